"""Operator 5, mixing sources to target weights (DataFrame functions only).

A source is its documents' words in a permuted order, cut into blocks of ``block_words``, or of less in a source whose target so large a
block would miss by a half per cent. Its target becomes an exact
quota of blocks; a multivariate-hypergeometric splitting tree deals the quotas of all sources to the output shards;
each shard draws its own stretch of every source's permuted block sequence, so that draws are disjoint, and shuffles
its blocks locally by a keyed hash. The permutation is a keyed Feistel network, so neighbouring blocks of a document land
apart. A document belongs to a mix through the word ranges of the blocks drawn.

Scale: documents are sized once, equal rows are counted, and different ones shuffled by (source, hash range), about 256 rows to a range of
all sources; global word offsets come from sums of ranges, and of 1,024 ranges at a time. Sources, of which there may be many, are ranked by
ranges, and the rate of weights is found by sums over all; the tree first deals quotas of groups of sources, as many as a group has sources,
and then each group's in a row of its own, so that no row has more numbers than the square root of the sources and no task more than some rows.

Edge cases: null or wordless text has size 0 and is taken 0 times; a null source is a source, ordered last; repeated rows
are dealt out one after the other; an empty table gives no rows; columns beside doc_id, text and source are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .common import materialize, table

WORD = r"[^\x20\x09-\x0D]+"
RANGE_ROWS = 256
#: Copies of a row that one task makes; sources that one task may put in order.
COPIES, FEW_SOURCES = 4096, 20_000
ROUNDS, WALK = 4, 24


def _uniform(*parts: Column) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def _with(s: Column, **more: Column) -> Column:
    for name, value in more.items():
        s = s.withField(name, value)
    return s


def hypergeometric(pop: Column, good: Column, draws: Column, u: Column) -> Column:
    """The u-quantile, counted outwards from the mode, of the good ones among draws out of pop.

    The pmf is summed by its ratio recurrence over twelve standard deviations and 20 on each side (beyond: below 1e-30).
    """
    given = F.struct(*[x.cast("double").alias(c) for c, x in (("n", pop), ("k", good), ("d", draws), ("u", u))])
    return _let(given, lambda g: _let(_bounds(g), lambda b: _let(_mass(b), _seek)))


def _bounds(g: Column) -> Column:
    n, k, d = g["n"], g["k"], g["d"]
    lo, hi, most = F.greatest(F.lit(0.0), d - (n - k)), F.least(d, k), F.greatest(n, F.lit(1.0))
    mode = F.least(hi, F.greatest(lo, F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")))
    spread = F.ceil(12 * F.sqrt(F.greatest(F.lit(0.0), d * k / most * (1 - k / most)))).cast("double") + 20
    return _with(g, mode=mode, up=F.least(hi - mode, spread).cast("int"), down=F.least(mode - lo, spread).cast("int"))


def _rise(g: Column, i: Column) -> Column:
    """p(mode + i) / p(mode + i - 1)"""
    return (g["k"] - g["mode"] - i + 1) * (g["d"] - g["mode"] - i + 1) / ((g["mode"] + i) * (g["n"] - g["k"] - g["d"] + g["mode"] + i))


def _fall(g: Column, i: Column) -> Column:
    """p(mode - i) / p(mode - i + 1)"""
    return (g["mode"] - i + 1) * (g["n"] - g["k"] - g["d"] + g["mode"] - i + 1) / ((g["k"] - g["mode"] + i) * (g["d"] - g["mode"] + i))


def _steps(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def _mass(g: Column) -> Column:
    def side(count: Column, ratio) -> Column:
        def step(s: Column, i: Column) -> Column:
            return _let(s["w"] * ratio(g, i), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")))

        return F.aggregate(_steps(count), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), step, lambda s: s["sum"])

    return _with(g, goal=g["u"] * (1.0 + side(g["up"], _rise) + side(g["down"], _fall)))


def _seek(g: Column) -> Column:
    def side(start: Column, count: Column, ratio, sign: int) -> Column:
        def step(s: Column, i: Column) -> Column:
            def move(w: Column) -> Column:
                here = (~s["done"]) & (s["sum"] + w >= g["goal"])
                return F.struct(w.alias("w"), (s["sum"] + w).alias("sum"), F.when(here, g["mode"] + sign * i).otherwise(s["x"]).alias("x"), (s["done"] | here).alias("done"))

            return _let(s["w"] * ratio(g, i), move)

        return F.aggregate(_steps(count), start, step)

    first = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), g["mode"].alias("x"), (g["goal"] <= 1.0).alias("done"))
    return _let(side(first, g["up"], _rise, 1), lambda s: side(_with(s, w=F.lit(1.0)), g["down"], _fall, -1)["x"].cast("long"))


def _dealer(seed: int):
    def deal(s: Column, q: Column) -> Column:
        x = hypergeometric(s["pop"], q, s["draws"], _uniform(F.lit(seed), F.col("level"), F.col("group"), F.col("shard"), F.size(s["out"])))
        return _let(x, lambda x: F.struct((s["draws"] - x).alias("draws"), (s["pop"] - q).alias("pop"), F.concat(s["out"], F.array(x)).alias("out")))

    return deal


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, q: a + q)


def split_quotas(roots: DataFrame, levels: int, seed: int) -> DataFrame:
    """roots(group, quotas array<long>, leaves array<long>) -> (group, shard, quotas) for 2^levels shards.

    Every inner node deals its blocks to its two children; how many of each source go left is a multivariate
    hypergeometric draw, made as a chain of conditional hypergeometric draws. leaves: how many blocks of the group each shard is
    to get; null: an inner node halves its blocks.
    """
    width = F.expr(f"shiftleft(1, {levels - 1} - level)")
    half = F.floor((_sum(F.col("quotas")) + F.pmod(F.xxhash64(F.lit(seed), "level", "shard"), F.lit(2))) / 2).cast("long")
    given = _sum(F.slice("leaves", (F.col("shard") * 2 * width + 1).cast("int"), width))
    start = F.struct(F.coalesce(given, half).alias("draws"), _sum(F.col("quotas")).alias("pop"), F.array().cast("array<bigint>").alias("out"))
    taken = F.aggregate("quotas", start, _dealer(seed), lambda s: s["out"])
    halves = F.array(
        F.struct((F.col("shard") * 2).alias("shard"), F.col("taken").alias("quotas")),
        F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("quotas", "taken", lambda a, b: a - b).alias("quotas")),
    )
    tree = roots.select("group", F.lit(0).cast("long").alias("shard"), "quotas", "leaves", F.lit(0).alias("level"))
    for level in range(levels):
        if level == 3:
            tree = tree.repartition(F.col("group"), F.col("shard"))
        tree = tree.select("*", taken.alias("taken")).select("group", "leaves", F.explode(halves).alias("half"), (F.col("level") + 1).alias("level"))
        tree = tree.select("group", "half.shard", "half.quotas", "leaves", "level")
    return tree.select("group", "shard", "quotas")


def deal_quotas(plan: DataFrame, sources: int, levels: int, seed: int) -> DataFrame:
    """plan(place, quota) of sources -> (shard, place, drawn)."""
    size = max(1, math.isqrt(max(0, sources - 1)) + 1)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "quota"))), lambda x: x["quota"])
    groups = materialize(plan.groupBy(F.floor(F.col("place") / size).alias("group")).agg(in_order.alias("quotas"), F.sum("quota").alias("all")), "mix_groups")
    root = groups.agg(F.transform(F.array_sort(F.collect_list(F.struct("group", "all"))), lambda x: x["all"]).alias("quotas"))  # a number for each group
    root = root.select(F.lit(-1).cast("long").alias("group"), "quotas", F.lit(None).cast("array<bigint>").alias("leaves"))
    dealt = split_quotas(root, levels, seed).select("shard", F.posexplode("quotas").alias("group", "got"))
    leaves = dealt.groupBy(F.col("group").cast("long").alias("group")).agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "got"))), lambda x: x["got"]).alias("leaves"))
    shards = split_quotas(groups.join(leaves, "group").select("group", "quotas", "leaves"), levels, seed)
    return shards.select("shard", "group", F.posexplode("quotas").alias("at", "drawn")).select("shard", (F.col("group") * size + F.col("at")).alias("place"), "drawn")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """sizes(source, words) -> adds place (order by code point, null last), weight, target.

    Targets are in proportion to weight; none is over ceiling times its source, and what one cannot take goes to the others:
    the common rate rises, by sums over all sources, until no further one is at its ceiling.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    sizes = materialize(sizes.withColumn("_last", F.col("source").isNull()), "mix_sources")
    order = ["_last", "source"]
    # A window over all is one task's, so it is for a counted few; ranges serve for the others.
    few = sizes.count() <= FEW_SOURCES
    out = sizes.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long")) if few else global_rank(sizes, order, "place")
    out = out.drop("_last").withColumn("place", F.col("place") - 1)
    out = materialize(out.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).cast("double")), "mix_places")
    limit, rate, full = ceiling * F.col("words"), 0.0, -1
    while True:
        at_limit = F.col("weight") * rate >= limit if full >= 0 else F.lit(False)
        now = out.agg(F.count_if(at_limit), share * F.sum("words") - F.coalesce(F.sum(F.when(at_limit, limit)), F.lit(0.0)), F.sum(F.when(~at_limit, F.col("weight")))).first()
        if now[0] == full or not now[2]:
            break
        full, rate = now[0], now[1] / now[2]
    # With every source at its ceiling there is no rate; share is then over ceiling.
    target = F.least(F.col("weight") * rate, limit) if now[2] or now[0] == 0 else limit
    return out.withColumn("target", target.cast("double"))


def permuted(x: Column, count: Column, rows: Column, cols: Column, keys: list[Column]) -> Column:
    """A keyed permutation of 0 .. count-1, for rows * cols >= count: a Feistel network over (row, column), a round a key, walked on while it leads outside.

    Outside are fewer than rows numbers of rows * cols; no walk is longer, and one of WALK steps has a chance below 1e-14.
    """

    def network(x: Column) -> Column:
        def turn(s: Column, j: int) -> Column:
            add = lambda other, size: F.pmod(F.xxhash64(keys[j], other), size)
            if j % 2:
                return F.struct(s["l"].alias("l"), F.pmod(s["r"] + add(s["l"], cols), cols).alias("r"))
            return F.struct(F.pmod(s["l"] + add(s["r"], rows), rows).alias("l"), s["r"].alias("r"))

        def rounds(s: Column, j: int) -> Column:
            return _let(turn(s, j), lambda t: rounds(t, j + 1)) if j < len(keys) else s["l"] * cols + s["r"]

        return rounds(F.struct(F.floor(x / cols).alias("l"), F.pmod(x, cols).alias("r")), 0)

    steps = F.slice(F.array(*[F.lit(i) for i in range(WALK)]), F.lit(1), F.least(rows * cols - count, F.lit(WALK)).cast("int"))
    return F.aggregate(steps, network(x), lambda y, _: F.when(y >= count, network(y)).otherwise(y))


def _copies(rows: DataFrame, most: int) -> DataFrame:
    """rows(begin, size, n, ...) -> n rows for each, one behind the other; more than COPIES are dealt out over tasks before they are made."""
    if most == 1:
        return rows
    last = F.col("n") - 1

    def made(some: DataFrame, first: Column, stop: Column) -> DataFrame:
        return some.withColumn("_copy", F.explode(F.sequence(first, stop))).withColumn("begin", F.col("begin") + F.col("_copy") * F.col("size")).drop("_copy")

    few = made(rows.where(F.col("n") <= COPIES), F.lit(0).cast("long"), last)
    if most <= COPIES:
        return few
    parts = rows.where(F.col("n") > COPIES).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES))))
    parts = parts.repartition(F.col("h"), F.col("_part"))
    return few.unionByName(made(parts, F.col("_part") * COPIES, F.least(last, (F.col("_part") + 1) * COPIES - 1)).drop("_part"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, ceiling: int = 2, block_words: int = 32, levels: int = 6, seed: int = 5
) -> DataFrame:
    """docs(doc_id, text, source) -> (doc_id, source, size, target, segments), one row for each row of docs.

    segments: array of (shard, pass, order_key, start_word, n_words), the word ranges drawn; a shard is read in order of order_key.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.lit(seed), "doc_id", text).alias("h"))
    # Equal rows are one from here on, until their places are known.
    sized = sized.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n"))
    sized = materialize(sized.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))), "mix_sizes")
    different, most = sized.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(1))).first()
    bits = max(0, math.ceil(math.log2(max(1, different) / RANGE_ROWS)))
    sized = sized.withColumn("range", F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")).withColumn("all", F.col("size") * F.col("n"))

    plan = source_targets(sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("all").alias("words")), weights, share, ceiling)
    fine = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("target") / 200)))
    plan = plan.withColumn("width", F.greatest(fine, F.ceil(F.col("words") / float(1 << 30))).cast("long"))
    plan = plan.withColumn("blocks", F.ceil(F.col("words") / F.col("width")).cast("long"))
    plan = plan.withColumn("quota", F.coalesce(F.round(F.col("target") / F.when(F.col("words") > 0, F.col("words")) * F.col("blocks")), F.lit(0)).cast("long"))
    plan = plan.withColumn("rows", F.greatest(F.lit(1), F.ceil(F.sqrt("blocks"))).cast("long"))
    plan = materialize(plan.withColumn("cols", F.greatest(F.lit(1), F.ceil(F.col("blocks") / F.col("rows"))).cast("long")), "mix_plan")
    shards = deal_quotas(plan.select("place", "quota"), plan.count(), levels, seed)
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("begin", F.coalesce(F.sum("drawn").over(before), F.lit(0)))
    starts = shards.groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "begin"))), lambda x: x["begin"]).alias("starts"))
    turns = range(math.ceil(ceiling))
    keys = [F.xxhash64(F.lit(seed), "place", F.lit(turn), F.lit(j)).alias(f"key_{turn}_{j}") for turn in turns for j in range(ROUNDS)]
    plan = plan.join(starts, "place", "left").select("key", "target", "width", "blocks", "rows", "cols", "quota", "starts", "place", *keys)

    ranges = sized.groupBy("key", "range").agg(F.sum("all").alias("words")).withColumn("span", F.shiftright("range", 10))
    spans = ranges.groupBy("key", "span").agg(F.sum("words").alias("words"))
    past = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("key", "span", F.coalesce(F.sum("words").over(past), F.lit(0)).alias("outer")).join(plan, "key")
    earlier = Window.partitionBy("key", "span").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inner", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(spans, ["key", "span"])
    ranges = ranges.withColumn("base", F.col("outer") + F.col("inner")).drop("words", "span", "outer", "inner")
    within = Window.partitionBy("key", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.join(ranges, ["key", "range"]).withColumn("begin", F.col("base") + F.coalesce(F.sum("all").over(within), F.lit(0)))
    rows = _copies(rows, most)

    begin, size, width, blocks, quota = (F.col(c) for c in ("begin", "size", "width", "blocks", "quota"))
    own = F.sequence(F.floor(begin / width), F.floor((begin + size - 1) / width))
    halvings = F.array(*[F.lit(1 << i) for i in reversed(range(levels))])

    def place_of(b: Column, turn: int) -> Column:
        return turn * blocks + permuted(b, blocks, F.col("rows"), F.col("cols"), [F.col(f"key_{turn}_{j}") for j in range(ROUNDS)])

    def shard_of(p: Column) -> Column:
        return F.aggregate(halvings, F.lit(0), lambda lo, s: F.when(F.element_at("starts", lo + s + 1) <= p, lo + s).otherwise(lo))

    def segment(x: Column, turn: int) -> Column:
        first = F.greatest(begin, x["b"] * width)
        words = F.least(begin + size, (x["b"] + 1) * width) - first
        return F.struct(
            shard_of(x["p"]).alias("shard"), F.lit(turn).alias("pass"), F.xxhash64(F.lit(seed), F.col("place"), x["p"]).alias("order_key"),
            (first - begin).alias("start_word"), words.alias("n_words"),
        )

    def drawn_in(turn: int) -> Column:
        placed = F.transform(F.when(quota > turn * blocks, own).otherwise(F.array().cast("array<bigint>")), lambda b: F.struct(b.alias("b"), place_of(b, turn).alias("p")))
        return F.transform(F.filter(placed, lambda x: x["p"] < quota), lambda x: segment(x, turn))

    drawn = F.concat(*[drawn_in(turn) for turn in turns])
    return rows.select("doc_id", "source", "size", "target", F.when(size > 0, drawn).alias("segments"))


def mixed_blocks(mixed: DataFrame) -> DataFrame:
    """The mix as rows (shard, order_key, doc_id, pass, start_word, n_words)."""
    return mixed.select("doc_id", F.explode("segments").alias("s")).select("s.shard", "s.order_key", "doc_id", "s.pass", "s.start_word", "s.n_words")


def op5_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix(table(spark, sf_dir, "documents")))


def taken_words(mixed: DataFrame) -> DataFrame:
    taken = F.aggregate(F.coalesce("segments", F.array()), F.lit(0).cast("long"), lambda a, s: a + s["n_words"])
    return mixed.select("doc_id", "size", "source", "target", taken.alias("taken"))
