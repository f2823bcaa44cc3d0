"""Operator 6, near-duplicates by MinHash with tensored banding.

Two collections of 8 values, each value made of 2 minhashes, stand for 64 tables: a table's key is a pair of one value
from either collection, so 32 minhashes do the work of 256. At a similarity of 0.85 a pair shares no key with a
probability of 7e-5, which is all that is lost; for other thresholds, a parameter, the collections are sized to the same (10 values
at 0.80). Documents with equal shingle sets are one class from the start and only classes are compared:

1. a value that one class alone has is dropped before keys are formed, as it cannot be part of a shared key;
2. in every bucket, the member with most bucket mates is the pivot, and all others are compared with it;
3. classes that the pivots have not joined are compared across components, pivot by pivot: every class outside the largest
   component of the pivot's bucket mates with every mate of another component. Mates are cut into chunks of about CHUNK shingles, a
   task compares two chunks by the products of their incidence matrices, and only links leave it: no pair is emitted and no task
   holds a whole group. A set is copied to as many chunk pairs as its family has chunks.

Every link is confirmed on the full shingle sets, as 64-bit shingle hashes. In buckets of more than LARGE members, a class
goes before step 2 if fewer than the threshold's share of its shingles occur in any other such class: no partner can
then be similar enough. This and the bounds by sizes are exact, so no link between bucket mates is lost, however large the bucket.

Edge cases: null, empty or white-space text has no shingles and stays alone; a text of fewer words than a shingle is one
shingle; rows that repeat a doc_id are linked as their texts are, and share the doc_id's component; a null doc_id is
linked like others but names no component unless alone, and is kept only then; columns beside doc_id and text pass by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .components import components
from .words import P, WordHashes, mix, shingle_set

PER_VALUE, WIDTH, PERCENT = 2, 5, 85
MISSED = 7.5e-5  # most of the pairs at the threshold that may share no key
LARGE, CHUNK = 16, 1 << 16
STEP, DENSE, COLUMNS = 1 << 14, 256, 2048


def tuned(percent: int) -> int:
    """Values of a collection for a threshold: 8 at 85, 10 at 80."""
    half = 1
    while 2 * (1 - (percent / 100) ** PER_VALUE) ** half > MISSED:
        half += 1
    return half


def _multipliers(half: int, seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 63, (2, 2 * half * PER_VALUE), np.uint64) * np.uint64(2) + np.uint64(1)
    return draw[0][:, None], draw[1][:, None]


def minhashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), ~np.uint64(0), np.uint64)
    for i in range(0, len(shingles), STEP):  # bounded memory for very long texts
        low = np.minimum(low, (a * shingles[None, i : i + STEP] + b).min(axis=1))
    return low


def _sketch(batches: Iterator[pa.RecordBatch], half: int) -> Iterator[pa.RecordBatch]:
    cache, (a, b) = WordHashes(), _multipliers(half)
    for batch in batches:
        n, cls, values = [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), WIDTH, cache)
            n.append(len(s))
            if not len(s):
                cls.append(None), values.append(None)
                continue
            cls.append(int(mix(np.array([(mix(s) * P).sum(dtype=np.uint64) ^ np.uint64(len(s))], np.uint64)).view(np.int64)[0]))
            m = minhashes(s, a, b)
            at = np.arange(2 * half, dtype=np.uint64)
            values.append(mix((m[0::2] * P + m[1::2]) * P + at).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(values, pa.list_(pa.int64()))], ["doc_id", "th", "n_shingles", "cls", "vals"]
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        for i in range(0, len(batch), 256):  # sets are larger than texts: small batches
            sets = [shingle_set(t.as_py(), WIDTH, cache) for t in batch.column("text").slice(i, 256)]
            cls = [int(mix(np.array([(mix(s) * P).sum(dtype=np.uint64) ^ np.uint64(len(s))], np.uint64)).view(np.int64)[0]) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["cls", "shingles"])


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th"))


def sketch(docs: DataFrame, half: int) -> DataFrame:
    """(doc_id, th, n_shingles, cls, vals): hash of the text, class of equal shingle sets, and the values of both collections."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _hashed(docs).mapInArrow(lambda batches: _sketch(batches, half), f"doc_id {kind}, th long, n_shingles long, cls long, vals array<long>")


def buckets(classes: DataFrame, half: int) -> DataFrame:
    """classes(cls, vals) -> (key, cls, size), for keys that at least two classes have."""
    values = classes.select("cls", F.posexplode("vals").alias("at", "value"))
    shared = values.groupBy("value").count().where("count > 1").select("value")
    left = values.join(shared, "value").groupBy("cls").agg(F.collect_list(F.struct("at", "value")).alias("vals"))
    left = left.where(F.exists("vals", lambda v: v["at"] < half) & F.exists("vals", lambda v: v["at"] >= half))
    one = left.select("cls", F.filter("vals", lambda v: v["at"] < half).alias("a"), F.filter("vals", lambda v: v["at"] >= half).alias("b"))
    pairs = one.select("cls", F.explode(F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x["value"], y["value"]))))).alias("key"))
    keys = materialize(pairs.select("key", "cls"), "keys")
    return keys.join(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the class pairs (u, v), those that the full sets confirm."""
    a = sets.select(F.col("cls").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("cls").alias("v"), F.col("shingles").alias("sv"))
    both = pairs.join(a, "u").join(b, "v").withColumn("inter", F.size(F.array_intersect("su", "sv")))
    return both.where(100 * F.col("inter") >= percent * (F.size("su") + F.size("sv") - F.col("inter"))).select("u", "v")


def _common(sets: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """How many shingles each of sets shares with each of others. sets, others: (number of the set, shingle) of all members.

    Shingles of many sets are columns of matrices that are multiplied, COLUMNS at a time; the pairs of the rest are counted one by one.
    """
    both = np.intersect1d(sets[1], others[1])
    (i, x), (j, y) = ((own[k], np.searchsorted(both, shingles[k])) for own, shingles in (sets, others) for k in (np.isin(shingles, both),))
    i, x, j, y = (z for own, col in ((i, x), (j, y)) for order in (np.argsort(col, kind="stable"),) for z in (own[order], col[order]))
    left, right = np.bincount(x, minlength=len(both)), np.bincount(y, minlength=len(both))
    out = np.zeros(shape, np.float32)
    hot = np.flatnonzero(left * right > DENSE)
    rank = np.full(len(both), -1, np.int64)
    rank[hot] = np.arange(len(hot))
    for first in range(0, len(hot), COLUMNS):
        a, b = (np.zeros((n, COLUMNS), np.float32) for n in shape)
        for matrix, own, col in ((a, i, x), (b, j, y)):
            at = (rank[col] >= first) & (rank[col] < first + COLUMNS)
            matrix[own[at], rank[col[at]] - first] = 1
        out += a @ b.T
    rare = np.flatnonzero(left * right <= DENSE)
    ends, other_ends, flat = np.cumsum(left), np.cumsum(right), out.reshape(-1)
    for first in range(0, len(rare), 1 << 14):
        cols = rare[first : first + (1 << 14)]
        pairs = left[cols] * right[cols]
        at = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        wide, begin, other = (np.repeat(v[cols], pairs) for v in (right, ends - left, other_ends - right))
        keys, counts = np.unique(i[begin + at // wide] * shape[1] + j[other + at % wide], return_counts=True)
        flat[keys] += counts
    return out


def _compare_chunks(rows: pa.Table, percent: int) -> pa.Table:
    """Links between the outer classes and the mates of one pair of chunks."""
    rows = rows.combine_chunks()
    side, cls, component, n = (rows.column(c).to_numpy() for c in ("outer", "cls", "component", "n"))
    common = rows.column("common").fill_null(-1).to_numpy()
    outer, mates = np.flatnonzero(side), np.flatnonzero(side == 0)
    able = (component[outer][:, None] != component[mates]) & (100 * np.minimum(n[outer][:, None], n[mates]) >= percent * np.maximum(n[outer][:, None], n[mates]))
    shared = np.minimum(common[outer][:, None], common[mates])  # what two of a crowd have both is common to the crowd
    able &= (shared < 0) | ((100 + percent) * shared >= percent * (n[outer][:, None] + n[mates]))
    outer, mates, able = outer[able.any(axis=1)], mates[able.any(axis=0)], able[able.any(axis=1)][:, able.any(axis=0)]
    if not able.size:
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    lists = rows.column("shingles").chunk(0)
    members, offsets = np.asarray(lists.values), np.asarray(lists.offsets)

    def all_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(at)), offsets[at + 1] - offsets[at]), np.concatenate([members[offsets[k] : offsets[k + 1]] for k in at])

    inter = _common(all_of(outer), all_of(mates), (len(outer), len(mates))).astype(np.int64)
    i, j = np.nonzero(able & (100 * inter >= percent * (n[outer][:, None] + n[mates] - inter)))
    u, v = cls[outer[i]], cls[mates[j]]
    return pa.table({"u": pa.array(np.minimum(u, v), pa.int64()), "v": pa.array(np.maximum(u, v), pa.int64())})


def _chunks(shingles: Column) -> Column:
    """Of about CHUNK shingles; more and smaller ones in families of a few chunks, so that they are spread, too."""
    return F.when(shingles < CHUNK // 2, 1).otherwise(F.greatest(F.ceil(shingles / CHUNK), F.ceil(F.sqrt(shingles * 32 / CHUNK)))).cast("long")


def _across(mates: DataFrame, traits: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """mates(pivot, cls, component, n) -> links (u, v) between classes of different components with a common pivot."""
    parts = mates.groupBy("pivot", "component").agg(F.sum("n").alias("size"))
    tops = parts.groupBy("pivot").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    tops = tops.select("pivot", F.col("top.component").alias("top"), _chunks(F.col("all")).alias("chunks"), _chunks(F.col("all") - F.col("top.size")).alias("outer_chunks"))
    tops = materialize(tops, "tops")  # apart from the join, which Spark can then split where a pivot has many mates
    rows = mates.drop("n").join(tops, "pivot").join(traits, "cls").join(sets, "cls")
    own = lambda count: F.pmod(F.xxhash64("cls"), count)
    as_mate = F.transform(F.sequence(F.lit(0).cast("long"), F.col("outer_chunks") - 1), lambda c: F.struct(F.lit(0).alias("outer"), c.alias("oc"), own(F.col("chunks")).alias("mc")))
    as_outer = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda c: F.struct(F.lit(1).alias("outer"), own(F.col("outer_chunks")).alias("oc"), c.alias("mc")))
    places = F.when(F.col("component") == F.col("top"), as_mate).otherwise(F.concat(as_mate, as_outer))
    placed = rows.select("pivot", "cls", "component", "n", "common", "shingles", F.explode(places).alias("at")).select("*", "at.*").drop("at")
    return placed.groupBy("pivot", "oc", "mc").applyInArrow(lambda rows: _compare_chunks(rows, percent), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_shingles, component_id, kept), a row for each row of docs; pairs of a similarity of percent or more are linked."""
    return _grouped(docs, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, first): th is the text's hash, first that of the least row of the component."""
    half = tuned(percent)
    sketched = materialize(sketch(docs, half), "sketch")
    least = F.min(F.struct("doc_id", "th"))
    classes = sketched.where("cls is not null").groupBy("cls", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("id"), least.alias("rep"), F.first("vals").alias("vals"))
    classes = materialize(classes, "classes")
    members = materialize(buckets(classes, half), "buckets")
    compared = materialize(members.select("cls").distinct(), "compared")
    wanted = classes.join(compared, "cls", "left_semi").select(F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th"))
    texts = _hashed(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left_semi").select("text")
    sets = materialize(texts.mapInArrow(_sets, "cls long, shingles array<long>").join(compared, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles")), "sets")

    crowd = members.where(F.col("size") > LARGE).select("cls").distinct()
    crowd = sets.join(crowd, "cls", "left_semi")
    each = crowd.select("cls", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").count().where("count > 1").select("shingle")
    crowd = crowd.select("cls", F.size("shingles").alias("n")).join(each.join(common, "shingle").groupBy("cls").agg(F.count("*").alias("common")), "cls", "left")
    crowd = materialize(crowd.withColumn("common", F.coalesce("common", F.lit(0))), "crowd")
    lone = crowd.where(100 * F.col("common") < percent * F.col("n")).select("cls", F.lit(True).alias("lone"))
    members = members.join(lone, "cls", "left").where((F.col("size") <= LARGE) | F.col("lone").isNull()).drop("lone", "size")
    members = materialize(members, "members")

    degree = members.join(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key").groupBy("cls").agg(F.sum("size").alias("degree"))
    pivots = members.join(degree, "cls").groupBy("key").agg(F.max(F.struct("degree", "cls"))["cls"].alias("pivot"), F.count("*").alias("size")).where("size > 1").select("key", "pivot")
    pivots = materialize(pivots, "pivots")
    stars = members.join(pivots, "key").where("cls <> pivot").select(F.least("cls", "pivot").alias("u"), F.greatest("cls", "pivot").alias("v")).distinct()
    links = materialize(_linked(stars, sets, percent), "links")
    found = components(links)

    traits = classes.join(compared, "cls", "left_semi").join(crowd.select("cls", "common"), "cls", "left").select("cls", "n", "common")
    mates = members.join(pivots, "key").select("pivot", "cls").distinct().join(found.select(F.col("node").alias("cls"), "component"), "cls", "left")
    mates = materialize(mates.withColumn("component", F.coalesce("component", "cls")).join(traits.select("cls", "n"), "cls"), "mates")
    links = links.unionByName(materialize(_across(mates, traits, sets, percent), "links"))
    return _labelled(sketched, classes, components(links))


def _labelled(sketched: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    named = classes.select("cls", "id", "rep").join(found.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"), F.min("rep")["th"].alias("first"))
    named = named.join(least, "component").select("cls", "component_id", "first")
    out = sketched.select("doc_id", "th", "n_shingles", "cls").join(named, "cls", "left")
    return out.select("doc_id", "th", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.when(F.col("cls").isNotNull(), F.col("first")).otherwise(F.col("th")).alias("first"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs without the documents that are not their component's first; of a component without any doc_id, the least text stays."""
    groups = materialize(_grouped(docs, percent), "groups")
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    nameless = groups.where("doc_id is null and (component_id is not null or th <> first)").select(F.col("th").alias("_th")).distinct()
    named = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(docs.columns)
    if nameless.isEmpty():
        return named.unionByName(docs.where("doc_id is null"))
    return named.unionByName(docs.where("doc_id is null").join(nameless, F.xxhash64("text") == F.col("_th"), "left_anti").select(docs.columns))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), PERCENT)
