"""Operator 10, personal data by weak supervision (DataFrame functions only).

Base patterns give spans of e-mail addresses, IP addresses, card and phone numbers that always stay. Looser patterns give
more candidates: addresses spelt out, phone numbers without a plus, keys and passwords, national numbers, names behind a title.
Labelers vote on every candidate, -1, 0 or 1, and may disagree: the base pattern; a strict shape; gazetteers of what is known to be
real or known to be a placeholder; key words before it; words before it that speak of other numbers; and how varied its
characters are and whether they run in a row. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, with no labels. The
posteriors train a naive Bayes classifier of spans, which also sees the span's length, punctuation, share of digits and
the characters on either side, and decides on the candidates that are not base spans.

Offsets come from splitting a text at the matches and adding up lengths, all inside one row, so texts are never shuffled. A
candidate's context is the text between it and the match before. Work is in proportion to a text's length, times the
logarithm of its base spans. What is gathered for the model are a weight for each value of each feature of each kind.

Edge cases: null text is empty; offsets are code points, end exclusive; matches of a kind do not overlap; a candidate
that overlaps a base span of any kind, or begins inside an earlier candidate of its kind, is left out; with no candidate anywhere
there is no model and only base spans remain; repeated rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

KINDS = ("email", "ip", "card", "phone")
# \G keeps the scan linear: a match begins where its run of characters does, or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without a match of this has no base match of the kind; cheap to test.
HINT = {"email": ("@",), "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9_%+-])(?<![A-Za-z0-9_%+-]\.))[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+ ?[\[({<] ?at ?[\])}>] ?[A-Za-z0-9-]++(?: ?[\[({<] ?dot ?[\])}>] ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "secret": r"AKIA[A-Z0-9]{16}|(?i:password|passwd|token|api[_-]?key|secret)\s?[=:]\s?\"?[A-Za-z0-9+/_-]{8,}+\"?",
    "id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "name": r"(?<![\p{L}.])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.? \p{Lu}\p{Ll}{2,}+(?: \p{Lu}\p{Ll}{2,}+)?",
}
# Words of which a text with a loose match has one, or a pattern that it matches.
LOOSE_HINT = {
    "email": r"[\[({<] ?at ?[\])}>]", "phone": r"[0-9]{3}[ .-][0-9]{4}", "secret": ("=", ":", "AKIA"), "id": r"-[0-9]{2}-", "name": ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Señor", "Monsieur", "Madame"),
}
# Labelers, by kind: a pattern that votes for a span, and one that votes against it (None: never; ANY_OTHER: whenever the first does not match).
ANY_OTHER = ""
SHAPE = {
    "email": (r"(?i)[a-z]{2,}$", ANY_OTHER), "ip": (r"^(?!0)[0-9.]+$", ANY_OTHER), "card": (r"^[3-6]", ANY_OTHER), "phone": (r"^(?:\+|\(?[2-9][0-9]{2}\)?[ .-][2-9])", ANY_OTHER),
    "secret": (r"^AKIA|[=:]\s?\"?(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[^\"]{8,}", ANY_OTHER), "id": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", ANY_OTHER), "name": (r"^\S+ \S+ \S+$", ANY_OTHER),
}
TOP_DOMAINS = "com org net edu gov int mil info biz io dev app de fr es it nl be at ch uk ie pt pl se no dk fi cz eu us ca mx br ar au nz jp cn in example"
GAZETTEER = {
    "email": (rf"(?i)(?:{TOP_DOMAINS.replace(' ', '|')})$", ANY_OTHER), "ip": (None, r"^(?:0|127|255)\."), "card": (r"^(?:4|5[1-5]|3[47]|6011|65)", None), "phone": (None, r"^\(?(?:800|888|877|866|900)\)?[ .-]"),
    "secret": (r"AKIA|ghp_|sk_|xox|eyJ", r"(?i)example|changeme|required|placeholder|optional|default|undefined|function|string|xxxx|123456|abcdef"), "id": (None, r"^(?:123-45-6789|078-05-1120|219-09-9999)$"),
    "name": (None, None),  # which words are names differs with the corpus: the shape and the words before it decide
}
CONTEXT = {
    "email": r"(?i)mail|contact|write|from|reach", "ip": r"(?i)\bip\b|address|host|server|login", "card": r"(?i)card|visa|master|credit|payment", "phone": r"(?i)phone|tel\b|call|mobile|fax|whatsapp",
    "secret": r"(?i)key|auth|secret|pass|token|credential", "id": r"(?i)ssn|social|security|insurance", "name": r"(?i)by|from|dear|signed|contact|with|patient",
}
AGAINST = r"(?i)(?:version|isbn|issn|page|chapter|section|order|invoice|figure|table|total|part|serial|no\.|doi|film|dummy|sample)[ :#]*+$"
VARIED = {"email": 5, "ip": 3, "card": 4, "phone": 4, "secret": 6, "id": 4}  # different letters and digits
RUNS = r"12345|23456|34567|45678|56789|67890|98765|87654|76543|65432|54321|abcde|qwert"  # characters in a row are typed, not drawn
LABELERS = ("base", "shape", "gazetteer", "context", "against", "variety")
BEFORE = 24
CHUNK = 256
SPANS = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
ROUNDS = 30


def _let(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    ints = F.transform(F.split(F.reverse(digits), ""), lambda c: F.expr("0") + c.try_cast("int"))
    worth = F.transform(ints, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(F.filter(worth, lambda w: w.isNotNull()), F.lit(0), lambda a, w: a + w) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: p.try_cast("double") <= 255)
    if kind == "card":
        return _let(_digits(s), lambda d: F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _chunks(items: Column) -> Column:
    """An array in pieces of CHUNK, so that arrays that grow an item at a time stay short however long a text is."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / CHUNK).cast("int") - 1, F.lit(0))), lambda c: F.slice(items, c * CHUNK + 1, CHUNK))


def _offsets(chunks: Column) -> Column:
    """Where each chunk of (gap, value) begins in the text."""
    size = lambda chunk: F.aggregate(chunk, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["value"]))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(chunks, first, lambda s, c: F.struct((s["at"] + size(c)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])


def _located(chunk: Column, begin: Column) -> Column:
    def add(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

    return F.aggregate(chunk, F.struct(begin.alias("at"), F.array().cast(SPANS).alias("out")), add, lambda s: s["out"])


def _matches(text: Column, pattern: str, hint: str | tuple[str, ...]) -> Column:
    """Array of (start, end, value, before, after), in order, of all matches of pattern: the text between matches, added up, gives their places."""

    def zipped(gaps: Column) -> Column:
        rows = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("value"), F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("next"))
        return F.transform(
            F.filter(rows, lambda x: x["value"].isNotNull()),
            lambda x: F.struct(x["gap"].alias("gap"), x["value"].alias("value"), F.right(x["gap"], F.lit(BEFORE)).alias("before"), F.left(x["next"], F.lit(1)).alias("after")),
        )

    found = _let(F.split(text, pattern, -1), lambda gaps: _let(zipped(gaps), lambda p: _let(_chunks(p), lambda c: F.flatten(F.zip_with(c, _offsets(c), _located)))))
    hinted = text.rlike(hint) if isinstance(hint, str) else _any([F.contains(text, F.lit(word)) for word in hint])
    return F.when(hinted, found).otherwise(F.array().cast(SPANS))


def _vote(value: Column, rules: tuple[str | None, str | None]) -> Column:
    yes, no = rules
    against = F.lit(no == ANY_OTHER) if no == ANY_OTHER or no is None else value.rlike(no)
    return F.when(against, -1).otherwise(F.when(value.rlike(yes), 1).otherwise(0) if yes else F.lit(0)) if no != ANY_OTHER else F.when(value.rlike(yes), 1).otherwise(-1)


def candidates(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, base, more): arrays of (kind, start, end, features)."""
    text = F.col("text")
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind in KINDS:
        out = out.withColumn(kind, _base_matches(kind, text))
    for kind in LOOSE:
        out = out.withColumn(f"loose_{kind}", _apart(_matches(text, LOOSE[kind], LOOSE_HINT[kind])))
    base = F.concat(*[_described(F.col(kind), kind, True) for kind in KINDS])
    more = F.concat(*[_described(F.col(f"loose_{kind}"), kind, False) for kind in LOOSE])
    return out.select("doc_id", base.alias("base"), more.alias("more"))


def _apart(spans: Column) -> Column:
    """Those of spans that overlap no base span of any kind."""
    return _let(spans, lambda found: F.filter(found, lambda m: ~_any([_overlaps(m, F.col(kind)) for kind in KINDS])))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _overlaps(m: Column, sorted_spans: Column) -> Column:
    """Whether m overlaps one of spans, which are in order and apart: the first that ends behind m's start is found by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_spans) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(sorted_spans).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        def side(mid: Column) -> Column:
            behind = F.get(sorted_spans, mid)["end"] > m["start"]
            return F.when(s["low"] >= s["high"], s).when(behind, F.struct(s["low"].alias("low"), mid.alias("high"))).otherwise(F.struct((mid + 1).alias("low"), s["high"].alias("high")))

        return _let(F.floor((s["low"] + s["high"]) / 2).cast("int"), side)

    first = F.aggregate(steps, start, halve, lambda s: s["low"])
    return F.when(F.size(sorted_spans) > 0, F.coalesce(F.get(sorted_spans, first)["start"] < m["end"], F.lit(False))).otherwise(False)


def _base_matches(kind: str, text: Column) -> Column:
    return F.filter(_matches(text, BASE[kind], HINT[kind]), lambda m: _valid(kind, m["value"]))


def _described(spans: Column, kind: str, base: bool) -> Column:
    """Spans with kind, votes and the classifier's own features as one string."""

    def one(m: Column) -> Column:
        value, ahead = m["value"], m["before"]
        marks = F.regexp_replace(value, r"[^\p{L}\p{N}]", "")
        core = F.regexp_replace(F.lower(marks if kind != "secret" else F.regexp_replace(value, r'^(?i:[a-z_-]+)\s?[=:]', "")), r"[^\p{L}\p{N}]", "")
        varied = F.size(F.array_distinct(F.split(core, "")))
        votes = [
            F.lit(1 if base else 0), _vote(value, SHAPE[kind]), _vote(value, GAZETTEER[kind]), F.when(ahead.rlike(CONTEXT[kind]), 1).otherwise(0), F.when(ahead.rlike(AGAINST), -1).otherwise(0),
            F.when((varied >= VARIED[kind]) & ~core.rlike(RUNS), 1).otherwise(-1) if kind in VARIED else F.lit(0),
        ]
        size = F.least(F.floor(F.length(value) / 8), F.lit(4))
        punctuation = F.when(value.rlike(r"[()\[\]{}<>\"]"), 2).when(value.rlike(r"[.-]"), 1).otherwise(0)
        digits = F.least(F.floor(4 * F.length(_digits(marks)) / F.greatest(F.length(marks), F.lit(1))), F.lit(3))
        left = F.when(ahead == "", 0).when(ahead.rlike(r"\s\z"), 1).otherwise(2)
        right = F.when(m["after"] == "", 0).when(m["after"].rlike(r"\s"), 1).when(m["after"].rlike(r"[.,;:!?]"), 2).otherwise(3)
        features = F.concat_ws(",", *[v.cast("string") for v in (*votes, size, punctuation, digits, left, right)])
        return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), features.alias("features"))

    return F.transform(spans, one)


def _votes(features: Column) -> Column:
    return F.slice(F.split(features, ","), 1, len(LABELERS))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """patterns(kind, features, n) -> (kind, features, n, posterior): EM over one prior and a reliability for each labeler.

    Labelers are taken as independent given the truth; the prior and every reliability are kept from 0 and 1 by
    pseudo-counts of four votes, three of them right. Only counts of vote patterns, 3^6 at most a kind, come together.
    """
    voted = patterns.withColumn("votes", F.array_join(_votes(F.col("features")), ","))
    rows = voted.groupBy("kind", "votes").agg(F.sum("n").cast("double").alias("n"))
    rows = rows.select("kind", F.col("votes").alias("features"), "n", F.transform(_votes(F.col("votes")), lambda x: x.cast("int")).alias("votes"))
    grouped = rows.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("features", "n", "votes"))).alias("rows"))

    def odds(s: Column, r: Column) -> Column:
        each = F.zip_with(r["votes"], s["right"], lambda v, a: v * F.log(a / (1 - a)))
        return F.aggregate(each, F.log(s["prior"] / (1 - s["prior"])), lambda a, x: a + x)

    def posteriors(s: Column) -> Column:
        return F.transform("rows", lambda r: F.struct(r["features"].alias("features"), r["n"].alias("n"), r["votes"].alias("votes"), (1 / (1 + F.exp(-odds(s, r)))).alias("p")))

    def total(rs: Column, f) -> Column:
        return F.aggregate(rs, F.lit(0.0), lambda a, r: a + f(r))

    def maximise(rs: Column) -> Column:
        prior = (total(rs, lambda r: r["n"] * r["p"]) + 1) / (total(rs, lambda r: r["n"]) + 2)
        return F.struct(prior.alias("prior"), F.array(*[_reliability(rs, j) for j in range(len(LABELERS))]).alias("right"))

    start = F.struct(F.lit(0.5).alias("prior"), F.array(*[F.lit(0.75)] * len(LABELERS)).alias("right"))
    model = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda s, _: _let(posteriors(s), maximise))
    done = grouped.withColumn("model", model).select("kind", F.explode(posteriors(F.col("model"))).alias("r"))
    done = done.select("kind", F.col("r.features").alias("votes"), F.col("r.p").alias("posterior"))
    return voted.join(done, ["kind", "votes"]).select("kind", "features", F.col("n").cast("double").alias("n"), "posterior")


def _reliability(rs: Column, j: int) -> Column:
    def right(a: Column, r: Column) -> Column:
        return a + r["n"] * F.when(r["votes"][j] == 1, r["p"]).when(r["votes"][j] == -1, 1 - r["p"]).otherwise(0.0)

    def cast(a: Column, r: Column) -> Column:
        return a + r["n"] * F.abs(r["votes"][j])

    return (F.aggregate(rs, F.lit(0.0), right) + 3) / (F.aggregate(rs, F.lit(0.0), cast) + 4)


def span_classifier(labelled: DataFrame) -> DataFrame:
    """(kind, features, n, posterior) -> (kind, at, value, weight): naive Bayes on the soft labels, add-one smoothed.

    A span's log odds are the sum of the weights of its features' values; at -1, the weight of the kind itself.
    """
    each = labelled.select("kind", "n", "posterior", F.posexplode(F.split("features", ",")).alias("at", "value"))
    yes, no = F.sum(F.col("n") * F.col("posterior")), F.sum(F.col("n") * (1 - F.col("posterior")))
    whole = labelled.groupBy("kind").agg(yes.alias("all_yes"), no.alias("all_no"))
    tables = each.groupBy("kind", "at", "value").agg(yes.alias("yes"), no.alias("no")).join(whole, "kind")
    weight = F.log((F.col("yes") + 1) / (F.col("all_yes") + 3)) - F.log((F.col("no") + 1) / (F.col("all_no") + 3))
    own = whole.select("kind", F.lit(-1).alias("at"), F.lit("").alias("value"), F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("weight"))
    return tables.select("kind", "at", "value", weight.alias("weight")).unionByName(own)


Model = dict[int, dict[str, float]]


def fit(found: DataFrame) -> Model:
    """Weights by feature, and by kind and value, learned from candidates; one number for each value of a feature of a kind is gathered."""
    patterns = found.select(F.explode(F.concat("base", "more")).alias("c")).groupBy("c.kind", "c.features").agg(F.count("*").alias("n"))
    model: Model = {}
    for r in span_classifier(materialize(estimate(materialize(patterns, "pii_patterns")), "pii_posteriors")).orderBy("at", "kind", "value").collect():
        model.setdefault(r["at"], {})[f"{r['kind']}:{r['value']}"] = r["weight"]
    return model


def log_odds(model: Model, kind: Column, features: Column) -> Column:
    def weight(at: int, value: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in model[at].items() for x in pair])
        return F.coalesce(known[F.concat(kind, F.lit(":"), value)], F.lit(0.0))

    def total(values: Column) -> Column:
        out = weight(-1, F.lit(""))
        for at in sorted(model):
            out = out + weight(at, F.get(values, F.lit(at))) if at >= 0 else out
        return out

    return _let(F.split(features, ","), total)


def decide(found: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """candidates -> (doc_id, base, added): arrays of (kind, start, end); added spans score threshold or more."""
    least = math.log(threshold / (1 - threshold))
    added = F.filter("more", lambda m: log_odds(model, m["kind"], m["features"]) >= least) if model else F.slice("more", 1, 0)
    bare = lambda s: F.transform(s, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select("doc_id", bare(F.col("base")).alias("base"), bare(added).alias("added"))


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, base, added); the model is learned from the same documents."""
    found = materialize(candidates(docs), "pii_candidates")
    return decide(found, fit(found), threshold)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_* and base_sha256 are of the base spans, spans lists the base and added ones."""
    out = find_personal_data(table(spark, sf_dir, "documents"))
    order = [*KINDS, *[k for k in LOOSE if k not in KINDS]]
    both = F.concat("base", "added")
    ranked = F.flatten(F.array(*[F.array_sort(_of_kind(both, k)) for k in order]))
    return out.select(
        "doc_id", *[F.size(_of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(ranked).alias("spans"),
    )


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)
