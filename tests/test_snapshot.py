import random

from pyspark.sql import functions as F

from docflow.operators import snapshot

SCHEMA = "id string, content_hash string, status string"


def state(n, seed=1):
    rng = random.Random(seed)
    return {f"pmid-{i}": (f"h{rng.randrange(1000)}", rng.choice(("approved", "pending"))) for i in range(n)}


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)


def changes(before, after):
    out = {}
    for k in {*before, *after}:
        a, b = before.get(k), after.get(k)
        out[k] = "new" if a is None else "removed" if b is None else "updated" if a[0] != b[0] else "moved" if a != b else "unchanged"
    return out


def test_diff_equals_a_full_comparison(spark, tmp_path):
    before = state(2000)
    after = dict(before)
    rng = random.Random(3)
    for k in rng.sample(sorted(before), 60):
        after[k] = rng.choice([("other", before[k][1]), (before[k][0], "rejected"), (None, None)])
    for k in rng.sample(sorted(before), 20):
        after.pop(k, None)
    after |= {f"pmid-{i}": ("x", "pending") for i in range(5000, 5020)}
    path = str(tmp_path / "s")
    snapshot.write_snapshot(frame(spark, before), path, 64)
    got = snapshot.diff(frame(spark, after), path).collect()
    assert {r["id"]: r["change"] for r in got} == changes(before, after) and len(got) == len({*before, *after})
    snapshot.write_snapshot(frame(spark, after), path, 64)
    assert {r["change"] for r in snapshot.diff(frame(spark, after), path).collect()} == {"unchanged"}


def test_only_changed_buckets_are_read(spark, tmp_path):
    before = state(3000)
    after = before | {k: ("other", "approved") for k in list(before)[:5]}
    path = str(tmp_path / "s")
    snapshot.write_snapshot(frame(spark, before), path, 256)
    rows = snapshot.keyed(frame(spark, after), 256)
    buckets = snapshot.changed_buckets(rows, spark.read.schema(snapshot.DIGESTS).parquet(f"{path}/digests").drop("buckets"))
    assert 1 <= len(buckets) <= 5
    everything = spark.read.parquet(f"{path}/rows")
    scanned = snapshot.read_buckets(spark, path, buckets)
    assert "PartitionFilters: [bucket" in scanned._jdf.queryExecution().executedPlan().toString() or "PartitionFilters" in scanned._jdf.queryExecution().toString()
    files = scanned.select(F.input_file_name()).distinct().count()
    assert files <= 5 and len(everything.inputFiles()) > 200
    assert snapshot.changed_buckets(snapshot.keyed(frame(spark, before), 256), spark.read.schema(snapshot.DIGESTS).parquet(f"{path}/digests").drop("buckets")) == []


def test_odd_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    empty = spark.createDataFrame([], SCHEMA)
    snapshot.write_snapshot(empty, path, 8)
    rows = spark.createDataFrame([("a", None, None), ("a", None, None), ("b", "2", "x"), ("b", "1", "y"), (None, "1", "x")], SCHEMA)
    assert {(r["id"], r["change"]) for r in snapshot.diff(rows, path).collect()} == {("a", "new"), ("b", "new")}
    snapshot.write_snapshot(rows, path, 8)
    assert {(r["id"], r["change"]) for r in snapshot.diff(empty, path).collect()} == {("a", "removed"), ("b", "removed")}
    assert {(r["id"], r["change"]) for r in snapshot.diff(rows, path).collect()} == {("a", "unchanged"), ("b", "unchanged")}
