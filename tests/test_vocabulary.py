import random
import time

from pyspark.sql import functions as F

from docflow import functions as fn
from docflow.config import default_config
from docflow.operators import vocabulary

MAPPING = default_config().mapping
WORDS = [*MAPPING.mesh_modality, *MAPPING.dialysis_mesh_terms, *(t for terms in MAPPING.topics.values() for t in terms), "other", "THIRST"]


def records(spark, n=300):
    rng = random.Random(2)
    rows = [(i, [rng.choice([*WORDS, None]) for _ in range(rng.randrange(5))]) for i in range(n)] + [(None, ["Diet"]), (n, None), (n + 1, [])]
    return spark.createDataFrame(rows, "id long, terms array<string>")


def test_equal_to_literals(spark):
    rows = records(spark)
    for found, literal in ((vocabulary.topics_of, fn.topics), (vocabulary.modalities_of, fn.modality)):
        want = {r["id"]: r["x"] for r in rows.select("id", literal(F.col("terms"), MAPPING).alias("x")).collect()}
        assert {r["id"]: r["labels"] for r in found(rows, "id", "terms", MAPPING).collect()} == want


def test_hundred_thousand_terms_and_many_labels(spark):
    labels = tuple(f"label {i}" for i in range(200))
    table = spark.range(100_000).select(F.concat(F.lit("Term "), F.col("id").cast("string")).alias("term"), F.concat(F.lit("label "), (F.col("id") % 211).cast("string")).alias("label"))
    rows = spark.createDataFrame([(0, ["term 5", "TERM 1204", "term 199", "term 63", "term 62", "nothing"]), (1, ["Term 205"])], "id long, terms array<string>")
    began = time.perf_counter()
    out = vocabulary.labels_of(rows, "id", "terms", vocabulary.of_table(table, labels))
    out._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 5
    got = {r["id"]: r["labels"] for r in out.collect()}
    assert got == {0: ["label 5", "label 62", "label 63", "label 149", "label 199"], 1: []}


def test_a_term_with_most_records(spark):
    rows = spark.range(5000).select("id", F.array(F.lit("Potassium"), F.when(F.col("id") % 2 == 0, "Diet")).alias("terms"))
    counts = vocabulary.topics_of(rows, "id", "terms", MAPPING).groupBy("labels").count().collect()
    assert {tuple(r["labels"]): r["count"] for r in counts} == {("potassium", "diet_general"): 2500, ("potassium",): 2500}
