"""Golden cases of the ordered classifiers."""

from pyspark.sql import functions as F

from chronotally.functions import columns as C

BUILD = "Build exact candidate"
CASES = [
    ("failure", "Reject option files of outsiders", None, "policy"),
    ("failure", BUILD, ["✔ [7/9] Built Axiom (1.1s)", "LINT-ENV: FAIL - see above"], "lint-env"),
    ("failure", BUILD, ["+ tee --timed out", "error: the request timed out"], "timeout"),
    ("failure", BUILD, ["step 4 timed out", "sh: Killed"], "process-killed"),
    ("failure", BUILD, ["lake: no such file"], "lean-error"),
    ("failure", BUILD, ["Basic.lean:3:4: error: unknown id", "found a Duplicate declaration"], "audit-duplicates"),
    ("timed_out", BUILD, [], "timeout"),
    ("cancelled", BUILD, ["ERR_COP"], "cancelled"),
    ("failure", BUILD, None, "build-unknown"),
    ("failure", BUILD, [], "lean-error"),
    ("success", BUILD, [], None),
    (None, BUILD, [], None),
    ("failure", "Post setup", [], "infra-report"),
    ("failure", "a step of no kind", ["Axiom"], "other"),
]


def test_failure_classes(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, conclusion string, step string, lines array<string>, want string")
    got = df.select("i", C.failure_class(F.col("conclusion"), F.col("step"), F.col("lines")).alias("got")).orderBy("i").collect()
    assert [r["got"] for r in got] == [c[3] for c in CASES]


def test_runner_kinds(spark):
    rows = [(["nscloud-8x16", "self-hosted"], "namespace"), (["linux", "self-hosted"], "self-hosted"), (["ubuntu-24.04"], "github"), (["custom"], "self-hosted"), ([], "unknown"), (None, "unknown")]
    df = spark.createDataFrame(rows, "labels array<string>, want string")
    assert all(r["want"] == r["got"] for r in df.withColumn("got", C.runner_kind(F.col("labels"))).collect())
