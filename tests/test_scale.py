"""What keeps the registry queries in bounds on large tables."""

import pytest
from pyspark.sql import functions as F

from tamiz.functions.folding import fold, fold_character, fold_tables
from tamiz.functions.text import BLANKS, trimmed
from tamiz.plans import cleaning as C
from tamiz.workload import queries
from tamiz.workload.messy import METHOD_LIMIT, TASKS_PER_SPLIT, messy


def test_tasks_of_the_view_follow_the_splits_and_are_alike(spark, tmp_path):
    # One file holds nearly all rows, as the splits of a table with few row groups do.
    folder = f"{tmp_path}/orders.parquet"
    for i in range(16):
        rows = 20_000 if i == 0 else 10
        spark.range(i * 100_000, i * 100_000 + rows).toDF("o_orderkey").coalesce(1).write.mode("append").parquet(folder)
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)  # a split for every file
    try:
        view = messy(spark, str(tmp_path))
        sizes = view.select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sizes.sum() == 20_150 and sizes.max() < 300
    assert view.rdd.getNumPartitions() == 16 * TASKS_PER_SPLIT


def test_methods_stay_short_unless_the_session_says_otherwise(spark, small_dir):
    spark.conf.unset(METHOD_LIMIT)
    try:
        messy(spark, small_dir)
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        spark.conf.set(METHOD_LIMIT, "60000")
        messy(spark, small_dir)
        assert spark.conf.get(METHOD_LIMIT) == "60000"
    finally:
        spark.conf.unset(METHOD_LIMIT)


def test_trimmed_looks_up_only_odd_ends(spark):
    texts = ["", " ", "a", " a", "a ", "~", "\x7fa", "á", "　x　", "x\x1c", "\x85x", "a​", "é a\xa0", None]
    texts += [f"{b}a b{b}" for b in BLANKS]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in rows.select(trimmed(F.col("t")).alias("x")).collect()]
    assert got == [(t or "").strip(BLANKS) for t in texts]
    plan = rows.select(trimmed(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan


def test_every_folded_character_alone_and_beside_a_usual_one(spark):
    chars = [*fold_tables().source, *fold_tables().expansions]
    texts = [t for c in chars for t in (c, f"á{c}")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in rows.select(fold(F.col("t")).alias("x")).collect()]
    assert got == ["".join(map(fold_character, t)) for t in texts]


def test_log_from_marks_equals_log_from_the_rules(spark, messy):
    marked = C.limpiar_datos(messy, marks=True)
    assert [*C.limpiar_datos(messy).columns] == [c for c in marked.columns if not c.startswith("_cambio")]
    log = C.registro_transformaciones(messy)
    assert C.registro_transformaciones(messy, marked).collect() == log.collect()


@pytest.mark.parametrize("name", ["violations", "validate_raw", "before_after"])
def test_orders_are_read_once(spark, small_dir, name):
    """All checks scan what was written; before, every one of them made the view again."""
    files = queries.QUERIES[name](spark, small_dir).inputFiles()
    assert files and not [f for f in files if f.endswith("orders.parquet")]
