"""Tables built from text are joined by shuffles, and their texts are read behind
the repartition: Catalyst takes them for smaller than they are."""

from pyspark.sql import functions as F

from codefacts.operators import linking as L
from codefacts.plans import corpus_client, link_checks
from conftest import SMOKE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_growing_tables_are_not_collected_by_the_driver(spark):
    text = plan(link_checks.call_reqs(spark, SMOKE))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_texts_are_read_behind_the_repartition(spark):
    found = corpus_client.component_files(spark, SMOKE).where(F.length("content") > 10)
    # a filter in the scan's tasks would stand below an exchange
    assert "Exchange" not in plan(found) and found.rdd.getNumPartitions() == 8
    assert found.count() == spark.read.parquet(f"{SMOKE}/part.parquet").count()


def test_behaviors_read_the_texts_once(spark):
    text = plan(L.behaviors(link_checks.components(spark, SMOKE)))
    assert "regexp_extract" not in text
