"""Every registered query against its SQL in an independent engine, on whole tables."""

import pytest

import __spark_entry__ as contract
import check
from accrete.plans.oracle import ORACLE
from accrete.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return check.engine(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, engine, name):
    assert check.compare(spark, engine, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["question_type", "count"] and df.count() == 10


def test_results_do_not_depend_on_partitioning(spark, engine):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("micro_batches", "text_dense_quarter", "dup_members", "packed_tokens_joined", "row_index",
                     "knn_batch_blocks", "hamming_pairs_crowded", "median_profile", "collated_batches"):
            assert check.compare(spark, engine, FOLDER, name) is None
    finally:
        for key in ("shuffle.partitions", "adaptive.enabled", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
