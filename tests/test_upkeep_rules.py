"""Rules that keep results right over time: fingerprints, keys, chunks, models, takes, scores."""

import os
import re
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from accrete.operators import batches, evaluate, lookup, neardup
from accrete.operators.feature import COLUMN, MODEL, feature
from accrete.operators.table import FeatureTable

PATTERN = re.compile("a+")


def helper(x):
    return x + 1


class Scale:
    factor = 2

    def __call__(self, x):
        return x * self.factor


def of(code, **options):
    return feature("int", ["x"], name="f", **options)(code).fingerprint()


def test_fingerprint_sees_captured_values_defaults_and_constants():
    def make(n):
        return lambda x: x[:n]

    assert of(make(1)) == of(make(1)) != of(make(3))
    assert of(lambda x, k=1: x + k) != of(lambda x, k=2: x + k)
    assert of(lambda x: x + 1) != of(lambda x: x + 2)
    assert of(make(np.arange(3))) != of(make(np.arange(4)))


def test_fingerprint_sees_helpers_and_class_members(monkeypatch):
    calls = lambda x: helper(x)
    before, scaled = of(calls), of(Scale, kind=MODEL)
    monkeypatch.setitem(globals(), "helper", lambda x: x + 2)
    monkeypatch.setattr(Scale, "factor", 3)
    assert of(calls) != before and of(Scale, kind=MODEL) != scaled
    pattern = lambda x: bool(PATTERN.match(x))
    before = of(pattern)
    monkeypatch.setitem(globals(), "PATTERN", re.compile("b+"))
    assert of(pattern) != before


def test_fingerprint_refuses_what_it_cannot_tell_apart():
    handle = object()
    with pytest.raises(TypeError):
        of(lambda x: handle)
    assert of(lambda x: handle, version="1") != of(lambda x: handle, version="2")


def test_truths_without_a_prediction_score_zero(spark):
    truths = spark.createDataFrame([(i, ["yes"] * 10) for i in range(4)], "id long, answers array<string>")
    said = spark.createDataFrame([(2, "Yes."), (9, "no truth")], "id long, prediction string")
    summary = evaluate.accuracy(evaluate.scored(truths, said, said.limit(0), "id")).first()
    assert (summary["rows"], summary["base_accuracy"], summary["tuned_accuracy"]) == (4, 0.25, 0.0)
    with pytest.raises(Exception, match="more than one base prediction for 2"):
        evaluate.scored(truths, said.union(said), said, "id").collect()


def numbers(spark, low, high, files=4):
    return spark.range(low, high, 1, files).select(F.col("id"), (F.col("id") * 2).alias("x"))


def test_keys_stay_unique_and_not_null(spark, tmp_path):
    table = FeatureTable.create(spark, str(tmp_path / "t"), numbers(spark, 0, 20), buckets=2)
    for bad in (numbers(spark, 19, 25), numbers(spark, 30, 33).union(numbers(spark, 30, 31)),
                spark.createDataFrame([(None, 1)], "id long, x long")):
        with pytest.raises(ValueError, match="null or repeated"):
            table.append(bad)
    table = table.append(numbers(spark, 10, 30), on_repeat="skip").append(numbers(spark, 0, 30), bucketed=True, on_repeat="skip")
    assert table.count_rows() == 30 == table.to_df().select("id").distinct().count()


def test_dependent_features_go_in_chunks(spark, tmp_path):
    first = feature("long", ["x"], kind=COLUMN, name="first")(lambda x: x + 1)
    second = feature("long", ["x", "first"], kind=COLUMN, name="second")(lambda x, y: x + y)
    table = FeatureTable.create(spark, str(tmp_path / "t"), numbers(spark, 0, 1000), buckets=8).backfill(first)
    table = table.backfill(second, checkpoint_size=250, max_chunks=1)
    done = table.select("second").where("second is not null").count()
    assert 0 < done < 500
    table = table.backfill(second, checkpoint_size=250)
    assert len(table.features["second"]["chunks"]) == 4 and table.is_complete("second")
    assert table.select("id", "second").where("second = id * 4 + 1").count() == 1000


def test_a_model_is_made_once_per_worker(spark, tmp_path):
    place = str(tmp_path / "loads")
    os.makedirs(place)

    class Loaded:
        def __init__(self):
            open(f"{place}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def batch(self, rows):
            return pa.array([x + 1 for x in rows.column("x").to_pylist()])

    loaded = feature("long", ["x"], kind=MODEL, name="y")(Loaded)
    made = loaded.apply(numbers(spark, 0, 2000, 40), "id")
    assert made.where("y = id * 2 + 1").count() == 2000
    loads = os.listdir(place)
    assert 0 < len(loads) == len({name.split("-")[0] for name in loads})


def test_a_take_reads_little_of_a_sorted_table(spark, tmp_path):
    path = str(tmp_path / "sorted")
    numbers(spark, 0, 400_000, 4).write.option("parquet.block.row.count.limit", 200).parquet(path)
    ids = [int(i) for i in np.random.default_rng(0).integers(0, 400_000, 160)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        taken = lookup.take_rows(spark.read.parquet(path), ids, "id", ["id", "x"])
        assert [r["id"] for r in taken.collect()] == ids
        leaves = taken._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        scans = [leaf for leaf in found if "Scan parquet" in leaf.nodeName()]
        assert len(scans) == 1 and scans[0].metrics().apply("numOutputRows").value() < 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_table_take_keeps_order_and_repeats(spark, tmp_path):
    first = feature("long", ["x"], kind=COLUMN, name="first")(lambda x: x + 1)
    table = FeatureTable.create(spark, str(tmp_path / "t"), numbers(spark, 0, 100), buckets=4).backfill(first)
    assert [tuple(r) for r in table.take([7, 3, 7, 500], ["first", "id"]).collect()] == [(15, 7), (7, 3), (15, 7)]
    assert table.read_columns(["id"], limit=10**12).count() == 100


def test_rows_without_a_hash_repeat_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, None)], "id long, dhash long")
    assert [tuple(r) for r in neardup.duplicate_groups(df, "id").collect()] == [(5, 2, 1)]
    assert sorted(tuple(r) for r in neardup.duplicate_members(df, "id").select("id", "representative", "group_rows").collect()) == [
        (1, 1, 2), (2, 1, 2), (3, None, None), (4, None, None)]
    assert tuple(neardup.duplicate_summary(df).first()) == (1, 4, 1)


def test_schedule_without_a_last_step(spark):
    ordered = batches.micro_batches(batches.epoch_order(numbers(spark, 0, 21), "id", 3), 2)
    steps = [r["step"] for r in batches.accumulation_schedule(ordered, 21, 2, 3, 4).collect()]
    assert max(s for s in steps if s) == 33 // 4 and steps.count(None) == 1
