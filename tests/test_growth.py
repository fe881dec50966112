"""Epochs in two levels, splits by groups, streams of near duplicates, part summaries, task sizes."""

import re

import numpy as np
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from accrete import FeatureTable, feature
from accrete.operators import batches, curate, summaries
from accrete.operators.summaries import Profile
from accrete.streaming import upkeep


# ---- two-level epochs ----------------------------------------------------------------------------


def training(spark, start, stop):
    ids = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.col("id") * 10 + i).cast("int"))
    wide = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: (F.col("id") + i).cast("float"))
    return spark.range(start, stop).select(
        "id", wide.alias("vision_tower_hiddens"), ids.alias("input_ids"), ids.alias("attention_mask"), ids.alias("labels"))


def test_windowed_batches_move_no_wide_column(spark, tmp_path, plan):
    table = FeatureTable.create(spark, str(tmp_path / "t"), training(spark, 0, 500), buckets=5)
    made = batches.windowed_batches(table, 8, seed=3, epochs=2, tokens=2, width=4, text_tokens=4)
    made.collect()
    told = made._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = re.findall(r"\) (?:Exchange|BroadcastExchange)\nInput \[\d+\]: \[(.*?)\]", told)
    assert exchanges and not any("vision" in e or "input_ids" in e for e in exchanges)


def test_windowed_batches_hold_each_row_once_an_epoch(spark, tmp_path):
    table = FeatureTable.create(spark, str(tmp_path / "t"), training(spark, 0, 500), buckets=5)
    table = table.append(training(spark, 500, 530)).append(training(spark, 530, 531))
    got = batches.windowed_batches(table, 8, seed=3, epochs=2, tokens=2, width=4, text_tokens=4).collect()
    orders = {}
    for epoch in (0, 1):
        mine = sorted((b.batch, [s.id for s in b.samples], [s["rank"] for s in b.samples]) for b in got if b.epoch == epoch)
        assert [n for n, _, _ in mine] == list(range(len(mine))) and all(len(ids) <= 8 for _, ids, _ in mine)
        assert [r for _, _, ranks in mine for r in ranks] == list(range(1, 532))
        orders[epoch] = [i for _, ids, _ in mine for i in ids]
        assert sorted(orders[epoch]) == list(range(531))
        # Few short batches: the last of a bucket.
        assert sum(len(ids) < 8 for _, ids, _ in mine) <= 10
    assert orders[0] != orders[1]
    sample = next(s for b in got for s in b.samples if s.id == 17)
    assert sample.vision == [[17.0, 18.0, 19.0, 20.0], [21.0, 22.0, 23.0, 24.0]] and sample.labels == [170, 171, 172, 173]
    again = batches.windowed_batches(table, 8, seed=3, epochs=2, tokens=2, width=4, text_tokens=4).collect()
    assert sorted((b.epoch, b.batch, str(b.samples)) for b in again) == sorted((b.epoch, b.batch, str(b.samples)) for b in got)


# ---- splits by groups ----------------------------------------------------------------------------


def test_no_close_pair_is_split(spark):
    rng = np.random.default_rng(9)
    centres = rng.integers(-(2**63), 2**63, 60)
    hashes = [int(c) ^ int(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 3), replace=False))) for c in centres for _ in range(6)]
    hashes += [int(centres[0])] * 120  # a third of all rows is one picture
    rows = [(i, h) for i, h in enumerate(hashes)] + [(10_000 + i, None) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, dhash bigint").withColumn("grp", F.lit("kept"))
    got = curate.holdout_by_group(df, "id", 400).collect()
    assert sorted(r.id for r in got) == [i for i, _ in rows] and all(r.grp == "kept" for r in got)
    side = {r.id: r.split for r in got}
    bits = np.array([h & (2**64 - 1) for h in hashes], np.uint64)
    for i in range(len(hashes)):
        near = np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 3)
        assert {side[int(j)] for j in near} == {side[i]}
    assert len(set(side.values())) == 2 and len({side[10_000 + i] for i in range(40)}) == 2
    nothing = curate.holdout_by_group(df.limit(0), "id", 400)
    assert nothing.count() == 0 and nothing.columns == ["id", "dhash", "grp", "split"]


# ---- near duplicates on a stream -------------------------------------------------------------------


def arrivals(landings, distance):
    seen, kept = [], set()
    for rows in landings:
        for key, value in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
            if not any(bin((value ^ s) & (2**64 - 1)).count("1") <= distance for s in seen):
                kept.add(key)
            seen.append(value)
        kept.update(k for k, v in rows if v is None)
    return kept


@pytest.mark.parametrize("limit_bytes", [1 << 26, 0])
def test_stream_of_near_duplicates_equals_order_of_arrival(spark, tmp_path, monkeypatch, limit_bytes):
    monkeypatch.setattr(upkeep._repeating, "__defaults__", (limit_bytes,))
    monkeypatch.setattr(upkeep, "COMPARED", 64)
    rng = np.random.default_rng(11)
    centres = rng.integers(-(2**63), 2**63, 25)
    landings, key = [], 0
    for _ in range(3):
        rows = []
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 4), replace=False)
            value = int(rng.choice(centres)) & (2**64 - 1)
            for b in flips:
                value ^= 1 << int(b)
            rows.append((key, None if key % 31 == 0 else value - (1 << 64) if value >> 63 else value))
            key += 1
        landings.append(rows)
    landing, place, progress = (str(tmp_path / n) for n in ("landing", "near", "progress"))
    schema = spark.createDataFrame([], "id bigint, dhash bigint").schema

    def run():
        upkeep.first_of_near_hashes(spark, landing, schema, "id", place, progress).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(f"{place}/kept").collect())

    for i, rows in enumerate(landings):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(landing)
        assert run() == sorted(arrivals(landings[: i + 1], 3))
    # A micro-batch that is repeated after its progress was lost writes the same again.
    again = str(tmp_path / "again")
    upkeep.first_of_near_hashes(spark, landing, schema, "id", str(tmp_path / "once"), again).awaitTermination()
    once = sorted(r.id for r in spark.read.parquet(str(tmp_path / "once" / "kept")).collect())
    upkeep.first_of_near_hashes(spark, landing, schema, "id", str(tmp_path / "once"), str(tmp_path / "other")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "once" / "kept")).collect()) == once
    assert once == sorted(arrivals([[r for rows in landings for r in rows]], 3))


# ---- profile of a growing table --------------------------------------------------------------------


def measured(spark, start, stop):
    return spark.range(start, stop).select(
        "id", (F.col("id") * 37 % 101).alias("n"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("w"), F.col("id") % 4)).alias("w"),
        F.when(F.col("id") % 5 != 0, F.col("id") * 3).alias("wide"))


def test_profile_reads_new_parts_only(spark, tmp_path, monkeypatch):
    table = FeatureTable.create(spark, str(tmp_path / "t"), measured(spark, 0, 3000), buckets=3)
    read = []
    whole = FeatureTable.part_rows
    monkeypatch.setattr(FeatureTable, "part_rows", lambda self, part, columns: read.append(part) or whole(self, part, columns))
    Profile(table, ["n", "w"], ["wide"]).refresh()
    first = list(read)
    table = table.append(measured(spark, 3000, 4000)).append(measured(spark, 4000, 4500))
    known = Profile(table, ["n", "w"], ["wide"])
    counts = {r.value: r["count"] for r in known.value_counts("w").collect()}
    assert first == [table.manifest["parts"][0]["name"]] and read[1:] == [p["name"] for p in table.manifest["parts"][1:]]
    everything = measured(spark, 0, 4500).toPandas()
    assert counts == {(None if isinstance(k, float) else k): v for k, v in everything["w"].value_counts(dropna=False).items()} or \
        {k: v for k, v in counts.items() if k} == everything["w"].value_counts().to_dict()
    assert known.int_median("n").first().median == int(everything["n"].median())
    assert known.distinct_values("n").first().distinct_values == 101 and known.distinct_values("w").first().distinct_values == 4
    bins = {r.bin: r["count"] for r in known.clipped_histogram("n", 10, 8).collect()}
    assert bins == np.minimum(everything["n"] // 10, 8).value_counts().to_dict()
    about = known.distinct_values("wide").first()
    exact = everything["wide"].dropna()
    assert abs(about.distinct_values / len(exact) - 1) < 0.05 and about["rows"] == len(exact)
    middle = known.quantile("wide", 0.5).first()
    assert middle["column"] == "wide" and abs(middle["quantile"] / exact.median() - 1) < 0.05
    read.clear()
    assert Profile(table, ["n", "w"], ["wide"]).refresh() == [] and read == []
    with pytest.raises(KeyError):
        known.quantile("n", 0.5)
    with pytest.raises(KeyError):
        Profile(table, ["absent"])


def test_profile_of_an_empty_table(spark, tmp_path):
    table = FeatureTable.create(spark, str(tmp_path / "t"), measured(spark, 0, 0), buckets=2)
    known = Profile(table, ["n"], ["wide"])
    assert known.value_counts("n").count() == 0 and known.int_median("n").first().median is None
    assert known.distinct_values("n").first()["rows"] == 0
    assert summaries.summarised(measured(spark, 0, 5), [], ["wide"]).count() == 1


# ---- task sizes ------------------------------------------------------------------------------------


@feature("int", ["n"], name="task")
def task_number(n):
    return TaskContext.get().partitionId()


@pytest.mark.parametrize("bucketed", [True, False])
def test_task_sizes_come_from_scan_splits(spark, tmp_path, plan, bucketed):
    rows = measured(spark, 0, 12_000)
    table = FeatureTable.create(spark, str(tmp_path / "t"), rows if bucketed else rows.limit(0), buckets=3, group_rows=100)
    if not bucketed:
        table = table.append(rows.repartition(2))
    filled = table.add_columns([task_number])
    chunk = filled._open_chunks(task_number, filled.features["task"], None)[-1]
    assert "Exchange" not in plan(filled._rows_to_fill(task_number, chunk, 500))
    done = table.backfill(task_number, task_size=500)
    sizes = [r["count"] for r in done.select("task").groupBy("task").count().collect()]
    assert sum(sizes) == 12_000 and max(sizes) <= 1000 and len(sizes) >= 12
    assert done.is_complete("task") and done.select("id").count() == 12_000
