"""Exact and approximate search over blocks and cells; takes and appends that read few files."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from accrete import FeatureTable, feature
from accrete.operators import keys, lookup, search
from accrete.operators import table as tables


def vectors(spark, points, key="id", kind="float"):
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, f"{key} bigint, v array<{kind}>")


def brute(points, asked, k):
    x = points.astype(np.float32).astype(float)
    out = {}
    for q in asked:
        gap = ((x - x[q]) ** 2).sum(axis=1)
        out[q] = np.lexsort((np.arange(len(x)), gap))[:k].tolist()
    return out


def answers(found):
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.neighbour_id)
    return got


SPREADS = {
    "scattered": lambda rng: rng.normal(size=(900, 8)),
    "flat": lambda rng: rng.random((1500, 2)),
    "copies": lambda rng: np.repeat(rng.normal(size=(12, 4)), 100, axis=0),
    "one cell": lambda rng: np.concatenate([np.zeros((500, 3)), rng.normal(size=(400, 3))]),
}


@pytest.mark.parametrize("spread", list(SPREADS))
def test_search_of_blocks_is_exact_with_few_partial_rows(spark, monkeypatch, spread):
    monkeypatch.setattr(search, "PACKED_ROWS", 64)
    monkeypatch.setattr(search, "VISITS", 4)
    monkeypatch.setattr(search, "MOST_PARTS", 3)
    points = SPREADS[spread](np.random.default_rng(4))
    df = vectors(spark, points)
    asked, stored = df.select(F.col("id").alias("query_id"), F.col("v").alias("query_vec")), df.select(
        F.col("id").alias("neighbour_id"), F.col("v").alias("vector"))
    partial = search.nearest_partials(asked, stored, 5).persist()
    # Carried gaps: no run lets out more than its best, however many blocks it takes in.
    assert partial.count() <= search.SLICES * len(points) * 5
    found = search._final(partial, 5, True)
    assert answers(found) == brute(points, range(len(points)), 5)
    partial.unpersist()


def test_copies_of_corpus_blocks_do_not_grow_with_the_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "PACKED_ROWS", 16)
    monkeypatch.setattr(search, "CROWDS", 3, raising=False)
    laid, runs = [], search._runs
    monkeypatch.setattr(search, "_runs", lambda rows, *more: laid.append(rows) or runs(rows, *more))
    points = SPREADS["scattered"](np.random.default_rng(9))
    df = vectors(spark, points)
    found = search.nearest_each(df, df, "id", "v", "id", "v", 5, squared=True, limit_bytes=0)
    assert answers(found) == brute(points, range(len(points)), 5)
    sent = [len(r["ids"]) for r in laid[0].where("ids is not null").collect()]
    assert sum(sent) <= 3 * len(points) and len(sent) > len(points) // 16
    # Crowds are as many as their vectors ask for, if that is more; the answers stay.
    monkeypatch.setattr(search, "CROWD_BYTES", 4096, raising=False)
    found = search.nearest_each(df, df, "id", "v", "id", "v", 5, squared=True, limit_bytes=0)
    assert answers(found) == brute(points, range(len(points)), 5)


def test_pivots_find_near_points():
    rng = np.random.default_rng(1)
    points = search.Pivots(rng.normal(size=(400, 6)))
    rows = rng.normal(size=(300, 6))
    cell, reach = points.nearest(rows)
    exact = np.sqrt(((rows[:, None] - points.points[None]) ** 2).sum(axis=2))
    assert np.allclose(reach, exact[np.arange(300), cell]) and (reach <= exact.min(axis=1) + 1e-9).mean() > 0.5
    gap, off = points.distances(rows)
    assert (np.abs(gap - exact) <= off + 1e-12).all()


def test_cells_are_a_stored_column_with_measured_recall(spark, tmp_path):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(40, 8))[rng.integers(0, 40, 1200)] + rng.normal(scale=0.25, size=(1200, 8))
    df = vectors(spark, points).unionByName(spark.createDataFrame([(5000, None)], "id bigint, v array<float>"))
    first = df.where("id % 2 = 0")
    centres = search.learn_cells(first, "id", "v", 24, rounds=4)
    cell = search.cell_feature(centres, "v")
    table = FeatureTable.create(spark, str(tmp_path / "t"), first, buckets=3).backfill(cell)
    table = table.append(df.where("id % 2 = 1")).backfill(cell)
    assert table.is_complete("cell") and table.select("id", "cell").where("cell is null").first().id == 5000
    rows, asked = table.to_df(), df.where("id % 20 = 0 and v is not null")
    found = {p: search.nearest_in_cells(asked, rows, centres, "id", "v", "id", "v", probes=p, squared=True) for p in (1, 6, 24)}
    exact = search.nearest_each(asked, df, "id", "v", "id", "v", 5)
    measured = {p: search.recall(f, exact).first() for p, f in found.items()}
    assert measured[24].recall == 1.0 and measured[6].recall >= 0.9 and measured[1].recall <= measured[6].recall
    assert measured[6].wanted == asked.count() * 5
    # Asking all cells gives the exact answer, and large query sets give what small ones do.
    assert answers(found[24]) == brute(points, range(0, 1200, 20), 5)
    packed = search.nearest_in_cells(asked, rows, centres, "id", "v", "id", "v", probes=6, squared=True, limit_bytes=0)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, found[6].collect()))
    # Other centres are another version of the column.
    assert search.cell_feature(centres + 1, "v").fingerprint() != cell.fingerprint()


def test_cells_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, v array<float>, cell int")
    some = spark.createDataFrame([(1, [1.0, 2.0], 0)], "id bigint, v array<float>, cell int")
    centres = np.zeros((1, 2))
    for limit in (0, 1 << 20):
        assert search.nearest_in_cells(none, some, centres, "id", "v", "id", "v", probes=1, limit_bytes=limit).count() == 0
        assert search.nearest_in_cells(some, none, centres, "id", "v", "id", "v", probes=1, limit_bytes=limit).count() == 0


# ---- takes and appends ---------------------------------------------------------------------------


@feature("bigint", ["n"], kind="column")
def tripled(n):
    return n * 3


def wide(spark, start, stop):
    return spark.range(start, stop).select("id", (F.col("id") * 7 % 1000).alias("n"), F.lit("x" * 20).alias("w"))


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """Two bucketed parts of small files and loose increments."""
    place = str(tmp_path_factory.mktemp("takes") / "t")
    table = FeatureTable.create(spark, place, wide(spark, 0, 40_000), buckets=4, file_rows=500)
    table = table.append(wide(spark, 40_000, 60_000), bucketed=True)
    for low in range(60_000, 60_300, 100):
        table = table.append(wide(spark, low, low + 100))
    return table.backfill(tripled)


def test_take_opens_only_files_around_the_ids(spark, grown):
    ids = [777, 59_999, 60_150, 3, 777, 10**9, -5]
    got = grown.take(ids, ["id", "w", "tripled"])
    assert [(r.id, r.tripled) for r in got.collect()] == [(i, i * 7 % 1000 * 3) for i in (777, 59_999, 60_150, 3, 777)]
    everything = len(grown.select("id", "w", "tripled").inputFiles())
    # Five keys, a raw and a feature file for each.
    assert len(got.inputFiles()) <= 10 < everything // 20
    rng = np.random.default_rng(2)
    some = rng.choice(60_300, 50, replace=False).tolist()
    got = grown.take(some, ["n"])
    assert [r.n for r in got.collect()] == [i * 7 % 1000 for i in some] and len(got.inputFiles()) <= 50
    assert grown.take([10**9], ["n"]).collect() == [] and grown.take([], ["n"]).collect() == []


def test_long_takes_are_joined(spark, grown, plan, monkeypatch):
    ids = np.random.default_rng(3).integers(0, 60_300, lookup.SHORT_LIST + 1).tolist()
    got = grown.take(ids, ["n"])
    text = plan(got)
    assert "SinglePartition" not in text and "RoundRobinPartitioning(1)" not in text and "rangepartitioning(_pos" in text
    assert [r.n for r in got.collect()] == [i * 7 % 1000 for i in ids]
    frame = spark.createDataFrame([(0, 5), (1, 60_001), (2, 5)], "_pos bigint, id bigint")
    assert [r.n for r in grown.take(frame, ["n"]).collect()] == [35, 60_001 * 7 % 1000, 35]
    plain = lookup.take_rows(wide(spark, 0, 100), list(range(99, -1, -1)) * 101, "id", ["id"])
    assert "rangepartitioning(_pos" in plan(plain) and [r.id for r in plain.limit(3).collect()] == [99, 98, 97]


def test_small_appends_read_only_parts_that_may_hold_a_key(spark, grown, monkeypatch):
    opened = []
    near = FeatureTable._scan_near

    def watched(self, folder, schema, layout, parts, ids):
        found = near(self, folder, schema, layout, parts, ids)
        opened.extend(found.inputFiles())
        return found

    monkeypatch.setattr(FeatureTable, "_scan_near", watched)
    monkeypatch.setattr(FeatureTable, "_keys", lambda self: pytest.fail("all keys were read"))
    more = grown.append(wide(spark, 70_000, 70_010))
    # A few of ten new keys may pass the bits of a part by chance, none is in a file's range.
    assert opened == [] and more.count_rows() == grown.count_rows() + 10
    with pytest.raises(ValueError, match="repeated: 60150"):
        more.append(wide(spark, 60_150, 60_151).unionByName(wide(spark, 80_000, 80_005)))
    assert len(set(opened)) == 1
    opened.clear()
    skipped = more.append(wide(spark, 39_995, 40_005).unionByName(wide(spark, 90_000, 90_002)), on_repeat="skip")
    assert skipped.count_rows() == more.count_rows() + 2 and 0 < len(set(opened)) <= 20
    with pytest.raises(ValueError, match="null or repeated"):
        skipped.append(wide(spark, 95_000, 95_001).withColumn("id", F.lit(None).cast("bigint")))


def test_large_appends_are_compared_with_all_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FEW_KEYS", 5)
    table = FeatureTable.create(spark, str(tmp_path / "t"), wide(spark, 0, 50), buckets=2)
    with pytest.raises(ValueError, match="repeated"):
        table.append(wide(spark, 45, 60))
    assert table.append(wide(spark, 45, 60), on_repeat="skip").count_rows() == 60


def test_string_keys(spark, tmp_path):
    rows = spark.range(300).select(F.format_string("k%05d", "id").alias("name"), "id")
    table = FeatureTable.create(spark, str(tmp_path / "t"), rows, key="name", buckets=3, file_rows=20)
    got = table.take(["k00007", "nothing", "k00250"], ["id"])
    assert [r.id for r in got.collect()] == [7, 250] and len(got.inputFiles()) <= 3
    with pytest.raises(ValueError, match="k00007"):
        table.append(rows.where("id = 7"))


def test_tables_without_key_files_are_still_read(spark, tmp_path):
    table = FeatureTable.create(spark, str(tmp_path / "t"), wide(spark, 0, 50), buckets=2).backfill(tripled)
    for part in table.manifest["parts"]:
        del part["indexed"]
    for chunk in table.features["tripled"]["chunks"]:
        del chunk["indexed"]
    assert [r.tripled for r in table.take([9, 3], ["tripled"]).collect()] == [27 * 7, 9 * 7]
    known = table._suspected(wide(spark, 48, 60))
    assert sorted(r.id for r in known.collect()) == [48, 49]


def test_bits_hold_all_keys_and_few_others(spark):
    rows = spark.range(5000)
    bits = keys.key_bits(rows, "id", 5000).withColumn("part", F.lit("p"))
    asked = keys.hashed_keys(spark.range(4000, 9000), "id", 10_000)
    found = keys.suspects(bits, asked).toArrow()["at"].to_pylist()
    ids = {asked["key"][i].as_py() for i in found}
    assert set(range(4000, 5000)) <= ids and len(ids) - 1000 < 100
    assert keys.hashed_keys(rows, "id", 10) is None
    assert keys.key_bits(rows.limit(0), "id", 0).count() == 0


def test_files_that_hold_ids():
    files, least, greatest = np.array(list("abcd")), np.array([0, 10, 0, 10]), np.array([9, 19, 9, 19])
    buckets, ids = np.array([0, 0, 1, 1]), np.array([3, 12, 25])
    assert keys.holding_files(files, least, greatest, ids).tolist() == list("abcd")
    assert keys.holding_files(files, least, greatest, ids, buckets, np.array([0, 1, 1])).tolist() == ["a", "d"]
    assert isinstance(pa.array(files), pa.Array)
