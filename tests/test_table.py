import pathlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from accrete import FeatureTable, feature
from accrete.functions import images as pixels
from accrete.operators import batches
from accrete.operators.feature import in_dependency_order
from accrete.sources import files, images
from accrete.streaming.upkeep import first_of_each_hash, keep_features


def local(path):
    return pathlib.Path(path.removeprefix("file:"))


def data_files(root):
    return {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in pathlib.Path(root).rglob("*.parquet")}


@feature("bigint", ["n"], kind="column")
def doubled(n):
    return n * 2


@feature("string", ["n"])
def worded(n):
    return "n" + str(n)


@feature("string", ["worded", "doubled"], kind="column", tier=2)
def joined(a, b):
    return F.concat(a, F.lit(":"), b)


@feature("bigint", ["n"], kind="batch")
def summed(batch):
    import pyarrow.compute as pc

    return pa.RecordBatch.from_arrays([pc.add(batch.column("n"), 1)], names=["summed"])


def checked_numbers(fail_at):
    """Same source text, hence the same feature, whether or not it fails."""

    @feature("bigint", ["n"], name="checked")
    def code(n):
        if n == fail_at:
            raise RuntimeError("executor trouble")
        return n * 10

    return code


def counting_model():
    # A local class travels to the workers by value.
    class CountingModel:
        def __init__(self):
            self.calls = 0

        def __call__(self, n):
            self.calls += 1
            return [float(n), float(self.calls > 0), 0.1]

    return CountingModel


@pytest.fixture
def table(spark, tmp_path):
    return FeatureTable.create(spark, str(tmp_path / "t"), numbers(spark, 0, 200), buckets=4)


def numbers(spark, start, stop):
    return spark.range(start, stop).select("id", (F.col("id") * 3).alias("n"), F.lit("wide").alias("w"))


def values(table, *columns):
    return sorted(tuple(r) for r in table.select("id", *columns).collect())


def test_open_by_suffixed_name(spark, table):
    path = table.folder.root
    assert FeatureTable.open(spark, path + ".table").count_rows() == 200
    assert files.split_table_path("data/x.table") == ("data", "x") == files.split_table_path("data/x/")
    assert files.split_table_path("x.table") == (".", "x")
    with pytest.raises(FileNotFoundError):
        FeatureTable.open(spark, path + "-absent")


def test_create_guards_and_overwrite(spark, table):
    with pytest.raises(FileExistsError):
        FeatureTable.create(spark, table.folder.root, numbers(spark, 0, 3))
    table.backfill(doubled)
    again = FeatureTable.create(spark, table.folder.root, numbers(spark, 0, 3), mode="overwrite")
    assert again.count_rows() == 3 and again.columns == ["id", "n", "w"]
    assert table.as_of(1).count_rows() == 200 and table.as_of(1).to_df().count() == 200


def test_column_add_touches_no_existing_file(table):
    before = data_files(table.folder.root)
    done = table.backfill(doubled).backfill(worded)
    after = data_files(table.folder.root)
    assert {p: after[p] for p in before} == before and len(after) > len(before)
    assert values(done, "doubled", "worded") == [(i, i * 6, f"n{i * 3}") for i in range(200)]


def test_registered_column_reads_as_null(table):
    registered = table.add_columns({"doubled": doubled})
    assert registered.columns[-1] == "doubled" and {v for _, v in values(registered, "doubled")} == {None}
    assert registered.add_columns([doubled]).version == registered.version
    with pytest.raises(ValueError):
        table.add_columns([feature("int", ["n"], name="w")(lambda n: n)])


def test_columns_side_by_side_without_shuffle(spark, table, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = table.backfill(doubled, checkpoint_size=60).backfill(summed, task_size=30)
        text = plan(done.select("id", "w", "doubled", "summed"))
        assert text.count("SortMergeJoin") == 2 and "Exchange" not in text
        assert "ReadSchema: struct<id:bigint,w:string>" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_only_read_skips_raw_rows(table, plan):
    done = table.backfill(doubled).backfill(worded)
    text = plan(done.select("doubled"))
    assert "base-" not in text and "Join" not in text and "worded" not in text
    both = plan(done.select("id", "doubled", "worded"))
    assert "base-" not in both and both.count("FileScan") == 2
    # With rows the feature does not cover, the raw keys are needed to keep every row.
    assert "ReadSchema: struct<>" in plan(done.append(numbers(done.spark, 500, 510)).select("doubled"))


def test_append_then_backfill_only_the_new_rows(spark, table):
    first = table.backfill(doubled)
    grown = first.append(numbers(spark, 200, 260)).append(numbers(spark, 260, 400), bucketed=True)
    assert grown.count_rows() == 400
    assert sum(v is None for _, v in values(grown, "doubled")) == 200
    assert sorted(r.id for r in grown.missing_rows("doubled").collect()) == list(range(200, 400))
    before = data_files(table.folder.root)
    full = grown.backfill(doubled)
    assert {p: s for p, s in data_files(table.folder.root).items() if p in before} == before
    assert values(full, "n", "doubled") == [(i, i * 3, i * 6) for i in range(400)]
    assert full.missing_rows("doubled").count() == 0 and full.is_complete("doubled")
    assert values(first, "doubled") == [(i, i * 6) for i in range(200)]


@pytest.mark.parametrize("concurrency", [1, 3])
def test_failed_backfill_resumes(table, concurrency):
    with pytest.raises(PySparkException):
        table.backfill(checked_numbers(fail_at=300), checkpoint_size=50, concurrency=concurrency)
    left = table.latest()
    assert not left.is_complete("checked")
    kept = {i for i, v in values(left, "checked") if v is not None}
    assert 0 < len(kept) < 200 and 100 not in kept
    assert {r.id for r in left.missing_rows("checked").collect()} == set(range(200)) - kept
    before = data_files(table.folder.root)
    done = left.backfill(checked_numbers(fail_at=None), checkpoint_size=50)
    after = data_files(table.folder.root)
    assert {p: after[p] for p in before} == before
    assert values(done, "checked") == [(i, i * 30) for i in range(200)]


@pytest.mark.parametrize("chunks", [1, 2, 3])
def test_time_boxed_backfill_equals_one_run(table, chunks):
    table.backfill(worded, checkpoint_size=50, max_chunks=chunks)
    partial = table.latest()
    assert 0 < sum(v is not None for _, v in values(partial, "worded")) < 200
    assert values(partial.backfill(worded), "worded") == [(i, f"n{i * 3}") for i in range(200)]


def test_complete_feature_is_left_alone(table):
    done = table.backfill(doubled)
    before = data_files(table.folder.root)
    again = done.backfill(doubled)
    assert again.version == done.version and data_files(table.folder.root) == before


def test_new_code_is_a_new_column_version(table):
    first = table.backfill(doubled)
    changed = feature("bigint", ["n"], kind="column", name="doubled")(lambda n: n * 2 + 1)
    second = first.backfill(changed)
    assert values(second, "doubled") == [(i, i * 6 + 1) for i in range(200)]
    assert values(table.as_of(first.version), "doubled") == [(i, i * 6) for i in range(200)]
    dropped = second.drop_columns(["doubled"])
    assert dropped.columns == ["id", "n", "w"] and "doubled" in table.as_of(second.version).columns
    with pytest.raises(KeyError):
        dropped.drop_columns(["doubled"])
    assert values(dropped.backfill(doubled), "doubled") == [(i, i * 6) for i in range(200)]


def test_dependent_features(table):
    assert [f.name for f in in_dependency_order([joined, worded, doubled])] == ["worded", "doubled", "joined"]
    done = table.backfill_all([joined, doubled, worded])
    assert values(done, "joined") == [(i, f"n{i * 3}:{i * 6}") for i in range(200)]
    loop = [feature("int", ["b"], name="a")(len), feature("int", ["a"], name="b")(len)]
    with pytest.raises(ValueError, match="a -> b -> a"):
        in_dependency_order(loop)


def times(factor):
    return feature("bigint", ["n"], kind="column", name="base")(lambda n: n * factor)


@feature("bigint", ["base"], name="next")
def after_base(base):
    return None if base is None else base + 1


@feature("bigint", ["next", "doubled"], kind="column", name="last")
def after_next(following, d):
    return following * 1000 + d


def test_a_change_upstream_reaches_all_that_read_it(table):
    first = table.backfill_all([times(1), after_base, after_next, doubled, worded])
    assert values(first, "last") == [(i, (i * 3 + 1) * 1000 + i * 6) for i in range(200)] and first.stale == []
    changed = first.backfill(times(10))
    # Nothing made of the old inputs is read beside the new ones, and nothing else is touched.
    assert set(changed.stale) == {"next", "last"}
    assert {v for row in values(changed, "next", "last") for v in row[1:]} == {None}
    assert all(changed.features[n] == first.features[n] for n in ("doubled", "worded"))
    assert changed.missing_rows("next").count() == 200
    before = data_files(table.folder.root)
    done = changed.backfill_all([times(10), after_base, after_next, doubled, worded])
    assert values(done, "base", "next", "last") == [(i, i * 30, i * 30 + 1, (i * 30 + 1) * 1000 + i * 6) for i in range(200)]
    new = {p for p in data_files(table.folder.root) if p not in before}
    assert new and all("/features/next-" in str(p) or "/features/last-" in str(p) for p in new)
    assert done.stale == [] and values(table.as_of(first.version), "next") == [(i, i * 3 + 1) for i in range(200)]
    graph = {(r.feature, r.input): r for r in done.versions().collect()}
    assert graph["next", "base"].input_version == done.features["base"]["stamp"] and graph["base", "n"].input_version is None
    assert graph["next", "base"].version != {(r.feature, r.input): r for r in first.versions().collect()}["next", "base"].version


def test_the_order_of_a_change_does_not_matter(table):
    """The dependant listed first, one backfill after the other, or the input registered only: never old values."""
    table.backfill_all([times(1), after_base])
    table.latest().add_columns([times(5)])
    # The new input is not filled, so the dependant waits.
    waiting = table.latest().backfill(after_base)
    assert not waiting.is_complete("next") and {v for _, v in values(waiting, "next")} == {None}
    done = waiting.backfill_all([after_base, times(5)])
    assert values(done, "next") == [(i, i * 15 + 1) for i in range(200)]


def test_only_parts_with_filled_inputs_are_computed(spark, table):
    done = table.backfill_all([times(2), after_base])
    grown = done.append(numbers(spark, 200, 260))
    half = grown.backfill(after_base)
    assert sum(v is None for _, v in values(half, "next")) == 60 and half.stale == []
    before = data_files(table.folder.root)
    full = half.backfill_all([times(2), after_base])
    assert {p: s for p, s in data_files(table.folder.root).items() if p in before} == before
    assert values(full, "next") == [(i, i * 6 + 1) for i in range(260)]


def test_a_time_boxed_change_upstream_is_followed_later(table):
    table.backfill_all([times(1), after_base])
    table.latest().backfill(times(7), checkpoint_size=50, max_chunks=1)
    part = table.latest().backfill(after_base)
    assert {v for _, v in values(part, "next")} == {None}
    assert values(part.backfill_all([times(7), after_base]), "next") == [(i, i * 21 + 1) for i in range(200)]


def test_dropped_inputs_and_loops(table):
    done = table.backfill_all([times(1), after_base])
    left = done.drop_columns(["base"]).add_columns([doubled])
    assert values(left, "next") == [(i, i * 3 + 1) for i in range(200)]
    # The same input again: the values are still those made of it.
    assert left.add_columns([times(1)]).stale == [] and left.latest().add_columns([times(2)]).stale == ["next"]
    with pytest.raises(KeyError, match="nothing"):
        table.add_columns([feature("int", ["nothing"], name="x")(len)])
    with pytest.raises(ValueError, match="read each other"):
        table.add_columns([feature("bigint", ["next"], kind="column", name="base")(lambda n: n)])


def test_model_feature_and_lengths(table):
    made = feature("array<float>", ["n"], kind="model", name="vec", length=3, half=True, batch_size=7)(counting_model())
    got = dict(values(table.backfill(made, task_size=50), "vec"))
    assert got[5] == [15.0, 1.0, float(np.float16(0.1))]
    packed = feature("binary", ["n"], kind="model", name="vec16", length=3, half=True)(counting_model())
    assert np.frombuffer(dict(values(table.backfill(packed), "vec16"))[5], np.float16).tolist() == got[5]
    short = feature("array<float>", ["n"], kind="model", name="short", length=4)(counting_model())
    with pytest.raises(PySparkException, match="expected 4 values, got 3"):
        table.backfill(short)


def test_provenance_and_read_columns(table):
    done = table.backfill(doubled)
    rows = {r.column: (r.type, r.source, r.is_new) for r in done.provenance().collect()}
    assert rows == {
        "id": ("bigint", "raw data", False), "n": ("bigint", "raw data", False), "w": ("string", "raw data", False),
        "doubled": ("bigint", "tier 1 feature of n", True),
    }
    assert [r.doubled for r in table.read_columns(["doubled"], limit=3).collect()] == [0, 6, 12]
    assert table.read_columns(["doubled"], limit=1000).count() == 200
    with pytest.raises(KeyError):
        table.select("doubled")


def test_training_batches_of_full_width_packed_vectors(spark, tmp_path):
    """The real shape, 400 x 2048 half-precision values a row, kept packed from the model to the batch."""

    def wide_model():
        class Wide:
            def __call__(self, n):
                return np.full(400 * 2048, n, np.float32)

        return Wide

    ids = F.transform(F.sequence(F.lit(1), F.lit(512)), lambda i: i.cast("int"))
    rows = spark.range(6).select("id", ids.alias("input_ids"), ids.alias("attention_mask"), ids.alias("labels"))
    made = feature("binary", ["id"], kind="model", name="vision_tower_hiddens", length=819200, half=True, batch_size=2)(wide_model())
    table = FeatureTable.create(spark, str(tmp_path / "wide"), rows, buckets=2).backfill(made)
    got = batches.cached_batches(table, batch_size=4, seed=1).collect()
    assert sorted(len(b.samples) for b in got) == [2, 4]
    for batch in got:
        for s in batch.samples:
            vision = np.frombuffer(s.vision, np.float16).reshape(400, 2048)
            assert (vision == s.id).all() and len(s.labels) == 512
    with pytest.raises(PySparkException, match="expected 32 bytes"):
        batches.cached_batches(table, tokens=4, width=4).collect()


def test_stream_keeps_features(spark, tmp_path):
    rows = numbers(spark, 0, 120)
    root, landing, progress = (str(tmp_path / n) for n in ("table", "landing", "progress"))
    FeatureTable.create(spark, root, rows.limit(0), buckets=4)
    seen = []
    for start in (0, 50, 120):
        if start < 120:
            rows.where((F.col("id") >= start) & (F.col("id") < start + 70)).where(
                F.col("id") >= (0 if start == 0 else 70)).repartition(2).write.mode("append").parquet(landing)
        keep_features(spark, root, landing, rows.schema, [joined, doubled, worded], progress, files_per_batch=1).awaitTermination()
        table = FeatureTable.open(spark, root)
        seen.append(table.count_rows())
    assert seen == [70, 120, 120]
    assert values(table, "joined") == [(i, f"n{i * 3}:{i * 6}") for i in range(120)]
    # A repeated micro-batch adds nothing.
    assert table.append(rows, part="stream-000000000").version == table.version


def test_stream_dedup(spark, tmp_path):
    schema = "id bigint, dhash bigint, at timestamp"
    landing, progress, kept = (str(tmp_path / n) for n in ("in", "progress", "out"))
    for part in ([(1, 5), (2, 5), (3, 6)], [(4, 6), (5, 7)]):
        rows = [(i, h, None) for i, h in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = first_of_each_hash(spark.readStream.schema(schema).parquet(landing))
        (stream.writeStream.format("parquet").option("path", kept).option("checkpointLocation", progress)
         .trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.dhash for r in spark.read.parquet(kept).collect()) == [5, 6, 7]
    timed = first_of_each_hash(spark.readStream.schema(schema).parquet(landing), event_time="at", delay="1 hour")
    assert timed.isStreaming


def test_sidecar_and_mirror(spark, tmp_path):
    place = str(tmp_path / "side")
    assert files.read_sidecar(spark, place) == {}
    files.write_sidecar(spark, place, {"slice": "text_dense"})
    assert files.read_sidecar(spark, place) == {"slice": "text_dense"}
    with pytest.raises(FileExistsError):
        files.write_sidecar(spark, place, {})
    copy = files.mirror_columns(numbers(spark, 0, 50), ["id", "w"], str(tmp_path / "mirror"))
    assert copy.columns == ["id", "w"] and copy.count() == 50
    assert all("snappy" not in p.name for p in (tmp_path / "mirror").glob("*.parquet"))


def png(rgb):
    height, width, _ = rgb.shape
    raw = b"".join(b"\0" + rgb[y].tobytes() for y in range(height))

    def piece(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + piece(b"IHDR", head) + piece(b"IDAT", zlib.compress(raw)) + piece(b"IEND", b"")


def test_image_files_and_encoded_bytes_hash_alike(spark, tmp_path):
    rng = np.random.default_rng(2)
    shots = {f"{i}.png": rng.integers(0, 256, (20 + i, 31, 3)).astype(np.uint8) for i in range(3)}
    for name, rgb in shots.items():
        (tmp_path / name).write_bytes(png(rgb))
    (tmp_path / "broken.png").write_bytes(b"not an image")
    got = {r.origin.rsplit("/", 1)[1]: r.dhash for r in images.hash_decoded(images.read_images(spark, str(tmp_path))).collect()}
    ppm = {n: b"P6\n31 %d\n255\n" % rgb.shape[0] + rgb.tobytes() for n, rgb in shots.items()}
    rows = spark.createDataFrame([(n, b) for n, b in ppm.items()] + [("broken.png", None)], "name string, image binary")
    encoded = {r.name: r.dhash for r in images.hash_encoded(rows, "name", "image").collect()}
    assert got == encoded and got["broken.png"] == 0
    for name, rgb in shots.items():
        assert got[name] == pixels.hash_gray(pixels.luma(rgb[..., 0], rgb[..., 1], rgb[..., 2]))
