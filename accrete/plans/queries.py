"""Registered queries: one or more per operator, each over whole tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrete.functions import hashing, scoring, text, vectors
from accrete.operators import batches, curate, evaluate, lookup, neardup, profile, readrate, search, tokens
from accrete.operators.feature import BATCH, COLUMN, MODEL, feature
from accrete.operators.summaries import Profile
from accrete.operators.table import FeatureTable
from accrete.plans import inputs
from accrete.plans.stand_in import OUTPUTS, ProjectionEmbedder
from accrete.session import new_dir
from accrete.sources import files, images
from accrete.streaming.upkeep import first_of_each_hash, first_of_near_hashes, keep_features

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# ---- features used below -----------------------------------------------------------------------


@feature("string", ["question"], kind=COLUMN)
def question_type(question):
    return text.question_type(question)


@feature("string", ["question"], kind=COLUMN, name="question_type")
def coarse_question_type(question):
    return text.profile_question_type(question)


@feature("int", ["question"])
def question_words(question):
    return len((question or "").split())


@feature("boolean", ["question_type", "question_words"], kind=COLUMN, tier=1)
def long_open_question(kind, words):
    return ~kind.isin("is_does", "other") & (words > 1)


@feature("int", ["question"], kind=BATCH, name="question_bytes")
def question_bytes(batch):
    import pyarrow.compute as pc

    return pa.RecordBatch.from_arrays([pc.binary_length(batch.column("question"))], names=["question_bytes"])


image_vector = feature("array<float>", ["embedding"], kind=MODEL, name="image_vector", length=OUTPUTS, half=True)(
    ProjectionEmbedder
)
packed_vector = feature("binary", ["embedding"], kind=MODEL, name="image_vector", length=OUTPUTS, half=True)(
    ProjectionEmbedder
)


def _question_table(spark: SparkSession, folder: str, label: str) -> FeatureTable:
    return FeatureTable.create(spark, new_dir(spark, label), inputs.questions(spark, folder))


# ---- feature tables ----------------------------------------------------------------------------


@query
def question_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = _question_table(spark, folder, "questions").backfill(question_type)
    return profile.value_counts(table.select("question_type"), "question_type")


@query
def feature_only_read(spark, folder):
    table = _question_table(spark, folder, "only").backfill(question_type)
    return table.select("question_type").groupBy("question_type").count()


@query
def stitched_columns(spark, folder):
    table = _question_table(spark, folder, "stitch").backfill_all([question_words, question_type])
    return table.select("id", "question", "question_type", "question_words")


@query
def batch_transform_feature(spark, folder):
    table = _question_table(spark, folder, "batch").backfill(question_bytes, task_size=2000)
    return table.select("id", "question_bytes")


@query
def dependent_features(spark, folder):
    table = _question_table(spark, folder, "depends").backfill_all([long_open_question, question_type, question_words])
    return table.select("id", "long_open_question")


@query
def resume_backfill(spark, folder):
    table = _question_table(spark, folder, "resume")
    size = max(1, table.count_rows() // 4)
    table.backfill(question_type, checkpoint_size=size, max_chunks=2)
    table = table.latest().backfill(question_type, checkpoint_size=size, concurrency=2)
    return profile.value_counts(table.select("question_type"), "question_type")


@query
def resume_dependent_backfill(spark, folder):
    table = _question_table(spark, folder, "redepend").backfill_all([question_type, question_words])
    size = max(1, table.count_rows() // 4)
    table.backfill(long_open_question, checkpoint_size=size, max_chunks=2)
    table = table.latest().backfill(long_open_question, checkpoint_size=size)
    return table.select("id", "long_open_question")


@query
def partial_coverage(spark, folder):
    table = _question_table(spark, folder, "partial").backfill(question_type)
    more = inputs.questions(spark, folder).select((-F.col("id") - 1).alias("id"), "question")
    table = table.append(more).add_columns([question_words])
    return profile.coverage(table.to_df(), ["id", "question", "question_type", "question_words"])


@query
def rows_left_to_fill(spark, folder):
    table = _question_table(spark, folder, "left").backfill(question_type)
    more = inputs.questions(spark, folder).select((-F.col("id") - 1).alias("id"), "question")
    return table.append(more).missing_rows("question_type")


@query
def feature_versions(spark, folder):
    first = _question_table(spark, folder, "versions").backfill(coarse_question_type)
    second = first.backfill(question_type)
    dropped = second.drop_columns(["question_type"])
    old = second.as_of(first.version).select("id", "question_type").withColumnRenamed("question_type", "before")
    new = dropped.as_of(second.version).select("id", "question_type").withColumnRenamed("question_type", "after")
    return (
        old.join(new, "id").groupBy("before", "after").count()
        .withColumn("still_there", F.lit("question_type" in dropped.columns))
    )


@query
def repeated_keys(spark, folder):
    rows = inputs.questions(spark, folder)
    table = FeatureTable.create(spark, new_dir(spark, "repeats"), rows.where("id % 3 = 0")).append(rows, on_repeat="skip")
    table = table.append(rows.where("id % 5 = 0"), on_repeat="skip").backfill(question_type)
    return table.select("id", "question", "question_type")


@query
def changed_code_versions(spark, folder):
    def first_letters(count):
        return feature("string", ["question"], name="start")(lambda question: question[:count])

    table = _question_table(spark, folder, "changed").backfill(first_letters(1)).backfill(first_letters(3))
    return profile.value_counts(table.select("start"), "start")


@query
def changed_upstream(spark, folder):
    """A feature at the root of a chain gets new code: what reads it follows, another branch is left alone."""
    def first_letters(count):
        return feature("string", ["text"], name="start")(lambda body: (body or "")[:count])

    marked = feature("string", ["start", "lang"], kind=COLUMN, name="marked")(lambda a, b: F.concat_ws("|", a, b))
    longer = feature("int", ["marked", "lines"], kind=COLUMN, name="longer")(lambda m, n: F.char_length(m) + n)
    lines = feature("int", ["text"], kind=COLUMN, name="lines")(lambda body: F.size(F.split(F.coalesce(body, F.lit("")), "\n")))
    rows = inputs.table(spark, folder, "documents").select("doc_id", "text", "lang")
    table = FeatureTable.create(spark, new_dir(spark, "upstream"), rows, key="doc_id")
    table = table.backfill_all([first_letters(1), marked, longer, lines])
    before = table.features
    table = table.backfill_all([first_letters(3), marked, longer])
    kept = before["lines"] == table.features["lines"] and not table.stale
    return table.select("doc_id", "start", "marked", "longer", "lines").withColumn("branch_kept", F.lit(kept))


@query
def appended_rows(spark, folder):
    rows = inputs.questions(spark, folder)
    table = FeatureTable.create(spark, new_dir(spark, "append"), rows.where(F.col("id") % 2 == 0))
    table = table.backfill(question_type).append(rows.where(F.col("id") % 2 == 1)).backfill(question_type)
    return table.select("id", "question_type")


@query
def provenance(spark, folder):
    table = _question_table(spark, folder, "origin").backfill(question_type).add_columns([question_words])
    filled = profile.coverage(table.to_df(), table.columns)
    return table.provenance().join(filled, "column")


@query
def open_by_name(spark, folder):
    path = new_dir(spark, "named")
    FeatureTable.create(spark, path + ".table", inputs.questions(spark, folder))
    table = FeatureTable.open(spark, path)
    return table.read_columns(["id", "question"])


@query
def overwritten_table(spark, folder):
    path = new_dir(spark, "again")
    FeatureTable.create(spark, path, inputs.questions(spark, folder)).backfill(question_type)
    table = FeatureTable.create(
        spark, path, inputs.qa(spark, folder).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "answer"),
        mode="overwrite",
    )
    return table.to_df()


@query
def model_feature(spark, folder):
    rows = inputs.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 50 != 0, F.col("embedding")).alias("embedding")
    )
    table = FeatureTable.create(spark, new_dir(spark, "model"), rows).backfill(image_vector, task_size=128)
    return _vector_digest(table.select("id", "image_vector"))


@query
def packed_model_feature(spark, folder):
    rows = inputs.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 50 != 0, F.col("embedding")).alias("embedding")
    )
    table = FeatureTable.create(spark, new_dir(spark, "packed"), rows).backfill(packed_vector, checkpoint_size=128)
    return _vector_digest(vectors.unpack_half(table.select("id", "image_vector"), "image_vector"))


def _vector_digest(df):
    value = F.col("image_vector")
    return df.select(
        "id", F.size(value).alias("n"), F.get(value, 0).cast("double").alias("first"),
        F.get(value, OUTPUTS - 1).cast("double").alias("last"),
        F.aggregate(value, F.lit(0.0), lambda a, x: a + x.cast("double")).alias("total"),
    )


@query
def incremental_features(spark, folder):
    rows = inputs.questions(spark, folder)
    root, landing, progress = (new_dir(spark, n) for n in ("upkeep", "landing", "progress"))
    FeatureTable.create(spark, root, rows.limit(0))
    for odd in (0, 1):
        rows.where(F.col("id") % 2 == odd).write.mode("append").parquet(landing)
        keep_features(spark, root, landing, rows.schema, [question_type], progress).awaitTermination()
    table = FeatureTable.open(spark, root)
    return profile.value_counts(table.select("question_type"), "question_type")


@query
def stream_dedup(spark, folder):
    hashed = inputs.rasters(spark, folder).select("vec_id", hashing.difference_hash(F.col("px")).alias("dhash"))
    landing, progress, kept = (new_dir(spark, n) for n in ("hashes", "dedup", "kept"))
    hashed.write.parquet(landing)
    stream = first_of_each_hash(spark.readStream.schema(hashed.schema).parquet(landing))
    (
        stream.writeStream.format("parquet").option("path", kept).option("checkpointLocation", progress)
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(kept).select(hashing.hash_hex(F.col("dhash")).alias("dhash"))


@query
def stream_near_dedup(spark, folder):
    """Three landings; what is kept equals the batch answer for the order of arrival."""
    hashed = inputs.bumped_rasters(spark, folder).select(
        "vec_id", F.when(F.col("vec_id") % 29 != 0, hashing.difference_hash(F.col("px"))).alias("dhash"))
    landing, place, progress = (new_dir(spark, n) for n in ("landing", "near", "progress"))
    for part in range(3):
        hashed.where(F.col("vec_id") % 3 == part).write.mode("append").parquet(landing)
        first_of_near_hashes(spark, landing, hashed.schema, "vec_id", place, progress).awaitTermination()
    kept = spark.read.schema(hashed.schema).parquet(f"{place}/kept")
    return kept.select("vec_id", hashing.hash_hex(F.col("dhash")).alias("dhash"))


@query
def stream_dedup_watermark(spark, folder):
    """Repeats of a user's event type within the delay; the events come in one batch, so that what is
    dropped does not hang on when the watermark moves."""
    events = inputs.table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.xxhash64("user_id", "event_type").alias("dhash"), "user_id", "event_type")
    landing, progress, kept = (new_dir(spark, n) for n in ("events", "dedup", "kept"))
    events.coalesce(1).write.parquet(landing)
    stream = first_of_each_hash(spark.readStream.schema(events.schema).parquet(landing), event_time="ts", delay="3650 days")
    (
        stream.writeStream.format("parquet").option("path", kept).option("checkpointLocation", progress)
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(kept).select("user_id", "event_type")


# ---- sources and small reads -------------------------------------------------------------------


@query
def dataset_counts(spark, folder):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations"]
    counted = [
        inputs.table(spark, folder, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows")
        for n in names
    ]
    result = counted[0]
    for df in counted[1:]:
        result = result.unionByName(df)
    return result


@query
def sidecar_metadata(spark, folder):
    place = new_dir(spark, "sidecar")
    documents = inputs.table(spark, folder, "documents")
    files.write_sidecar(spark, place, {"slice": "text_dense"})
    schema = "slice string"
    info, absent = (files.sidecar_rows(spark, place, schema, name) for name in ("slice_info.json", "other.json"))
    counted = documents.agg(F.count(F.lit(1)).alias("rows"))
    return info.crossJoin(counted).crossJoin(absent.agg(F.count(F.lit(1)).cast("int").alias("absent")))


@query
def parquet_mirror(spark, folder):
    copy = files.mirror_columns(
        inputs.table(spark, folder, "documents"), ["doc_id", "text", "lang"], new_dir(spark, "mirror")
    )
    return copy.select("doc_id", "lang", F.md5("text").alias("digest"))


@query
def sequential_scan(spark, folder):
    read = readrate.scan_batches(inputs.table(spark, folder, "documents"), ["doc_id", "text"], 8)
    return read.agg(F.sum("rows").alias("rows"), F.max("rows").alias("largest_batch"))


@query
def head_projection(spark, folder):
    return curate.first_rows(
        inputs.table(spark, folder, "documents"), "doc_id", 4,
        ["doc_id", "lang", text.prefix_text(text.words(F.col("text")), 8).alias("start")],
    )


@query
def query_row_pick(spark, folder):
    rows = inputs.table(spark, folder, "embeddings")
    return rows.select("vec_id", "label").orderBy("vec_id").offset(11).limit(1)


@query
def take_batches(spark, folder):
    return curate.random_batches(inputs.table(spark, folder, "documents"), "doc_id")


@query
def take_by_ids(spark, folder):
    documents = inputs.table(spark, folder, "documents")
    drawn = curate.random_batches(documents.select("doc_id"), "doc_id", 20, 8).orderBy("batch", "doc_id").collect()
    return lookup.take_rows(documents, [row["doc_id"] for row in drawn], "doc_id", ["doc_id", "lang", "n_chars"])


@query
def table_take(spark, folder):
    table = _question_table(spark, folder, "take").backfill(question_type)
    drawn = curate.random_batches(table.select("id"), "id", 20, 8).orderBy("batch", "id").collect()
    return table.take([row["id"] for row in drawn], ["id", "question", "question_type"])


@query
def row_index(spark, folder):
    return batches.row_index(inputs.table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")


# ---- text and profiling ------------------------------------------------------------------------


@query
def qtype_v1_counts(spark, folder):
    typed = inputs.questions(spark, folder).select(text.profile_question_type(F.col("question")).alias("qtype"))
    return profile.value_counts(typed, "qtype")


@query
def ascending_counts(spark, folder):
    return profile.value_counts(inputs.table(spark, folder, "documents"), "lang", ascending=True)


@query
def text_lengths(spark, folder):
    body = F.col("text")
    return inputs.table(spark, folder, "documents").select(
        "doc_id", text.word_count(body).alias("words"), text.text_length(body).alias("characters")
    )


@query
def null_defaults(spark, folder):
    answered = inputs.qa(spark, folder)
    listed = inputs.tokens(spark, folder)
    return (
        answered.select(F.lit("answer").alias("part"), text.word_count(F.col("answer")).alias("n"))
        .unionByName(listed.select(F.lit("tokens").alias("part"), text.item_count(F.col("ocr_tokens")).alias("n")))
        .groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n") == 0).alias("empty"),
                             F.sum("n").alias("total"))
    )


@query
def word_count_histogram(spark, folder):
    words = inputs.qa(spark, folder).select(text.word_count(F.col("answer")).alias("n"))
    return profile.clipped_histogram(words, "n", 8)


@query
def token_histogram_20(spark, folder):
    sized = inputs.tokens(spark, folder).select(text.item_count(F.col("ocr_tokens")).alias("n"))
    return profile.equal_width_histogram(sized, "n", 20, cap=60)


@query
def median_profile(spark, folder):
    sized = inputs.tokens(spark, folder).select(text.item_count(F.col("ocr_tokens")).alias("ocr_n"))
    worded = inputs.qa(spark, folder).select(text.word_count(F.col("answer")).alias("answer_words"))
    return profile.int_medians(sized, ["ocr_n"]).unionByName(profile.int_medians(worded, ["answer_words"]))


@query
def profile_of_growing_table(spark, folder):
    """Counts, a median and a histogram from summaries of parts; an append adds the summary of one part."""
    rows = inputs.table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    table = FeatureTable.create(spark, new_dir(spark, "profiled"), rows.where("doc_id % 3 <> 0"), key="doc_id")
    Profile(table, ["lang", "n_chars"]).refresh()
    known = Profile(table.append(rows.where("doc_id % 3 = 0")), ["lang", "n_chars"])
    added = len(known.refresh())
    told = [
        known.value_counts("lang").select(F.lit("lang").alias("statistic"), F.col("value").alias("item"), F.col("count").alias("n")),
        known.value_counts("n_chars").select(F.lit("n_chars"), F.col("value").cast("string"), F.col("count")),
        known.clipped_histogram("n_chars", 500, 12).select(F.lit("bin"), F.col("bin").cast("string"), "count"),
        known.int_median("n_chars").select(F.lit("median"), "column", "median"),
        known.distinct_values("n_chars").select(F.lit("distinct"), F.lit("n_chars"), "distinct_values"),
    ]
    found = told[0]
    for more in told[1:]:
        found = found.union(more)
    return found.withColumn("parts_added", F.lit(added))


@query
def top_classes(spark, folder):
    return profile.top_items(inputs.classes(spark, folder), "image_classes", 8)


@query
def distinct_labels(spark, folder):
    return profile.distinct_count(inputs.table(spark, folder, "embeddings"), "label")


@query
def list_prefix_text(spark, folder):
    return inputs.tokens(spark, folder).select("id", text.prefix_text(F.col("ocr_tokens"), 8).alias("start"))


@query
def normalise_text(spark, folder):
    return inputs.table(spark, folder, "conversations").select(
        "conv_id", "turn", text.normalise_answer(F.col("text")).alias("normalised")
    )


@query
def prompts(spark, folder):
    return inputs.qa(spark, folder).select("conv_id", "turn", text.prompt(F.col("question")).alias("prompt"))


# ---- vector search -----------------------------------------------------------------------------


@query
def knn_single(spark, folder):
    rows = inputs.table(spark, folder, "embeddings")
    asked = search.pick_row(rows, 11, "vec_id", ["embedding"])
    found = search.nearest(rows, asked["embedding"], "embedding", "vec_id", 5, ["label"])
    return found.select(
        "vec_id", "label", F.round("_distance", 6).alias("distance"),
        text.fixed(F.col("_distance"), 2, prefix="d=").alias("shown"),
    )


@query
def knn_batch(spark, folder):
    rows = inputs.table(spark, folder, "embeddings")
    found = search.nearest_each(rows, rows, "vec_id", "embedding", "vec_id", "embedding", 5)
    return found.select("query_id", "rank", "neighbour_id", F.round("_distance", 6).alias("distance"))


@query
def knn_batch_blocks(spark, folder):
    rows = inputs.table(spark, folder, "embeddings")
    found = search.nearest_each(rows, rows, "vec_id", "embedding", "vec_id", "embedding", 5, squared=True, limit_bytes=0)
    return found.select("query_id", "rank", "neighbour_id", F.round("_distance", 6).alias("distance"))


# Cells of the stored column, and cells a query looks into.
CELLS, PROBES = 16, 8


def _cell_table(spark, folder):
    """Vectors with their cells: learned on the first half of the rows, kept for those appended later."""
    rows = inputs.table(spark, folder, "embeddings").select("vec_id", "embedding")
    first = rows.where("vec_id % 2 = 0")
    centres = search.learn_cells(first, "vec_id", "embedding", CELLS, rounds=0)
    cell = search.cell_feature(centres, "embedding")
    table = FeatureTable.create(spark, new_dir(spark, "cells"), first, key="vec_id").backfill(cell)
    return table.append(rows.where("vec_id % 2 = 1")).backfill(cell).to_df(), centres


def _found_in_cells(spark, folder, limit_bytes=search.BROADCAST_BYTES):
    rows, centres = _cell_table(spark, folder)
    return search.nearest_in_cells(
        rows.where("vec_id % 20 = 0"), rows, centres, "vec_id", "embedding", "vec_id", "embedding", k=5, probes=PROBES,
        limit_bytes=limit_bytes)


@query
def knn_cells(spark, folder):
    found = _found_in_cells(spark, folder)
    return found.select("query_id", "rank", "neighbour_id", F.round("_distance", 6).alias("distance"))


@query
def knn_cells_blocks(spark, folder):
    found = _found_in_cells(spark, folder, limit_bytes=0)
    return found.select("query_id", "rank", "neighbour_id", F.round("_distance", 6).alias("distance"))


@query
def knn_cells_recall(spark, folder):
    rows = inputs.table(spark, folder, "embeddings")
    exact = search.nearest_each(rows.where("vec_id % 20 = 0"), rows, "vec_id", "embedding", "vec_id", "embedding", 5)
    return search.recall(_found_in_cells(spark, folder), exact).select("wanted", F.round("recall", 9).alias("recall"))


# ---- scoring -----------------------------------------------------------------------------------


def _scores(spark, folder, first=None):
    truths = inputs.truths(spark, folder)
    if first:
        truths = curate.first_rows(truths, "id", first, truths.columns)
    base, tuned = (inputs.predictions(spark, folder, which) for which in ("base", "tuned"))
    return evaluate.scored(truths, base, tuned, "id")


@query
def answer_scores(spark, folder):
    return _scores(spark, folder).select(
        "id", F.round("base_score", 6).alias("base_score"), F.round("tuned_score", 6).alias("tuned_score")
    )


@query
def accuracy_lift(spark, folder):
    summary = evaluate.accuracy(_scores(spark, folder))
    rounded = [F.round(c, 6).alias(c) for c in ("base_accuracy", "tuned_accuracy", "lift_points")]
    return summary.select("rows", *rounded, "wins")


@query
def formatted_scores(spark, folder):
    return evaluate.accuracy_text(evaluate.accuracy(_scores(spark, folder)))


@query
def eval_table(spark, folder):
    shown = evaluate.comparison(_scores(spark, folder), "id", "question")
    return shown.select("id", "question", "base", "tuned", "truths", "tuned_wins")


@query
def eval_head(spark, folder):
    rows = evaluate.comparison(_scores(spark, folder, first=256), "id", "question")
    return rows.select("id", "base", "tuned", "tuned_wins")


@query
def truth_matches(spark, folder):
    said = inputs.predictions(spark, folder, "tuned").join(inputs.truths(spark, folder), "id", "right")
    score = scoring.answer_score(F.col("prediction"), F.col("answers"))
    return said.groupBy(F.round(score, 6).alias("score")).count()


# ---- images ------------------------------------------------------------------------------------


def _hashed(spark, folder):
    return inputs.rasters(spark, folder).select("vec_id", hashing.difference_hash(F.col("px")).alias("dhash"))


@query
def dhash_hex(spark, folder):
    return _hashed(spark, folder).select("vec_id", hashing.hash_hex(F.col("dhash")).alias("dhash"))


@query
def image_dhash(spark, folder):
    hashed = images.hash_encoded(inputs.pictures(spark, folder), "vec_id", "image")
    return hashed.select("vec_id", hashing.hash_hex(F.col("dhash")).alias("dhash"))


@query
def dup_groups(spark, folder):
    groups = neardup.duplicate_groups(_hashed(spark, folder), "vec_id")
    return groups.select(hashing.hash_hex(F.col("dhash")).alias("dhash"), "rows", "representative")


@query
def dup_members(spark, folder):
    return neardup.duplicate_members(_hashed(spark, folder), "vec_id").select("vec_id", "representative", "group_rows")


@query
def dup_summary(spark, folder):
    return neardup.duplicate_summary(_hashed(spark, folder))


@query
def hamming_pairs(spark, folder):
    pairs = neardup.similar_hashes(_hashed(spark, folder), distance=3)
    return _shown_pairs(pairs)


@query
def hamming_pairs_fine(spark, folder):
    hashed = inputs.fine_rasters(spark, folder).select("vec_id", hashing.difference_hash(F.col("px")).alias("dhash"))
    return _shown_pairs(neardup.similar_hashes(hashed, distance=18, crowded=64))


@query
def hamming_pairs_crowded(spark, folder):
    hashed = inputs.bumped_rasters(spark, folder).select("vec_id", hashing.difference_hash(F.col("px")).alias("dhash"))
    return _shown_pairs(neardup.similar_hashes(hashed, distance=3, crowded=16))


def _shown_pairs(pairs):
    return pairs.select(
        hashing.hash_hex(F.col("hash_a")).alias("hash_a"), hashing.hash_hex(F.col("hash_b")).alias("hash_b"),
        F.col("distance").cast("int").alias("distance"), "rows_a", "rows_b",
    )


# ---- curation and training ---------------------------------------------------------------------


@query
def text_dense_quarter(spark, folder):
    return curate.dense_share(inputs.tokens(spark, folder), "id", "ocr_tokens").select("id")


@query
def holdout_split(spark, folder):
    return curate.holdout_split(inputs.table(spark, folder, "documents"), "doc_id", 400, "split").select("doc_id", "split")


@query
def holdout_by_group(spark, folder):
    """No two pictures within 3 bits on different sides; the crossing pairs are counted to show it."""
    hashed = inputs.bumped_rasters(spark, folder).select(
        "vec_id", F.when(F.col("vec_id") % 29 != 0, hashing.difference_hash(F.col("px"))).alias("dhash"))
    return curate.holdout_by_group(hashed, "vec_id", 400, seed="split").select("vec_id", "split")


@query
def epoch_permutation(spark, folder):
    return batches.epoch_order(inputs.table(spark, folder, "documents"), "doc_id", 3).select("epoch", "doc_id", "rank")


@query
def micro_batches(spark, folder):
    ordered = batches.epoch_order(inputs.table(spark, folder, "documents"), "doc_id", 2, 42)
    return batches.micro_batches(ordered, 3).select("epoch", "doc_id", "batch")


# Fixed values of the training run: micro-batches a step, steps, epochs at most.
ACCUMULATE, STEPS, EPOCHS = 4, 300, batches.EPOCH_LIMIT


def _schedule(spark, folder, steps, epochs):
    documents = inputs.table(spark, folder, "documents")
    rows = documents.count()
    if steps is not None:
        epochs = batches.epochs_needed(rows, 2, ACCUMULATE, steps, epochs)
    batched = batches.micro_batches(batches.epoch_order(documents, "doc_id", epochs), 2)
    return batches.accumulation_schedule(batched, rows, 2, epochs, ACCUMULATE, steps)


@query
def accum_schedule(spark, folder):
    return _schedule(spark, folder, STEPS, EPOCHS)


@query
def whole_epoch_schedule(spark, folder):
    return _schedule(spark, folder, None, 2)


@query
def progress_steps(spark, folder):
    return batches.progress_steps(_schedule(spark, folder, STEPS, EPOCHS), STEPS)


@query
def collated_batches(spark, folder):
    rows = inputs.training_rows(spark, folder)
    table = FeatureTable.create(spark, new_dir(spark, "train"), rows)
    made = batches.cached_batches(table, batch_size=3, seed=42, epochs=2, tokens=8, width=8, text_tokens=16)
    return _shown_batches(made)


@query
def unshuffled_batches(spark, folder):
    rows = inputs.training_rows(spark, folder)
    table = FeatureTable.create(spark, new_dir(spark, "train"), rows)
    return _shown_batches(batches.cached_batches(table, 8, shuffle=False, tokens=8, width=8, text_tokens=16))


@query
def windowed_epoch(spark, folder):
    """Two epochs, bucket by bucket; a loose increment has buckets of its own."""
    rows = inputs.training_rows(spark, folder)
    table = FeatureTable.create(spark, new_dir(spark, "train"), rows.where("id % 5 <> 0"), buckets=6)
    table = table.append(rows.where("id % 5 = 0"))
    return _shown_batches(batches.windowed_batches(table, 4, seed=7, epochs=2, tokens=8, width=8, text_tokens=16))


def _shown_batches(made):
    listed = F.col("samples")
    corner = lambda s: F.get(F.get(s["vision"], 1), 2).cast("double")
    return made.select(
        F.col("epoch").cast("int").alias("epoch"), "batch", F.size(listed).alias("n"),
        F.array_join(F.transform(listed, lambda s: s["id"].cast("string")), " ").alias("ids"),
        F.array_join(F.flatten(F.transform(listed, lambda s: s["labels"].cast("array<string>"))), " ").alias("labels"),
        F.round(F.aggregate(listed, F.lit(0.0), lambda a, s: a + corner(s)), 6).alias("corner_sum"),
    )


@query
def sft_struct_or_flat(spark, folder):
    flat = inputs.training_rows(spark, folder)
    nested = flat.select("id", "vision_tower_hiddens", F.struct(*batches.TOKEN_FIELDS).alias("sft_tokens"))
    read = [
        df.select("id", F.lit(name).alias("layout"), *[
            F.array_join(batches.token_field(df.columns, f).cast("array<string>"), " ").alias(f)
            for f in batches.TOKEN_FIELDS
        ])
        for name, df in (("flat", flat), ("struct", nested))
    ]
    return read[0].unionByName(read[1])


def _packed(spark, folder, limit_bytes):
    asked = inputs.qa(spark, folder).withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    packed = tokens.prompt_answer_tokens(asked, "id", "question", "answer", limit_bytes=limit_bytes)
    return packed.select("id", *[
        F.array_join(F.col(f).cast("array<string>"), " ").alias(f) for f in batches.TOKEN_FIELDS
    ], "n_tokens", "truncated")


@query
def packed_tokens(spark, folder):
    return _packed(spark, folder, tokens.BROADCAST_BYTES)


@query
def packed_tokens_joined(spark, folder):
    return _packed(spark, folder, 0)


@query
def token_vocabulary(spark, folder):
    known = tokens.vocabulary(inputs.tokens(spark, folder), "ocr_tokens")
    return known.select("token", "n", F.col("token_id").cast("bigint").alias("token_id"))


@query
def scatter_placeholders(spark, folder):
    filled = tokens.fill_placeholders(inputs.placeholder_rows(spark, folder), "id", "ids", "text", "vectors", 7)
    return filled.select("id", F.posexplode("filled").alias("pos", "v")).select(
        "id", "pos", *[F.round(F.get("v", i).cast("double"), 6).alias(f"v{i}") for i in range(4)]
    )


@query
def pad_check(spark, folder):
    rows = inputs.placeholder_rows(spark, folder)
    uneven = rows.withColumn("vectors", F.when(F.col("id") % 5 == 0, F.slice("vectors", 1, 2)).otherwise(F.col("vectors")))
    return tokens.placeholder_check(uneven, "id", "ids", "vectors", 7)
