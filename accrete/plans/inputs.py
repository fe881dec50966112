"""Inputs of the registered queries, derived row by row from the given tables.

`SQL` states each of them once more for the independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrete.functions.text import words

IMAGE_WIDTH, IMAGE_HEIGHT = 18, 16
VOCABULARY_BUDGET = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """(id, question): every question label occurs, one text is empty."""
    starts = F.array(*[F.lit(s) for s in (
        "How many ", "What is the color of ", "what brand ", "What number ", "what ", "Which ", "who ", "  where ",
        "Does ", "whatever ", "",
    )])
    at = (F.col("event_id") % 11).cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.concat(F.get(starts, at), "event_type").alias("question")
    )


def qa(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, question, answer): user turns with the assistant turn after them, if any."""
    turns = table(spark, folder, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    given = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(given, ["conv_id", "turn"], "left")


def truths(spark: SparkSession, folder: str) -> DataFrame:
    """(id, question, answers): ten human answers per order, made from the order's own fields."""
    kind = lambda i: (F.col("o_orderkey") + i * i) % 5
    answer = lambda i: (
        F.when(kind(i) == 0, F.concat(F.lit("The "), "o_orderpriority", F.lit(".")))
        .when(kind(i) == 1, F.lower("o_orderpriority"))
        .when(kind(i) == 2, F.col("o_orderstatus"))
        .when(kind(i) == 3, F.concat(F.lit("an "), "o_orderstatus", F.lit("!")))
        .otherwise(F.concat("o_orderpriority", F.lit(" "), "o_orderstatus"))
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Which priority has "), "o_orderkey", F.lit("?")).alias("question"),
        F.transform(F.sequence(F.lit(0), F.lit(9)), answer).alias("answers"),
    )


def predictions(spark: SparkSession, folder: str, which: str) -> DataFrame:
    """(id, prediction) of the "base" or the "tuned" run; some base answers are missing or blank."""
    key = F.col("o_orderkey")
    if which == "base":
        said = (
            F.when(key % 7 == 0, F.lit(None).cast("string")).when(key % 7 == 1, "").when(key % 7 == 2, " ")
            .when(key % 7 == 3, F.concat("o_orderstatus", F.lit("?")))
            .when(key % 7 == 4, F.concat("o_orderpriority", F.lit(" "), "o_orderstatus"))
            .when(key % 7 == 5, "the")
            .otherwise(F.concat(F.lit("a ("), F.lower("o_orderpriority"), F.lit(")")))
        )
    else:
        said = (
            F.when(key % 3 == 0, F.concat(F.upper("o_orderpriority"), F.lit("!")))
            .when(key % 3 == 1, F.concat(F.lit("The "), "o_orderstatus"))
            .otherwise(F.concat("o_orderpriority", F.lit(" "), "o_orderstatus"))
        )
    # Some truths have no prediction.
    missing = (key % 11 == 3) if which == "base" else (key % 13 == 5)
    return table(spark, folder, "orders").where(~missing).select(key.alias("id"), said.alias("prediction"))


def rasters(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, px): 8 rows of 9 gray values; many vectors share a picture."""
    odd = lambda i: F.when((i == F.col("vec_id") % 72) & (F.col("vec_id") % 3 == 0), 13).otherwise(0)
    pixel = lambda i: ((F.col("label") * 31 + i * i * 7 + odd(i)) % 97).cast("int")
    return table(spark, folder, "embeddings").select(
        "vec_id", F.transform(F.sequence(F.lit(0), F.lit(71)), pixel).alias("px")
    )


def fine_rasters(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, px): 72 gray values straight from the vector; nearly all pictures differ."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.concat("embedding", F.slice("embedding", 1, 8)).alias("px")
    )


def bumped_rasters(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, px): pictures that differ from their label's picture in two places, so that very
    many different hashes lie a few bits apart."""
    bump = lambda i, at: F.when(i == at, 60).otherwise(0)
    pixel = lambda i: (
        (F.col("label") * 31 + i * i * 7) % 97 + bump(i, F.col("vec_id") % 72)
        + bump(i, F.floor(F.col("vec_id") / 7) % 72)
    ).cast("int")
    return table(spark, folder, "embeddings").select(
        "vec_id", F.transform(F.sequence(F.lit(0), F.lit(71)), pixel).alias("px")
    )


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, image): an 18x16 colour picture per vector as binary PPM; every 25th is empty."""
    level = lambda e: F.floor(F.abs(e.cast("double")) * 1000) % 256
    levels = F.transform("embedding", lambda e: F.lpad(F.hex(level(e)), 2, "0"))
    turned = lambda n: F.concat(F.slice("levels", n + 1, 64 - n), F.slice("levels", 1, n))
    both = lambda a, b: F.concat(a, b)
    pixels = F.zip_with(F.zip_with("levels", turned(5), both), turned(10), both)
    # Pixel p takes levels p, p+5 and p+10, modulo 64: the 64 pixels repeat to fill 18 x 16.
    body = F.substring(F.repeat(F.array_join(pixels, ""), 5), 1, IMAGE_WIDTH * IMAGE_HEIGHT * 6)
    header = F.encode(F.lit(f"P6\n{IMAGE_WIDTH} {IMAGE_HEIGHT}\n255\n"), "UTF-8")
    image = F.when(F.col("vec_id") % 25 == 0, F.encode(F.lit(""), "UTF-8")).otherwise(F.concat(header, F.unhex(body)))
    return table(spark, folder, "embeddings").withColumn("levels", levels).select("vec_id", image.alias("image"))


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(id, ocr_tokens): the words of each document; null for every 17th."""
    listed = F.when(F.col("doc_id") % 17 != 0, words(F.col("text")))
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), listed.alias("ocr_tokens"))


def classes(spark: SparkSession, folder: str) -> DataFrame:
    """(id, image_classes): the words of each part's name; null for every 19th."""
    listed = F.when(F.col("p_partkey") % 19 != 0, F.split("p_name", " "))
    return table(spark, folder, "part").select(F.col("p_partkey").alias("id"), listed.alias("image_classes"))


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(id, vision_tower_hiddens, input_ids, attention_mask, labels) of small fixed sizes."""
    at = F.sequence(F.lit(0), F.lit(VOCABULARY_BUDGET - 1))
    ids = F.transform(at, lambda i: ((F.col("vec_id") * 31 + i * 7) % 1000).cast("int"))
    kept = lambda i: i < F.col("vec_id") % VOCABULARY_BUDGET + 1
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vision_tower_hiddens"), ids.alias("input_ids"),
        F.transform(at, lambda i: kept(i).cast("int")).alias("attention_mask"),
        F.transform(ids, lambda x, i: F.when(kept(i), x).otherwise(-100)).alias("labels"),
    )


def placeholder_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(id, ids, text, vectors): 16 token slots of width 4, a placeholder (7) in some of them."""
    at = F.sequence(F.lit(0), F.lit(15))
    ids = F.transform(at, lambda i: F.when((F.col("vec_id") + i) % 3 == 0, 7).otherwise(i + 100).cast("int"))
    text = F.transform(at, lambda i: F.array(*[(i + c).cast("float") for c in range(4)]))
    slots = F.size(F.filter("ids", lambda x: x == 7))
    vectors = F.transform(F.sequence(F.lit(0), slots - 1), lambda k: F.slice("embedding", k * 4 + 1, F.lit(4)))
    return (
        table(spark, folder, "embeddings").withColumn("ids", ids)
        .select(F.col("vec_id").alias("id"), "ids", text.alias("text"), vectors.alias("vectors"))
    )


SQL = {
    "questions": """
        SELECT event_id AS id, ['How many ','What is the color of ','what brand ','What number ','what ','Which ',
          'who ','  where ','Does ','whatever ',''][(event_id % 11)::INT + 1] || event_type AS question FROM events""",
    "qa": """
        SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer FROM conversations q
        LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
        WHERE q.role = 'user'""",
    "truths": """
        SELECT o_orderkey AS id, 'Which priority has ' || o_orderkey || '?' AS question,
          list_transform(range(10), lambda i: CASE (o_orderkey + i*i) % 5
            WHEN 0 THEN 'The ' || o_orderpriority || '.' WHEN 1 THEN lower(o_orderpriority) WHEN 2 THEN o_orderstatus
            WHEN 3 THEN 'an ' || o_orderstatus || '!' ELSE o_orderpriority || ' ' || o_orderstatus END) AS answers
        FROM orders""",
    "base": """
        SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' '
          WHEN 3 THEN o_orderstatus || '?' WHEN 4 THEN o_orderpriority || ' ' || o_orderstatus WHEN 5 THEN 'the'
          ELSE 'a (' || lower(o_orderpriority) || ')' END AS prediction FROM orders WHERE o_orderkey % 11 <> 3""",
    "tuned": """
        SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN upper(o_orderpriority) || '!'
          WHEN 1 THEN 'The ' || o_orderstatus ELSE o_orderpriority || ' ' || o_orderstatus END AS prediction
        FROM orders WHERE o_orderkey % 13 <> 5""",
    "rasters": """
        SELECT vec_id, list_transform(range(72), lambda i: ((label*31 + i*i*7 +
          CASE WHEN i = vec_id % 72 AND vec_id % 3 = 0 THEN 13 ELSE 0 END) % 97)::INT) AS px FROM embeddings""",
    "bumped_rasters": """
        SELECT vec_id, list_transform(range(72), lambda i: ((label*31 + i*i*7) % 97 +
          CASE WHEN i = vec_id % 72 THEN 60 ELSE 0 END + CASE WHEN i = vec_id // 7 % 72 THEN 60 ELSE 0 END)::INT) AS px
        FROM embeddings""",
    "fine_rasters": "SELECT vec_id, list_concat(embedding, embedding[1:8]) AS px FROM embeddings",
    "tokens": r"""
        SELECT doc_id AS id, CASE WHEN doc_id % 17 <> 0
          THEN list_filter(string_split_regex(text, '\s+'), lambda t: t <> '') END AS ocr_tokens FROM documents""",
    "classes": """
        SELECT p_partkey AS id, CASE WHEN p_partkey % 19 <> 0 THEN string_split(p_name, ' ') END AS image_classes
        FROM part""",
    "training_rows": """
        SELECT vec_id AS id, embedding AS vision_tower_hiddens,
          list_transform(range(16), lambda i: (vec_id*31 + i*7) % 1000) AS input_ids,
          list_transform(range(16), lambda i: CASE WHEN i < vec_id % 16 + 1 THEN 1 ELSE 0 END) AS attention_mask,
          list_transform(range(16), lambda i: CASE WHEN i < vec_id % 16 + 1 THEN (vec_id*31 + i*7) % 1000 ELSE -100 END)
            AS labels FROM embeddings""",
    "placeholder_rows": """
        SELECT vec_id AS id, embedding, list_transform(range(16), lambda i: CASE WHEN (vec_id + i) % 3 = 0 THEN 7
          ELSE i + 100 END) AS ids FROM embeddings""",
}
