"""The same results stated in SQL for an independent engine; inputs as in `inputs.SQL`."""

from __future__ import annotations

from accrete.functions.text import ANSWER_HINT, PROFILE_QUESTION_TYPES, QUESTION_TYPES
from accrete.plans.inputs import SQL as INPUT

WORDS = r"list_filter(string_split_regex({0}, '\s+'), lambda t: t <> '')"


def _with(names: str, body: str, **extra: str) -> str:
    parts = [f"{n} AS ({INPUT[n]})" for n in names.split()] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body


def _first_match(column: str, patterns) -> str:
    cases = " ".join(f"WHEN regexp_matches({column}, '{p}', 'i') THEN '{label}'" for label, p in patterns)
    return f"CASE {cases} ELSE 'other' END"


TYPE = _first_match("question", QUESTION_TYPES)
COARSE = _first_match("question", PROFILE_QUESTION_TYPES)


def _norm(x: str) -> str:
    bare = f"regexp_replace(lower(trim({x})), '[.,!?;:()\"]+', '', 'g')"
    return (
        f"array_to_string(list_filter(string_split_regex({bare}, '\\s+'), "
        f"lambda w: w <> '' AND w NOT IN ('a','an','the')), ' ')"
    )


def _score(said: str) -> str:
    matches = f"len(list_filter(answers, lambda g: {_norm('g')} = {_norm(said)}))"
    return f"CASE WHEN coalesce({said}, '') = '' THEN 0.0::DOUBLE ELSE least({matches} / 3.0::DOUBLE, 1.0) END"


SCORED = {
    "said": "SELECT t.id, t.question, t.answers, b.prediction AS base, u.prediction AS tuned "
            "FROM truths t LEFT JOIN base b USING (id) LEFT JOIN tuned u USING (id)",
    "scored": f"SELECT *, {_score('base')} AS base_score, {_score('tuned')} AS tuned_score FROM said",
}

HASH_BITS = "list_transform(range(64), lambda i: CASE WHEN px[(i//8)*9 + i%8 + 2] > px[(i//8)*9 + i%8 + 1] THEN 1 ELSE 0 END)"
# 16 hex digits, and the same bits as an unsigned number.
HEX = (
    "array_to_string(list_transform(range(16), lambda j: "
    "'0123456789abcdef'[(b[4*j+1]*8 + b[4*j+2]*4 + b[4*j+3]*2 + b[4*j+4] + 1)::INT]), '')"
)
NUMBER = "list_reduce(list_transform(b, lambda x: x::HUGEINT), lambda a, x: a*2 + x)::UBIGINT"


def _hashed(source: str) -> dict[str, str]:
    return {
        "bits": f"SELECT vec_id, {HASH_BITS} AS b FROM {source}",
        "hashed": f"SELECT vec_id, {HEX} AS dhash, {NUMBER} AS number FROM bits",
    }


def _pairs(distance: int) -> str:
    # Hashes are ordered as signed numbers, as the 64-bit column is.
    return f"""
        SELECT a.dhash AS hash_a, b.dhash AS hash_b, bit_count(xor(a.number, b.number))::INT AS distance,
          a.n AS rows_a, b.n AS rows_b
        FROM groups a JOIN groups b ON a.signed < b.signed AND bit_count(xor(a.number, b.number)) <= {distance}"""


GROUPS = """
    SELECT dhash, number, CASE WHEN number >= 9223372036854775808 THEN number::HUGEINT - 18446744073709551616
      ELSE number::HUGEINT END AS signed, count(*) AS n FROM hashed GROUP BY ALL"""


def _weights(source: int, target: int) -> str:
    scale = source / target
    reach = 3 * max(scale, 1.0)
    x = f"((a - (o + 0.5) * {scale} + 0.5) / {max(scale, 1.0)})"
    sinc = lambda v: f"(CASE WHEN {v} = 0 THEN 1.0 ELSE sin(pi() * {v}) / (pi() * {v}) END)"
    return f"""
        SELECT o, a, trunc(w / sum(w) OVER (PARTITION BY o) * 4194304 + CASE WHEN w < 0 THEN -0.5 ELSE 0.5 END)::BIGINT AS w
        FROM (SELECT o, a, {sinc(x)} * {sinc(f'({x} / 3)')} AS w FROM range({target}) s(o), range({source}) t(a)
          WHERE a >= greatest(trunc((o + 0.5) * {scale} - {reach} + 0.5), 0)
            AND a < least(trunc((o + 0.5) * {scale} + {reach} + 0.5), {source}) AND abs({x}) < 3)"""


PICTURE = {
    "gray": """
        SELECT vec_id, p % 18 AS x, p // 18 AS y, (19595 * g[p % 64 + 1] + 38470 * g[(p + 5) % 64 + 1]
          + 7471 * g[(p + 10) % 64 + 1] + 32768) // 65536 AS v
        FROM (SELECT vec_id, list_transform(embedding, lambda e: (floor(abs(e::DOUBLE) * 1000) % 256)::BIGINT) AS g
          FROM embeddings WHERE vec_id % 25 <> 0), range(288) r(p)""",
    "wx": _weights(18, 9),
    "wy": _weights(16, 8),
    "wide": """
        SELECT vec_id, y, o AS x, greatest(least(floor((sum(v * w) + 2097152)::DOUBLE / 4194304), 255), 0)::BIGINT AS v
        FROM gray JOIN wx ON wx.a = gray.x GROUP BY vec_id, y, o""",
    "small": """
        SELECT vec_id, o AS y, x, greatest(least(floor((sum(v * w) + 2097152)::DOUBLE / 4194304), 255), 0)::BIGINT AS v
        FROM wide JOIN wy ON wy.a = wide.y GROUP BY vec_id, o, x""",
    "shrunk": "SELECT vec_id, list(v ORDER BY y, x) AS px FROM small GROUP BY vec_id",
}

RANKED = "row_number() OVER (PARTITION BY epoch ORDER BY md5('{seed}|' || epoch || '|' || {key}), {key})"

DISTANCE = "list_sum(list_transform(list_zip(q.embedding, c.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2))"

CELLS = {
    "centre": """
        SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) - 1 AS cell, embedding
        FROM embeddings WHERE vec_id % 2 = 0 QUALIFY cell < 16""",
    "near": f"""
        SELECT q.vec_id, c.cell, row_number() OVER (PARTITION BY q.vec_id ORDER BY {DISTANCE}, c.cell) AS place
        FROM embeddings q, centre c""",
    "cells_found": f"""
        SELECT query_id, rank::INT AS rank, neighbour_id, round(sqrt(gap), 6) AS distance FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY gap, neighbour_id) AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id, {DISTANCE} AS gap
            FROM near p JOIN embeddings q ON q.vec_id = p.vec_id JOIN near o ON o.cell = p.cell AND o.place = 1
              JOIN embeddings c ON c.vec_id = o.vec_id
            WHERE p.place <= 8 AND p.vec_id % 20 = 0))
        WHERE rank <= 5""",
}

MODEL = """
    SELECT id, list_transform(range(16), lambda j: CASE WHEN id % 50 = 0 THEN 0.0 ELSE
      list_sum(list_transform(range(64), lambda i: floor(embedding[i+1]::DOUBLE * 1000) * ((7*i + 13*j) % 11 - 5))) / 1024 END) AS v
    FROM (SELECT vec_id AS id, embedding FROM embeddings)"""
HALF = """
    SELECT id, list_transform(v, lambda x: CASE WHEN x = 0 THEN 0.0::DOUBLE ELSE
      round_even(x / (2.0 ** (floor(log2(abs(x))) - 10)), 0) * (2.0 ** (floor(log2(abs(x))) - 10)) END) AS v FROM raw"""
MODEL_SQL = _with("", "SELECT id, len(v)::INT AS n, v[1] AS first, v[16] AS last, list_sum(v) AS total FROM half",
                  raw=MODEL, half=HALF)


def _batches(size: int, epochs: int, order: str) -> str:
    return _with("training_rows", f"""
        SELECT epoch::INT AS epoch, batch, count(*)::INT AS n, string_agg(id::VARCHAR, ' ' ORDER BY rank) AS ids,
          string_agg(array_to_string(labels, ' '), ' ' ORDER BY rank) AS labels,
          round(sum(vision_tower_hiddens[11]::DOUBLE), 6) AS corner_sum FROM placed GROUP BY epoch, batch""",
        ranked=f"SELECT *, {order} AS rank FROM training_rows, range({epochs}) e(epoch)",
        placed=f"SELECT *, (rank - 1) // {size} AS batch FROM ranked")


def _murmur(value: str) -> dict[str, str]:
    """`hashed` (id, h): the hash by which Spark deals a 64-bit key to buckets, as a signed 32-bit number."""
    word, most = 4294967296, 4294967295
    turn = lambda x, n: f"((({x}) << {n}) | (({x}) >> {32 - n})) & {most}"
    steps = {"h0": f"SELECT id, 42::UBIGINT AS h, (({value}) & {most})::UBIGINT AS low, ((({value}) >> 32) & {most})::UBIGINT AS high FROM training_rows"}
    for i, half in enumerate(("low", "high")):
        k = f"(({turn(f'({half} * 3432918353) % {word}', 15)}) * 461845907) % {word}"
        steps[f"k{i}"] = f"SELECT *, ({k})::UBIGINT AS k FROM h{i}"
        h = f"(({turn('xor(h, k)', 13)}) * 5 + 3864292196) % {word}"
        steps[f"h{i + 1}"] = f"SELECT id, ({h})::UBIGINT AS h, low, high FROM k{i}"
    steps["f1"] = "SELECT id, xor(h, 8::UBIGINT) AS h FROM h2"
    steps["f2"] = f"SELECT id, (xor(h, h >> 16) * 2246822507) % {word} AS h FROM f1"
    steps["f3"] = f"SELECT id, (xor(h, h >> 13) * 3266489909) % {word} AS h FROM f2"
    steps["hashed"] = f"SELECT id, CASE WHEN g >= 2147483648 THEN g::BIGINT - {word} ELSE g::BIGINT END AS h FROM (SELECT id, xor(h, h >> 16) AS g FROM f3)"
    return steps


WINDOWED = {
    **_murmur("id"),
    "placed_keys": """
        SELECT id, epoch, ((h % 6) + 6) % 6 + CASE WHEN id % 5 = 0 THEN 6 ELSE 0 END AS bucket FROM hashed, range(2) e(epoch)""",
    "sizes": "SELECT epoch, bucket, ceil(count(*) / 4.0)::BIGINT AS batches FROM placed_keys GROUP BY ALL",
    "firsts": """
        SELECT epoch, bucket, coalesce(sum(batches) OVER (PARTITION BY epoch ORDER BY md5('7|' || epoch || '|bucket ' || bucket), bucket
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM sizes""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY epoch, bucket ORDER BY md5('7|' || epoch || '|' || id), id) - 1 AS rank FROM placed_keys""",
    "placed": "SELECT t.*, r.epoch, r.rank, f.first + r.rank // 4 AS batch FROM training_rows t JOIN ranked r USING (id) JOIN firsts f USING (epoch, bucket)",
}

SCHEDULE = {
    "size": "SELECT count(*) AS n, ceil(count(*) / 2.0)::BIGINT AS per_epoch FROM documents",
    "run": "SELECT *, least(10, ceil(1200.0 / per_epoch))::BIGINT AS epochs FROM size",
    "ranked": f"SELECT epoch, {RANKED.format(seed=0, key='doc_id')} AS rank FROM documents, range(10) e(epoch)",
    "sized": "SELECT epoch, (rank - 1) // 2 AS batch, count(*) AS samples FROM ranked GROUP BY ALL",
    "schedule": """
        SELECT epoch::INT AS epoch, batch, samples,
          CASE WHEN (epoch * per_epoch + batch) // 4 + 1 <= least(300, epochs * per_epoch // 4)
            THEN (epoch * per_epoch + batch) // 4 + 1 END AS step
        FROM sized, run WHERE epoch < epochs""",
}

PROMPT = "coalesce(question, '') || chr(10) || chr(10) || '" + ANSWER_HINT + "'"


def _join(items: str) -> str:
    return f"array_to_string({items}, ' ')"


PACKED = _with("qa", f"""
    SELECT id, {_join("list_concat(ids, list_transform(range(512 - len(ids)), lambda i: 0))")} AS input_ids,
      {_join("list_concat(list_transform(ids, lambda i: 1), list_transform(range(512 - len(ids)), lambda i: 0))")} AS attention_mask,
      {_join('''list_concat(list_transform(ids, lambda x, i: CASE WHEN i <= start THEN -100 ELSE x END),
        list_transform(range(512 - len(ids)), lambda i: -100))''')} AS labels, n_tokens, n_tokens > 512 AS truncated
    FROM (SELECT id, any_value(start) AS start, any_value(n)::INT AS n_tokens, list(token_id ORDER BY pos) AS ids
      FROM kept JOIN vocabulary USING (token) GROUP BY id)""",
    asked=f"SELECT conv_id * 1000 + turn AS id, {WORDS.format(PROMPT)} AS p, {WORDS.format("coalesce(answer, '')")} AS a FROM qa",
    worded="SELECT id, len(p) AS start, list_concat(p, a) AS tokens FROM asked",
    spread="SELECT id, start, len(tokens) AS n, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM worded",
    kept="SELECT * FROM spread WHERE pos <= 512",
    vocabulary="""SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS token_id FROM spread GROUP BY token""")

ORACLE = {
    # feature tables
    "question_type_counts": _with("questions", f"SELECT {TYPE} AS question_type, count(*) AS count FROM questions GROUP BY 1"),
    "feature_only_read": _with("questions", f"SELECT {TYPE} AS question_type, count(*) AS count FROM questions GROUP BY 1"),
    "stitched_columns": _with("questions", f"""
        SELECT id, question, {TYPE} AS question_type, len({WORDS.format('question')})::INT AS question_words FROM questions"""),
    "batch_transform_feature": _with("questions", "SELECT id, strlen(question)::INT AS question_bytes FROM questions"),
    "dependent_features": _with("questions", f"""
        SELECT id, {TYPE} NOT IN ('is_does', 'other') AND len({WORDS.format('question')}) > 1 AS long_open_question
        FROM questions"""),
    "resume_dependent_backfill": _with("questions", f"""
        SELECT id, {TYPE} NOT IN ('is_does', 'other') AND len({WORDS.format('question')}) > 1 AS long_open_question
        FROM questions"""),
    "resume_backfill": _with("questions", f"SELECT {TYPE} AS question_type, count(*) AS count FROM questions GROUP BY 1"),
    "partial_coverage": """
        SELECT unnest(['id', 'question', 'question_type', 'question_words']) AS column,
          unnest([2 * n, 2 * n, n, 0]) AS filled, 2 * n AS rows FROM (SELECT count(*) AS n FROM events)""",
    "rows_left_to_fill": "SELECT -event_id - 1 AS id FROM events",
    "feature_versions": _with("questions", f"""
        SELECT {COARSE} AS before, {TYPE} AS after, count(*) AS count, false AS still_there FROM questions GROUP BY 1, 2"""),
    "repeated_keys": _with("questions", f"SELECT id, question, {TYPE} AS question_type FROM questions"),
    "changed_code_versions": _with("questions", "SELECT left(question, 3) AS start, count(*) AS count FROM questions GROUP BY 1"),
    "changed_upstream": """
        SELECT doc_id, left(coalesce(text, ''), 3) AS start, concat_ws('|', left(coalesce(text, ''), 3), lang) AS marked,
          (length(concat_ws('|', left(coalesce(text, ''), 3), lang)) + len(string_split(coalesce(text, ''), chr(10))))::INT AS longer,
          len(string_split(coalesce(text, ''), chr(10)))::INT AS lines, true AS branch_kept FROM documents""",
    "appended_rows": _with("questions", f"SELECT id, {TYPE} AS question_type FROM questions"),
    "provenance": """
        SELECT c.column, c.type, c.source, c.is_new, CASE WHEN c.column = 'question_words' THEN 0 ELSE n END AS filled,
          n AS rows
        FROM (SELECT count(*) AS n FROM events), (VALUES ('id', 'bigint', 'raw data', false),
          ('question', 'string', 'raw data', false),
          ('question_type', 'string', 'tier 1 feature of question', true),
          ('question_words', 'int', 'tier 1 feature of question', true)) c("column", type, source, is_new)""",
    "open_by_name": _with("questions", "SELECT id, question FROM questions"),
    "overwritten_table": _with("qa", "SELECT conv_id * 1000 + turn AS id, answer FROM qa"),
    "model_feature": MODEL_SQL,
    "packed_model_feature": MODEL_SQL,
    "incremental_features": _with("questions", f"SELECT {TYPE} AS question_type, count(*) AS count FROM questions GROUP BY 1"),
    "stream_dedup": _with("rasters", "SELECT DISTINCT dhash FROM hashed", **_hashed("rasters")),
    # sources and small reads
    "stream_near_dedup": _with("bumped_rasters", """
        SELECT vec_id, dhash FROM arrived a WHERE dhash IS NULL OR NOT EXISTS (
          SELECT 1 FROM arrived b WHERE b.dhash IS NOT NULL AND bit_count(xor(a.number, b.number)) <= 3
            AND (b.vec_id % 3 < a.vec_id % 3 OR b.vec_id % 3 = a.vec_id % 3 AND b.vec_id < a.vec_id))""",
        **_hashed("bumped_rasters"),
        arrived="SELECT vec_id, number, CASE WHEN vec_id % 29 <> 0 THEN dhash END AS dhash FROM hashed"),
    "stream_dedup_watermark": "SELECT DISTINCT user_id, event_type FROM events",
    "dataset_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) AS rows FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                  "embeddings", "pages", "benchmark", "labels", "conversations")
    ),
    "sidecar_metadata": "SELECT 'text_dense' AS slice, count(*) AS rows, 0 AS absent FROM documents",
    "parquet_mirror": "SELECT doc_id, lang, md5(text) AS digest FROM documents",
    "sequential_scan": "SELECT count(*) AS rows, least(count(*), 8) AS largest_batch FROM documents",
    "head_projection": f"""
        SELECT doc_id, lang, array_to_string({WORDS.format('text')}[1:8], ' ') AS start
        FROM documents ORDER BY doc_id LIMIT 4""",
    "query_row_pick": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 1 OFFSET 11",
    "take_batches": """
        SELECT batch::INT AS batch, doc_id FROM (SELECT batch, doc_id, row_number() OVER (PARTITION BY batch
          ORDER BY md5('0|' || batch || '|' || doc_id), doc_id) AS place FROM documents, range(20) b(batch))
        WHERE place <= 8""",
    "take_by_ids": """
        SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY batch
          ORDER BY md5('0|' || batch || '|' || doc_id), doc_id) AS place FROM documents, range(20) b(batch))
        WHERE place <= 8""",
    "table_take": _with("questions", f"""
        SELECT id, question, {TYPE} AS question_type FROM (SELECT *, row_number() OVER (PARTITION BY batch
          ORDER BY md5('0|' || batch || '|' || id), id) AS place FROM questions, range(20) b(batch)) WHERE place <= 8"""),
    "row_index": "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents",
    # text and profiling
    "qtype_v1_counts": _with("questions", f"SELECT {COARSE} AS qtype, count(*) AS count FROM questions GROUP BY 1"),
    "ascending_counts": "SELECT lang, count(*) AS count FROM documents GROUP BY lang ORDER BY count, lang",
    "text_lengths": f"""
        SELECT doc_id, len({WORDS.format('text')})::INT AS words, length(text)::INT AS characters FROM documents""",
    "null_defaults": _with("qa tokens", """
        SELECT part, count(*) AS rows, count(*) FILTER (n = 0) AS empty, sum(n)::BIGINT AS total FROM counted GROUP BY part""",
        counted=f"""SELECT 'answer' AS part, len({WORDS.format("coalesce(answer, '')")}) AS n FROM qa
          UNION ALL SELECT 'tokens', coalesce(len(ocr_tokens), 0) FROM tokens"""),
    "word_count_histogram": _with("qa", """
        SELECT bin::INT AS bin, count(n) AS count FROM range(9) b(bin) LEFT JOIN counted ON n = bin GROUP BY bin""",
        counted=f"SELECT least(len({WORDS.format('''coalesce(answer, '')''')}), 8) AS n FROM qa"),
    "token_histogram_20": _with("tokens", """
        SELECT i::INT AS bin, lo + i * (hi - lo)::DOUBLE / 20 AS "left", lo + (i + 1) * (hi - lo)::DOUBLE / 20 AS "right",
          (SELECT count(*) FROM capped WHERE least((n - lo) * 20 // (hi - lo), 19) = i) AS count
        FROM range(20) b(i), ends""",
        capped="SELECT least(coalesce(len(ocr_tokens), 0), 60) AS n FROM tokens",
        ends="SELECT min(n) AS lo, max(n) AS hi FROM capped"),
    "median_profile": _with("tokens qa", f"""
        SELECT 'ocr_n' AS column, trunc(median(coalesce(len(ocr_tokens), 0)))::BIGINT AS median FROM tokens UNION ALL
        SELECT 'answer_words', trunc(median(len({WORDS.format("coalesce(answer, '')")})))::BIGINT FROM qa"""),
    "profile_of_growing_table": """
        SELECT *, 1 AS parts_added FROM (
          SELECT 'lang' AS statistic, lang AS item, count(*) AS n FROM documents GROUP BY lang UNION ALL
          SELECT 'n_chars', n_chars::VARCHAR, count(*) FROM documents GROUP BY n_chars UNION ALL
          SELECT 'bin', least(n_chars // 500, 12)::VARCHAR, count(*) FROM documents WHERE n_chars IS NOT NULL GROUP BY ALL UNION ALL
          SELECT 'median', 'n_chars', trunc(median(n_chars))::BIGINT FROM documents UNION ALL
          SELECT 'distinct', 'n_chars', count(DISTINCT n_chars) FROM documents)""",
    "top_classes": _with("classes", """
        SELECT item, count(*) AS count, item || ' (' || count(*) || ')' AS label
        FROM (SELECT unnest(image_classes) AS item FROM classes) GROUP BY item ORDER BY count DESC, item LIMIT 8"""),
    "distinct_labels": "SELECT count(DISTINCT label) AS distinct_values, count(*) AS rows FROM embeddings",
    "list_prefix_text": _with("tokens", "SELECT id, coalesce(array_to_string(ocr_tokens[1:8], ' '), '') AS start FROM tokens"),
    "normalise_text": f"SELECT conv_id, turn, {_norm('text')} AS normalised FROM conversations",
    "prompts": _with("qa", f"""
        SELECT conv_id, turn, question || chr(10) || chr(10) || '{ANSWER_HINT}' AS prompt FROM qa"""),
    # vector search
    "knn_single": f"""
        SELECT vec_id, label, round(distance, 6) AS distance, printf('d=%.2f', distance) AS shown FROM (
          SELECT c.vec_id, c.label, sqrt({DISTANCE}) AS distance FROM embeddings c,
            (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1 OFFSET 11) q)
        ORDER BY distance, vec_id LIMIT 5""",
    "knn_batch": f"""
        SELECT query_id, rank::INT AS rank, neighbour_id, round(sqrt(gap), 6) AS distance FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY gap, neighbour_id) AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id, {DISTANCE} AS gap FROM embeddings q, embeddings c))
        WHERE rank <= 5""",
    "knn_batch_blocks": f"""
        SELECT query_id, rank::INT AS rank, neighbour_id, round(gap, 6) AS distance FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY gap, neighbour_id) AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id, {DISTANCE} AS gap FROM embeddings q, embeddings c))
        WHERE rank <= 5""",
    "knn_cells": _with("", "SELECT * FROM cells_found", **CELLS),
    "knn_cells_blocks": _with("", "SELECT * FROM cells_found", **CELLS),
    "knn_cells_recall": _with("", """
        SELECT count(*) AS wanted, round(count(f.neighbour_id) / count(*)::DOUBLE, 9) AS recall
        FROM exact e LEFT JOIN cells_found f ON f.query_id = e.query_id AND f.neighbour_id = e.neighbour_id""", **CELLS,
        exact=f"""
        SELECT query_id, neighbour_id FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY gap, neighbour_id) AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id, {DISTANCE} AS gap FROM embeddings q, embeddings c
            WHERE q.vec_id % 20 = 0))
        WHERE rank <= 5"""),
    # scoring
    "answer_scores": _with("truths base tuned", """
        SELECT id, round(base_score, 6) AS base_score, round(tuned_score, 6) AS tuned_score FROM scored""", **SCORED),
    "accuracy_lift": _with("truths base tuned", """
        SELECT count(*) AS rows, round(avg(base_score), 6) AS base_accuracy, round(avg(tuned_score), 6) AS tuned_accuracy,
          round((avg(tuned_score) - avg(base_score)) * 100, 6) AS lift_points,
          count(*) FILTER (tuned_score > base_score) AS wins FROM scored""", **SCORED),
    "formatted_scores": _with("truths base tuned", """
        SELECT printf('%.3f', avg(base_score)) AS base, printf('%.3f', avg(tuned_score)) AS tuned,
          printf('%+.1f pp', (avg(tuned_score) - avg(base_score)) * 100) AS lift FROM scored""", **SCORED),
    "eval_table": _with("truths base tuned", """
        SELECT id, question, base, tuned, array_to_string(answers[1:5], ', ') AS truths,
          tuned_score > base_score AS tuned_wins FROM scored""", **SCORED),
    "eval_head": _with("truths base tuned", """
        SELECT id, base, tuned, tuned_score > base_score AS tuned_wins FROM scored ORDER BY id LIMIT 256""", **SCORED),
    "truth_matches": _with("truths base tuned", """
        SELECT round(tuned_score, 6) AS score, count(*) AS count FROM scored GROUP BY 1""", **SCORED),
    # images
    "dhash_hex": _with("rasters", "SELECT vec_id, dhash FROM hashed", **_hashed("rasters")),
    "image_dhash": _with("", """
        SELECT vec_id, coalesce(dhash, '0000000000000000') AS dhash FROM embeddings LEFT JOIN hashed USING (vec_id)""",
        **PICTURE, **_hashed("shrunk")),
    "dup_groups": _with("rasters", """
        SELECT dhash, count(*) AS rows, min(vec_id) AS representative FROM hashed GROUP BY dhash""", **_hashed("rasters")),
    "dup_members": _with("rasters", """
        SELECT vec_id, min(vec_id) OVER g AS representative, count(*) OVER g AS group_rows FROM hashed
        WINDOW g AS (PARTITION BY dhash)""", **_hashed("rasters")),
    "dup_summary": _with("rasters", """
        SELECT count(DISTINCT dhash) AS distinct_hashes, count(*) AS rows, count(*) - count(DISTINCT dhash) AS repeated_rows
        FROM hashed""", **_hashed("rasters")),
    "hamming_pairs": _with("rasters", _pairs(3), **_hashed("rasters"), groups=GROUPS),
    "hamming_pairs_fine": _with("fine_rasters", _pairs(18), **_hashed("fine_rasters"), groups=GROUPS),
    "hamming_pairs_crowded": _with("bumped_rasters", _pairs(3), **_hashed("bumped_rasters"), groups=GROUPS),
    # curation and training
    "text_dense_quarter": _with("tokens", """
        SELECT id FROM (SELECT id, row_number() OVER (ORDER BY coalesce(len(ocr_tokens), 0) DESC, md5('0|' || id), id) AS place
          FROM tokens) WHERE place <= (SELECT floor(count(*) * 0.25) FROM tokens)"""),
    "holdout_split": """
        SELECT doc_id, CASE WHEN ('0x' || substr(md5('split|' || doc_id), 1, 6))::BIGINT % 1000 < 400
          THEN 'val' ELSE 'train' END AS split FROM documents""",
    "holdout_by_group": _with("bumped_rasters", """
        SELECT vec_id, CASE WHEN ('0x' || substr(md5('split|' || coalesce('group ' || grp, vec_id::VARCHAR)), 1, 6))::BIGINT % 1000 < 400
          THEN 'val' ELSE 'train' END AS split
        FROM hashed LEFT JOIN (SELECT number, min(reached) AS grp FROM linked GROUP BY number) USING (number)""".replace(
            "FROM hashed LEFT", "FROM (SELECT vec_id, CASE WHEN vec_id % 29 <> 0 THEN number END AS number FROM hashed) LEFT"),
        **_hashed("bumped_rasters"),
        distinct_hashes="""
        SELECT DISTINCT number, CASE WHEN number >= 9223372036854775808 THEN (number::HUGEINT - 18446744073709551616)::BIGINT
          ELSE number::BIGINT END AS signed FROM hashed WHERE vec_id % 29 <> 0""",
        linked="""
        SELECT number, signed AS reached FROM distinct_hashes UNION
        SELECT h.number, l.reached FROM linked l JOIN distinct_hashes o ON o.number = l.number
          JOIN distinct_hashes h ON bit_count(xor(h.number, o.number)) <= 3"""),
    "windowed_epoch": _with("training_rows", """
        SELECT epoch::INT AS epoch, batch, count(*)::INT AS n, string_agg(id::VARCHAR, ' ' ORDER BY rank) AS ids,
          string_agg(array_to_string(labels, ' '), ' ' ORDER BY rank) AS labels,
          round(sum(vision_tower_hiddens[11]::DOUBLE), 6) AS corner_sum FROM placed GROUP BY epoch, batch""", **WINDOWED),
    "epoch_permutation": f"""
        SELECT epoch::INT AS epoch, doc_id, {RANKED.format(seed=0, key='doc_id')} AS rank FROM documents, range(3) e(epoch)""",
    "micro_batches": f"""
        SELECT epoch::INT AS epoch, doc_id, (rank - 1) // 3 AS batch FROM (
          SELECT epoch, doc_id, {RANKED.format(seed=42, key='doc_id')} AS rank FROM documents, range(2) e(epoch))""",
    "whole_epoch_schedule": """
        WITH size AS (SELECT ceil(count(*) / 2.0)::BIGINT AS per_epoch, count(*) AS n FROM documents),
        steps AS (SELECT e::INT AS epoch, b AS batch, least(2, n - 2 * b) AS samples, (e * per_epoch + b) // 4 + 1 AS s, per_epoch
                  FROM size, range(2) r(e), unnest(range(per_epoch)) u(b))
        SELECT epoch, batch, samples, CASE WHEN s <= 2 * per_epoch // 4 THEN s END AS step FROM steps""",
    "accum_schedule": _with("", "SELECT * FROM schedule", **SCHEDULE),
    "progress_steps": _with("", """
        SELECT step, sum(samples)::BIGINT AS samples FROM schedule WHERE step % 10 = 0 OR step = 300 GROUP BY step""",
        **SCHEDULE),
    "collated_batches": _batches(3, 2, RANKED.format(seed=42, key="id")),
    "unshuffled_batches": _batches(8, 1, "row_number() OVER (ORDER BY id)"),
    "sft_struct_or_flat": _with("training_rows", f"""
        SELECT id, layout, {_join('input_ids')} AS input_ids, {_join('attention_mask')} AS attention_mask,
          {_join('labels')} AS labels FROM training_rows, (VALUES ('flat'), ('struct')) l(layout)"""),
    "packed_tokens": PACKED,
    "packed_tokens_joined": PACKED,
    "token_vocabulary": _with("tokens", """
        SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) AS token_id
        FROM (SELECT unnest(ocr_tokens) AS token FROM tokens) GROUP BY token"""),
    "scatter_placeholders": _with("placeholder_rows", """
        SELECT id, p::INT AS pos, """ + ", ".join(f"""round(CASE WHEN ids[p+1] = 7
            THEN embedding[(len(list_filter(ids[1:p], lambda x: x = 7)) * 4 + {c + 1})::INT]::DOUBLE ELSE p + {c} END, 6) AS v{c}"""
            for c in range(4)) + " FROM placeholder_rows, range(16) r(p)"),
    "pad_check": _with("placeholder_rows", """
        SELECT id, slots::INT AS placeholders, given::INT AS vectors, slots = given AS matches FROM (
          SELECT *, CASE WHEN id % 5 = 0 THEN least(slots, 2) ELSE slots END AS given FROM (
            SELECT id, len(list_filter(ids, lambda x: x = 7)) AS slots FROM placeholder_rows))"""),
}
