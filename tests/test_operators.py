import collections
import hashlib
import itertools
import re
import statistics

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from accrete.functions.hashing import order_key
from accrete.operators import batches, curate, evaluate, lookup, neardup, profile, rank, readrate, search, tokens


def table(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- rank --------------------------------------------------------------------------------------


def test_prefix_grows_with_rows():
    assert [rank.prefix_length(n) for n in (0, 1, 500_000, 8_000_000, 8_000_001, 10**12, 10**15)] == [1, 1, 1, 1, 2, 5, 5]


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_hash_rank_is_the_sorted_position(spark, monkeypatch, digits):
    monkeypatch.setattr(rank, "prefix_length", lambda rows: digits)
    df = spark.range(500).withColumn("g", F.col("id") % 2).withColumn("k", order_key("s", F.col("id")))
    got = table(rank.hash_rank(df, "k", "id", groups=("g",)).select("g", "id", "rank"), "g", "id")
    for g in (0, 1):
        ids = sorted((i for i in range(500) if i % 2 == g), key=lambda i: hashlib.md5(f"s|{i}".encode()).hexdigest())
        assert {i: p for gg, i, p in got if gg == g} == {i: n + 1 for n, i in enumerate(ids)}


def test_hash_rank_shuffles_the_rows_once(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).withColumn("k", order_key("s", F.col("id")))
        text = plan(rank.hash_rank(df, "k", "id", rows=1000))
        # rows by bucket, counts by bucket, bucket counts to one task for the running sum, offsets by bucket
        assert text.count("Exchange hashpartitioning(_bucket") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sorted_rank(spark):
    values = [5, 3, 3, 9, 1, 7, 7, 7]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int").repartition(4)
    got = {r.i: r["rank"] for r in rank.sorted_rank(df, [F.col("v").desc(), "i"]).collect()}
    want = sorted(range(8), key=lambda i: (-values[i], i))
    assert got == {i: n + 1 for n, i in enumerate(want)}


def test_cumulative_crosses_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([(g, v, (v + g) % 4 + 1) for g in (0, 1) for v in range(-7, 40)], "g int, v bigint, n bigint")
        assert rank._placed(df, ["g", "v"]).select("_part").distinct().count() > 4
        running = table(rank.cumulative(df, "v", "n", groups=("g",)).select("g", "v", "n", "below", "upto"), "g", "v")
        for g in (0, 1):
            below = 0
            for _, v, n, lo, hi in (r for r in running if r[0] == g):
                assert (lo, hi) == (below, below + n)
                below += n
        one = df.where("g = 0").drop("g")
        down = table(rank.cumulative(one, "v", "n", descending=True), F.col("v").desc())
        assert down[0][2] == 0 and down[-1][3] == sum(r[1] for r in down)
        assert all(a[3] == b[2] for a, b in zip(down, down[1:]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


# ---- profile -----------------------------------------------------------------------------------


def test_value_counts_order(spark):
    df = spark.createDataFrame([(x,) for x in "bbaac"], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [r.v for r in profile.value_counts(df, "v", ascending=True).collect()] == ["c", "a", "b"]


@pytest.mark.parametrize("values", [[1], [1, 2], [4, 1, 9], [1, 1, 1, 9], [0, 1475, 1476, 5000], [-3, -2], [2] * 50 + [7] * 50])
def test_median_truncates(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    assert profile.int_medians(df, ["v"]).first().median == int(statistics.median(values))


def test_clipped_histogram_matches_numpy(spark):
    values = [0, 0, 3, 8, 9, 100, 8, 7]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    want = np.histogram(np.clip(values, None, 8), bins=range(0, 10))[0].tolist()
    assert [r["count"] for r in profile.clipped_histogram(df, "v", 8).collect()] == want


@pytest.mark.parametrize("values", [[1, 5, 60, 61, 99, 3], [4, 4, 4], list(range(60)), [0, 59], [-5, 12, 13]])
def test_equal_width_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    count, edges = np.histogram(np.clip(values, None, 60), bins=20)
    got = profile.equal_width_histogram(df, "v", 20, cap=60).collect()
    assert [r["count"] for r in got] == count.tolist()
    assert [r["left"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_top_items_skip_null_lists(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,), (["b"],), ([],)], "l array<string>")
    assert [tuple(r) for r in profile.top_items(df, "l", 8).collect()] == [("b", 2, "b (2)"), ("a", 1, "a (1)")]


def test_distinct_and_coverage(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "a int, b int")
    assert tuple(profile.distinct_count(df, "a").first()) == (1, 3)
    assert profile.distinct_count(df, "a", approximate=True).first()[0] == 1
    assert table(profile.coverage(df, ["a", "b"]), "column") == [("a", 2, 3), ("b", 2, 3)]


# ---- lookup ------------------------------------------------------------------------------------


def test_balanced_lookup_with_hot_and_cold_keys(spark):
    values = ["hot"] * 3000 + [f"k{i}" for i in range(2000)] + ["gone"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, k string")
    sizes = df.groupBy("k").count().where("k <> 'gone'").withColumn("len", F.length("k"))
    got = lookup.balanced_lookup(df, sizes, "k", "count").collect()
    assert sorted(r.i for r in got) == list(range(len(values)))
    assert all(r.len == (None if r.k == "gone" else len(r.k)) for r in got)


def test_balanced_lookup_joins_on_the_salt(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).select("id", F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"))
        sizes = df.groupBy("k").count().withColumn("double", F.col("k") * 2)
        found = lookup.balanced_lookup(df, sizes, "k", "count")
        text = plan(found)
        assert re.search(r"SortMergeJoin \[k#\d+L?, _salt#\d+\]", text) and "BroadcastHashJoin" in text
        assert re.search(r"hashpartitioning\(k#\d+L?, _salt#\d+, ", text)
        assert found.where("double = k * 2").count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_take_rows_keeps_order_and_repeats(spark, monkeypatch):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    assert [r.v for r in lookup.take_rows(df, [7, 3, 7, 500], "id", ["v"]).collect()] == [14, 6, 14]
    assert lookup.take_rows(df, [], "id", ["v"]).count() == 0
    monkeypatch.setattr(lookup, "RANGES", 1)
    assert [r.v for r in lookup.take_rows(df, [7, 3, 7, 500], "id", ["v"]).collect()] == [14, 6, 14]


# ---- search ------------------------------------------------------------------------------------


def brute(queries, corpus, k):
    out = {}
    for q, v in queries:
        out[q] = [i for _, i in sorted((float(((v - w) ** 2).sum()), i) for i, w in corpus)[:k]]
    return out


@pytest.mark.parametrize("spread", ["normal", "ties", "clustered", "few"])
@pytest.mark.parametrize("limit_bytes", [1 << 26, 0])
def test_nearest_each_equals_brute_force(spark, monkeypatch, spread, limit_bytes):
    monkeypatch.setattr(search, "PACKED_ROWS", 32)
    monkeypatch.setattr(search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(search, "CORPUS_BLOCK", 11)
    monkeypatch.setattr(search, "PIVOTS", 8)
    rng = np.random.default_rng(3)
    size = 3 if spread == "few" else 300
    if spread == "ties":
        points = rng.integers(0, 3, (size, 4)).astype(float)
    elif spread == "clustered":
        points = np.concatenate([rng.normal(0, 0.01, (size // 3, 4)), rng.normal(50, 9, (size - size // 3, 4))])
    else:
        points = rng.normal(size=(size, 4))
    data = [(i, p.tolist()) for i, p in enumerate(points)]
    corpus = spark.createDataFrame(data, "id bigint, v array<double>").repartition(5)
    queries = spark.createDataFrame(data[:60], "q bigint, w array<double>").repartition(3)
    got = collections.defaultdict(list)
    found = search.nearest_each(queries, corpus, "q", "w", "id", "v", 5, limit_bytes=limit_bytes)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.neighbour_id)
    assert got == brute([(i, points[i]) for i, _ in data[:60]], list(enumerate(points)), 5)


def test_nearest_single_is_a_top_k_plan(spark, plan):
    points = np.random.default_rng(0).normal(size=(50, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(99, None)], "id bigint, v array<float>")
    found = search.nearest(df, points[4].tolist(), "v", "id", 5)
    assert "TakeOrderedAndProject" in plan(found)
    assert [r.id for r in found.collect()] == brute([(0, points[4])], list(enumerate(points)), 5)[0]
    assert found.first()["_distance"] == pytest.approx(0, abs=1e-6)


def test_search_without_rows(spark):
    empty = spark.createDataFrame([], "id bigint, v array<double>")
    some = spark.createDataFrame([(1, [1.0])], "id bigint, v array<double>")
    for limit in (0, 1 << 20):
        assert search.nearest_each(empty, some, "id", "v", "id", "v", 3, limit_bytes=limit).count() == 0
        assert search.nearest_each(some, empty, "id", "v", "id", "v", 3, limit_bytes=limit).count() == 0


def test_pick_row(spark):
    assert search.pick_row(spark.range(40).repartition(3), 11, "id", []).id == 11


# ---- near duplicates ---------------------------------------------------------------------------


def brute_pairs(hashes, distance):
    count = collections.Counter(hashes)
    mask = (1 << 64) - 1
    return sorted(
        (a, b, ((a ^ b) & mask).bit_count(), count[a], count[b])
        for a, b in itertools.combinations(sorted(count), 2) if ((a ^ b) & mask).bit_count() <= distance
    )


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


@pytest.mark.parametrize("kind", ["spread", "one_cluster", "shared_half"])
@pytest.mark.parametrize("crowded", [2048, 20, 3])
def test_similar_hashes_equal_all_pairs(spark, monkeypatch, kind, crowded):
    monkeypatch.setattr(neardup, "BLOCK_HASHES", 16)
    rng = np.random.default_rng(5)
    seeds = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    hashes = []
    for _ in range(150):
        if kind == "one_cluster":
            h = seeds[0]
            flips = 3
        elif kind == "shared_half":
            h = (seeds[0] >> 32 << 32) | int(rng.integers(0, 1 << 32))
            flips = 0
        else:
            h = seeds[int(rng.integers(12))] * 2 + 1
            flips = int(rng.integers(5))
        for bit in rng.integers(0, 64, flips):
            h ^= 1 << int(bit)
        hashes.append(signed(h & ((1 << 64) - 1)))
    df = spark.createDataFrame([(h,) for h in hashes + hashes[:9]] + [(None,)], "dhash bigint")
    got = neardup.similar_hashes(df, distance=3, crowded=crowded).select("hash_a", "hash_b", "distance", "rows_a", "rows_b")
    assert sorted(tuple(r) for r in got.collect()) == brute_pairs(hashes + hashes[:9], 3)


def test_duplicate_groups_and_members(spark):
    hashes = [0] * 40 + [7, 7, 8]
    df = spark.createDataFrame(list(enumerate(hashes)), "id bigint, dhash bigint")
    assert table(neardup.duplicate_groups(df, "id"), "dhash") == [(0, 40, 0), (7, 2, 40), (8, 1, 42)]
    members = neardup.duplicate_members(df, "id").collect()
    assert sorted((r.id, r.representative, r.group_rows) for r in members) == sorted(
        (i, {0: 0, 7: 40, 8: 42}[h], {0: 40, 7: 2, 8: 1}[h]) for i, h in enumerate(hashes))
    assert tuple(neardup.duplicate_summary(df).first()) == (3, 43, 40)


# ---- curation ----------------------------------------------------------------------------------


@pytest.mark.parametrize("lengths", [list(range(40)), [5] * 40, [1] * 30 + [9] * 3 + [5] * 7, [0] * 3])
def test_dense_share_is_exact(spark, lengths):
    df = spark.createDataFrame([(i, ["x"] * n) for i, n in enumerate(lengths)], "id bigint, l array<string>")
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], hashlib.md5(f"0|{i}".encode()).hexdigest()))
    got = {r.id for r in curate.dense_share(df, "id", "l", 0.25).collect()}
    assert got == set(order[: len(lengths) // 4])


def test_dense_share_is_a_filter(spark, plan):
    df = spark.createDataFrame([(i, ["x"] * (i % 3)) for i in range(90)], "id bigint, l array<string>")
    text = plan(curate.dense_share(df, "id", "l", 0.25))
    assert "Exchange" not in text and "Join" not in text


def test_split_is_stable_under_append(spark):
    split = lambda n: {r.id: r.split for r in curate.holdout_split(spark.range(n), "id", 400).collect()}
    small, large = split(500), split(1000)
    assert all(large[i] == s for i, s in small.items())
    assert 300 < sum(s == "val" for s in large.values()) < 500


@pytest.mark.parametrize("rows,size", [(5, 8), (200, 8), (3000, 2)])
def test_random_batches(spark, rows, size):
    got = collections.defaultdict(set)
    for r in curate.random_batches(spark.range(rows), "id", 6, size, 1).collect():
        got[r.batch].add(r.id)
    for b in range(6):
        want = sorted(range(rows), key=lambda i: hashlib.md5(f"1|{b}|{i}".encode()).hexdigest())[:size]
        assert got[b] == set(want)


# ---- batches -----------------------------------------------------------------------------------


def test_epochs_are_permutations(spark):
    got = batches.epoch_order(spark.range(101), "id", 3, 7).collect()
    orders = []
    for e in range(3):
        one = sorted((r["rank"], r.id) for r in got if r.epoch == e)
        assert [p for p, _ in one] == list(range(1, 102)) and sorted(i for _, i in one) == list(range(101))
        orders.append([i for _, i in one])
    assert orders[0] != orders[1] != orders[2]
    again = batches.epoch_order(spark.range(101).repartition(7), "id", 3, 7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


@pytest.mark.parametrize("rows,size,accumulate,steps", [(7, 2, 4, 300), (600, 2, 4, 300), (1, 2, 4, 5), (10, 3, 2, 3)])
def test_schedule_follows_the_loop(spark, rows, size, accumulate, steps):
    epochs = batches.epochs_needed(rows, size, accumulate, steps)
    batched = batches.micro_batches(batches.epoch_order(spark.range(rows), "id", epochs), size)
    got = {(r.epoch, r.batch): (r.samples, r.step) for r in
           batches.accumulation_schedule(batched, rows, size, epochs, accumulate, steps).collect()}
    # The loop restated: steps are counted after every `accumulate` batches until `steps` are done.
    want, taken, group, step = {}, 0, [], 0
    for epoch in range(epochs):
        for start in range(0, rows, size):
            batch = (epoch, start // size)
            want[batch] = (min(size, rows - start), None)
            if step < steps:
                group.append(batch)
            if len(group) == accumulate:
                step += 1
                for b in group:
                    want[b] = (want[b][0], step)
                group = []
    assert got == want
    assert epochs == 10 or step == steps


def test_progress_rows(spark):
    schedule = spark.createDataFrame([(s // 2 + 1, 2) for s in range(50)] + [(None, 2)], "step bigint, samples bigint")
    assert table(batches.progress_steps(schedule, 25), "step") == [(10, 4), (20, 4), (25, 4)]


def test_token_columns():
    flat = ["id", "vision_tower_hiddens", "input_ids", "attention_mask", "labels"]
    assert batches.token_columns(flat) == flat[1:]
    assert batches.token_columns(["sft_tokens"]) == ["vision_tower_hiddens", "sft_tokens"]
    assert batches.token_columns([*flat, "sft_tokens"]) == flat[1:]
    assert batches.token_columns(["sft_tokens", "labels"]) == ["vision_tower_hiddens", "sft_tokens"]


def test_collate_rejects_short_rows(spark):
    df = spark.createDataFrame([(1, [1.0] * 4, [1, 2], [1, 1], [1])],
                               "id bigint, vision_tower_hiddens array<float>, input_ids array<int>, attention_mask array<int>, labels array<int>")
    ordered = batches.micro_batches(batches.epoch_order(df, "id"), 2)
    made = batches.collate(ordered, df, "id", batches.cached_fields(df.columns, 2, 2, 2))
    with pytest.raises(PySparkException, match="labels: expected 2 values, got 1"):
        made.collect()


# ---- tokens ------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit_bytes", [1 << 26, 0])
def test_token_ids(spark, limit_bytes):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, None), (3, []), (4, ["c", "a", "zz", "b"])], "id bigint, t array<string>")
    known = tokens.vocabulary(df, "t").where("token <> 'zz'")
    assert table(known.select("token", "token_id"), "token_id") == [("b", 1), ("a", 2), ("c", 3)]
    got = tokens.token_ids(df, "id", "t", known, 3, limit_bytes)
    assert table(got.select("id", "ids"), "id") == [(1, [1, 2, 1]), (2, []), (3, []), (4, [3, 2])]
    packed = tokens.packed_tokens(got.withColumn("start", F.lit(1)), 4, prompt_length="start")
    one = packed.where("id = 1").first()
    assert (one.input_ids, one.attention_mask, one.labels) == ([1, 2, 1, 0], [1, 1, 1, 0], [-100, 2, 1, -100])


def test_vocabulary_in_workers_is_flat(spark, monkeypatch):
    """No object per word travels; words that share a digest, and unknown tokens that share one, stay apart."""
    df = spark.createDataFrame([(1, ["ab", "b", None, "ax", "c" * 9]), (2, ["zz", "b", "ä"])], "id bigint, t array<string>")
    known = tokens.vocabulary(df, "t").where("token is null or token not in ('ax', 'zz')")
    numbers = {r["token"]: r["token_id"] for r in known.collect()}
    shipped, context = [], type(spark.sparkContext)
    broadcast = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: shipped.append(value) or broadcast(self, value))
    first = lambda token, salt: F.ascii(F.coalesce(F.col(token) if isinstance(token, str) else token, F.lit("0"))).cast("long") * salt
    for digest in (None, first):  # the second one: all words share a digest at first, then "ab" and "ax" do
        if digest is not None:
            monkeypatch.setattr(tokens, "_digest", digest, raising=False)
        got = dict(table(tokens.token_ids(df, "id", "t", known, 9), "id"))
        assert got == {1: [numbers["ab"], numbers["b"], numbers[None], numbers["c" * 9]], 2: [numbers["b"], numbers["ä"]]}
        assert all(isinstance(part, np.ndarray | pa.Array) for part in shipped[-1])


def test_placeholders(spark):
    schema = "id bigint, ids array<int>, e array<array<float>>, v array<array<float>>"
    data = [
        (1, [7, 1, 7], [[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]], [[5.0, 6.0], [8.0, 9.0]]),
        (2, [1, 2], [[3.0, 3.0], [4.0, 4.0]], []),
        (3, [7, 7], [[0.0, 0.0], [0.0, 0.0]], [[1.0, 2.0], [3.0, 4.0]]),
    ]
    df = spark.createDataFrame(data, schema)
    got = dict(table(tokens.fill_placeholders(df, "id", "ids", "e", "v", 7), "id"))
    assert got == {1: [[5, 6], [1, 1], [8, 9]], 2: [[3, 3], [4, 4]], 3: [[1, 2], [3, 4]]}
    assert [r.matches for r in tokens.placeholder_check(df, "id", "ids", "v", 7).collect()] == [True] * 3
    # One vector too many here, one too few there: totals agree, rows do not.
    uneven = spark.createDataFrame([(1, [7], [[0.0]], [[1.0], [2.0]]), (2, [7, 7], [[0.0], [0.0]], [[1.0]])], schema).coalesce(1)
    with pytest.raises(PySparkException, match="1 placeholders, 2 vectors"):
        tokens.fill_placeholders(uneven, "id", "ids", "e", "v", 7).collect()


# ---- evaluation and reading --------------------------------------------------------------------


def test_before_and_after(spark):
    truths = spark.createDataFrame([(1, "q", ["x"] * 3), (2, "r", ["y", "z"])], "id int, question string, answers array<string>")
    base = spark.createDataFrame([(1, "no"), (2, None)], "id int, prediction string")
    tuned = spark.createDataFrame([(2, "Y."), (1, "the x")], "id int, prediction string")
    scores = evaluate.scored(truths, base, tuned, "id")
    assert tuple(evaluate.accuracy(scores).first()) == pytest.approx((2, 0.0, 2 / 3, 200 / 3, 2))
    assert tuple(evaluate.accuracy_text(evaluate.accuracy(scores)).first()) == ("0.000", "0.667", "+66.7 pp")
    shown = table(evaluate.comparison(scores, "id", "question").select("id", "truths", "tuned_wins"), "id")
    assert shown == [(1, "x, x, x", True), (2, "y, z", True)]


def test_read_rates(spark):
    df = spark.range(100).withColumn("v", F.col("id") + 1)
    assert readrate.sequential_rate(df, ["v"], 8)[0] == 100
    rows, rate = readrate.shuffled_rate(df, "id", ["v"], batches=3, batch_size=4)
    assert rows == 12 and rate > 0
    assert readrate.epoch_rate(df, "id", ["v"], 8)[0] == 100
