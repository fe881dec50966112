"""What a Python worker holds, and how many of them a task takes."""

import tracemalloc

import numpy as np
import pyarrow as pa

from accrete.llm import packing, simhash, terms, token_files
from accrete.llm.queries import vocabulary
from accrete.llm.simhash import simhash_groups
from accrete.llm.terms import BETWEEN_BLANKS, Summed, Terms, counted
from accrete.operators import components


def _peak(work):
    """MB that numpy and Python take at once."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_one_python_worker_a_task_of_links(spark, plan, monkeypatch):
    seen, put = [], components.staged
    monkeypatch.setattr(components, "staged", lambda df, label: (seen.append((label, plan(df))), put(df, label))[1])
    base = "one two three four five six seven eight nine ten"
    rows = [(i, base) for i in range(3)] + [(9, "something else entirely that is here"), (10, None), (11, "")]
    found = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {0: 0, 1: 0, 2: 0, 9: 9, 10: 10, 11: 10}
    label, first = seen[0]
    assert label == "edges" and first.count("MapInArrow") == 1


def test_links_and_trees_of_links_have_the_same_components(spark):
    random = np.random.default_rng(7)
    values = random.integers(-(1 << 62), 1 << 62, 60)
    near = np.concatenate([values] + [values ^ (1 << int(b)) for b in random.integers(0, 62, 4)])
    classes = spark.createDataFrame([(int(v),) for v in np.unique(near)], "fp long")
    whole = components.components(simhash.close_pairs(classes))
    trees = components.components(simhash.close_pairs(classes, trees=True), contracted=True)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, trees.collect()))
    assert simhash.close_pairs(classes, trees=True).count() <= simhash.close_pairs(classes).count()


def test_digests_take_a_few_times_the_window(monkeypatch):
    raw = np.frombuffer(b"some words of it " * 100_000, np.uint8)
    start = np.flatnonzero((raw != 32) & np.concatenate([[True], raw[:-1] == 32]))
    stop = np.flatnonzero((raw != 32) & np.concatenate([raw[1:] == 32, [True]])) + 1
    monkeypatch.setattr(terms, "_powers", terms._Powers())
    assert _peak(lambda: terms.digests(raw, start, stop)) < 8e-6 * len(start) + 25
    # A term is the same one wherever a window begins, and a long one is whole.
    column = pa.array(["x" * (1 << 20) + " a b", "a " + "x" * (1 << 20), "b " * 300_000 + "a"])
    found = Terms(column, BETWEEN_BLANKS).digest
    assert found[0] == found[4] and found[1] == found[3] == found[-1] and len(np.unique(found)) == 3


def test_sums_take_little_besides_what_is_held():
    random = np.random.default_rng(3)
    columns = [random.integers(0, 1 << 62, 100_000).astype(np.uint64) for _ in range(3)] + [np.ones(100_000, np.int64)]

    def work():
        summed = Summed(["a", "b", "c", "n"], 3, most=1_000_000)
        for _ in range(10):
            last = None
            for last in summed.add(*(c.copy() for c in columns[:3]), columns[3] + 0):
                pass
        for last in summed.rest():
            pass

    assert _peak(work) < 75  # 32 of them held


def test_sums_are_those_of_counted():
    random = np.random.default_rng(5)
    keys = [random.integers(0, 9, 250_000).astype(np.uint64), random.integers(0, 40_000, 250_000)]
    n = random.integers(1, 5, 250_000)
    summed, out = Summed(["a", "b", "n"], 2, most=60_000), []
    for at in range(0, 250_000, 25_000):
        out += summed.add(*(k[at : at + 25_000] for k in keys), n[at : at + 25_000])
    out += summed.rest()
    assert max(b.num_rows for b in out) <= 100_000 and not list(summed.rest())
    found = [np.concatenate([b.column(i).to_numpy() for b in out]) for i in range(3)]
    (a, b), (total,) = counted(found[:2], found[2:])
    (c, d), (expected,) = counted(keys, [n])
    assert (a == c.astype(np.int64)).all() and (b == d).all() and (total == expected).all()


def test_texts_reach_the_encoder_in_small_slices(monkeypatch):
    sizes = []

    class Encoder:
        def encode(self, texts):
            sizes.append(sum(len(t) for t in texts.to_pylist()))
            return np.zeros(len(texts), "<u2"), np.arange(1, len(texts) + 1)

    monkeypatch.setattr(packing, "column_encoder", lambda *a: Encoder())
    caught = {}

    class Rows:
        def selectExpr(self, *_):
            return self

        def mapInArrow(self, run, schema):
            caught["run"] = run

    packing.cut_documents(Rows(), vocabulary("byte_bpe_50k.json"), 2048)
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(["x" * 1000] * 2000)], ["doc_id", "text"])
    assert sum(b.num_rows for b in caught["run"](iter([batch]))) == 2000
    assert max(sizes) <= 501_000 and sum(sizes) == 2_000_000


def test_texts_of_token_files_reach_the_encoder_in_small_slices(monkeypatch):
    sizes, caught = [], {}

    class Encoder:
        def encode(self, texts):
            sizes.append(sum(len(t) for t in texts.to_pylist()))
            return np.zeros(len(texts), "<u2"), np.arange(1, len(texts) + 1)

    class Rows:
        def selectExpr(self, *_):
            return self

        def mapInArrow(self, run, schema):
            caught["run"] = run

    monkeypatch.setattr(token_files, "column_encoder", lambda *a: Encoder())
    token_files.token_table(Rows(), vocabulary("word_bpe_49k.json"), 2)
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(["x" * 1000] * 2000)], ["doc_id", "text"])
    assert sum(b.num_rows for b in caught["run"](iter([batch]))) == 2000
    assert max(sizes) <= 501_000 and sum(sizes) == 2_000_000


def test_token_files_are_read_by_few_tasks(spark, tmp_path):
    few = {"spark.sql.shuffle.partitions": "48", "spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "1m"}
    kept = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame([(i, f"some words {i}") for i in range(480)], "doc_id long, text string")
        token_files.write_token_files(docs, vocabulary("word_bpe_49k.json"), str(tmp_path / "files"))
        written = len(list((tmp_path / "files/blocks").glob("part-*")))
        found = token_files.read_token_files(spark, str(tmp_path / "files"))
        tasks, rows = found.rdd.getNumPartitions(), found.orderBy("doc_id").collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "files/ranks").glob("part-*"))) == 1
    assert written > 40 and tasks <= max(spark.sparkContext.defaultParallelism, -(-written // 4)) < written
    assert [r["doc_id"] for r in rows] == list(range(480))
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1]]
