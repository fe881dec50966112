"""Registered queries of the subpackage against their SQL, and the pipeline against brute force."""

import glob
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
import corpus_pipeline
from accrete.llm.oracle import ORACLE
from accrete.llm.queries import QUERIES, vocabulary
from accrete.llm.tokenizing import tokenizer
from accrete.session import staged
from test_llm import brute_fingerprint, brute_words, within_one_edit

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.engine(FOLDER), FOLDER, name) is None


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_gives_every_document(spark, name):
    rows = contract.queries()[name](spark, FOLDER).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = contract.queries()["op4_language_id"](spark, folder).join(docs, "doc_id").where("held_out")
    right, rows = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert rows > 200 and right > 0.98
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    scored = contract.queries()["op10_toxicity"](spark, folder).join(labels, "doc_id")
    assert scored.where("predicted = 1").agg(F.avg("toxic")).first()[0] > 0.9


def line_dedup(docs):
    earlier, kept = [], {}
    for doc_id, text in sorted(docs.items()):
        lines = []
        for line in text.split("\n"):
            t = line.strip(" \t\r\f\x0b")
            seen = t in earlier or len(t) >= 20 and any(abs(len(e) - len(t)) < 2 and len(e) >= 20 and within_one_edit(e, t) for e in earlier)
            if not t or not seen:
                lines.append(line)
            if t and t not in earlier:
                earlier.append(t)
        kept[doc_id] = "\n".join(lines)
    return kept


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, outputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), name)
        outputs.append(docs)
    assert all(df.columns == columns for df in outputs[:-1])
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in outputs[:-1]]
    source = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}

    assert texts[0] == {i: t for i, t in source.items() if t and any(c.isalpha() for c in t)}
    assert texts[1] == line_dedup(texts[0])

    ids = sorted(texts[1])
    prints = np.array([brute_fingerprint(texts[1][i]) for i in ids], np.uint64)
    group = np.arange(len(ids))
    for _ in range(len(ids)):
        new = np.array([group[np.bitwise_count(prints ^ p) <= 3].min() for p in prints])
        if (new == group).all():
            break
        group = new
    assert texts[2] == {i: texts[1][i] for n, i in enumerate(ids) if group[n] == n}

    windows = set()
    for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = brute_words(row["text"])
        windows |= {tuple(w[s : s + 10]) for s in range(max(len(w) - 9, 1))} if w else set()

    def hit(text):
        w = brute_words(text)
        return any(tuple(w[s : s + n]) in windows for n in {len(x) for x in windows} for s in range(len(w) - n + 1))

    assert texts[3] == {i: t for i, t in texts[2].items() if not hit(t)}

    pieces, sequences = defaultdict(dict), defaultdict(list)
    for r in outputs[4].collect():
        pieces[r["doc_id"]][r["piece"]] = r["ids"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    encode = tokenizer(vocabulary("byte_bpe_50k.json")).encode
    assert set(pieces) == set(texts[3])
    for i, text in texts[3].items():
        whole = np.frombuffer(b"".join(pieces[i][p] for p in sorted(pieces[i])), "<u4").tolist()
        assert whole == encode(text, add_special_tokens=False).ids + [0]
    for places in sequences.values():
        ends = [0, *(o + n for o, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048
    assert glob.glob(f"{FOLDER}/*.parquet")


def test_stages_on_odd_and_empty_tables(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, and columns with names used inside."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(30)
    texts = [None, "", "  \n", "1234 5678", "a", "word " * 30_000, "x" * 30_000, "one line\none line\nanother line here"]
    odd = [(9000 + i, t, "en", None, None) for i, t in enumerate(texts)]
    odd += [(None, "no id at all", "en", "s", 3), (None, None, None, None, None), (9007, texts[7], "en", None, None), (9020, texts[7], None, None, None)]
    docs = given.unionByName(spark.createDataFrame(odd, given.schema))
    docs = docs.select("*", *(F.lit(5).alias(c) for c in ("row", "key", "id", "n", "length", "fp", "lines", "_row")))
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), name)
        kept.append([(r["doc_id"], r["text"] if "text" in docs.columns else r["length"]) for r in docs.collect()])
        if name != "best_fit_packing":
            assert docs.columns == columns and docs.where("row <> 5 or length <> 5").count() == 0
    ids = [[i for i, _ in rows] for rows in kept]
    assert not {9000, 9001, 9002, 9003} & set(ids[0]) and {9004, 9005, 9006, None} <= set(ids[0]) and ids[0].count(9007) == 2
    assert sorted(ids[1], key=repr) == sorted(ids[0], key=repr)
    assert dict(kept[1])[9020] == "" and "one line\nanother line here" in [t for i, t in kept[1] if i == 9007]
    assert set(ids[3]) <= set(ids[2]) <= set(ids[1]) and set(ids[4]) == set(ids[3])
    assert all(0 < n <= 2048 for _, n in kept[4])
    empty = given.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, FOLDER), name)
        assert empty.count() == 0
