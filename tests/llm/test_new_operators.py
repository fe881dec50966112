"""Suffix tree, mask search and source audit against brute force, and on odd input."""

import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from accrete.llm import mask_search, source_audit, suffix_tree
from accrete.llm.folds import held_out
from accrete.llm.queries import op11_suffix_tree

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "alpha beta gamma " * 40_000
ODD = ["", " ", "\t\n", None, "a", "A a É é ÉÉ", "x" * 5000, "end. The END", "ß ﬁ İ Σς", "a\x00b\x1fc", "日本 語", LONG, LONG, "a"]


def lowered(text):
    return (text or "").translate(LOWER)


# ---- suffix tree ---------------------------------------------------------------------------------


def lines(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered(text)) if w] + ["</s>"]


class BruteTree:
    """The same definition with plain dictionaries, contexts as tuples of words, oldest first."""

    def __init__(self, texts, depth, share, least, gain):
        lists = [["<s>", *lines(t)] for t in texts]
        self.depth = depth
        runs = Counter(tuple(w[i : i + k]) for w in lists for k in range(1, depth + 2) for i in range(len(w) - k + 1))
        words = {r[0]: n for r, n in runs.items() if len(r) == 1 and r[0] != "<s>"}
        self.words, self.total = words, sum(words.values())
        self.off = (sum(n == 1 for n in words.values()) + 0.5) / (len(words) + 1)
        self.unseen = self.off * len(words) / self.total if words else 1.0
        least = max(least, math.ceil(share * self.total))
        own = defaultdict(dict)
        for r, n in runs.items():
            if len(r) > 1 and n >= least:
                own[r[:-1]][r[-1]] = n
        self.tables = {}
        for s in sorted(own, key=len):
            rest = 1 - sum(n - suffix_tree.DISCOUNT for n in own[s].values()) / runs[s]
            self.tables[s] = (rest, {w: (n - suffix_tree.DISCOUNT) / runs[s] + rest * self.p(s[1:], w) for w, n in own[s].items()})
        self.kept = set()
        for s in sorted(own, key=len, reverse=True):
            rest, p = self.tables[s]
            gained = sum(n * math.log(p[w] / self.p(s[1:], w)) for w, n in own[s].items())
            gained += (runs[s] - sum(own[s].values())) * math.log(rest)
            if gained > gain * (len(p) + 1) or s in self.kept:
                self.kept.update(s[i:] for i in range(len(s)))

    def p(self, s, w):
        if not s:
            return (self.words[w] - self.off) / self.total if w in self.words else self.unseen
        if s not in self.tables:
            return self.p(s[1:], w)
        rest, p = self.tables[s]
        return p[w] if w in p else rest * self.p(s[1:], w)

    def score(self, text):
        w, total = ["<s>", *lines(text)], 0.0
        for i in range(1, len(w)):
            states = [tuple(w[i - k : i]) for k in range(min(self.depth, i), 0, -1)]
            total += math.log10(self.p(next((s for s in states if s in self.kept), ()), w[i]))
        return total

    def base(self, text):
        return sum(math.log10((self.words.get(w, 0) + 1) / (self.total + len(self.words) + 1)) for w in lines(text))


@pytest.mark.parametrize("held", [10**6, 3])
def test_suffix_tree_equals_brute_force(spark, held):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (None, None)], "doc_id long, text string")
    docs = documents.unionByName(odd).withColumn("held_out", held_out("doc_id", 7, 2))
    # Columns named like those used inside change nothing.
    docs = docs.select("*", *(F.lit(1).alias(c) for c in ("at", "other", "score", "row", "n")))
    share = 0.02 if held == 3 else 1e-5
    tree = suffix_tree.learn_suffix_tree(docs.where("not held_out"), share=share, least=3, gain=1.0, held_words=held)
    assert (tree.rest is not None) == (held == 3)
    rows = docs.collect()
    brute = BruteTree([r["text"] for r in rows if not r["held_out"]], 3, share, 3, 1.0)
    assert len(tree.nodes) == len(brute.kept) and (held == 3 or len(brute.kept) > 50 and max(map(len, brute.kept)) == 3)
    found = tree.score(docs)
    assert found.columns == ["doc_id", "held_out", "at", "other", "row", "n", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def key(r):
        return repr(r[0]), r[1], r[2], r[3]

    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found.collect()), key=key)
    want = sorted(((r["doc_id"], len(lines(r["text"])), sum(w in brute.words for w in lines(r["text"])), brute.total,
                    brute.base(r["text"]), brute.score(r["text"])) for r in rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


def test_suffix_tree_probabilities_add_up(spark):
    texts = ["a b a b a b c", "a b a b", "b a c a b a b", "c"] * 3
    brute = BruteTree(texts, 3, 0.0, 2, 0.1)
    assert brute.kept
    for s in ((), *brute.kept):
        # <s> is never a symbol; all unseen words are one.
        assert sum(brute.p(s, w) for w in brute.words) + brute.p(s, "unseen") == pytest.approx(1.0)
    tree = suffix_tree.learn_suffix_tree(spark.createDataFrame([(t,) for t in texts], "text string"), share=1e-9, least=2, gain=0.1, held_words=10)
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a z", "z", "", "b a b c c"])], "i int, text string")
    for r in tree.score(asked).collect():
        assert r["score"] == pytest.approx(brute.score(["a b a z", "z", "", "b a b c c"][r["i"]]))


def test_suffix_tree_has_one_rule_at_every_size(spark):
    """A run is a candidate by its share of the training tokens, few or many of them."""
    texts = ["a b a b a b c", "a b d", "b a c a b e f", "c", "g h"]

    def learned(times, **more):
        return suffix_tree.learn_suffix_tree(spark.createDataFrame([(t,) for t in texts * times], "text string"), **more)

    for share in (suffix_tree.SHARE, 0.1):
        one, many = (learned(times, share=share, gain=-1e18) for times in (1, 7))  # all candidates stay
        assert len(one.grams) and one.grams.tolist() == many.grams.tolist() and one.nodes.tolist() == many.nodes.tolist()
    brute = BruteTree(texts, 3, suffix_tree.SHARE, 1, suffix_tree.GAIN)
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in learned(1).score(asked).collect():
        assert r["score"] == pytest.approx(brute.score(texts[r["i"]]))


def test_suffix_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    tree = suffix_tree.learn_suffix_tree(empty)
    assert tree.score(empty).count() == 0
    got = tree.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_suffix_tree_is_better_than_its_base(spark):
    scored = op11_suffix_tree(spark, "/root/testdata/sf0.01").where("held_out")
    mine, base = scored.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert mine > base + 0.3


# ---- mask search ---------------------------------------------------------------------------------


def terms(text, pattern="[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"):
    return re.findall(pattern, lowered(text))


def brute_ranking(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c) for i, c in bags if c]
    n, length = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(w for _, c in bags for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in bags:
            m = 75 + 25 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                        for w in terms(text) if w in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit_bytes, docs_a_block", [(1 << 24, 2048), (600, 5)])
def test_ranking_equals_brute_force(spark, monkeypatch, limit_bytes, docs_a_block):
    monkeypatch.setattr(mask_search, "DOCS", docs_a_block)
    long_item = " ".join(f"w{i}" for i in range(150)) + " alpha"
    docs = [(i, t) for i, t in enumerate(ODD)] + [(4, "a"), (None, "a a"), (None, None), (50, long_item), (51, long_item[:200])]
    items = [(1, "a b the END 日本"), (1, "a b the END 日本"), (2, None), (3, ""), (None, "alpha ALPHA gamma é"), (4, long_item)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(3).alias("rank"), F.lit(3).alias("n"))
    asked = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(3).alias("item"), F.lit(3).alias("score"))
    got = mask_search.rank_documents(frame, asked, 4, limit_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_ranking(docs, items, 4)


def test_ranking_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert mask_search.rank_documents(none, items).count() == 0
    assert mask_search.rank_documents(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def test_masks_group_and_bound():
    rng = np.random.default_rng(3)
    for rows in (5, 64, 70, 130):
        present = rng.random((rows, 300)) < 0.02
        first, group = mask_search.grouped(present)
        assert (present[:, first][:, group] == present).all() and len({c.tobytes() for c in present.T}) == len(first)
    part = (rng.integers(1, 1000, (40, 2000)) * (rng.random((40, 2000)) < 0.1)).astype(np.int32)
    weights, ids = rng.integers(0, 9000, 40), np.arange(2000)
    ranking = mask_search.Ranking(20)
    scored = ranking.block(part, weights, ids)
    order = np.lexsort((ids, -(weights @ part.astype(np.int64))))[:20]
    # The greatest scores of masks spare most documents.
    assert ranking.docs.tolist() == order.tolist() and scored < 1500


# ---- source audit --------------------------------------------------------------------------------


def brute_audit(rows, least, top):
    letters = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+"
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = terms(text, letters)
        groups.add((lang, source))
        counts[lang, source].update(words)
        df[lang].update(set(words))
    kept = {lang: [w for w, n in c.items() if n >= least] for lang, c in df.items()}
    out = []

    def share(c, lang):
        mass = sum(c[w] for w in kept[lang]) + 5 * len(kept[lang])
        return {w: 1 + 10**9 * (c[w] + 5) // mass for w in kept[lang]}

    p = {g: share(counts[g], g[0]) for g in groups}
    for lang, source in groups:
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])
        q, own = share(whole, lang), p[lang, source]
        parts = {"pair": [(o, sum(abs(own[w] - p[lang, o][w]) for w in kept[lang])) for a, o in groups if a == lang and o != source],
                 "term": [(w, own[w] - q[w]) for w in kept[lang] if counts[lang, source][w] and own[w] > q[w]]}
        for part, found in parts.items():
            found = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("bits", [64, 5])
def test_audit_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(source_audit, "SIDE", 2)
    rng = np.random.default_rng(5)
    words = ["Aé", "b", "C", "dd", "日本", "ÉÉ", "x", "tail"]
    rows = [(str(rng.choice(["en", "de"])), str(rng.choice(["s1", "s2", "s3", "é", "s4"])), " ".join(rng.choice(words, rng.integers(0, 30)))) for _ in range(80)]
    rows += [("xx", "alone", "once"), ("xx", "empty", None), (None, None, "b b"), ("", "s1", ""), (None, "s1", "b c1d"), ("en", None, LONG)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").select("*", F.lit(1).alias("n"), F.lit(1).alias("rank"), F.lit(1).alias("grp"))
    got = source_audit.audit_sources(docs, 6, 3, bits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, 6, 3)


def test_what_an_audit_keeps_is_written_in_few_files(spark):
    """Of the terms counted here five are kept; as many files as the sums had tasks were written of them."""
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    rare = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) + "q" for i in range(40_000)]
    rows = [("en", f"s{i % 3}", "kept often a b c " + " ".join(rare[i::40])) for i in range(40)]
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    spark.conf.set(smallest, "16k")
    try:
        source_audit.audit_sources(spark.createDataFrame(rows, "lang string, source string, text string"), 30).collect()
    finally:
        spark.conf.unset(smallest)
    written = {p.name.rsplit("-", 1)[0]: len(list(p.glob("part-*.parquet"))) for p in set(shared.iterdir()) - before}
    assert written["common"] == written["names"] == written["terms"] == 1


def test_audit_of_nothing(spark):
    assert source_audit.audit_sources(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_shares_are_exact():
    n, mass = np.array([0, 7, 10**12, 123_456_789_012]), np.array([35, 10**13, 3 * 10**12, 9 * 10**13])
    assert source_audit.shares(n, mass).tolist() == [1 + 10**9 * (int(a) + 5) // int(b) for a, b in zip(n, mass)]


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_source_audit"])
def test_new_query_equals_sql(spark, name):
    assert check.compare(spark, check.engine(FOLDER), FOLDER, name) is None


# ---- token ids of whole columns --------------------------------------------------------------------


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_column_ids_are_the_librarys(name, spaced):
    """Random texts of letters that change under lower case, marks, all kinds of white space and special
    strings; both ways to the ids give what the library gives."""
    import pyarrow as pa

    from accrete.llm.chunk_ids import ColumnEncoder
    from accrete.llm.queries import vocabulary
    from accrete.llm.tokenizing import chunk_encoder, tokenizer

    letters = [*"aAbBeinI Iiz.,;:!?'  \n\n\t|<>0159-", "<|endoftext|>", "İ", "ﬁ", "ẞ", "\xdf", "\xe9", "\xc9", "̇",
               "\xa0", " ", "﻿", "​", "\x85", "\x1c", "日", "本", "Σ", "ς", "—", "’", "…",
               "\U0001f600", "́", "ǰ", "ŉ", "ΐ"]
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(6000)]
    texts += ["BİRİNCİ.", "", None, "x" * 5000, "a. b, c! d.", "﻿" + "ab. " * 2000, *ODD]
    encoder = chunk_encoder(vocabulary(name), spaced)
    column, found = ColumnEncoder(encoder), []
    column.encoder.remembered, kept = 3000, column.encoder.remembered  # the memory is emptied now and then
    for i in range(0, len(texts), 500):
        ids, ends = column.encode(pa.array(texts[i : i + 500], pa.string()))
        found += np.split(ids, ends[:-1])
    encoder.remembered = kept
    want = [e.ids for e in tokenizer(vocabulary(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [f.tolist() for f in found] == want
    assert [f.tolist() for f in encoder.ids(texts)] == want
    assert [len(x) for x in column.encode(pa.array([], pa.string()))] == [0, 0]
    sliced = pa.array(texts[:40], pa.large_string()).slice(7, 20)
    ids, ends = column.encode(sliced)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == want[7:27]


def test_one_word_in_capitals_or_before_marks_is_learned_once():
    import pyarrow as pa

    from accrete.llm.chunk_ids import ColumnEncoder
    from accrete.llm.queries import vocabulary
    from accrete.llm.tokenizing import ChunkEncoder, tokenizer

    path = vocabulary("word_bpe_49k.json")
    column = ColumnEncoder(ChunkEncoder(path, False))
    column.encode(pa.array(["\xe9 Word word WORD word!! wOrd$$$ \xe9 Word%%% word.%%% word", "word"]))
    assert len(column.key) == 6  # the accent, the word and four runs of marks
    # Letters that a mark after them joins, marks of all kinds, and runs beyond those that are cut off.
    letters = [*"aAhHIKsStT''.,;:!?$%&*#()[]{}-_=+/^~`@\"\\   \n", "!!!", "\u0331", "\u030a", "\u0307", "\xc9", "\xe9", "\u0130", "\u1e9e", "<", "|", ">"]
    rng = np.random.default_rng(12)
    texts = ["".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(4000)]
    texts += ["A" + "!" * 16, "A" + "!" * 17 + " b", "A" + "!" * 3000 + ".", "!" * 40, "H\u0331 \xe9", "\xe9 <|ENDOFTEXT|> A.", "\xe9 <|endoftext|>A!! IT'S!", "a b'", "'S!"]
    ids, ends = column.encode(pa.array(texts))
    want = [e.ids for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == want


def test_runs_of_bytes_are_compared_whole():
    """Runs of 1 to 40 bytes that differ in one byte or none, also at the ends of short arrays."""
    from accrete.llm.terms import same_bytes

    for size in range(1, 41):
        for pad in (0, 1, 9):
            a = np.arange(size + 2 * pad, dtype=np.uint8)
            one = [np.array([pad]), np.array([size])]
            assert same_bytes(a, *one, a.copy(), *one).tolist() == [True]
            for i in range(size):
                b = a.copy()
                b[pad + i] += 1
                assert same_bytes(a, *one, b, *one).tolist() == [False]
    a = np.frombuffer(b"abcabcd", np.uint8)
    found = same_bytes(a, np.array([0, 0, 3]), np.array([3, 3, 4]), a, np.array([3, 3, 3]), np.array([3, 4, 4]))
    assert found.tolist() == [True, False, True]


# ---- toxicity --------------------------------------------------------------------------------------


def test_toxic_rows_of_the_fold_held_out_are_found(spark):
    from accrete.llm.queries import op10_toxicity

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = op10_toxicity(spark, folder).where("held_out").join(labels, "doc_id")
    hits, toxic, said = rows.agg(F.count_if(F.expr("predicted = 1 and toxic = 1")), F.sum("toxic"), F.sum("predicted")).first()
    assert toxic > 50 and hits / toxic >= 0.85 and hits / said >= 0.9


def test_greatest_expression():
    from accrete.llm.toxicity import greatest

    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 6, 40)
    values, of = rng.normal(size=sizes.sum()), np.repeat(np.arange(40), sizes)
    want = []
    for i in range(40):
        own = values[of == i]
        want.append(max((own[j : j + 2].mean() for j in range(len(own) - 1)), default=own.mean() if len(own) else 0.0))
    assert np.allclose(greatest(values, of, 40), want)
    assert greatest(values[:0], of[:0], 3).tolist() == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("held", [1 << 20, 40])
def test_toxicity_equals_brute_force(spark, monkeypatch, held):
    """Odds and scores against plain dictionaries, words held or joined."""
    from accrete.llm import toxicity

    monkeypatch.setattr(toxicity, "HELD_WORDS", held)
    rng = np.random.default_rng(13)
    rows = [(i, " ".join([*rng.choice([f"w{j}" for j in range(120)], rng.integers(0, 30)), *(["bad", "Worse!"] if i % 4 == 0 else [])]), int(i % 4 == 0))
            for i in range(400)] + [(400, None, 0), (401, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn_toxicity(df.where("doc_id % 2 = 0"), df.where("doc_id % 2 = 1"))
    words = lambda t: re.findall("[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    n, docs = [Counter(), Counter()], [0, 0]
    for i, t, y in rows:
        if i % 2 == 0:
            n[y].update(set(words(t)))
            docs[y] += 1
    total, kinds = [sum(c.values()) for c in n], [len(c) for c in n]
    odds = {}
    for w in n[0] | n[1]:
        both = n[0][w] + n[1][w]
        g = max(2 * sum(n[c][w] * math.log(n[c][w] / (both * docs[c] / sum(docs))) for c in (0, 1) if n[c][w]), 0.0)
        p = [(max(n[c][w] - 0.75, 0) + 0.75 * kinds[c] * both / sum(total)) / total[c] for c in (0, 1)]
        odds[w] = g / (g + 8) * math.log(p[1] / p[0])
    for r in toxicity.score_toxicity(df, model).collect():
        own = [odds[w] for w in words(r["text"]) if w in odds]
        x = max(((a + b) / 2 for a, b in zip(own, own[1:])), default=own[0] if own else 0.0)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(min(model.slope * (x - model.middle), 30), -30))), rel=1e-6)


# ---- long lines ------------------------------------------------------------------------------------


def test_long_lines_are_compared_in_the_time_of_short_ones(spark, monkeypatch):
    """Lines of a million characters, and of all lengths around where blocks are cut again."""
    import time

    from accrete.llm import line_dedup

    rng = np.random.default_rng(17)
    letters = np.array(list("abcdefghij klmnop"))

    def edited(line, kind):
        at = int(rng.integers(1, len(line) - 1))
        return {"=": line, "-": line[:at] + line[at + 1 :], "+": line[:at] + "Z" + line[at:], "x": line[:at] + "Z" + line[at + 1 :],
                "2": line[:at // 2] + "Z" + line[at // 2 + 1 : at] + "Y" + line[at + 1 :] if at > 4 else "Q" * 30}[kind]

    lines, repeats = [], []
    for size in (30, 1000, 1023, 1024, 1025, 1030, 2000, 5000, 66_000):
        for kind in "=-+x2":
            line = "A" + "".join(rng.choice(letters, size)) + "B"
            lines += [line, edited(line, kind)]
            repeats += [False, kind != "2"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(docs).collect()}
    assert [found[i] == "" for i in range(len(lines))] == repeats
    giant = "".join(rng.choice(letters, 1_000_000))
    begun = time.time()
    pair = spark.createDataFrame([(1, "A" + giant), (2, "A" + edited(giant, "-")), (3, "A" + edited(giant, "2"))], "doc_id long, text string")
    got = {r["doc_id"]: len(r["text"]) for r in line_dedup.without_repeated_lines(pair).collect()}
    assert got[1] == 1_000_001 and got[2] == 0 and got[3] == 1_000_001 and time.time() - begun < 120
