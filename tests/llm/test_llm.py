"""Operators of the training-data pipeline against brute force, and their behaviour on odd input."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from accrete.llm import packing, token_counts, token_files, toxicity
from accrete.llm.components import components
from accrete.llm.decontamination import contamination, without_contaminated
from accrete.llm.embedding_dedup import embedding_groups
from accrete.llm.language import UNKNOWN, codewords, identify_languages, learn_languages
from accrete.llm.line_dedup import without_repeated_lines
from accrete.llm.queries import vocabulary
from accrete.llm.simhash import close_pairs, one_of_each_group, simhash_groups
from accrete.llm.span_dedup import sentences, without_repeated_spans
from accrete.llm.tokenizing import chunk_encoder, tokenizer
from accrete.llm.toxicity import learn_toxicity, score_toxicity

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
LONG = " ".join(f"word{i % 97} item{i % 31}." for i in range(6000))
ODD = ["", " ", "a  b", "x \n y", " lead", "trail ", "a\tb\t c", "don't we'll 'l 'v", "\n\n a \n", "a | b||c |", "a\x1cb",
       "<|endoftext|> x<|endoftext|>y  <|endoftext|>  z", "é x́ ß ﬁ İ Σς ΑΣ 1234 ½", "日本語 テスト 😀", "tab\t\tq \t",
       "a\r\nb \r\n c", "A.B, c!d?  e", "no.5,6;7"]


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with names used inside."""
    texts = [*ODD, None, None, LONG, LONG, "Short text here.", "Short text here."]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "no id at all"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *(F.lit(7).alias(c) for c in ("_row", "n", "length", "key", "content", "fp", "_key", "_id", "_copy")))


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("path, spaced", [(BYTES, True), (WORDS, False)])
def test_chunks_give_the_library_ids(path, spaced):
    texts = [*ODD, LONG, None]
    for text, found in zip(texts, chunk_encoder(path, spaced).ids(texts)):
        assert found.tolist() == tokenizer(path).encode(text or "", add_special_tokens=False).ids, text


def test_every_prefix_has_its_count():
    encoder = chunk_encoder(BYTES, True)
    answers = token_counts.PrefixCounts(encoder)
    for text in [*ODD, "The quick, brown fox.\nIt's 42 o'clock"]:
        ends, counts = next(token_counts.prefix_tables(encoder, [text]))
        table = token_counts.pack_table(ends, counts)
        exact = [len(encoder.tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert [answers.tokens_at(text, table, i) for i in range(len(text) + 1)] == exact, text
        for budget in range(max(exact) + 1):
            i = answers.longest_prefix(text, table, budget)
            assert exact[i] <= budget


def test_token_counts_of_odd_rows(odd_docs):
    found = token_counts.prefix_token_counts(odd_docs, BYTES, 100).select("doc_id", "n_bytes", "n_tokens", "over_limit", "limit_bytes").collect()
    expected = []
    for doc_id, text in texts_of(odd_docs):
        n = len(tokenizer(BYTES).encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 100))
    assert ordered(tuple(r)[:4] for r in found) == ordered(expected)
    assert all(r["limit_bytes"] == r["n_bytes"] for r in found if not r["over_limit"])


def test_room_tree_finds_the_tightest():
    tree, rooms = packing.RoomTree(50), [3, 17, 17, 40, 50]
    for room in rooms:
        tree.add(room, 1)
    for need in range(1, 51):
        assert tree.tightest(need) == min((r for r in rooms if r >= need), default=None)


def plain_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            min(fitting)[0] -= length
        else:
            bins.append([capacity - length])
    return sorted(b[0] for b in bins)


def test_packing_over_counts_equals_one_by_one():
    random = np.random.default_rng(1)
    for capacity in (7, 20, 64):
        lengths = random.integers(1, capacity + 1, 300).tolist() + [capacity // 3] * 50
        counts = {l: lengths.count(l) for l in set(lengths)}
        used = defaultdict(int)
        taken = defaultdict(list)
        for length, rank, count, first, offset in packing.best_fit_decreasing(counts, capacity):
            taken[length].extend(range(rank, rank + count))
            for s in range(first, first + count):
                assert used[s] == offset
                used[s] += length
        assert {l: sorted(t) for l, t in taken.items()} == {l: list(range(c)) for l, c in counts.items()}
        assert sorted(capacity - u for u in used.values()) == plain_best_fit(lengths, capacity)


def test_packed_documents(odd_docs):
    found = packing.pack_documents(odd_docs, BYTES, 64).collect()
    at, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        at[(r["doc_id"])].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    one = sorted(at[ODD.index("a | b||c |")], key=lambda r: r["piece"])
    whole = tokenizer(BYTES).encode("a | b||c |", add_special_tokens=False).ids + [0]
    assert np.frombuffer(b"".join(r["ids"] for r in one), "<u4").tolist() == whole
    long = sorted(at[texts_of(odd_docs).index((20, LONG))], key=lambda r: r["piece"])
    assert [r["length"] for r in long[1:]] == [64] * (len(long) - 1)
    assert packing.pack_documents(odd_docs.limit(0), BYTES, 64).count() == 0


def test_lengths_out_of_range_raise(spark):
    with pytest.raises(ValueError):
        packing.best_fit_pack(spark.createDataFrame([(0,), (3,)], "length long"), 10)


def test_variable_length_coding_round_trip():
    random = np.random.default_rng(2)
    for count in (0, 1, 3, 4, 5, 1000):
        values = (random.integers(0, 1 << 32, count) >> random.integers(0, 32, count)).astype("<u4")
        control, data = token_files.encode_ranks(values)
        assert len(control) == -(-count // 4)
        assert token_files.decode_ranks(control, data, count).tolist() == values.tolist()


def test_token_files_round_trip(odd_docs):
    found = token_files.through_files(odd_docs, WORDS, 2).collect()
    known = [(d, tokenizer(WORDS).encode(t or "", add_special_tokens=False).ids + [2]) for d, t in texts_of(odd_docs)]
    assert ordered((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found) == ordered(known)
    place = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == place and zlib.crc32(r["ids"]) == r["ids_crc32"]
        place += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert token_files.through_files(odd_docs.limit(0), WORDS).count() == 0


def test_codewords_differ():
    for n in (2, 3, 4, 6, 7, 40):
        code = codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (2 ** (n - 2) if n <= 6 else code.shape[1] / 4)


def test_languages(spark, odd_docs):
    seen = {"en": "the house and the garden with some trees", "de": "das haus und der garten mit einigen bäumen"}
    learn = spark.createDataFrame([(t, l) for l, t in seen.items()] * 5 + [("x", None), (None, "en")], "text string, lang string")
    model = learn_languages(learn)
    assert model.languages == ["de", "en"]
    rows = {r["text"]: r for r in identify_languages(learn, model).collect()}
    assert all(rows[t]["lang_pred"] == l and 0.5 < rows[t]["score"] <= 1 for l, t in seen.items())
    found = identify_languages(odd_docs, model)
    assert found.columns == [*odd_docs.columns, "lang_pred", "score", "ambiguous"]
    for r in found.collect():
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == UNKNOWN) == (not letters)
    nothing = learn_languages(learn.limit(0))
    assert {r["lang_pred"] for r in identify_languages(learn, nothing).collect()} == {UNKNOWN}


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_of_odd_rows(odd_docs):
    found = simhash_groups(odd_docs).collect()
    assert ordered((r["doc_id"], r["fingerprint"]) for r in found) == ordered(
        (d, f"{brute_fingerprint(t or ''):016x}") for d, t in texts_of(odd_docs))
    least = {}
    for r in found:
        if r["doc_id"] is not None:
            least[r["fingerprint"]] = min(r["doc_id"], least.get(r["fingerprint"], r["doc_id"]))
    assert all(r["component_id"] == least.get(r["fingerprint"]) for r in found)
    one = one_of_each_group(odd_docs)
    assert one.columns == odd_docs.columns
    ids = [r["doc_id"] for r in one.collect()]
    assert len(ids) == len(set(ids)) == len({r["fingerprint"] for r in found})
    assert simhash_groups(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [4096, 50])
def test_close_fingerprints_are_all_found(spark, monkeypatch, rows):
    """Also when places are crowded and split into blocks."""
    from accrete.llm import simhash

    monkeypatch.setattr(simhash, "PLACE_ROWS", rows)
    random = np.random.default_rng(3)
    centre = random.integers(-(1 << 62), 1 << 62, 60)
    near = centre[random.integers(0, 3, 300)]
    for _ in range(3):
        near = near ^ (np.int64(1) << random.integers(0, 63, 300))
    values = np.unique(np.concatenate([centre, near]))
    found = close_pairs(spark.createDataFrame([(int(v),) for v in values], "fp long")).collect()
    u = values.view(np.uint64)
    expected = {(int(min(a, b)), int(max(a, b))) for i, a in enumerate(values) for b in values[:i] if (int(a) ^ int(b)) & (1 << 64) - 1
                and bin((int(a) ^ int(b)) & (1 << 64) - 1).count("1") <= 3}
    assert len(u) == len(values) and ordered(tuple(r) for r in found) == ordered(expected)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (159, 300)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys([*range(100, 160), 300], 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings(spark):
    random = np.random.default_rng(4)
    centres = random.standard_normal((30, 16))
    vectors = [c + 0.12 * random.standard_normal(16) for c in centres for _ in range(8)]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(500 + i, rows[0][1], 2) for i in range(30)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    df = spark.createDataFrame(rows + [(i, v, 3) for i, v in odd], "vec_id long, embedding array<double>, n int")
    found = {r["vec_id"]: r for r in embedding_groups(df).collect()}
    e = np.array([v for _, v, _ in rows])
    ids = [i for i, _, _ in rows]
    unit = e / np.linalg.norm(e, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    links = linked.sum(axis=1) - 1
    got = np.array([found[i]["n_links"] for i in ids])
    assert (got <= links).all() and got.sum() >= 0.95 * links.sum() > 0
    assert all(found[500 + i]["component_id"] == found[0]["component_id"] == 0 for i in range(30))
    for i in (900, 901, 902, 903, 904):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert found[905]["n_links"] == found[906]["n_links"] == 1 and found[906]["component_id"] == 905
    assert embedding_groups(df.limit(0)).count() == 0


def within_one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def test_line_dedup_against_all_pairs(spark):
    random = np.random.default_rng(5)
    base = ["".join(random.choice(list("abcdé "), 30 + 9 * i)).strip() + "x" for i in range(12)]
    lines = []
    for _ in range(300):
        line = list(base[random.integers(len(base))])
        for _ in range(random.integers(0, 3)):
            at, kind = random.integers(len(line)), random.integers(3)
            line[at : at + (kind != 0)] = [random.choice(list("abcdé"))] if kind < 2 else []
        lines.append("".join(line))
    docs = [(i, "\n".join([*lines[3 * i : 3 * i + 3], "", "a", " short  "])) for i in range(100)]
    earlier, expected = [], []
    for doc_id, text in docs:
        kept = []
        for line in text.split("\n"):
            t = line.strip(" ")
            if t and (t in earlier or len(t) >= 20 and any(len(e) >= 20 and within_one_edit(e, t) for e in earlier)):
                pass
            else:
                kept.append(line)
            if t and t not in earlier:
                earlier.append(t)
        expected.append((doc_id, "\n".join(kept)))
    found = without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == expected


def test_line_dedup_of_odd_rows(odd_docs):
    found = without_repeated_lines(odd_docs)
    assert found.columns == odd_docs.columns
    rows = texts_of(found)
    assert len(rows) == odd_docs.count()
    assert sum(t == LONG for _, t in rows) == 1 and sum(t == "Short text here." for _, t in rows) == 1
    assert sum(t is None for _, t in rows) == 3
    assert without_repeated_lines(odd_docs.limit(0)).count() == 0


def brute_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("limit", [1 << 26, 1 << 10])
def test_contamination_against_all_windows(spark, odd_docs, monkeypatch, limit):
    """Also when the benchmark takes several passes."""
    from accrete.llm import decontamination

    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
    random = np.random.default_rng(6)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(random.choice(words, 10 + i))) for i in range(12)]
    items += [(50, "É w1 W2"), (51, "single"), (52, None), (53, "..."), (54, items[3][1]), (None, "w5 w6 w7 w8 nothing")]
    docs = [(100 + i, " ".join([*random.choice(words, 20), *brute_words(items[i % 12][1])[i % 3 :], *random.choice(words, 9)])) for i in range(30)]
    docs += [(200, "É, w1! w2 single"), (201, "é w1 w2"), (202, items[3][1] + " " + items[3][1]), (202, "single"), (202, "single")]
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    windows = defaultdict(set)
    for item, text in items:
        w = brute_words(text)
        for s in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[s : s + 10])].add(item)
    expected = []
    for doc_id, text in texts_of(df):
        w, hit, found = brute_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        expected.append((doc_id, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination(df, benchmark).select("doc_id", "n_words", "n_hit", "items").collect()
    assert ordered(tuple(r) for r in rows) == ordered(expected)
    clean = without_contaminated(odd_docs, benchmark.where("item_id = 3"))
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    assert contamination(df, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(df.limit(0), benchmark).count() == 0


def test_sentence_spans(spark, odd_docs):
    passage = "One two three four five six seven. Eight nine ten eleven twelve thirteen. And a third sentence of it ends here."
    docs = [(1, f"Own start one. {passage} Own end."), (2, f"Other start. {passage}"), (3, "Clean text alone. Nothing repeated in it at all, really nothing here.")]
    found = {r["doc_id"]: r for r in without_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[1]["text"] == docs[0][1] and found[3]["text"] == docs[2][1]
    assert found[2]["text"] == "Other start. " and found[2]["n_removed"] == 3 and found[2]["n_sentences"] == 4
    rows = texts_of(without_repeated_spans(odd_docs, 2, 4))
    # Inside a text its own spans repeat too.
    assert len(rows) == odd_docs.count() and sum(len(t or "") > 100 for _, t in rows) == 1
    assert "".join(sentences(LONG)) == LONG
    assert without_repeated_spans(odd_docs.limit(0)).count() == 0


def test_sentence_spans_against_all_documents(spark):
    random = np.random.default_rng(8)
    pool = [" ".join(random.choice([f"v{i}" for i in range(50)], n)) for n in random.integers(1, 9, 40)]
    docs = [(i, " ".join(f"{pool[j]}." for j in random.integers(0, 40, random.integers(0, 60)))) for i in range(60)]
    first, expected = {}, []
    for doc_id, text in docs:
        parts, removed = sentences(text), set()
        for start in range(len(parts)):
            stop = next((e for e in range(start + 2, len(parts) + 1) if len(" ".join(parts[start:e]).split()) >= 6), None)
            if stop is not None and first.setdefault(" ".join(" ".join(parts[start:stop]).split()), (doc_id, start)) != (doc_id, start):
                removed |= set(range(start, stop))
        expected.append((doc_id, "".join(p for j, p in enumerate(parts) if j not in removed), len(parts), len(removed)))
    found = without_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"), 2, 6)
    assert sorted(map(tuple, found.collect())) == expected


def test_passages_within_long_sentences(spark):
    """Passages of 51 words go whatever stands around them: inside a sentence, with one sentence end,
    with one whole sentence, in other scripts; so does an exact copy without any sentence end."""
    random = np.random.default_rng(21)

    def some(n):
        return [f"w{x}" for x in random.integers(0, 10**9, n)]

    for ends in ([], [25], [16, 32], [20, 31], [3], [48]):
        passage = [w + "." * (i in ends) for i, w in enumerate(some(51))]
        docs = [(i, " ".join([*some(a), *passage, *some(b)])) for i, (a, b) in enumerate([(0, 0), (0, 0), (30, 30), (3, 40), (40, 2), (0, 30)])]
        found = {r["doc_id"]: r for r in without_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        assert found[0]["text"] == docs[0][1] and found[1]["text"] == ""
        for i in range(2, len(docs)):
            own = set(docs[i][1].split()) - set(passage)
            left = found[i]["text"].split()
            assert own <= set(left) and len(left) - len(own) <= 39, (ends, i)
    for text in ("\u6f22\u5b57\u304c\u3042\u308b\u6587\u3067\u3059\u3002" * 2, "".join(chr(0x4E00 + x) for x in random.integers(0, 20000, 60)),
                 " ".join(chr(0x0915 + x) * 3 for x in range(20)) + "\u0964"):
        found = without_repeated_spans(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"))
        assert {r["doc_id"]: r["text"] for r in found.collect()}[2] == "", text


def test_spans_cover_all_repeated_runs(spark):
    lengths = (10, 10, 5, 4)
    shared = " ".join(" ".join(f"s{i}x{j}" for j in range(n)) + "." for i, n in enumerate(lengths))
    random = np.random.default_rng(9)
    pool = [" ".join(random.choice([f"v{i}" for i in range(50)], n)) for n in random.integers(1, 9, 12)]
    docs = [(0, shared + " Own end of one."), (1, shared + " Other end.")]
    docs += [(i, " ".join(f"{pool[j]}." for j in random.integers(0, 12, random.integers(0, 30)))) for i in range(2, 40)]
    first, expected = {}, []
    for doc_id, text in docs:
        parts, removed = sentences(text), set()
        for start in range(len(parts)):
            for stop in range(start + 2, len(parts) + 1):
                run = " ".join(" ".join(parts[start:stop]).split())
                if len(run.split()) >= 12 and first.setdefault(run, (doc_id, start)) != (doc_id, start):
                    removed |= set(range(start, stop))
        expected.append((doc_id, "".join(p for j, p in enumerate(parts) if j not in removed), len(parts), len(removed)))
    assert expected[1][1] == "Other end."
    found = without_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == expected


def test_toxicity(spark, odd_docs):
    random = np.random.default_rng(7)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(900):
        text = [*random.choice(words, 40), *(["nasty", "awful"] if i % 5 == 0 else [])]
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = learn_toxicity(df.where("doc_id % 3 = 0"), df.where("doc_id % 3 = 1"))
    found = score_toxicity(df.where("doc_id % 3 = 2"), model).collect()
    assert all(r["predicted"] == r["label"] for r in found)
    scored = score_toxicity(odd_docs, model)
    assert scored.columns == [*odd_docs.columns, "score", "predicted"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in scored.collect())
    empty = learn_toxicity(df.limit(0), df.limit(0))
    assert all(0 < r["score"] < 1 for r in score_toxicity(odd_docs, empty).collect())


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_rare_toxic_words_count(spark, monkeypatch, held):
    """Words of six toxic and no ordinary documents raise the score, held or joined."""
    monkeypatch.setattr(toxicity, "HELD_WORDS", held)
    random = np.random.default_rng(11)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(900):
        rows.append((i, " ".join([*random.choice(words, 20), *([f"rare{i // 10 % 15}"] * 4 if i % 10 == 0 else [])]), int(i % 10 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    counted, curve = df.where("doc_id % 900 < 600"), df.where("doc_id >= 600")
    model = learn_toxicity(counted, curve)
    texts = [(1, "rare3 nothing known"), (1, "rare3 nothing known"), (2, ""), (3, None), (None, "w1 w2 w3")]
    found = [tuple(r) for r in score_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), model).select("doc_id", "score").collect()]
    scores = dict(found)
    assert len(found) == 5 and scores[1] > 0.5 > scores[2] == scores[3]


def test_rows_beyond_the_calibration_sample_are_counted(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 10)
    df = spark.createDataFrame([(i, "t", i % 2) for i in range(100)], "doc_id long, text string, label int")
    counted, curve = (sorted(r["doc_id"] for r in d.collect()) for d in toxicity.split_calibration(df, F.col("doc_id") < 40))
    assert len(curve) == 10 and max(curve) < 40 and sorted(counted + curve) == list(range(100))
