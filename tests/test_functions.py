import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from accrete.functions import hashing, images, scoring, text, vectors

QUESTIONS = [
    None, "", "  HOW   MANY x", "whatever", "what is the color", "what colors", "island", " what", "What number is it",
    "what is the company", "which", "Whose", "who\tis", "where?", "can you", "What is this", "\x1chow\x1fmany",
]


def expected_label(question, patterns):
    for label, pattern in patterns:
        if question and re.search(pattern, question, re.I):
            return label
    return "other"


@pytest.mark.parametrize("expression,patterns", [
    (text.question_type, text.QUESTION_TYPES), (text.profile_question_type, text.PROFILE_QUESTION_TYPES)])
def test_question_labels(rows, expression, patterns):
    assert rows(QUESTIONS, "q string", expression(F.col("q"))) == [expected_label(q, patterns) for q in QUESTIONS]


def test_the_two_label_sets_differ(rows):
    assert rows(["whatever"], "q string", text.question_type(F.col("q"))) == ["other"]
    assert rows(["whatever"], "q string", text.profile_question_type(F.col("q"))) == ["what"]


def test_word_count_is_python_split(rows):
    values = [None, "", "  ", "a b", " a\tb\nc ", "a b", "a b\x1cc", "été là"]
    assert rows(values, "s string", text.word_count(F.col("s"))) == [len((v or "").split()) for v in values]
    assert rows(values, "s string", text.words(F.col("s"))) == [(v or "").split() for v in values]


def test_lists_and_caps(rows):
    assert rows([None, [], ["a", "b"]], "l array<string>", text.item_count(F.col("l"))) == [0, 0, 2]
    assert rows([None, 3, 8, 9], "n int", text.clip_upper(F.col("n"), 8)) == [None, 3, 8, 8]
    assert rows([None, [], ["a", "b", "c"]], "l array<string>", text.prefix_text(F.col("l"), 2, ", ")) == ["", "", "a, b"]
    assert rows([None, "Why?"], "q string", text.prompt(F.col("q"), "h")) == ["\n\nh", "Why?\n\nh"]
    assert rows([None, "a b"], "s string", text.text_length(F.col("s"))) == [0, 3]


@pytest.mark.parametrize("value,expected", [
    ("The  A.B, (c)!", "ab c"), ("don't", "don't"), ("a", ""), ("the", ""), ("x\t y\nz", "x y z"), ("An-apple a day", "an-apple day"),
    ('"Quoted": yes;no?', "quoted yesno"), ("  ", ""), ("the the dog", "dog"), ("go go", "go go")])
def test_normalise(rows, value, expected):
    assert rows([value], "s string", text.normalise_answer(F.col("s"))) == [expected]


def test_scores(rows):
    cases = [(None, ["x"]), ("", [""]), (" ", ["the", "the", "the"])]
    cases += [("Yes!", ["yes"] * n + ["no"] * (10 - n)) for n in (0, 1, 2, 3, 10)]
    got = rows(cases, "p string, g array<string>", scoring.answer_score(F.col("p"), F.col("g")))
    assert got == pytest.approx([0, 0, 1, 0, 1 / 3, 2 / 3, 1, 1])
    assert rows([("x", None), ("x", [None, "X"])], "p string, g array<string>",
                scoring.answer_score(F.col("p"), F.col("g"))) == pytest.approx([0, 1 / 3])


def test_number_formats(rows):
    assert rows([0.7994, 0.0625], "x double", text.fixed(F.col("x"), 3)) == ["0.799", "0.062"]
    assert rows([2.1, -2.1, 0.0], "x double", text.fixed(F.col("x"), 1, signed=True, suffix=" pp")) == ["+2.1 pp", "-2.1 pp", "+0.0 pp"]
    assert rows([1.239], "x double", text.fixed(F.col("x"), 2, prefix="d=")) == ["d=1.24"]


def test_difference_hash_edges(rows):
    rising = [c for _ in range(8) for c in range(9)]
    falling = [9 - c for _ in range(8) for c in range(9)]
    first = [0, 1] + [0] * 70
    last = [0] * 71 + [1]
    # The second pixel of `first` is followed by a darker one, so only the first test holds.
    got = rows([rising, falling, [5] * 72, first, last, None], "px array<int>", hashing.hash_hex(hashing.difference_hash(F.col("px"))))
    assert got == ["f" * 16, "0" * 16, "0" * 16, "8" + "0" * 15, "0" * 15 + "1", "0" * 16]


def test_hamming(rows):
    pairs = [(0, 0), (-1, 0), (-1, 1), (5, 6)]
    assert rows(pairs, "a bigint, b bigint", hashing.hamming(F.col("a"), F.col("b"))) == [0, 64, 63, 2]


def test_numpy_hash_equals_the_expression(rows):
    rng = np.random.default_rng(1)
    grays = [rng.integers(0, 256, (8, 9)) for _ in range(20)]
    assert rows([g.flatten().tolist() for g in grays], "px array<int>", hashing.difference_hash(F.col("px"))) == [images.hash_gray(g) for g in grays]


def test_shrink_keeps_flat_and_smooth_pictures():
    assert (images.shrink(np.full((40, 50), 77)) == 77).all()
    ramp = np.tile(np.arange(90), (64, 1))
    small = images.shrink(ramp)
    assert small.shape == (8, 9) and (np.diff(small[0]) > 0).all()
    assert images.hash_gray(ramp) == -1
    assert (images.lanczos_weights(50, 9).sum(axis=1) - (1 << 22) < 50).all()


def test_luma_and_missing_images():
    assert images.luma(np.array([255, 255, 0]), np.array([255, 0, 0]), np.array([255, 0, 255])).tolist() == [255, 76, 29]
    assert images.image_hash(b"") == 0 and images.image_hash(None) == 0
    with pytest.raises(ValueError):
        images.decode_gray(b"P6\n1 1\n70000\nxxx")


def test_vector_lengths(rows, spark):
    assert rows([[1.0, 2.0], None], "v array<float>", vectors.check_length(F.col("v"), 2)) == [[1.0, 2.0], None]
    with pytest.raises(PySparkException, match="expected 2 values, got 3"):
        rows([[1.0, 2.0, 3.0]], "v array<float>", vectors.check_length(F.col("v"), 2))
    assert rows([list(range(6))], "v array<int>", vectors.reshape(F.col("v"), 2, 3)) == [[[0, 1, 2], [3, 4, 5]]]
    with pytest.raises(PySparkException, match="reshape"):
        rows([[1, 2]], "v array<int>", vectors.reshape(F.col("v"), 2, 3))
    assert spark.range(1).select(vectors.zeros(3)).first()[0] == [0.0] * 3
    assert rows([([0.0, 0.0], [3.0, 4.0])], "a array<float>, b array<float>", vectors.l2_distance(F.col("a"), F.col("b"))) == [5.0]


def test_unpack_half(spark):
    half = np.array([0.1, -2.5, 65504], np.float16)
    df = spark.createDataFrame([(1, half.tobytes()), (2, None), (3, b"")], "id int, v binary")
    got = {r.id: r.v for r in vectors.unpack_half(df, "v").collect()}
    assert got == {1: half.astype(np.float32).tolist(), 2: None, 3: []}
