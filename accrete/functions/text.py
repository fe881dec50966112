"""Text signals as Spark expressions (tier 1: no Python worker involved)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Question labels with the opening words that select them, first match wins.
QUESTION_TYPES = [
    ("how_many", r"^\s*how\s+many\b"),
    ("what_color", r"^\s*what\s+(is\s+the\s+)?color\b"),
    ("what_brand", r"^\s*what\s+(is\s+the\s+)?(brand|company|make)\b"),
    ("what_number", r"^\s*what\s+number\b"),
    ("what", r"^\s*what\b"),
    ("which", r"^\s*which\b"),
    ("who", r"^\s*who\b"),
    ("where", r"^\s*where\b"),
    ("is_does", r"^\s*(is|are|does|do|can)\b"),
]

# The coarser labels used for profiling; no word boundary at the end.
PROFILE_QUESTION_TYPES = [
    ("how many", r"^\s*how\s+many"),
    ("what is/are", r"^\s*what\s+(is|are)"),
    ("what", r"^\s*what"),
    ("which", r"^\s*which"),
    ("who", r"^\s*who"),
    ("where", r"^\s*where"),
    ("is/does", r"^\s*(is|are|do|does|can)"),
]

# What answer normalisation removes.
ANSWER_PUNCTUATION = r'[.,!?;:()"]+'
ARTICLES = ["a", "an", "the"]

# Fixed value: the instruction put after every question.
ANSWER_HINT = "Answer the question using a single word or short phrase, no explanation."

# White space as Python's str.split() sees it; (?U) makes \s cover Unicode.
BLANK = r"(?U)[\s\x1c-\x1f]+"
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]+"


def first_match(text: Column, patterns: list[tuple[str, str]], default: str = "other") -> Column:
    """Label of the first pattern found in `text`, ignoring case; null and no match give `default`."""
    label = None
    for name, pattern in patterns:
        unicode_pattern = "(?iU)" + pattern.replace(r"\s", r"[\s\x1c-\x1f]")
        hit = text.rlike(unicode_pattern)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(default)


def question_type(question: Column) -> Column:
    return first_match(question, QUESTION_TYPES)


def profile_question_type(question: Column) -> Column:
    return first_match(question, PROFILE_QUESTION_TYPES)


def words(text: Column) -> Column:
    """Blank-separated words; null gives an empty list."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NOT_BLANK), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_BLANK))


def item_count(items: Column) -> Column:
    """Length of a list, null counting as empty."""
    return F.coalesce(F.size(items), F.lit(0))


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def clip_upper(value: Column, cap: int) -> Column:
    """Cap from above; unlike `least`, null stays null."""
    return F.when(value > cap, F.lit(cap)).otherwise(value)


def normalise_answer(text: Column) -> Column:
    """Lower case, listed punctuation deleted, articles dropped, single blanks between words."""
    bare = F.regexp_replace(F.lower(text), ANSWER_PUNCTUATION, "")
    tokens = F.regexp_extract_all(bare, F.lit(NOT_BLANK), F.lit(0))
    for article in ARTICLES:
        tokens = F.array_remove(tokens, article)
    return F.array_join(tokens, " ")


def prefix_text(items: Column, count: int, separator: str = " ") -> Column:
    """First `count` items as one string; null gives the empty string."""
    return F.coalesce(F.array_join(F.slice(items, 1, count), separator), F.lit(""))


def prompt(question: Column, hint: str = ANSWER_HINT) -> Column:
    return F.concat(F.coalesce(question, F.lit("")), F.lit("\n\n" + hint))


def fixed(value: Column, digits: int, prefix: str = "", signed: bool = False, suffix: str = "") -> Column:
    """`value` with a fixed number of digits; ties go to the even digit as in Python."""
    spec = f"%{'+' if signed else ''}.{digits}f"
    return F.format_string(f"{prefix}{spec}{suffix.replace('%', '%%')}", F.bround(value, digits))
