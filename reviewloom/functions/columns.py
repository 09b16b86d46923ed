"""Column expressions for coercion, derived columns and text. All run inside codegen."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.schemas import ANONYMOUS, PLATFORM_NAMES

# White space and word characters spelled out: Java's \s, \w and \b only know ASCII.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
NON_SPACE = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_space(col: Column | str) -> Column:
    """Strip white space of any kind; SQL ``trim`` strips blanks only."""
    return F.regexp_replace(_c(col), f"^{SPACE}+|{SPACE}+$", "")


def is_blank(col: Column | str) -> Column:
    return F.coalesce(trim_space(col), F.lit("")) == ""


def to_number(col: Column | str) -> Column:
    """Number or null. The pattern keeps out forms only Java reads, such as ``5d`` or ``NaN``."""
    c = _c(col).cast("string")
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def to_review_date(col: Column | str) -> Column:
    """``yyyy-MM-dd`` or null."""
    return F.try_to_date(trim_space(col), "yyyy-MM-dd")


def to_int_trunc(col: Column | str) -> Column:
    """Whole part of a number, null where it fits no int."""
    return _c(col).try_cast("int")


def fill_count(col: Column | str) -> Column:
    return F.coalesce(to_number(col).try_cast("int"), F.lit(0))


def or_default(col: Column | str, default: str | None) -> Column:
    """Trimmed text, or the default where nothing is left."""
    trimmed = F.nullif(trim_space(col), F.lit(""))
    return trimmed if default is None else F.coalesce(trimmed, F.lit(default))


def username(col: Column | str) -> Column:
    return or_default(col, ANONYMOUS)


def review_length(col: Column | str) -> Column:
    """Code points."""
    return F.length(_c(col))


def word_count(col: Column | str) -> Column:
    """White-space separated tokens."""
    return F.regexp_count(_c(col), F.lit(f"{NON_SPACE}+"))


def star_sentiment(col: Column | str) -> Column:
    c = _c(col)
    return (
        F.when(c.isNull(), "unrated")
        .when(c >= 4, "positive")
        .when(c <= 2, "negative")
        .otherwise("neutral")
    )


def month(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def check_platform(key: str) -> str:
    if key not in PLATFORM_NAMES:
        raise ValueError(f"unknown platform {key!r}, expected one of {sorted(PLATFORM_NAMES)}")
    return key


def platform_name(col: Column | str) -> Column:
    """Display name of a platform key; an unknown key fails the job."""
    c = _c(col)
    out = None
    for key, name in PLATFORM_NAMES.items():
        out = F.when(c == key, name) if out is None else out.when(c == key, name)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown platform "), c)).cast("string"))


def cut(col: Column | str, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``(low, high]``; outside all bins null. A last edge of
    ``None`` leaves the top bin open."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    c = _c(col)
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = c > low if high is None else (c > low) & (c <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def share(part: Column | str, whole: Column | str) -> Column:
    """Percentage; null for an empty whole."""
    return F.try_divide(_c(part) * F.lit(100.0), _c(whole))


# --- text ---------------------------------------------------------------------------------


def lower_without_urls(col: Column | str) -> Column:
    return F.regexp_replace(F.lower(_c(col)), f"http{NON_SPACE}+|www\\.{NON_SPACE}+", " ")


def normalise_text(col: Column | str) -> Column:
    """Lower case, addresses and runs of white space to one blank; punctuation stays. Blanks that
    stand alone are already right and are not matched."""
    runs = f"[{SPACE[1:-1]}&&[^ ]]{SPACE}*| {SPACE}+"
    return F.trim(F.regexp_replace(lower_without_urls(col), runs, " "))


def word_tokens(col: Column | str, min_chars: int = 2) -> Column:
    return F.regexp_extract_all(_c(col), F.lit(f"{WORD}{{{min_chars},}}"), F.lit(0))


def ngrams(tokens: Column | str, n: int) -> Column:
    """All 1..n-grams of a token array, each joined by a blank."""

    def build(t: Column) -> Column:
        parts = [t]
        for k in range(2, n + 1):
            # the grams one shorter without their last, each with the word that follows it
            shorter = F.slice(parts[-1], F.lit(1), F.greatest(F.size(parts[-1]) - 1, F.lit(0)))
            following = F.slice(t, F.lit(k), F.size(t))
            parts.append(F.zip_with(shorter, following, lambda a, b: F.concat(a, F.lit(" "), b)))
        return F.concat(*parts) if n > 1 else t

    # the one-element transform binds the tokens, so they are computed once
    return F.element_at(F.transform(F.array(_c(tokens)), build), 1)


def literal_count(col: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    c = _c(col)
    gone = F.replace(c, F.lit(needle), F.lit(""))
    return ((F.length(c) - F.length(gone)) / F.lit(len(needle))).cast("int")


def uppercase_ratio(col: Column | str) -> Column:
    c = _c(col)
    # taking out the few upper-case runs is cheaper than taking out everything else
    upper = F.length(c) - F.length(F.regexp_replace(c, r"\p{Lu}+", ""))
    return upper / F.greatest(F.length(c), F.lit(1))


def mean_word_length(col: Column | str) -> Column:
    c = _c(col)
    chars = F.length(F.regexp_replace(c, f"{SPACE}+", ""))
    return F.coalesce(F.try_divide(chars.cast("double"), word_count(c)), F.lit(0.0))


def whole_word_pattern(keywords: Sequence[str]) -> str:
    """Pattern for any of the keywords as whole words, to be used on lower-cased text."""
    body = "|".join(re.escape(k.lower()) for k in keywords)
    return f"(^|{NOT_WORD})({body})($|{NOT_WORD})"


def mentions(col: Column | str, keywords: Sequence[str]) -> Column:
    """1 where a keyword or phrase occurs as whole words in any case, else 0."""
    hit = F.lower(_c(col)).rlike(whole_word_pattern(keywords))
    return F.coalesce(hit, F.lit(False)).cast("int")


def class_map(pairs: Mapping[str, Column]) -> Column:
    flat: list[Column] = []
    for key, value in pairs.items():
        flat += [F.lit(key), value]
    return F.create_map(*flat)


# --- hashing ------------------------------------------------------------------------------


def portable_hash(*parts: Column | str) -> Column:
    """60-bit number from the first 15 hex digits of an md5, the same in every SQL engine."""
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
