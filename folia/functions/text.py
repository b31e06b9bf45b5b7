"""Text column functions: cleaning, predicates, splitting, packing."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words after which an English paragraph goes on.
CONNECTORS = "and or but because although however if while when to for in of with on as at by from such the a an".split()
# Named HTML entities that cleaning resolves.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " "}

SENTENCE_END = r"(?<=[.!?])\s+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: Column | str) -> Column:
    """Non-empty runs between white space."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def tokens(c: Column | str) -> Column:
    return words(F.lower(col(c)))


def sentences(c: Column | str) -> Column:
    return F.split(col(c), SENTENCE_END)


def unescape(c: Column | str) -> Column:
    out = col(c)
    for name, char in reversed(ENTITIES.items()):
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def clean_string(c: Column | str, ascii_only: bool = True) -> Column:
    """Unescape, drop control characters, lower-case, turn what is neither letter, digit nor space into a space, trim.

    ascii_only=False keeps letters and digits of all scripts."""
    out = F.regexp_replace(unescape(F.trim(col(c))), r"[\x00-\x1f\x7f-\x9f]", "")
    return F.trim(F.regexp_replace(F.lower(out), "[^A-Za-z0-9 ]" if ascii_only else r"[^\p{L}\p{N} ]", " "))


def clean_name(c: Column | str) -> Column:
    """Lower-case, trimmed, white space squeezed."""
    return F.regexp_replace(F.trim(F.lower(col(c))), r"\s+", " ")


def clean_type(c: Column | str) -> Column:
    return F.regexp_replace(F.trim(F.upper(col(c))), r"\s+", "_")


def split_any(c: Column | str, marks: Iterable[str]) -> Column:
    """Split on any of the marks, trim, drop empties."""
    pattern = "|".join("\\Q" + m + "\\E" for m in marks)
    return F.filter(F.transform(F.split(col(c), pattern), lambda x: F.trim(x)), lambda x: x != "")


def fix_hyphens(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"-\s+", "-")


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "<[^>]+>", "")


def is_float(c: Column | str) -> Column:
    return col(c).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")


def truncate_words(c: Column | str, n: int) -> Column:
    return F.array_join(F.slice(words(c), 1, n), " ")


def is_contents(c: Column | str) -> Column:
    """A line of a table of contents: two dot leaders, or a short text with a leader before a digit that is over a quarter dots and space."""
    t = col(c)
    share = F.length(F.regexp_replace(t, r"[^.\s]", "")) / F.length(t)
    short = (F.length(t) < 80) & t.rlike(r"[.\s]{2,}\d") & (share > 0.25)
    return F.coalesce((F.length(t) > 0) & (t.rlike(r"(\.\s*\..*?){2,}") | short), F.lit(False))


def is_boilerplate(c: Column | str) -> Column:
    """Two web or mail addresses, or a short line of digits, slashes and space."""
    t = col(c)
    links = F.size(F.regexp_extract_all(t, F.lit(r"(?:www\.\S+|https?://\S+|\S+@\S+\.\w{2,})"), 0))
    page = (F.length(F.trim(t)) < 20) & F.trim(t).rlike(r"^[\d\s/\\-]+$")
    return F.coalesce((F.length(t) > 0) & ((links >= 2) | page), F.lit(False))


def looks_incomplete(c: Column | str) -> Column:
    """A paragraph of five words and 25 characters at least that seems cut: hyphen, comma, colon or semicolon at the end, no end mark, or a connector as last word."""
    t = F.regexp_replace(col(c), r"^\s+|\s+$", "")
    bare = F.regexp_replace(t, "['\"]+$", "")
    last = F.lower(F.element_at(F.regexp_extract_all(bare, F.lit(r"\w+"), 0), -1))
    long_enough = (F.size(words(t)) >= 5) & (F.length(t) >= 25)
    cut = t.endswith("-") | bare.rlike(r"[,:;]$") | ~bare.rlike(r"[.!?]$") | F.coalesce(last.isin(CONNECTORS), F.lit(False))
    return F.coalesce(long_enough & cut, F.lit(False))


def is_acronym(c: Column | str) -> Column:
    """The first word is upper case and longer than one character."""
    first = F.get(words(c), F.lit(0))  # a blank text has none
    return F.coalesce((F.length(first) > 1) & (F.upper(first) == first) & (F.lower(first) != first), F.lit(False))


def garbage_start(c: Column | str, window: int = 15, ratio: float = 0.9) -> Column:
    """0-based word at which the first window of mostly single characters starts; null where there is none.

    One pass: a running sum of single-character words, read at both ends of the window."""
    w = words(c)
    start = F.aggregate(
        w,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("recent"), F.lit(None).cast("int").alias("found")),
        lambda s, x: F.struct(
            (s["at"] + 1).alias("at"),
            F.slice(F.concat(F.array((F.length(x) == 1).cast("int")), s["recent"]), 1, window).alias("recent"),
            F.coalesce(
                s["found"],
                F.when(
                    (s["at"] + 1 >= window)
                    & (F.aggregate(F.slice(F.concat(F.array((F.length(x) == 1).cast("int")), s["recent"]), 1, window), F.lit(0), lambda a, y: a + y) / window >= ratio),
                    s["at"] + 1 - window,
                ),
            ).alias("found"),
        ),
        lambda s: s["found"],
    )
    return start


def cut_garbage(c: Column | str, window: int = 15, ratio: float = 0.9) -> Column:
    start = garbage_start(c, window, ratio)
    return F.when(start.isNull(), col(c)).when(start == 0, F.lit("")).otherwise(F.array_join(F.slice(words(c), 1, start), " "))


def has_digit(c: Column | str) -> Column:
    return col(c).rlike(r"\d")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def pack_greedy(sizes: pd.Series, budgets: pd.Series) -> pd.Series:
    """Chunk number of each item: a chunk is closed before the item that would carry it over the budget."""
    out = []
    for items, budget in zip(sizes, budgets):
        if items is None:
            out.append(None)
            continue
        chunk, held, nums = 0, 0, []
        for n in items:
            if held and held + n > budget:
                chunk, held = chunk + 1, 0
            held += n
            nums.append(chunk)
        out.append(nums)
    return pd.Series(out)
