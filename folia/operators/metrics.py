"""Answer metrics as column functions and aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number words of answers, in order from zero.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
ARTICLES = ("a", "an", "the")


def anls(gold: Column, predicted: Column, bar: float = 0.5) -> Column:
    """1 - edit distance / longer length; 0 at or under the bar."""
    a, b = F.lower(F.trim(gold)), F.lower(F.trim(predicted))
    longest = F.greatest(F.length(a), F.length(b))
    s = F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)
    return F.when(s > bar, s).otherwise(F.lit(0.0))


def normal_tokens(c: Column) -> Column:
    """Lower-case tokens without articles and punctuation (kept inside numbers), number words as digits."""
    words = F.split(F.regexp_replace(F.lower(c), "[-\\s]+", " "), " ")
    digits = F.create_map(*[x for k, w in enumerate(NUMBER_WORDS) for x in (F.lit(w), F.lit(str(k)))])
    bare = F.transform(words, lambda w: F.when(w.rlike(r"^[+-]?\d[\d,]*\.?\d*$"), F.regexp_replace(w, ",", "")).otherwise(F.regexp_replace(w, r"[^\p{L}\p{N}]", "")))
    bare = F.transform(bare, lambda w: F.coalesce(F.try_element_at(digits, w), w))
    return F.filter(bare, lambda w: (w != "") & ~w.isin(*ARTICLES))


def shared_tokens(gold: Column, predicted: Column) -> Column:
    """Size of the intersection of two token arrays as multisets: both are sorted together once, and each predicted token uses up one equal gold token."""
    side = lambda c, k: F.transform(c, lambda x: F.struct(x.alias("t"), F.lit(k).alias("s")))
    start = F.struct(F.lit(None).cast("string").alias("t"), F.lit(0).alias("left"), F.lit(0).alias("n"))

    def step(a: Column, e: Column) -> Column:
        left = F.when(a["t"] == e["t"], a["left"]).otherwise(0)
        hit = ((e["s"] == 1) & (left > 0)).cast("int")
        return F.struct(e["t"].alias("t"), F.when(e["s"] == 0, left + 1).otherwise(left - hit).alias("left"), (a["n"] + hit).alias("n"))

    return F.aggregate(F.array_sort(F.concat(side(gold, 0), side(predicted, 1))), start, step, lambda a: a["n"])


def token_f1(gold: Column, predicted: Column) -> Column:
    """F1 of two token arrays as multisets."""
    shared = shared_tokens(gold, predicted)
    return F.when((F.size(gold) == 0) | (F.size(predicted) == 0), (F.size(gold) == F.size(predicted)).cast("double")).otherwise(2 * shared / (F.size(gold) + F.size(predicted)))


def set_f1(gold: Column, predicted: Column) -> Column:
    """F1 of two arrays as sets; two empty ones match."""
    g, p = F.array_distinct(gold), F.array_distinct(predicted)
    return F.when(F.size(g) + F.size(p) == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(g, p)) / (F.size(g) + F.size(p)))


def list_exact(gold: Column, predicted: Column) -> Column:
    return ((F.size(gold) == F.size(predicted)) & (F.array_sort(F.array_distinct(gold)) == F.array_sort(F.array_distinct(predicted)))).cast("double")


def decimals(c: Column) -> Column:
    """Digits behind the point as a number is usually written (at least one); 3 where it is written without a point."""
    t = c.cast("string")
    return F.when(t.contains("."), F.length(F.substring_index(t, ".", -1))).otherwise(F.lit(3))


def numbers_equal(gold: Column, predicted: Column, tolerance: float = 0.01) -> Column:
    """Equal up to one percent of the larger, or when both are rounded to the fewer of their decimals (2 at least); the gold number may be in percent or a share."""
    close = lambda a, b: F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b))

    def rounded(a: Column, b: Column) -> Column:
        n = F.pow(F.lit(10.0), F.greatest(F.least(decimals(a), decimals(b)), F.lit(2)))
        return F.rint(a * n) == F.rint(b * n)

    either = [close(g, predicted) | rounded(g, predicted) for g in (gold, gold / 100, gold * 100)]
    return F.coalesce(either[0] | either[1] | either[2], F.lit(False))


def clean_answer(c: Column) -> Column:
    """Lower case, without bracketed remarks, one quote at either end, a dollar sign ahead and percent signs behind."""
    t = F.trim(F.regexp_replace(F.trim(F.lower(c)), r"\s*\([^)]*\)", ""))
    t = F.trim(F.regexp_replace(t, "^['\"]|['\"]$", ""))
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(t, r"^\$+", "")), "%+$", ""))


# Patterns of answers that have to match as a whole.
EXACT = (
    "https://",
    r"\.py$|ipynb$",
    "^page",
    r"^\d+(-\d+|\s\d+)?$",
    r"a\.m\.|p\.m\.",
    r"^\d{4}[-\s]\d{2}[-\s]\d{2}$",
    r"^\d{4}[-\s]\d{2}$",
    r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
)


def exact_only(c: Column) -> Column:
    """Web addresses, code files, pages, telephone numbers, times, dates and mail addresses."""
    return c.rlike("|".join(f"(?:{x})" for x in EXACT))


def typed_score(kind: Column, gold: Column, predicted: Column) -> Column:
    """Score by answer format. Int: the whole parts are equal. Float: numbers_equal. Str and None: the cleaned texts, by equality
    where the gold one is exact_only, else by ANLS. Others are lists (JSON arrays or one item): of one length, sorted after cleaning, equal if
    the first gold item is a number or exact_only, else the least ANLS of the pairs."""
    plain = lambda a, b: F.when(exact_only(a), (a == b).cast("double")).otherwise(anls(a, b))
    items = lambda c: F.array_sort(F.transform(F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>")).otherwise(F.array(c)), clean_answer))
    g, p = items(gold), items(predicted)
    first = F.get(g, F.lit(0))
    strict = first.try_cast("double").isNotNull() | exact_only(first)
    listed = F.when(F.size(g) != F.size(p), F.lit(0.0)).when(strict, (g == p).cast("double")).otherwise(F.array_min(F.zip_with(g, p, lambda a, b: anls(a, b))))
    whole = F.trim(gold).try_cast("long") == F.trim(predicted).try_cast("double").cast("long")
    number = lambda c: clean_answer(c).try_cast("double")
    return (
        F.when(kind == "Int", F.coalesce(whole.cast("double"), F.lit(0.0)))
        .when(kind == "Float", numbers_equal(number(gold), number(predicted)).cast("double"))
        .when(kind.isin("Str", "None"), plain(clean_answer(gold), clean_answer(predicted)))
        .otherwise(F.coalesce(listed, F.lit(0.0)))
    )


def assignment(m: np.ndarray) -> float:
    """Greatest sum over a one-to-one choice of a column for each row; at least as many columns as rows. Shortest augmenting paths."""
    n, w = m.shape
    u, v, row_of = np.zeros(n + 1), np.zeros(w + 1), np.zeros(w + 1, int)
    cost = np.zeros((n + 1, w + 1))
    cost[1:, 1:] = -m
    for i in range(1, n + 1):
        row_of[0], at = i, 0
        least, way, used = np.full(w + 1, np.inf), np.zeros(w + 1, int), np.zeros(w + 1, bool)
        while row_of[at]:
            used[at] = True
            lack = cost[row_of[at]] - u[row_of[at]] - v
            closer = ~used & (lack < least)
            least[closer], way[closer] = lack[closer], at
            nearest = int(np.where(used, np.inf, least).argmin())
            step = least[nearest]
            u[row_of[used]] += step
            v[used] -= step
            least[~used] -= step
            at = nearest
        while at:
            row_of[at] = row_of[way[at]]
            at = way[at]
    return float(sum(m[row_of[j] - 1, j - 1] for j in range(1, w + 1) if row_of[j]))


@F.pandas_udf(T.DoubleType())
def aligned_f1(gold: pd.Series, predicted: pd.Series) -> pd.Series:
    """Mean token F1 over the best one-to-one alignment of answer spans, over the longer list; 2 decimals."""

    def f1(a: str, b: str) -> float:
        x, y = set(a.lower().split()), set(b.lower().split())
        nums = lambda s: {t for t in s if t.replace(".", "", 1).isdigit()}
        if nums(x) and not nums(x) & nums(y):
            return 0.0
        return 2 * len(x & y) / (len(x) + len(y)) if x and y else float(x == y)

    def one(g, p) -> float:
        g, p = list(g if g is not None else []), list(p if p is not None else [])
        if not g or not p:
            return float(len(g) == len(p))
        if len(g) > len(p):
            g, p = p, g
        m = [[f1(a, b) for b in p] for a in g]
        best = assignment(np.array(m))
        return round(best / len(p), 2)

    return pd.Series([one(g, p) for g, p in zip(gold, predicted)])


def accuracy_f1(df: DataFrame, group: list[str], score: str, answerable: str, answered: str) -> DataFrame:
    """Mean score, and F1: the scores of answerable samples over the number of answerable and of answered ones; 0 where a part is empty."""
    hit = F.sum(F.when(F.col(answerable), F.col(score)).otherwise(0.0))
    recall = F.try_divide(hit, F.sum(F.col(answerable).cast("double")))
    precision = F.try_divide(hit, F.sum(F.col(answered).cast("double")))
    t = df.groupBy(*group).agg(F.avg(score).alias("accuracy"), F.coalesce(recall, F.lit(0.0)).alias("recall"), F.coalesce(precision, F.lit(0.0)).alias("precision"))
    return t.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
