"""Default extraction without a model: mentions by capital letters, relations by shared sentences, JSON fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions.text import clean_name, sentences


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, sentence, name, n): capitalised words that do not open their sentence, by sentence."""
    s = docs.select(id_col, F.posexplode(sentences(text_col)).alias("sentence", "s"))
    found = F.regexp_extract_all("s", F.lit(r"[a-z,;] ([A-Z][a-z]+)"), 1)
    return s.select(id_col, "sentence", F.explode(found).alias("raw")).groupBy(id_col, "sentence", clean_name("raw").alias("name")).agg(F.count("*").alias("n"))


def co_mentions(found: DataFrame, id_col: str) -> DataFrame:
    """(a, b, weight): names that share a sentence; pairs stay inside sentences, so their number follows the text."""
    x = found.select(id_col, "sentence", F.col("name").alias("a"))
    y = found.select(id_col, "sentence", F.col("name").alias("b"))
    return x.join(y, [id_col, "sentence"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("weight"))


def first_object(c: Column | str) -> Column:
    """The text from the first brace to the last: the JSON object in an answer with words around it; null where there is none."""
    t = F.col(c) if isinstance(c, str) else c
    found = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def first_array(c: Column | str) -> Column:
    t = F.col(c) if isinstance(c, str) else c
    found = F.regexp_extract(t, r"(?s)(\[.*\])", 1)
    return F.when(found != "", found)


def repaired_json(c: Column | str) -> Column:
    """The object with code fences and trailing commas gone and single quotes doubled, as text that from_json can take."""
    t = F.regexp_replace(first_object(c), r",\s*([}\]])", "$1")
    return F.when(F.try_parse_json(t).isNotNull(), t).otherwise(F.replace(t, F.lit("'"), F.lit('"')))


def key_values(c: Column | str) -> Column:
    """Map of lines `key: value`; keys lower-case and trimmed; later lines win."""
    t = F.col(c) if isinstance(c, str) else c
    lines = F.filter(F.split(t, "\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.regexp_extract(x, r"^([^:]*):", 1))).alias("key"), F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)
