"""Parsed page blocks: renumbering, zipping, tables before tables, nodes from blocks, record texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import clean_name, clean_type, is_float


def drop_invalid(blocks: DataFrame, doc: str, order: str) -> DataFrame:
    """Valid blocks with pdf_id from 1 without gaps in each document."""
    return blocks.where("not coalesce(invalid, false)").withColumn("pdf_id", F.row_number().over(Window.partitionBy(doc).orderBy(order)))


def zip_lists(df: DataFrame, left: str, right: str, keep: list[str]) -> DataFrame:
    """(keep…, pos, left, right): items of two arrays by position; a missing right item is null."""
    rows = df.select(*keep, right, F.posexplode(left).alias("pos", left))
    return rows.withColumn(right, F.get(right, F.col("pos")))


def previous_of(blocks: DataFrame, doc: list[str], order: str, wanted: str, columns: list[str]) -> DataFrame:
    """Adds prev_<column>: values of the nearest block before for which `wanted` holds (a backward as-of join)."""
    w = Window.partitionBy(*doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    for c in columns:
        blocks = blocks.withColumn(f"prev_{c}", F.last(F.when(F.expr(wanted), F.col(c)), ignorenulls=True).over(w))
    return blocks


def continued_tables(tables: DataFrame, doc: list[str]) -> DataFrame:
    """Tables (doc…, pos, page, n_cols, caption) that go on from the one before: previous page, as many columns, no caption of their own."""
    t = previous_of(tables, doc, "pos", "true", ["pos", "page", "n_cols"])
    return t.withColumn("continues", F.coalesce((F.col("prev_page") == F.col("page") - 1) & (F.col("prev_n_cols") == F.col("n_cols")) & (F.coalesce("caption", F.lit("")) == ""), F.lit(False)))


def parse_records(df: DataFrame, keep: list[str], text: str, record: str = "##", field: str = "<|>", done: str = "<|COMPLETE|>") -> DataFrame:
    """(keep…, kind, name, type, target, description, weight) of delimited extraction records; others are left out.

    An entity has four fields, a relationship five; the last is the weight where it is a number, else 1."""
    quoted = lambda s: "\\Q" + s + "\\E"
    rows = df.select(*keep, F.posexplode(F.split(F.col(text), f"{quoted(record)}|{quoted(done)}")).alias("pos", "raw"))
    rows = rows.withColumn("inner", F.regexp_extract("raw", r"(?s)\((.*)\)", 1)).where("inner <> ''")
    rows = rows.withColumn("f", F.transform(F.split("inner", quoted(field)), lambda x: F.trim(F.regexp_replace(x, '^"|"$', ""))))
    kind = F.lower(F.regexp_replace(F.get("f", F.lit(0)), '"', ""))
    rows = rows.withColumn("kind", kind).where("(kind = 'entity' and size(f) >= 4) or (kind = 'relationship' and size(f) >= 5)")
    is_entity = F.col("kind") == "entity"
    last = F.element_at("f", -1)
    return rows.select(
        *keep, "pos", "kind", clean_name(F.get("f", F.lit(1))).alias("name"),
        F.when(is_entity, clean_type(F.get("f", F.lit(2)))).alias("type"),
        F.when(~is_entity, clean_name(F.get("f", F.lit(2)))).alias("target"),
        F.get("f", F.lit(3)).alias("description"),
        F.when(~is_entity, F.coalesce(F.when(is_float(last), last.try_cast("double")), F.lit(1.0))).alias("weight"),
    )


def typed_nodes(blocks: DataFrame) -> DataFrame:
    """Adds node_type and content of tree nodes: joined captions, footnotes and body by type; unknown types are text."""
    known = F.lower(F.col("type"))
    kind = F.when(known.isin("text", "title", "image", "table", "equation"), known).otherwise(F.lit("text"))
    join = lambda *c: F.trim(F.concat_ws(" ", *[F.when(F.trim(x) != "", F.trim(x)) for x in c]))
    listed = lambda c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), " ")
    content = (
        F.when(kind == "image", join(listed("image_caption"), listed("image_footnote")))
        .when(kind == "table", join(listed("table_caption"), F.col("table_body"), listed("table_footnote")))
        .otherwise(F.coalesce("text", F.lit("")))
    )
    title = (kind == "text") & F.col("text_level").isNotNull()
    return blocks.withColumn("node_type", F.when(title, F.lit("title")).otherwise(kind)).withColumn("content", content)
