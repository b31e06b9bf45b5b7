"""Markdown as content blocks: headings, paragraphs, images and pipe tables, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import strip_tags


def markdown_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pdf_id, type, text, text_level, img_path): blocks in order, numbered from 0.

    A heading, an image alone on its line and a run of table lines are blocks; other lines up to the next blank line are one paragraph. Tags are dropped."""
    lines = docs.select(id_col, F.posexplode(F.split(F.regexp_replace(text_col, "\r\n?", "\n"), "\n")).alias("line_no", "line"))
    t = F.trim("line")
    kind = (
        F.when(t == "", "blank").when(t.rlike(r"^#{1,6}\s"), "title").when(t.rlike(r"^!\[[^\]]*\]\([^)]*\)$"), "image")
        .when(t.rlike(r"^\|.*\|$"), "table").otherwise("text")
    )
    w = Window.partitionBy(id_col).orderBy("line_no")
    lines = lines.withColumn("type", kind)
    starts = (F.col("type") != F.lag("type").over(w)) | F.col("type").isin("title", "image") | F.lag("type").over(w).isNull()
    runs = lines.withColumn("run", F.sum(starts.cast("int")).over(w)).where("type <> 'blank'")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("line_no", F.trim("line").alias("line")))), lambda x: x["line"])
    blocks = runs.groupBy(id_col, "run", "type").agg(F.array_join(ordered, "\n").alias("raw"))
    text = (
        F.when(F.col("type") == "title", F.regexp_replace("raw", r"^#+\s+|\s+#+$", ""))
        .when(F.col("type") == "image", F.regexp_extract("raw", r"^!\[([^\]]*)\]", 1)).otherwise(F.col("raw"))
    )
    return blocks.select(
        id_col, (F.row_number().over(Window.partitionBy(id_col).orderBy("run")) - 1).alias("pdf_id"), "type", strip_tags(text).alias("text"),
        F.when(F.col("type") == "title", F.length(F.regexp_extract("raw", "^(#+)", 1))).alias("text_level"),
        F.when(F.col("type") == "image", F.regexp_extract("raw", r"\(([^)]*)\)$", 1)).alias("img_path"),
    )
