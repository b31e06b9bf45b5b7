"""Tables over several pages as one, and tables as parts of an entity graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import clean_name, clean_type, truncate_words, words
from folia.operators.answers import packed
from folia.sources.html_tables import column_names, header_rows, is_number

# Weight of what a table says of its entities, words of a description that name it, and its type.
WEIGHT, NAME_WORDS, TABLE = 9.0, 8, "TABLE"


def width(grid: Column) -> Column:
    """Columns of a grid: the most of any row; 0 for an empty or null one."""
    return F.coalesce(F.array_max(F.transform(grid, F.size)), F.lit(0))


def table_chains(tables: DataFrame, doc: list[str]) -> DataFrame:
    """Adds head: the pos of the table with which a chain of continued tables begins, its own where it continues none.

    tables (doc…, pos, page, grid, caption, footnote): a table goes on from the nearest one before if that is on the page before, both have rows and equally many columns, and it has no caption and footnote of its own."""
    w = Window.partitionBy(*doc).orderBy("pos")
    t = tables.withColumn("_w", width(F.col("grid")))
    bare = (F.coalesce("caption", F.lit("")) == "") & (F.coalesce("footnote", F.lit("")) == "")
    goes_on = bare & (F.col("page") > 0) & (F.lag("page").over(w) == F.col("page") - 1) & (F.col("_w") > 0) & (F.lag("_w").over(w) == F.col("_w"))
    t = t.withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    return t.withColumn("head", F.last(F.when(~F.col("_on"), F.col("pos")), ignorenulls=True).over(w)).drop("_w", "_on")


def _continued(so_far: Column, part: Column, head: Column, n_header: Column) -> Column:
    """Rows so far and those of a further part: header rows that it repeats go, and empty cells that its first row begins with take what stands above, as a span that the page cut."""
    repeats = (n_header > 0) & (F.slice(part, 1, n_header) == F.slice(head, 1, n_header))
    rows = F.when(repeats, F.slice(part, n_header + 1, F.greatest(F.size(part) - n_header, F.lit(0)))).otherwise(part)
    first, above = F.get(rows, F.lit(0)), F.element_at(so_far, -1)
    lead = F.array_position(F.transform(first, lambda c: F.coalesce(c, F.lit("")) != ""), True)  # 0: it is empty throughout
    mended = F.transform(first, lambda c, i: F.when((i < lead - 1) & (i < F.size(above)), F.get(above, i)).otherwise(c))
    rest = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    return F.when(F.size(rows) > 0, F.concat(so_far, F.array(mended), rest)).otherwise(so_far)


def merge_continued(tables: DataFrame, doc: list[str]) -> DataFrame:
    """(doc…, pos, n_parts, last_page, caption, footnote, grid): each chain of continued tables as one table, in the place and with the caption and footnote of the first.

    A repeated header is left out and a span that a page cut is filled in. Tables without rows stay as they are."""
    t = table_chains(tables, doc)
    part = F.struct("pos", "page", "grid", "caption", "footnote")
    t = t.groupBy(*doc, F.col("head").alias("pos")).agg(F.sort_array(F.collect_list(part)).alias("x"))
    head = F.get("x", F.lit(0))
    t = t.withColumns({"_head": head["grid"], "_n": header_rows(head["grid"])})
    grid = F.aggregate(F.slice("x", 2, F.size("x")), F.col("_head"), lambda g, p: _continued(g, p["grid"], F.col("_head"), F.col("_n")))
    return t.select(*doc, "pos", F.size("x").alias("n_parts"), F.element_at("x", -1)["page"].alias("last_page"), head["caption"].alias("caption"), head["footnote"].alias("footnote"), grid.alias("grid"))


def row_batches(grid: Column, n_header: Column, budget: int) -> Column:
    """Batch number of each row under the header: rows written with bars between, whole, in order, within a budget of words; a row above it is a batch of its own."""
    return packed(F.transform(F.slice(grid, n_header + 1, F.greatest(F.size(grid) - n_header, F.lit(0))), lambda r: F.size(words(row_text(r)))), budget)


def row_text(row: Column) -> Column:
    return F.array_join(F.transform(row, lambda c: F.trim(c)), " | ")


def batches_of(tables: DataFrame, keys: list[str], budget: int, n_header: int = 1) -> DataFrame:
    """(keys…, batch, n_rows, rows): the rows of each table (keys…, grid) in batches for extraction, one row a line."""
    h = F.lit(n_header)
    rows = F.transform(F.slice("grid", h + 1, F.greatest(F.size("grid") - h, F.lit(0))), row_text)
    t = tables.select(*keys, F.posexplode(F.arrays_zip(rows.alias("r"), row_batches(F.col("grid"), h, budget).alias("b"))).alias("_at", "e"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "e.r"))), lambda e: e["r"]), "\n")
    return t.groupBy(*keys, F.col("e.b").alias("batch")).agg(F.count("*").alias("n_rows"), text.alias("rows"))


def table_entity(key: Column, caption: Column, footnote: Column) -> tuple[Column, Column]:
    """Name and description of the entity of a table: by the first words of its caption and footnote, else by its key."""
    said = F.trim(F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(footnote, F.lit(""))))
    name = F.when(said != "", truncate_words(said, NAME_WORDS)).otherwise(F.concat(F.lit("Node "), key.cast("string")))
    text = F.when(said != "", F.concat(F.lit("A data table described as: "), said)).otherwise(F.lit("A table with no available description."))
    return F.concat(F.lit("Table: "), name, F.lit("...")), text


def table_entities(tables: DataFrame, key: str, n_header: int = 1) -> DataFrame:
    """(key, place, name, type, description) of each table (key, grid, caption, footnote): the table itself, its columns by their header path, and the cells of its body that are not numbers.

    A cell's type is its column. Names are cleaned; of equal ones of a table the first stays, columns before cells, cells by row. Places count from 0."""
    g, h = F.col("grid"), F.lit(n_header)
    said, text = table_entity(F.col(key), F.col("caption"), F.col("footnote"))
    # columns of their own, so that they are made once for a table and not for each cell
    tables = tables.withColumns({"_name": said, "_columns": column_names(g, h)})
    name, columns = F.col("_name"), F.col("_columns")
    entity = lambda n, t, d: F.struct(n.alias("name"), t.alias("type"), d.alias("description"))
    heads = F.transform(columns, lambda c: entity(clean_name(c), F.lit("COLUMN"), F.concat(F.lit("A column of "), name)))
    body = F.slice(g, h + 1, F.greatest(F.size(g) - h, F.lit(0)))
    cells = F.flatten(F.transform(body, lambda r: F.filter(
        F.transform(r, lambda c, i: F.when((F.trim(c) != "") & ~is_number(c), entity(clean_name(c), clean_type(F.coalesce(F.get(columns, i), F.lit(""))), F.concat(F.lit("A cell of "), name)))), lambda x: x.isNotNull())))
    rows = tables.select(key, F.posexplode(F.concat(F.array(entity(name, F.lit(TABLE), text)), F.coalesce(heads, F.array()), F.coalesce(cells, F.array()))).alias("_at", "e")).select(key, "_at", "e.*").where("name <> ''")
    # the table's own entity is apart from what it holds
    first = rows.groupBy(key, (F.col("_at") == 0).alias("_own"), "name").agg(F.min_by(F.struct("_at", "type", "description"), "_at").alias("e")).select(key, "name", "e.*")
    return first.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("_at")) - 1).select(key, "place", "name", "type", "description")


def table_relations(entities: DataFrame, key: str) -> DataFrame:
    """(key, src, dst, weight, description): from the entity of each table to every other one of it."""
    own = F.when((F.col("type") == TABLE) & (F.col("place") == 0), F.col("name"))
    named = entities.where(F.col(key).isNotNull()).withColumn("src", F.max(own).over(Window.partitionBy(key)))
    said = F.concat(F.lit("Table '"), F.col("src"), F.lit("' contains data about '"), F.col("name"), F.lit("'."))
    return named.where((F.col("type") != TABLE) & F.col("src").isNotNull()).select(key, "src", F.col("name").alias("dst"), F.lit(WEIGHT).alias("weight"), said.alias("description"))
