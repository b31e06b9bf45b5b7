"""What extraction gives for equations and titles, and the repair of its records before they enter a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import clean_name, truncate_words
from folia.plans.runtime import materialize

# Types of entities that are made here, words that name an equation, and the similarity from which a name is taken for another.
EQUATION, UNKNOWN, NAME_WORDS, LEAST = "EQUATION_OR_FORMULA", "UNKNOWN", 8, 0.9
# Lines that open a table as text.
HEAVY, WORDED, CAPTION, FOOTNOTE = "Type: Data-heavy table (schema summary)", "Type: Text-heavy table (full linearization)", "Table Caption: ", "Footnote: "


def equation_entity(content: Column) -> Column:
    """(name, type, description) of an equation that a model gives nothing for: by its first words."""
    return F.struct(F.concat(F.lit("Equation: "), truncate_words(content, NAME_WORDS)).alias("name"), F.lit(EQUATION).alias("type"), F.concat(F.lit("A formula represented by LaTeX code: "), content).alias("description"))


def title_contexts(tree: DataFrame, doc: list[str], title: str = "title") -> DataFrame:
    """(doc…, node_id, title, titles, previous, next): what a title is given to be read in: the titles on its path from the root down to its parent, and those of the nearest siblings before and after (null at the ends).

    tree (doc…, node_id, parent_id, path, title) with paths of ids; ids of siblings are in order."""
    at = tree.select(*doc, "node_id", F.posexplode(F.slice("path", 1, F.size("path") - 1)).alias("_at", "_up"))
    above = at.join(tree.select(*doc, F.col("node_id").alias("_up"), F.col(title).alias("_title")), [*doc, "_up"]).groupBy(*doc, "node_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_at", "_title"))), lambda x: x["_title"]).alias("titles"))
    w = Window.partitionBy(*doc, "parent_id").orderBy("node_id")
    alone = F.col("parent_id").isNull()
    t = tree.select(*doc, "node_id", F.col(title).alias("title"), F.when(~alone, F.lag(title).over(w)).alias("previous"), F.when(~alone, F.lead(title).over(w)).alias("next"))
    return t.join(above, [*doc, "node_id"], "left").select(*doc, "node_id", "title", F.coalesce("titles", F.array().cast("array<string>")).alias("titles"), "previous", "next")


def repair_records(entities: DataFrame, relations: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(entities (key, name, type, description), relations (key, src, dst, relation, weight, description)) of the records of each extraction, ready for a graph.

    Names are in lower case with single spaces, types in upper case with underscores. Entities (key, pos, name, type, description) that agree in name and type are one, their descriptions in order with a space between. An end of a relation
    (key, pos, src, dst, relation, weight, description) that no entity of the extraction bears becomes the nearest name by edit distance, if alike enough, else an entity of type UNKNOWN without description. Of relations with equal ends and name the first stays.
    An extraction is what one chunk gives, so its names are compared with each other; unknown names attract no others."""
    entity = F.struct("pos", "name", "type", "description")
    relation = F.struct("pos", "src", "dst", "relation", "weight", "description")
    e = entities.groupBy(key).agg(F.collect_list(entity).alias("entities"))
    r = relations.groupBy(key).agg(F.collect_list(relation).alias("relations"))
    return repair_grouped(e.join(r.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "full").select(F.coalesce(key, "_k").alias(key), "entities", "relations"), key)


def _matches(known: Column, asked: Column) -> Column:
    """(name, match) of each name asked for: itself where it is known, else the nearest known name by edit distance, the smallest on ties, null under the threshold; lengths that alone keep a name under it are not compared."""

    def nearest(name: Column) -> Column:
        longest = lambda k: F.greatest(F.length(name), F.length(k))
        near = F.filter(known, lambda k: F.abs(F.length(name) - F.length(k)) <= (1 - LEAST) * longest(k) + 1e-6)
        best = F.array_min(F.transform(near, lambda k: F.struct((-(1 - F.levenshtein(name, k) / longest(k))).alias("s"), k.alias("k"))))
        return F.when(F.coalesce(F.array_contains(known, name), F.lit(False)), name).when(-best["s"] >= LEAST, best["k"])

    return F.transform(asked, lambda n: F.struct(n.alias("name"), nearest(n).alias("match")))


def repair_grouped(records: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """repair_records of extractions that are one row each: key, entities of (pos, name, type, description), relations of (pos, src, dst, relation, weight, description); either may be null.

    Only the written table of these is read twice; what is done inside an extraction is done in its row, without a further shuffle. Records without a key are not compared with each other."""
    e = F.transform("entities", lambda x: F.struct(x["pos"].alias("pos"), clean_name(x["name"]).alias("name"), F.replace(F.upper(x["type"]), F.lit(" "), F.lit("_")).alias("type"), F.coalesce(x["description"], F.lit("")).alias("description")))
    ends = lambda x: (clean_name(x["src"]).alias("src"), clean_name(x["dst"]).alias("dst"))
    r = F.transform("relations", lambda x: F.struct(*ends(x), x["relation"].alias("relation"), x["pos"].alias("pos"), x["weight"].alias("weight"), x["description"].alias("description")))
    t = materialize(records.select(key, e.alias("entities"), r.alias("relations")))
    kinds = F.array_distinct(F.transform("entities", lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))))
    said = lambda k: F.array_sort(F.transform(F.filter("entities", lambda x: x["name"].eqNullSafe(k["name"]) & x["type"].eqNullSafe(k["type"])), lambda x: F.struct(x["pos"].alias("pos"), x["description"].alias("description"))))
    merged = F.transform(kinds, lambda k: F.struct(k["name"].alias("name"), k["type"].alias("type"), F.array_join(F.transform(said(k), lambda x: x["description"]), " ").alias("description")))
    known = F.when(F.col(key).isNotNull(), F.array_distinct(F.filter(F.transform("entities", lambda x: x["name"]), lambda n: n.isNotNull())))
    names = F.array().cast("array<string>")
    asked = F.array_distinct(F.flatten(F.transform("relations", lambda x: F.array(x["src"], x["dst"]))))
    t = t.withColumns({"_known": F.coalesce(known, names), "_asked": asked}).withColumn("_to", _matches(F.col("_known"), F.col("_asked")))
    fresh = F.transform(F.filter("_to", lambda x: x["match"].isNull()), lambda x: F.struct(x["name"].alias("name"), F.lit(UNKNOWN).alias("type"), F.lit("").alias("description")))
    every = t.select(key, F.explode(F.concat(F.coalesce(merged, F.array().cast("array<struct<name:string,type:string,description:string>>")), F.coalesce(fresh, F.array().cast("array<struct<name:string,type:string,description:string>>")))).alias("x")).select(key, "x.name", "x.type", "x.description")
    to = F.map_from_entries(F.transform(F.filter("_to", lambda x: x["name"].isNotNull()), lambda x: F.struct(x["name"], F.coalesce(x["match"], x["name"]))))
    t = t.where(F.col(key).isNotNull()).select(key, "relations", to.alias("_to"))
    known_ends = F.filter("relations", lambda x: x["src"].isNotNull() & x["dst"].isNotNull())
    rows = F.array_sort(F.transform(known_ends, lambda x: F.struct(F.try_element_at("_to", x["src"]).alias("src"), F.try_element_at("_to", x["dst"]).alias("dst"), *[x[c].alias(c) for c in ("relation", "pos", "weight", "description")])))
    same = lambda x, y: x["src"].eqNullSafe(y["src"]) & x["dst"].eqNullSafe(y["dst"]) & x["relation"].eqNullSafe(y["relation"])
    first = F.filter("_rows", lambda x, i: (i == 0) | ~same(x, F.get("_rows", i - 1)))
    t = t.select(key, rows.alias("_rows")).select(key, F.explode(first).alias("x"))
    return every, t.select(key, "x.src", "x.dst", "x.relation", "x.weight", "x.description")


def schema_summary(grid: Column, caption: Column, footnote: Column, share: float = 0.5) -> Column:
    """A table as text: where at least `share` of its cells are without a letter, its labels by place (the first two rows, the first two columns, elsewhere); else a sentence for each row under the first.

    A table without cells is its caption."""
    letters = lambda c: c.rlike(r"\p{L}")
    none = F.array().cast("array<string>")
    g = F.coalesce(grid, F.array().cast("array<array<string>>"))
    cells = F.filter(F.flatten(g), lambda c: F.coalesce(c, F.lit("")) != "")
    labels = lambda c: F.array_sort(F.array_distinct(F.filter(c, lambda x: F.coalesce(x, F.lit("")).rlike(r"\p{L}"))))
    across, down = labels(F.flatten(F.slice(g, 1, 2))), labels(F.flatten(F.transform(g, lambda r: F.slice(r, 1, 2))))
    other = F.array_except(F.array_except(labels(cells), across), down)
    line = lambda name, x: F.when(F.size(x) > 0, F.concat(F.lit(f"{name}: "), F.array_join(x, ", ")))
    some = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name), c))
    head = F.coalesce(F.get(g, F.lit(0)), none)

    def sentence(row: Column, i: Column) -> Column:
        parts = F.filter(F.transform(row, lambda c, k: F.when((F.coalesce(c, F.lit("")) != "") & (F.coalesce(F.get(head, k), F.lit("")) != ""), F.concat(F.lit("'"), F.get(head, k), F.lit("' is '"), c, F.lit("';")))), lambda x: x.isNotNull())
        return F.rtrim(F.concat(F.lit("Row "), (i + 1).cast("string"), F.lit(": "), F.array_join(parts, " ")))

    rows = F.transform(F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(0))), sentence)
    heavy = F.size(F.filter(cells, lambda c: ~letters(c))) >= share * F.size(cells)
    data = F.concat_ws("\n", some(CAPTION, caption), F.lit(HEAVY), line("Column Labels", across), line("Row Labels", down), line("Other Labels", other), some(FOOTNOTE, footnote))
    text = F.concat_ws("\n", some(CAPTION, caption), F.lit(WORDED), F.when(F.size(rows) > 0, F.array_join(rows, "\n")), some(FOOTNOTE, footnote))
    return F.when(F.size(cells) == 0, F.coalesce(caption, F.lit(""))).when(heavy, data).otherwise(text)
