"""Readers and writers of the library's tables: datasets, trees, graphs, caches, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DATASET = "question string, answer string, doc_uuid string, doc_path string"
NODE = "index_id int, parent_id int, type string, summary string, meta_info struct<file_name:string,page_idx:int,pdf_id:int,caption:string,footnote:string,table_body:string,content:string,title_level:int>"
TREE = f"nodes array<struct<{', '.join(f'{a}:{b}' for a, b in (x.split(' ', 1) for x in NODE.split(', ')))}>>"
ENTITY = "entity_name string, entity_type string, description string, source_ids array<int>"
GRAPH = (
    "graph struct<nodes:array<struct<id:string,entity_name:string,entity_type:string,description:string,source_ids:array<int>>>,"
    "links:array<struct<source:string,target:string,relation_name:string,weight:double,description:string,source_ids:array<int>>>>, tree2kg map<string,array<string>>"
)


def read_dataset(spark: SparkSession, path: str, schema: str = DATASET, lines: bool = False) -> DataFrame:
    """Questions from JSON arrays, or with `lines` an object a line."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """(doc_path, index_id, parent_id, type, summary, meta_info) of tree files; type is the short lower-case name."""
    raw = spark.read.schema(TREE).option("multiLine", True).json(path).withColumn("doc_path", F.input_file_name())
    n = raw.select("doc_path", F.explode("nodes").alias("n")).select("doc_path", "n.*")
    return n.withColumn("type", F.lower(F.regexp_replace("type", "^NodeType\\.", "")))


def read_graphs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vertices, edges and the node-to-vertex bridge of node-link graph files."""
    raw = spark.read.schema(GRAPH).option("multiLine", True).json(path).withColumn("doc_path", F.input_file_name())
    vertices = raw.select("doc_path", F.explode("graph.nodes").alias("v")).select("doc_path", "v.*")
    edges = raw.select("doc_path", F.explode("graph.links").alias("e")).select("doc_path", "e.*")
    bridge = raw.select("doc_path", F.explode("tree2kg").alias("node", "ids")).select("doc_path", F.col("node").cast("int").alias("node"), F.explode("ids").alias("vertex"))
    return vertices, edges, bridge


def write_trees(nodes: DataFrame, path: str, doc: str = "doc_path") -> None:
    """A JSON object a document, nodes in index order."""
    cols = [c for c in nodes.columns if c != doc]
    t = nodes.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("nodes"))
    t.select(F.to_json(F.struct("nodes")).alias("value")).write.text(path)


def without_done(tasks: DataFrame, done: DataFrame, keys: list[str], output: str = "output") -> DataFrame:
    """Tasks that have no result yet; an empty output is none."""
    return tasks.join(done.where(f"coalesce({output}, '') <> ''").select(*keys).distinct(), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows in place of old ones with the same keys; the caller writes the result."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def delete(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(gone.select(*keys).distinct(), keys, "left_anti")


def quarantine(rows: DataFrame, problem: str) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and those for which the expression `problem` gives a text, with it as `error`."""
    t = rows.withColumn("error", F.expr(problem))
    return t.where("error is null").drop("error"), t.where("error is not null")


def first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by input order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_r = 1").drop("_r")


def pack_columns(df: DataFrame, cols: list[str], order: str) -> DataFrame:
    """One JSON array of the chosen columns for a small table."""
    inner = F.sort_array(F.collect_list(F.struct(order, *[c for c in cols if c != order])))
    return df.agg(F.to_json(F.transform(inner, lambda x: F.struct(*[x[c].alias(c) for c in cols]))).alias("json"))
