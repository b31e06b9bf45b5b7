"""Graphs as files: node-link JSON of one graph, and stores of three tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERTEX = "id: string, entity_name: string, entity_type: string, description: string, source_ids: array<long>"
LINK = "source: string, target: string, weight: double, relation_name: string, description: string, source_ids: array<long>"
#: A graph with its links to tree nodes, as one JSON object.
NODE_LINK = f"graph struct<nodes: array<struct<{VERTEX}>>, links: array<struct<{LINK}>>>, tree2kg map<string, array<string>>, variant string"


def read_node_link(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, edges, bridge (node, entity)) of node-link JSON files, one graph each; keys of tree nodes are numbers, source_ids without repeats. Several files are one graph each, told apart by column `file`."""
    g = spark.read.schema(NODE_LINK).option("multiLine", True).json(path).withColumn("file", F.input_file_name())
    sources = F.array_sort(F.array_distinct(F.coalesce("source_ids", F.array().cast("array<long>"))))
    vertices = g.select("file", F.explode("graph.nodes").alias("n")).select("file", "n.*").withColumn("source_ids", sources)
    edges = g.select("file", F.explode("graph.links").alias("l")).select("file", "l.*").withColumn("source_ids", sources)
    bridge = g.select("file", F.explode("tree2kg").alias("node", "e")).select("file", F.col("node").cast("long").alias("node"), F.explode("e").alias("entity")).distinct()
    return vertices, edges, bridge


def save_graph(vertices: DataFrame, edges: DataFrame, bridge: DataFrame, path: str) -> None:
    """Three Parquet tables under a folder; a graph of any size, where one JSON object would have to pass one task."""
    for name, df in (("vertices", vertices), ("edges", edges), ("bridge", bridge)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{path}/{name}") for name in ("vertices", "edges", "bridge"))


def add_and_link(vertices: DataFrame, bridge: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, bridge) after found vertices (node, pos, id, …): the first definition of a vertex stays, that of the graph before any found one, and every tree node is linked to what it found."""
    columns = vertices.columns
    fresh = found.join(vertices.select("id"), "id", "left_anti").groupBy("id").agg(F.min_by(F.struct(*[c for c in columns if c != "id"]), F.struct("node", "pos")).alias("x")).select("id", "x.*").select(columns)
    links = bridge.select("node", "entity").unionByName(found.select("node", F.col("id").alias("entity"))).distinct()
    return vertices.unionByName(fresh), links


def lookup(vertices: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices of the ids asked for, ids that no vertex has)."""
    ids = asked.select("id").distinct()
    return vertices.join(ids, "id", "left_semi"), ids.join(vertices.select("id"), "id", "left_anti")
