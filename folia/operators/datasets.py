"""Question sets from groups of chunks: groups that hold, samples with their evidence, and the share of single chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.operators.collections import IMAGE, TABLE, node_type
from folia.operators.repair import chunk_type
from folia.operators.sampling import draw

# Characters of evidence of an image and of other chunks, and the size of a group of several chunks.
IMAGE_CHARS, OTHER_CHARS = 300, 500
FEWEST, MOST = 2, 4


def valid_groups(groups: DataFrame, nodes: DataFrame, group: str = "group_id", ids: str = "ids") -> DataFrame:
    """Groups (group, ids) as a model may give them, with their ids known, each once and in their order, the first four at most; groups of fewer than two go."""
    each = groups.select(group, F.posexplode(ids).alias("_at", "_id")).groupBy(group, "_id").agg(F.min("_at").alias("_at"))
    known = each.join(nodes.select(F.col("index_id").alias("_id")).distinct(), "_id", "left_semi")
    kept = known.groupBy(group).agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_id"))), lambda x: x["_id"]), 1, MOST).alias("_ids"))
    return groups.join(kept.where(F.size("_ids") >= FEWEST), group).withColumn(ids, F.col("_ids")).drop("_ids")


def evidence_content(kind: Column, content: Column, caption: Column, table_body: Column, summary: Column) -> Column:
    """What a sample shows of a chunk: a table its caption or else its body, an image its caption and summary, others their content; cut to so many characters."""
    some = lambda c: F.coalesce(c, F.lit(""))
    table = F.when(some(caption) != "", caption).otherwise(some(table_body))
    image = F.concat(some(caption), F.lit(" | "), some(summary))
    return F.when(kind == TABLE, F.substring(table, 1, OTHER_CHARS)).when(kind == IMAGE, F.substring(image, 1, IMAGE_CHARS)).otherwise(F.substring(some(content), 1, OTHER_CHARS))


def assemble_samples(groups: DataFrame, nodes: DataFrame, answers: DataFrame, group: str = "group_id", ids: str = "ids") -> DataFrame:
    """(group, question, answer, chunk_ids, evidences (chunk_id, chunk_type, page, content), chunk_types, is_multi_chunk, …): a sample for each group with a question (group, question, answer).

    nodes (index_id, type, content, caption, table_body, summary, page_idx); pages count from 1. Chunks stand in the order of their group, types once each. Ids without a node are left out. A chunk that stands in very many groups is joined to rows, not gathered; a group is small."""
    rows = groups.select(group, F.posexplode(ids).alias("_at", "index_id")).join(nodes, "index_id")
    kind = node_type(F.col("type"))
    shown = F.struct(
        "_at", F.col("index_id").alias("chunk_id"), chunk_type(F.col("type")).alias("chunk_type"), (F.col("page_idx") + 1).alias("page"),
        evidence_content(kind, F.col("content"), F.col("caption"), F.col("table_body"), F.col("summary")).alias("content"),
    )
    got = rows.groupBy(group).agg(F.sort_array(F.collect_list(shown)).alias("_e"))
    out = answers.select(group, F.trim("question").alias("question"), F.trim("answer").alias("answer")).join(got, group).join(groups.drop(ids), group)
    evidences = F.transform("_e", lambda e: F.struct(e["chunk_id"].alias("chunk_id"), e["chunk_type"].alias("chunk_type"), e["page"].alias("page"), e["content"].alias("content")))
    more = [c for c in groups.columns if c not in (group, ids)]
    return out.select(group, "question", "answer", F.transform("_e", lambda e: e["chunk_id"]).alias("chunk_ids"), evidences.alias("evidences"), F.array_distinct(F.transform("_e", lambda e: e["chunk_type"])).alias("chunk_types"), (F.size("_e") > 1).alias("is_multi_chunk"), *more)


def sample_groups(single: DataFrame, multi: DataFrame, total: int, share: float, seed: int, group: str = "group_id") -> DataFrame:
    """`total` groups, round(total * share) of them single and the rest of several chunks, by draw; a kind that has too few gives all. place is the shuffled order."""
    n = round(total * share)
    took = [df.orderBy(draw(seed, F.lit(k), group), group).limit(m).withColumn("kind", F.lit(k)) for k, df, m in (("single", single, n), ("multi", multi, total - n))]
    return took[0].unionByName(took[1]).withColumn("place", draw(seed + 1, "kind", group))
