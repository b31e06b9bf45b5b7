"""A corpus pipeline of five stages, each an operator of folia.llm on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.llm import bpe, jaccard, langid, mixing, substring_dedup
from folia.llm.common import written
from folia.llm.queries import BYTE_BPE
from folia.session import ship, table

#: Smallest margin between the two best languages.
MARGIN = 0.01


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with numbers for names, so that no column clashes with one a stage adds, and the number of each name."""
    of = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*of.values()), of


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin of at least MARGIN; lang becomes the one told.

    Rows are judged by their texts alone: repeated rows stay or go together. Null texts and texts without a letter have no language and go;
    null ids and null labels do no harm; ties between languages have no margin and go."""
    frame, of = apart(docs)
    columns = {"text_col": of["text"], "id_col": of["doc_id"], "lang_col": of["lang"]}
    known = langid.fit_dictionaries(frame.where(~langid.held_out(of["doc_id"])), **columns)
    told = langid.identify(frame, known, text_col=of["text"], keep=frame.columns, margin=MARGIN)
    kept = told.where(F.col("lang_pred") != langid.UNDETERMINED).withColumn(of["lang"], F.col("lang_pred"))
    return kept.select(*of.values()).toDF(*docs.columns)


def rows_of(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """apart(docs) with a row number: the same in each reading of a written table, so that ids may repeat or be null."""
    frame, of = apart(docs)
    return frame.withColumn("row", F.monotonically_increasing_id()), of


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of five-word shingles of 0.8 or more: that with the smallest doc_id, the first row of those that repeat it.

    Null ids come last. Null and empty texts are one group; rows that repeat a text are in its group."""
    rows, of = rows_of(docs)
    named = jaccard.near_duplicates(rows, row_col="row", text_col=of["text"], id_col=of["doc_id"])
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    firsts = named.groupBy("root").agg(F.min(order)["row"].alias("row")).select("row")
    return rows.join(firsts, "row", "left_semi").select(*of.values()).toDF(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier too; texts that lose no word stay as they are, texts that lose all go.

    n_chars, where it is there, follows the text. Null ids come last; rows that repeat id and text are one document and stay together."""
    frame, of = apart(docs)
    cut = substring_dedup.dedup_passages(frame, text_col=of["text"], id_col=of["doc_id"], carry=frame.columns)
    out = cut.where("n_removed = 0 or n_removed < n_words")
    lost = F.col("n_removed") > 0
    made = {"text": F.when(lost, F.col("kept_text")).otherwise(F.col(of["text"]))}
    if "n_chars" in of:
        made["n_chars"] = F.when(lost, F.length("kept_text")).otherwise(F.col(of["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return out.select(*[made.get(c, F.col(n)).alias(c) for c, n in of.items()])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it.

    A null source is a source; null and empty texts have no words and are not taken; rows that repeat are drawn one by one."""
    rows, of = rows_of(docs)
    columns = {"text_col": of["text"], "id_col": of["doc_id"], "source_col": of["source"]}
    took = mixing.mix_sources(rows, row_col="row", **columns).where("copies > 0").select("row", "copies")
    out = rows.join(took, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return out.select(*of.values()).toDF(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of the ids and of the text decoded from them.

    A row for each row of docs: null texts count as empty, repeated rows give equal results. Columns other than doc_id, lang and source end here."""
    return bpe.encode_decode(docs, BYTE_BPE, keep=["doc_id", "lang", "source"]).select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("language ID", language), ("near duplicates", near_duplicates), ("passages", passages), ("mixture", mixture), ("tokens", tokens)]

#: Language models, fingerprints and draws are not SQL; tests/llm hold the pipeline against a plain model of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
