"""The corpus pipeline: documents in, the training mix out.

Every stage takes (spark, docs, sf_dir), works on all rows of `docs` and
returns a DataFrame that is written as Parquet and read again for the next one.
All but the last return the columns of `docs`, whatever their names; an empty
table gives an empty one at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import op1_jaccard, op4_decontaminate, op6_lines, op8_quality, op10_mixing
from adlake.llm.tables import free_name, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands or the base rules reject go, those
    with a null or empty text among them.  Repeated rows are judged alike."""
    return op8_quality.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut out of the texts, and n_chars follows.
    A document of which no line is left goes.  Null texts and texts without a
    line that isn't blank stay as they are; of rows equal in doc_id and text all
    stay; columns may have any names."""
    lines = free_name(docs, "_lines")
    rows = op6_lines.deduplicated(docs, name=lines)
    emptied = (F.col(f"{lines}.n_removed") > 0) & (F.col(f"{lines}.n_removed") == F.col(f"{lines}.n_lines"))
    changed = F.col(f"{lines}.n_removed") > 0
    new = {"text": F.col(f"{lines}.kept"), "n_chars": F.length(f"{lines}.kept")}
    return rows.where(~emptied).select(*[
        F.when(changed, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id,
    null first, then by a digest of the text; of repeated rows one.  Documents
    without words all stay."""
    return op1_jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.  Null texts hold none; an
    empty benchmark lets all stay."""
    return op4_decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document, in the order of the mix.
    Documents without words are never taken.  Ties and repeated rows have one
    place by id and text, and are taken alike."""
    return op10_mixing.mixed(docs)


STAGES = [
    ("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing)]

# Compression ratios and the mix's shuffled order have no SQL form; tests/llm
# holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
