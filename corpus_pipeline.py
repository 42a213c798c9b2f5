"""Documents to packed training bins: toxicity, quality rules, near-dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next stage's docs.

In every stage, rows with a null doc_id, repeated rows, very long texts and further columns are handled as the operator's
own docstring says; an empty table gives an empty one. Columns named like those that an operator uses itself do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import packing, quality, simhash, toxicity
from quillmill.llm.scratch import Scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance calls toxic go; the labels train it.

    Null, empty and wordless texts stay, as do all rows where the labels tell no two classes apart. Of repeated rows all
    stay or all go. Long texts are judged whole.
    """
    return toxicity.drop_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the compression bands, and those with a null or empty text, go.

    Rows with a null doc_id are judged like any other. Of repeated rows all stay or all go. Long texts are judged whole.
    """
    return quality.drop_low_quality(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least doc_id.

    Rows with a null doc_id or a blank text all stay. Of repeated rows one stays; ties of doc_id go to the least text.
    """
    return simhash.drop_near_duplicates(spark, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents, packed: one row per bin.

    Rows with a null doc_id or without a token aren't packed. A long document is cut over bins, and none of it is lost.
    """
    return packing.pack(spark, docs)


STAGES = [("toxicity", toxicity_stage), ("quality rules", quality_stage), ("near-dedup", near_dedup_stage), ("best-fit packing", packing_stage)]

#: SQL has neither zstandard nor a best-fit fold: tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to the table documents. A stage's files go once the next one is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), str(k))
        if k:
            scratch.drop(str(k - 1))
    return docs
