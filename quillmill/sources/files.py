"""Readers of files: Markdown, question sets, and an inventory of binary documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, file_name, text) of the .md files in a folder, not below it. doc_id is a hash of the path.

    A folder that is missing or holds none gives an empty table.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "doc_id long, source string, file_name string, text string")
    path = F.col("_metadata.file_path")
    files = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return files.select(F.xxhash64(path).alias("doc_id"), path.alias("source"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def read_binary_documents(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, size_mb, content) of all matching files below a folder; content is read only if it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.round(F.col("length") / 1048576.0, 2).alias("size_mb"), "content")


def page_type(pages: DataFrame, least_chars: int = 80, image_share: float = 0.5) -> DataFrame:
    """(path, num_pages, avg_chars_per_page, image_page_ratio, page_type) from (path, page_no, n_chars, big_image)."""
    per = pages.groupBy("path").agg(F.count("*").alias("num_pages"), F.round(F.avg("n_chars"), 1).alias("avg_chars_per_page"), F.round(F.avg(F.col("big_image").cast("int")), 2).alias("image_page_ratio"), F.avg("n_chars").alias("__c"), F.avg(F.col("big_image").cast("int")).alias("__i"))
    return per.withColumn("page_type", F.when((F.col("__c") < least_chars) | (F.col("__i") >= image_share), "scan").otherwise("text")).drop("__c", "__i")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """One row per question of a JSON file: a list, or an object with a list `questions`. A row without one fails."""
    raw = spark.read.option("multiLine", True).json(path)
    rows = raw.select(F.explode("questions").alias("q")).select("q.*") if "questions" in raw.columns else raw
    if "question" not in rows.columns:
        raise ValueError("a question set needs the field question")
    return rows.withColumn("question", F.when(F.length("question") > 0, F.col("question")).otherwise(F.raise_error(F.lit("a question is missing"))))


def numbered_questions(questions: DataFrame) -> DataFrame:
    """questions with qid: their id where they have one, else a hash of the question."""
    given = F.col("id").cast("string") if "id" in questions.columns else F.lit(None).cast("string")
    return questions.withColumn("qid", F.coalesce(given, F.sha2("question", 256)))
