"""Namespaces, records of vectors, exact similarity search, and evaluation of what was found."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillmill.functions.ids import ascii_slug, label_id

#: Questions that are sent to every executor at once. More of them are searched for in blocks of so many.
BLOCK_QUESTIONS = 10_000
METRICS = ("cosine", "dotproduct", "euclidean")

# --- namespaces -----------------------------------------------------------------------------------------------------

#: label -> (id, what belongs there)
NAMESPACES = {
    "Dépannage": ("depannage", "faults, alarms, symptoms and their remedies"),
    "Dimensionnement": ("dimensionnement", "calculations, selection and capacities"),
    "Général": ("general", "anything else"),
}


def namespace(source: Column, strategy: str = "none", prefix: str = "") -> Column:
    """The partition of a row: none (the prefix alone), by_file (the stem of its file) or by_folder (its parent folder)."""
    if strategy == "none":
        return F.lit(prefix)
    part = {"by_file": r"([^/]+?)(?:\.[^./]*)?$", "by_folder": r"([^/]+)/[^/]*$"}[strategy]
    found = F.nullif(F.regexp_extract(F.coalesce(source, F.lit("")), part, 1), F.lit(""))
    name = ascii_slug(F.coalesce(found, F.lit("unknown")))
    return F.concat(F.lit(f"{prefix}_"), name) if prefix else name


def namespace_config(definitions: str | None = None) -> dict[str, str]:
    """label -> namespace id, from JSON of {label: {"id": …, "description": …}}, or the default ones if that is unusable.

    An id that isn't given is made of the label. Labels, labels in lower case and ids all lead to the id.
    """
    given = {k: v[0] for k, v in NAMESPACES.items()}
    if definitions:
        try:
            given = {k: v.get("id") or label_id(k) for k, v in json.loads(definitions).items()}
        except (ValueError, AttributeError):
            pass
    return {name: ns for k, ns in given.items() for name in (k, k.strip(), k.lower(), ns)}


def label_namespace(label: Column, config: dict[str, str], fallback: str | None = None) -> Column:
    """The namespace of a label as it is, or in lower case; else the fallback, by default the first one configured."""
    table = F.create_map(*(F.lit(x) for pair in config.items() for x in pair))
    clean = F.trim(label)
    first = fallback if fallback is not None else next(iter(config.values()))
    return F.coalesce(F.try_element_at(table, clean), F.try_element_at(table, F.lower(clean)), F.lit(first))


def classify(chunks: DataFrame, provider: Callable[[list[str]], list[str]], config: dict[str, str] | None = None, batch: int = 25, most_chars: int = 600, col: str = "content") -> DataFrame:
    """chunks with namespace as a provider labels them: it takes up to `batch` texts and returns as many labels.

    Where it fails or returns another number, the whole batch falls to the first namespace configured.
    """
    config = config or namespace_config()

    def run(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in column:
            out: list[str | None] = []
            given = [t.strip().replace("\n", " ") for t in texts.fillna("")]
            for k in range(0, len(given), batch):
                part = given[k : k + batch]
                try:
                    got = list(provider(part))
                except Exception:  # noqa: BLE001 - a provider may fail in any way
                    got = []
                out += got if len(got) == len(part) else [None] * len(part)
            yield pd.Series(out, dtype=object)

    labels = F.pandas_udf(run, "string")(F.substring(F.trim(F.coalesce(F.col(col), F.lit(""))), 1, most_chars))
    return chunks.withColumn("namespace", label_namespace(labels, config))


def classify_offline(label: Column) -> Column:
    """The namespace of a heuristic label: see enrichment.label."""
    return F.when(label == "depannage", "depannage").when(label == "dimensionnement", "dimensionnement").otherwise("general")


def namespace_stats(df: DataFrame, col: str = "namespace") -> DataFrame:
    """(namespace, n, percent)."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(col, "n", F.round(F.col("n") * 100.0 / F.col("total"), 4).alias("percent"))


def namespace_totals(df: DataFrame, col: str = "namespace") -> DataFrame:
    """(namespace, n) and a row of the total, whose namespace is null."""
    return df.rollup(col).agg(F.count("*").alias("n"))


# --- records --------------------------------------------------------------------------------------------------------


def vector_id(file_name: Column, *numbers: Column) -> Column:
    """The id of a chunk's vector: its file's name in ASCII and the numbers of the chunk."""
    return F.concat(ascii_slug(file_name), F.lit("_chunk_"), F.concat_ws("-", *(n.cast("string") for n in numbers)))


def _cut(df: DataFrame, name: str, n: int) -> Column:
    return F.nullif(F.substring(df[name].cast("string"), 1, n), F.lit("")) if name in df.columns else F.lit(None).cast("string")


def _cut_list(df: DataFrame, name: str, most: int, n: int) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("array<string>")
    return F.when(F.size(name) > 0, F.transform(F.slice(name, 1, most), lambda x: F.substring(x, 1, n)))


def record_metadata(chunks: DataFrame, version: str | None = None, *keys: str) -> DataFrame:
    """(*keys, source, file_name, … embedding_version): what is stored beside a vector, cut to what a store takes.

    Columns that chunks lacks, and empty values, are null; counts that it lacks are 0.
    """
    has = lambda c: c in chunks.columns
    content = F.coalesce("content", F.lit(""))
    number = lambda c: F.coalesce(c, F.lit(0)) if has(c) else F.lit(0)
    score = lambda c: F.col(c).cast("double") if has(c) else F.lit(None).cast("double")
    shown = F.coalesce(F.nullif("display_content", F.lit("")), content) if has("display_content") else content
    keywords = F.coalesce(_cut_list(chunks, "keywords_ai", 10, 60), _cut_list(chunks, "keywords", 10, 60))
    columns = {
        "source": F.coalesce(chunks["source"], F.lit("")) if has("source") else F.lit(""), "file_name": F.coalesce(chunks["file_name"], F.lit("")) if has("file_name") else F.lit(""),
        "chunk_index": number("chunk_index"), "total_chunks": number("total_chunks"), "chunk_size": F.coalesce("chunk_size", F.length(content)) if has("chunk_size") else F.length(content),
        "text": F.substring(content, 1, 8000), "display_text": F.substring(shown, 1, 8000), "embedding_dimension": F.coalesce(F.size("embedding"), F.lit(0)) if has("embedding") else F.lit(0),
        "section_hierarchy": _cut(chunks, "section_hierarchy_string", 500), "section_title": _cut(chunks, "section_title", 200), "summary": _cut(chunks, "summary", 500),
        "document_type": F.nullif(_cut(chunks, "document_type", 50), F.lit("unknown")), "topics": _cut_list(chunks, "topics", 5, 80), "keywords": keywords, "domain_tags": _cut_list(chunks, "domain_tags", 8, 60),
        "rag_label": _cut(chunks, "rag_label", 80), "rag_label_confidence": score("rag_label_confidence"), "quality_score": score("quality_score"), "chunk_quality_score": score("chunk_quality_score"),
        "embedding_version": F.lit(version).cast("string"),
    }
    return chunks.select(*keys, *(c.alias(k) for k, c in columns.items()))


def valid_vectors(vectors: DataFrame, dimension: int) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by dimension."""
    good = F.coalesce(F.size("embedding") == dimension, F.lit(False))
    return vectors.where(good), vectors.where(~good)


def latest(rows: DataFrame, keys: tuple[str, ...], *order: Column) -> DataFrame:
    """Of rows that agree in keys the first one in an order."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


class VectorTable:
    """Vectors in Parquet, one partition per namespace; rows are (namespace, vec_id, seq, embedding, …)."""

    def __init__(self, spark: SparkSession, path: str, dimension: int | None = None, metric: str = "cosine"):
        if metric not in METRICS:
            raise ValueError(f"no such metric: {metric}")
        self.spark, self.path, self.dimension, self.metric = spark, path, dimension, metric

    def _files(self, path: str | None = None):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def exists(self) -> bool:
        system, at = self._files()
        return system.exists(at)

    def read(self, name: str | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        return df if name is None else df.where(F.col("namespace") == name)

    def upsert(self, rows: DataFrame, reset: bool = False) -> DataFrame:
        """Returns (namespace, accepted, rejected), which doesn't count twice what occurs twice.

        Of rows with the same namespace and vec_id, the one with the highest seq stays, of equal ones the new one, then the
        one with the greatest vector. Vectors of another dimension are rejected, and if all are, nothing is written and
        ValueError raised. Only touched partitions are rewritten; with `reset` they lose their old rows. The new state is
        written beside the table before it moves, and a run that breaks off can be repeated.
        """
        good = F.lit(True) if self.dimension is None else F.coalesce(F.size("embedding") == self.dimension, F.lit(False))
        judged = rows.withColumn("__good", good)
        counts = judged.groupBy("namespace").agg(F.count_if("__good").alias("accepted"), F.count_if(~F.col("__good")).alias("rejected"))
        found = counts.collect()  # a row per namespace
        if not found:
            return self.spark.createDataFrame([], counts.schema)
        if not any(r.accepted for r in found):
            raise ValueError("no vector has the dimension of the table")
        rows = judged.where("__good").drop("__good").withColumn("__new", F.lit(1))
        if self.exists() and not reset:
            touched = rows.select("namespace").distinct()
            rows = rows.unionByName(self.read().join(touched, "namespace", "left_semi").withColumn("__new", F.lit(0)), allowMissingColumns=True)
        kept = latest(rows, ("namespace", "vec_id"), F.desc("seq"), F.desc("__new"), F.desc("embedding")).drop("__new")
        staged = f"{self.path}.staged"
        kept.write.mode("overwrite").parquet(staged)
        self.spark.read.parquet(staged).repartition("namespace", F.pmod(F.xxhash64("vec_id"), F.lit(16))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("namespace").parquet(self.path)
        system, at = self._files(staged)
        system.delete(at, True)
        return self.spark.createDataFrame([tuple(r) for r in found], counts.schema)

    def store(self, chunks: DataFrame, name: str = "") -> DataFrame:
        """upsert of all chunks into one namespace."""
        return self.upsert(chunks.withColumn("namespace", F.lit(name)))

    def delete(self, name: str | None = None) -> None:
        """One namespace, or all of them."""
        if not self.exists():
            return
        if name is None:
            system, at = self._files()
            system.delete(at, True)
            return
        quoted = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("namespace", name or None)
        system, at = self._files(f"{self.path}/{quoted}")
        system.delete(at, True)

    def stats(self) -> DataFrame:
        return namespace_stats(self.read())

    def namespaces(self) -> list[str]:
        return sorted(r[0] for r in self.read().select("namespace").distinct().where("namespace IS NOT NULL").collect())


# --- search ---------------------------------------------------------------------------------------------------------


def similarity(a: Column, b: Column, metric: str = "cosine") -> Column:
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def dot(x: Column, y: Column) -> Column:
        return total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))

    if metric == "cosine":
        return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
    if metric == "dotproduct":
        return dot(a, b)
    if metric == "euclidean":
        return -F.sqrt(total(F.zip_with(a, b, lambda p, q: (p - q).cast("double") * (p - q).cast("double"))))
    raise ValueError(f"no such metric: {metric}")


def _kernel(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    if metric == "euclidean":
        return -np.sqrt(np.maximum((q * q).sum(1)[:, None] + (v * v).sum(1) - 2 * q @ v.T, 0))
    if metric == "cosine":
        q, v = (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300) for x in (q, v))
    return q @ v.T


def top_k(questions: DataFrame, vectors: DataFrame, k: int = 5, metric: str = "cosine", within: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """The k best vectors for each question (qid, question_embedding), with score and rank; ties by vec_id.

    Questions go to every executor in blocks of at most BLOCK_QUESTIONS, and each batch of vectors is scored against all
    of a block at once, of which only the best k for each question go on. `within`: a ranking for each of its groups.
    `where` is a condition on the vectors, which is applied before. Vectors of another length than a question's, and
    those that are null, aren't found by it.
    """
    if metric not in METRICS:
        raise ValueError(f"no such metric: {metric}")
    if where is not None:
        vectors = vectors.where(where)
    n = questions.count()
    blocks = max(1, -(-n // BLOCK_QUESTIONS))
    spark, group = questions.sparkSession, within or []
    qid_type = questions.schema["qid"].dataType.simpleString()
    keyed = questions.withColumn("__b", F.pmod(F.xxhash64("qid"), F.lit(blocks)))
    others = [c for c in vectors.columns if c != "embedding"]
    kinds = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in others)
    found = None
    for b in range(blocks):
        table = keyed.where(F.col("__b") == b).select("qid", F.col("question_embedding").cast("array<double>").alias("e")).dropna().toArrow()
        sent, kind = spark.sparkContext.broadcast((table["qid"].to_pylist(), table["e"].to_pylist())), table["qid"].type

        def run(batches: Iterator[pa.RecordBatch], sent=sent, kind=kind) -> Iterator[pa.RecordBatch]:
            qids, lists = sent.value
            by_length: dict[int, list[int]] = {}
            for i, e in enumerate(lists):
                by_length.setdefault(len(e), []).append(i)
            matrices = {d: np.array([lists[i] for i in at], np.float64).reshape(len(at), d) for d, at in by_length.items()}
            for batch in batches:
                column = batch.column(batch.num_columns - 1)
                lengths = np.array([len(x) if x is not None else -1 for x in column.to_pylist()], np.int64)
                groups = list(zip(*(batch.column(batch.schema.names.index(g)).to_pylist() for g in group))) if group else None
                ids = batch.column(batch.schema.names.index("vec_id"))
                for d, at in by_length.items():
                    rows = np.flatnonzero(lengths == d)
                    if not len(rows):
                        continue
                    v = np.array(column.take(pa.array(rows)).to_pylist(), np.float64).reshape(len(rows), d)
                    parts = [np.arange(len(rows))] if groups is None else [np.array([i for i, r in enumerate(rows) if groups[r] == g]) for g in dict.fromkeys(groups[r] for r in rows)]
                    order = np.argsort(np.array(ids.take(pa.array(rows)).to_pylist()), kind="stable")
                    place = np.empty(len(rows), np.int64)
                    place[order] = np.arange(len(rows))
                    for part in parts:
                        scores = np.round(_kernel(matrices[d], v[part], metric), 6)
                        best = np.lexsort((np.broadcast_to(place[part], scores.shape), -scores), axis=1)[:, :k]
                        q = np.repeat(np.arange(len(at)), best.shape[1])
                        rows_of = rows[part[best.ravel()]]
                        picked = batch.take(pa.array(rows_of))
                        names = [qids[at[i]] for i in q]
                        yield pa.RecordBatch.from_arrays([*picked.columns[:-1], pa.array(names, kind), pa.array(scores[q, best.ravel()])], names=[*picked.schema.names[:-1], "qid", "score"])

        one = vectors.select(*others, F.col("embedding").cast("array<double>").alias("__e")).mapInArrow(run, f"{kinds}, qid {qid_type}, score double")
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("qid", *group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def show_matches(found: DataFrame, most_chars: int = 300) -> str:
    """What was found as text, for a console; found is the small result of a search."""
    out = []
    for r in found.orderBy("qid", "rank").collect():
        x = r.asDict()
        where = " | ".join(str(x[c]) for c in ("namespace", "file_name", "section_title", "rag_label") if x.get(c))
        out.append(f"[{x['rank']}] {x['score']:.4f}  {where}".rstrip() + (f"\n    {str(x['text'])[:most_chars]}" if x.get("text") else ""))
    return "\n".join(out)


# --- evaluation -----------------------------------------------------------------------------------------------------

EXPECTED = ("expected_sources", "expected_keywords", "expected_labels", "expected_tags")
_BLOB_TEXTS = ("file_name", "source", "section_hierarchy", "section_title", "summary", "text", "display_text")
_BLOB_LISTS = ("topics", "keywords", "domain_tags")


def metadata_blob(found: DataFrame) -> Column:
    """All that is stored beside a vector as one text in lower case, for containment."""
    texts = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in _BLOB_TEXTS if c in found.columns]
    lists = [F.nullif(F.array_join(c, " "), F.lit("")) for c in _BLOB_LISTS if c in found.columns]
    return F.lower(F.concat_ws("\n", *texts, *lists))


def expected_list(questions: DataFrame, name: str) -> Column:
    """What is expected, in lower case without blanks: a list, a single string, or nothing."""
    none = F.array().cast("array<string>")
    if name not in questions.columns:
        return none
    kind = questions.schema[name].dataType.simpleString()
    if kind == "string":
        return F.when(F.col(name).isNull(), none).otherwise(F.array(F.lower(name)))
    texts = F.transform(F.col(name).cast("array<string>"), lambda x: F.lower(x))
    return F.coalesce(F.filter(texts, lambda x: F.length(F.trim(x)) > 0), none)


def contains_any(blob: Column, expected: Column) -> Column:
    return F.exists(expected, lambda x: F.contains(blob, x))


def overlaps(tags: Column, expected: Column) -> Column:
    return F.coalesce(F.arrays_overlap(F.transform(tags, lambda x: F.lower(x)), expected), F.lit(False))


def evaluate(questions: DataFrame, found: DataFrame, weak: float = 0.25, label: str = "rag_label", tags: str = "domain_tags") -> DataFrame:
    """Per question (qid, expected_…): (qid, n_found, source_match, keyword_match, label_match, tag_match, hit, best_score, weak).

    A match of sources or keywords is containment in what is stored beside a vector, its text included. hit is null where
    nothing is expected. Unanswered questions stay, and are weak.
    """
    asked = questions.select("qid", *(expected_list(questions, c).alias(c) for c in EXPECTED))
    known = found.select("qid", "vec_id", "score", metadata_blob(found).alias("__blob"), (F.lower(F.col(label).cast("string")) if label in found.columns else F.lit(None).cast("string")).alias("__label"), (F.col(tags) if tags in found.columns else F.lit(None).cast("array<string>")).alias("__tags"))
    judged = asked.join(known, "qid", "left")
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    per = judged.groupBy("qid").agg(
        F.count("vec_id").alias("n_found"), any_of(contains_any(F.col("__blob"), F.col("expected_sources"))).alias("source_match"), any_of(contains_any(F.col("__blob"), F.col("expected_keywords"))).alias("keyword_match"),
        any_of(F.array_contains("expected_labels", F.col("__label"))).alias("label_match"), any_of(overlaps(F.col("__tags"), F.col("expected_tags"))).alias("tag_match"),
        F.max(F.size(F.concat(*EXPECTED))).alias("n_expected"), F.max("score").alias("best_score"),
    )
    hit = F.col("source_match") | F.col("keyword_match") | F.col("label_match") | F.col("tag_match")
    return per.select("qid", "n_found", "source_match", "keyword_match", "label_match", "tag_match", F.when(F.col("n_expected") > 0, hit).alias("hit"), "best_score", F.coalesce(F.col("best_score") < weak, F.lit(True)).alias("weak"))


def summary(per_question: DataFrame) -> DataFrame:
    """One row: counts and rates. Hits and matches are those of questions with an expectation; weak ones and the average
    count all. Rates are of the questions with an expectation, or of all if none has one, so a rate of weak ones may
    exceed 1."""
    matches = [c for c in ("source_match", "label_match", "tag_match") if c in per_question.columns]
    scored = F.col("hit").isNotNull()
    agg = per_question.agg(
        F.count("*").alias("n_all"), F.count("hit").alias("n_scored"), F.count_if("hit").alias("hits"), *(F.count_if(F.col(c) & scored).alias(c) for c in matches),
        F.count_if("weak").alias("weak_results"), F.round(F.avg(F.coalesce("best_score", F.lit(0.0))), 4).alias("average_best_score"),
    )
    total = F.when(F.col("n_scored") > 0, F.col("n_scored")).otherwise(F.col("n_all"))
    rate = lambda c: F.coalesce(F.round(F.try_divide(c, total), 3), F.lit(0.0)).alias(f"{c}_rate")
    return agg.select("n_all", "n_scored", "hits", rate("hits"), *(x for c in matches for x in (F.col(c), rate(c))), "weak_results", rate("weak_results"), "average_best_score")


def report_matches(found: DataFrame) -> DataFrame:
    """found as a report shows it: (qid, rank, score, namespace, source, … preview)."""
    has = lambda c, kind="string": F.col(c) if c in found.columns else F.lit(None).cast(kind)
    shown = F.coalesce(F.nullif(has("display_text"), F.lit("")), has("text"), F.lit(""))
    section = F.coalesce(F.nullif(has("section_hierarchy"), F.lit("")), has("section_title"), F.lit(""))
    plain = [F.coalesce(has(c), F.lit("")).alias(c) for c in ("namespace", "source", "file_name")]
    return found.select("qid", "rank", "score", *plain, has("chunk_index", "int").alias("chunk_index"), section.alias("section"), F.coalesce(has("rag_label"), F.lit("")).alias("rag_label"), has("rag_label_confidence", "double").alias("rag_label_confidence"), has("domain_tags", "array<string>").alias("domain_tags"), has("topics", "array<string>").alias("topics"), F.coalesce(has("summary"), F.lit("")).alias("summary"), F.substring(shown, 1, 900).alias("preview"))
