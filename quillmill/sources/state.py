"""Results of stages in a folder, with a manifest, so that a run can go on where another has ended."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.operators import cleaning, retrieval, review


class Folder:
    """Small text files and whole folders below a path, through Hadoop, so that any shared store will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str = ""):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def exists(self, name: str = "") -> bool:
        system, at = self._at(name)
        return system.exists(at)

    def names(self) -> list[str]:
        system, at = self._at()
        return sorted(f.getPath().getName() for f in system.listStatus(at)) if system.exists(at) else []

    def delete(self, name: str) -> None:
        system, at = self._at(name)
        system.delete(at, True)

    def write_text(self, name: str, text: str) -> str:
        system, at = self._at(name)
        out = system.create(at, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return f"{self.path}/{name}"

    def read_text(self, name: str) -> str:
        (row,) = self.spark.read.text(f"{self.path}/{name}", wholetext=True).collect()
        return row[0]


class State:
    """Chunks and, for each namespace, embedded chunks in Parquet; metadata.json says what they hold."""

    MANIFEST = "metadata.json"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    @staticmethod
    def _name(namespace: str) -> str:
        return f"embeddings_{namespace}" if namespace else "embeddings_results"

    def metadata(self, stage: str | None = None) -> dict:
        """The manifest of a stage, or of all of them; {} if there is none."""
        found = json.loads(self.folder.read_text(self.MANIFEST)) if self.folder.exists(self.MANIFEST) else {}
        return found if stage is None else found.get(stage, {})

    def _note(self, stage: str, facts: dict | None) -> None:
        known = self.metadata()
        known.pop(stage, None)
        if facts is not None:
            known[stage] = facts
        self.folder.write_text(self.MANIFEST, json.dumps(known, indent=2, ensure_ascii=False))

    def _save(self, df: DataFrame, name: str, key: str) -> dict:
        at = f"{self.folder.path}/{name}"
        df.write.mode("overwrite").parquet(at)
        saved = self.spark.read.parquet(at)
        counted = saved.agg(F.count_distinct(key).alias("files"), F.count("*").alias("chunks")).first()
        return {"num_files": counted.files, "total_chunks": counted.chunks}

    def _load(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.folder.path}/{name}") if self.folder.exists(name) else None

    def save_chunks(self, chunks: DataFrame, key: str = "doc_id") -> None:
        self._note("chunks", self._save(chunks, "chunks_results", key))

    def load_chunks(self) -> DataFrame | None:
        return self._load("chunks_results")

    def has_chunks(self) -> bool:
        return self.folder.exists("chunks_results")

    def save_embeddings(self, chunks: DataFrame, namespace: str = "", key: str = "doc_id") -> None:
        name = self._name(namespace)
        facts = self._save(chunks, name, key)
        size = self._load(name).where("embedding IS NOT NULL").select(F.size("embedding")).first()
        self._note(name, {**facts, "embedding_dimension": size[0] if size else 0, "namespace": namespace})

    def load_embeddings(self, namespace: str = "") -> DataFrame | None:
        return self._load(self._name(namespace))

    def has_embeddings(self, namespace: str = "") -> bool:
        return self.folder.exists(self._name(namespace))

    def namespaces(self) -> list[str]:
        """Namespaces whose embeddings are saved; "" is the default one."""
        found = [n.removeprefix("embeddings_") for n in self.folder.names() if n.startswith("embeddings_")]
        return sorted("" if n == "results" else n for n in found)

    def clear_chunks(self) -> None:
        self.folder.delete("chunks_results")
        self._note("chunks", None)

    def clear_embeddings(self, namespace: str = "") -> None:
        self.folder.delete(self._name(namespace))
        self._note(self._name(namespace), None)

    def clear_all(self) -> None:
        """Chunks, the embeddings of every namespace, and the manifest."""
        for name in self.folder.names():
            if name in ("chunks_results", self.MANIFEST) or name.startswith("embeddings_"):
                self.folder.delete(name)

    def status(self) -> str:
        lines = [f"chunks: {json.dumps(self.metadata('chunks')) if self.has_chunks() else 'none'}"]
        return "\n".join(lines + [f"embeddings {n or '(default)'}: {json.dumps(self.metadata(self._name(n)))}" for n in self.namespaces()])


def save_cleaned(docs: DataFrame, path: str, profile: str = "default", is_ocr: bool = False) -> DataFrame:
    """Cleans docs by a profile and writes them as Parquet, each text behind a mark that says so; returns what was written.

    clean_profile and is_ocr say the same in columns. Rows are kept by their source, so equal names don't collide.
    """
    cleaned = cleaning.clean(docs, profile, is_ocr).withColumn("clean_profile", F.lit(profile)).withColumn("is_ocr", F.lit(is_ocr))
    cleaned.withColumn("text", F.concat(F.lit(cleaning.cleaning_marker(profile, is_ocr)), F.col("text"))).write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def save_report(questions: DataFrame, per_question: DataFrame, folder: Folder) -> tuple[str, str]:
    """Writes the evaluation as JSON and as HTML, under the time, and returns both paths. A row per question."""
    facts = retrieval.summary(per_question).first().asDict()
    rows = [r.asDict() for r in per_question.join(questions.select("qid", *[c for c in ("question",) if c in questions.columns]), "qid").orderBy("qid").collect()]
    stamp = _stamp()
    text = json.dumps({"generated_at": stamp, "summary": facts, "questions": rows}, indent=2, ensure_ascii=False, default=str)
    return folder.write_text(f"rag_eval_{stamp}.json", text), folder.write_text(f"rag_eval_{stamp}.html", review.report_page(facts, rows))


def export_review(chunks: DataFrame, folder: Folder, size: int = 20, order: tuple[str, ...] = ("doc_id", "chunk_index")) -> tuple[str, str]:
    """Writes a stratified sample as JSON and as HTML, under the time, and returns both paths."""
    items = [r.asDict(recursive=True) for r in review.review_items(review.stratified_sample(review.flatten(chunks), size, order)).collect()]
    stamp = _stamp()
    text = json.dumps(sorted(items, key=lambda x: x["id"]), indent=2, ensure_ascii=False)
    return folder.write_text(f"chunk_review_{stamp}.json", text), folder.write_text(f"chunk_review_{stamp}.html", review.review_page(items))
