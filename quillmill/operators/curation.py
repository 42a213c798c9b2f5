"""Scores, filters and merging of chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.functions import lines as L, patterns as P
from quillmill.functions.splitting import Tokenizer
from quillmill.operators import chunking
from quillmill.operators.chunking import tokens


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def annotate_tokens(chunks: DataFrame, most: int = 600, col: str = "content", tokenizer: Tokenizer | None = None) -> DataFrame:
    """chunks with token_count, and oversized where that exceeds `most`."""
    return chunks.withColumn("token_count", chunking.token_count(F.col(col), tokenizer)).withColumn("oversized", F.when(F.col("token_count") > most, True))


def quality_score(chunks: DataFrame, col: str = "content", least: int = 200, most: int = 2000, words: int = 10) -> DataFrame:
    """chunks with quality_score, a product of penalties; null and empty contents score 0."""
    c, n = F.col(col), F.length(col)
    chunks = chunks.withColumn("__words", tokens(c))
    n_words = F.size("__words")

    def penalty(when: Column, factor: float) -> Column:
        return F.when(when, F.lit(factor)).otherwise(F.lit(1.0))

    score = F.when(n < least, 0.3).when(n > most, 0.7).otherwise(1.0)
    score = score * penalty(n_words < words, 0.5) * penalty(_removed(c, P.NOT_WORD_OR_SPACE) / n > 0.3, 0.4)
    score = score * penalty((_removed(c, r"\p{Lu}") / n > 0.5) & (n < 200), 0.6)
    score = score * penalty((n_words > 0) & (F.size(F.array_distinct("__words")) / n_words < 0.3), 0.3)
    score = score * penalty(F.regexp_count(c, F.lit("\n\n\n")) > 3, 0.7)
    score = score * penalty((_removed(c, r"[^\x{0}-\x{7f}]") / n > 0.5) & (n < 100), 0.8)
    return chunks.withColumn("quality_score", F.when(n > 0, score).otherwise(0.0)).drop("__words")


def split_by_quality(chunks: DataFrame, least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of chunks with a quality_score."""
    good = F.coalesce(F.col("quality_score"), F.lit(0.5)) >= least
    return chunks.where(good), chunks.where(~good)


def priority_score(chunks: DataFrame, col: str = "content") -> DataFrame:
    """chunks with priority_score; section_title, section_level and quality_score count where there are such columns."""
    has = lambda c: c in chunks.columns
    low = F.lower(col)
    named = F.lit(False)
    for word in P.PRIORITY_WORDS:
        named = named | low.contains(word)
    points = lambda when, p: F.when(when, F.lit(p)).otherwise(F.lit(0.0))
    score = F.lit(0.5) + points(F.length("section_title") > 0, 0.2) if has("section_title") else F.lit(0.5)
    if has("section_level"):
        score = score + points(F.coalesce(F.col("section_level"), F.lit(99)) <= 2, 0.15)
    quality = F.coalesce(F.col("quality_score"), F.lit(0.5)) if has("quality_score") else F.lit(0.5)
    score = score + points(named, 0.1) + points(F.length(col).between(200, 1000), 0.1) + quality * 0.1 + points(F.col(col).rlike(r"\p{Nd}"), 0.05)
    return chunks.withColumn("priority_score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))


def sort_by_priority(chunks: DataFrame, *keys: str) -> DataFrame:
    return chunks.orderBy(F.desc("priority_score"), *keys)


#: Of a joined chunk these are the second one's, where it has them.
SECOND = ("section_title", "section_level", "section_hierarchy", "section_hierarchy_string")


def neighbour_score(same_section: Column, is_next: bool, strategy: str = "hybrid") -> Column:
    """How well a chunk goes with a neighbour; 0 means not at all."""
    if strategy == "sequential":
        return F.lit(1.0 if is_next else 0.5)
    if strategy == "semantic":
        return F.when(same_section, 1.0).otherwise(0.0) + (0.1 if is_next else 0.0)
    if strategy == "hybrid":
        return F.when(same_section, 1.0).otherwise(0.5 if is_next else 0.0)
    raise ValueError(f"no such strategy: {strategy}")


def best_neighbour(chunks: DataFrame, most: int = 2000, strategy: str = "hybrid", key: str = "doc_id", order: str = "chunk_index") -> DataFrame:
    """chunks with neighbour, 1 for the next chunk, -1 for the one before, and neighbour_score; null where none fits."""
    w = Window.partitionBy(key).orderBy(order)
    here = F.col("section_hierarchy_string") if "section_hierarchy_string" in chunks.columns else F.lit(None).cast("string")
    tries = []
    for step, there in ((1, F.lead), (-1, F.lag)):
        fits = F.length("content") + F.coalesce(there(F.length("content")).over(w), F.lit(most)) + 2 <= most
        same = F.coalesce((F.length(here) > 0) & (here == there(here).over(w)), F.lit(False))
        score = neighbour_score(same, step == 1, strategy)
        tries.append(F.when(fits & (score > 0), F.struct(score.alias("score"), F.lit(step).alias("step"))))
    best = F.greatest(*tries)  # of equal scores the next chunk's
    return chunks.withColumn("__best", best).withColumn("neighbour", F.col("__best.step")).withColumn("neighbour_score", F.col("__best.score")).drop("__best")


def merge_chunks(chunks: DataFrame, small: int = 400, most: int = 2000, strategy: str = "hybrid", key: str = "doc_id", order: str = "chunk_index") -> DataFrame:
    """chunks, each that is shorter than `small` joined with the next one of its document if the strategy allows it.

    Further columns are those of the first chunk, but for SECOND; merged, merged_from and original_chunk_sizes tell what
    was joined, and chunk_size is the new one. A joined chunk isn't joined again: within a run of chunks that could be,
    every second one is. No chunk is lost or repeated. Two windows over one shuffle.
    """
    w = Window.partitionBy(key).orderBy(order)
    here = F.col("section_hierarchy_string") if "section_hierarchy_string" in chunks.columns else F.lit(None).cast("string")
    same = F.coalesce((F.length(here) > 0) & (here == F.lead(here).over(w)), F.lit(False))
    fits = (F.length("content") < small) & (F.length("content") + F.lead(F.length("content")).over(w) + 2 <= most) & (neighbour_score(same, True, strategy) > 0)
    rows = chunks.withColumn("__can", F.coalesce(fits, F.lit(False)))
    rows = rows.withColumn("__run", F.coalesce(F.sum(F.when(~F.col("__can"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("__opens", F.col("__can") & (F.row_number().over(Window.partitionBy(key, "__run").orderBy(order)) % 2 == 1))
    seconds = [c for c in SECOND if c in chunks.columns]
    rows = rows.withColumn("__gone", F.coalesce(F.lag("__opens").over(w), F.lit(False))).withColumn("__next", F.lead(F.struct(order, "content", *seconds)).over(w)).where("NOT __gone")
    sizes = F.array(F.length("content"), F.length("__next.content"))
    found = {
        "merged": F.when(F.col("__opens"), True), "merged_from": F.when(F.col("__opens"), F.array(order, F.col(f"__next.{order}"))), "original_chunk_sizes": F.when(F.col("__opens"), sizes),
        **{c: F.when(F.col("__opens"), F.coalesce(f"__next.{c}", c)).otherwise(F.col(c)) for c in seconds},
        "content": F.when(F.col("__opens"), F.concat_ws("\n\n", "content", "__next.content")).otherwise(F.col("content")),
    }
    return rows.withColumns(found).withColumn("chunk_size", F.length("content")).drop("__can", "__run", "__opens", "__gone", "__next")


def merge_by_replay(chunks: DataFrame, small: int = 400, most: int = 2000, strategy: str = "hybrid", key: str = "doc_id", order: str = "chunk_index") -> DataFrame:
    """(key, merged_from, content) by a walk that may also join a chunk with the one before it, for comparison only.

    Such a walk repeats the chunk before, which is out already, and passes over the next one. Use merge_chunks.
    """
    section = F.coalesce("section_hierarchy_string", F.lit("")) if "section_hierarchy_string" in chunks.columns else F.lit("")

    def score(same: bool, is_next: bool) -> float:
        if strategy == "sequential":
            return 1.0 if is_next else 0.5
        return float(same) + 0.1 * is_next if strategy == "semantic" else 1.0 if same else 0.5 * is_next

    def walk(rows: pd.DataFrame) -> Iterator[tuple[list[int], str]]:
        texts, sections, order_of = rows.content.tolist(), rows.section.tolist(), rows.position.tolist()
        taken: set[int] = set()
        i = 0
        while i < len(texts):
            tries = [j for j in (i + 1, i - 1) if 0 <= j < len(texts) and j not in taken and len(texts[i]) + len(texts[j]) + 2 <= most]
            scored = [(score(bool(sections[i]) and sections[i] == sections[j], j > i), j) for j in tries]
            best = max(scored, key=lambda x: x[0], default=(0.0, i))
            if len(texts[i]) < small and i + 1 < len(texts):
                joins = best[0] > 0
                yield ([order_of[i], order_of[best[1]]], f"{texts[i]}\n\n{texts[best[1]]}") if joins else ([order_of[i]], texts[i])
                if joins:
                    taken.add(best[1])
                    i += 1
            elif i not in taken:
                yield [order_of[i]], texts[i]
            i += 1

    def run(name, rows):
        got = list(walk(rows.sort_values("position")))
        return pd.DataFrame({key: [name[0]] * len(got), "merged_from": [g[0] for g in got], "content": [g[1] for g in got]})

    kind = chunks.schema[key].dataType.simpleString()
    given = chunks.select(key, F.col(order).cast("int").alias("position"), section.alias("section"), "content")
    return given.groupBy(key).applyInPandas(run, f"`{key}` {kind}, merged_from array<int>, content string")


def curate(chunks: DataFrame, most_tokens: int = 600, small: int = 400, most: int = 2000, overlap: int = 200, least_quality: float = 0.5, strategy: str = "hybrid", use_tokens: bool = True, filter_quality: bool = True, merge: bool = True, prioritize: bool = True, tokenizer: Tokenizer | None = None, key: str = "doc_id") -> DataFrame:
    """What becomes of chunks before they are embedded: tokens are counted, small chunks joined, long ones cut by tokens,
    poor ones left out, and the rest scored by priority.

    orig_chunk_index and sub_index say where a chunk comes from, and seq numbers the chunks of a document anew.
    """
    if use_tokens:
        chunks = annotate_tokens(chunks, most_tokens, tokenizer=tokenizer)
    if merge:
        chunks = merge_chunks(chunks, small, most, strategy, key)
    if use_tokens:
        chunks = chunking.rechunk(chunks.drop("token_count", "oversized"), most_tokens, min(overlap // 2, 100), tokenizer)
    else:
        chunks = chunks.withColumn("sub_index", F.lit(None).cast("int"))
    if filter_quality:
        chunks = split_by_quality(quality_score(chunks, least=small // 2, most=most), least_quality)[0]
    if prioritize:
        chunks = priority_score(chunks)
    seq = F.row_number().over(Window.partitionBy(key).orderBy("chunk_index", F.coalesce("sub_index", F.lit(-1)))) - 1
    return chunks.withColumn("seq", seq).withColumnRenamed("chunk_index", "orig_chunk_index")


def totals(chunks: DataFrame) -> DataFrame:
    """One row: (n_chunks, total_chars, average_quality)."""
    return chunks.agg(F.count("*").alias("n_chunks"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("total_chars"), F.avg(F.coalesce("quality_score", F.lit(0.5))).alias("average_quality"))
