"""A sample of chunks for people to look at."""

from __future__ import annotations

from collections import Counter
from html import escape

from pyspark.sql import Column, DataFrame, Row, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def flatten(results: DataFrame) -> DataFrame:
    """The chunks of per-file results with an array `chunks` of structs; a table of chunks stays as it is."""
    return results.select(F.explode("chunks").alias("c")).select("c.*") if "chunks" in results.columns else results


def stratified_sample(chunks: DataFrame, size: int = 20, order: tuple[str, ...] = ("doc_id", "chunk_index"), seed: int | None = 7) -> DataFrame:
    """`size` rows of chunks with position: all of them if they are no more; else the first and last row and the quarters,
    then in order those with a table and the first of each section, until the sample is full; if it isn't, others by a
    hash, or in order without a seed. Nulls go last in the order; of rows with equal keys each counts. Only keys, positions
    and flags are sorted, and only the sample's rows are fetched.
    """
    has = lambda c, kind: F.col(c) if c in chunks.columns else F.lit(None).cast(kind)
    flags = {"__s": F.coalesce(has("section_hierarchy_string", "string"), F.lit("")), "__t": F.coalesce(has("has_table", "boolean"), F.lit(False))}
    keys = [*order, *flags]
    by = [F.asc_nulls_last(c) for c in order]
    # Sorted once, and kept until the sample is known: sorted again, for counts, tasks would end at other keys.
    parts = chunks.withColumns(flags).select(*keys).repartitionByRange(*by).sortWithinPartitions(*by, *flags).withColumn("__at", F.monotonically_increasing_id()).persist()
    try:
        picked = _picked(parts, size, seed)
    finally:
        parts.unpersist()
    # Rows with equal keys and flags are interchangeable: the sample has as many of them as it has of their positions.
    seen: Counter = Counter()
    rows = []
    for *key, position in picked:
        seen[tuple(key)] += 1
        rows.append((*key, seen[tuple(key)], position))
    fields = [(c, parts.schema[c].dataType) for c in keys]
    schema = StructType([StructField(f"__{k}", kind) for k, (_, kind) in enumerate(fields)] + [StructField("__tie", IntegerType()), StructField("position", LongType())])
    wanted = chunks.sparkSession.createDataFrame(rows, schema)
    same = lambda df: [df[f"__{k}"].eqNullSafe(F.col(c)) for k, c in enumerate(keys)]
    ones = wanted.where("__tie = 1").drop("__tie", "position")
    among = Window.partitionBy(*keys).orderBy("content" if "content" in chunks.columns else order[-1])
    found = chunks.withColumns(flags).join(F.broadcast(ones), same(ones), "left_semi").withColumn("__n", F.row_number().over(among))
    return found.join(F.broadcast(wanted), [*same(wanted), F.col("__n") == wanted["__tie"]]).select(*chunks.columns, "position")


def _picked(parts: DataFrame, size: int, seed: int | None) -> list[Row]:
    """The sample's rows of parts, in order, with position for __at, whose upper bits number the tasks of the sort."""
    counts = dict(parts.groupBy(F.shiftright("__at", 33).cast("int").alias("p")).count().collect())
    before = [0]
    for p in range(max(counts, default=0)):
        before.append(before[-1] + counts.get(p, 0))
    n = sum(counts.values())
    shift = F.element_at(F.lit(before), F.shiftright("__at", 33).cast("int") + 1)
    placed = parts.withColumn("position", shift + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at")
    position = F.col("position")
    least = lambda df: [r.position for r in df.select("position").orderBy("position").limit(size).collect()]
    if n <= size:
        chosen = {*range(n)}
    else:
        chosen = {0, n // 4, n // 2, 3 * n // 4, n - 1}
        # A section counts as seen from its first row that has no table on.
        firsts = placed.where("NOT __t AND length(__s) > 0").groupBy("__s").agg(F.min("position").alias("position"))
        varied = {*least(placed.where("__t")), *least(firsts)} - chosen
        chosen |= {*sorted(varied)[: max(0, size - len(chosen))]}
        if len(chosen) < size:
            rest = placed.where(~position.isin(chosen))
            within = position if seed is None else F.xxhash64("position", F.lit(seed))
            chosen |= {r.position for r in rest.orderBy(within, "position").limit(size - len(chosen)).select("position").collect()}
    return sorted(placed.where(position.isin(chosen)).collect(), key=lambda r: r.position)[:size]


def review_items(sample: DataFrame) -> DataFrame:
    """What a reviewer sees of each row, and fields for the verdict."""

    def of(name: str, kind: str = "string") -> Column:
        return F.col(name).cast(kind) if name in sample.columns else F.lit(None).cast(kind)

    blank = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(""))
    verdict = F.struct(F.lit(None).cast("int").alias("rating"), F.lit("").alias("note"), F.lit(None).cast("string").alias("action"))
    return sample.select(
        of("position", "long").alias("id"), F.coalesce("content", F.lit("")).alias("content"), F.substring(F.coalesce("content", F.lit("")), 1, 500).alias("content_preview"),
        F.coalesce(F.nullif(of("section_hierarchy_string"), F.lit("")), of("section_title"), F.lit("")).alias("section"), blank(of("chunk_title")).alias("chunk_title"),
        F.coalesce(of("quality_score", "double"), of("chunk_quality_score", "double")).alias("quality_score"), F.coalesce(of("topics", "array<string>"), F.array().cast("array<string>")).alias("topics"),
        blank(of("summary")).alias("summary"), F.coalesce(of("has_table", "boolean"), F.lit(False)).alias("has_table"), of("token_count", "int").alias("token_count"), blank(of("file_name")).alias("file_name"), verdict.alias("review"),
    )


def _page(title: str, body: str) -> str:
    return f"<!doctype html>\n<html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>\n{body}\n</body></html>\n"


def review_page(items: list[dict]) -> str:
    """HTML of a sample, which is small by its parameter."""
    rows = []
    for x in sorted(items, key=lambda i: i["id"] or 0):
        facts = " | ".join(escape(str(v)) for v in (x["file_name"], x["section"], x["quality_score"], x["token_count"]) if v not in (None, ""))
        rows.append(f"<section><h2>#{x['id']} {escape(x['chunk_title'])}</h2><p>{facts}</p><pre>{escape(x['content'])}</pre></section>")
    return _page("Chunk review", "\n".join(rows))


def report_page(summary: dict, questions: list[dict]) -> str:
    """HTML of an evaluation: the rates, and a row per question."""
    head = "".join(f"<li>{escape(k)}: {escape(str(v))}</li>" for k, v in summary.items())
    names = list(questions[0]) if questions else []
    table = "".join("<tr>" + "".join(f"<td>{escape(str(q[c]))}</td>" for c in names) + "</tr>" for q in questions)
    return _page("Retrieval evaluation", f"<ul>{head}</ul><table><tr>{''.join(f'<th>{escape(c)}</th>' for c in names)}</tr>{table}</table>")
