"""Sections, content types and titles of Markdown texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.functions import lines as L

LEVELS = range(1, 7)


def headings(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_no, level, title, start_char) of every heading; lines and characters count from 0. No shuffle."""
    lines = F.col("__lines")
    rows = docs.select(key, L.lines_of(F.col("text")).alias("__lines"))
    levels = F.transform(lines, lambda x, i: F.struct(i.alias("line_no"), L.heading_level(x).alias("level"), x.alias("line")))
    rows = rows.withColumn("__h", F.filter(levels, lambda h: h["level"].isNotNull()))
    before = lambda h: F.length(L.joined(F.slice(lines, 1, h["line_no"]))) + F.when(h["line_no"] > 0, 1).otherwise(0)
    found = F.transform("__h", lambda h: F.struct(h["line_no"].alias("line_no"), h["level"].alias("level"), L.heading_title(h["line"]).alias("title"), before(h).alias("start_char")))
    return rows.select(key, F.explode(found).alias("h")).select(key, "h.*")


def sections(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start_line, end_line, start_char, level, title, path) of every section: a heading opens one, the next ends it.

    path holds the open titles from the top down to the section's own. Only headings are shuffled, once, by key.
    """
    found = headings(docs, key)
    ahead = Window.partitionBy(key).orderBy("line_no")
    upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
    n_lines = docs.select(key, F.size(L.lines_of(F.col("text"))).alias("n_lines"))
    found = found.join(n_lines, key)
    for k in LEVELS:
        found = found.withColumn(f"l{k}", F.last(F.when(F.col("level") == k, F.struct("line_no", "title")), True).over(upto))
    open_titles = []
    for k in LEVELS:
        above = [F.coalesce(F.col(f"l{j}.line_no"), F.lit(-1)) for j in range(1, k)]
        still_open = F.lit(True) if not above else F.col(f"l{k}.line_no") > (F.greatest(*above) if len(above) > 1 else above[0])
        open_titles.append(F.when((F.lit(k) <= F.col("level")) & still_open, F.col(f"l{k}.title")))
    path = F.filter(F.array(*open_titles), lambda x: x.isNotNull())
    end = F.coalesce(F.lead("line_no").over(ahead), F.col("n_lines")) - 1
    return found.select(key, F.col("line_no").alias("start_line"), end.alias("end_line"), "start_char", "level", "title", path.alias("path"))


def outline(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, outline): the titles, one per line, two blanks deeper for each level."""
    line = F.concat(F.repeat(F.lit("  "), F.col("level") - 1), F.col("title"))
    rows = headings(docs, key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("line_no", line.alias("x")))).alias("r"))
    return rows.select(key, F.array_join("r.x", "\n").alias("outline"))


def hierarchy(path: Column) -> Column:
    """The titles from the top down to a section's own, as one string."""
    return F.array_join(path, " > ")


def with_sections(chunks: DataFrame, found: DataFrame, key: str = "doc_id", at: str = "start_char") -> DataFrame:
    """chunks with section_title, section_level, section_hierarchy and section_hierarchy_string: those of the section that
    position `at` lies in, null before the first. `found` has columns key, start_char, level, title and path.

    An as-of join: both go into one window by key, in the order of their positions, and each chunk takes the last section
    up to its own. One shuffle, and no pair of a chunk with a section that isn't its own.
    """
    section = F.struct(F.col("title").alias("section_title"), F.col("level").alias("section_level"), F.col("path").alias("section_hierarchy"))
    marks = found.select(key, F.col("start_char").cast("long").alias("__at"), F.lit(0).alias("__kind"), section.alias("__section"))
    rows = chunks.select(key, F.coalesce(F.col(at), F.lit(0)).cast("long").alias("__at"), F.lit(1).alias("__kind"), F.struct(*chunks.columns).alias("__row"))
    both = marks.unionByName(rows, allowMissingColumns=True)
    upto = Window.partitionBy(key).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("__section", F.last("__section", True).over(upto)).where("__kind = 1")
    return met.select("__row.*", "__section.*").withColumn("section_hierarchy_string", hierarchy(F.col("section_hierarchy")))


def with_running_position(chunks: DataFrame, key: str = "doc_id", order: str = "chunk_index", col: str = "content") -> DataFrame:
    """chunks with start_char, the characters of the chunks before: what a position is where only chunks are at hand."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn("start_char", F.coalesce(F.sum(F.length(col)).over(before), F.lit(0)))


def heading_choice(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, level): the level of heading to cut a document at. See splitting.heading_level; 3 without a valid title."""
    good = headings(docs, key).where(L.is_valid_title(F.col("title")))
    counts = good.groupBy(key, "level").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    best = counts.groupBy(key).agg(F.max_by("level", F.struct("n", -F.abs(F.col("level") - 3), -F.col("first"))).alias("level"))
    return docs.select(key).join(best, key, "left").select(key, F.coalesce("level", F.lit(3)).alias("level"))


def _share(lines: Column, rule: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(lines, rule))


def _count(c: Column, what: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def content_scores(df: DataFrame, col: str = "text") -> DataFrame:
    """df with table_score, list_score, code_score and content_type."""
    lines, text = F.col("__lines"), F.col(col)
    df = df.withColumn("__lines", L.lines_of(text)).withColumn("__full", F.filter(lines, lambda x: ~L.is_blank(x)))
    full, n = F.col("__full"), F.size("__full")
    table = F.greatest(_share(lines, L.is_table_line), _share(lines, lambda x: _count(x, "\t") >= 2))
    items = F.greatest(_share(full, lambda x: x.rlike(r"^\s*[-*+]\s+")), _share(full, lambda x: x.rlike(r"^\s*[0-9]+\.\s+")))
    indented = _share(lines, lambda x: x.startswith("    ") | x.startswith("\t")) / F.size(lines)
    code = F.when(text.contains("```"), 0.9).when(F.regexp_count(text, F.lit("`[^`]+`")) > 3, 0.6).when(indented > 0.5, 0.7).otherwise(0.0)
    df = df.withColumn("table_score", F.when(n > 0, table / n).otherwise(0.0)).withColumn("list_score", F.when(n > 0, items / n).otherwise(0.0)).withColumn("code_score", code)
    kind = F.when(F.greatest("table_score", "list_score", "code_score") < 0.2, "narrative").when(F.col("table_score") >= 0.3, "table").when(F.col("list_score") >= 0.3, "list").when(F.col("code_score") >= 0.3, "code").otherwise("mixed")
    return df.withColumn("content_type", kind).drop("__lines", "__full")


def structure_score(df: DataFrame, col: str = "text") -> DataFrame:
    """df with n_sections, n_headings (those marked with #) and structure_score, null for null texts.

    The score is how many of the headings that its length calls for a text has: 0.7 for sections, whatever opens them, 0.3 for marked headings.
    """
    expected = F.greatest(F.lit(3), F.floor(F.length(col) / 2500))
    sections = F.when(F.col(col).isNotNull(), _share(L.lines_of(F.col(col)), lambda x: L.heading_level(x).isNotNull()))
    marked = F.regexp_count(F.col(col), F.lit(r"(?md)^#{1,6}[ \t]+\S"))
    df = df.withColumn("n_sections", sections).withColumn("n_headings", marked)
    score = 0.7 * F.least(F.col("n_sections") / expected, F.lit(1.0)) + 0.3 * F.least(F.col("n_headings") / expected, F.lit(1.0))
    return df.withColumn("structure_score", F.when(F.col(col).isNotNull(), score))


def needs_boundaries(scored: DataFrame, enabled: bool = False, threshold: float = 0.5) -> Column:
    """Whether a provider should say where sections begin: see chunking.boundary_chunks. scored has structure_score."""
    return F.lit(enabled) & (F.coalesce(F.col("structure_score"), F.lit(0.0)) < threshold)
