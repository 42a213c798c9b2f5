"""Cleaning of extracted text: every operator takes a DataFrame with a text column and returns it with that column
replaced. Null texts stay null. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions import lines as L, patterns as P

Transform = Callable[[DataFrame], DataFrame]
MARKER_OPEN, MARKER_CLOSE = "<!-- quillmill:cleaned=", " -->"
#: Marks of other tools are read as well.
_MARKER = r"<!-- [\w-]+:cleaned="
_SYMBOLS = "©®™€£¥°±×÷≈≠≤≥•◦▪▫→←↑↓⇒⇐⇑⇓"


def _on_text(df: DataFrame, change: Callable[[Column], Column], col: str) -> DataFrame:
    return df.withColumn(col, change(F.col(col)))


def _on_lines(df: DataFrame, change: Callable[[Column], Column], col: str) -> DataFrame:
    """A column of its own for the lines, so that a change may refer to them often."""
    return df.withColumn("__lines", L.lines_of(F.col(col))).withColumn(col, L.joined(change(F.col("__lines")))).drop("__lines")


def _dropping(rule: Callable[[Column], Column]) -> Callable[..., DataFrame]:
    def operator(df: DataFrame, col: str = "text") -> DataFrame:
        return _on_lines(df, lambda lines: L.drop_where(lines, rule), col)

    return operator


drop_page_numbers = _dropping(L.is_page_number)
drop_captions = _dropping(L.is_caption)
drop_update_notes = _dropping(L.is_update_note)
drop_rights_notices = _dropping(L.is_rights_notice)
drop_page_headers = _dropping(L.is_page_header)
drop_corrupted_lines = _dropping(L.is_corrupted)
drop_ocr_noise = _dropping(L.is_ocr_noise)


def cleaning_marker(profile: str, is_ocr: bool = False) -> str:
    return f"{MARKER_OPEN}{profile},ocr={str(is_ocr).lower()}{MARKER_CLOSE}\n"


def has_marker(text: Column) -> Column:
    return text.rlike(rf"(?U)\A\s*{_MARKER}")


def strip_marker(df: DataFrame, col: str = "text") -> DataFrame:
    """Without the mark that a cleaned file begins with; a mark that isn't closed stays."""
    return _on_text(df, lambda t: F.regexp_replace(t, rf"(?sU)\A\s*{_MARKER}.*?{MARKER_CLOSE}\n*", ""), col)


def fix_artifacts(df: DataFrame, col: str = "text") -> DataFrame:
    """Control and zero-width characters go, broken ordinals and superscripts are repaired."""
    text = F.regexp_replace(F.col(col), r"[\x00-\x08\x0b\x0c\x0e-\x1f­​-‍﻿]", "")
    df = df.withColumn(col, F.regexp_replace(text, r"(?iU)(\d+)\s*\[e\]", "$1e"))
    for digit, raised in zip("23456789", "²³⁴⁵⁶⁷⁸⁹"):
        text, mark = F.col(col), rf"\[{digit}\]"
        for pattern, new in ((rf"(?U)\*\*(\w+)\*\*\s*\*\*{mark}\*\*", f"$1{raised}"), (rf"\*\*{mark}\*\*", raised), (rf"(?U)(\w)\s*{mark}", f"$1{raised}"), (rf"(?U)\*\*(\w+)\*\*\s*{mark}", f"$1{raised}")):
            text = F.regexp_replace(text, pattern, new)
        df = df.withColumn(col, text)
    return df


def join_hyphenated(df: DataFrame, col: str = "text") -> DataFrame:
    return _on_text(df, lambda t: F.regexp_replace(t, r"(?U)(\w+)[-‐­]\s*\n\s*(\w+)", "$1$2"), col)


def drop_toc(df: DataFrame, col: str = "text") -> DataFrame:
    """Tables of contents: an entry opens one, and all lines fall until a heading or a long sentence ends it.

    One letter per line: H heading, T entry, L long sentence, O other. A T, and each O that follows one without a gap
    but for other dropped lines, is struck out.
    """
    df = df.withColumn("__lines", L.lines_of(F.col(col)))

    def letter(x: Column, i: Column) -> Column:
        s = L.strip(x)
        return F.when(L.is_content_heading(x), "H").when(L.is_toc_entry(x), "T").when((F.length(s) > 100) & s.endswith("."), "L").otherwise("O")

    codes = L.letters_of(F.regexp_replace(L.letter_per_line("__lines", letter), r"T|(?!^)\GO", "X"))
    kept = L.let(codes, lambda c: F.filter("__lines", lambda x, i: F.get(c, i) != "X"))
    return df.withColumn(col, L.joined(kept)).drop("__lines")


def drop_front_matter(df: DataFrame, col: str = "text") -> DataFrame:
    """Publisher's lines at the start: all before the first line of content go; without one, the whole text."""
    df = df.withColumn("__lines", L.lines_of(F.col(col)))
    df = df.withColumn("__full", F.filter(F.transform("__lines", lambda x, i: F.when(~L.is_blank(x), i)), lambda i: i.isNotNull()))

    def begins(i: Column, rank: Column) -> Column:
        s = L.strip(F.get("__lines", i))
        front = s.rlike(P.FRONT_MATTER) | ((rank < 40) & (F.length(s) < 120) & ~s.endswith("."))
        return s.rlike(P.CONTENT_START) | ~front

    df = df.withColumn("__first", F.get("__full", (F.array_position(F.transform("__full", begins), True) - 1).cast("int")))
    kept = F.when(F.col(col).isNull(), F.lit(None)).when(F.col("__first").isNull(), F.lit("")).otherwise(L.joined(F.slice("__lines", F.col("__first") + 1, F.size("__lines"))))
    return df.withColumn(col, kept).drop("__lines", "__full", "__first")


def clean_characters(df: DataFrame, col: str = "text") -> DataFrame:
    """Pictures become [?], marks and unassigned characters a blank; two [?] side by side become one."""
    kept = "".join(f"\\x{{{ord(c):x}}}" for c in _SYMBOLS)
    text = F.regexp_replace(F.col(col), rf"[\p{{So}}&&[^\x{{0}}-\x{{2000}}{kept}]]", "[?]")
    text = F.regexp_replace(text, rf"[[\p{{M}}\p{{C}}]&&[^\x{{0}}-\x{{7f}}{kept}]]", " ")
    text = F.regexp_replace(text, r"(?U)\[\?\]\s*\[\?\]", "[?]")
    return df.withColumn(col, F.regexp_replace(text, r"(?mdU)^\s*\[\?\]\s*$", ""))


def normalize_whitespace(df: DataFrame, col: str = "text", most: int = 1) -> DataFrame:
    """Trailing blanks go, runs of blanks shrink to one, runs of empty lines to `most`, none at either end."""

    def change(t: Column) -> Column:
        t = F.regexp_replace(t, r"(?U)[\s&&[^\n]]+(?=\n|\z)", "")
        t = F.regexp_replace(t, " +", " ")
        t = F.regexp_replace(t, rf"\n{{{most + 2},}}", "\n" * (most + 1))
        return F.regexp_replace(t, r"\A\n+|\n+\z", "")

    return _on_text(df, change, col)


def drop_emails(df: DataFrame, col: str = "text") -> DataFrame:
    return _on_text(df, lambda t: F.regexp_replace(t, P.EMAIL, ""), col)


def drop_urls(df: DataFrame, col: str = "text") -> DataFrame:
    def change(t: Column) -> Column:
        for pattern in P.URLS:
            t = F.regexp_replace(t, pattern, "")
        return t

    return _on_text(df, change, col)


def drop_short_isolated(df: DataFrame, col: str = "text", least: int = 15) -> DataFrame:
    """Short lines between blank ones, headings excepted."""

    def change(lines: Column) -> Column:
        def isolated(x: Column, i: Column) -> Column:
            empty = lambda step: F.coalesce(L.is_blank(L.neighbour(lines, i, step)), F.lit(True))
            s = L.strip(x)
            return (F.length(s) < least) & empty(-1) & empty(1) & ~s.startswith("#")

        return F.filter(lines, lambda x, i: ~isolated(x, i))

    return _on_lines(df, change, col)


def drop_repeated_lines(df: DataFrame, col: str = "text", least: int = 3) -> DataFrame:
    """All copies of lines that occur `least` times, in texts of ten lines or more, unless they are most of a text."""
    same = lambda x: F.lower(F.regexp_replace(L.strip(x), r"(?U)\s+", " "))
    long = lambda x: F.length(L.strip(x)) >= 5
    df = df.withColumn("__lines", L.lines_of(F.col(col)))
    df = df.withColumn("__sorted", F.array_sort(F.transform(F.filter("__lines", long), same)))
    df = df.withColumn("__often", F.array_distinct(F.filter("__sorted", lambda x, i: F.get("__sorted", i - F.lit(least - 1)) == x)))
    kept = F.filter("__lines", lambda x: ~long(x) | ~F.array_contains("__often", same(x)))
    few = (F.size("__lines") < 10) | (F.size("__often") > F.size("__lines") * F.lit(0.3)) | (F.size("__often") == 0)
    return df.withColumn(col, F.when(few, F.col(col)).otherwise(L.joined(kept))).drop("__lines", "__sorted", "__often")


def _paired(df: DataFrame, col: str, opens: Callable[[Column, Column, Column], Column], join: Callable[[Column, Column], Column], prepare: Callable[[Column], Column]) -> DataFrame:
    """Joins a line with the next one where `opens` says so, left to right: a joined line isn't joined again."""
    df = df.withColumn("__lines", L.lines_of(F.col(col)))
    df = df.withColumn("__lines", F.transform("__lines", prepare))
    after = lambda i: L.neighbour(F.col("__lines"), i, 1)
    flags = L.letter_per_line(F.col("__lines"), lambda x, i: F.when(F.coalesce(opens(x, after(i), i), F.lit(False)), "m").otherwise("."))
    df = df.withColumn("__codes", L.letters_of(F.regexp_replace(flags, "m[m.]", "MX")))
    merged = F.transform("__lines", lambda x, i: F.when(F.get("__codes", i) == "M", join(x, after(i))).when(F.get("__codes", i) != "X", x))
    return df.withColumn(col, L.joined(F.filter(merged, lambda x: x.isNotNull()))).drop("__lines", "__codes")


def _heading_parts(s: Column) -> tuple[Column, Column]:
    """The marks of a heading, also with blanks between them, and its text."""
    marks = F.regexp_replace(F.regexp_extract(s, r"(?U)^((?:#\s*)+)", 1), r"(?U)\s", "")
    return marks, F.regexp_replace(s, r"(?U)^(?:#\s*)+", "")


def fix_broken_headings(df: DataFrame, col: str = "text") -> DataFrame:
    """A heading that goes on in lower case on the next line becomes one line."""

    def opens(x: Column, nxt: Column, i: Column) -> Column:
        _, title = _heading_parts(L.strip(x))
        n = L.strip(nxt)
        return L.strip(x).startswith("#") & (F.length(title) > 0) & ~L.any_suffix(title, ".", "?", "!") & (F.length(title) < 100) & (F.length(n) < 100) & L.starts_lower(n)

    def join(x: Column, nxt: Column) -> Column:
        marks, title = _heading_parts(L.strip(x))
        return F.concat(marks, F.lit(" "), title, F.lit(" "), L.strip(nxt))

    return _paired(df, col, opens, join, lambda x: F.regexp_replace(x, r"(?U)\s+\z", ""))


def normalize_headings(df: DataFrame, col: str = "text") -> DataFrame:
    """Headings with one blank between words and after the marks; headings without text go."""

    def change(lines: Column) -> Column:
        def one(x: Column) -> Column:
            marks, title = _heading_parts(L.strip(x))
            title = L.strip(F.regexp_replace(title, r"(?U)\s+", " "))
            return F.when(~L.strip(x).startswith("#"), x).when(F.length(title) > 0, F.concat(marks, F.lit(" "), title))

        return F.filter(F.transform(lines, one), lambda x: x.isNotNull())

    return _on_lines(df, change, col)


def improve_structure(df: DataFrame, col: str = "text") -> DataFrame:
    """Lines in capitals become headings; lines cut off within a sentence are joined with the next one."""

    def prepare(x: Column) -> Column:
        s = L.strip(x)
        heading = L.is_upper(s) & (F.size(F.split(s, r"(?U)\s+")) <= 15) & ~L.is_false_heading(s)
        return F.when(heading, F.concat(F.lit("\n### "), s, F.lit("\n"))).otherwise(x)

    def opens(x: Column, nxt: Column, i: Column) -> Column:
        s = L.strip(x)
        return (F.length(s) > 20) & ~L.any_suffix(s, ".", ":") & ~s.startswith("#") & L.starts_lower(L.strip(nxt))

    return _paired(df, col, opens, lambda x, nxt: F.concat(F.regexp_replace(x, r"(?U)\s+\z", ""), F.lit(" "), L.strip(nxt)), prepare)


def strip_text(df: DataFrame, col: str = "text") -> DataFrame:
    return _on_text(df, L.strip, col)


def _chain(df: DataFrame, steps: list[Transform]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


def clean_default(df: DataFrame, is_ocr: bool = False, corrupted: bool = True) -> DataFrame:
    """For plain extractors."""
    steps = [fix_artifacts, join_hyphenated, drop_page_numbers, drop_captions, drop_update_notes, drop_toc, drop_emails, drop_urls, drop_rights_notices, drop_page_headers, clean_characters]
    steps += [drop_repeated_lines, normalize_whitespace, fix_broken_headings, normalize_headings, improve_structure, *[drop_ocr_noise] * is_ocr, drop_short_isolated, normalize_whitespace, strip_text]
    return _chain(df, steps)


def clean_technical_manual(df: DataFrame, is_ocr: bool = False, corrupted: bool = True) -> DataFrame:
    """For manuals. The rule for corrupted lines also takes ordinary prose; corrupted=False leaves it out."""
    steps = [strip_marker, fix_artifacts, join_hyphenated, drop_page_numbers, drop_toc, drop_front_matter, drop_rights_notices, clean_characters]
    return _chain(df, [*steps, *[drop_ocr_noise] * is_ocr, *[drop_corrupted_lines] * corrupted, normalize_whitespace, normalize_headings, strip_text])


def clean_markdown(df: DataFrame, is_ocr: bool = False, corrupted: bool = True) -> DataFrame:
    """For Markdown that has its structure already."""
    steps = [strip_marker, fix_artifacts, join_hyphenated, drop_page_numbers, drop_toc, drop_rights_notices, clean_characters]
    return _chain(df, [*steps, *[drop_ocr_noise] * is_ocr, normalize_whitespace, normalize_headings, strip_text])


def clean_light(df: DataFrame, is_ocr: bool = False, corrupted: bool = True) -> DataFrame:
    """For text that has been cleaned before."""
    return _chain(df, [strip_marker, drop_page_numbers, normalize_whitespace, *[drop_corrupted_lines] * is_ocr, strip_text])


PROFILES = {"default": clean_default, "technical_manual": clean_technical_manual, "markdown": clean_technical_manual, "markdown_extraction": clean_markdown, "light": clean_light}


def clean(df: DataFrame, profile: str = "default", is_ocr: bool = False, corrupted: bool = True) -> DataFrame:
    return PROFILES[profile](df, is_ocr, corrupted)


def clean_for_chunking(df: DataFrame, source_col: str = "source", least: int = 50, corrupted: bool = True) -> DataFrame:
    """Marked texts get the light profile, others the one for manuals; what has under 50 characters left becomes null.

    Texts from a path with "scan" or "_ocr" count as OCR. One chain for all rows: where a step isn't for a row, the text
    that it would change is handed to it as null, and the one before is kept.
    """
    low = F.lower(F.coalesce(F.col(source_col), F.lit(""))) if source_col in df.columns else F.lit("")
    df = df.withColumn("__ocr", F.contains(low, F.lit("scan")) | F.contains(low, F.lit("_ocr"))).withColumn("__marked", has_marker(F.col("text")))

    def only(step: Transform, rows: Column) -> Transform:
        return lambda d: step(d.withColumn("__kept", F.col("text")).withColumn("text", F.when(rows, F.col("text")))).withColumn("text", F.when(rows, F.col("text")).otherwise(F.col("__kept"))).drop("__kept")

    manual, ocr = ~F.col("__marked"), F.col("__ocr")
    steps = [strip_marker, only(fix_artifacts, manual), only(join_hyphenated, manual), drop_page_numbers, only(drop_toc, manual), only(drop_front_matter, manual), only(drop_rights_notices, manual), only(clean_characters, manual), only(drop_ocr_noise, manual & ocr)]
    steps += [only(normalize_whitespace, ~manual), *[only(drop_corrupted_lines, manual | ocr)] * corrupted, only(normalize_whitespace, manual), only(normalize_headings, manual), strip_text]
    # Not a filter: pushed through all steps, it would repeat every one of them.
    return _chain(df, steps).withColumn("text", F.when(F.length("text") >= least, F.col("text"))).drop("__ocr", "__marked")
