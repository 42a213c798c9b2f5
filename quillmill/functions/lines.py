"""Rules about one line of text, and the arrays of lines they are applied to.

A document is cleaned within its row: its lines form an array, and a rule that depends on neighbours is written as a
regex over a string of one letter per line. So no cleaning step moves a text between executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from quillmill.functions import patterns as P


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def joined(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def letters(c: Column) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, r"\p{L}", ""))


def is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & (F.lower(c) != c)


def starts_lower(c: Column) -> Column:
    return c.rlike(r"^\p{Ll}")


def any_prefix(c: Column, *prefixes: str) -> Column:
    out = c.startswith(prefixes[0])
    for p in prefixes[1:]:
        out = out | c.startswith(p)
    return out


def any_suffix(c: Column, *suffixes: str) -> Column:
    out = c.endswith(suffixes[0])
    for s in suffixes[1:]:
        out = out | c.endswith(s)
    return out


# --- rules about one line -------------------------------------------------------------------------------------------


def is_page_number(line: Column) -> Column:
    return line.rlike(P.PAGE_NUMBER)


def is_caption(line: Column) -> Column:
    return strip(line).rlike(P.CAPTION)


def is_update_note(line: Column) -> Column:
    return strip(line).rlike(P.UPDATE)


def is_rights_notice(line: Column) -> Column:
    return line.rlike(P.COPYRIGHT)


def is_page_header(line: Column) -> Column:
    return strip(line).rlike(P.PAGE_HEADER)


def is_toc_header(line: Column) -> Column:
    s = strip(line)
    return s.rlike(P.TOC_HEADER) | F.lower(strip(F.regexp_replace(s, r"\*+", ""))).isin(*P.TOC_HEADER_NAMES)


def is_toc_entry(line: Column) -> Column:
    s = strip(line)
    short = s.rlike(P.TOC_SHORT_END) & (F.length(s) < 90) & s.rlike(P.TOC_SHORT_START)
    return (F.length(s) > 0) & ~s.startswith("#") & (is_toc_header(line) | s.rlike(P.TOC_ENTRY_EXACT) | s.rlike(P.TOC_ENTRY_START) | short)


def is_content_heading(line: Column) -> Column:
    return strip(line).rlike(P.HEADING_START)


def vowel_share(c: Column) -> Column:
    low = F.lower(c)
    vowels = F.length(low) - F.length(F.regexp_replace(low, "[aeiouyàâäéèêëïîôùûüæœ]", ""))
    return F.when(letters(c) > 0, vowels / letters(c)).otherwise(F.lit(0.0))


def is_corrupted(line: Column) -> Column:
    s = strip(line)
    broken = F.regexp_count(s, F.lit(r"(?iu)[a-zà-ü]\s+[a-zà-ü]")) >= 3
    return (F.length(s) >= 20) & ~any_prefix(s, "#", "|") & (broken | ((vowel_share(s) < 0.25) & (F.length(s) > 25)))


def is_ocr_noise(line: Column) -> Column:
    s = strip(line)
    return (F.length(s) < 3) | ((letters(s) > 0) & (letters(s) / F.length(s) < 0.5)) | s.rlike(r"^[^a-zA-Z0-9\s]{3,}$")


def is_false_heading(s: Column) -> Column:
    return (F.length(s) == 0) | s.startswith("#") | F.contains(s, F.lit("**")) | s.rlike("^[CDILMVX]+$") | s.rlike(r"\p{Nd}")


def heading_level(line: Column) -> Column:
    """1 to 6 for a marked heading, 3 for a line in capitals, null for any other line."""
    s = strip(line)
    marked = s.rlike(r"^#{1,6}\s+.+$")
    capitals = is_upper(s) & F.length(s).between(6, 99) & (letters(s) / F.length(s) > 0.6)
    return F.when(marked, F.length(F.regexp_extract(s, "^(#{1,6})", 1))).when(capitals, F.lit(3))


def heading_title(line: Column) -> Column:
    s = strip(line)
    return F.when(s.rlike(r"^#{1,6}\s+.+$"), strip(F.regexp_replace(s, r"^#{1,6}\s+", ""))).otherwise(s)


def is_valid_title(title: Column) -> Column:
    c = strip(F.regexp_replace(title, r"\*+", ""))
    return (F.length(c) >= 4) & ~c.rlike(r"^[0-9]+$") & ~c.rlike("^[WθΔΦλ]+$") & (letters(c) / F.length(c) >= 0.4)


def is_table_line(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit(""))) >= 2


# --- rules over lines -----------------------------------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once: a column used only within a lambda would be inlined, and so worked out
    again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def drop_where(lines: Column, rule: Callable[[Column], Column]) -> Column:
    return F.filter(lines, lambda x: ~rule(x))


def letter_per_line(lines: Column, rule: Callable[[Column, Column], Column]) -> Column:
    return F.array_join(F.transform(lines, rule), "")


def letters_of(codes: Column) -> Column:
    return F.split(codes, "")


def neighbour(lines: Column, i: Column, step: int) -> Column:
    """The line `step` before or after position i, null beyond the ends."""
    return F.get(lines, i + F.lit(step))
