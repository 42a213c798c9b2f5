"""The cleaning rules in DuckDB's SQL, written from what they mean and not from how Spark does them: states are windows
over exploded lines here. A step is a function from the name of a CTE and a new name to the SQL of the new CTE."""

from __future__ import annotations

from collections.abc import Callable

from quillmill.functions import patterns as P
from quillmill.operators.cleaning import _SYMBOLS

Step = Callable[[str, str], str]


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    return q(pattern.replace("(?iu)", "(?i)"))


def _sub(subject: str, pattern: str, new: str, flags: str = "g") -> str:
    return f"regexp_replace({subject}, {q(pattern)}, {q(new)}, '{flags}')"


def strip(x: str) -> str:
    return _sub(x, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")


def letters(x: str) -> str:
    return f"(length({x}) - length({_sub(x, chr(92) + 'p{L}', '')}))"


def of_text(expression: str) -> Step:
    """A step whose result is an expression of the column text."""
    return lambda src, dst: f"{dst} AS MATERIALIZED (SELECT doc_id, {expression} AS text FROM {src})"


def of_lines(keep: str | None = None, change: str = "x") -> Step:
    """Lines x of which those that satisfy keep stay, as changed; null ones fall."""
    lines = "string_split(text, chr(10))"
    kept = f"list_filter({lines}, lambda x: {keep})" if keep else lines
    return of_text(f"array_to_string(list_filter(list_transform({kept}, lambda x: {change}), lambda x: x IS NOT NULL), chr(10))")


def _lines(src: str) -> str:
    return f"SELECT doc_id, i, ls[i] AS x, len(ls) AS n, {strip('ls[i]')} AS s FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {src}))"


def _windowed(columns: str, keep: str) -> Step:
    """Lines with further columns (window functions over x, s, i, n), of which those that satisfy keep stay."""
    return lambda src, dst: f"""{dst} AS MATERIALIZED (SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text FROM {src} d LEFT JOIN (
        SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS text FROM (SELECT *, {columns} FROM ({_lines(src)})) WHERE {keep} GROUP BY doc_id) k ON k.doc_id = d.doc_id)"""


def _paired(prepare: str, opens: str, join: str) -> Step:
    """Joins line x with the next one y where opens says so, from left to right: an opened pair's second line opens none.

    Within a run of lines that could open, every second one does.
    """
    return lambda src, dst: f"""{dst}_p AS MATERIALIZED (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {prepare}) AS ls FROM {src}),
        {dst}_l AS (SELECT doc_id, i, ls[i] AS x, ls[i + 1] AS y FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM {dst}_p)),
        {dst}_c AS (SELECT *, coalesce({opens}, false) AS can FROM (SELECT *, {strip('x')} AS s, {strip('y')} AS t FROM {dst}_l)),
        {dst}_r AS (SELECT *, coalesce(sum(CASE WHEN can THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM {dst}_c),
        {dst}_o AS (SELECT *, can AND row_number() OVER (PARTITION BY doc_id, run ORDER BY i) % 2 = 1 AS opened FROM {dst}_r),
        {dst}_g AS (SELECT *, coalesce(lag(opened) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM {dst}_o),
        {dst} AS MATERIALIZED (SELECT d.doc_id, k.text FROM {src} d LEFT JOIN (SELECT doc_id, string_agg(CASE WHEN opened THEN {join} ELSE x END, chr(10) ORDER BY i) AS text FROM {dst}_g WHERE NOT gone GROUP BY doc_id) k ON k.doc_id = d.doc_id)"""


def _chain(subject: str, *pairs: tuple[str, str]) -> str:
    for pattern, new in pairs:
        subject = _sub(subject, pattern, new)
    return subject


_W = r"[\p{L}\p{N}_]"
_SUPERSCRIPTS = [
    pair
    for d, r in zip("23456789", "²³⁴⁵⁶⁷⁸⁹")
    for pair in ((rf"\*\*({_W}+)\*\*\s*\*\*\[{d}\]\*\*", rf"\1{r}"), (rf"\*\*\[{d}\]\*\*", r), (rf"({_W})\s*\[{d}\]", rf"\1{r}"), (rf"\*\*({_W}+)\*\*\s*\[{d}\]", rf"\1{r}"))
]
_ARTIFACTS = _chain("text", (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{ad}\x{200b}-\x{200d}\x{feff}]", ""), (r"(?i)([0-9]+)\s*\[e\]", r"\1e"), *_SUPERSCRIPTS)

_TOC_HEADER = f"(regexp_matches(s, {re2(P.TOC_HEADER)}) OR lower({strip(_sub('s', r'[*]+', ''))}) IN ({', '.join(map(q, P.TOC_HEADER_NAMES))}))"
_TOC_SHORT = f"(regexp_matches(s, {re2(P.TOC_SHORT_END)}) AND length(s) < 90 AND regexp_matches(s, {re2(P.TOC_SHORT_START)}))"
_TOC_ENTRY = f"(length(s) > 0 AND NOT starts_with(s, '#') AND ({_TOC_HEADER} OR regexp_matches(s, {re2(P.TOC_ENTRY_EXACT)}) OR regexp_matches(s, {re2(P.TOC_ENTRY_START)}) OR {_TOC_SHORT}))"
_HEADING = f"regexp_matches(s, {re2(P.HEADING_START)})"
_LONG = "(length(s) > 100 AND ends_with(s, '.'))"
_EVENT = f"CASE WHEN {_HEADING} THEN 0 WHEN {_TOC_ENTRY} THEN 1 WHEN {_LONG} THEN 0 END"
_IN_TOC = f"coalesce(last_value({_EVENT} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"

_RANK = "coalesce(sum(CASE WHEN s <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
_FRONT = f"(regexp_matches(s, {re2(P.FRONT_MATTER)}) OR (r < 40 AND length(s) < 120 AND NOT ends_with(s, '.')))"


def _front_matter(src: str, dst: str) -> str:
    begins = f"s <> '' AND (regexp_matches(s, {re2(P.CONTENT_START)}) OR NOT {_FRONT})"
    return f"""{dst} AS MATERIALIZED (WITH a AS (SELECT *, {_RANK} AS r FROM ({_lines(src)})), b AS (SELECT doc_id, min(i) AS first FROM a WHERE {begins} GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text FROM {src} d LEFT JOIN (SELECT a.doc_id, string_agg(x, chr(10) ORDER BY i) AS text FROM a JOIN b ON a.doc_id = b.doc_id AND i >= first GROUP BY a.doc_id) k ON k.doc_id = d.doc_id)"""


_NORM = f"lower({_sub('s', chr(92) + 's+', ' ')})"


def _repeated(src: str, dst: str) -> str:
    return f"""{dst} AS MATERIALIZED (WITH a AS (SELECT *, CASE WHEN length(s) >= 5 THEN {_NORM} END AS k FROM ({_lines(src)})),
        c AS (SELECT doc_id, k, count(*) AS c FROM a WHERE k IS NOT NULL GROUP BY doc_id, k HAVING count(*) >= 3), o AS (SELECT doc_id, count(*) AS o FROM c GROUP BY doc_id),
        e AS (SELECT a.doc_id, a.i, a.x, c.c IS NOT NULL AND n >= 10 AND o.o <= n * 0.3 AS gone FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.k = c.k LEFT JOIN o ON a.doc_id = o.doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text FROM {src} d LEFT JOIN (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS text FROM e WHERE NOT gone GROUP BY doc_id) k ON k.doc_id = d.doc_id)"""


_CHARACTER = rf"""CASE WHEN c < chr(128) OR contains({q(_SYMBOLS)}, c) THEN c WHEN regexp_matches(c, '\p{{So}}') AND unicode(c) > 8192 THEN '[?]' WHEN regexp_matches(c, '[\p{{M}}\p{{C}}]') THEN ' ' ELSE c END"""
_CHARACTERS = _chain(f"array_to_string(list_transform(regexp_extract_all(text, '(?s).'), lambda c: {_CHARACTER}), '')", (r"\[\?\]\s*\[\?\]", "[?]"), (r"(?m)^\s*\[\?\]\s*$", ""))
_WHITESPACE = _chain("text", (r"[ \t\r\f\v]+(\n|\z)", r"\1"), (" +", " "), (r"\n{3,}", "\n\n"), (r"\A\n+|\n+\z", ""))

_VOWELS = f"(length(lower(s)) - length({_sub('lower(s)', '[aeiouyàâäéèêëïîôùûüÿæœ]', '')}))"
_CORRUPTED = rf"(length(s) >= 20 AND s[1] NOT IN ('#', '|') AND (len(regexp_extract_all(s, '(?i)[a-zà-ü]\s+[a-zà-ü]')) >= 3 OR (CASE WHEN {letters('s')} > 0 THEN {_VOWELS} / {letters('s')} ELSE 0 END < 0.25 AND length(s) > 25)))"
_NOISE = rf"(length({strip('x')}) < 3 OR ({letters(strip('x'))} > 0 AND {letters(strip('x'))} / length({strip('x')}) < 0.5) OR regexp_matches({strip('x')}, '^[^a-zA-Z0-9\s]{{3,}}$'))"

_EMPTY = "coalesce({} = '', true)"
_NEIGHBOUR = "OVER (PARTITION BY doc_id ORDER BY i)"
_ISOLATED = f"(length(s) < 15 AND before_empty AND after_empty AND NOT starts_with(s, '#'))"

_MARKS = _sub(rf"regexp_extract(s, '^((?:#\s*)+)', 1)", r"\s", "")
_TITLE = _sub("s", r"^(?:#\s*)+", "")
_BROKEN = rf"starts_with(s, '#') AND length({_TITLE}) > 0 AND NOT regexp_matches({_TITLE}, '[.?!]$') AND length({_TITLE}) < 100 AND length(t) < 100 AND regexp_matches(t, '^\p{{Ll}}')"
_SX, _CLEAN_TITLE = strip("x"), strip(_sub(_sub(strip("x"), r"^(?:#\s*)+", ""), r"\s+", " "))
_NORMAL_HEADING = f"CASE WHEN NOT starts_with({_SX}, '#') THEN x WHEN length({_CLEAN_TITLE}) > 0 THEN concat({_sub(f'regexp_extract({_SX}, {q(r"^((?:#\s*)+)")}, 1)', chr(92) + 's', '')}, ' ', {_CLEAN_TITLE}) END"
_FALSE = rf"(length({_SX}) = 0 OR starts_with({_SX}, '#') OR contains({_SX}, '**') OR regexp_matches({_SX}, '^[CDILMVX]+$') OR regexp_matches({_SX}, '\p{{Nd}}'))"
_CAPITALS = rf"upper({_SX}) = {_SX} AND lower({_SX}) <> {_SX} AND len(regexp_split_to_array({_SX}, '\s+')) <= 15 AND NOT {_FALSE}"

STEPS: dict[str, Step] = {
    "artifacts": of_text(_ARTIFACTS),
    "hyphenation": of_text(_chain("text", (rf"({_W}+)[-\x{{2010}}\x{{ad}}]\s*\n\s*({_W}+)", r"\1\2"))),
    "page_numbers": of_lines(f"NOT regexp_matches(x, {re2(P.PAGE_NUMBER)})"),
    "captions": of_lines(f"NOT regexp_matches({_SX}, {re2(P.CAPTION)})"),
    "update_notes": of_lines(f"NOT regexp_matches({_SX}, {re2(P.UPDATE)})"),
    "toc": _windowed(f"{_IN_TOC} AS in_toc", f"{_HEADING} OR (NOT {_TOC_ENTRY} AND ({_LONG} OR in_toc = 0))"),
    "front_matter": _front_matter,
    "rights_notices": of_lines(f"NOT regexp_matches(x, {re2(P.COPYRIGHT)})"),
    "page_headers": of_lines(f"NOT regexp_matches({_SX}, {re2(P.PAGE_HEADER)})"),
    "emails": of_text(_chain("text", (P.EMAIL, ""))),
    "urls": of_text(_chain("text", *((p, "") for p in P.URLS))),
    "characters": of_text(_CHARACTERS),
    "whitespace": of_text(_WHITESPACE),
    "corrupted_lines": _windowed("1 AS one", f"NOT {_CORRUPTED}"),
    "ocr_noise": of_lines(f"NOT {_NOISE}"),
    "short_lines": _windowed(f"{_EMPTY.format(f'lag(s) {_NEIGHBOUR}')} AS before_empty, {_EMPTY.format(f'lead(s) {_NEIGHBOUR}')} AS after_empty", f"NOT {_ISOLATED}"),
    "repeated_lines": _repeated,
    "broken_headings": _paired(_sub("x", r"\s+$", ""), _BROKEN, f"concat({_MARKS}, ' ', {_TITLE}, ' ', t)"),
    "headings": of_lines(None, _NORMAL_HEADING),
    "structure": _paired(rf"CASE WHEN {_CAPITALS} THEN concat(chr(10), '### ', {_SX}, chr(10)) ELSE x END", r"length(s) > 20 AND NOT regexp_matches(s, '[.:]$') AND NOT starts_with(s, '#') AND regexp_matches(t, '^\p{Ll}')", f"concat({_sub('x', r'[\s]+$', '')}, ' ', t)"),
    "strip": of_text(strip("text")),
}

PROFILES = {
    "default": "artifacts hyphenation page_numbers captions update_notes toc emails urls rights_notices page_headers characters repeated_lines whitespace broken_headings headings structure short_lines whitespace strip",
    "technical_manual": "artifacts hyphenation page_numbers toc front_matter rights_notices characters corrupted_lines whitespace headings strip",
    "markdown": "artifacts hyphenation page_numbers toc rights_notices characters whitespace headings strip",
    "light": "page_numbers whitespace strip",
}


def chain_sql(names: str, first: str, ctes: str) -> str:
    """SELECT of steps one after the other, from a CTE on."""
    out, src = [ctes], first
    for k, name in enumerate(names.split()):
        out.append(STEPS[name](src, f"s{k}"))
        src = f"s{k}"
    return "WITH " + ",\n".join(out) + f" SELECT doc_id, text FROM {src}"
