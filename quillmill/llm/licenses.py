"""Licence scan: ordered signature rules behind a keyword filter, overlaps resolved by priority and containment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillmill.llm.license_rules import RULES, TAGGED

_GAP = r"(?:\s+(?:[*#/;%|>-]+\s+)?)"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    license: str
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern


def _compiled(pattern: str) -> re.Pattern:
    """A blank in a rule is a gap between words; one with "?" may be missing, and "[- ]" is a hyphen or a gap."""
    spaced = pattern.replace("[- ]", "(?:-| )").replace(" ?", "\0").replace(" ", _GAP).replace("\0", rf"{_GAP}?")
    return re.compile(spaced, re.I | re.S)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    out = []
    for name in TAGGED.split():
        pattern = rf"spdx-license-identifier: ?\(?{re.escape(name)}(?![\w.+-])"
        out.append(Rule(f"spdx:{name}", name, 100, ("spdx-license-identifier", name.lower()), _compiled(pattern)))
    out.append(Rule("spdx:other", "Other", 95, ("spdx-license-identifier",), _compiled(r"spdx-license-identifier: ?[\w.+()-]+")))
    for k, line in enumerate(x for x in RULES.strip().splitlines() if x.strip()):
        name, priority, keywords, pattern = (x.strip() for x in line.split(" | ", 3))
        out.append(Rule(f"{k + 1:03d}:{name}", name, int(priority), tuple(keywords.split("+")), _compiled(pattern)))
    return tuple(out)


def _words(text: str) -> str:
    """A keyword may lie across a gap between words, so gaps become blanks before keywords are sought.

    Letters become those that a regex takes them for when it ignores case; lower() alone leaves three out.
    """
    for letter, plain in () if text.isascii() else ("İi", "ıi", "ſs"):
        text = text.replace(letter, plain)
    return " ".join(t for t in text.lower().split() if t.strip("*#/;%|>-"))


@lru_cache(maxsize=1)
def _keywords() -> tuple[ahocorasick.Automaton, tuple[tuple[int, ...], ...]]:
    numbers: dict[str, int] = {}
    needed = tuple(tuple(numbers.setdefault(_words(k), len(numbers)) for k in r.keywords) for r in rules())
    automaton = ahocorasick.Automaton()
    for word, n in numbers.items():
        automaton.add_word(word, n)
    automaton.make_automaton()
    return automaton, needed


def contained(spans: list[tuple[int, int]]) -> list[bool]:
    """Of spans in order of precedence: whether each lies within an earlier one that was kept."""
    starts = sorted({a for a, _ in spans})
    place = {a: i + 1 for i, a in enumerate(starts)}
    furthest = [-1] * (len(starts) + 1)  # a Fenwick tree of the greatest end among starts up to a place
    out = []
    for a, b in spans:
        i, reach = place[a], -1
        while i:
            reach = max(reach, furthest[i])
            i -= i & -i
        out.append(reach >= b)
        i = place[a]
        while reach < b and i <= len(starts):
            furthest[i] = max(furthest[i], b)
            i += i & -i
    return out


def scan(text: str | None) -> list[tuple[str, str, int, int, int, str]]:
    """(rule_id, license, priority, start, end, matched) of the detections in a text, by place.

    Precedence: higher priority, then the longer match, then the earlier one, then the earlier rule. A detection within
    one of higher precedence is dropped; those that only overlap both stay.
    """
    if not text:
        return []
    automaton, needed = _keywords()
    seen = {n for _, n in automaton.iter(_words(text))}
    if not seen:
        return []
    found = []
    for k, (rule, numbers) in enumerate(zip(rules(), needed)):
        if seen.issuperset(numbers):
            found += [(-rule.priority, m.start() - m.end(), m.start(), k, m.end()) for m in rule.pattern.finditer(text) if m.end() > m.start()]
    found.sort()
    hidden = contained([(a, b) for _, _, a, _, b in found])
    kept = sorted((a, b, k) for (_, _, a, k, b), gone in zip(found, hidden) if not gone)
    return [(rules()[k].rule_id, rules()[k].license, rules()[k].priority, a, b, text[a:b]) for a, b, k in kept]


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, rule_id, license, priority, start, end, matched): every detection in every row of docs.

    Null and empty texts have none. Rows with a null doc_id, and repeated rows, are scanned like any other. Whole texts
    are scanned; start and end count code points. Other columns aren't read.
    """
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    names = ["doc_id", "rule_id", "license", "priority", "start", "end", "matched"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *x) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in scan(t)]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0)
    return rows.mapInArrow(run, "doc_id long, rule_id string, license string, priority int, start int, end int, matched string")
