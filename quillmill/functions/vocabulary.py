"""Keywords, tags and label of a text in one Arrow pass.

An automaton over all terms of all tags and labels goes through a text once; only patterns of which a term occurs are then
tried. In expressions, each pattern would go through each text, and words would be counted by interpreted functions, which
takes some ten times as long.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, functions as F

from quillmill.functions import patterns as P
from quillmill.functions.batches import mapped

PLAIN_WORD = "^[a-zA-ZÀ-ÿ]{4,}$"
#: Whole words that PLAIN_WORD fits; the two signs among its letters aren't parts of words.
_PLAIN = re.compile(r"(?<!\w)[a-zA-ZÀ-ÖØ-öø-ÿ]{4,}(?!\w)")
FACTS = "struct<keywords:array<string>,tags:array<string>,label:string,confidence:double>"
_ARROW = pa.struct([("keywords", pa.list_(pa.string())), ("tags", pa.list_(pa.string())), ("label", pa.string()), ("confidence", pa.float64())])


def terms(pattern: str) -> list[str]:
    """All strings of which one lies in every match: the alternatives without boundaries, their classes of letters spelt out."""
    out = []
    for part in pattern.split("|"):
        choices = re.findall(r"\[([^\]]+)\]|(.)", part.replace(r"\b", ""))
        out += ["".join(x) for x in product(*(group or one for group, one in choices))]
    return out


@lru_cache(maxsize=1)
def _automaton() -> tuple:
    """Terms lead to the numbers of their patterns: the tags', then the labels'."""
    import ahocorasick  # where it runs, on the executors

    patterns = [*P.DOMAIN_TAGS.values(), *P.LABELS.values()]
    of: dict[str, set[int]] = {}
    for k, pattern in enumerate(patterns):
        for term in terms(pattern):
            of.setdefault(term, set()).add(k)
    found = ahocorasick.Automaton()
    for term, numbers in of.items():
        found.add_word(term, numbers)
    found.make_automaton()
    return found, [re.compile(p) for p in patterns]


def keywords(low: str, most: int) -> list[str]:
    counts = Counter(w for w in _PLAIN.findall(low) if w not in P.STOP_WORDS)
    return [w for w, _ in counts.most_common(most)]


def tags_and_label(low: str, most: int) -> tuple[list[str], str, float]:
    found, patterns = _automaton()
    numbers: set[int] = set().union(*(of for _, of in found.iter(low)))
    names, n = [*P.DOMAIN_TAGS], len(P.DOMAIN_TAGS)
    tags = [names[k] for k in sorted(numbers) if k < n and patterns[k].search(low)]
    counts = [len(patterns[n + k].findall(low)) if n + k in numbers else 0 for k in range(len(P.LABELS))]
    best = max(counts)
    if not best:
        return tags[:most], "general", 0.45
    return tags[:most], [*P.LABELS][counts.index(best)], 0.78 if best >= 3 else 0.62


def text_facts(text: Column, n_keywords: int = 5, n_tags: int = 8) -> Column:
    """Struct (keywords, tags, label, confidence). A null text has no keyword and no tag, and is general."""

    def one(t: str | None) -> dict:
        low = (t or "").lower()
        tags, label, confidence = tags_and_label(low, n_tags)
        return {"keywords": keywords(low, n_keywords), "tags": tags, "label": label, "confidence": confidence}

    return F.arrow_udf(lambda texts: mapped(texts, one, _ARROW), FACTS)(text)


def only_keywords(text: Column, most: int = 5) -> Column:
    return F.arrow_udf(lambda texts: mapped(texts, lambda t: keywords((t or "").lower(), most), pa.list_(pa.string())), "array<string>")(text)


def only_tags_and_label(text: Column, most: int = 8) -> Column:
    kind = pa.struct([*_ARROW][1:])

    def one(t: str | None) -> dict:
        return dict(zip(("tags", "label", "confidence"), tags_and_label((t or "").lower(), most)))

    return F.arrow_udf(lambda texts: mapped(texts, one, kind), FACTS.replace("keywords:array<string>,", ""))(text)
