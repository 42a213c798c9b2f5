"""Cutting one text into pieces, in plain Python: what needs recursion or a running state over the pieces of a document.

Each function takes a text and yields strings or (title, string); operators run them over Arrow batches, so no text leaves
its row.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

SEPARATORS = ("\n### ", "\n## ", "\n# ", "\n\n", "\n", ". ", " ", "")
TABLE_SEPARATORS = ("\n\n", "\n")
LIST_SEPARATORS = ("\n\n", *(f"\n{b} " for b in "-*+"), "\n")
CODE_SEPARATORS = ("\n\n", "\n```", "\n", "")
NUMBERED_SEPARATORS = (*(f"\n{n}." for n in range(1, 10)), *("\n" + "#" * n + " " for n in (4, 3, 2, 1)), "\n\n", "\n", ". ", " ")
COVER, WHOLE = "Page de garde", "Document"


def _merged(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    held: deque[str] = deque()
    total = 0
    for piece in pieces:
        if total + len(piece) > size and held:
            if text := "".join(held).strip():
                yield text
            while held and (total > overlap or total + len(piece) > size):
                total -= len(held.popleft())
        held.append(piece)
        total += len(piece)
    if text := "".join(held).strip():
        yield text


def split_text(text: str, size: int = 1000, overlap: int = 200, separators: Sequence[str] = SEPARATORS) -> Iterator[str]:
    """Chunks of at most `size` characters: cut at the first separator that occurs, and further where that isn't enough.

    A separator stays at the start of the piece that follows it. Neighbouring chunks share up to `overlap` characters.
    """
    at = next((k for k, s in enumerate(separators) if s in text), len(separators))
    rest = separators[at + 1 :]
    if at == len(separators):
        pieces = [text]
    elif not separators[at]:
        pieces = list(text)
    else:
        first, *more = text.split(separators[at])
        pieces = [first, *(separators[at] + p for p in more)]
    held: list[str] = []
    for piece in filter(None, pieces):
        if len(piece) < size:
            held.append(piece)
            continue
        yield from _merged(held, size, overlap)
        held = []
        if rest:
            yield from split_text(piece, size, overlap, rest)
        else:
            yield piece
    yield from _merged(held, size, overlap)


def is_table_line(line: str) -> bool:
    return line.count("|") >= 2


def table_blocks(text: str) -> list[tuple[bool, str]]:
    """(is a table, block) in turn. A blank line belongs to a table that goes before it; blocks are stripped."""
    lines, in_table, kinds = text.split("\n"), False, []
    for line in lines:
        in_table = is_table_line(line) or in_table and not line.strip()
        kinds.append(in_table)
    blocks = ((kind, "\n".join(x for _, x in run).strip()) for kind, run in groupby(zip(kinds, lines), key=lambda p: p[0]))
    return [(kind, block) for kind, block in blocks if block]


def content_type(text: str) -> str:
    """narrative, table, list, code or mixed, by shares of lines."""
    lines = text.split("\n")
    full = sum(1 for x in lines if x.strip())
    count = lambda rule: sum(map(bool, map(rule, lines)))
    table = max(count(is_table_line), count(lambda x: x.count("\t") >= 2)) / full if full else 0.0
    items = max(count(re.compile(r"\s*[-*+]\s+").match), count(re.compile(r"\s*\d+\.\s+").match)) / full if full else 0.0
    if "```" in text:
        code = 0.9
    elif len(re.findall(r"`[^`]+`", text)) > 3:
        code = 0.6
    else:
        code = 0.7 if count(lambda x: x.startswith(("    ", "\t"))) / len(lines) > 0.5 else 0.0
    if max(table, items, code) < 0.2:
        return "narrative"
    return next((kind for kind, score in (("table", table), ("list", items), ("code", code)) if score >= 0.3), "mixed")


def is_valid_title(title: str) -> bool:
    """Not a formula, a label or a number that extraction took for a title."""
    clean = title.replace("*", "").strip()
    return len(clean) >= 4 and not re.fullmatch(r"\d+|[WλΦΔθ]+", clean) and sum(map(str.isalpha, clean)) / len(clean) >= 0.4


def sentences(text: str, longer_than: int = 15) -> list[str]:
    found = [s for x in re.split(r"(?<=[.!?])\s+", text) if len(s := x.strip()) > longer_than]
    return found or [text]


def sentence_contexts(text: str, reach: int = 2) -> list[str]:
    found = sentences(text)
    return [" ".join(found[max(0, i - reach) : i + reach + 1]) for i in range(len(found))]


@dataclass(frozen=True)
class Sizes:
    """Characters of chunks: `size` and `overlap` within sections, `least` and `most` of the sections themselves."""

    size: int = 1000
    overlap: int = 200
    least: int = 400
    most: int = 2000

    def of(self, kind: str) -> tuple[int, int, tuple[str, ...]]:
        if kind == "table":
            return max(2 * self.size, 2000), 0, TABLE_SEPARATORS
        if kind in ("list", "code"):
            return int(1.5 * self.size), 100, LIST_SEPARATORS if kind == "list" else CODE_SEPARATORS
        return self.size, self.overlap, SEPARATORS


def adaptive(text: str, sizes: Sizes = Sizes(), kind: str | None = None) -> Iterator[str]:
    """Chunks by the type of the content; a table stays whole, and what lies between tables is cut as one text."""
    kind = kind or content_type(text)
    size, overlap, separators = sizes.of(kind)
    if kind != "table":
        yield from split_text(text, size, overlap, separators)
        return
    for is_table, run in groupby(table_blocks(text), key=lambda b: b[0]):
        blocks = [b for _, b in run]
        if is_table:
            yield from blocks
        elif len(between := "\n\n".join(blocks)) <= size:
            yield between
        else:
            yield from split_text(between, size, overlap, separators)


def split_large(text: str, title: str, sizes: Sizes) -> Iterator[tuple[str, str]]:
    """Blocks of a section that is too long: tables whole, other blocks cut, with the number of the part in the title."""
    blocks = table_blocks(text)
    for is_table, block in blocks:
        parts = [block] if is_table or len(block) <= sizes.most else list(split_text(block, sizes.most, sizes.overlap, NUMBERED_SEPARATORS))
        if len(parts) == 1:
            yield title, block
        else:
            yield from ((f"{title} (partie {k}/{len(parts)})", part) for k, part in enumerate(parts, 1))
    if not blocks:
        yield title, text


def split_at_level(text: str, level: int) -> list[tuple[str, str]]:
    """(heading, section) at the first level from `level` on that gives three sections, or at the sixth.

    What goes before the first section is one as well, if it has 30 characters.
    """
    lines = text.split("\n")
    while True:
        mark = "#" * level + " "
        opens = [i for i, x in enumerate(lines) if x.startswith(mark) and is_valid_title(x[len(mark) :].strip())]
        found = [(lines[a].strip(), body) for a, b in zip(opens, [*opens[1:], len(lines)]) if (body := "\n".join(lines[a:b]).strip())]
        before = "\n".join(lines[: opens[0]] if opens else lines).strip()
        if len(before) >= 30:
            found.insert(0, (COVER, before))
        if len(found) >= 3 or level >= 6:
            return found
        level += 1


def heading(line: str) -> tuple[int, str] | None:
    """(level, title) of a marked heading, or of a line in capitals, which is of level 3."""
    s = line.strip()
    if found := re.match(r"(#{1,6})\s+(.+)$", s):
        return len(found[1]), found[2].strip()
    if s.isupper() and 5 < len(s) < 100 and sum(map(str.isalpha, s)) / len(s) > 0.6:
        return 3, s
    return None


def heading_level(text: str) -> int:
    """The level with most valid titles; of equals the one nearest to 3, then the one met first; 3 without any."""
    counts: dict[int, int] = {}
    for found in filter(None, map(heading, text.split("\n"))):
        if is_valid_title(found[1]):
            counts[found[0]] = counts.get(found[0], 0) + 1
    return max(counts, key=lambda k: (counts[k], -abs(k - 3)), default=3)


def sections(text: str) -> tuple[list[int], list[tuple[str, int, list[str]]]]:
    """Where the sections of a text begin, and the (title, level, path) of each; a heading opens one, the next ends it."""
    starts, found, above, at = [], [], [], 0
    for line in text.split("\n"):
        if opened := heading(line):
            level, title = opened
            above = [x for x in above if x[0] < level] + [opened]
            starts.append(at)
            found.append((title, level, [t for _, t in above]))
        at += len(line) + 1
    return starts, found


def joined_small(sections: list[tuple[str, str]], sizes: Sizes) -> Iterator[tuple[str, str]]:
    """A short section is joined with the next one if both fit; a joined one isn't joined again."""
    waiting = deque(sections)
    while waiting:
        title, body = waiting.popleft()
        if len(body) < sizes.least and waiting and len(body) + len(waiting[0][1]) + 2 <= sizes.most:
            other, more = waiting.popleft()
            title, body = f"{title} / {other}", f"{body}\n\n{more}"
        elif len(body) > sizes.most:
            yield from split_large(body, title, sizes)
            continue
        yield title, body


def by_sections(text: str, sizes: Sizes = Sizes(), level: int | None = None) -> list[tuple[str, str]]:
    """(title, chunk) by the headings of the level that suits the document, within the bounds of size."""
    cut: list[tuple[str, str]] = []
    for title, body in split_at_level(text, level or heading_level(text)):
        if len(body) >= 30:
            cut += split_large(body, title, sizes) if len(body) > sizes.most else [(title, body)]
    return list(joined_small(cut, sizes) if cut else split_large(text, WHOLE, sizes))


def hybrid(text: str, sizes: Sizes = Sizes(), procedural: bool = False) -> Iterator[tuple[str, str]]:
    """Sections, of which tables, lists and code are cut by their type, and the prose of procedures by sentences."""
    for title, body in by_sections(text, sizes):
        kind = content_type(body)
        if kind in ("table", "list", "code"):
            yield from ((title, x) for x in adaptive(body, sizes, kind))
        elif procedural:
            yield from ((title, x) for x in sentence_contexts(body))
        else:
            yield title, body


def positions(text: str, chunks: Sequence[str], overlap: int) -> list[int]:
    """Where each chunk begins in the text: its first 80 characters are sought from the one before on.

    The next search begins `overlap` before a chunk's end; a chunk that isn't found counts as beginning there.
    """
    out, begin = [], 0
    for chunk in chunks:
        at = text.find(chunk[:80], begin)
        out.append(begin if at < 0 else at)
        if at >= 0:
            begin = at + max(1, len(chunk) - overlap)
    return out


Tokenizer = Callable[[str], list[str]]
_PIECE = re.compile(r"\s*(?:[^\W_]+|[^\w\s]|_)|\s+\Z")


def plain_tokens(text: str) -> list[str]:
    """The default tokens, which need no vocabulary: words and marks, with the white space before them."""
    return _PIECE.findall(text)


def token_windows(text: str, size: int, overlap: int, tokenizer: Tokenizer = plain_tokens) -> Iterator[str]:
    """Windows of `size` tokens, each beginning `overlap` before the last one's end."""
    if not text.strip():
        return
    tokens = tokenizer(text)
    yield from ("".join(tokens[k : k + size]) for k in range(0, len(tokens), size - overlap))


def token_chunks(text: str, size: int, overlap: int, tokenizer: Tokenizer = plain_tokens) -> Iterator[str]:
    """The same for each block of a text; a table that fits stays whole."""
    for is_table, block in table_blocks(text):
        if is_table and len(tokenizer(block)) <= size:
            yield block
        else:
            yield from token_windows(block, size, overlap, tokenizer)


def split_by_excerpts(text: str, sections: Sequence[tuple[str, str]], most: int = 2000) -> list[tuple[str, str]]:
    """(title, chunk) where given excerpts begin. Chunks under 50 characters fall, those over `most` are halved."""
    found = sorted(((title, text.index(start)) for title, start in sections if start and start in text), key=lambda x: x[1])
    out: list[tuple[str, str]] = []
    for (title, a), b in zip(found, [*(at for _, at in found[1:]), len(text)]):
        part = text[a:b].strip()
        if len(part) > most:
            half = len(part) // 2
            out += [(f"{title} (1/2)", part[:half]), (f"{title} (2/2)", part[half:])]
        elif len(part) >= 50:
            out.append((title, part))
    return out or [(WHOLE, text)]
