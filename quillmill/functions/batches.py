"""Arrow batches of texts, a slice at a time.

A batch holds up to 10,000 texts or 64 MB. As Python objects, with what is made of them, these take several times as much,
and each core of an executor has such a batch: so only a slice of it is turned into objects at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

MOST_BYTES, MOST_ROWS = 1 << 20, 1000


def spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(begin, length) of slices that cover all rows, nulls as well; a text of more than MOST_BYTES is a slice of its own."""
    begin = held = 0
    texts = texts.cast(pa.string()) if pa.types.is_null(texts.type) else texts  # a literal NULL has no type
    for k, n in enumerate(pc.binary_length(texts).to_pylist()):
        n = n or 0
        if k > begin and (held + n > MOST_BYTES or k - begin == MOST_ROWS):
            yield begin, k - begin
            begin, held = k, 0
        held += n
    if len(texts) > begin:
        yield begin, len(texts) - begin


def mapped(texts: pa.Array, f: Callable[[str | None], object], kind: pa.DataType) -> pa.Array:
    """f of each text."""
    parts = [pa.array([f(t) for t in texts.slice(*span).to_pylist()], kind) for span in spans(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
