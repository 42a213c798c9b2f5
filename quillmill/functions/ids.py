"""Names that a store accepts: ASCII without accents. Spark has no Unicode decomposition, so this is an Arrow function."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, functions as F

from quillmill.functions.batches import mapped


def _ascii(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def slug(text: str) -> str:
    """Letters, digits, dots, hyphens and underscores; other runs become one underscore, none at either end."""
    return re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9_.-]", "_", _ascii(text))).strip("_")


def label_id(text: str) -> str:
    """The id of a label: lower case letters, digits and underscores."""
    return re.sub(r"[^a-z0-9_]", "_", _ascii(text.lower())).strip("_")


def _over(f):
    return F.arrow_udf(lambda texts: mapped(texts, lambda t: None if t is None else f(t), pa.string()), "string")


def ascii_slug(text: Column) -> Column:
    return _over(slug)(text)


def ascii_label(text: Column) -> Column:
    return _over(label_id)(text)
