"""Joins whose smaller side is broadcast only when its counted size allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Ids up to which one side of a join is sent to every executor: 16 MB of integers.
BROADCAST_IDS = 1_000_000


def with_ids(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id", most: int = BROADCAST_IDS) -> DataFrame:
    """left_semi or left_anti join of docs with a table of distinct ids.

    Up to `most` ids they are broadcast, so that the texts stay where they are; beyond, both sides are shuffled by key.
    """
    small = ids.limit(most + 1).count() <= most
    side = F.broadcast(ids) if small else ids.hint("shuffle_hash")
    return docs.join(side, key, how)
