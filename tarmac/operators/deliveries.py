"""Deliveries: the unit in which raw rows arrive and are replaced.

A month may come in several files and a file may hold rows of several months, so neither
replaces the other. Every clean row carries the delivery it came with; a delivery that
arrives again replaces its own earlier rows and nothing else.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIVERY = "delivery"


def delivery_id(name: str | list[str]) -> str:
    """A directory-safe id of a file or path: its last part, and a digest of the whole."""
    whole = name if isinstance(name, str) else "\n".join(sorted(name))
    last = re.sub(r"[^A-Za-z0-9]+", "_", whole.rstrip("/").rsplit("/", 1)[-1]).strip("_")[:40]
    return f"{last}_{hashlib.sha256(whole.rstrip('/').encode()).hexdigest()[:12]}"


def merge(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both, without the stored rows of a delivery that ``incoming`` brings again.

    Deliveries are few and large, so their ids are broadcast: a shuffle by them would send all
    rows of a delivery to one task.
    """
    again = incoming.select(DELIVERY).distinct()
    return stored.join(F.broadcast(again), DELIVERY, "left_anti").select(*stored.columns).unionByName(incoming)


def split_expected(clean_df: DataFrame, months: list[tuple[int, int]] | None) -> tuple[DataFrame, DataFrame]:
    """(rows of the expected months, rows of any other month); all are expected if ``months`` is None."""
    if months is None:
        return clean_df, clean_df.limit(0)
    keys = sorted({int(y) * 100 + int(m) for y, m in months})
    expected: Column = (F.col("year") * 100 + F.col("month")).isin(keys)
    return clean_df.filter(expected), clean_df.filter(~expected)
