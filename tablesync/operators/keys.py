"""Keeping or dropping the rows whose key is in a list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.config import BROADCAST_BYTES
from tablesync.session import reliable


def row_bytes(df: DataFrame) -> Column:
    """Roughly the memory a row of ``df`` takes."""
    width = F.lit(16)
    for name in df.columns:
        width = width + 8 + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    return width.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Roughly the memory the rows of ``df`` take, counted on the executors."""
    return df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0


@dataclass(frozen=True)
class KeyList:
    """Distinct keys, written once and measured, to filter other frames with.

    The filtered frame may hold most of its rows under one key. A list that
    measures below the limit is broadcast, so the frame is not shuffled. With a
    longer one both sides are shuffled; since the list is distinct already and
    its side is a plain shuffle, adaptive execution can split the partition of
    a hot key of the frame and repeat the few listed keys that belong to it.
    """

    keys: DataFrame
    on: tuple[str, ...]
    small: bool

    @classmethod
    def of(
        cls, keys: DataFrame, on: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
    ) -> KeyList:
        listed = reliable(keys.select(*on).distinct())
        return cls(listed, tuple(on), measured_bytes(listed) <= broadcast_bytes)

    def keep(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is listed."""
        return self._join(df, "left_semi")

    def drop(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is not listed; a null key never is."""
        return self._join(df, "left_anti")

    def _join(self, df: DataFrame, how: str) -> DataFrame:
        keys = F.broadcast(self.keys) if self.small else self.keys
        return df.join(keys, list(self.on), how)
