"""How many buckets each tenant of a stored table has, and how that grows.

Buckets follow linear hashing: with one more, a single bucket is parted in two and all
others stay as they are. The counts are stored with the table, one small file a
version, so they do not depend on what a job that opens the table thinks of them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, SparkSession, functions as F

from tablesync.session import read_last_text, write_text

FOLDER = "_layout"
COPY, CLEAN = "copy", "clean"


def bucket_number(hashed: Column, buckets: int) -> Column:
    """The bucket of a row among ``buckets``: by as many bits of its hash as they need."""
    low = 1 << (buckets.bit_length() - 1)
    fine = F.pmod(hashed, F.lit(2 * low))
    return F.when(fine < buckets, fine).otherwise(F.pmod(hashed, F.lit(low))).cast("int")


def parted_bucket(buckets: int) -> int:
    """The bucket that is parted when one is added to ``buckets``."""
    return buckets - (1 << (buckets.bit_length() - 1))


@dataclass(frozen=True)
class Layout:
    """Bucket counts: of most tenants, and of those that have their own.

    ``moving`` are tenants one of whose buckets is being parted, and how far that
    is: rows are copied (``COPY``), or are where they belong and still where they were
    (``CLEAN``). Of these tenants, a row counts only where it belongs by these counts.
    """

    buckets: int
    own: Mapping[str, int] = field(default_factory=dict)
    moving: Mapping[str, str] = field(default_factory=dict)
    version: int = -1

    def of(self, tenant: str) -> int:
        return self.own.get(tenant, self.buckets)

    def _by_tenant(self, tenant: str, value) -> Column:
        found = value(self.buckets)
        for name, count in self.own.items():
            found = F.when(F.col(tenant) == name, value(count)).otherwise(found)
        return found

    def count(self, tenant: str) -> Column:
        return self._by_tenant(tenant, F.lit)

    def number(self, tenant: str, hashed: Column) -> Column:
        return self._by_tenant(tenant, lambda count: bucket_number(hashed, count))

    def changed(self, tenant: str, buckets: int, step: str | None) -> Layout:
        moving = {name: at for name, at in self.moving.items() if name != tenant} | ({tenant: step} if step else {})
        return replace(self, own={**self.own, tenant: buckets}, moving=moving)

    def store(self, spark: SparkSession, path: str) -> Layout:
        """Write the next version; fails if another job has written it meanwhile."""
        version = self.version + 1
        text = json.dumps({"buckets": self.buckets, "own": dict(self.own), "moving": dict(self.moving)})
        write_text(spark, f"{path}/{FOLDER}/{version:09d}.json", text)
        return replace(self, version=version)


def stored_layout(spark: SparkSession, path: str) -> Layout | None:
    """The newest version of a table's layout."""
    found = read_last_text(spark, f"{path}/{FOLDER}", ".json")
    if found is None:
        return None
    held = json.loads(found[1])
    return Layout(held["buckets"], held["own"], held["moving"], int(found[0].split(".")[0]))
