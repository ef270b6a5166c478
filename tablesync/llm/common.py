"""What the operators share: reading tables, Arrow maps, scratch tables, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablesync.session import delete_folder, scratch_path

# The six ASCII white-space characters between words (x20 and x09-x0D); bytes.split()
# without arguments splits at exactly these.
BLANKS = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, kept if executors go."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`written` made; what was written from them stays."""
    for table in tables:
        delete_folder(table.sparkSession, table.scratch)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that ``df`` has no column of, in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder."""
    return scratch_path(spark, label)


def map_rows(
    df: DataFrame,
    schema: str,
    rows: Callable[..., Iterator[tuple]],
    batch_rows: int = 4096,
) -> DataFrame:
    """Run ``rows(columns...)``-style generator over Arrow batches.

    ``rows`` gets an iterator of lists of columns (Python lists, in the order of
    ``df.columns``) and yields output rows as tuples in the order of ``schema``.
    Memory is bound by one Arrow batch in and ``batch_rows`` rows out.
    """
    target = pa_schema(df.sparkSession, schema)

    def run(batches):
        def columns():
            for batch in batches:
                if batch.num_rows:
                    yield [c.to_pylist() for c in batch.columns]

        held: list[tuple] = []
        for row in rows(columns()):
            held.append(row)
            if len(held) >= batch_rows:
                yield _batch(held, target)
                held = []
        if held:
            yield _batch(held, target)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def fresh_name(prefix: str) -> str:
    """A name no other attempt of a task uses."""
    return f"{prefix}-{uuid.uuid4().hex}"


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
