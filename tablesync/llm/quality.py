"""Quality rules: figures of each text, and lines that too many documents of a host share.

Lines are normalised, hashed, and counted over all documents of a host; a
document counts once, and copies of a document count as one (told by a digest
of all its normalised lines). A line above the limit is removed from all
documents but the one with the smallest id that holds it (where none has an id,
the one with the smallest digest). Documents that are left with too little are
rejected.

Each text is read once, into a table of figures and line hashes in the shared
folder. Counting is an aggregate taken in part before each shuffle, so a line
of every document costs a row a task.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import BLANKS, map_rows, mix64, unused, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Documents of a host that may share a line.
MAX_DOCUMENTS = 50
#: Words, and percent of the words, that have to be left.
LEAST_WORDS = 20
LEAST_LEFT = 30
_DIGITS = re.compile(rb"[0-9]+")


def line_hash(words: list[bytes]) -> int:
    """Hash of a line: case and digits of ASCII don't count, nor does the white space."""
    normal = _DIGITS.sub(b"0", b" ".join(words).lower())
    return int.from_bytes(hashlib.blake2b(normal, digest_size=8).digest(), "little", signed=True)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight words that are found twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.uint64, len(words))
    if len(numbers) == len(words):
        return 0
    keys = mix64(ids)
    keys = keys[:-1] * np.uint64(0x9E3779B97F4A7C15) + keys[1:]
    keys = mix64(keys)[:-2] * np.uint64(0x9E3779B97F4A7C15) + mix64(keys)[2:]
    keys = mix64(keys)[:-4] * np.uint64(0x9E3779B97F4A7C15) + mix64(keys)[4:]
    ranked = np.sort(keys)
    if not (ranked[1:] == ranked[:-1]).any():
        return 0
    # Equal hashes are only taken for equal windows after the words have been compared.
    windows = np.lib.stride_tricks.sliding_window_view(ids.astype(np.int64), WINDOW)
    same = np.isin(keys, ranked[1:][ranked[1:] == ranked[:-1]])
    at = np.flatnonzero(same)
    _, group, count = np.unique(windows[at], axis=0, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, np.int64)
    begin = at[count[group.ravel()] > 1]
    np.add.at(covered, begin, 1)
    np.add.at(covered, begin + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def figures(text: str) -> tuple:
    """Counts of a text, digest of all its normalised lines in order, and its lines: hash, words."""
    octets = text.encode()
    words = octets.split()
    blanks = sum(octets.count(b) for b in BLANKS)
    symbols = sum(octets.count(s.encode()) for s in SYMBOLS)
    seen: set[bytes] = set()
    duplicates = 0
    lines: dict[int, int] = {}
    whole = hashlib.blake2b(digest_size=8)
    for line in octets.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            duplicates += 1
        else:
            seen.add(line)
        key = line_hash(parts)
        lines[key] = lines.get(key, 0) + len(parts)
        whole.update(key.to_bytes(8, "little", signed=True))
    digest = int.from_bytes(whole.digest(), "little", signed=True)
    return len(words), len(text) - blanks, symbols, duplicates, repeated_words(words), digest, list(lines), list(lines.values())


_COLUMNS = (
    "doc_id long, host string, content binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, digest long, hashes array<long>, words array<int>"
)


def _content(text: Column) -> Column:
    """Digest of an untouched text; null for null."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _verdicts(docs: DataFrame, max_documents: int, id_col: str, host_col: str, text_col: str) -> DataFrame:
    """What ``judge`` gives, with ``host`` and ``content``: these and ``doc_id`` decide all but ``row``."""
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        _content(F.col(text_col)).alias("content"),
        F.col(text_col).alias("text"),
    )

    def rows(batches):
        for ids, hosts, contents, texts in batches:
            for key, host, content, text in zip(ids, hosts, contents, texts):
                yield key, host, content, *figures(text or "")

    found = map_rows(source, _COLUMNS, rows).withColumn("row", F.monotonically_increasing_id())
    found = written(found, "line-figures")
    # Rows of an id hold a line together; rows without an id are documents of their own, after all others.
    holder = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("digest")).alias("digest"))
    lines = found.select("row", "host", "digest", holder.alias("holder"), F.explode(F.arrays_zip("hashes", "words")).alias("line"))
    lines = lines.select("row", "host", "digest", "holder", F.col("line.hashes").alias("hash"), F.col("line.words").alias("words"))
    counted = (
        lines.groupBy("host", "hash", "digest")
        .agg(F.min("holder").alias("first"))
        .groupBy("host", "hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
        .filter(F.col("n") > max_documents)
    )
    heavy = counted.select(F.col("host").alias("h_host"), F.col("hash").alias("h_hash"), "first")
    above = lines.join(heavy, F.col("host").eqNullSafe(F.col("h_host")) & (F.col("hash") == F.col("h_hash")))
    removed = (
        above.filter(~F.col("holder").eqNullSafe(F.col("first")))
        .groupBy("row")
        .agg(F.sum("words").alias("n_removed_words"), F.collect_list("hash").alias("removed"))
    )
    judged = found.drop("digest", "hashes", "words").join(removed, "row", "left")
    gone = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    left = F.col("n_words") - gone
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = (left < LEAST_WORDS) | (100 * left < LEAST_LEFT * F.col("n_words"))
    return judged.select(
        "row",
        "doc_id",
        "host",
        "content",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        gone.alias("n_removed_words"),
        F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
        (~failed & ~depleted).alias("kept"),
    )


def judge(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: figures, base verdict, removed lines and verdict.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_removed_words, removed (array of line hashes),
    kept``. A null text counts as empty and fails; a null host is a host of its
    own; rows of the same id are judged one by one, but hold a line together, as
    copies without an id do. Other columns are not read.
    """
    return _verdicts(docs, max_documents, id_col, host_col, text_col).drop("host", "content")


def without_lines(text: str, removed: set[int]) -> str:
    """``text`` without the lines that have these hashes."""
    return "\n".join(x for x in text.split("\n") if not (parts := x.encode().split()) or line_hash(parts) not in removed)


def keep_good(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, host_col: str = "source", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The documents that the rules keep, without the lines above the limit; all columns stay.

    Each row goes by its own verdict, also where ids are repeated or null: verdicts
    are found again by id, host and digest of the text, which decide them. Null
    and empty texts go; columns of any other name stay as they are.
    """
    judged, host, digest, gone = unused(docs, "judged", "host", "content", "removed")
    verdicts = (
        _verdicts(docs, max_documents, "doc_id", host_col, text_col)
        .filter("kept")
        .groupBy(F.col("doc_id").alias(judged), F.col("host").alias(host), F.col("content").alias(digest))
        .agg(F.first("removed").alias(gone))
    )
    own = (
        F.col("doc_id").cast("long").eqNullSafe(F.col(judged))
        & F.col(host_col).cast("string").eqNullSafe(F.col(host))
        & _content(F.col(text_col)).eqNullSafe(F.col(digest))
    )
    kept = docs.join(verdicts, own).drop(judged, host, digest)
    whole = docs.schema

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(gone)).to_pylist()
            batch = batch.select([f.name for f in whole])
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            texts = [without_lines(t, set(lost)) if lost else t for t, lost in zip(texts, lists)]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if length_col is not None:
                at = batch.schema.get_field_index(length_col)
                sizes = [None if t is None else len(t) for t in texts]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes, batch.schema.field(at).type))
            yield batch

    return kept.mapInArrow(run, whole)
