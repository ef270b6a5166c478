"""Removal of passages that stand in an earlier document, by repeated-phrase automata.

1. Each text is read once for a fingerprint: of every 35 neighbouring phrases of
   16 words, the one with the least hash. Any two occurrences of a window of 50
   words share such a phrase. Exact copies are told by their digest and settled
   there: only the first of them goes on.
2. Phrases found in two documents or more are confirmed by an aggregate that
   keeps the least and the greatest document of a phrase.
3. Documents with confirmed phrases are streamed in blocks. Each block is a
   shard: its confirmed phrases become one Aho-Corasick automaton, and all of
   its documents are run through it for every occurrence. Windows without an
   occurrence cannot recur and go no further.
4. Windows around occurrences are reduced to two 64-bit hashes and the first
   document of each window is found by an aggregate; those of later documents
   are removed.

Frequent phrases and windows are reduced in part before each shuffle and met
again by joins that adaptive execution can split, so no passage is gathered in
one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_rows, written
from tablesync.llm.words import CHUNK_BYTES, run_hashes, winnowed, word_hashes

WINDOW = 50
PHRASE = 16
BLOCK_CHARS = 8_000_000
BLOCK_PHRASES = 20_000
EMPTY = hashlib.sha256(b"").hexdigest()


def byte_chunks(batches: Iterator[list], size: int = CHUNK_BYTES) -> Iterator[list[list]]:
    """Rows (columns as lists, the last one the text) of about ``size`` bytes at a time."""
    held: list[list] | None = None
    room = 0
    for columns in batches:
        for row in zip(*columns):
            if held is None:
                held, room = [[] for _ in row], 0
            for column, value in zip(held, row):
                column.append(value)
            room += len(row[-1] or b"")
            if room >= size:
                yield held
                held = None
    if held:
        yield held


def fingerprints(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """``own, doc_id, n_words, kept_sha256 (of all words), phrases (selected hashes)`` of each text."""

    def rows(batches):
        for owns, ids, texts in byte_chunks(batches):
            texts = [t or b"" for t in texts]
            for own, key, text, words in zip(owns, ids, texts, word_hashes(texts)):
                digest = hashlib.sha256(b" ".join(text.split())).hexdigest()
                phrases = np.zeros(0, np.uint64)
                if len(words) >= window:
                    found = run_hashes(words, phrase)
                    phrases = np.unique(found[winnowed(found, window - phrase + 1)])
                yield own, key, len(words), digest, phrases.view(np.int64)

    return map_rows(docs, "own long, doc_id long, n_words long, kept_sha256 string, phrases array<long>", rows, 512)


class Block:
    """A shard of documents with the automaton of their confirmed phrases."""

    def __init__(self, window: int, phrase: int):
        import ahocorasick

        self.window, self.phrase = window, phrase
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        self.rows: list[tuple] = []
        self.texts: list[str] = []
        self.chars = 0

    @property
    def full(self) -> bool:
        """Whether the next document should open another block."""
        return self.chars >= BLOCK_CHARS or len(self.automaton) >= BLOCK_PHRASES

    def add(self, key: tuple, text: bytes, words: np.ndarray, confirmed: np.ndarray) -> None:
        """Take a document, and its confirmed phrases (hashes) as words."""
        parts = text.split()
        found = run_hashes(words, self.phrase)
        known, at = np.unique(found, return_index=True)
        for i in at[np.isin(known, confirmed)].tolist():
            self.automaton.add_word(" " + b" ".join(parts[i : i + self.phrase]).decode() + " ")
        self.rows.append((*key, words))
        self.texts.append(" " + b" ".join(parts).decode() + " ")
        self.chars += len(self.texts[-1])

    def occurrences(self) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
        """Each document's key, word hashes, and the places (in words) where phrases begin."""
        self.automaton.make_automaton()
        for (*key, words), text in zip(self.rows, self.texts):
            hits = np.array([end - size + 1 for end, size in self.automaton.iter(text)], np.int64) if len(self.automaton) else np.zeros(0, np.int64)
            spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
            yield tuple(key), words, np.unique(np.searchsorted(spaces, hits))


def near(places: np.ndarray, n_words: int, window: int, phrase: int) -> np.ndarray:
    """Starts of the windows that hold a phrase which begins at one of ``places``."""
    last = n_words - window
    if last < 0 or not len(places):
        return np.zeros(0, np.int64)
    marks = np.zeros(last + 2, np.int64)
    np.add.at(marks, np.clip(places + phrase - window, 0, last + 1), 1)
    np.add.at(marks, np.clip(places + 1, 0, last + 1), -1)
    return np.flatnonzero(np.cumsum(marks)[: last + 1] > 0)


def covered(starts: list[int], n_words: int, window: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    marks = np.zeros(n_words + 1, np.int64)
    at = np.array(starts, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, np.minimum(at + window, n_words), -1)
    return np.cumsum(marks)[:n_words] > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of each whole text that stand in a window which a smaller ``doc_id`` has too.

    Columns: ``doc_id, n_words, n_removed, kept_sha256``, a row per row of
    ``docs``. Words are parted by ASCII white space and compared as they are. A
    null text has no words. Rows of the same id don't count as earlier for each
    other; a null id is never earlier than another and nothing is earlier than
    it. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    source = source.select(F.xxhash64("doc_id", "text").alias("own"), "doc_id", "text")
    prints = written(fingerprints(source, window, phrase), "fingerprints")
    able = prints.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    firsts = able.groupBy(F.col("kept_sha256").alias("sha")).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("final")
    )
    copies = able.join(firsts.filter("first < final"), F.col("kept_sha256") == F.col("sha"))
    copies = written(copies.filter("doc_id > first").select("own").distinct(), "copies")
    mine = able.join(copies, "own", "left_anti").select("own", "doc_id", F.explode("phrases").alias("phrase"))
    mine = written(mine, "phrases")
    confirmed = (
        mine.groupBy("phrase")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most")
        .select(F.col("phrase").alias("confirmed"))
    )
    found = mine.join(confirmed, F.col("phrase") == F.col("confirmed")).groupBy("own")
    found = found.agg(F.collect_set("phrase").alias("phrases"))
    streamed = source.join(found.withColumnRenamed("own", "its"), F.col("own") == F.col("its"))

    def windows(batches):
        def found(block):
            for (own, key), words, places in block.occurrences():
                at = near(places, len(words), window, phrase)
                if not len(at):
                    continue
                one = run_hashes(words, window, 1)[at].view(np.int64).tolist()
                two = run_hashes(words, window, 2)[at].view(np.int64).tolist()
                yield from zip(one, two, [key] * len(one), [own] * len(one), at.tolist())

        block = None
        for owns, ids, phrases, texts in byte_chunks(batches):
            for own, key, some, text, words in zip(owns, ids, phrases, texts, word_hashes(texts)):
                block = block or Block(window, phrase)
                block.add((own, key), text, words, np.array(some, np.int64).view(np.uint64))
                if block.full:
                    yield from found(block)
                    block = None
        if block:
            yield from found(block)

    streamed = streamed.select("own", "doc_id", "phrases", "text")
    spots = map_rows(streamed, "one long, two long, doc_id long, its long, at int", windows, 65_536)
    spots = written(spots, "windows")
    earliest = (
        spots.groupBy("one", "two")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most")
        .select(F.col("one").alias("e_one"), F.col("two").alias("e_two"), "least")
    )
    later = (
        spots.join(earliest, (F.col("one") == F.col("e_one")) & (F.col("two") == F.col("e_two")))
        .filter(F.col("doc_id") > F.col("least"))
        .groupBy("its")
        .agg(F.collect_set("at").alias("starts"))
    )
    changed = source.join(later, F.col("own") == F.col("its")).select("own", "starts", "text")

    def kept(batches):
        for owns, starts, texts in batches:
            for own, some, text in zip(owns, starts, texts):
                parts = text.split()
                gone = covered(some, len(parts), window)
                left = b" ".join([p for p, g in zip(parts, gone.tolist()) if not g])
                yield own, int(gone.sum()), hashlib.sha256(left).hexdigest()

    cut = map_rows(changed, "own long, removed long, left_sha256 string", kept).dropDuplicates(["own"])
    marked = prints.drop("phrases").join(copies.withColumn("copy", F.lit(True)), "own", "left").join(cut, "own", "left")
    return marked.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY)).otherwise(F.coalesce("left_sha256", "kept_sha256")).alias("kept_sha256"),
    )
