"""Token ids in Arrow files of equal-length sequences.

Each task writes one Arrow IPC file. Its record batches hold two fixed-size-list
columns: ``ids`` (16 or 32 bits, by the size of the vocabulary) and ``mask``
(true for real ids). The documents' ids follow one another without gaps across
sequences and batches; only the last sequence of a file is filled up. All
batches but the last have the same number of sequences, so sequence ``i`` is
found by division and read from a memory map without a copy. Beside each file
lies an index of its documents.

Documents are ordered by range partitioning, so a file holds a range of ids and
no task sees more than a range.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import fresh_name, map_rows, scratch_folder, written

SEQUENCE = 2048
BATCH = 512
#: Distinct words a worker remembers; beyond it all are forgotten and encoded again when met.
KEPT_WORDS = 1_200_000
JOINED = 512


class WordEncoder:
    """Ids of texts by a tokenizer that never looks across ASCII white space.

    Words between white space are encoded once and remembered. New words are
    given to the tokenizers library many at a time: a word of letters, without
    its final stops and commas, makes exactly one token that ends a word, so a
    row of them can be taken apart again. All other words are encoded singly.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.tokenizer = Tokenizer.from_str(text)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        suffix = json.loads(text)["model"].get("end_of_word_suffix")
        self.dtype = dtype_for(max(vocab.values()))
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in found]

    def _learn_pieces(self, new: list[bytes]) -> None:
        groups = [new[i : i + JOINED] for i in range(0, len(new), JOINED)]
        for group, ids in zip(groups, self._ids([b" ".join(g).decode() for g in groups])):
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group) and (not len(cuts) or cuts[-1] == len(ids)):
                held, cuts = ids.tobytes(), (cuts * ids.itemsize).tolist()
                self.pieces.update(zip(group, [held[a:b] for a, b in zip([0, *cuts], cuts)]))
            else:
                self.pieces.update(zip(group, [x.tobytes() for x in self._ids([p.decode() for p in group])]))

    def learn(self, new: list[bytes]) -> None:
        """Encode words that are not known yet."""
        plain, other = [], []
        for word in new:
            core = word.rstrip(b".,")
            if core.isalpha() or (core and core.decode().isalpha()):
                plain.append((word, core.lower(), word[len(core) :]))
            else:
                other.append(word)
        wanted = {p for _, core, tail in plain for p in (core, tail) if p and p not in self.pieces}
        self._learn_pieces(list(wanted))
        self.pieces[b""] = b""
        pieces = self.pieces
        self.words.update([(word, pieces[core] + pieces[tail]) for word, core, tail in plain])
        for i in range(0, len(other), JOINED):
            part = other[i : i + JOINED]
            self.words.update(zip(part, [x.tobytes() for x in self._ids([w.decode() for w in part])]))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, as bytes of :attr:`dtype`."""
        split = [t.split() for t in texts]
        known, met = self.words, set().union(*split)
        new = [w for w in met if w not in known]
        if len(new) + len(known) > KEPT_WORDS:
            self.words.clear()
            self.pieces.clear()
            new = list(met)
        self.learn(new)
        ids = self.words.__getitem__
        for words in split:
            yield b"".join(map(ids, words))


def dtype_for(largest: int) -> np.dtype:
    """The narrowest type of the file format that holds ``largest``."""
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def encoder_for(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, once a worker."""
    return WordEncoder(path)


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder that the cluster shares."""
    if "://" not in folder and not folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


class TokenWriter:
    """Writes ids into one file of fixed-size lists."""

    def __init__(self, fs, path: str, dtype: np.dtype, sequence: int = SEQUENCE, batch: int = BATCH):
        self.dtype, self.sequence, self.full = dtype, sequence, sequence * batch
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.out = fs.open_output_stream(path)
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.held = bytearray()
        self.written = 0

    def add(self, ids: bytes) -> None:
        """Append the ids of a document."""
        self.held += ids
        size = self.full * self.dtype.itemsize
        while len(self.held) >= size:
            self._put(bytes(self.held[:size]))
            del self.held[:size]

    def _put(self, ids: bytes) -> None:
        values = np.frombuffer(ids, self.dtype)
        n = len(values)
        rows = -(-n // self.sequence)
        mask = np.arange(rows * self.sequence) < n
        values = np.concatenate([values, np.zeros(rows * self.sequence - n, self.dtype)])
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (values, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.written += n

    def close(self) -> None:
        """Write what is left, and the file's footer."""
        if self.held:
            self._put(bytes(self.held))
            self.held.clear()
        self.file.close()
        self.out.close()


class TokenFile:
    """Random access to the sequences of a file; local files are mapped, not copied."""

    def __init__(self, fs, path: str):
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.sequence = self.file.schema.field("ids").type.list_size
        self.batches = self.file.num_record_batches
        self.rows = self.file.get_batch(0).num_rows if self.batches else 0
        self._at, self._ids = -1, np.zeros(0, np.uint16)

    def sequence_at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence ``i``."""
        batch = self.file.get_batch(i // self.rows)
        at = (i % self.rows) * self.sequence
        ids = batch.column("ids").values.slice(at, self.sequence).to_numpy(zero_copy_only=True)
        mask = batch.column("mask").values.slice(at, self.sequence).to_numpy(zero_copy_only=False)
        return ids, mask

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views of ``n`` ids from ``start`` of the file, a view a batch."""
        full = max(1, self.rows * self.sequence)
        while n > 0:
            at, offset = divmod(start, full)
            if at != self._at:
                self._ids = self.file.get_batch(at).column("ids").values.to_numpy(zero_copy_only=True)
                self._at = at
            part = self._ids[offset : offset + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        """Let go of the file."""
        self._ids = np.zeros(0, np.uint16)
        self.source.close()


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_token_files(
    docs: DataFrame, path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode whole texts and write their ids in ascending order of ``doc_id``.

    ``path`` is the tokenizer file; ``end_id`` ends each document. Returns the
    manifest, a row a file: ``part, file, n_docs, n_tokens``, in order of
    ``part``. A file's name is in the manifest only if its task was the one that
    counted; files of lost or repeated attempts stay unlisted.

    A null text counts as empty and gets only the end id. Null ids come first.
    Rows of the same id are kept, in order of their texts. Other columns are not
    read. An empty table gives no files.
    """
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("binary").alias("text"))
    source = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def rows(batches):
        encoder = encoder_for(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        fs, place = open_folder(folder)
        fs.create_dir(place, recursive=True)
        name = fresh_name("ids")
        writer, keys, counts = None, [], []
        for ids, texts in batches:
            writer = writer or TokenWriter(fs, f"{place}/{name}.arrow", encoder.dtype)
            for i in range(0, len(texts), 1024):
                for key, found in zip(ids[i : i + 1024], encoder.encode([t or b"" for t in texts[i : i + 1024]])):
                    writer.add(found + end)
                    keys.append(key)
                    counts.append(len(found) // encoder.dtype.itemsize + 1)
        if writer is None:
            return
        writer.close()
        counts = np.array(counts, np.int64)
        index = pa.record_batch([pa.array(keys, pa.int64()), np.cumsum(counts) - counts, counts], schema=INDEX)
        with fs.open_output_stream(f"{place}/{name}.docs") as out, pa.ipc.new_file(out, INDEX) as file:
            file.write_batch(index)
        yield TaskContext.get().partitionId(), name, len(keys), int(counts.sum())

    return written(map_rows(source, "part int, file string, n_docs long, n_tokens long", rows), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32, file``.

    ``start`` counts the ids of all documents before it, in all files;
    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    files = files.select("file", "base").repartition(max(1, manifest.count()), "file")

    def rows(batches):
        fs, place = open_folder(folder)
        for names, bases in batches:
            for name, base in zip(names, bases):
                with fs.open_input_file(f"{place}/{name}.docs") as source:
                    index = pa.ipc.open_file(source).read_all()
                tokens = TokenFile(fs, f"{place}/{name}.arrow")
                for key, start, n in zip(*(c.to_pylist() for c in index.columns)):
                    crc = 0
                    for part in tokens.pieces(start, n):
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    yield key, base + start, n, crc, name
                tokens.close()

    return map_rows(files, "doc_id long, start long, n_tokens long, ids_crc32 long, file string", rows)


def token_files(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the files, then describe each document by what is read back from them."""
    folder = folder or scratch_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, path, end_id, folder), folder)
