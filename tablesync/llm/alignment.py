"""Alignment of the tokens of two tokenizers, and how often ids meet corpus-wide.

Tokenizer A is a byte-level BPE of the tokenizers library, B a BPE model with
byte fallback of the sentencepiece library. Both cover the bytes of a space and
the text. Byte offsets where tokens of both end cut the two id lists into
groups: a dictionary from end to place for each list, the set of keys that both
have, sorted, are the cuts. Within a group, the tokens whose byte ranges overlap
are linked.

Neither tokenizer joins anything across a space between two characters that are
not white space, so a text is taken apart there, and each distinct word of what
a task has read is encoded, cut and linked once (``Aligner``). Models for which
that does not hold are found out when they are loaded, and have whole texts as
words.

How often two ids are linked is counted over all documents:

1. Texts are read in parts of bounded size. Each part gives a row per document
   with the pairs of ids that it links, and a row per distinct pair of the part.
2. An aggregate over the latter counts pairs, and the highest count of each B id.
3. The counts are joined to the pairs of each part, not to the documents; the
   documents of a part meet them in one bounded group.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import pa_schema, written

#: A part ends at so many characters or documents, whichever comes first, and is read in steps.
PART_CHARS, PART_DOCS, STEP_CHARS = 8_000_000, 16_384, 500_000
#: Distinct words and pairs a worker remembers between parts; beyond it all are forgotten and met again.
KEPT_WORDS, KEPT_PAIRS = 300_000, 500_000

FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_PARTS = (
    "part long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "pairs binary, times binary, pair int, a int, b int, total long"
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)
_UNSAFE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def cut_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after the last token of each group in both lists, in order.

    Ends are those of tokens with one byte or more, so they are distinct.
    """
    a_at = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    b_at = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (a_at, b_at))


def link_slices(
    a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the overlapping tokens of all groups, in order.

    A group with one token on a side links it with all of the other's. In any
    other, each stretch from one end to the next is what exactly two tokens share.
    """
    a_size, b_size = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    counts = a_size + b_size - 1  # of links in a group: no ends but the last are common
    group = np.repeat(np.arange(len(counts)), counts)
    step = np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
    a = (a_cuts - a_size)[group] + np.where(b_size[group] == 1, step, 0)
    b = (b_cuts - b_size)[group] + np.where((a_size[group] == 1) & (b_size[group] > 1), step, 0)
    woven = ((a_size > 1) & (b_size > 1))[group]
    if woven.any():
        ends = np.union1d(a_ends, b_ends)
        a[woven] = np.searchsorted(a_ends, ends)[woven]
        b[woven] = np.searchsorted(b_ends, ends)[woven]
    return a, b


def packed(values: np.ndarray) -> bytes:
    """Small whole numbers by planes of bytes, which compress well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: list[bytes]) -> np.ndarray:
    """The numbers of several :func:`packed` lists, one after another."""
    flat = [np.frombuffer(d, np.uint8).reshape(4, -1) for d in data]
    return np.ascontiguousarray(np.concatenate(flat, axis=1).T).view("<u4").ravel() if flat else np.zeros(0, "<u4")


class Aligner:
    """Encodes words by both tokenizers and remembers their groups and links."""
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path_a, encoding="utf-8") as file:
            text = file.read()
        self.one = Tokenizer.from_str(text)
        self.one.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocabulary = self.one.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.two.id_to_piece(i) for i in range(self.two.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.two.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        config = json.loads(text)
        before = config.get("pre_tokenizer") or {}
        self.cuts = (
            config.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and all(t["special"] for t in config.get("added_tokens", []))
            and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # An id as text and what follows it: the next id of the group, the other side, the next group, the next word.
        self.a_shown = np.array([[f"{i}{c}" for c in ",|"] for i in range(len(self.a_bytes))], object)
        self.b_shown = np.array([[f"{i}{c}" for c in ",;\n"] for i in range(len(self.b_bytes))], object)
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[str | None] = []  # None where the tokens are not the word's bytes
        self.pairs: dict[int, int] = {}
        # By step: figures of each word, and the places of the pairs it links.
        self.held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros((0, 4), np.int32), np.zeros(0, np.int32))]

    def split(self, text: str) -> list[str]:
        """The words of a text, each without the space before it."""
        if not self.cuts:
            return [text]
        if text[:1].isspace() or text[-1:].isspace() or _UNSAFE.search(text):
            return [w[1:] for w in _CUT.split(" " + text)]
        return text.split(" ")

    def learn(self, words: list[str]) -> None:
        """Encode, cut and link words that are not known yet."""
        coded = self.one.encode_batch_fast([" " + w for w in words], add_special_tokens=False)
        a_ids, b_ids = [e.ids for e in coded], self.two.encode(words, num_threads=1)
        for i, (word, a, b) in enumerate(zip(words, a_ids, b_ids), len(self.groups)):
            self.places[word] = i
            wanted = b" " + word.encode()
            if any(b"".join(map(t.__getitem__, x)) != wanted for t, x in ((self.a_bytes, a), (self.b_bytes, b))):
                a.clear()
                b.clear()
        a_count, b_count = (np.fromiter(map(len, x), np.int64, len(words)) for x in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        # All words lie one after another; each ends a group.
        a_cuts, b_cuts = cut_groups(a_ends, b_ends)
        x, y = link_slices(a_ends, b_ends, a_cuts, b_cuts)
        a_stops = np.cumsum(a_count)
        n_groups = np.diff(np.searchsorted(a_cuts, a_stops, side="right"), prepend=0)
        n_links = a_count + b_count - n_groups
        self.held.append((np.stack([a_count, b_count, n_groups, n_links], 1).astype(np.int32), self._pairs(a[x] << 32 | b[y])))
        shown = iter(self._shown(a, b, a_cuts, b_cuts, np.cumsum(b_count)))
        self.groups.extend([next(shown) if n else None for n in a_count.tolist()])

    def _pairs(self, codes: np.ndarray) -> np.ndarray:
        """Places of pairs of ids."""
        met, at = np.unique(codes, return_inverse=True)
        pairs = self.pairs
        return np.array([pairs.setdefault(c, len(pairs)) for c in met.tolist()], np.int32)[at]

    def _shown(self, a, b, a_cuts, b_cuts, b_stops) -> list[str]:
        """Groups of each word that has some, as text."""
        group_a, group_b = (np.searchsorted(c, np.arange(len(i)), side="right") for c, i in ((a_cuts, a), (b_cuts, b)))
        out = np.empty(len(a) + len(b), object)
        last = np.zeros(len(a), np.int64)
        last[a_cuts - 1] = 1
        out[np.arange(len(a)) + np.concatenate([[0], b_cuts])[group_a]] = self.a_shown[a, last]
        last = np.zeros(len(b), np.int64)
        last[b_cuts - 1] = 1
        last[b_stops[b_stops > 0] - 1] = 2
        out[np.arange(len(b)) + a_cuts[group_b]] = self.b_shown[b, last]
        return "".join(out.tolist()).split("\n")

    def step(self, texts: list[str], totals: dict[int, int], keep_groups: bool) -> dict[str, list]:
        """Columns of some documents of a part; ``totals`` counts the pairs of the part."""
        split = [self.split(t) if t else [] for t in texts]
        new = list(dict.fromkeys(w for words in split for w in words if w not in self.places))
        for i in range(0, len(new), 4096):
            self.learn(new[i : i + 4096])
        self.held = [tuple(np.concatenate(c) for c in zip(*self.held))]
        figures, links = self.held[0]
        stops = np.cumsum(figures[:, 3], dtype=np.int64)
        out: dict[str, list] = {name: [] for name in ("groups_sha256", "groups")}
        met = []
        for words in split:
            at = [self.places[w] for w in words]
            shown = [self.groups[i] for i in at]
            text = ";".join(shown) if at and None not in shown else ""
            met.append(at if text else [])
            out["groups_sha256"].append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            out["groups"].append(text if keep_groups else None)
        words = np.fromiter(chain.from_iterable(met), np.int64)
        edges = np.concatenate([[0], np.cumsum([len(at) for at in met])])
        running = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(figures[words], axis=0, dtype=np.int64)])
        sums = running[edges[1:]] - running[edges[:-1]]
        out |= {name: sums[:, i] for i, name in enumerate(FIGURES)}
        # The links of all words in order, then each document's distinct pairs.
        counts = figures[words, 3].astype(np.int64)
        at = np.repeat(stops[words] - np.cumsum(counts), counts) + np.arange(counts.sum())
        keys, times = np.unique(np.repeat(np.arange(len(met)), sums[:, 3]) << 32 | links[at], return_counts=True)
        pairs, cuts = keys & 0xFFFFFFFF, np.searchsorted(keys, np.arange(1, len(met)) << 32)
        out["pairs"] = [packed(np.diff(p, prepend=0)) for p in np.split(pairs, cuts)]
        out["times"] = [packed(n) for n in np.split(times, cuts)]
        summed = np.bincount(pairs, times).astype(np.int64) if len(pairs) else pairs
        for place in np.flatnonzero(summed).tolist():
            totals[place] = totals.get(place, 0) + int(summed[place])
        return out

    def part(self, number: int, steps: Iterator[tuple[list, list[str]]], keep_groups: bool) -> Iterator[dict[str, list]]:
        """Columns of one part: rows of its documents, then rows of the pairs they link."""
        if len(self.groups) > KEPT_WORDS or len(self.pairs) > KEPT_PAIRS:
            self.forget()
        totals: dict[int, int] = {}
        for ids, texts in steps:
            yield {"part": [number] * len(ids), "doc_id": ids} | self.step(texts, totals, keep_groups)
        codes = np.fromiter(self.pairs, np.int64, len(self.pairs))[list(totals)]
        if totals:
            ids = {"a": codes >> 32, "b": codes & 0xFFFFFFFF}
            yield {"part": [number] * len(codes), "pair": list(totals), "total": list(totals.values())} | ids


@lru_cache(maxsize=1)
def aligner_for(path_a: str, path_b: str) -> Aligner:
    """The aligner of two models, once a worker."""
    return Aligner(path_a, path_b)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, int]]:
    """Ids, texts and characters of one step at a time."""
    ids, texts, room = [], [], 0
    for batch in batches:
        for key, text in zip(*[c.to_pylist() for c in batch.columns]):
            ids.append(key)
            texts.append(text)
            room += len(text or "")
            if room >= STEP_CHARS or len(ids) >= PART_DOCS:
                yield ids, texts, room
                ids, texts, room = [], [], 0
    if ids:
        yield ids, texts, room


def read_parts(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """Rows of documents (``pair`` is null) and of the pairs they link, by part; see the module."""
    target = pa_schema(docs.sparkSession, _PARTS)

    def run(batches):
        aligner = aligner_for(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        steps = _steps(batches)

        def part(first):
            chars, rows, step = 0, 0, first
            while step is not None:
                yield step[:2]
                chars, rows = chars + step[2], rows + len(step[0])
                if chars >= PART_CHARS or rows >= PART_DOCS:
                    return
                step = next(steps, None)

        for first in steps:
            for columns in aligner.part(number, part(first), keep_groups):
                n = len(columns["part"])
                arrays = [pa.array(columns.get(f.name, [None] * n), f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
            number += 1

    return docs.mapInArrow(run, _PARTS)


def link_counts(parts: DataFrame) -> DataFrame:
    """``a, b, count, best`` of every pair of ids that is linked anywhere.

    ``best`` says that no other A id is linked with the B id more often.
    """
    counts = parts.filter("pair is not null").groupBy("a", "b").agg(F.sum("total").alias("count"))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def _sum_up(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one part with the sums of their pairs."""
    place = pairs["pair"].to_numpy()
    sums = np.zeros((2, int(place.max()) + 1 if len(place) else 0), np.int64)
    for row, name in zip(sums, ("best", "count")):
        row[place] = pairs[name].to_numpy()
    out: tuple[list, list] = ([], [])
    for piece in docs.select(["pairs", "times"]).to_batches(max_chunksize=1024):
        held, times = (c.to_pylist() for c in piece.columns)
        edges = np.concatenate([[0], np.cumsum([len(h) // 4 for h in held])])
        at, n = unpacked(held).astype(np.int64), unpacked(times).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(at)])
        at = before[1:] - np.repeat(before[edges[:-1]], np.diff(edges))
        for row, found in zip(sums, out):
            running = np.concatenate([[0], np.cumsum(row[at] * n)])
            found.append(running[edges[1:]] - running[edges[:-1]])
    best, count = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
    columns = {name: docs[name] for name in ("doc_id", *FIGURES)}
    columns |= {"n_best": pa.array(best), "count_sum": pa.array(count)}
    return pa.table(columns | {name: docs[name] for name in ("groups_sha256", "groups")})


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    keep_groups: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Groups and links of every text's tokens: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, groups``.

    ``groups`` (``a1,a2|b1;a3|b2``, ids in order) is given if ``keep_groups``, and
    null otherwise. ``n_best`` are the links whose count is the highest of their
    B id, ties included; ``count_sum`` adds up the counts of all links. Both
    count over all rows of ``docs``, copies and repeated ids included. A row per
    row of ``docs``; a null id stays null. Texts that are null or empty, or that
    one of the models does not give back byte for byte, have no tokens: zeros,
    an empty digest and no links. Other columns are not read. A text is held
    whole by one task, however long it is; all else is of bounded size.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = written(read_parts(source, path_a, path_b, keep_groups), "alignment-parts")
    counts = written(link_counts(parts), "link-counts")
    pairs = parts.filter("pair is not null").select(F.col("part").alias("of"), "pair", "a", "b").join(counts, ["a", "b"])
    pairs = pairs.select("of", "pair", F.col("best").cast("long").alias("best"), "count")
    rows = parts.filter("pair is null").select("part", "doc_id", *FIGURES, "groups_sha256", "groups", "pairs", "times")
    return rows.groupBy("part").cogroup(pairs.groupBy("of")).applyInArrow(_sum_up, _RESULT)
