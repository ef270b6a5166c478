"""Byte-level BPE by replaying the merges over a whole chunk of the corpus.

The distinct pieces (pre-tokens) of a chunk lie in one array of symbols. An
inverted index has, for each token that a pair of neighbours makes, the
positions of those pairs. Merges are taken in rank order; each is applied at
all its positions at once, and only the pairs that touch a merged symbol are
looked up anew. Documents are then rows of piece numbers, and their ids are
gathered from the encoded pieces.

A chunk is what one task has read (in parts of ``CHUNK_CHARS`` characters), so
no text is shuffled and a frequent piece costs one replay a task.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from tablesync.llm.common import map_rows

CHUNK_CHARS = 24_000_000
#: Known pieces a worker keeps; beyond it all are forgotten and encoded again when met.
KEPT_PIECES = 700_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a rank file (base64 and number a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class MergeReplay:
    """Encodes many pieces together by replaying merges in rank order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        codes, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    codes.append(left << 32 | right)
                    made.append(rank)
        order = np.argsort(np.array(codes, np.int64), kind="stable")
        self.codes = np.array(codes, np.int64)[order]
        self.made = np.array(made, np.int32)[order]
        left, right = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.first = self._made(left, right)

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes; -1 where it makes none."""
        if not len(self.codes):
            return np.full(len(left), -1, np.int32)
        code = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.made[at], np.int32(-1))

    def _alone(self, piece: bytes) -> list[int]:
        """One piece by the plain rule: the lowest rank first, the leftmost of equals."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row, and where each piece's ids begin (one more at the end)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        n = int(starts[-1])
        octets = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.byte_ids[octets]
        following = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        if n:
            full = lengths > 0
            following[starts[1:][full] - 1] = -1
            before[starts[:-1][full]] = -1
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(at: np.ndarray, made: np.ndarray) -> None:
            """Put positions into the index under the tokens that they make."""
            keep = made >= 0
            at, made = at[keep], made[keep]
            if not len(at):
                return
            order = np.argsort(made, kind="stable")
            at, made = at[order], made[order]
            cuts = np.flatnonzero(made[1:] != made[:-1]) + 1
            for token, part in zip(made[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if token in index:
                    index[token].append(part)
                else:
                    index[token] = [part]
                    heapq.heappush(queue, token)

        at = np.flatnonzero(following >= 0).astype(np.int32)
        note(at, self.first[octets[at].astype(np.int32) << 8 | octets[at + 1]])
        odd = np.zeros(len(pieces), bool)
        while queue:
            token = heapq.heappop(queue)
            found = index.pop(token)
            at = np.sort(np.concatenate(found))  # no position is noted twice for one token
            right = following[at]
            live = (symbols[at] >= 0) & (right >= 0)
            at, right = at[live], right[live]
            live = self._made(symbols[at], symbols[right]) == token
            at, right = at[live], right[live]
            if not len(at):
                continue
            if len(at) > 1 and (right[:-1] == at[1:]).any():
                # Of overlapping pairs in a row, the first, third, ... are merged.
                joined = np.concatenate([[False], right[:-1] == at[1:]])
                run = np.flatnonzero(~joined)
                offset = np.arange(len(at)) - run[np.cumsum(~joined) - 1]
                at, right = at[offset % 2 == 0], right[offset % 2 == 0]
            after = following[right]
            symbols[at] = token
            symbols[right] = -1
            following[at] = after
            before[after[after >= 0]] = at[after >= 0]
            left = before[at]
            # Where the left neighbour is a merged one too, its own right side is that pair.
            left = left[(left >= 0) & (symbols[left] != token)]
            spots = np.concatenate([left, at[after >= 0]])
            if not len(spots):
                continue
            made = self._made(symbols[spots], symbols[following[spots]])
            early = (made >= 0) & (made < token)
            if early.any():
                # A merge made a pair of lower rank: such pieces need a strict order.
                odd[owner[spots[early]]] = True
            note(spots, made)
        whole = {i: self.ranks[p] for i, p in enumerate(pieces) if p in self.ranks} if self.ranks else {}
        live = symbols >= 0
        counts = np.bincount(owner[live], minlength=len(pieces))
        ids = symbols[live]
        special = {i: [r] for i, r in whole.items() if counts[i] != 1}
        special |= {int(i): self._alone(pieces[i]) for i in np.flatnonzero(odd) if int(i) not in whole}
        begins = np.concatenate([[0], np.cumsum(counts)])
        if special:
            parts, done = [], 0
            for i in sorted(special):
                parts += [ids[begins[done] : begins[i]], np.array(special[i], np.int64)]
                counts[i] = len(special[i])
                done = i + 1
            parts.append(ids[begins[done] :])
            ids = np.concatenate(parts)
            begins = np.concatenate([[0], np.cumsum(counts)])
        return ids, begins


@lru_cache(maxsize=2)
def splitter(pattern: str):
    """A function that gives the pieces of a text, as ``regex`` splits it by ``pattern``.

    The standard library's ``re`` is faster. Its classes of letters, digits and
    blanks differ for a few characters; those are looked up here, and only texts
    that hold one of them go to ``regex``.
    """
    exact = regex.compile(pattern).findall
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\w\s]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    if r"\p" in plain:
        return exact
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    odd: set[str] = set()
    for theirs, ours in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s")):
        odd |= set(regex.findall(theirs, every)) ^ set(re.findall(ours, every))
    # Characters beyond the basic plane are not looked at one by one.
    fast, holds_odd = re.compile(plain).findall, re.compile(f"[{''.join(map(re.escape, sorted(odd)))}\U00010000-\U0010ffff]").search
    return lambda text: exact(text) if holds_odd(text) else fast(text)


@lru_cache(maxsize=2)
def replay_for(path: str) -> MergeReplay:
    """The replay of a rank file, once a worker."""
    return MergeReplay(load_ranks(path))


class _Numbers(dict):
    """Numbers pieces in the order in which they are met."""

    def __missing__(self, piece):
        self[piece] = number = len(self)
        return number


class CorpusEncoder:
    """Encodes texts in chunks; ids of known pieces are kept between chunks."""

    def __init__(self, path: str, pattern: str):
        self.replay = replay_for(path)
        self.split = splitter(pattern)
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.zeros(0, np.int32)
        self.begins = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > KEPT_PIECES:
            self._forget()
        known = len(self.numbers)
        number = self.numbers.__getitem__
        rows = [np.fromiter(map(number, self.split(t)), np.int32) for t in texts]
        if len(self.numbers) > known:
            new = [p.encode() for p in list(self.numbers)[known:]]
            ids, begins = self.replay.encode(new)
            self.begins = np.concatenate([self.begins, begins[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        for row in rows:
            begin = self.begins[row]
            count = self.begins[row + 1] - begin
            total = np.cumsum(count)
            if not len(total):
                yield np.zeros(0, np.int32)
                continue
            yield self.ids[np.repeat(begin - (total - count), count) + np.arange(total[-1])]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text, and the digests of ids and of the decoded bytes.

    Columns: ``doc_id, n_tokens, ids (array<int>), ids_sha256, decoded_sha256``.
    One row out per row in, so repeated rows stay; a null text counts as empty
    and has no ids; a null ``doc_id`` stays null; other columns are not read.
    """
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def rows(batches):
        encoder = CorpusEncoder(path, pattern)
        tokens = encoder.replay.tokens
        known = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        names = list(map(str, range(len(known))))
        for doc_ids, texts in chunks(batches):
            for doc_id, ids in zip(doc_ids, encoder.encode(texts)):
                listed = ids.tolist()
                digits = ",".join([names[i] for i in listed]).encode()
                back = b"".join([known[i] for i in listed])
                yield doc_id, len(listed), ids, hashlib.sha256(digits).hexdigest(), hashlib.sha256(back).hexdigest()

    return map_rows(
        source, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string", rows, 512
    )


def chunks(batches: Iterator[list], size: int = CHUNK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about ``size`` characters at a time; null texts become empty."""
    keys: list = []
    texts: list[str] = []
    held = 0
    for ids, some in batches:
        for key, text in zip(ids, some):
            keys.append(key)
            texts.append(text or "")
            held += len(texts[-1])
            if held >= size:
                yield keys, texts
                keys, texts, held = [], [], 0
    if keys:
        yield keys, texts
