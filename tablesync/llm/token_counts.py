"""Token counts that follow edits.

A document's pre-tokens lie in leaves of a segment tree whose nodes hold the
characters and tokens below them. An edit re-splits the text from shortly
before it until the new boundaries meet the old ones, counts only the
pre-tokens in between, and updates the sums above the touched leaves.

Pre-tokens are matches of a pattern without look-behind, so splitting from a
boundary on depends only on the text after it; a match looks at most
``AHEAD`` characters past its end.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.bpe import splitter
from tablesync.llm.common import map_rows

LEAF = 64
#: Characters past a match that can bear on where it ends ("'ll" looks at two).
AHEAD = 3
KEPT_PIECES = 1_000_000
Edit = tuple[int, int, str]


class PieceCounter:
    """Tokens of pre-tokens, remembered."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = splitter(pattern)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece."""
        try:
            return list(map(self.known.__getitem__, pieces))
        except KeyError:
            if len(self.known) > KEPT_PIECES:
                self.known.clear()
            for piece in pieces:
                if piece not in self.known:
                    self.known[piece] = len(self.encoding.encode_ordinary(piece))
            return list(map(self.known.__getitem__, pieces))


@lru_cache(maxsize=2)
def counter_for(path: str, pattern: str) -> PieceCounter:
    """The counter of a rank file, once a worker."""
    return PieceCounter(path, pattern)


class TokenTree:
    """A text with its token count, kept right under edits."""

    def __init__(self, text: str, counter: PieceCounter):
        self.counter = counter
        pieces = counter.split(text)
        counts = counter.counts(pieces)
        self.leaves = [(pieces[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(pieces), LEAF)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (some, numbers) in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(map(len, some)), sum(numbers)
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        """Tokens of the whole text."""
        return self.tokens[1]

    def text(self) -> str:
        """The text as it is now."""
        return "".join(p for pieces, _ in self.leaves for p in pieces)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place`` (the last one at the end), and where it begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if place >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.size, begin

    def _put(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf] = (pieces, counts)
        node = self.size + leaf
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), sum(counts)
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of characters ``start`` to ``end``; pre-tokens counted anew."""
        first, begin = self._leaf_at(max(0, start - AHEAD))
        pieces, counts = self.leaves[first]
        keep = 0
        while keep < len(pieces) and begin + len(pieces[keep]) + AHEAD <= start:
            begin += len(pieces[keep])
            keep += 1
        last = first
        old = pieces[keep:]
        while begin + sum(map(len, old)) < end and last + 1 < len(self.leaves):
            last += 1
            old = old + self.leaves[last][0]
        while True:
            held = "".join(old)
            changed = held[: start - begin] + new + held[end - begin :]
            shift = len(changed) - len(held)
            whole = last + 1 == len(self.leaves)
            found = self.counter.split(changed)
            marks, place = {}, begin
            for i, piece in enumerate(old):
                if place >= end:
                    marks[place + shift] = i
                place += len(piece)
            done, place = None, begin
            limit = begin + len(changed) - (0 if whole else AHEAD)
            for i, piece in enumerate(found):
                if place in marks and place >= start + len(new):
                    done = (i, marks[place])
                    break
                place += len(piece)
                if place > limit:
                    break
            else:
                if whole:
                    done = (len(found), len(old))
            if done or whole:
                break
            last += 1
            old = old + self.leaves[last][0]
        i, j = done or (len(found), len(old))
        fresh = self.counter.counts(found[:i])
        rest = old[j:]
        old_counts = counts[keep:] + [c for leaf in range(first + 1, last + 1) for c in self.leaves[leaf][1]]
        if last == first:
            self._put(first, pieces[:keep] + found[:i] + rest, counts[:keep] + fresh + old_counts[j:])
            return i
        for leaf in range(first + 1, last):
            self._put(leaf, [], [])
        self._put(first, pieces[:keep] + found[:i], counts[:keep] + fresh)
        self._put(last, rest, old_counts[j:])
        return i


#: The edits of the registered query: long runs of digits become one mark.
NUMBERS = re.compile(r"[0-9]{4,}")


def mask_numbers(text: str) -> list[Edit]:
    """Edits that put ``<number>`` in place of every run of four digits or more."""
    return [(*m.span(), "<number>") for m in NUMBERS.finditer(text)]


def count_edited(
    docs: DataFrame,
    path: str,
    pattern: str,
    edits: Callable[[str], list[Edit]] = mask_numbers,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token counts of every whole text before and after its edits.

    ``edits`` gives non-overlapping spans of the original text and what replaces
    them, in order. Columns: ``doc_id, n_edits, n_before, n_tokens, n_recounted,
    n_pieces, text_sha256`` (of the edited text); ``n_recounted`` are pre-tokens
    counted again for edits. One row out per row in; a null text counts as empty;
    null ids stay null; other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def rows(batches) -> Iterator[tuple]:
        counter = counter_for(path, pattern)
        for ids, texts in batches:
            for key, text in zip(ids, texts):
                tree = TokenTree(text or "", counter)
                before, again, wanted = tree.n_tokens, 0, edits(text or "")
                for start, end, new in reversed(wanted):  # from the end, so earlier places stay
                    again += tree.edit(start, end, new)
                pieces = sum(len(p) for p, _ in tree.leaves)
                digest = hashlib.sha256(tree.text().encode()).hexdigest()
                yield key, len(wanted), before, tree.n_tokens, again, pieces, digest

    return map_rows(
        source,
        "doc_id long, n_edits long, n_before long, n_tokens long, n_recounted long, n_pieces long, text_sha256 string",
        rows,
    )
