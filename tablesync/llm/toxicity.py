"""Toxicity by a bidirectional gated recurrent network with attention, in numpy.

A word's input is the sum of a hashed word vector and the mean of its hashed
character trigrams' vectors. Both directions read windows of 32 words that
overlap by half; attention weighs the states, and the document's score is that
of its worst window, so whole texts are scored however long they are.

The network learns from a bounded sample of labelled documents: in each round
the windows that score highest stand for their document. Scoring is a map over
the documents; what it needs of a text's words is worked out once for the
distinct words of a batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_rows, mix64
from tablesync.llm.substrings import byte_chunks

LENGTH, STRIDE = 32, 16
STATES, WIDTH = 8, 12
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 13
#: Labelled documents of each class that are learned from, at most.
SAMPLE = 800
#: Windows of a document that take part in learning.
TOP = 3
THRESHOLD = 0.7
BATCH = 4096
_PLAIN = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words of a text; ASCII signs part them."""
    return text.lower().translate(_PLAIN).split()


class Words:
    """Numbers distinct words, and knows the hashed rows of each."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}

    def row(self, words: list[bytes]) -> np.ndarray:
        """The numbers of words."""
        known = self.numbers
        return np.fromiter([known.setdefault(w, len(known)) for w in words], np.int32, len(words))

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of each word, rows of all trigrams, and where each word's trigrams begin."""
        marked = [b"\x01" + w + b"\x02" for w in self.numbers]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        octets = np.frombuffer(b"".join(marked) + b"\0\0", np.uint8).astype(np.uint64)
        triples = mix64(octets[:-2] | octets[1:-1] << np.uint64(8) | octets[2:] << np.uint64(16))
        begins = np.cumsum(sizes) - sizes
        inside = np.ones(len(triples), bool)
        ends = np.cumsum(sizes)
        inside[ends - 1] = inside[ends - 2] = False
        powers = mix64(triples * np.uint64(3) + np.arange(len(triples), dtype=np.uint64) - np.repeat(begins, sizes).astype(np.uint64))
        word = np.add.reduceat(powers, begins) if len(marked) else np.zeros(0, np.uint64)
        counts = sizes - 2
        return (
            (word % np.uint64(WORD_ROWS)).astype(np.int64),
            (triples[inside] % np.uint64(CHAR_ROWS)).astype(np.int64),
            np.cumsum(counts) - counts,
        )


def some_of(features: tuple, at: np.ndarray) -> tuple[tuple, np.ndarray]:
    """The features of the words in ``at`` only, and ``at`` with these words' new numbers."""
    word, char, begins = features
    picked, again = np.unique(at, return_inverse=True)
    again = again.reshape(at.shape)
    if len(picked) and picked[0] < 0:
        picked, again = picked[1:], again - 1
    counts = np.diff(np.append(begins, len(char)))[picked]
    ends = np.cumsum(counts)
    places = np.repeat(begins[picked] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
    return (word[picked], char[places], ends - counts), again


def windows(row: np.ndarray) -> Iterator[np.ndarray]:
    """Overlapping windows over a text's word numbers; the last one ends with the text."""
    n = len(row)
    if n <= LENGTH:
        yield row
        return
    for begin in range(0, n - LENGTH, STRIDE):
        yield row[begin : begin + LENGTH]
    yield row[n - LENGTH :]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, scoring and gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.weights = {
            "word": normal(WORD_ROWS, WIDTH, scale=0.05),
            "char": normal(CHAR_ROWS, WIDTH, scale=0.05),
            "v": normal(2 * STATES, scale=0.3),
            "out": normal(2 * STATES, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.weights["in" + side] = normal(WIDTH, 3 * STATES, scale=0.4)
            self.weights["bias" + side] = np.zeros(3 * STATES, np.float32)
            self.weights["own" + side] = normal(STATES, 3 * STATES, scale=0.3)

    def vectors(self, features: tuple) -> np.ndarray:
        """A vector per distinct word."""
        word, char, begins = features
        counts = np.diff(np.append(begins, len(char)))[:, None]
        found = self.weights["word"][word]
        if len(char):
            # A word has one trigram at least, so no run of the reduction is empty.
            found = found + np.add.reduceat(self.weights["char"][char], begins) / counts
        return found.astype(np.float32)

    def _gates(self, vectors: np.ndarray, side: str) -> np.ndarray:
        gates = vectors @ self.weights["in" + side] + self.weights["bias" + side]
        return np.vstack([gates, np.zeros((1, 3 * STATES), np.float32)])  # the last row is for gaps

    def _run(self, gates: np.ndarray, at: np.ndarray, live: np.ndarray | None, side: str, keep: bool):
        n, length = at.shape
        h = np.zeros((n, STATES), np.float32)
        states = np.empty((length, n, STATES), np.float32)
        trace = []
        own = self.weights["own" + side]
        steps = range(length) if side == "f" else range(length - 1, -1, -1)
        for t in steps:
            x, u = gates[at[:, t]], h @ own
            zr = _sigmoid(x[:, : 2 * STATES] + u[:, : 2 * STATES])
            z, r = zr[:, :STATES], zr[:, STATES:]
            new = np.tanh(x[:, 2 * STATES :] + r * u[:, 2 * STATES :])
            after = new + z * (h - new)
            if live is not None:
                after = np.where(live[:, t, None], after, h)
            if keep:
                trace.append((t, h, z, r, new, u[:, 2 * STATES :]))
            states[t] = h = after
        return states, trace

    def forward(self, vectors: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logit of each window (rows of word numbers, -1 for gaps), and what gradients need."""
        live = at >= 0
        masked = None if live.all() else live
        forth, one = self._run(self._gates(vectors, "f"), at, masked, "f", keep)
        back, two = self._run(self._gates(vectors, "b"), at, masked, "b", keep)
        states = np.concatenate([forth, back], 2)
        score = states @ self.weights["v"]
        if masked is not None:
            score = np.where(live.T, score, -1e9)
        weight = np.exp(score - score.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        logit = pooled @ self.weights["out"] + self.weights["bias"]
        return logit, (states, weight, pooled, one, two, live)

    def gradients(self, vectors: np.ndarray, features: tuple, at: np.ndarray, wanted: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the cross entropy, and the windows' probabilities."""
        w = self.weights
        logit, (states, weight, pooled, one, two, live) = self.forward(vectors, at, keep=True)
        chance = _sigmoid(logit)
        dlogit = ((chance - wanted) / len(at)).astype(np.float32)
        grads = {"out": pooled.T @ dlogit, "bias": dlogit.sum(keepdims=True)}
        dpooled = dlogit[:, None] * w["out"]
        dweight = (states * dpooled).sum(2)
        dscore = weight * (dweight - (weight * dweight).sum(0))
        grads["v"] = np.einsum("tn,tnh->h", dscore, states)
        dstates = weight[:, :, None] * dpooled + dscore[:, :, None] * w["v"]
        dvectors = np.zeros((len(vectors) + 1, WIDTH), np.float32)
        for side, trace, part in (("f", one, dstates[:, :, :STATES]), ("b", two, dstates[:, :, STATES:])):
            own = w["own" + side]
            down = np.zeros_like(own)
            din, dbias = np.zeros_like(w["in" + side]), np.zeros_like(w["bias" + side])
            dh = np.zeros((len(at), STATES), np.float32)
            with_gap = np.vstack([vectors, np.zeros((1, WIDTH), np.float32)])
            for t, before, z, r, new, u in reversed(trace):
                dh = dh + part[t]
                on = live[:, t, None]
                pass_on, dh = np.where(on, 0, dh), np.where(on, dh, 0)
                dnew = dh * (1 - z) * (1 - new * new)
                dz = dh * (before - new) * z * (1 - z)
                dr = dnew * u * r * (1 - r)
                dx = np.concatenate([dz, dr, dnew], 1)
                du = np.concatenate([dz, dr, dnew * r], 1)
                down += before.T @ du
                dbias += dx.sum(0)
                rows = at[:, t]
                din += with_gap[rows].T @ dx
                np.add.at(dvectors, rows, dx @ w["in" + side].T)
                dh = dh * z + du @ own.T + pass_on
            grads |= {"own" + side: down, "in" + side: din, "bias" + side: dbias}
        word, char, begins = features
        dvectors = dvectors[:-1]
        grads["word"], grads["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
        np.add.at(grads["word"], word, dvectors)
        counts = np.diff(np.append(begins, len(char)))
        np.add.at(grads["char"], char, np.repeat(dvectors / np.maximum(counts, 1)[:, None], counts, axis=0))
        return grads, chance

    def scores(self, rows: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
        """The score of each text: its highest window's."""
        found = np.full(len(rows), -np.inf, np.float32)
        full, short, owners_full, owners_short = [], [], [], []
        for i, row in enumerate(rows):
            for part in windows(row):
                kind = (full, owners_full) if len(part) == LENGTH else (short, owners_short)
                kind[0].append(part)
                kind[1].append(i)
        for parts, owners in ((full, owners_full), (short, owners_short)):
            for begin in range(0, len(parts), BATCH):
                at = padded(parts[begin : begin + BATCH])
                logit, _ = self.forward(vectors, at)
                np.maximum.at(found, owners[begin : begin + BATCH], logit)
        return _sigmoid(found.astype(np.float64))


def padded(parts: list[np.ndarray]) -> np.ndarray:
    """Windows as rows of equal length, -1 for gaps; an empty window is all gaps."""
    if all(len(p) == LENGTH for p in parts):
        return np.stack(parts)
    at = np.full((len(parts), LENGTH), -1, np.int32)
    for row, part in zip(at, parts):
        row[: len(part)] = part
    return at


def train(texts: list[bytes], labels: list[int], rounds: int = 24, seed: int = 7) -> Network:
    """Fit a network to texts and their labels; the same input gives the same weights."""
    rng = np.random.default_rng(seed)
    network = Network(seed)
    words = Words()
    rows = [words.row(words_of(t)) for t in texts]
    if not words.numbers:
        return network
    features = words.features()
    wanted = np.array(labels, np.float32)
    # Words begin with how much more often toxic documents of the sample have them.
    seen = np.zeros((2, len(words.numbers)), np.float32)
    for row, label in zip(rows, labels):
        seen[label, np.unique(row)] += 1
    total = np.array([max(1, len(labels) - wanted.sum()), max(1, wanted.sum())])
    odds = np.log((seen[1] + 0.5) / total[1]) - np.log((seen[0] + 0.5) / total[0])
    odds *= np.minimum(1, (seen.sum(0)) / 8)
    network.weights["word"][features[0], 0] = np.clip(odds, -2, 5)
    parts, owners = [], []
    for i, row in enumerate(rows):
        some = list(windows(row))
        parts += some
        owners += [i] * len(some)
    at, owners = padded(parts), np.array(owners)
    first, second = ({k: np.zeros_like(v) for k, v in network.weights.items()} for _ in range(2))
    step = 0
    for round_no in range(rounds):
        if round_no % 6 == 0:
            if round_no:
                vectors = network.vectors(features)
                logit = np.concatenate([network.forward(vectors, at[i : i + BATCH])[0] for i in range(0, len(at), BATCH)])
            else:
                logit = np.max(np.where(at >= 0, odds[at], -9), axis=1)
            order = np.lexsort((-logit, owners))
            rank = np.arange(len(order)) - np.searchsorted(owners[order], owners[order])
            chosen, rank = order[rank < TOP], rank[rank < TOP]
            # Of toxic texts only the worst window must be toxic, of others none may be.
            chosen = chosen[(wanted[owners[chosen]] == 0) | (rank == 0)]
        mixed = rng.permutation(chosen)
        for begin in range(0, len(mixed), 256):
            some = mixed[begin : begin + 256]
            part, part_at = some_of(features, at[some])
            grads, _ = network.gradients(network.vectors(part), part, part_at, wanted[owners[some]])
            step += 1
            for name, grad in grads.items():
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.01 * (grad * grad - second[name])
                rate = 0.01 * (1 - round_no / rounds) + 0.001
                network.weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    return network


def is_held_out(doc_id: int | None) -> bool:
    """Whether a document's label is kept out of learning."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def learning_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """At most ``size`` texts of each class, and their labels, chosen by a hash of the id.

    Rows without an id, a text or a label, and ids that are held out, are never
    chosen; of ids with several labels or texts, one each.
    """
    known = labels.select(F.col(id_col).cast("long").alias("its"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("its").isNotNull() & F.col("label").isin(0, 1))
    known = known.filter(F.crc32(F.col("its").cast("string")) % 3 != 1)
    known = known.groupBy("its").agg(F.max("label").alias("label"))
    order = (F.xxhash64("its"), F.col("its"))
    few = known.filter("label = 1").orderBy(*order).limit(size).union(known.filter("label = 0").orderBy(*order).limit(size))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(few), F.col("id") == F.col("its")).filter(F.col("text").isNotNull())
    chosen = {r["id"]: (bytes(r["text"]), r["label"]) for r in sorted(rows.collect(), key=lambda r: (r["id"], r["text"]))}
    return [t for t, _ in chosen.values()], [y for _, y in chosen.values()]


def score_documents(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text, a row per row of ``docs``.

    A null text counts as empty; an empty one is scored as a window without
    words. A null id is not held out. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def rows(batches):
        for ids, texts in byte_chunks(batches):
            words = Words()
            lists = [words.row(words_of(t or b"")) for t in texts]
            vectors = network.vectors(words.features()) if words.numbers else np.zeros((0, WIDTH), np.float32)
            for key, score in zip(ids, network.scores(lists, vectors).tolist()):
                yield key, is_held_out(key), score, int(score >= threshold)

    return map_rows(source, "doc_id long, held_out boolean, score double, predicted int", rows)
