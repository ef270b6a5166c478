"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

The guess cost of a value is the logarithm (base 10) of the guesses that its
cheapest reading takes. Dynamic programming over the end of a segment finds the
cheapest segmentation into words, dates, repeats, keyboard walks and
brute-force spans. Values that cost more than a limit are secrets.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_rows

# The base patterns, group of the secret, least length.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
ORDER = {"assign": 0, "access": 1, "hex": 2, "guess": 3}

#: Values behind such names are looked at by their guess cost.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth(?:orization)?)"""
    r"""["']?\x20*(?:=>|:=|[:=])\x20*(?:"([^"\n]*)"|'([^'\n]*)'|([^\s"',;]+))""",
    re.A | re.I,
)
HINTS = ("pass", "pwd", "secret", "token", "api", "credential", "auth")
#: Least guess cost of a secret: ten thousand million guesses.
LIMIT = 10.0
_HEX_ONLY = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))

ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?")
LEET = str.maketrans("4@831!0$57", "aabeliosst")
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d"
    r"|(?:19|20)\d\d"
)
LONGEST_WORD = 24
LONGEST_UNIT = 8
SEGMENT = math.log10(2)


def _places() -> dict[str, tuple[float, int]]:
    """Column and row of each key; rows are shifted by half a key."""
    found = {}
    for y, (plain, shifted) in enumerate(zip(ROWS, SHIFTED)):
        for x, (a, b) in enumerate(zip(plain, shifted)):
            found[a] = found[b] = (x + 0.5 * y, y)
    return found


PLACES = _places()


@lru_cache(maxsize=2)
def word_costs(path: str) -> dict[str, float]:
    """Words and the logarithm of their place in a tokenizer's vocabulary (whole words only)."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix = model.get("end_of_word_suffix") or ""
    words = [t.removesuffix(suffix) for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1]) if t.endswith(suffix)]
    costs: dict[str, float] = {}
    for rank, word in enumerate((w for w in words if len(w) > 2 and w.isalpha()), 1):
        costs.setdefault(word, math.log10(rank))
    return costs


def _alone(char: str) -> float:
    """Cost of one character by brute force."""
    if char.isascii():
        size = 26 if char.isalpha() else 10 if char.isdigit() else 33
    else:
        size = 100
    return math.log10(size)


def guess_cost(value: str, words: dict[str, float]) -> float:
    """The cost of the cheapest segmentation of ``value``, in time proportional to its length."""
    n = len(value)
    lower = value.lower()
    if len(lower) != n:  # letters that change their length are left as they are
        lower = value
    plain = lower.translate(LEET)
    single = [_alone(c) for c in value]
    before = [0.0]
    for cost in single:
        before.append(before[-1] + cost)
    capitals = [0]
    for c in value:
        capitals.append(capitals[-1] + c.isupper())
    dates = {}
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            size = m.end() - i
            dates.setdefault(m.end(), []).append((i, 2.1 if size == 4 else 4.6 + (0.6 if not m[0].isdigit() else 0)))
    best = [0.0] * (n + 1)
    same = [0] * (LONGEST_UNIT + 1)
    repeats = [[(math.inf, 1)] * (n + 1) for _ in range(LONGEST_UNIT + 1)]
    walk, step = math.inf, None
    for j in range(1, n + 1):
        cost = best[j - 1] + single[j - 1]
        for size in range(3, min(LONGEST_WORD, j) + 1):
            i = j - size
            found = words.get(lower[i:j])
            leet = 0.0
            if found is None:
                found, leet = words.get(plain[i:j]), 1.0
            if found is not None:
                upper = capitals[j] - capitals[i]
                cost = min(cost, best[i] + found + leet + SEGMENT * (1 + min(upper, size - upper + 1)))
        for i, price in dates.get(j, ()):
            cost = min(cost, best[i] + price + SEGMENT)
        for unit in range(1, LONGEST_UNIT + 1):
            same[unit] = same[unit] + 1 if j > unit and value[j - 1] == value[j - 1 - unit] else 0
            if same[unit] >= unit:
                once = best[j - 2 * unit] + before[j] - before[j - unit] + SEGMENT
                unit_cost, times = repeats[unit][j - unit]
                longer = (unit_cost, times + 1)
                shorter = (once, 2)
                chosen = min(longer, shorter, key=lambda x: x[0] + math.log10(x[1]))
                repeats[unit][j] = chosen
                cost = min(cost, chosen[0] + math.log10(chosen[1]))
        if j > 1:
            move = _move(value[j - 2], value[j - 1])
            begun = best[j - 2] + 1.7 + 0.7 + SEGMENT
            if move is None:
                walk = math.inf
            else:
                walk = min(begun, walk + (0.1 if move == step else 0.7))
                cost = min(cost, walk)
            step = move
        best[j] = cost
    return best[n]


def _move(a: str, b: str) -> tuple | None:
    """The step from one key to a neighbour, or along the alphabet or the digits."""
    if abs(ord(b) - ord(a)) == 1 and a.isalnum() and b.isalnum():
        return ("row", ord(b) - ord(a))
    if a in PLACES and b in PLACES and a != b:
        dx, dy = PLACES[b][0] - PLACES[a][0], PLACES[b][1] - PLACES[a][1]
        if abs(dx) <= 1 and abs(dy) <= 1:
            return ("key", dx, dy)
    return None


def base_spans(text: str, whole: bool = False) -> list[tuple[int, int, str]]:
    """Start, end and kind of what the base patterns find; failing matches count as passed over.

    Of ``assign``, the span of the value, or with ``whole`` that of the whole match.
    """
    found = []
    for kind, pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((*m.span(0 if whole else group), kind))
    return found


def may_hold(text: str) -> tuple[bool, bool, bool]:
    """Whether a name of a credential, an access key, a long hex run can be in ``text``."""
    low = text.lower()
    runs = b"x" * 24 in text.encode().translate(_HEX_ONLY)
    return any(hint in low for hint in HINTS), "AKIA" in text, runs


def find_spans(text: str, words: dict[str, float], limit: float = LIMIT, whole: bool = False) -> list[tuple[int, int, str]]:
    """All spans, by start and then kind: base ones (``whole`` as there), and values that are hard to guess."""
    named, access, runs = may_hold(text)
    if not (named or access or runs):
        return []
    found = base_spans(text)
    if named:
        taken = [(a, b) for a, b, _ in found]
        for m in CONTEXT.finditer(text):
            begin, end = next(m.span(g) for g in (1, 2, 3) if m.start(g) >= 0)
            if any(a <= begin and end <= b for a, b in taken):
                continue
            if guess_cost(text[begin:end], words) >= limit:
                found.append((begin, end, "guess"))
    if whole:  # which values are guessed at does not depend on it
        found = base_spans(text, True) + [s for s in found if s[2] == "guess"]
    return sorted(found, key=lambda x: (x[0], ORDER[x[2]], x[1]))


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_secrets(
    docs: DataFrame,
    words_path: str,
    limit: float = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole: bool = False,
) -> DataFrame:
    """Secrets of every whole text.

    Columns: ``doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans``;
    spans are ``kind:start:end`` in code points, by start and then kind. For
    ``assign`` the span is the value's, or with ``whole`` that of the whole match,
    from the name on. ``words_path`` is a tokenizer file whose
    vocabulary ranks the words. One row out per row in; a null text counts as
    empty; null ids stay null; other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def rows(batches):
        words = word_costs(words_path)
        for ids, texts in batches:
            for key, text in zip(ids, texts):
                spans = find_spans(text or "", words, limit, whole)
                kinds = [s[2] for s in spans]
                base = _listed([s for s in spans if s[2] != "guess"])
                yield key, *(kinds.count(k) for k in ORDER), hashlib.sha256(base.encode()).hexdigest(), _listed(spans)

    return map_rows(
        source,
        "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string",
        rows,
    )


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "<secret>") -> str:
    """``text`` with a mark in place of each span; overlapping spans get one."""
    parts, done = [], 0
    for begin, end, _ in sorted(spans):
        if begin >= done:
            parts += [text[done:begin], mark]
        done = max(done, end)
    parts.append(text[done:])
    return "".join(parts)


def redact_secrets(docs: DataFrame, words_path: str, limit: float = LIMIT, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with all secrets replaced by ``<secret>``; no row goes, all columns stay.

    ``length_col`` names a column that holds the text's length and follows it.
    A null text stays null.
    """
    whole = docs.schema

    def run(batches):
        import pyarrow as pa

        words = word_costs(words_path)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t and redacted(t, find_spans(t, words, limit)) for t in batch.column(at).to_pylist()]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if length_col is not None:
                at = batch.schema.get_field_index(length_col)
                sizes = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(at).type)
                batch = batch.set_column(at, batch.schema.field(at), sizes)
            yield batch

    return docs.mapInArrow(run, whole)
