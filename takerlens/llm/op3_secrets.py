"""Secrets by randomness: a battery of tests on every long token, with false discoveries held by length.

The narrowest encoding that covers a token gives its alphabet. A token must pass as random over it (chi-squared
uniformity, runs about the median symbol, serial correlation), and must be unlike words: few words change so often between
letters, digits and cases, or repeat so few symbols. The evidence against "made of words" is a p-value that gets small only
with length; Benjamini and Hochberg's rule is applied over all tokens of the corpus within each class of lengths.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.blocks import id_type
from takerlens.llm.op1_pii import Span, written
from takerlens.llm.staging import documents, staged

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# From narrow to wide.
ENCODINGS = (_DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER, _UPPER + "234567", _DIGITS + _LOWER,
             _DIGITS + _UPPER, _UPPER + _LOWER, _DIGITS + _UPPER + _LOWER, _UPPER + _LOWER + _DIGITS + "+/",
             _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _LOWER + _DIGITS + "+/-_")
_SETS = [frozenset(e) for e in ENCODINGS]
_CLASS = {**dict.fromkeys(_DIGITS, 0), **dict.fromkeys(_LOWER, 1), **dict.fromkeys(_UPPER, 2), **dict.fromkeys("+/-_", 3)}

# Words change class at fewer than one place in five, and two of their letters agree at least that often.
WORD_CHANGES, WORD_MATCHES = 0.2, 0.065
STEPS, LAST = 4, 160  # p-values are counted by quarters of a power of ten, down to 1e-40


def base_spans(text: str) -> list[Span]:
    """Plain assignments, access keys and hexadecimal runs, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    low = text.lower() if text.isascii() else text.translate(_ASCII_LOWER)
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return _ordered(found)


_ASCII_LOWER = {ord(c): c.lower() for c in _UPPER}


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def looks_random(token: str, alphabet: str, level: float = 1e-3) -> bool:
    """No test of the battery rejects uniform and independent symbols at `level`."""
    n, size = len(token), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    chi = size / n * sum(c * c for c in Counter(token).values()) - n
    spread = math.sqrt(2 * (size - 1) * (n - 1) / n)
    if chi > size - 1 and _tail((chi - size + 1) / spread) < level:
        return False
    x = np.array([place[c] for c in token], float)
    above = x > (size - 1) / 2
    up = int(above.sum())
    if 0 < up < n:
        runs, mean = 1 + int((above[1:] != above[:-1]).sum()), 1 + 2 * up * (n - up) / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        if variance > 0 and _tail((runs - mean) / math.sqrt(variance)) < level:
            return False
    elif 2.0 ** (1 - n) < level:
        return False
    y = x - x.mean()
    power = float(y @ y)
    return power > 0 and _tail(float(y[1:] @ y[:-1]) / power * math.sqrt(n)) >= level


def _binomial_tail(k: int, n: int, p: float) -> float:
    """P(at least k of n)."""
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1)) if n <= 400 else 0.5 * math.erfc(
        (k - 0.5 - n * p) / math.sqrt(2 * n * p * (1 - p)))


def _poisson_head(k: int, mean: float) -> float:
    """P(at most k)."""
    if mean > 500:
        return 0.5 * math.erfc((mean - k - 0.5) / math.sqrt(2 * mean))
    term = total = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        total += term
    return min(total, 1.0)


def evidence(token: str) -> float:
    """-log10 of the p-value of "made of words"; 0 where the token is not random over its own alphabet."""
    chars = set(token)
    alphabet = next(e for e, s in zip(ENCODINGS, _SETS) if chars <= s)
    if alphabet == _DIGITS or not looks_random(token, alphabet):
        return 0.0
    n = len(token)
    kinds = [_CLASS[c] for c in token]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    matches = sum(c * (c - 1) // 2 for c in Counter(token.lower()).values())
    # Fisher's sum of two logarithms, chi-squared with four degrees of freedom.
    half = -math.log(max(_binomial_tail(changes, n - 1, WORD_CHANGES), 1e-300)) - math.log(
        max(_poisson_head(matches, n * (n - 1) / 2 * WORD_MATCHES), 1e-300))
    return max(0.0, (half - math.log1p(half)) / math.log(10))


def length_class(n: int) -> int:
    return int(2 * math.log2(n))


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, evidence step) of each long token that no base span touches."""
    out = []
    k = 0
    spans = sorted((a, b) for _, a, b in base)
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if all(a >= end or b <= start for a, b in spans[k:k + 4]):
            out.append((start, end, length_class(end - start), min(int(STEPS * evidence(m[0])), LAST)))
    return out


def discovered(counts: dict[tuple[int, int], int], rate: float) -> dict[int, int]:
    """For each length class the least evidence step that Benjamini and Hochberg's rule accepts at `rate`."""
    out = {}
    for kind in {c for c, _ in counts}:
        tested = sum(n for (c, _), n in counts.items() if c == kind)
        found = 0
        for step in range(LAST, 0, -1):
            found += counts.get((kind, step), 0)
            if found and 10 ** (-step / STEPS) * tested <= rate * found:
                out[kind] = step
    return out


def find_secrets(docs: DataFrame, rate: float = 1e-3) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random for each row of `docs` (doc_id, text).

    Counts and the digest are of the base patterns; `spans` also has tokens found by randomness, kind "random", as
    kind:start:end in code points. NULL texts count as empty and have none; repeated rows and NULL ids give a row each;
    other columns are ignored; a token of any length is tested whole.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            spans, found = [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                for kind, count in zip(BASE, counts):
                    count.append(sum(s[0] == kind for s in base))
                spans.append(written(base))
                found.append([dict(zip(("start", "end", "class", "step"), c)) for c in candidates(text, base)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(spans, pa.string()),
                 pa.array(found, _FOUND)], ["doc_id", *(f"n_{k}" for k in BASE), "base", "found"])

    columns = f"doc_id {id_type(docs)}, {', '.join(f'n_{k} long' for k in BASE)}, base string"
    tested = staged(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        rows, columns + ", found array<struct<start: int, end: int, class: int, step: int>>"), "secrets")
    # At most a few dozen length classes of LAST + 1 steps.
    counted = tested.select(F.explode("found").alias("f")).groupBy("f.class", "f.step").count().collect()
    least = discovered({(r[0], r[1]): r[2] for r in counted}, rate)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column("base").to_pylist()
            spans, n_random = [], []
            for plain, found in zip(base, batch.column("found").to_pylist()):
                more = [("random", f["start"], f["end"]) for f in found if f["step"] >= least.get(f["class"], LAST + 1)]
                known = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in plain.split(",") if s)]
                spans.append(written(_ordered(known + more)))
                n_random.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(f"n_{k}") for k in BASE),
                 pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                 pa.array(spans, pa.string()), pa.array(n_random, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_random"])

    return tested.mapInArrow(chosen, columns.replace("base string", "base_sha256 string") + ", spans string, n_random long")


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("step", pa.int32())]))


def op3_randomness_battery(spark, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))
