"""The model against a version that keeps its contexts in dictionaries."""

import collections
import math
import random
import tracemalloc
import zlib

import pyarrow as pa

from takerlens.llm import op2_ppm


def slow_scores(rows, order):
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 10 == 0
    tokens = collections.Counter()
    grams = [collections.Counter() for _ in range(order + 1)]
    for doc_id, text in rows:
        if not held(doc_id):
            words = (text or "").encode().lower().split()
            tokens.update([*words, b"\n"])
            coded = b"\n" * order + b" ".join(words) + b"\n"
            grams[order].update(coded[i - order:i + 1] for i in range(order, len(coded)))
    for k in range(order - 1, -1, -1):
        grams[k].update(g[1:] for g in grams[k + 1])
    contexts = [collections.defaultdict(dict) for _ in grams]
    for k, counted in enumerate(grams):
        for g, c in counted.items():
            contexts[k][g[:-1]][g[-1]] = c

    def logp(gram):
        total, excluded = 0.0, set()
        for k in range(order, -1, -1):
            met = contexts[k].get(gram[order - k:-1])
            if met is None:
                continue
            left = {s: c for s, c in met.items() if s not in excluded}
            n = sum(left.values())
            if gram[-1] in left:
                return total + math.log10((2 * left[gram[-1]] - 1) / (2 * n))
            if n:
                total += math.log10(len(left) / (2 * n))
            excluded |= set(met)
        return total - math.log10(256 - len(excluded))

    n, v = sum(tokens.values()), len(tokens)
    out = []
    for doc_id, text in rows:
        words = [*(text or "").encode().lower().split(), b"\n"]
        coded = b"\n" * order + b" ".join(words[:-1]) + b"\n"
        out.append((doc_id, held(doc_id), len(words), sum(tokens[w] > 0 for w in words), n,
                    sum(math.log10((tokens[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words),
                    sum(logp(coded[i - order:i + 1]) for i in range(order, len(coded)))))
    return out, logp


def test_scores(stored, samples):
    rows = [(i, t) for i, t in samples if len(t or "") < 4000][:90] + [(9101, "A\tb\x0b C é"), (9102, "the " * 50)]
    expected, logp = slow_scores(rows, 3)
    assert abs(sum(10 ** logp(b"the" + bytes([b])) for b in range(256)) - 1) < 1e-9
    assert abs(sum(10 ** logp(b"qzx" + bytes([b])) for b in range(256)) - 1) < 1e-9
    got = sorted((tuple(r) for r in op2_ppm.score(stored(rows), order=3).collect()), key=str)
    for a, b in zip(got, sorted(expected, key=str), strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_nothing_to_learn_from(stored):
    held = [i for i in range(200) if op2_ppm.held_out(i)][:3]
    rows = [(i, "ab") for i in held]
    got = op2_ppm.score(stored(rows, 1), order=2).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(2, 0, 0)] * 3
    assert all(math.isclose(r.score, -3 * math.log10(256)) for r in got)
    assert op2_ppm.score(stored(rows, 1).limit(0)).count() == 0


def test_held_out_texts_are_predicted_better_than_by_token_counts(spark):
    import os

    import pytest

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    row = op2_ppm.op2_prediction_by_partial_matching(spark, folder).where("held_out").selectExpr(
        "sum(score) AS score", "sum(base_score) AS base").first()
    assert row.score > row.base


def test_the_grams_of_a_block_take_little_memory(stored, monkeypatch):
    docs = stored([(1, "a")], 1)
    made = []
    frame = type(docs)
    real = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, schema, *more: made.append(f) or real(self, f, schema, *more))
    op2_ppm._grams(docs, 5)
    text = random.Random(1).randbytes(1 << 20).replace(b"\n", b" ")
    batch = pa.record_batch([pa.array([1, 2]), pa.array([text, text[:5000]]), pa.array([0, 1])], names=["doc_id", "text", "row"])
    tracemalloc.start()
    n = sum(out.num_rows for out in made[-1](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 900_000 and peak < 40 * len(text)


def test_grams_are_counted_in_parts(monkeypatch):
    monkeypatch.setattr(op2_ppm, "_PART", 7)
    rows = [(i, t) for i, t in enumerate(["the cat the cat", "", "the dog", None, "a a a a a a a a"] * 5)]
    texts = [(t or "").encode() for _, t in rows]
    expected = collections.Counter()
    for (i, _), text in zip(rows, texts):
        for gram in op2_ppm.grams(op2_ppm.stream(text), 5).tolist():
            expected[gram] += not op2_ppm.held_out(i)
    got = [(g, w) for part in op2_ppm.counted_grams(pa.array([i for i, _ in rows]), texts, 5) for g, w in zip(*map(list, part))]
    assert got == sorted(expected.items())
    assert list(op2_ppm.counted_grams(pa.array([], pa.int64()), [], 5)) == []
