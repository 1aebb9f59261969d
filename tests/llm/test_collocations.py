"""Phrases from FM-indexes against plain counting."""

import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from takerlens.llm import op11_fmindex as op
from tests.compare import compare
from tests.llm.conftest import FOLDER, babble, needs_tables

SCHEMA = "doc_id long, text string, lang string, n long, word string, shard int, phrase string"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from takerlens.llm.staging import with_package
    with_package(spark)

    def write(rows, files=3):
        path = str(tmp_path_factory.mktemp("lang") / "documents.parquet")
        spark.createDataFrame([(*r, 5, "w", 1, "p") for r in rows], SCHEMA).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write


def brute(rows, longest=3, least=10, inside=50, first=2000):
    counts, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            around = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= inside * a for b in around):
                continue
            score, k = min((Fraction(10**6 * a * a, f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def rows_of(n, seed):
    rng = random.Random(seed)
    texts = babble(["a ", "B ", "b ", "c\t", "dé ", "d.", "e\n", "  ", "x\x0b", "The ", "the,", "z\xa0y ", "\x85 ", "É "], n, 60, seed)
    return [(i, t, rng.choice(["en", "en", "fr", None, "", "e\nn"])) for i, t in enumerate(texts)]


@pytest.mark.parametrize("longest, least, bucket", [(3, 10, 2_000_000), (3, 3, 50), (5, 4, 300), (2, 10, 7)])
def test_equal_to_counting(stored, longest, least, bucket):
    rows = rows_of(150, longest) + [(900, None, "en"), (901, "", None), (902, "the the the " * 400, "en"), (902, "the the the " * 400, "en"),
                                    (None, "a b " * 30, "fr")]
    got = op.top(op.collocations(stored(rows), longest, least, shard_bytes=2000, bucket=bucket))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, longest, least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_first_of_each_lang(stored):
    rows = rows_of(150, 9)
    found = op.collocations(stored(rows), least=2, shard_bytes=5000)
    assert sorted(tuple(r) for r in op.top(found, 5).collect()) == brute(rows, least=2, first=5)


def test_nothing_to_find(stored):
    assert op.top(op.collocations(stored([(1, "a b", "en")]).limit(0))).count() == 0
    assert op.top(op.collocations(stored([(1, None, None), (2, " .\n", "en"), (3, "once only", "en")]))).count() == 0


def test_index_intervals_count_every_phrase():
    """Both directions: every phrase's place and count among the suffixes of the text and of its mirror."""
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(0, 4, 400), 0)
    index = op.Index(text, 4, 4)
    plain = {k: Counter(p for i in range(len(text) - k) if 0 not in (p := tuple(text[i:i + k].tolist()))) for k in (2, 3, 4)}
    for found, count in op.phrases(index, 4):
        assert dict(zip(map(tuple, found.tolist()), count.tolist())) == plain[found.shape[1]]
    # Left and right extensions of a phrase reach the same longer phrases.
    symbol, lo, rlo, size = index.words()
    right = index.extended(1, lo, rlo, size)
    left = index.extended(0, lo, rlo, size)
    pairs = {(int(symbol[o]), int(s)): int(n) for o, s, n in zip(right[0], right[1], right[4])}
    assert pairs == {(int(s), int(symbol[o])): int(n) for o, s, n in zip(left[0], left[1], left[4])} == plain[2]
    intervals = {(int(symbol[o]), int(s)): (int(a), int(b)) for o, s, a, b in zip(right[0], right[1], right[2], right[3])}
    assert intervals == {(int(s), int(symbol[o])): (int(a), int(b)) for o, s, a, b in zip(left[0], left[1], left[2], left[3])}


def test_a_shard_takes_little_memory():
    """Peak of a shard's index and phrases per word: it was 87 bytes, and an executor holds a shard per core."""
    rng = np.random.default_rng(5)
    text = np.append(np.minimum(rng.zipf(1.3, 2_000_000), 30_000), 0)
    tracemalloc.start()
    phrases = {found.shape[1]: len(found) for found, _ in op.phrases(op.Index(text, 30_001, 3), 3)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    pairs = text[:-2] * 30_001 + text[1:-1]
    assert phrases == {2: len(np.unique(pairs)), 3: len(np.unique(pairs[:-1] * 30_001 + text[2:-1]))}
    assert peak < 60 * len(text)


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_extended_some_at_a_time(monkeypatch, depth):
    """Slices of any size, also smaller than one phrase's places, give the same phrases as plain counting."""
    monkeypatch.setattr(op, "PLACES", 7)
    text = np.append(np.random.default_rng(depth).integers(0, 3, 300), 0)
    for found, count in op.phrases(op.Index(text, 3, depth), depth):
        k = found.shape[1]
        plain = Counter(p for i in range(len(text) - k) if 0 not in (p := tuple(text[i:i + k].tolist())))
        assert dict(zip(map(tuple, found.tolist()), count.tolist())) == plain


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, l, r = 123_456_789_012, 234_567_890_123, 345_678_901_234
    df = spark.createDataFrame([(a, l, r), (10, 10, 10), (10, 3_000_000, 5_000_000)], "a long, l long, r long")
    got = [x.s for x in df.select(op.exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()]
    assert got == [10**6 * a * a // (l * r), 10**6, 0]


@needs_tables
def test_registered_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert compare(op.op11_fm_index_collocations(spark, FOLDER), con, op.OP11_SQL) is None
