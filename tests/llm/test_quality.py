"""Rule statistics against their statement; the forest on rows that stand apart."""

import collections
import re

import numpy as np

from takerlens.llm import op9_isolation
from tests.llm.conftest import babble

WORD = r"[^\x20\x09-\x0D]+"


def stated(text):
    words = re.findall(WORD, text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def test_counts_are_the_stated_ones():
    for text in babble(["a", "b", "é", "\n", " ", "\t", "#", "|", "\x0b", "\x1c", "\xa0", "c "], 4000, 40, 1):
        assert op9_isolation.statistics(text.encode())[0] == stated(text), repr(text)


def test_rows_outside_the_good_range_stand_apart():
    rng = np.random.default_rng(3)
    good = rng.normal([5, 0.1], [0.5, 0.01], (2000, 2))
    model = op9_isolation.model_of(good)
    plain, odd = model.score(good), model.score(np.array([[5, 3.0], [40, 0.1], [5, 0.5]]))
    assert odd.min() > np.quantile(plain, 0.995)


def test_cut_parts_labels():
    good, bad = np.zeros(op9_isolation.BINS + 2), np.zeros(op9_isolation.BINS + 2)
    good[600], bad[1000] = 500, 20
    assert op9_isolation.cut_of(good, bad, 20) == (600 + 999) / 2 / op9_isolation.BINS


def test_junk_goes_and_plain_text_stays(spark, stored, samples):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    rng = np.random.default_rng(0)
    plain = [(i, " ".join(rng.choice(words, 120)) + ".") for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in rng.choice(words, 120))) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in plain[:200]] + [(i, 0, 0) for i, _ in junk[:20]] + [(5, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = plain + junk + samples[-8:]
    docs = stored(rows)
    got = op9_isolation.judge(docs, labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, _ in plain} <= kept and not kept & {i for i, _ in junk}
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    good = op9_isolation.keep_good(docs, labels)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept
    assert {r.doc_id for r in op9_isolation.judge(docs, labels.limit(0)).collect() if r.kept} >= {i for i, _ in junk}
    assert op9_isolation.judge(docs.limit(0), labels).count() == 0
