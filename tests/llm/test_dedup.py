"""Line templates, near and exact duplicates against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from takerlens.llm import op5_templates, op7_jaccard, op8_exact
from takerlens.llm.components import components


def body(i, n=40):
    return " ".join(f"w{chr(97 + i)}{chr(97 + j)}" for j in range(n))


def notice(year, name):
    return f"Copyright {year} by {name}, all rights are reserved here"


def test_recurring_templates_go_but_for_the_first(stored):
    names = ["Ann", "Bob", "Cid", "Dan", "Eve"]
    rows = [(i, "\n".join([body(i), notice(2000 + i, names[i]), "Of the.", body(i + 8)])) for i in range(5)]
    rows += [(30, "this line recurs exactly in two\n" + body(20)), (31, body(21) + "\nthis line recurs exactly in two"),
             (31, body(21) + "\nthis line recurs exactly in two"), (None, notice(1999, "Ann")), (32, None), (33, "")]
    docs = stored(rows)
    out = op5_templates.drop_templates(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    expected = [(i, "\n".join([body(i), *([notice(2000, "Ann"), "Of the."] if i == 0 else []), body(i + 8)])) for i in range(5)]
    expected += [(30, rows[5][1]), (31, body(21)), (31, body(21)), *rows[8:]]
    assert got == sorted(expected, key=str)
    assert op5_templates.drop_templates(docs.limit(0)).count() == 0


def test_copies_stay_whole_and_unlike_lines_of_a_leaf_stay(stored):
    same = "\n".join(body(i) for i in range(3))
    apart = [(50 + i, f"in the end {body(i, 9)}\n{body(i + 10)}") for i in range(6)]
    rows = [(1, same), (2, same + "\nand a line of its own"), *apart]
    assert sorted((r.doc_id, r.text) for r in op5_templates.drop_templates(stored(rows)).collect()) == sorted(rows)


def test_documents_made_of_boilerplate_lose_it_and_near_copies_do_not(stored):
    shared = [body(i, 12) for i in range(20, 23)]
    rows = [(i, "\n".join([body(i, 60), shared[i]])) for i in range(3)]
    rows += [(7, "\n".join([*shared, "but this is new"]))]
    copy = "\n".join(body(i) for i in range(10, 16))
    rows += [(8, copy), (9, copy + "\n" + shared[0])]
    got = {r.doc_id: r.text for r in op5_templates.drop_templates(stored(rows)).collect()}
    assert got == {**dict(rows), 7: "but this is new", 9: copy}


def test_a_leaf_holds_several_templates(stored):
    kinds = ["posted in the {} section by our own staff writers", "posted in the {} forum where all members may answer",
             "posted in the {} list which nobody reads any more"]
    assert len({(len(k.split()), *k.split()[:3]) for k in kinds}) == 1
    fields = ["red", "green", "blue", "grey"]
    rows = [(10 * k + i, f"{body(k)}\n{kind.format(f)}") for k, kind in enumerate(kinds) for i, f in enumerate(fields)]
    rows += [(100 + i, f"{body(4)}x\nposted in the {body(i, 6)}") for i in range(2)]
    rows = [(i, f"{i:03d} " + text.replace("\n", f" {chr(97 + i % 10)}z\n", 1)) for i, text in rows]
    unlike = [(i, " ".join(["posted in the", *(f"q{chr(97 + i)}{chr(97 + j)}" for j in range(6))])) for i in range(9)]
    rows += [(200 + i, f"{body(5 + i, 50)}\n{line}") for i, line in unlike]
    got = {r.doc_id: r.text for r in op5_templates.drop_templates(stored(rows)).collect()}
    lost = {i for i, text in rows if text.split("\n")[-1] not in got[i].split("\n")}
    assert lost == {10 * k + i for k in range(3) for i in range(1, 4)}


def slow_lines(rows):
    """Templates by plain counting over all words in memory."""
    found, leaves, raws, totals = [], {}, {}, {}
    for row, (doc_id, text) in enumerate(rows):
        split = [x.encode().split() for x in (text or "").split("\n")] if doc_id is not None else []
        for i, words in enumerate(split):
            masked = tuple("*" if any(c in b"0123456789" for c in w) else w for w in words)
            if set(masked) <= {"*"}:
                continue
            found.append((row, doc_id, i, tuple(words), masked))
            leaves.setdefault((len(words), masked[:3]), {}).setdefault(masked, set()).add(doc_id)
            raws.setdefault(tuple(words), set()).add(doc_id)
        if any(r[0] == row for r in found[-len(split):]):
            totals[doc_id] = max(totals.get(doc_id, 0), sum(map(len, split)))
    keep = {}
    for (n, _), lines in leaves.items():
        groups = {}
        for line, ids in lines.items():
            if len(ids) > 1 and (n >= 5 or len(ids) >= 5):
                groups[line] = [line]
            counts = [sum(other[k] == line[k] for other in lines) for k in range(n)]
            words = [k for k in range(n) if line[k] != "*" and counts[k] > 1]
            for level in {counts[k].bit_length() - 1 for k in words} if n >= 5 else ():
                constant = tuple((k, line[k]) for k in words if counts[k].bit_length() - 1 >= level)
                if len(constant) >= max(1, -(-8 * (n - line.count("*")) // 10)):
                    groups.setdefault(constant, []).append(line)
        for group in groups.values():
            ids = set().union(*(lines[x] for x in group))
            if len(ids) > 1:
                for line in group:
                    keep[line] = min(keep.get(line, min(ids)), min(ids))
    gone = {}
    for row, doc_id, i, words, masked in found:
        if masked in keep and doc_id > keep[masked]:
            gone.setdefault(row, []).append((i, len(words), keep[masked], min(raws[words]) == keep[masked]))
    out = []
    for row, (doc_id, text) in enumerate(rows):
        mine = gone.get(row, [])
        same = {}
        for _, n, k, exact in mine:
            same[k] = same.get(k, 0) + n * exact
        near = max((k for k in same if same[k]), key=lambda k: (same[k], k), default=None)
        total = len((text or "").encode().split())
        if near is not None and 10 * same[near] < 8 * (total + totals[near] - same[near]):
            near = None
        drop = {i for i, _, k, exact in mine if not (exact and k == near)}
        out.append((doc_id, text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)))
    return out


def test_short_lines_go_once_many_documents_have_them(stored):
    rows = [(i, f"{body(i)}\nRead more\n{i}\nnot in five {i // 2}") for i in range(6)] + [(9, "Read more\n" + body(9))]
    got = {r.doc_id: r.text.split("\n") for r in op5_templates.drop_templates(stored(rows)).collect()}
    assert [i for i in got if "Read more" in got[i]] == [0]
    assert all(str(i) in got[i] for i in range(6))  # a variable alone is no template
    assert [i for i in range(6) if any(x.startswith("not in five") for x in got[i])] == [0]
    few = stored([(i, f"{body(i)}\nRead more") for i in range(4)])
    assert all("Read more" in r.text for r in op5_templates.drop_templates(few).collect())


def test_lines_of_random_words_stay(stored):
    rng = random.Random(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(i, " ".join(["all lines begin", *(rng.choice(words) for _ in range(9))])) for i in range(1500)]
    assert sorted((r.doc_id, r.text) for r in op5_templates.drop_templates(stored(rows)).collect()) == sorted(rows)


def test_rows_of_one_id_and_other_ids_and_names(spark, tmp_path):
    boiler, own = "this line is in very many documents", "unique first line of the other row"
    rows = [("a", f"{body(1)}\n{boiler}"), ("b", f"{boiler}\n{body(2)}"), ("b", f"{own}\n{body(3)}\n{boiler}"), ("c", boiler)]
    spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id string, text string, row int, dropped int, Row_ string") \
         .write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = op5_templates.drop_templates(docs)
    assert out.columns == docs.columns and out.where("row = 1 AND dropped = 2 AND Row_ = 'x'").count() == 4
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted([
        ("a", f"{body(1)}\n{boiler}"), ("b", body(2)), ("b", f"{own}\n{body(3)}"), ("c", "")])


def test_random_lines_equal_counting(stored):
    rng = random.Random(7)
    starts, fields = ["sold by the", "made in a", "on 5 may"], ["red", "blue", "grey", "x1", "x2"]
    line = lambda: " ".join([rng.choice(starts), *(rng.choice(fields + ["shop"] * 6) for _ in range(rng.randint(0, 7)))])
    rows = [(rng.choice([i, i, 3, None]), "\n".join(line() for _ in range(rng.randint(0, 4)))) for i in range(150)]
    got = sorted(((r.doc_id, r.text) for r in op5_templates.drop_templates(stored(rows)).collect()), key=str)
    assert got == sorted(slow_lines(rows), key=str)


def test_lines_of_real_rows(stored, samples):
    assert sorted(((r.doc_id, r.text) for r in op5_templates.drop_templates(stored(samples)).collect()), key=str) \
        == sorted(slow_lines(samples), key=str)


def slow_classes(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    texts = list(dict.fromkeys(sets))
    near = {t: [u for u in texts if u != t and 10 * len(t & u) >= 8 * len(t | u) and t and u] for t in texts}
    root = {}
    for t in texts:
        todo = [] if t in root else [t]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = t
                todo += near[x]
    low = {}
    for (doc_id, _), s in zip(rows, sets):
        if doc_id is not None:
            low[root[s]] = min(low.get(root[s], doc_id), doc_id)
    return [(doc_id, low.get(root[s]), len(near[s]), sets.count(s)) for (doc_id, _), s in zip(rows, sets)]


@pytest.fixture(scope="module")
def near_rows(samples):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = list(samples)
    for k in range(50):
        copy = list(words)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(300)] = f"x{rng.randrange(1000)}"
        rows.append((10_000 + k, " ".join(copy)))
    return rows + [(20_000, "one two"), (20_001, "one two"), (20_002, "two one"), (None, "two one")]


def test_rows_keep_their_identity_however_scans_are_split(spark, stored, near_rows, monkeypatch):
    """Cores come and go between two scans of one table: the files are split in another way."""
    docs = stored(near_rows, 7)
    expected = sorted((r.doc_id for r in op7_jaccard.keep_one(docs).collect()), key=str)
    cores, plain = iter([1, 8, 2, 16, 3, 5] * 50), op7_jaccard.staged

    def changing(rows, name):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(next(cores)))
        return plain(rows, name)

    monkeypatch.setattr(op7_jaccard, "staged", changing)
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        kept = op7_jaccard.keep_one(docs)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
        assert sorted((r.doc_id for r in kept.collect()), key=str) == expected
    finally:
        for name in ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(name)
        if before is not None:
            spark.conf.set("spark.sql.files.minPartitionNum", before)


@pytest.mark.parametrize("block", [2048, 16])
def test_links_classes_and_copies(stored, near_rows, monkeypatch, block):
    monkeypatch.setattr(op7_jaccard, "BLOCK", block)
    docs = stored(near_rows)
    got = [tuple(r) for r in op7_jaccard.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(slow_classes(near_rows), key=str)


def test_one_of_each_class_stays(stored, near_rows):
    docs = stored(near_rows)
    kept = op7_jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({c for _, c, _, _ in slow_classes(near_rows)}, key=str)
    assert op7_jaccard.keep_one(docs.limit(0)).count() == 0
    nameless = stored([(None, "a b c d e f"), (None, "a b c d e f"), (None, "g h")], 1)
    assert op7_jaccard.keep_one(nameless).count() == 2


def test_posterior_bounds():
    least = op7_jaccard.least_matches(0.8)
    assert least[25] == max(m for m in range(26) if _tail(m - 1, 25) < op7_jaccard.TOLERANCE) and (least[1:] <= range(1, 126)).all()


def _tail(m, n):
    """P(similarity >= 0.8) after m matches of n, by summing the posterior on a fine grid."""
    grid = [(i + 0.5) / 4000 for i in range(4000)]
    weight = [x ** m * (1 - x) ** (n - m) for x in grid] if m >= 0 else [float(x < 0) for x in grid]
    return sum(w for x, w in zip(grid, weight) if x >= 0.8) / (sum(weight) or 1)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys((200, 201, 202), 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


EXACT = [(1, "a"), (2, "b"), (2, "b"), (3, None), (4, ""), (None, "a"), (None, "z"), (5, "a"), (6, "c"), (7, "d"), (8, "c")]


def slow_exact(rows):
    out = []
    for doc_id, text in rows:
        same = [d for d, t in rows if (t or "") == (text or "")]
        out.append((doc_id, max((d for d in same if d is not None), default=None), len(same),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_copies_over_several_triggers(spark, stored, tmp_path, weak):
    path = str(tmp_path / "documents.parquet")
    for part in (EXACT[:5], EXACT[5:]):
        stored(part, 1).write.mode("append").parquet(path)
    digest = (lambda t: F.crc32(t) % 2) if weak else op8_exact.sha256
    got = op8_exact.deduplicate(spark, path, digest, max_bytes=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == slow_exact(EXACT)
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len({sha for _, sha in kept}) == 6 and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_a_stream_goes_on_where_it_stopped(spark, stored, tmp_path):
    path, log, at = (str(tmp_path / x) for x in ("documents.parquet", "log", "at"))
    stored(EXACT[:5], 1).write.parquet(path)
    op8_exact.run_stream(spark, path, log, at)
    stored(EXACT[5:], 1).write.mode("append").parquet(path)
    op8_exact.run_stream(spark, path, log, at)
    assert sorted(r.size for r in op8_exact.classes(spark, log).collect()) == [1, 1, 2, 2, 2, 3]


def test_no_rows_no_groups(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    assert op8_exact.deduplicate(spark, str(tmp_path / "d")).collect() == []
