"""Phrase collocations from bidirectional FM-indexes over word ids.

A shard is a block of documents of bounded size. Words that are rare in the whole corpus cannot be part of a frequent
phrase, so they only separate: every shard counts its words, the counts meet in one shuffle, and a shard gets back which of
its words stay. Over their ids it builds a Burrows-Wheeler transform of its text and of the reversed text. An interval of
one with its mirror in the other stands for a phrase; extending it by a word to the right or to the left gives the longer
phrases with their counts, level by level up to the longest phrase wanted. Suffixes need no more order than that, so
repeats of any length cost nothing.

Counts of shards are added up per phrase. They travel as sorted packs, one per shard and bucket of phrases; a phrase has at
most one entry a shard, so no phrase is hot, and a bucket holds about `BUCKET` entries however large the corpus is.

An executor holds a shard's index and phrases per core, so they are 32-bit numbers, phrases are extended some at a time, and
a worker gives back what a shard took.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from takerlens.llm.blocks import Vocabulary, packed, released, unpacked
from takerlens.llm.staging import documents, staged

LONGEST, LEAST, INSIDE, FIRST = 3, 10, 50, 2000
SHARD_BYTES = 16 << 20
BUCKET = 2_000_000
PLACES = 500_000
MILLION = 1_000_000
_BREAK = b"\xff"  # no byte of UTF-8
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz" + _BREAK * len(_BREAKS))


def words_of(text: bytes) -> list[bytes]:
    """Words, and b"\\xff" where a piece ends."""
    return text.translate(_FOLD).replace(_BREAK, b" \xff ").split()


class Index:
    """Bidirectional FM-index of a sequence over 0 .. symbols - 1, where 0 separates, for phrases of up to `depth` symbols.

    An interval (lo, rlo, size) has the phrase's place among the sorted suffixes of the text, that of the reversed phrase
    among those of the reversed text, and how often the phrase occurs.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.symbols, self.n = symbols, len(text)
        self.bwt = _transform(text, symbols, depth)
        self.mirror = _transform(text[::-1], symbols, depth)
        counts = np.bincount(text, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self._at: list[np.ndarray | None] = [None, None]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """symbol, lo, rlo, size of each symbol that occurs."""
        size = np.diff(self.first)
        symbol = 1 + np.flatnonzero(size[1:])
        return symbol, self.first[symbol], self.first[symbol], size[symbol]

    def _rank(self, side: int, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        if self._at[side] is None:
            # Occurrences of each symbol in a transform, as symbol * n + place: sorted, so a rank is a binary search.
            at = (self.bwt, self.mirror)[side].astype(np.int64)
            at *= self.n
            at += np.arange(self.n, dtype=np.int32)
            at.sort()
            self._at[side] = at
        return np.searchsorted(self._at[side], symbol * self.n + place) - self.first[symbol]

    def extended(self, side: int, lo: np.ndarray, rlo: np.ndarray, size: np.ndarray):
        """Every phrase with one word more, on the left (side 0) or right (side 1).

        Returns which phrase was extended, by which symbol, and the new lo, rlo and size.
        """
        if side:
            of, symbol, rlo, lo, size = self._grown(1, rlo, lo, size)
        else:
            of, symbol, lo, rlo, size = self._grown(0, lo, rlo, size)
        return of, symbol, lo, rlo, size

    def counted(self, side: int, lo: np.ndarray, rlo: np.ndarray, size: np.ndarray):
        """`extended` without the new places: which phrase was extended, by which symbol, and the new size."""
        of, symbol, count, _ = self._joined(self._next(side, rlo if side else lo, size))
        return of, symbol, count

    def _grown(self, side: int, here: np.ndarray, there: np.ndarray, size: np.ndarray):
        def placed():
            for of, symbol, count, smaller in self._next(side, here, size):
                yield of, symbol, self.first[symbol] + self._rank(side, symbol, here[of]), there[of] + smaller, count

        return self._joined(placed())

    def _next(self, side: int, here: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """What stands next to some of the phrases at a time: which phrase, symbol, how often, and how often a smaller one."""
        transform, through = (self.bwt, self.mirror)[side], np.cumsum(size, dtype=np.int64)
        lo = 0
        while not lo or lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(through, (through[lo - 1] if lo else 0) + PLACES, "right")))
            each = size[lo:hi].astype(np.int64)
            begins = np.cumsum(each) - each
            at = np.repeat(here[lo:hi] - begins, each)
            at += np.arange(len(at))
            found = transform[at]
            del at
            key = np.repeat(np.arange(len(each)) * self.symbols, each)
            key += found
            key.sort()
            start = np.flatnonzero(np.diff(key, prepend=-1))
            count = np.diff(start, append=len(key))
            of, symbol = np.divmod(key[start], self.symbols)
            smaller = start - begins[of]  # extensions of the same phrase by smaller symbols
            real = symbol > 0
            yield of[real] + lo, symbol[real], count[real], smaller[real]
            lo = hi

    @staticmethod
    def _joined(parts: Iterator[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        kept = [[x.astype(np.int32) for x in part] for part in parts]
        return tuple(np.concatenate(column) for column in zip(*kept))


def _transform(text: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """The symbol before each suffix, suffixes sorted by `depth` symbols; the text runs in a circle and ends with 0."""
    text = text.astype(np.int32)
    n, rank, have = len(text), text, 1
    while True:
        more, more_have = (rank, have) if depth - have > 1 else (text, 1)
        key = rank.astype(np.int64)
        key *= int(more.max(initial=0)) + 1
        key += np.roll(more, -have)
        have += more_have
        if int(key.max(initial=0)) < (1 << 62) // n:
            key *= n
            key += np.arange(n, dtype=np.int32)
            key.sort()
            order = (key % n).astype(np.int32)
            key //= n
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
        if have >= depth:
            return text[order - 1]
        rank = np.empty_like(text)
        rank[order] = np.cumsum(np.diff(key, prepend=key[:1]) > 0, dtype=np.int32)


def phrases(index: Index, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 2 to `longest`, the phrases (a column per word) and their counts.

    Words are extended to the right, the pairs to the left, and so on in turn.
    """
    symbol, *interval = index.words()
    found, side = symbol[:, None].astype(np.int32), 1
    for length in range(2, longest + 1):
        if length < longest:
            of, symbol, *interval = index.extended(side, *interval)
            size = interval[2]
        else:
            of, symbol, size = index.counted(side, *interval)
            del interval, index
        found = np.column_stack([found[of], symbol] if side else [symbol, found[of]])
        del of, symbol
        yield found, size
        side = 1 - side


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """shard, lang, idx, word, n, payload: the distinct words of each shard with their counts, and one payload a shard.

    A payload is the shard's text as word numbers from 1, 0 where a piece ends.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, text, size, number = {}, [], 0, None
        for batch in batches:
            for row, lang, data in zip(*(c.to_pylist() for c in batch.columns)):
                number = row if number is None else number
                own = known.setdefault(lang, (Vocabulary({_BREAK: 0}), []))
                own[1].append(own[0].indices(words_of(data)))
                own[1].append(np.zeros(1, np.int32))
                size += len(data)
                if size >= shard_bytes:
                    yield from shard(number, known)
                    known, size, number = {}, 0, None
                    del own
                    released()
        if known:
            yield from shard(number, known)
        known = {}
        released()

    def shard(number: int, known: dict) -> Iterator[pa.RecordBatch]:
        text, before = [], 0
        for lang, (words, parts) in known.items():
            ids, n = np.concatenate(parts), len(words) - 1
            if n:
                counts = np.bincount(ids, minlength=n + 1)[1:]
                spelling = list(words)
                for lo in range(0, n, 100_000):
                    part = spelling[1 + lo:1 + lo + 100_000]
                    k = len(part)
                    yield _rows(shard=np.full(k, number), lang=[lang] * k, idx=np.arange(before + lo + 1, before + lo + k + 1),
                                word=part, n=counts[lo:lo + k], payload=[None] * k)
            text.append(np.where(ids > 0, ids + before, 0))
            before += n
        data = packed(pa.table({"text": np.concatenate(text).astype(np.int32)}))
        yield _rows(shard=[number], lang=[None], idx=[0], word=[None], n=[None], payload=[data])

    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        rows, "shard long, lang string, idx int, word binary, n long, payload binary")


def _rows(**columns) -> pa.RecordBatch:
    kinds = {"shard": pa.int64(), "lang": pa.string(), "idx": pa.int32(), "word": pa.binary(), "n": pa.int64(),
             "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[k], kind) for k, kind in kinds.items()], list(kinds))


def counted(cut: DataFrame, frequent: DataFrame, longest: int, buckets: int) -> DataFrame:
    """bucket, words (how many), pack: counts of each shard's phrases of words of `frequent` (lang, word, id)."""

    def shard(payload: pa.Table, known: pa.Table) -> pa.Table:
        out = {"bucket": [], "words": [], "pack": []}
        if payload.num_rows and known.num_rows:
            known = known.sort_by("id")  # a shard's numbers grow with the ids
            ids = np.concatenate([[0], known.column("id").to_numpy()])
            text = _narrowed(payload, known.column("idx").to_numpy())
            for found, count in phrases(Index(text, len(ids), longest), longest):
                for bucket, pack in _packs(found, ids, count, buckets):
                    out["bucket"].append(bucket)
                    out["words"].append(found.shape[1])
                    out["pack"].append(pack)
            del found, count
        released()
        return pa.table([pa.array(out["bucket"], pa.int32()), pa.array(out["words"], pa.int32()), pa.array(out["pack"], pa.binary())],
                        list(out))

    known = cut.where("idx > 0").join(frequent, ["lang", "word"]).select("shard", "idx", "id")
    payload = cut.where("idx = 0").select(F.col("shard").alias("of"), "payload")
    return payload.groupBy("of").cogroup(known.groupBy("shard")).applyInArrow(shard, "bucket int, words int, pack binary")


def _narrowed(payload: pa.Table, idx: np.ndarray) -> np.ndarray:
    """A shard's text in the words numbered `idx`, from 1; all else separates, once at a time and at the end."""
    text = unpacked(payload.column("payload")[0].as_py()).column("text").to_numpy()
    symbol = np.zeros(max(int(text.max(initial=0)), int(idx.max())) + 1, np.int32)
    symbol[idx] = np.arange(1, len(idx) + 1)
    text = symbol[text]
    return np.append(text[(text > 0) | (np.roll(text, 1) > 0)], np.int32(0))


def _packs(found: np.ndarray, ids: np.ndarray, count: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Phrases of numbers into `ids` (ascending) dealt by a hash of their ids, in each bucket sorted, as compressed columns."""
    mixed = np.zeros(len(found), np.uint64)
    for column in found.T:
        mixed ^= ids[column].astype(np.uint64)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    mixed %= np.uint64(buckets)
    bucket = mixed.astype(np.int32)
    del mixed
    order = np.lexsort([*found.T[::-1], bucket]).astype(np.int32)
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        rows = order[lo:hi]
        part = ids[found[rows]]
        columns = {"word0": np.diff(part[:, 0], prepend=0)}  # sorted: steps are small
        columns |= {f"word{k}": part[:, k] for k in range(1, part.shape[1])}
        yield int(bucket[rows[0]]), packed(pa.table({**columns, "n": count[rows].astype(np.int64)}))


def summed(packs: DataFrame, least: int) -> DataFrame:
    """words (ids), n: phrases that occur `least` times or more in all shards together."""

    def bucket(table: pa.Table) -> pa.Table:
        parts = [unpacked(p) for p in table.column("pack").to_pylist()]
        words = table.column("words")[0].as_py()
        columns = [np.concatenate([p.column(f"word{k}").to_numpy() for p in parts]) for k in range(1, words)]
        columns = [np.concatenate([np.cumsum(p.column("word0").to_numpy()) for p in parts]), *columns]
        n = np.concatenate([p.column("n").to_numpy() for p in parts])
        del parts
        order, new = np.lexsort(columns[::-1]), False
        for k, c in enumerate(columns):
            columns[k] = c = c[order]
            new |= np.diff(c, prepend=c[0] - 1) != 0
        first = np.flatnonzero(new)
        n = np.add.reduceat(n[order], first)
        del order, c
        often = n >= least
        flat = np.column_stack([c[first[often]] for c in columns]).ravel()
        del columns
        released()
        ends = np.arange(0, len(flat) + 1, words, dtype=np.int32)
        return pa.table({"words": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "n": pa.array(n[often])})

    return packs.groupBy("bucket", "words").applyInArrow(bucket, "words array<long>, n long")


def scored(grams: DataFrame, inside: int) -> DataFrame:
    """words, a, l, r, score of the candidates in `grams` (words, n), which also holds the single words.

    A part of a phrase is at least as frequent as the phrase, so it is in `grams` as well. Of all longer candidates around
    a phrase it is enough to look at those with one word more: what lies further out is no more frequent.
    """
    size = F.size("words")
    candidates = grams.where(size > 1)
    cuts = candidates.select("words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("head"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail"))
    parts = (cuts.join(grams.select(F.col("words").alias("head"), F.col("n").alias("l")), "head")
             .join(grams.select(F.col("words").alias("tail"), F.col("n").alias("r")), "tail"))
    lowest = parts.withColumn("score", exact_score(F.col("a"), F.col("l"), F.col("r"))).groupBy("words").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    around = candidates.where(size > 2).select("n", F.explode(F.array(
        F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"))
    around = around.groupBy("words").agg(F.max("n").alias("longer"))
    kept = lowest.join(around, "words", "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside) * F.col("cut.a")))
    return kept.select("words", "cut.a", "cut.l", "cut.r", "cut.score")


def exact_score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in 38 digits: exact for counts below 10^15."""
    wide = "decimal(38,0)"
    above = (a.cast("decimal(16,0)") * a.cast("decimal(16,0)")).cast(wide) * F.lit(MILLION).cast("decimal(7,0)")
    return F.call_function("div", above, (l.cast("decimal(18,0)") * r.cast("decimal(18,0)")).cast(wide))


def spelled(found: DataFrame, frequent: DataFrame) -> DataFrame:
    """`found` with lang and phrase in place of word ids."""
    each = found.select("words", F.posexplode("words").alias("pos", "id")).join(
        frequent.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    text = each.groupBy("words").agg(F.first("lang").alias("lang"), phrase.alias("phrase"))
    return found.join(text, "words").drop("words")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE,
                 shard_bytes: int = SHARD_BYTES, bucket: int = BUCKET) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every candidate phrase of `docs` (lang, text), without any limit.

    Letters A-Z count as a-z. Pieces lie between `.,;:!?` and line breaks, words between blanks and tabs; all else is part of
    a word. Everything is per lang, NULL being `und`; an empty lang is one of its own. Repeated rows count again; NULL and
    empty texts have no words; ids and other columns are not read; no rows give none. Candidates have 2 to `longest` words
    and occur `least` times or more. One is left out if a longer candidate around it is at least `inside` percent as
    frequent. Of its cuts in two the one with the lowest score counts, then the one with the shorter first part.
    `docs` must be a stored table: shards are named by place in the scan, which is read once.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur at least once")
    cut = staged(shards(docs, shard_bytes), "shards")
    words = cut.where("idx > 0").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = staged(words, "words")
    # Numbers for frequent words: positions in a stored table, so they stay the same for all that follows.
    frequent = staged(words.where(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id() + 1), "frequent")
    occurrences = frequent.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, min(-(-occurrences * (longest - 1) // bucket), 1 << 30))
    grams = summed(counted(cut, frequent.select("lang", "word", "id"), longest, buckets), least)
    grams = staged(grams.unionByName(frequent.select(F.array("id").alias("words"), "n")), "phrases")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return spelled(scored(grams, inside), frequent).join(total, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top(found: DataFrame, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each lang by score, frequency and spelling.

    Partitions drop what cannot be among the first before anything moves.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_fm_index_collocations(spark, sf_dir: str) -> DataFrame:
    return top(collocations(documents(spark, sf_dir)))


OP11_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents),
split AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
counts AS MATERIALIZED (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3)) AS lengths(k) WHERE i + k - 1 <= len(w))
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= {LEAST}),
cuts AS (SELECT lang, phrase, f, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS tail FROM often WHERE k > 1
  UNION ALL SELECT lang, phrase, f, 2, array_to_string(w[:2], ' '), w[3] FROM often WHERE k = 3),
scores AS (SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, c.k,
    ({MILLION}::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = c.head JOIN often r ON r.lang = c.lang AND r.phrase = c.tail),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS phrase, f FROM often WHERE k = 3),
longer AS (SELECT lang, phrase, max(f) AS f FROM around GROUP BY ALL),
kept AS (SELECT lang, lowest.phrase, a, l, r, score FROM lowest LEFT JOIN longer USING (lang, phrase)
  WHERE longer.f IS NULL OR 100 * longer.f < {INSIDE} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {FIRST}"""
