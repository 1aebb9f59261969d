"""Personal data behind disguises, at its place in the source.

A chain of transducers rewrites a text: invisible characters go, look-alike letters and digits become ASCII, spelled
digits become figures, and written-out "at" and "dot" become signs. Each keeps the list of its edits, so a span of the
rewritten text maps back to the source characters it came from. Identifiers are then found by the same patterns as in
plain text; a disguise counts only where it completes an identifier.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.staging import documents

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_TOP = re.compile(r"\.(?!dot$)[A-Za-z]{2,24}$")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[Span]:
    # Anchored at the sign: a long run without one is never searched.
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield "email", start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Identifiers written plainly, leftmost and not overlapping within a kind, by start and kind."""
    found = list(_emails(text))
    if any(d in text for d in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.groups()):
                found.append(("ip", *m.span()))
        for m in _DIGIT_CHAIN.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return _ordered(found)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Tape:
    """A rewritten text and where each stretch of it came from."""

    def __init__(self, text: str):
        self.text = text
        self._starts, self._sources, self._copied = [0], [0], [True]
        self._source_length = len(text)

    def rewrite(self, edits: Iterator[tuple[int, int, str]]) -> Tape:
        """A new tape with text[start:end] replaced for each edit, in order and not overlapping; self if there is none."""
        parts, starts, sources, copied = [], [], [], []
        size = done = 0

        def keep(lo: int, hi: int) -> None:
            nonlocal size
            k = bisect_right(self._starts, lo) - 1
            while lo < hi:
                stop = min(hi, self._starts[k + 1] if k + 1 < len(self._starts) else hi)
                starts.append(size)
                sources.append(self._sources[k] + (lo - self._starts[k] if self._copied[k] else 0))
                copied.append(self._copied[k])
                size += stop - lo
                lo, k = stop, k + 1

        for lo, hi, new in edits:
            if lo > done:
                keep(done, lo)
            parts += [self.text[done:lo], new]
            if new:
                starts.append(size)
                sources.append(self.source(lo, hi)[0])
                copied.append(False)
                size += len(new)
            # What is removed belongs to the character before it.
            done = hi
        if not parts:
            return self
        if done < len(self.text):
            keep(done, len(self.text))
        out = Tape("".join([*parts, self.text[done:]]))
        out._starts, out._sources, out._copied = starts or [0], sources or [0], copied or [True]
        out._source_length = self._source_length
        return out

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        """The source span of text[lo:hi]: from its first character's place to the end of its last one's."""
        first = bisect_right(self._starts, lo) - 1
        last = bisect_right(self._starts, hi - 1) - 1
        start = self._sources[first] + (lo - self._starts[first] if self._copied[first] else 0)
        if self._copied[last]:
            return start, self._sources[last] + hi - self._starts[last]
        end = self._sources[last + 1] if last + 1 < len(self._sources) else self._source_length
        return start, end


# Letters of other scripts that look like ASCII ones (compatibility forms come from Unicode's own table).
_LOOKS = dict(zip("авекмнорстухіјѕԁɡһԛԝАВЕКМНОРСТУХІЈЅԌΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρτυχιѵⅼӏ",
                  "abekmhopctyxijsdghqwABEKMHOPCTYXIJSGABEZHIKMNOPTYXaovptuxivll", strict=True))
_HIDDEN = re.compile("[­​-‏⁠-⁤﻿]+")
_FOREIGN = re.compile("[Ā-￿\U0001d400-\U0001d7ff\U0001f100-\U0001f1ff]")
_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
          "seven": "7", "eight": "8", "nine": "9"}
_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_GAP = r"[ \t]{0,2}[-,.]?[ \t]{0,2}"
# Seven in a row are no prose.
_SPELLED = re.compile(rf"(?i)(?<![^\W_]){_WORD}(?:{_GAP}{_WORD})+(?![^\W_])")
# Any number of them; a full stop between them stays, it may part an address.
_SPELLED_ANY = re.compile(rf"(?i)(?<![^\W_]){_WORD}(?:[ \t]{{0,2}}[-,]?[ \t]{{0,2}}{_WORD})*(?![^\W_])")
_ONE_SPELLED = re.compile(rf"(?i){_WORD}")
_PLUS = re.compile(r"(?i)(?<![^\W_])plus[ \t]{1,2}(?=[0-9])")
_AT = re.compile(r"(?i)[ \t]{0,2}(?:\([ \t]?(?:at|@)[ \t]?\)|\[[ \t]?(?:at|@)[ \t]?\]|\{[ \t]?at[ \t]?\}|<at>)[ \t]{0,2}"
                 r"|(?<=[A-Za-z0-9])[ \t]{1,2}@[ \t]{1,2}(?=[A-Za-z0-9])"
                 r"|(?<=[A-Za-z0-9])[ \t]{1,2}at[ \t]{1,2}(?=[A-Za-z0-9-]{1,63}[ \t]{0,2}(?:[\[({<][ \t]?(?:dot|\.)|dot[ \t]))")
_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9])[ \t]{0,2}(?:\([ \t]?(?:dot|\.)[ \t]?\)|\[[ \t]?(?:dot|\.)[ \t]?\]|\{[ \t]?(?:dot|\.)[ \t]?\}|<dot>)[ \t]{0,2}(?=[A-Za-z0-9])"
                  r"|(?<=[A-Za-z0-9])[ \t]{1,2}dot[ \t]{1,2}(?=[A-Za-z0-9])")
_BARE_AT = re.compile(r"(?i)(?<=[A-Za-z0-9])[ \t]{1,2}at[ \t]{1,2}(?=[A-Za-z0-9])")
_HOST = re.compile(r"(?i)[A-Za-z0-9-]{1,63}(?:(?:\.|[ \t]{1,2}dot[ \t]{1,2}|[ \t]{0,2}(?:\([ \t]?(?:dot|\.)[ \t]?\)|\[[ \t]?(?:dot|\.)[ \t]?\]"
                   r"|\{[ \t]?(?:dot|\.)[ \t]?\}|<dot>)[ \t]{0,2})[A-Za-z0-9-]{1,63}){1,20}")
# No plain word: names joined by a sign, or a name with a number.
_NAME = re.compile(r"(?<![A-Za-z0-9._%+-])(?:[A-Za-z0-9-]*[A-Za-z][A-Za-z0-9-]*[._%+][A-Za-z0-9._%+-]*|[A-Za-z]{2,}[0-9]+)$")


def _unhide(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _HIDDEN.finditer(text):
        yield *m.span(), ""


def _look_alikes(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _FOREIGN.finditer(text):
        plain = _LOOKS.get(m[0]) or unicodedata.normalize("NFKC", m[0])
        if plain != m[0] and len(plain) == 1 and plain.isascii():
            yield *m.span(), plain
        elif unicodedata.category(m[0]) == "Nd":
            yield *m.span(), str(unicodedata.digit(m[0]))
        elif m[0] in "‐‑‒–—−":
            yield *m.span(), "-"


# Each search below is slow beside a look for what it cannot do without.
_TWO_WORDS = re.compile(rf"\b{_WORD}\b[-., \t]{{1,5}}{_WORD}\b")
_DISGUISED_AT = ("(at", "( at", "[at", "[ at", "{at", "{ at", "<at", "(@", "( @", "[@", "[ @", " @", "\t@", "dot", "(.", "[.", "{.")
_DISGUISED_DOT = ("dot", "(.", "( .", "[.", "[ .", "{.", "{ .")


def _figures(text: str) -> Iterator[tuple[int, int, str]]:
    if _TWO_WORDS.search(text.lower()):
        for m in _SPELLED.finditer(text):
            words = _ONE_SPELLED.findall(m[0])
            if len(words) >= 7:
                yield *m.span(), "".join(_WORDS[w.lower()] for w in words)


def _all_figures(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SPELLED_ANY.finditer(text):
        yield *m.span(), "".join(_WORDS[w.lower()] for w in _ONE_SPELLED.findall(m[0]))


def _signs(text: str) -> Iterator[tuple[int, int, str]]:
    if re.search(r"plus[ \t]{1,2}[0-9]", text.lower()):
        for m in _PLUS.finditer(text):
            yield *m.span(), "+"


def _ats(text: str) -> Iterator[tuple[int, int, str]]:
    low = text.lower()
    found = set()
    if any(x in low for x in _DISGUISED_AT):
        found.update(m.span() for m in _AT.finditer(text))
    for m in _BARE_AT.finditer(text):
        host = _HOST.match(text, m.end())
        # A plain host needs a local part that is no plain word.
        if host and (re.search(r"[^A-Za-z0-9.-]", host[0]) or _NAME.search(text[max(0, m.start() - 65):m.start()])):
            found.add(m.span())
    for lo, hi in sorted(found):
        yield lo, hi, "@"


def _dots(text: str) -> Iterator[tuple[int, int, str]]:
    low = text.lower()
    if any(x in low for x in _DISGUISED_DOT):
        for m in _DOT.finditer(text):
            yield *m.span(), "."


CHAIN: tuple[Callable, ...] = (_unhide, _look_alikes, _figures, _signs, _ats, _dots)
# Spelled digits anywhere, also beside figures: what this shows counts where the first chain shows nothing.
WIDER: tuple[Callable, ...] = (_unhide, _look_alikes, _all_figures, _signs, _ats, _dots)


def added_spans(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that only the rewritten text shows, at their place in `text`, clear of the plain ones of their kind."""
    out: list[Span] = []
    seen = {text}
    for chain in (CHAIN, WIDER):
        tape = Tape(text)
        for step in chain:
            tape = tape.rewrite(step(tape.text))
        if tape.text not in seen:
            seen.add(tape.text)
            out = _ordered(out + _shown(text, tape, [*plain, *out]))
    return out


def _shown(text: str, tape: Tape, known: list[Span]) -> list[Span]:
    """Identifiers of a tape that are no plain ones and clear of the known ones of their kind."""
    out: list[Span] = []
    taken = {kind: sorted(s[1:] for s in known if s[0] == kind) for kind in KINDS}
    starts = {kind: [a for a, _ in spans] for kind, spans in taken.items()}
    for kind, lo, hi in plain_spans(tape.text):
        start, end = tape.source(lo, hi)
        if kind == "email" and not _TOP.search(tape.text, lo, hi):
            continue
        k = bisect_left(starts[kind], end) - 1  # the last known one that starts before this one ends
        if (k < 0 or taken[kind][k][1] <= start) and text[start:end] != tape.text[lo:hi]:
            out.append((kind, start, end))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, read: Callable[[str], tuple[list[Span], list[Span]]], kinds: tuple[str, ...]) -> DataFrame:
    """doc_id, a base count per kind, base_sha256, spans, n_added for each row of `docs`.

    `read(text)` gives the base spans and the added ones.
    """
    kind_of = docs.select("doc_id").schema[0].dataType.simpleString()
    schema = f"doc_id {kind_of}, {', '.join(f'n_{k} long' for k in kinds)}, base_sha256 string, spans string, n_added long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in kinds]
            shas, spans, added = [], [], []
            for text in batch.column(1).to_pylist():
                base, more = read(text)
                for kind, count in zip(kinds, counts):
                    count.append(sum(s[0] == kind for s in base))
                shas.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(sorted([*base, *more], key=lambda s: (s[1], kinds.index(s[0]), s[2]))))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()),
                 pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans", "n_added"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(rows, schema)


def _read(text: str) -> tuple[list[Span], list[Span]]:
    base = plain_spans(text)
    return base, added_spans(text, base)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row of `docs` (doc_id, text).

    Counts and the digest are of plainly written data; `spans` also has the disguised, as kind:start:end in code points.
    NULL texts count as empty and have none; repeated rows and NULL ids give a row each; other columns are ignored; work
    on a text is in proportion to its length.
    """
    return find(docs, _read, KINDS)


def masked(text: str | None) -> str | None:
    """`text` with each identifier replaced by its kind in angle brackets; NULL stays NULL.

    Where spans of two kinds overlap, the one that starts first is replaced together with what it overlaps.
    """
    if not text:
        return text
    base, more = _read(text)
    parts, done = [], 0
    for kind, start, end in _ordered([*base, *more]):
        if start >= done:
            parts += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in `text` masked; all rows and columns stay."""

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(masked)

    return docs.withColumn("text", mask("text"))


def op1_offset_preserving_pii(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))
