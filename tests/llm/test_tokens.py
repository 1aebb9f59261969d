"""Token counts, SentencePiece ids and packed pieces against the libraries themselves."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from takerlens.llm import op4_tokens, op6_packing, op10_sentencepiece, wordpieces
from tests.llm.conftest import babble

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")

ODD = [" ", "\n", "\t", "▁", "a", "b'", "s.", "!", "<|endoftext|>", "<|STARTOFTEXT|>", "é", "É", "ß", "İ", "Σ", "ς", "́", "\x00", "\x1c",
       "\x85", "\xa0", " ", "字", "が", "９", "½", "​", "😀", "l'eau", "Word,"]


@pytest.fixture(scope="module")
def rows(samples):
    return samples + [(20_000 + i, t) for i, t in enumerate(babble(ODD, 400, 40, 3))]


def test_counts_are_the_librarys(stored, rows):
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in op4_tokens.count_tokens(stored(rows)).collect()), key=str)
    n = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows]
    assert got == sorted(((i, b, k, k > 2048) for i, b, k in n), key=str)
    assert op4_tokens.count_tokens(stored(rows).limit(0)).count() == 0


def test_words_of_letters_share_a_text(monkeypatch):
    """The library is called for texts of many words, not word by word, and each word gets its own ids."""
    path = public.path("word_bpe_49k.json")
    library, asked = wordpieces.tokenizer(path), []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(library, name)

    monkeypatch.setattr(wordpieces, "tokenizer", lambda path: Counted())
    words = sorted({w.encode() for w in [*babble("abcdeéñßÿ", 3000, 12, 4), *ODD, "", "don't", "x.y", "A", "</w>", "a</w>"]})
    size, flat = wordpieces.encoder(path, count_only=False)(words, None)
    expected = [library.encode(w.decode(), add_special_tokens=False).ids for w in words]
    assert size.tolist() == list(map(len, expected)) and flat.tolist() == sum(expected, [])
    assert wordpieces.encoder(path, count_only=True)(words, None)[0].tolist() == size.tolist()
    assert len(asked) < 2 * (len(words) / 100 + 60)
    size, flat = wordpieces.encoder(path, count_only=False)([], None)
    assert len(size) == len(flat) == 0


def test_a_vocabulary_that_marks_no_ends(tmp_path):
    """Words go to such a library one by one."""
    letters = {c: i for i, c in enumerate("abc")}
    library = tokenizers.Tokenizer(tokenizers.models.BPE(letters | {"ab": 3}, [("a", "b")]))
    library.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
    library.save(path := str(tmp_path / "plain.json"))
    size, flat = wordpieces.encoder(path, count_only=False)([b"aab", b"c", b"cab"], None)
    assert size.tolist() == [2, 1, 2] and flat.tolist() == [0, 3, 2, 2, 3]


def test_chunks_and_pretokens_spell_the_texts():
    texts = [t.encode() for t in ["", " ", *babble([*ODD, " ", "\x0b", "Éa", "x!?", "Ab.", "×", "."], 300, 30, 8), "  "]]
    chunks, place, n = wordpieces.chunked(texts)
    spelled = [c.encode() for c in chunks.take(pa.array(place)).to_pylist()]
    assert [spelled[end - k:end] for end, k in zip(np.cumsum(n).tolist(), n.tolist())] == [t.split() for t in texts]
    words, pairs = wordpieces.pretokens(chunks)
    assert len(set(words)) == len(words)
    for chunk, (word, mark) in zip(chunks.to_pylist(), pairs.tolist()):
        plain = re.fullmatch("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)", chunk)
        assert (words[word], words[mark] if mark >= 0 else "") == ((plain[1].lower(), plain[2]) if plain else (chunk, ""))
    assert wordpieces.pretokens([])[0] == [] and len(wordpieces.chunked([b" ", b""])[0]) == 0


def test_ids_and_decoding_are_the_librarys(stored, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))

    def expected(doc_id, text):
        ids = library.encode(text or "")
        return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    docs = stored(rows)
    got = [tuple(r) for r in op10_sentencepiece.encode_digests(docs).collect()]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows), key=str)
    ids = {r.doc_id: r.ids for r in op10_sentencepiece.encode(docs).collect()}
    assert all(ids[i] == library.encode(t or "") for i, t in rows if i is not None)
    assert op10_sentencepiece.encode(docs.limit(0)).count() == 0


def test_chunks_spell_the_marked_text():
    for text in babble([" ", "  ", "\n", "▁", "a", "b.", "é"], 500, 20, 5):
        assert "".join(op10_sentencepiece.chunks_of(text)) == ("▁" + text.replace(" ", "▁") if text else "")


def test_words_hold_the_chunks_of_the_text():
    for text in ["", " ", "a", "a ", "  a", *babble([" ", "  ", "\n", "▁", "a", "b.", "é,", "\t"], 500, 20, 6)]:
        words = op10_sentencepiece.spaced(text.encode())
        parts, size, flat = op10_sentencepiece._parts(words, op10_sentencepiece.re.compile("(?!)"))
        assert len(size) == len(words) and [parts[i] for i in flat] == op10_sentencepiece.chunks_of(text)


def test_a_text_is_matched_by_distinct_word_and_once(monkeypatch):
    """Each use of a word costs a lookup; only distinct ones meet the pattern, and one of two scans has no places to note."""
    path = public.path("piece_bpe_32k.model")
    met, placed = [], []
    pattern, numbers = op10_sentencepiece._CHUNK, op10_sentencepiece.numbers

    class Counting:
        def findall(self, text):
            met.append(text)
            return pattern.findall(text)

    monkeypatch.setattr(op10_sentencepiece, "_CHUNK", Counting())
    monkeypatch.setattr(op10_sentencepiece, "numbers", lambda index: placed.append(index) or numbers(index))
    text = ("one two, three\nfour " * 1000).encode()
    table, chunks, _ = op10_sentencepiece._reader(path)(pa.array([1, 2]), [text, text])
    assert sum(map(len, met)) < 100 and len(placed) == 1
    assert op10_sentencepiece._chunk_reader(path)(pa.array([1, 2]), [text, text])[1] == chunks and len(placed) == 1


def test_pieces_and_places(stored, rows):
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    expected = []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected += [(doc_id, k, lo, len(ids[lo:lo + 4096]), zlib.crc32(ids[lo:lo + 4096].tobytes()))
                     for k, lo in enumerate(range(0, len(ids), 4096))]
    got = op6_packing.pack_documents(stored(rows)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-sum(e[3] for e in expected) // 4096) * 1.02 + 1


def slow_sum_of_squares(lengths, capacity):
    """Every choice tried in full."""
    levels, out = [], []
    for s in lengths:
        def squares(now):
            return sum(now.count(g) ** 2 for g in set(now) if g < capacity)
        choices = [(squares(levels + [s]), 1, 0, None)]
        for i, g in enumerate(levels):
            if g < capacity and g + s <= capacity:
                choices.append((squares(levels[:i] + [g + s] + levels[i + 1:]), 0, -g, i))
        best = min(choices, key=lambda c: c[:3])
        fill = -best[2]
        if best[3] is None:
            levels.append(s)
        else:
            levels[best[3]] += s
        out.append(fill)
    return out, levels


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(2)
    for _ in range(40):
        lengths = rng.integers(1, 13, 40)
        sequence, offset = op6_packing.sum_of_squares(lengths, 12)
        fills, levels = slow_sum_of_squares(lengths.tolist(), 12)
        assert offset.tolist() == fills
        assert sorted(np.bincount(sequence, lengths).astype(int).tolist()) == sorted(levels)


def test_many_buckets_leave_few_loose_sequences(spark, stored):
    rng = np.random.default_rng(4)
    lengths = np.clip(rng.lognormal(5.5, 1.2, 3000).astype(int), 1, 4096)
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    got = op6_packing.pack(rows, bucket=100).collect()
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in used.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(got) == 3000 and len(used) <= lengths.sum() / 4096 * 1.05 + 2
