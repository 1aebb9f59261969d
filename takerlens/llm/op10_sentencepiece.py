"""SentencePiece by distinct chunk: pieces never cross the start of a white-space marker, so each distinct marked word is
segmented once and its ids are joined back by position. Decoding joins the pieces' texts the same way.

No piece holds a line break either, so chunks also end there, which leaves fewer distinct ones."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from takerlens.llm.blocks import Vocabulary, answered_apart, finished, id_type, lists, numbers, ragged
from takerlens.llm.staging import documents
from takerlens.llm.wordpieces import public_path

_MARK = "▁"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CHUNK = re.compile(rf"{_MARK}+[^{_MARK}\n]*|[^{_MARK}\n]+|\n")
_CLOSING = ".,;:!?"
_SPACED = re.compile(b" ( *[^ ]*)")


@lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = [p for p in map(loaded.id_to_piece, range(loaded.vocab_size())) if _MARK in p.lstrip(_MARK) or "\n" in p]
    if crossing:
        raise ValueError(f"pieces such as {crossing[0]!r} cross a white-space marker or a line break")
    return loaded


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, end to end; the library puts a marker before a text that is not empty."""
    return _CHUNK.findall(_MARK + text.replace(" ", _MARK)) if text else []


@lru_cache(maxsize=4)
def closing(path: str) -> re.Pattern:
    """Chunks of letters and then marks that no piece has after a letter: these are two chunks, which repeat more often."""
    library = processor(path)
    pieces = [library.id_to_piece(i) for i in range(library.vocab_size()) if not library.is_byte(i)]
    apart = [m for m in _CLOSING if not any(re.search(f"[{_LETTERS}]{re.escape(m)}", p) for p in pieces)]
    return re.compile(f"({_MARK}*[{_LETTERS}]+)([{''.join(apart)}]+)" if apart else "(?!)")


def spaced(text: bytes) -> list[bytes]:
    """The words of a text, each with the spaces before it but the first; `chunks_of` all words are those of the text."""
    text = text.replace(_MARK.encode(), b" ")
    if b"  " in text or text.startswith(b" "):
        return _SPACED.findall(b" " + text)
    return text.split(b" ") if text else []


def _parts(words: Iterable[bytes], two: re.Pattern) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct parts of chunks, and each word's numbers of parts and their places end to end."""
    parts: dict[str, int] = {}
    flat: list[int] = []
    size: list[int] = []
    for word in words:
        # The first marker is of the space that the word was split at, or the one before the text.
        marked = _MARK + word.decode()
        found = _CHUNK.findall(marked.replace(" ", _MARK)) if b"\n" in word or b" " in word else (marked,)
        before = len(flat)
        for chunk in found:
            if chunk[-1] in _CLOSING and (both := two.fullmatch(chunk)):
                flat += [parts.setdefault(part, len(parts)) for part in both.groups()]
            else:
                flat.append(parts.setdefault(chunk, len(parts)))
        size.append(len(flat) - before)
    return list(parts), np.array(size, np.int64), np.array(flat, np.int32)


def _chunk_reader(path: str):
    def chunks(ids: pa.Array, texts: list[bytes]) -> tuple[pa.Table, list[str], None]:
        words = dict.fromkeys(chain.from_iterable(map(spaced, texts)))
        return pa.table({"doc_id": ids}), _parts(words, closing(path))[0], None

    return chunks


def _reader(path: str):
    def positions(ids: pa.Array, texts: list[bytes]) -> tuple[pa.Table, list[str], None]:
        words = Vocabulary()
        index = [words.indices(spaced(text)) for text in texts]
        parts, size, flat = _parts(words, closing(path))
        starts = np.cumsum(size) - size
        return pa.table({"doc_id": ids, **numbers([ragged(flat, starts, size, row) for row in index])}), parts, None

    return positions


def _segmenter(path: str):
    def segment(chunks: list[bytes], _) -> tuple[np.ndarray, np.ndarray]:
        library = processor(path)
        # After a line break the library adds no marker; its own marker and the break are the first two ids.
        ids = [x[2:] for x in library.encode(["\n" + x.decode() for x in chunks], num_threads=1)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return size, np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))

    return segment


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) for each row of `docs`, exactly the library's.

    NULL and empty texts have no ids; repeated rows and NULL ids give a row each; other columns are ignored.
    """
    return _encoded(docs, path or public_path("piece_bpe_32k.model"), _ids_rows, "ids array<int>")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of `docs`; see `encode` for unusual rows."""
    path = path or public_path("piece_bpe_32k.model")

    def digests(data: pa.Table, size: np.ndarray, flat: np.ndarray) -> pa.Table:
        return _digest_rows(data, size, flat, processor(path))

    return _encoded(docs, path, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(docs: DataFrame, path: str, finish, columns: str) -> DataFrame:
    return finished(answered_apart(docs, _reader(path), _segmenter(path), _chunk_reader(path)), finish, f"doc_id {id_type(docs)}, {columns}")


def _ids_rows(data: pa.Table, size: np.ndarray, flat: np.ndarray) -> pa.Table:
    starts = np.cumsum(size) - size
    ids = [ragged(flat, starts, size, index) for index in lists(data)]
    return pa.table({"doc_id": data.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))})


def _digest_rows(data: pa.Table, size: np.ndarray, flat: np.ndarray, library) -> pa.Table:
    ends = np.cumsum(size).tolist()
    every = flat.tolist()
    ids = [every[end - n:end] for end, n in zip(ends, size.tolist())]
    digits = list(map(str, range(library.vocab_size())))
    written = [",".join([digits[i] for i in x]) for x in ids]
    # A chunk is whole characters, so byte pieces never join across chunks.
    line_break = library.encode("\n")[1:]
    spelled = [x[1:] for x in library.decode([line_break + x for x in ids])] if ids else []
    n_tokens, ids_sha, text_sha = [], [], []
    for index in lists(data):
        n_tokens.append(int(size[index].sum()))
        chunks = index.tolist()
        ids_sha.append(hashlib.sha256(",".join(map(written.__getitem__, chunks)).encode()).hexdigest())
        text_sha.append(hashlib.sha256("".join(map(spelled.__getitem__, chunks))[1:].encode()).hexdigest())
    return pa.table({"doc_id": data.column("doc_id"), "n_tokens": pa.array(n_tokens, pa.int64()),
                     "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())})


def op10_distinct_chunk_pieces(spark, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))
