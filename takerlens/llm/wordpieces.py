"""Word-level BPE: pre-tokens of a text, and what each pre-token becomes.

White space always ends a token of these vocabularies, so a text is the sum of its chunks between ASCII white space. A
chunk of plain letters and closing punctuation is two pre-tokens, the lower-cased word and the punctuation, which keeps
the table of distinct pre-tokens small; any other chunk stays whole and goes to the library as it is.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters whose lower case is one letter and which no normal form changes.
_PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[.,;:!?]*)$"
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_TOGETHER = 200


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=4)
def _word_ends(path: str) -> np.ndarray | None:
    """For each id whether it ends a word, if the vocabulary marks that."""
    library = tokenizer(path)
    mark = getattr(library.model, "end_of_word_suffix", None)
    if not mark:
        return None
    ends = np.zeros(1 + max(library.get_vocab().values()), bool)
    ends[[i for token, i in library.get_vocab().items() if token.endswith(mark)]] = True
    return ends


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def chunked(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of `texts` between ASCII white space, the places of all chunks among them, and how many each text has."""
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    words, n_words = split.flatten(), split.value_lengths().to_numpy()
    real = pc.not_equal(words, "")  # none before leading and after trailing white space
    through = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    words = words.filter(real).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.diff(through[np.concatenate([[0], np.cumsum(n_words)])])


def pretokens(chunks: list[bytes] | pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct pre-tokens of `chunks`, and for each chunk its word and its punctuation (-1: none)."""
    if isinstance(chunks, list):
        chunks = pa.array(chunks, pa.large_binary()).cast(pa.large_string())
    plain = pc.extract_regex(chunks, _PLAIN)
    word = pc.if_else(plain.is_valid(), pc.utf8_lower(pc.struct_field(plain, "word")), chunks)
    mark = pc.struct_field(plain, "mark")
    mark = pc.if_else(pc.equal(mark, ""), None, mark)
    found = pa.chunked_array([mark, word]).combine_chunks().dictionary_encode()  # small numbers for what is everywhere
    return found.dictionary.to_pylist(), found.indices.fill_null(-1).to_numpy().reshape(2, -1)[::-1].T


def encoder(path: str, count_only: bool):
    """Answers distinct pre-tokens with their number of ids, and with the ids unless only the number is asked for.

    Words of letters go to the library many in a text, with blanks between them, where its ids tell where a word ends.
    """

    def library(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return size, np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))

    def together(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        starts = range(0, len(words), _TOGETHER)
        size, ids = library([" ".join(words[lo:lo + _TOGETHER]) for lo in starts])
        last, through = _word_ends(path)[ids], np.cumsum(size)
        ends = np.concatenate([[0], np.cumsum(last)])[through]
        if (ends != [min(lo + _TOGETHER, len(words)) for lo in starts]).any() or not last[through - 1].all():
            return library(words)
        return np.diff(np.flatnonzero(last), prepend=-1), ids

    def encode(chunks: list[bytes], _) -> tuple[np.ndarray, np.ndarray | None]:
        words = [x.decode() for x in chunks]
        plain = np.fromiter((_LETTERS.fullmatch(x) is not None for x in words), bool, len(words))
        plain &= _word_ends(path) is not None
        size, parts = np.zeros(len(words), np.int64), []
        for rows, ask, step in ((np.flatnonzero(plain), together, 100 * _TOGETHER), (np.flatnonzero(~plain), library, 2000)):
            for lo in range(0, len(rows), step):
                own = rows[lo:lo + step]
                size[own], ids = ask([words[i] for i in own.tolist()])
                if not count_only:
                    parts.append((own, ids))
        if count_only:
            return size, None
        starts, flat = np.cumsum(size) - size, np.empty(size.sum(), np.int32)
        for own, ids in parts:
            each = size[own]
            flat[np.repeat(starts[own] - (np.cumsum(each) - each), each) + np.arange(len(ids))] = ids
        return size, flat

    return encode
