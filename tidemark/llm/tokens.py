"""Token ids of whole texts by the public tokenizer files.

Texts are cut at white space, which no token of either vocabulary crosses, and
each distinct piece is encoded by the tokenizers library, by each worker and as long as
the worker remembers it: its memory is bounded, and what it forgets is encoded again.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import kept

#: Fixed value: white space as the tokenizers' patterns see it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space beyond ASCII.
WIDE_SPACE = re.compile(f"[{SPACE[4:]}]")
#: Characters that end many words; a run of them is one piece, and no special token ends in one.
PUNCTUATION = ".,;:!?#$%&*"
#: Entries of a worker's memory, and characters of a key, at most.
REMEMBERED, LONGEST = 600_000, 100
#: Characters of text whose words are looked up together; a longer text is alone.
TOGETHER = 4 << 20


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself if printable, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


LETTERS = byte_letters()
AS_LETTERS = dict(enumerate(LETTERS))


def lettered(text: str) -> str:
    """Bytes of the text, written as the vocabulary writes them."""
    return text if text.isascii() and text.isalpha() else text.encode().decode("latin-1").translate(AS_LETTERS)


def packed(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class Memory(dict):
    """Remembers what ``find`` gives for a key. Holds ``size`` keys at most: when it is
    half full, what it holds becomes the older half, of which used keys come back."""

    def __init__(self, find, size: int = REMEMBERED):
        super().__init__()
        self.find, self.half, self.older = find, size // 2, {}

    def __missing__(self, key):
        found = self.older.get(key, self)
        if found is self:
            found = self.find(key)
        self.keep(key, found)
        return found

    def keep(self, key, found) -> None:
        if len(key) <= LONGEST:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = found

    def all(self, keys: list, finish) -> list:
        """For each of different keys what ``finish`` makes, for all new keys at once,
        of what ``find`` gives for them; never None."""
        own = list(map(self.get, keys))
        absent = [k for k, found in enumerate(own) if found is None]
        asked = [keys[k] for k in absent]
        known = list(map(self.older.get, asked))
        new = [key for key, found in zip(asked, known, strict=True) if found is None]
        made = iter(finish(list(map(self.find, new))))
        known = [next(made) if found is None else found for found in known]
        for k, found in zip(absent, known, strict=True):
            own[k] = found
        if len(self) + len(asked) <= self.half and max(map(len, asked), default=0) <= LONGEST:
            self.update(zip(asked, known, strict=True))
        else:
            for key, found in zip(asked, known, strict=True):
                self.keep(key, found)
        return own


def gathered(ids: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces with ``n`` ids each, one after the other, those that ``at`` names."""
    first, n = (np.cumsum(n) - n)[at], n[at]
    first -= np.cumsum(n) - n
    return ids[np.repeat(first, n) + np.arange(n.sum())], n


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def together(texts: list[str]) -> Iterator[list[str]]:
    """The texts, some at a time."""
    sizes = np.cumsum([len(text) for text in texts]) // TOGETHER
    cuts = [*np.flatnonzero(np.diff(sizes, prepend=-1)).tolist(), len(texts)]
    yield from (texts[a:b] for a, b in zip(cuts, cuts[1:], strict=False))


class WordIds:
    """Ids of a text by a vocabulary with word ends (lower case, white space
    dropped), as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run in parallel
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.pieces_only = Tokenizer(self.model)  # neither changes nor cuts what it is given
        self.size = self.tokenizer.get_vocab_size()
        suffix = self.model.end_of_word_suffix
        self.final = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(self.size)])
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stems = Memory(self.stem)
        self.ends = Memory(self.piece)
        self.words = Memory(lambda word: packed(self.tokenizer.encode(word, add_special_tokens=False).ids))

    def piece(self, piece: str) -> bytes:
        return packed([t.id for t in self.model.tokenize(lettered(piece))])

    def stem(self, letters: str) -> str:
        """What stands before a word's punctuation as the vocabulary writes it, if that
        is one piece."""
        low = letters.lower()
        if not low.isalpha():
            return ""
        if letters.isascii():
            return low
        return lettered(low) if "Σ" not in letters and unicodedata.is_normalized("NFC", letters) else ""

    def pieces(self, written: list[str]) -> list[bytes]:
        """Ids of each piece of letters, given as the vocabulary writes them. No token
        but the last of such a piece ends a word."""
        some = list(filter(None, written))
        coded = self.pieces_only.encode_batch_fast([some], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(coded[0].ids, "<u4")
        ends = ((np.flatnonzero(self.final[ids]) + 1) * 4).tolist()
        if len(ends) != len(some):
            return [packed([t.id for t in self.model.tokenize(piece)]) for piece in written]
        raw = ids.tobytes()
        own = iter([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        return [next(own) if piece else b"" for piece in written]

    def plain(self, text: str) -> str:
        """The text with ASCII white space only, and in lower case where that changes
        no ids: not before normal form C, and not where it makes a special token."""
        if text.isascii():
            low = text.lower()
        else:
            text = WIDE_SPACE.sub(" ", text)
            low = text.lower()
            if "Σ" in text or not all(unicodedata.is_normalized("NFC", x) for x in (text, low)):
                return text
        return text if any(token in low for token in self.special) else low

    def encode(self, text: str) -> bytes:
        return next(self.each([text])).tobytes()

    def each(self, texts: list[str], end: int | None = None) -> Iterator[np.ndarray]:
        """Ids of each text, ``end`` behind them."""
        for ids, n in self.encode_all(texts, end):
            stops = np.cumsum(n).tolist()
            yield from (ids[a:b] for a, b in zip([0, *stops], stops, strict=False))

    def encode_all(self, texts: list[str], end: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts one after the other, ``end`` behind each, and the number of
        ids of each text; some texts at a time. A word is looked up once in these."""
        for some in together(texts):
            yield self._together(some, end)

    def _together(self, texts: list[str], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pa.array(map(self.plain, texts), pa.large_string()))
        coded = split.flatten().dictionary_encode()
        word, stops = coded.indices.to_numpy(), split.offsets.to_numpy()[1:]
        if end is not None:
            word, stops = np.insert(word, stops, len(coded.dictionary)), stops + np.arange(1, len(stops) + 1)
        ids, n = self._words(coded.dictionary, packed([] if end is None else [end]))
        ids, n = gathered(ids, n, word)
        return ids, np.diff(np.append(0, np.cumsum(n))[stops], prepend=0)

    def _words(self, words: pa.Array, last: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, and ``last``: of its stem and of the punctuation behind, or
        of the whole."""
        bare = pc.utf8_rtrim(words, PUNCTUATION)
        stems = bare.dictionary_encode()
        own = self.stems.all(strings(stems.dictionary), self.pieces)
        n = np.fromiter(map(len, own), np.int64, len(own)) // 4
        one = stems.indices.to_numpy().astype(np.intp)
        # Every word is two of the pieces in ``own``, of which one may be empty.
        other = np.full(len(one), len(own))
        own.append(b"")
        longer = pc.binary_length(words).to_numpy() - pc.binary_length(bare).to_numpy()
        for size in np.unique(longer[longer > 0]).tolist():
            at = np.flatnonzero(longer == size)
            ends = pc.utf8_slice_codeunits(words.take(pa.array(at)), -size).dictionary_encode()
            other[at] = len(own) + ends.indices.to_numpy()
            own.extend(map(self.ends.__getitem__, strings(ends.dictionary)))
        at = np.flatnonzero(n[one] == 0)
        one[at], other[at] = len(own) + np.arange(len(at)), len(stems.dictionary)
        own.extend(map(self.words.__getitem__, strings(words.take(pa.array(at)))))
        own.append(last)
        n = np.append(n, np.fromiter(map(len, own[len(n) :]), np.int64) // 4)
        pair = np.append(np.column_stack([one, other]).ravel(), [len(own) - 1, len(stems.dictionary)])
        ids, n = gathered(np.frombuffer(b"".join(own), "<u4"), n, pair)
        return ids, n[::2] + n[1::2]


@kept
def word_ids(path: str) -> WordIds:
    """One for each worker process."""
    return WordIds(path)
