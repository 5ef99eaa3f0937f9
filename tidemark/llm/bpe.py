"""Byte-level BPE of whole texts; long texts by tree concatenation.

A text up to ``LEAF`` characters is encoded where it is read. A longer one is cut
into halves, and halves of halves, and the leaves are dealt out to all tasks.
Two neighbours are then joined: a window of pre-tokens around the cut is split
and encoded again, and it grows until its first pre-token is one of the left side
and its last is one of the right. Pre-tokens follow from the place where one
starts, so from there on both sides stand. A pre-token that spans a cut (a run of
letters without end) is joined in the same way by its tokens: a window of tokens
is encoded again and grows until it fits its neighbours, that is until each
neighbour and the window's outer token, encoded together, give these two tokens.
A sequence of tokens is what BPE gives if and only if all its neighbours fit.

Defined results: a NULL text is an empty text and has no ids; identifiers may be
NULL or repeat (rows stay apart); the text of the special token, wherever it
stands, is that token; an empty input gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, text_of
from tidemark.llm.tokens import LETTERS, SPACE, WIDE_SPACE, Memory, gathered, lettered, strings, together

LEAF = 16_384
#: Longest string given to the library's merges in one go.
UNIT = 2048
#: Fixed value: how the vocabulary cuts texts into pre-tokens.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PUNCTUATION = frozenset(".,;:!?")
#: What a worker remembers at most.
CHUNKS, PIECES = 300_000, 300_000
#: Marks the last id of a pre-token; no id is as large.
LAST = np.uint32(1 << 31)
#: What is cut of a segment: all, between single spaces only, or nothing.
PLAIN, WIDE, WHOLE = range(3)
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
LEAVES = "row long, doc_id long, segment int, leaf int, special boolean, text binary"


def packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def marked(ids: bytes) -> bytes:
    """Packed ids of a pre-token, the last one marked."""
    return ids[:-1] + b"\x80"


def chunk_starts(text: np.ndarray, sizes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where chunks start in the UTF-8 bytes of segments that stand one after the other:
    where white space starts; before the last of several blanks that a word follows; and
    behind a blank that is no space. A pre-token starts at each of these places, and
    none depends on what stands on the other side."""
    ends = np.cumsum(sizes)
    some = sizes > 0
    space = text == 32
    blank = space | (text - np.uint8(9) < 5)
    before = np.append(False, blank[:-1])
    behind = np.append(blank[1:], True)
    behind[ends[some] - 1] = True
    cut = np.where(blank, ~before | ~behind, before & ~np.append(False, space[:-1]))
    if kinds.any():
        kind = np.repeat(kinds, sizes)
        wide = text >= 128  # white space beyond ASCII may be next to these
        single = space & ~before & ~behind & ~np.append(False, wide[:-1]) & ~np.append(wide[1:], False)
        cut &= (kind == PLAIN) | single & (kind == WIDE)
    cut[(ends - sizes)[some]] = True
    return np.flatnonzero(cut)


class ByteBpe:
    """Encoder and decoder of one vocabulary file, one for each worker."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        byte_of = {letter: b for b, letter in enumerate(LETTERS)}
        special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special = {content: i for i, content in special.items()}
        size = tokenizer.get_vocab_size()
        self.bytes_of = [
            special[i].encode() if i in special else bytes(byte_of[c] for c in tokenizer.id_to_token(i)) for i in range(size)
        ]
        self.texts = pa.array(self.bytes_of, pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        space = f"[{SPACE}]", f"[^{SPACE}]"
        pattern = PRETOKEN.replace(r"[^\s", "[^" + SPACE).replace(r"\s", space[0]).replace(r"\S", space[1])
        self.pretokens = regex.compile(pattern).findall
        self.known = Memory(self.chunk, CHUNKS)
        self.pieces = Memory(self.piece, PIECES)

    # Pre-tokens.

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        if len(piece) > UNIT:
            return self.halves(piece)
        return packed([t.id for t in self.model.tokenize(lettered(piece))])

    def halves(self, piece: str) -> bytes:
        """Ids of a long pre-token, from its halves."""
        if len(piece) <= UNIT:
            return packed([t.id for t in self.model.tokenize(lettered(piece))])
        middle = len(piece) // 2
        return packed(self.join_ids(unpacked(self.halves(piece[:middle])), unpacked(self.halves(piece[middle:]))))

    def merged(self, text: bytes) -> list[int]:
        """Ids of bytes within one pre-token."""
        return [t.id for t in self.model.tokenize("".join([LETTERS[b] for b in text]))]

    def fits(self, left: int, right: int) -> bool:
        return self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring parts of a pre-token, from the ids of each."""
        a, b = min(4, len(left)), min(4, len(right))
        while True:
            inner = left[len(left) - a :] + right[:b]
            window = self.merged(b"".join([self.bytes_of[i] for i in inner]))
            left_stands = a == len(left) or self.fits(left[-a - 1], window[0])
            right_stands = b == len(right) or self.fits(window[-1], right[b])
            if left_stands and right_stands:
                return left[: len(left) - a] + window + right[b:]
            if not left_stands:
                a = min(2 * a, len(left))
            if not right_stands:
                b = min(2 * b, len(right))

    # Texts.

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk, the last of each pre-token marked."""
        if chunk in self.special:
            return marked(packed([self.special[chunk]]))
        word, end = (chunk[:-1], chunk[-1]) if chunk[-1] in PUNCTUATION else (chunk, "")
        bare = word[1:] if word[:1] == " " else word
        if bare.isalpha():
            return marked(self.pieces[word]) + marked(self.pieces[end]) if end else marked(self.pieces[word])
        return b"".join([marked(self.pieces[piece]) for piece in self.pretokens(chunk)])

    def segments(self, text: str) -> list[str]:
        """The text cut before and after special tokens; every second is one."""
        return self.cut_special.split(text)

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts one after the other, the last of each pre-token marked, and
        the number of ids of each text; some texts at a time. A chunk is looked up once
        in these."""
        for some in together(texts):
            split = list(map(self.segments, some))
            ids, n = self._together([segment for own in split for segment in own], [k % 2 for own in split for k in range(len(own))])
            segments = np.cumsum([len(own) for own in split])
            yield ids, np.diff(np.append(0, np.cumsum(n))[segments], prepend=0)

    def _together(self, segments: list[str], special: list[int]) -> tuple[np.ndarray, np.ndarray]:
        kinds = [WHOLE if s else PLAIN if t.isascii() or not WIDE_SPACE.search(t) else WIDE for t, s in zip(segments, special, strict=True)]
        raw = [segment.encode() for segment in segments]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        text = b"".join(raw)
        starts = chunk_starts(np.frombuffer(text, np.uint8), sizes, np.array(kinds, np.int8))
        offsets = np.append(starts, len(text))
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(text)).dictionary_encode()
        own = list(map(self.known.__getitem__, strings(coded.dictionary)))
        n = np.fromiter(map(len, own), np.int64, len(own)) // 4
        ids, n = gathered(np.frombuffer(b"".join(own), "<u4"), n, coded.indices.to_numpy())
        ends = np.append(0, np.cumsum(n))[np.searchsorted(starts, np.cumsum(sizes))]
        return ids, np.diff(ends, prepend=0)

    def each(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, the last of each pre-token marked."""
        for ids, n in self.encode_all(texts):
            stops = np.cumsum(n).tolist()
            yield from (ids[a:b] for a, b in zip([0, *stops], stops, strict=False))

    def encoded(self, text: str) -> bytes:
        return (next(self.each([text])) & ~LAST).tobytes()

    def decoded(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")

    def digests(self, ids: np.ndarray, n: np.ndarray) -> list[tuple[int, str, str]]:
        """Of texts whose ids stand one after the other: the number of ids, digest of
        the ids and of the decoded text."""
        bounds = np.append(0, np.cumsum(n))
        ids = pa.array(ids & ~LAST)
        decimal, text = self.decimals.take(ids), self.texts.take(ids)
        a, b = (np.frombuffer(x.buffers()[1], np.int64, len(ids) + 1)[bounds].tolist() for x in (decimal, text))
        decimal, text = (memoryview(x.buffers()[2] or b"") for x in (decimal, text))
        return [
            (
                count,
                # Without the last comma; an empty text has none.
                hashlib.sha256(decimal[a[k] : max(a[k], a[k + 1] - 1)]).hexdigest(),
                hashlib.sha256(str(text[b[k] : b[k + 1]], "utf-8", "replace").encode()).hexdigest(),
            )
            for k, count in enumerate(n.tolist())
        ]

    # Leaves of a tree.

    def leaf(self, text: str) -> Part:
        return Part(*ids_and_counts(next(self.each([text]))))

    def tree(self, parts: list[Part]) -> Part:
        """Neighbours are joined, then neighbours of these, up to the whole."""
        while len(parts) > 1:
            joined = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
            parts = joined + parts[2 * len(joined) :]
        return parts[0]

    def join(self, left: Part, right: Part) -> Part:
        if not left.ids or not right.ids:
            return left if left.ids else right
        a, b = min(2, len(left.ids)), min(2, len(right.ids))
        while True:
            old = [self.decoded(unpacked(ids)) for ids in left.ids[-a:] + right.ids[:b]]
            window = self.pretokens("".join(old))
            left_stands = a == len(left.ids) or window[0] == old[0]
            right_stands = b == len(right.ids) or window[-1] == old[-1]
            if left_stands and right_stands:
                break
            if not left_stands:
                a = min(2 * a, len(left.ids))
            if not right_stands:
                b = min(2 * b, len(right.ids))
        across = old[a - 1] + old[a]
        ids = []
        for piece in window:
            if piece == across and len(piece) > UNIT:
                ids.append(packed(self.join_ids(unpacked(left.ids[-1]), unpacked(right.ids[0]))))
            else:
                ids.append(self.pieces[piece])
        return Part.of(left.ids[:-a] + ids + right.ids[b:])


class Part:
    """Packed ids of each pre-token of a stretch of text. Its pre-tokens are what
    these decode to."""

    def __init__(self, ids: bytes, counts: bytes):
        ends = (4 * np.cumsum(np.frombuffer(counts, "<u4"), dtype=np.int64)).tolist()
        self.ids = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    @classmethod
    def of(cls, ids: list[bytes]) -> Part:
        part = cls(b"", b"")
        part.ids = ids
        return part


def ids_and_counts(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Packed ids, and the number of ids of each pre-token, from marked ids."""
    counts = np.diff(np.flatnonzero(ids >= LAST), prepend=-1)
    return (ids & ~LAST).tobytes(), counts.astype("<u4").tobytes()


@kept
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def halved(text: str, leaf: int = LEAF) -> list[str]:
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halved(text[:middle], leaf) + halved(text[middle:], leaf)


def _results(doc_ids: pd.Series, digests: list[tuple[int, str, str]]) -> pd.DataFrame:
    names = [x.split()[0] for x in RESULT.split(", ")]
    results = pd.DataFrame(digests, columns=names[1:])
    results.insert(0, names[0], pd.array([None if pd.isna(x) else int(x) for x in doc_ids], "Int64"))
    return results


def token_digests(documents: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """Encodes and decodes every text: number of ids, digest of the ids, digest
    of the decoded text."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            digests = [own for ids, n in bpe.encode_all(batch["text"].tolist()) for own in bpe.digests(ids, n)]
            yield _results(batch["doc_id"], digests)

    short = rows.filter(F.length("text") <= leaf).mapInPandas(whole, RESULT)
    return short.unionByName(long_digests(rows.filter(F.length("text") > leaf), tokenizer, leaf))


def encoded_leaves(rows: DataFrame, tokenizer: str, leaf: int) -> DataFrame:
    """A row for each leaf with its ids and the number of ids of each pre-token."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer)
        names = [x.split()[0] for x in LEAVES.split(", ")]
        for batch in batches:
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                out = [
                    (row, doc_id, s, k, s % 2 == 1, part.encode())
                    for s, segment in enumerate(bpe.segments(text))
                    for k, part in enumerate(halved(segment, leaf))
                ]
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            texts = [text.decode() for text in batch["text"]]
            ids, counts = zip(*map(ids_and_counts, bpe.each(texts)), strict=True) if texts else ((), ())
            yield batch.drop(columns="text").assign(ids=ids, counts=counts)

    # Leaves of one text go to different tasks.
    leaves = rows.mapInPandas(cut, LEAVES).repartition("row", "segment", "leaf")
    return leaves.mapInPandas(encode, LEAVES.replace("text binary", "ids binary, counts binary"))


def long_digests(rows: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """As ``token_digests``, for texts worth cutting. Leaves come together by
    text, as ids: their text is what these decode to."""

    def joined(leaves: pd.DataFrame) -> pd.DataFrame:
        bpe = byte_bpe(tokenizer)
        leaves = leaves.sort_values(["segment", "leaf"])
        ids: list[bytes] = []
        for _, segment in leaves.groupby("segment", sort=True):
            if segment["special"].iloc[0]:
                ids.append(segment["ids"].iloc[0])
                continue
            parts = [Part(*own) for own in zip(segment["ids"], segment["counts"], strict=True)]
            ids.extend(bpe.tree(parts).ids)
        whole = np.frombuffer(b"".join(ids), "<u4")
        return _results(leaves["doc_id"].iloc[:1], bpe.digests(whole, np.array([len(whole)])))

    return encoded_leaves(rows, tokenizer, leaf).groupBy("row").applyInPandas(joined, RESULT)
