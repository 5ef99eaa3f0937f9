"""Repeated passages by prefix-partitioned suffix trees.

Every word of a document starts a suffix. Two suffixes share a passage of
``WINDOW`` words if their paths in a suffix tree part at that depth or deeper, so
trees are cut off there, and suffixes with fewer words are left out. Suffixes are
split by prefixes of different lengths: a census counts prefixes of 1, 2, 4 and 8
words; a suffix belongs to its shortest prefix that at most ``GROUP`` suffixes
have, and several small prefixes share a group. Prefixes too common at every length
are split by the whole path. Equal suffixes always meet, and a group fits in
memory. Its tree is built by sorting the suffixes' paths; each run of equal paths is
an internal node of that depth, its leaves are the places of a repeat, and all but
the earliest (smallest identifier, then start) are repeats of that one.

Paths are 64-bit hashes made from XXH64 hashes of the words. A block of documents sends a path to a group
once, with the first place it stands at, so a passage that everyone shares arrives
once from each block.

Defined results: a NULL text is an empty text; NULL identifiers come first; rows
with the same identifier and text are one document, listed as often as it occurs;
documents with one identifier and different texts are ordered by a hash of the
text; an empty input gives no rows. Other columns are not read, or pass unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hand_back, text_of, unused

WINDOW = 20
GROUP = 2_000_000
PREFIXES, CODE_BITS = (1, 2, 4, 8), 10
#: Bytes of text that are hashed at once.
BLOCK_BYTES = 3 << 20
U = np.uint64
FLAGS = "doc_id long, text_hash long, places binary"


#: Words whose hashes a task remembers at most.
REMEMBERED = 200_000
SEED = 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Hash of two stretches, one behind the other, from the hashes of both. Nothing
    of it is linear, so words that change places do not cancel out."""
    return mixed(mixed(one + U(0x9E3779B97F4A7C15)) ^ (other * U(0xC2B2AE3D27D4EB4F)))


class WordHashes(dict):
    """XXH64 of each word, a bounded number of them remembered."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxh64_intdigest(word, SEED)
        return found


class Words:
    """Hashes of the words of several texts, one after the other, and of stretches
    of 2, 4, 8, ... words from each place on."""

    def __init__(self, texts: list[bytes]):
        hashes, parts, self.first = WordHashes(), [], [0]
        for text in texts:
            words = text.split()
            parts.append(np.fromiter(map(hashes.__getitem__, words), U, len(words)))
            self.first.append(self.first[-1] + len(words))
        self.first = np.array(self.first)
        self.levels = [np.concatenate(parts) if parts else np.zeros(0, U)]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and first word of each window, in order."""
        counts = np.maximum(np.diff(self.first) - WINDOW + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        before = np.cumsum(counts) - counts
        return text, np.arange(counts.sum()) - np.repeat(before - self.first[:-1], counts)

    def _level(self, k: int) -> np.ndarray:
        """Hashes of 2**k words from each place on that has so many."""
        while len(self.levels) <= k:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(joined(last[:-step], last[step:]) if len(last) > step else last[:0])
        return self.levels[k]

    def paths(self, at: np.ndarray, words: int) -> np.ndarray:
        """Hash of so many words from each place on."""
        found, done = None, 0
        for k in reversed(range(words.bit_length())):
            if words >> k & 1:
                own = self._level(k)[at + done]
                found = own if found is None else joined(found, own)
                done += 1 << k
        return mixed(found)


def _key(documents: DataFrame) -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash")]


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(*_key(documents), text_of().alias("text"))


def _blocks(batches: Iterator[pd.DataFrame], size: int = BLOCK_BYTES) -> Iterator[tuple[list, list, list[bytes]]]:
    """Distinct documents in order, some megabytes of text at a time."""
    held: dict[tuple, bytes] = {}
    held_bytes = 0
    for batch in batches:
        for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True):
            key = (-(2**63) if pd.isna(doc_id) else int(doc_id), not pd.isna(doc_id), int(text_hash))
            if key not in held:
                held[key] = text.encode("utf-8", "surrogatepass")
                held_bytes += len(held[key])
            if held_bytes >= size:
                yield _ordered(held)
                held, held_bytes = {}, 0
    if held:
        yield _ordered(held)


def _ordered(held: dict[tuple, bytes]):
    keys = sorted(held)
    return [k[:2] for k in keys], [k[2] for k in keys], [held[k] for k in keys]


def codes(words: Words, at: np.ndarray) -> Iterator[np.ndarray]:
    for n in PREFIXES:
        yield (words.paths(at, n) >> U(64 - CODE_BITS)).astype(np.intp)


def census(rows: DataFrame) -> np.ndarray:
    """How many suffixes have a prefix with this code: a row for each length of
    prefixes, a fixed number of codes."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(PREFIXES), 1 << CODE_BITS), np.int64)
        for _, _, texts in _blocks(batches):
            words = Words(texts)
            _, at = words.windows()
            for own, code in zip(total, codes(words, at), strict=True):
                own += np.bincount(code, minlength=len(own))
        level, code = np.nonzero(total)
        yield pd.DataFrame({"level": level, "code": code, "n": total[level, code]})
        hand_back()

    counts = rows.mapInPandas(count, "level int, code int, n long").groupBy("level", "code").agg(F.sum("n").alias("n"))
    total = np.zeros((len(PREFIXES), 1 << CODE_BITS), np.int64)
    for row in counts.collect():
        total[row.level, row.code] = row.n
    return total


def plan_groups(counts: np.ndarray, group: int = GROUP) -> tuple[np.ndarray, int]:
    """Group of each prefix code, -1 for prefixes that are too common, and the
    number of groups. Of prefixes of 2 words and more only a part still has to be
    placed, so their groups tend to be smaller than counted."""
    groups = np.full(counts.shape, -1, np.int32)
    number, held = 0, 0
    for level, code in zip(*np.nonzero((counts > 0) & (counts <= group)), strict=True):
        n = counts[level, code]
        if held + n > group and held:
            number, held = number + 1, 0
        groups[level, code] = number
        held += n
    return groups, number + 1


def ascending(values: np.ndarray) -> bytes:
    """Ascending numbers by their steps, in the width the largest step needs."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    top = int(steps.max()) if len(steps) and steps[0] >= 0 else -(len(steps) > 0)
    width = next((w for w in ("<u1", "<u2", "<u4") if 0 <= top < 256 ** int(w[2])), "<i8")
    return width.encode() + steps.astype(width).tobytes()


def ascended(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data[3:], data[:3].decode()).astype(np.int64))


SUFFIXES = (
    "group int, block long, doc_ids binary, known binary, text_hashes binary, firsts binary, places binary,"
    " paths binary, again binary"
)
BLOCKS = "block long, doc_ids binary, known binary, text_hashes binary, firsts binary, places binary"


def repeated_ids(rows: DataFrame) -> bool:
    """Does an identifier occur twice? Only then do suffixes carry text hashes."""
    return not rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def suffixes(rows: DataFrame, groups: np.ndarray, number: int, rest: int) -> DataFrame:
    """A row for each block and group: distinct paths and their first places.
    ``rest`` groups hold what has no prefix of its own. Groups below 0 hold what
    documents the blocks consist of."""
    told_apart = repeated_ids(rows)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in SUFFIXES.split(", ")]
        for number_of, (keys, text_hashes, texts) in enumerate(_blocks(batches)):
            block = (TaskContext.get().partitionId() << 32) | number_of
            words = Words(texts)
            _, at = words.windows()
            if not len(at):
                continue
            path = words.paths(at, WINDOW)
            to = np.full(len(at), -1, np.int32)
            for own, code in zip(groups, codes(words, at), strict=True):
                to = np.where(to < 0, own[code], to)
            to = np.where(to < 0, number + (path % U(rest)).astype(np.int32), to)
            order = np.lexsort((at, path, to))
            to, path, at = to[order], path[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (path[1:] != path[:-1]) | (to[1:] != to[:-1])
            ids = np.array([k[0] for k in keys], np.int64)
            known = np.array([k[1] for k in keys], np.uint8)
            hashes = np.array(text_hashes, np.int64)
            cuts = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
            nothing = ascending(at[:0])
            out = [
                (
                    -1 - block % number,
                    block,
                    ascending(ids),
                    known.tobytes(),
                    hashes.tobytes(),
                    ascending(words.first[:-1]),
                    nothing,
                    b"",
                    nothing,
                )
            ]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                fresh = new[a:b]
                place, own = at[a:b][fresh], path[a:b][fresh]
                by_place = np.argsort(place, kind="stable")
                again = np.sort(at[a:b][~fresh])
                used = np.unique(np.searchsorted(words.first, at[a:b], side="right") - 1)
                out.append(
                    (
                        int(to[a]),
                        block,
                        ascending(ids[used]),
                        known[used].tobytes(),
                        hashes[used].tobytes() if told_apart else b"",
                        ascending(words.first[used]),
                        ascending(place[by_place]),
                        own[by_place].tobytes(),
                        ascending(again),
                    )
                )
            yield pd.DataFrame(out, columns=names)
        hand_back()

    return rows.mapInPandas(send, SUFFIXES)


def repeats(group: pd.DataFrame) -> pd.DataFrame:
    """Places in each block of a group's suffixes whose path stands earlier too."""
    if group["group"].iloc[0] < 0:
        return group[[x.split()[0] for x in BLOCKS.split(", ")]]
    ids, known, hashes, document, place, path = ([] for _ in range(6))
    again, sizes, count = [], [], 0
    for row in group.itertuples():
        firsts, at = ascended(row.firsts), ascended(row.places)
        k = np.searchsorted(firsts, at, side="right") - 1
        document.append(k + count)
        place.append(at - firsts[k])
        again.append(ascended(row.again))
        sizes.append(len(at))
        ids.append(ascended(row.doc_ids))
        known.append(np.frombuffer(row.known, np.uint8))
        own = np.frombuffer(row.text_hashes, np.int64)
        hashes.append(own if len(own) else np.zeros(len(firsts), np.int64))
        path.append(np.frombuffer(row.paths, np.uint64))
        count += len(firsts)
    ids, known, hashes, document, place, path = map(np.concatenate, (ids, known, hashes, document, place, path))
    # Documents in order; rows of one document (same identifier and text) are equal.
    order = np.lexsort((hashes, known, ids))
    change = np.ones(count, bool)
    change[1:] = np.any([np.diff(x[order]) != 0 for x in (hashes, known, ids)], axis=0)
    rank = np.empty(count, np.int64)
    rank[order] = np.cumsum(change) - 1
    when = (rank[document] << 32) | place
    del ids, known, hashes, document, place, rank, change
    order = np.lexsort((when, path))
    path, when = path[order], when[order]
    start = np.flatnonzero(np.diff(path, prepend=path[:1] ^ U(1)) != 0)
    earliest = np.repeat(when[start], np.diff(np.append(start, len(path))))
    later = np.zeros(len(path), bool)
    later[order] = when != earliest
    del path, when, order, earliest, start
    found, a = [], 0
    for row, own, n in zip(group.itertuples(), again, sizes, strict=True):
        at = ascended(row.places)[later[a : a + n]]
        a += n
        if len(at) or len(own):
            found.append((row.block, b"", b"", b"", b"", ascending(np.sort(np.concatenate([at, own])))))
    hand_back()
    return pd.DataFrame(found, columns=[x.split()[0] for x in BLOCKS.split(", ")])


def by_document(block: pd.DataFrame) -> pd.DataFrame:
    """A block's places, document by document."""
    is_table = block["firsts"].map(len) > 0
    table = block[is_table].iloc[0]
    places = np.sort(np.concatenate([np.zeros(0, np.int64), *map(ascended, block["places"][~is_table])]))
    firsts = ascended(table.firsts)
    document = np.searchsorted(firsts, places, side="right") - 1
    start = np.flatnonzero(np.diff(document, prepend=-1))
    which = document[start]
    own = np.split(places - firsts[document], start[1:]) if len(start) else []
    doc_ids = pd.array(ascended(table.doc_ids)[which], dtype="Int64")
    doc_ids[np.frombuffer(table.known, np.uint8)[which] == 0] = pd.NA
    text_hashes = np.frombuffer(table.text_hashes, np.int64)[which]
    return pd.DataFrame({"doc_id": doc_ids, "text_hash": text_hashes, "places": list(map(ascending, own))})


def repeated_places(documents: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, text_hash, places: words at which a window starts that also starts
    earlier, as ``ascending`` writes them."""
    rows = _rows(documents)
    counts = census(rows)
    groups, number = plan_groups(counts, group)
    # What no prefix places is at most what the longest prefixes leave.
    common = int(counts[-1][counts[-1] > group].sum())
    sent = suffixes(rows, groups, number, 1 + common // group)
    found = sent.groupBy("group").applyInPandas(repeats, BLOCKS)
    return found.groupBy("block").applyInPandas(by_document, FLAGS)


def covered(n_words: int, places: list[bytes]) -> np.ndarray:
    """Which words a window starting at one of the places covers."""
    steps = np.zeros(n_words + 1, np.int64)
    for own in places:
        at = ascended(own)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + WINDOW, -1)
    return np.cumsum(steps[:-1]) > 0


def spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last (exclusive) word of each covered stretch."""
    edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def with_places(documents: DataFrame, group: int = GROUP) -> tuple[DataFrame, str]:
    """The documents, all columns, and one more with the places (list of binaries or
    NULL); its name, which no other column has."""
    places, own_id, own_hash, its_id, its_hash = unused(documents, "places", "own_id", "own_hash", "its_id", "its_hash")
    found = repeated_places(documents, group).groupBy("doc_id", "text_hash").agg(F.collect_list("places").alias("p"))
    found = found.withColumnsRenamed({"doc_id": its_id, "text_hash": its_hash, "p": places})
    doc_id, text_hash = _key(documents)
    marked = documents.withColumns({own_id: doc_id, own_hash: text_hash})
    same = F.col(own_id).eqNullSafe(F.col(its_id)) & (F.col(own_hash) == F.col(its_hash))
    return marked.join(found, same, "left").drop(own_id, own_hash, its_id, its_hash), places


def removal_digests(documents: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, places in zip(batch["text"], batch["places"], strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                removed = 0
                if places is not None and len(places):
                    gone = covered(len(words), places)
                    removed = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out.append((len(words) + removed, removed, hashlib.sha256(b" ".join(words)).hexdigest()))
            found = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"])
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield found.astype({"doc_id": "Int64"})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return with_places(rows, group)[0].mapInPandas(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def repeated_spans(documents: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, start, stop: stretches of words that repeat what stands earlier."""

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, places in zip(batch["doc_id"], batch["text"], batch["places"], strict=True):
                n = len(text.encode("utf-8", "surrogatepass").split())
                out += [(None if pd.isna(doc_id) else int(doc_id), a, b) for a, b in spans(covered(n, places))]
            yield pd.DataFrame(out, columns=["doc_id", "start", "stop"]).astype({"doc_id": "Int64"})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    hit = with_places(rows, group)[0].filter(F.col("places").isNotNull())
    return hit.mapInPandas(stretches, "doc_id long, start long, stop long")


def without_repeats(documents: DataFrame, group: int = GROUP) -> DataFrame:
    """The documents, all columns, without the words of repeated passages. Texts
    that lose words are joined by single spaces; others stay as they are."""

    def cut(texts: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, places, strict=True):
            if own is not None and len(own):
                words = text.encode("utf-8", "surrogatepass").split()
                gone = covered(len(words), own).tolist()
                text = b" ".join([w for w, g in zip(words, gone, strict=True) if not g]).decode("utf-8", "surrogatepass")
            out.append(text)
        return pd.Series(out, dtype=object)

    shorter = F.pandas_udf(cut, "string")
    names = documents.columns
    marked, places = with_places(documents, group)
    text = F.when(F.col(places).isNull(), F.col("text")).otherwise(shorter("text", places))
    return marked.select(*[text.alias("text") if c == "text" else F.col(c) for c in names])
