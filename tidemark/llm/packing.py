"""Packing token sequences into bins by best two fit.

A bin is filled greedily, the largest piece that fits first. As long as a gap
remains, its smallest piece is taken out for a moment, and if two unpacked pieces
fill the expanded gap more tightly than it did, they take its place. Only
documents longer than a bin are cut.

Pieces are packed in groups of about ``GROUP`` pieces drawn by a hash, so no task
ever holds more than that and each group leaves about one bin unfilled. What is
shuffled of a piece is its place in the document and its length, not its ids;
``packed_sequences`` brings the ids together afterwards.

Defined results: a NULL or empty text is the end id alone; identifiers may be NULL
or repeat (rows stay apart); an empty input gives no pieces. Other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of
from tidemark.llm.tokens import word_ids

CAPACITY = 4096
GROUP = 50_000
END = 1
PIECE = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. Bins are numbered from 0."""
    order = np.argsort(lengths, kind="stable")
    by_length = np.searchsorted(lengths[order], np.arange(capacity + 2))
    left = np.diff(by_length)  # unpacked pieces of each length
    used = np.zeros(capacity + 1, np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    sizes = np.flatnonzero(left)  # lengths of which some are unpacked, ascending
    number, remaining = 0, len(lengths)

    def take(n: int) -> None:
        nonlocal sizes
        left[n] -= 1
        if not left[n]:
            sizes = np.delete(sizes, np.searchsorted(sizes, n))

    def give(n: int) -> None:
        nonlocal sizes
        if not left[n]:
            sizes = np.insert(sizes, np.searchsorted(sizes, n), n)
        left[n] += 1

    while remaining:
        held, gap = [], capacity
        while True:
            at = np.searchsorted(sizes, gap, side="right") - 1
            if at < 0:
                break
            n = int(sizes[at])
            held.append(n)
            take(n)
            gap -= n
        while gap and len(held) > 1 and len(sizes):
            smallest = held[-1]  # taken in descending order
            pair = _tightest_pair(sizes, left, gap + smallest)
            if pair is None or sum(pair) <= smallest:
                break
            take(pair[0])
            take(pair[1])
            give(smallest)
            held[-1:] = sorted(pair, reverse=True)
            gap += smallest - sum(pair)
            held.sort(reverse=True)
        offset = 0
        for n in held:
            piece = order[by_length[n] + used[n]]
            used[n] += 1
            bins[piece], offsets[piece] = number, offset
            offset += n
        remaining -= len(held)
        number += 1
    return bins, offsets


def _tightest_pair(sizes: np.ndarray, left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum within ``room``."""
    first = sizes[: np.searchsorted(sizes, room // 2, side="right")]
    if not len(first):
        return None
    at = np.searchsorted(sizes, room - first, side="right") - 1
    second = sizes[at]
    # A length alone cannot be paired with itself: then the next smaller one.
    alone = (second == first) & (left[first] < 2)
    second = np.where(alone, np.where(at > 0, sizes[at - 1], 0), second)
    sums = np.where(second > 0, first + second, 0)
    best = int(np.argmax(sums))
    return (int(first[best]), int(second[best])) if sums[best] else None


def cut_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece; ``row`` tells documents apart."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(tokenizer)
        for batch in batches:
            out = []
            for row, doc_id, ids in zip(batch["row"], batch["doc_id"], encoder.each(batch["text"].tolist(), END), strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    out.append((row, doc_id, piece, start, len(own), zlib.crc32(own)))
            yield _frame(out)

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    return rows.mapInPandas(pieces, PIECE)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in PIECE.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset. Reads them twice, so they should
    be stored."""
    groups = max(1, -(-pieces.count() // group))
    names = pieces.columns

    def packed(pieces: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_two_fit(pieces["length"].to_numpy(np.int64), capacity)
        first = int(pieces["group"].iloc[0])
        return pieces[names].assign(sequence_id=bins * groups + first, offset=offsets)

    schema = pieces.drop("group").schema.add("sequence_id", "long").add("offset", "long")
    by_hash = F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("group")
    return pieces.select("*", by_hash).groupBy("group").applyInPandas(packed, schema)


def pack_documents(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    return pack(stored(cut_pieces(documents, tokenizer, capacity), "pieces"), capacity, group)


def packed_sequences(documents: DataFrame, placed: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and the ids themselves (array), from the same documents that
    were packed. A sequence holds ``capacity`` ids at most."""

    def with_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(tokenizer)
        for batch in batches:
            out = []
            for row, ids in zip(batch["row"], encoder.each(batch["text"].tolist(), END), strict=True):
                ids = ids.astype(np.int32)
                out += [(row, k, ids[s : s + capacity]) for k, s in enumerate(range(0, len(ids), capacity))]
            yield pd.DataFrame(out, columns=["row", "piece", "ids"])

    rows = documents.select(F.monotonically_increasing_id().alias("row"), text_of().alias("text"))
    ids = rows.mapInPandas(with_ids, "row long, piece int, ids array<int>")
    return (
        placed.select("row", "piece", "sequence_id", "offset")
        .join(ids, ["row", "piece"])
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    )
