"""Token ids on disk, compressed by a grammar for each shard (Re-Pair).

Documents are encoded, each followed by an end id, and written in ascending order
of their identifiers. A shard holds about ``SHARD_TOKENS`` ids of consecutive
documents. Within it, frequent pairs of ids are replaced by new ids
(nonterminals), pairs of those again, and so on; a rule never crosses the end of
a document. A shard is one row of a Parquet table:

* ``part``, ``shard``: order of the shards; ``first``: ids before it in its part
* ``doc_ids``, ``lengths``: identifier and number of ids of each document
* ``ends``: end of each document in the compressed sequence
* ``sequence``: the compressed sequence; ``left``, ``right``: the rules
* ``spans``: the number of ids each rule stands for

With ``spans`` any range of any document is found without expanding what comes
before it (``read_range``).

Defined results: a NULL text is an empty text and gives the end id alone; NULL
identifiers come first, equal ones in order of their texts; an empty input gives
an empty table. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.llm.tokens import word_ids

END = 1
SHARD_TOKENS = 1 << 20
#: Rules of a round, and how often a pair must occur to become one.
ROUND_RULES, LEAST = 2000, 12
TABLE_BITS = 19
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
SHARD = (
    "part int, shard int, first long, n_tokens long, base int, doc_ids binary, known binary, lengths binary,"
    " ends binary, sequence binary, left binary, right binary, spans binary"
)


def grammar(ids: np.ndarray, lengths: np.ndarray, base: int):
    """Compressed sequence, end of each document in it, left and right side of
    each rule. Rule ``i`` is the id ``base + i``. Rounds end when no pair is left that
    occurs ``LEAST`` times; each takes ids away, so a pair that is rare once stays rare,
    and only pairs that were common or have a new id are counted again."""
    sequence = ids.astype(np.uint32)
    last = np.cumsum(lengths) - 1  # of each document
    open_pairs = np.ones(len(sequence), bool)
    open_pairs[last] = False
    left, right = [], []
    for round_number in count():
        found = _frequent(sequence, open_pairs, base + len(left), round_number)
        if found is None:
            break
        at, rule, lefts, rights = found
        left.extend(lefts)
        right.extend(rights)
        sequence[at] = rule
        gone = at + 1
        last -= np.searchsorted(gone, last, side="right")
        open_pairs[at] = open_pairs[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(sequence), bool)
        keep[gone] = False
        keep = np.flatnonzero(keep)
        sequence, open_pairs = sequence[keep], open_pairs[keep]
        open_pairs[last] = False
    return sequence, last + 1, np.array(left, np.int64), np.array(right, np.int64)


def _frequent(sequence: np.ndarray, open_pairs: np.ndarray, next_id: int, round_number: int = 0):
    """Where frequent pairs stand (none overlapping), the rule of each, and both
    sides of the new rules; the most frequent pairs first. Pairs that turn out to be
    rare are no longer open.

    Pairs are counted in buckets, and one pair speaks for each. Buckets differ from
    round to round, so a pair that had to wait is not kept waiting by the same one
    again; where no bucket gives a rule, pairs are counted one by one."""
    at = np.flatnonzero(open_pairs)
    if not len(at):
        return None
    one, other = sequence[at], sequence[at + 1]
    turn = np.uint32((int(MIX[0]) + 2 * round_number * 0x27D4EB2F) & 0xFFFFFFFF)
    bucket = ((one * turn) ^ (other * MIX[1])) * MIX[2]
    bucket >>= np.uint32(32 - TABLE_BITS)
    bucket = bucket.astype(np.intp)
    often = (np.bincount(bucket, minlength=1 << TABLE_BITS) >= LEAST)[bucket]
    open_pairs[at] = often
    often = np.flatnonzero(often)
    if not len(often):
        return None
    some, bucket = at[often], bucket[often]
    key = (one[often].astype(np.int64) << 32) | other[often]
    speaker = np.zeros(1 << TABLE_BITS, np.int64)
    speaker[bucket] = key
    same = np.flatnonzero(key == speaker[bucket])
    found = _rules(some[same], bucket[same], speaker, next_id)
    if found is None:
        pairs, number = np.unique(key, return_inverse=True)
        found = _rules(some, number, pairs, next_id)
    return found


def _rules(some: np.ndarray, number: np.ndarray, pairs: np.ndarray, next_id: int):
    """Rules for the numbered pairs at the given places that are frequent there."""
    # Of equal pairs that overlap (a run of one id), every second one from the left counts.
    even = _every_second((some[1:] - some[:-1] == 1) & (number[1:] == number[:-1]))
    some, number = some[even], number[even]
    counts = np.bincount(number, minlength=len(pairs))
    chosen = np.flatnonzero(counts >= LEAST)
    if not len(chosen):
        return None
    chosen = chosen[np.argsort(-counts[chosen], kind="stable")[:ROUND_RULES]]
    rule = np.full(len(pairs), -1, np.int64)
    rule[chosen] = next_id + np.arange(len(chosen))
    rule = rule[number]
    taken = np.flatnonzero(rule >= 0)
    some, rule = some[taken], rule[taken]
    # Of different pairs that overlap, every second one from the left is replaced.
    free = _every_second(some[1:] - some[:-1] == 1)
    return some[free], rule[free], pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF


def _every_second(follows: np.ndarray) -> np.ndarray:
    """The places that count if of each run every second one does, from its first on;
    ``follows`` says of each place but the first if it goes on with a run."""
    out = np.ones(len(follows) + 1, bool)
    at = np.flatnonzero(follows) + 1
    starts = np.flatnonzero(np.diff(at, prepend=-1) > 1)
    run = np.repeat(at[starts], np.diff(np.append(starts, len(at))))
    out[at] = (at - run) % 2 == 1
    return np.flatnonzero(out)


def spans(left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for. Rules use earlier ones only."""
    lengths = np.ones(base + len(left), np.int64)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True), base):
        lengths[i] = lengths[a] + lengths[b]
    return lengths[base:]


class Shard:
    """A shard as read back."""

    def __init__(self, row):
        wide = "<u4" if row.base + len(row.left) // 4 > 1 << 16 else "<u2"
        self.base = row.base
        self.doc_ids = np.frombuffer(row.doc_ids, "<i8")
        self.known = np.frombuffer(row.known, np.uint8).astype(bool)
        self.lengths = np.frombuffer(row.lengths, "<u4").astype(np.int64)
        self.ends = np.frombuffer(row.ends, "<u4").astype(np.int64)
        self.sequence = np.frombuffer(row.sequence, wide).astype(np.int64)
        self.left, self.right, self.rule_spans = (
            np.frombuffer(x, "<u4").astype(np.int64) for x in (row.left, row.right, row.spans)
        )
        self.spans = np.concatenate([np.ones(self.base, np.int64), self.rule_spans])
        self.places = np.cumsum(self.spans) - self.spans
        self.flat = np.arange(self.spans.sum())  # the ids themselves come first
        # Rules are expanded together as far as they use only expanded ones.
        newest, start = np.maximum(self.left, self.right), 0
        while start < len(newest):
            unknown = newest[start:] >= self.base + start
            stop = start + int(unknown.argmax()) if unknown.any() else len(newest)
            at = self.places[self.base + start]
            own = self.expand(np.column_stack([self.left, self.right])[start:stop].ravel())
            self.flat[at : at + len(own)] = own
            start = stop

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.spans[symbols]
        shift = self.places[symbols] - (np.cumsum(n) - n)
        return self.flat[np.repeat(shift, n) + np.arange(n.sum())]

    def read_all(self) -> np.ndarray:
        """Ids of all documents, one after the other."""
        return self.expand(self.sequence)

    def symbols(self, document: int) -> np.ndarray:
        return self.sequence[self.ends[document - 1] if document else 0 : self.ends[document]]

    def read(self, document: int) -> np.ndarray:
        return self.expand(self.symbols(document))

    def read_range(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a document, expanding only what holds them."""
        symbols = self.symbols(document)
        ends = np.cumsum(self.spans[symbols])
        a, b = np.searchsorted(ends, [start, stop - 1], side="right")
        skipped = ends[a - 1] if a else 0
        return self.expand(symbols[a : b + 1])[start - skipped : stop - skipped]


def _shard(part: int, number: int, first: int, doc_ids: list, ids: list[bytes], base: int) -> dict:
    lengths = np.array([len(x) // 4 for x in ids], np.int64)
    sequence, ends, left, right = grammar(np.frombuffer(b"".join(ids), "<u4"), lengths, base)
    wide = "<u4" if base + len(left) > 1 << 16 else "<u2"
    known = np.array([x is not None for x in doc_ids], np.uint8)
    return {
        "part": part,
        "shard": number,
        "first": first,
        "n_tokens": int(lengths.sum()),
        "base": base,
        "doc_ids": np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        "known": known.tobytes(),
        "lengths": lengths.astype("<u4").tobytes(),
        "ends": ends.astype("<u4").tobytes(),
        "sequence": sequence.astype(wide).tobytes(),
        "left": left.astype("<u4").tobytes(),
        "right": right.astype("<u4").tobytes(),
        "spans": spans(left, right, base).astype("<u4").tobytes(),
    }


def write_tokens(documents: DataFrame, path: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes the documents and writes the shards below ``path``."""

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(tokenizer)
        part, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, ids, held = [], [], 0
        for batch in batches:
            for doc_id, own in zip(batch["doc_id"], encoder.each(batch["text"].tolist(), END), strict=True):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                ids.append(own.tobytes())
                held += len(own)
                if held >= shard_tokens:
                    yield pd.DataFrame([_shard(part, number, first, doc_ids, ids, encoder.size)])
                    number, first, doc_ids, ids, held = number + 1, first + held, [], [], 0
        if ids:
            yield pd.DataFrame([_shard(part, number, first, doc_ids, ids, encoder.size)])

    (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInPandas(shards, SHARD)
        .write.parquet(path)
    )


def read_tokens(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the shards."""
    # A row for each part, that is for each task that wrote: prefix sums over
    # these do not grow with the documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_first"))

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                shard = Shard(row)
                starts = row.part_first + row.first + np.cumsum(shard.lengths) - shard.lengths
                ends = (4 * np.cumsum(shard.lengths)).tolist()
                ids = memoryview(shard.read_all().astype("<u4").tobytes())
                crc = [zlib.crc32(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
                doc_ids = pd.array(shard.doc_ids, dtype="Int64")
                doc_ids[~shard.known] = pd.NA
                yield pd.DataFrame(
                    {"doc_id": doc_ids, "start": starts, "n_tokens": shard.lengths, "ids_crc32": crc}
                )

    return shards.join(F.broadcast(parts), "part").mapInPandas(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
