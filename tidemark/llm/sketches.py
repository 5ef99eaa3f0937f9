"""Document fingerprints: threshold-scaled sketches.

A text's shingles are its runs of ``SHINGLE`` characters (one shingle if it is
shorter; none if it is empty). Of their 32-bit hashes the sketch keeps all below a
fixed fraction of the range, so sketches of any two texts keep the same shingles,
their union is the sketch of both texts together, and the share of one sketch in
another estimates containment however unequal the texts are.

``edited`` gives each text with its last quarter replaced by the start of the next
document's. Documents are dealt out by ranges of the identifier; the first row of
a range is also sent to the range before it, so that no task needs another's rows.

Defined results: a NULL text is an empty text, its sketch is empty, and two empty
sketches are alike (1) if both texts are empty, else not (0); NULL identifiers
come first, equal ones in order of their texts; a single document is its own next;
an empty input gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

SHINGLE = 8
#: One of so many hashes is kept. A text of 28 characters keeps 2.6 on average.
SCALE = 8
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
#: Bytes of text that one range is meant to hold.
RANGE_BYTES = 32 << 20
#: Ranges at most, beyond which they hold more; a task sorts its range on disk
#: and reads it as a stream.
MOST_RANGES = 4096


def sketch(text: str) -> np.ndarray:
    """Kept hashes, ascending, each once."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(letters):
        return np.zeros(0, np.uint32)
    n = max(1, len(letters) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    letters = (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    letters ^= letters >> np.uint64(29)
    for k in range(min(SHINGLE, len(letters))):
        total *= np.uint64(0xD1342543DE82EF95)
        total += letters[k : k + n]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xDABA0B6EB09322E3)
    hashes = (total >> np.uint64(32)).astype(np.uint32)
    return np.unique(hashes[hashes < (1 << 32) // SCALE])


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sketch of two texts together."""
    return np.union1d(one, other)


def shared(one: np.ndarray, other: np.ndarray) -> int:
    return len(np.intersect1d(one, other, assume_unique=True))


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second has."""
    return shared(one, other) / len(one) if len(one) else 0.0


def resemblance(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of common shingles among all of both texts."""
    both = shared(one, other)
    union = len(one) + len(other) - both
    return both / union if union else 0.0


def likeness(a: str, b: str, one: np.ndarray, other: np.ndarray) -> float:
    return 1.0 if a == b else resemblance(one, other)


def written(hashes: np.ndarray) -> str:
    return b64encode(hashes.astype(">u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(b64decode(fingerprint), ">u4").astype(np.uint32)


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


def ranges(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, text, part, tail: the documents by ranges, and for each range a row
    more: the document after its last."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.max("doc_id").alias("top")).first()
    parts = min(MOST_RANGES, 1 + (size.n or 0) // range_bytes)
    cuts: list[int] = []
    if parts > 1 and size.top is not None:
        shares = [i / parts for i in range(1, parts)]
        cuts = sorted({int(c) for c in rows.approxQuantile("doc_id", shares, 0.2 / parts)})
    part = F.lit(0)
    if cuts:
        bounds = F.array(*map(F.lit, cuts))
        part = F.size(F.filter(bounds, lambda c: c <= F.col("doc_id")))
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(part)
    rows = rows.withColumn("part", part.cast("int"))
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))
    firsts = stored(rows.groupBy("part").agg(first["doc_id"].alias("first"), first["known"].alias("known")), "range-firsts")
    found = sorted(firsts.collect(), key=lambda r: r.part)
    numbers = [r.part for r in found]
    before = {n: numbers[i - 1] for i, n in enumerate(numbers)}  # the last range comes before the first
    heads = [(r.part, r.first, before[r.part]) for r in found]
    if not heads:
        return rows.withColumn("tail", F.lit(False))
    table = F.create_map(*[x for p, _, b in heads for x in (F.lit(p), F.lit(b))])
    id_of = F.create_map(*[x for p, i, _ in heads for x in (F.lit(p), F.lit(i).cast("long"))])
    is_head = F.col("doc_id").eqNullSafe(id_of[F.col("part")])
    to = table[F.col("part")]
    copies = F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("tail")),
        F.struct(to.alias("part"), F.lit(True).alias("tail")),
    )
    copies = F.when(is_head, copies).otherwise(F.slice(copies, 1, 1))
    return rows.select("doc_id", "text", F.explode(copies).alias("at")).select("doc_id", "text", "at.part", "at.tail")


def fingerprints(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Sketch of each text and of its edited form, and their likeness to each
    other and to the next document."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the row whose next one has not come yet
        for batch in batches:
            out = []
            for doc_id, text, part, tail in zip(
                batch["doc_id"], batch["text"], batch["part"], batch["tail"], strict=True
            ):
                if held and held[2] == part:
                    own = held[3] if held[3] is not None else sketch(held[1])
                    following = sketch(text)
                    out.append(_row(held[0], held[1], own, text, following))
                    held = None if tail else (doc_id, text, part, following)
                elif not tail:
                    held = (doc_id, text, part, None)
            yield _frame(out)

    return (
        ranges(documents, range_bytes)
        .repartitionByRange("part")
        .sortWithinPartitions("part", "tail", "doc_id", "text")
        .mapInPandas(pairs, RESULT)
    )


def _row(doc_id, text: str, own: np.ndarray, following: str, next_sketch: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = sketch(changed)
    return (
        None if pd.isna(doc_id) else int(doc_id),
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        written(own),
        written(other),
        likeness(text, changed, own, other),
        likeness(text, following, own, next_sketch),
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in RESULT.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "n_chars": "int64"})
