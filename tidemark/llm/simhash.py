"""Near-duplicate groups by SimHash, with pivot distance tables.

A fingerprint has a bit for each position that is set in over half of the hashes of
a text's word shingles. Distances to ``PIVOTS`` reference fingerprints are computed
once for each distinct fingerprint; a pair is discarded if any of these distances
differs by more than the radius (the triangle inequality), and survivors are
compared bit by bit. Random references alone pass about a third of unrelated pairs
each, so pairs are only looked for among fingerprints that agree in all but as many
blocks of bits as the radius: of 64 bits in 5 blocks, a pair within 2 bits agrees
in 3. That is exact, and such keys are shared by few fingerprints.

``near_duplicates`` is meant for texts that share most, not all, of their words. Texts
are linked if their five-word shingles have a Jaccard similarity of ``SIMILARITY`` or
more. It takes the same steps: keys, pivot distances, bits, and then the shingles
themselves. Keys come from a prefix filter, which is exact: of a text's shingles in one
order for all, rarest first, those up to the first that a similar text must have; sizes
and the places of the key must allow the similarity. Fingerprints have ``WIDE`` times
64 bits, made from the distinct shingles. Random references discard nothing at the
radius that such texts need, so pivots are texts: under a key the one with the fewest
shingles of its own. Each text is first compared with its pivots, whose distances make
the pivot table. Pairs under a key that this has left in different groups are compared
next, all but those that pivot distances, then bits, exclude. The radius is not a
parameter: it follows from the similarity (``wide_radius``), so that a link is lost with
odds of ``LOST`` at most.

Defined results: a NULL text is an empty text; texts without words have the
fingerprint 0; repeated rows share their group; a group's id is its smallest
identifier, NULL only if it has no other; an empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial, reduce
from itertools import combinations
from math import acos, comb, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hand_back, small, stored, text_of, unused, workspace
from tidemark.llm.graph import components
from tidemark.llm.substrings import Words

SHINGLE_WORDS, RADIUS = 3, 2
BLOCKS, PIVOTS = 5, 16
SEED = 42


def words_of(text: str) -> list[bytes]:
    """Words, cut at ASCII white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    return np.fromiter(map(partial(xxh64_intdigest, seed=SEED), shingles), np.uint64, len(shingles))


def majorities(hashes: np.ndarray) -> np.ndarray:
    """For each column of hashes, the bits set in over half of them."""
    rows, columns = hashes.shape
    counts = np.zeros(64 * columns, np.int64)
    for i in range(0, rows, 255):  # so many ones fit a byte
        some = np.ascontiguousarray(hashes[i : i + 255], "<u8").view(np.uint8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * counts > rows, bitorder="little").view("<u8")


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as an unsigned number."""
    return int(majorities(hashes[:, None])[0])


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number."""

    def fingerprint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [majority(shingle_hashes(words_of(t), shingle_words)) for t in batch["text"]]
            fp = np.array(found, np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": fp})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(fingerprint, "doc_id long, fp long")


def references(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, spread over the space by a fixed rule."""
    draw = np.random.default_rng(SEED)
    return [int(x) for x in draw.integers(-(2**63), 2**63 - 1, n, dtype=np.int64)]


def pivot_table(fp: Column) -> list[Column]:
    """Distances to the references, eight to a number, in columns p0, p1, ..."""
    distances = [F.bit_count(fp.bitwiseXOR(F.lit(r))).cast("long") for r in references()]
    packed = []
    for i in range(0, len(distances), 8):
        total = F.lit(0).cast("long")
        for k, distance in enumerate(distances[i : i + 8]):
            total = total.bitwiseOR(F.shiftleft(distance, 8 * k))
        packed.append(total.alias(f"p{i // 8}"))
    return packed


def pivots_allow(left: str, right: str, radius: int) -> Column:
    """No coordinate differs by more than the radius."""
    allowed = F.lit(True)
    for i in range(PIVOTS):
        one, other = (
            F.shiftright(F.col(f"{side}p{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255)) for side in (left, right)
        )
        allowed = allowed & (F.abs(one - other) <= radius)
    return allowed


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """All bits but those of ``radius`` blocks, as signed numbers, for each choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    own = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    masks = []
    for dropped in combinations(range(blocks), radius):
        mask = sum(own[i] for i in range(blocks) if i not in dropped)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def linked(classes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs of distinct fingerprints within the radius: a, b."""
    keys = [
        F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(block_masks(blocks, radius))
    ]
    rows = classes.select("fp", *pivot_table(F.col("fp")), F.explode(F.array(*keys)).alias("k"))
    rows = rows.select("fp", "p0", "p1", "k.kind", "k.key")
    near = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= radius
    same_key = (F.col("l.kind") == F.col("r.kind")) & (F.col("l.key") == F.col("r.key"))
    pairs = rows.alias("l").join(
        rows.alias("r"), same_key & (F.col("l.fp") < F.col("r.fp")) & pivots_allow("l.", "r.", radius) & near
    )
    return pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_groups(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: the smallest identifier reachable."""
    rows = stored(fingerprints(documents), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = stored(components(linked(classes, radius)), "fingerprint-roots")
    least = roots.join(classes, roots["node"] == classes["fp"]).groupBy("root").agg(F.min("first").alias("least"))
    named = roots.join(least, "root").select(F.col("node").alias("fp"), "least")
    classes = classes.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


# Near duplicates that share most of their words.

SIMILARITY, SIMILAR_SHINGLE = 0.8, 5
#: One of so many more shingles than its prefix has is looked at, to leave
#: unrelated documents out early.
FURTHER = 16
#: Bytes of text that are hashed at once.
TEXT_BYTES = 1 << 20
#: Numbers of 64 bits of a wide fingerprint, and the odds that a pair of similar texts
#: has one outside the radius, at most.
WIDE, LOST = 8, 1e-12
NODE = "doc_id long, text_hash long"
Put = Callable[[DataFrame, str], DataFrame]


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """Ascending hashes of the distinct shingles of each text; a shorter text is
    one shingle, a text without words has none."""
    some, held = [], 0
    for text in [*texts, None]:
        if text is not None:
            some.append(text.encode("utf-8", "surrogatepass").lower())
            held += len(some[-1])
        if some and (text is None or held >= TEXT_BYTES):
            words = Words(some)
            counts = np.diff(words.first)
            many = np.maximum(counts - SIMILAR_SHINGLE + 1, 0)
            ends = np.cumsum(many)
            at = np.arange(many.sum()) + np.repeat(words.first[:-1] - (ends - many), many)
            hashes = words.paths(at, SIMILAR_SHINGLE)
            for first, n, k, end in zip(words.first[:-1], counts, many, ends, strict=True):
                own = hashes[end - k : end] if k or not n else words.paths(np.array([first]), int(n))
                yield np.unique(own)
            some, held = [], 0


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of ``WIDE`` numbers. Each is made from other bits: the hashes are mixed
    anew for it (the finalizer of SplitMix64)."""
    mixed = hashes[:, None] + np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return majorities(mixed ^ (mixed >> np.uint64(31)))


@lru_cache
def wide_radius(similarity: float) -> int:
    """Differing bits of wide fingerprints that similar texts have at most, but for
    odds of ``LOST``. Bits are independent, so their number is binomial. In large sets a
    bit differs as often as the angle between the sets says; in small ones, where half of
    the bits is a tie more often, up to sqrt(pi / 2) times as often."""
    angle = acos(min(1.0, 2 * similarity / (1 + similarity))) / pi
    odds, bits, beyond = min(0.5, angle * sqrt(pi / 2)), 64 * WIDE, 0.0
    for radius in range(bits, 0, -1):
        beyond += comb(bits, radius) * odds**radius * (1 - odds) ** (bits - radius)
        if beyond > LOST:
            return radius
    return 0


def needed(size, similarity: float):
    """Shingles that a text of ``size`` shares with any similar one, at least."""
    return np.ceil(size * similarity - 1e-9)


def _needed(size: Column, similarity: float) -> Column:
    return F.ceil(size * similarity - 1e-9)


def _key() -> list[Column]:
    """What tells documents apart: identifier and hash of the text."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash")]


def _hashed(documents: DataFrame, **take: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """node, size (number of shingles), and what each ``take`` makes of the shingles."""

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, taken = [], {name: [] for name in take}
            for own in shingle_sets(batch["text"].tolist()):
                sizes.append(len(own))
                for name, of in take.items():
                    taken[name].append(of(own).view(np.int64).copy())
            out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"]})
            yield out.assign(size=sizes, **taken)
        hand_back()

    found = documents.mapInPandas(hashes, f"{NODE}, size int, " + ", ".join(f"{name} array<long>" for name in take))
    return found.filter("size > 0").select(F.struct("doc_id", "text_hash").alias("node"), "size", *take)


def possible(documents: DataFrame, put: Put, similarity: float = SIMILARITY) -> DataFrame:
    """node of each document that can have a similar one. Of its m smallest hashes
    a similar text has all but as many as it may lack at all; so many, at least,
    must stand in a second document."""

    def smallest(own: np.ndarray) -> np.ndarray:
        return own[: len(own) - int(needed(len(own), similarity)) + 1 + len(own) // FURTHER]

    rows = documents.select(*_key(), text_of().alias("text")).filter(F.length(F.trim("text")) > 0)
    rows = put(_hashed(rows, keys=smallest), "near-prefixes")
    spread = rows.select("node", "size", F.explode("keys").alias("key"))
    twice = put(spread.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "near-keys")
    shared = spread.join(small(twice, 16), "key").groupBy("node", "size").agg(F.count("*").alias("n"))
    least = F.least(F.floor(F.col("size") / FURTHER) + 1, _needed(F.col("size"), similarity))
    return put(shared.filter(F.col("n") >= least).select("node"), "near-nodes")


def shingles_of(documents: DataFrame, nodes: DataFrame, put: Put) -> DataFrame:
    """node, size, keys (all of them) and fp, the wide fingerprint, of the given nodes."""
    rows = documents.select(F.struct(*_key()).alias("node"), text_of().alias("text"))
    asked = rows.join(small(nodes, 64), "node", "left_semi").select("node.doc_id", "node.text_hash", "text")
    sets = _hashed(asked, keys=lambda own: own, fp=wide_fingerprint)
    return put(sets.dropDuplicates(["node"]), "near-sets")


def prefixes(sets: DataFrame, put: Put, similarity: float = SIMILARITY) -> DataFrame:
    """key, node, size, place, alone: the rarest shingles of each document, one of
    which any similar one has; how many come before, and the share of shingles
    that no other document has."""
    spread = sets.select("node", "size", F.explode("keys").alias("key"))
    known = put(spread.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "near-known")
    ranked = spread.join(small(known, 24), "key").groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("ranked")
    )
    before = F.col("size") - F.size("ranked")
    length = F.col("size") - _needed(F.col("size"), similarity) + 1
    first = F.slice("ranked", F.lit(1), F.greatest(F.lit(0), (length - before).cast("int")))
    rows = ranked.select("node", "size", before.alias("before"), F.posexplode(first).alias("k", "one"))
    return put(
        rows.select(
            F.col("one.key").alias("key"),
            "node",
            "size",
            (F.col("k") + F.col("before")).alias("place"),
            (F.col("before") / F.col("size")).alias("alone"),
        ),
        "near-rare",
    )


def may_be_similar(left: str, right: str, similarity: float) -> Column:
    """Do both texts have enough shingles from this common one on, if it is their first?"""
    sizes, rest = [F.col(f"{s}size") for s in (left, right)], [F.col(f"{s}size") - F.col(f"{s}place") for s in (left, right)]
    return F.least(*rest) >= _needed(sizes[0] + sizes[1], similarity / (1 + similarity))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.selectExpr("least(l_node, r_node) AS a", "greatest(l_node, r_node) AS b").distinct()


def _sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns]) for s, df in (("l", left), ("r", right)))


def with_distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs and the number of bits in which their fingerprints differ."""
    for side in ("a", "b"):
        marks = sets.select(F.col("node").alias(side), F.col("fp").alias(f"{side}_fp"))
        pairs = pairs.join(small(marks, 8 * WIDE + 64), side)
    differing = [F.bit_count(F.col("a_fp")[i].bitwiseXOR(F.col("b_fp")[i])) for i in range(WIDE)]
    return pairs.withColumn("distance", reduce(Column.__add__, differing)).drop("a_fp", "b_fp")


def data_pivots(rows: DataFrame, sets: DataFrame, put: Put) -> DataFrame:
    """a, b, a_size, b_size, distance: each node under a key and the pivot there, the
    node with the fewest shingles of its own."""
    pivots = rows.groupBy("key").agg(F.min(F.struct("alone", "node", "size")).alias("pivot"))
    pivots = pivots.select("key", F.col("pivot.node").alias("b"), F.col("pivot.size").alias("b_size"))
    of = rows.withColumnsRenamed({"node": "a", "size": "a_size"}).join(pivots, "key")
    of = put(of.select("a", "b", "a_size", "b_size").distinct(), "near-pivot-pairs")
    return put(with_distances(of, sets), "near-pivots")


def led_pairs(pivots: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b: each node and a pivot of it, if sizes and bits allow the similarity."""
    sizes = F.least("a_size", "b_size") >= _needed(F.greatest("a_size", "b_size"), similarity)
    led = pivots.filter((F.col("a") != F.col("b")) & sizes & (F.col("distance") <= wide_radius(similarity)))
    return led.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def pairs_across(
    rows: DataFrame, roots: DataFrame, pivots: DataFrame, put: Put, similarity: float = SIMILARITY
) -> DataFrame:
    """Pairs of nodes that can be similar and have different roots: a, b. Under
    each key those outside its largest group are paired with all others whose distance
    from the pivot differs by no more than the radius."""
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = put(rows, "near-rooted")
    parts = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.min(F.struct("alone", "node")).alias("first"))
    keys = parts.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"), F.min("first").alias("first"), F.count("*").alias("parts")
    )
    keys = keys.filter("parts > 1").select("key", F.col("most.root").alias("most"), F.col("first.node").alias("pivot"))
    table = pivots.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "distance")
    mixed = put(rows.drop("alone").join(keys, "key").join(table, ["node", "pivot"]).drop("pivot"), "near-mixed")
    one, other = _sides(mixed.filter("root != most").drop("most"), mixed.drop("most"))
    apart = (F.col("l_root") != F.col("r_root")) & may_be_similar("l_", "r_", similarity)
    allowed = F.abs(F.col("l_distance") - F.col("r_distance")) <= wide_radius(similarity)
    return _pairs(one.join(other, (F.col("l_key") == F.col("r_key")) & apart & allowed))


def close(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose fingerprints allow the similarity: a, b."""
    return with_distances(pairs, sets).filter(F.col("distance") <= wide_radius(similarity)).select("a", "b")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose shingles are similar: a, b."""
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("keys").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("keys").alias("y")), "b"
    )
    both = F.size(F.array_intersect("x", "y"))
    return joined.filter(both >= (F.size("x") + F.size("y") - both) * F.lit(similarity) - 1e-9).select("a", "b")


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, root_id, root_hash of each document in a group of two or
    more: the member with the smallest identifier (then hash) is the root."""
    with workspace(documents.sparkSession, "near-duplicates") as put:
        sets = shingles_of(documents, possible(documents, put, similarity), put)
        rows = prefixes(sets, put, similarity)
        pivots = data_pivots(rows, sets, put)
        led = put(similar(put(led_pairs(pivots, similarity), "led"), sets, similarity), "links")
        roots = put(components(led, put), "roots")
        across = put(pairs_across(rows, roots, pivots, put, similarity), "across")
        across = put(close(across, sets, similarity), "close")
        found = components(led.union(similar(across, sets, similarity)), put)
        return stored(
            found.select(
                "node.doc_id",
                "node.text_hash",
                F.col("root.doc_id").alias("root_id"),
                F.col("root.text_hash").alias("root_hash"),
            ),
            "near-groups",
        )


def without_near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents but for those that are not the root of their group, all
    columns, whatever they are named."""
    groups = near_duplicates(documents, similarity)
    is_root = F.col("doc_id").eqNullSafe(F.col("root_id")) & (F.col("text_hash") == F.col("root_hash"))
    gone_id, gone_hash, own_id, own_hash = unused(documents, "gone_id", "gone_hash", "own_id", "own_hash")
    gone = groups.filter(~is_root).select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash))
    gone = small(stored(gone, "near-gone"), 64)
    doc_id, text_hash = _key()
    marked = documents.withColumns({own_id: doc_id, own_hash: text_hash})
    same = F.col(own_id).eqNullSafe(F.col(gone_id)) & (F.col(own_hash) == F.col(gone_hash))
    return marked.join(gone, same, "left_anti").drop(own_id, own_hash)
