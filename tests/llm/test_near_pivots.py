"""Fingerprints and pivots of the near-copy stage."""

import random
from math import ceil, comb

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import simhash
from tidemark.llm.common import prepare, stored


def differing(common, one, other):
    """Odds that a bit differs in sets that share hashes and have so many of their own."""

    def odds(n):
        return np.array([comb(n, k) for k in range(n + 1)], float) / 2.0**n

    shared = np.arange(common + 1)[:, None]
    a, b = ((2 * (shared + np.arange(n + 1)) > common + n) @ odds(n) for n in (one, other))
    return float(odds(common) @ (a * (1 - b) + b * (1 - a)))


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9])
def test_radius_holds_for_sets_of_every_size(similarity):
    worst = max(
        differing(common, one, size - common - one)
        for size in range(1, 60)
        for common in range(ceil(size * similarity - 1e-9), size + 1)
        for one in range((size - common) // 2 + 1)
    )
    bits, radius = 64 * simhash.WIDE, simhash.wide_radius(similarity)
    lost = sum(comb(bits, k) * worst**k * (1 - worst) ** (bits - k) for k in range(radius + 1, bits + 1))
    assert lost <= simhash.LOST


def test_wide_fingerprints_tell_texts_apart():
    draw = np.random.default_rng(3)
    for size in (5, 10, 40, 300, 20_000):
        own = draw.integers(0, 2**64, size, dtype=np.uint64)
        less = own[: size - size // 5]  # a similarity of 0.8
        other = draw.integers(0, 2**64, size, dtype=np.uint64)
        mark, near, far = (simhash.wide_fingerprint(x) for x in (own, less, other))
        assert np.bitwise_count(mark ^ near).sum() <= simhash.wide_radius(0.8) < np.bitwise_count(mark ^ far).sum()
        assert np.array_equal(mark, simhash.wide_fingerprint(own[::-1]))


def families(spark):
    """Two families of edited copies that have a rare line in common, and its near copies."""
    draw = random.Random(3)
    line, texts = [f"rare{i}" for i in range(12)], []
    for family in range(2):
        base = [f"f{family}w{draw.randrange(10**6)}" for _ in range(160)]
        for k in range(10):
            copy = list(base)
            copy[16 * k] = f"new{family}x{k}"
            texts.append(" ".join([*line, *copy]))
    rows = [*enumerate(texts), (50, " ".join(f"alone{i}" for i in range(50))), (51, None), (None, texts[0] + " end")]
    return stored(prepare(spark).createDataFrame(rows, "doc_id long, text string"), "families")


def test_pivots_discard_pairs_before_texts_are_compared(spark, monkeypatch):
    docs, compared, across = families(spark), [], []

    def seen(pairs, sets, similarity):
        compared.extend((r.a.doc_id, r.b.doc_id) for r in pairs.collect())
        return similar(pairs, sets, similarity)

    def met(*args):
        found = pairs_across(*args)
        across.append({(r.a.doc_id, r.b.doc_id) for r in found.collect()})
        return found

    similar, pairs_across = simhash.similar, simhash.pairs_across
    monkeypatch.setattr(simhash, "similar", seen)
    monkeypatch.setattr(simhash, "pairs_across", met)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept == {None, 10, 50, 51}
    assert compared and all((a or 0) // 10 == (b or 0) // 10 for a, b in compared)
    # The first key that both families have leads from one to the other; its pivot keeps them apart.
    assert not any((a or 0) // 10 != (b or 0) // 10 for a, b in across[0])


def test_nothing_is_found_without_fingerprints(spark, monkeypatch):
    docs = families(spark)
    monkeypatch.setattr(simhash, "wide_radius", lambda similarity: -1)
    assert simhash.without_near_duplicates(docs).count() == docs.count()


def test_pivot_table(spark):
    docs = families(spark)
    with simhash.workspace(spark, "pivot-table") as put:
        nodes = docs.filter(F.length("text") > 0).select(F.struct(*simhash._key()).alias("node"))
        sets = simhash.shingles_of(docs, nodes, put)
        rows = simhash.prefixes(sets, put)
        marks = {r.node: np.array(r.fp, np.int64) for r in sets.collect()}
        table = simhash.data_pivots(rows, sets, put).collect()
        pivots = {}
        for r in rows.collect():
            pivots.setdefault(r.key, []).append((r.alone, (r.node.doc_id is not None, *r.node[:]), r.node))
        want = {(m[2], min(members, key=lambda x: (x[0], x[1][0], x[1][1] or 0, x[1][2]))[2]) for members in pivots.values() for m in members}
        assert {(r.a, r.b) for r in table} == want
        assert all(r.distance == np.bitwise_count((marks[r.a] ^ marks[r.b]).view(np.uint64)).sum() for r in table)
