"""Quality by weak labels: heuristic labellers, their accuracies, a hashed scorer.

Labellers look at a text's shape and vote good (1), bad (-1) or nothing (0). They
overlap, and none is trusted: expectation-maximisation over the counts of all vote
patterns estimates how often each is right about good and about bad texts, and how
common good texts are. A pattern's posterior then labels every text that shows it,
and these labels train a linear scorer over hashed runs of ``GRAM`` bytes, which
also reads what no labeller looks at.

Votes are counted over all documents; patterns are few (three to the number of
labellers at most), so the estimation is small whatever the input. The scorer is
fitted on a bounded sample, ``FIT_ROWS`` documents in order of a hash.

Defined results: a NULL or empty text gets votes like any short text and the score
of its posterior; identifiers may be NULL or repeat; an empty input gives no rows.
Only texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

FIT_ROWS = 4_000
GRAM, BUCKETS = 4, 1 << 16
#: Good texts score at least this.
THRESHOLD = 0.5
ROUNDS = 60
#: How often a labeller is believed to vote bad, nothing, good on bad and on good
#: texts before any is seen, and what that counts for, as a share of all texts. A
#: bad text is bad in one way, seldom in all, so most labellers find it good.
BELIEF = np.array([[0.25, 0.08, 0.67], [0.004, 0.046, 0.95]])
TRUST = 0.25


#: Classes of bytes: letters (and all of what is not ASCII), marks, capitals, ends of sentences.
LETTERS, MARKS, CAPITALS, ENDS = (np.zeros(256, np.int64) for _ in range(4))
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
CAPITALS[65:91] = 1
ENDS[[33, 46, 63]] = 1
NAMES = ("symbols", "letters", "variety", "lines", "case", "word_length", "sentences", "length")


def votes_of(text: str) -> list[int]:
    """Votes of the labellers, in the order of ``NAMES``."""
    data = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, letters, marks = max(1, len(data)), int(LETTERS @ count), int(MARKS @ count)
    capitals, ends = int(CAPITALS @ count), int(ENDS @ count)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    new_words = len(set(words)) / max(1, len(words))
    new_lines = len(set(lines)) / max(1, len(lines))
    mean = letters / max(1, len(words))

    def vote(good: bool, bad: bool) -> int:
        return -1 if bad else int(good)

    return [
        vote(marks < 0.05 * n, marks > 0.12 * n),
        vote(letters > 0.75 * n, letters < 0.62 * n),
        vote(new_words > 0.45, len(words) > 20 and new_words < 0.3),
        vote(new_lines == 1, new_lines < 0.7),
        vote(capitals < 0.1 * letters, capitals > 0.4 * max(1, letters)),
        vote(2.5 <= mean <= 9, not 1.5 <= mean <= 15),
        vote(ends > 0 and len(words) < 60 * ends, len(words) > 80 and len(words) > 200 * ends),
        vote(len(words) > 30, len(words) < 4),
    ]


def with_votes(documents: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text) and votes of each document."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "h"]].assign(votes=[votes_of(t) for t in batch["text"]])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    return rows.mapInPandas(vote, "doc_id long, h long, votes array<int>")


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, dict]:
    """Posterior of each pattern, and what was estimated: ``rates[c, j, v]`` is how
    often labeller j votes v - 1 on texts of class c (0 bad, 1 good)."""
    n, labels = patterns.shape
    hit = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    rates = np.empty((2, labels, 3))
    rates[:] = BELIEF[:, None]
    prior = 0.8
    posterior = np.full(n, 0.5)
    for _ in range(rounds):
        seen = np.einsum("njv,cjv->cn", hit, np.log(rates)) + np.log([1 - prior, prior])[:, None]
        posterior = 1 / (1 + np.exp(np.clip(seen[0] - seen[1], -500, 500)))
        for c, share in ((0, 1 - posterior), (1, posterior)):
            weight = counts * share
            held = TRUST * counts.sum()
            rates[c] = (np.einsum("n,njv->jv", weight, hit) + held * BELIEF[c]) / (weight.sum() + held)
        prior = float(np.clip((counts * posterior).sum() / counts.sum(), 0.01, 0.99))
    accuracy = {
        name: float(prior * rates[1, j, 2] + (1 - prior) * rates[0, j, 0]) for j, name in enumerate(NAMES[:labels])
    }
    return posterior, {"prior": prior, "rates": rates, "accuracy": accuracy}


def posteriors(votes: DataFrame) -> tuple[dict[tuple, float], dict]:
    """From the votes of all documents."""
    counts = votes.groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** labellers rows
    if not counts:
        return {}, {}
    patterns = np.array([r.votes for r in counts])
    found, model = estimate(patterns, np.array([r.n for r in counts], float))
    return {tuple(r.votes): float(p) for r, p in zip(counts, found, strict=True)}, model


def buckets(text: str) -> np.ndarray:
    """Buckets of the text's runs of bytes."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").ljust(GRAM), np.uint8).astype(np.uint32)
    n = len(data) - GRAM + 1
    total = np.zeros(n, np.uint32)
    for k in range(GRAM):
        total = total * np.uint32(0x01000193) ^ data[k : k + n]
    total *= np.uint32(0x9E3779B1)
    return total >> np.uint32(16)


def linear(text: str, weights: np.ndarray) -> float:
    """Weights of the text's buckets, by the length of its count vector."""
    own = buckets(text)
    if len(own) < BUCKETS // 8:
        place, count = np.unique(own, return_counts=True)
    else:
        count = np.bincount(own, minlength=BUCKETS)
        place = slice(BUCKETS)
    return float(weights[place] @ count / np.sqrt((count * count).sum()))


def train(texts: list[str], posterior: np.ndarray, epochs: int = 12, rate: float = 2.0) -> np.ndarray:
    """Logistic regression on bucket counts of length 1, by passes over the sample in a
    fixed order; the last weight is the offset."""
    own = [np.unique(buckets(t), return_counts=True) for t in texts]
    weights = np.zeros(BUCKETS + 1)
    prior = np.clip(posterior.mean() if len(posterior) else 0.5, 0.01, 0.99)
    weights[-1] = np.log(prior / (1 - prior))
    order = np.random.default_rng(5).permutation(len(texts))
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for i in order:
            place, count = own[i]
            share = count / np.sqrt((count * count).sum())
            z = weights[place] @ share + weights[-1]
            error = posterior[i] - 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            weights[place] += step * error * share
            weights[-1] += 0.01 * error
    return weights


def quality_scores(documents: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, posterior, score, keep, predicted, votes of each document. The score
    is the mean of what the labellers' posterior and the hashed scorer say."""
    votes = stored(with_votes(documents), "quality-votes")
    by_pattern, _ = posteriors(votes)
    # Different texts, then the documented bound of the fit.
    chosen = votes.select("votes", "h").dropDuplicates(["h"]).orderBy("h").limit(rows)
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sample = (
        own.withColumn("h", F.xxhash64("text"))
        .join(F.broadcast(chosen), "h")
        .dropDuplicates(["h"])
        .orderBy("h")
        .toPandas()
    )
    target = np.array([by_pattern[tuple(v)] for v in sample["votes"]])
    weights = train(sample["text"].tolist(), target)
    shared = documents.sparkSession.sparkContext.broadcast((by_pattern, weights))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, w = shared.value
        for batch in batches:
            votes = [votes_of(t) for t in batch["text"]]
            posterior = np.array([table[tuple(v)] for v in votes])
            z = np.array([linear(t, w) for t in batch["text"]]) + w[-1]
            hashed = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            value = (posterior + hashed) / 2
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "posterior": posterior,
                    "score": value,
                    "keep": value >= THRESHOLD,
                    "predicted": (value >= THRESHOLD).astype("int32"),
                    "votes": votes,
                }
            )

    schema = "doc_id long, posterior double, score double, keep boolean, predicted int, votes array<int>"
    return own.mapInPandas(score, schema)
