"""Toxicity by a subsequence-kernel support vector machine.

Words are compared by the letters they share in the same order: the kernel of two
words counts common subsequences of three letters, each weighted by the room it
takes up, so gaps and inserted characters cost little. (Word start and end count
as letters; what is neither letter nor digit is left out; a run of single letters
is read as one word.) The kernel of two sentences sums over their words. A
Nyström map over landmark words makes it a linear one, and the machine is trained
on the sentences of labelled documents: all sentences of clean documents, and of
toxic ones those that the last round of training found most toxic.

As the map is linear in the words, a word has one number, and a sentence the sum
of its words' numbers. A document is scored by its most toxic sentences through a
logistic curve fitted to the labels.

Fitting uses a bounded sample, ``FIT_ROWS`` labelled documents in order of a hash;
scoring reads every whole text.

Defined results: a NULL or empty text has the score of a document without
sentences; identifiers may be NULL (such rows carry no label) or repeat; without
labelled rows of both kinds every score is 0; an empty input gives no rows. Only
texts are scored: no other column is an input.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import nlargest
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hand_back, text_of, unused

#: Most labelled documents that the fit uses.
FIT_ROWS = 2_000
#: Words whose numbers a task remembers at most.
REMEMBERED = 200_000
#: Words of a sentence at most; a longer one counts as several.
SENTENCE = 30
TOXIC_LANDMARKS, PLAIN_LANDMARKS = 64, 32
#: Room a subsequence may take up, and its weight for each letter left out.
ORDER, ROOM, DECAY = 3, 5, 0.75
#: Letters of a word read at once; longer words are read in overlapping parts.
PART = 24
CODES = 64
THRESHOLD = 0.3
HELD_OUT = 2
FEATURES = 6
SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+").split
LETTER_RUN = re.compile(r"(?<!\S)[^\W_](?:[\W_]+[^\W_]){2,}(?![^\W_])").findall
NOT_WORD = re.compile(r"[\W_]+").sub


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == HELD_OUT


def plain(word: str) -> str:
    return NOT_WORD("", word.lower())


def parts(word: str) -> list[str]:
    if len(word) <= PART:
        return [word]
    return [word[i : i + PART] for i in range(0, len(word) - PART // 2, PART // 2)]


def codes(words: list[str]) -> np.ndarray:
    """A row for each word: 1 for its start, letters, 2 for its end, 0 behind."""
    letters = np.array(words or [""], dtype=f"<U{PART}").view("<u4").reshape(-1, PART).astype(np.int32)
    lengths = (letters > 0).sum(1)
    own = np.where((letters >= 97) & (letters <= 122), letters - 94, 30 + letters % (CODES - 30))
    out = np.zeros((len(letters), lengths.max() + 2 + ROOM), np.int32)
    out[:, 1 : lengths.max() + 1] = np.where(letters > 0, own, 0)[:, : lengths.max()]
    out[:, 0] = 1
    out[np.arange(len(letters)), lengths + 1] = 2
    return out


def subsequences(coded: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Number and weight of the subsequences that each place of a word starts,
    one for each way to leave letters out; 0 where the word is too short."""
    width = coded.shape[1] - ROOM
    for rest in combinations(range(1, ROOM), ORDER - 1):
        number = coded[:, :width]
        for place in rest:
            number = number * CODES + coded[:, place : place + width]
        yield np.where(coded[:, rest[-1] : rest[-1] + width] > 0, number, 0), DECAY ** (rest[-1] - ORDER + 1)


def length_of(coded: np.ndarray) -> np.ndarray:
    """Of each word in the space of subsequences: a subsequence that stands in it
    more than once is one coordinate, the sum of its weights."""
    weights, keys = [], []
    for number, weight in subsequences(coded):
        if weight not in weights:
            weights.append(weight)
        word, place = np.nonzero(number)
        keys.append((word * CODES**ORDER + number[word, place]) * 8 + weights.index(weight))
    key = np.sort(np.concatenate(keys))
    if not len(key):
        return np.full(len(coded), np.sqrt(1e-9))
    starts = np.flatnonzero(np.diff(key >> 3, prepend=-1))
    sums = np.add.reduceat(np.array(weights)[key & 7], starts)
    total = np.bincount(key[starts] // (8 * CODES**ORDER), sums**2, minlength=len(coded))
    return np.sqrt(np.maximum(total, 1e-9))


class Kernel:
    """Kernel of any word with the landmark words."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        coded = codes(landmarks)
        norm = length_of(coded)
        found = list(subsequences(coded))
        self.numbers = np.unique(np.concatenate([n[n > 0] for n, _ in found]))
        self.row_of = np.zeros(CODES**ORDER, np.uint16)
        self.row_of[self.numbers] = np.arange(1, len(self.numbers) + 1)
        #: A row for each subsequence, the first for all that no landmark has.
        self.weights = np.zeros((len(self.numbers) + 1, len(landmarks)), np.float32)
        for number, weight in found:
            word, place = np.nonzero(number)
            np.add.at(self.weights, (self.row_of[number[word, place]], word), weight / norm[word])

    def sums(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """Sum of rows of ``weights`` over the subsequences of each word, by its
        length in the space of subsequences."""
        coded = codes(words)
        out = np.zeros((len(coded), weights.shape[1]), np.float32)
        for number, weight in subsequences(coded):
            row = self.row_of[number]
            if weights.shape[1] == 1:
                out[:, 0] += np.float32(weight) * weights[row, 0].sum(1)
                continue
            word, place = np.nonzero(row)
            if len(word):
                starts = np.flatnonzero(np.diff(word, prepend=-1))
                out[word[starts]] += np.float32(weight) * np.add.reduceat(weights[row[word, place]], starts, axis=0)
        return out / length_of(coded)[:, None].astype(np.float32)

    def __call__(self, words: list[str]) -> np.ndarray:
        return self.sums(words, self.weights)

    def machine(self, beta: np.ndarray) -> np.ndarray:
        """The weighted landmarks as one column of weights of subsequences."""
        return (self.weights @ beta)[:, None].astype(np.float32)


class Scorer:
    """Numbers of words, remembered; scores of sentences and documents."""

    def __init__(self, kernel: Kernel | None, beta: np.ndarray, curve: np.ndarray):
        self.kernel, self.beta, self.curve = kernel, beta, curve
        self.machine = kernel.machine(beta) if kernel else None
        self.numbers: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        """Numbers of words not met before."""
        new = list(words - self.numbers.keys())
        if len(self.numbers) + len(new) > REMEMBERED:
            self.numbers.clear()
            new = list(words)
        for i in range(0, len(new), 4096):
            own = new[i : i + 4096]
            cut = [parts(plain(w)) for w in own]
            value = self.kernel.sums([p for ps in cut for p in ps], self.machine)[:, 0]
            first = np.cumsum([0] + [len(ps) for ps in cut[:-1]])
            self.numbers.update(zip(own, np.maximum.reduceat(value, first).tolist(), strict=True))

    def features(self, text: str) -> list[float]:
        """Of the most toxic sentence, the three most toxic ones, and the most
        toxic words; a word counts once in a sentence."""
        number, sums, words = self.numbers.__getitem__, [], set()
        for sentence in sentence_words(text):
            own = set(sentence)
            words |= own
            sums.append(sum(map(number, own)))
        if not sums:
            return [0.0] * FEATURES
        top = nlargest(3, sums)
        values = nlargest(8, map(number, words))
        best = {round(v, 3) for v in values}  # forms of one word count once
        best = sorted(best, reverse=True)[:3]
        return [top[0], sum(top) / 3, values[0], values[0] ** 2, sum(best) / 3, (sum(best) / 3) ** 2]

    def measured(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), FEATURES))
        for i in range(0, len(texts), 64):
            some = texts[i : i + 64]
            self.learn({w for t in some for w in t.split()} | {w for t in some for w in letter_runs(t)})
            out[i : i + 64] = [self.features(t) for t in some]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.kernel is None:
            return np.zeros(len(texts))
        return logistic(shaped(self.measured(texts)) @ self.curve)


def shaped(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), np.clip(features, -20, 20)])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def letter_runs(text: str) -> list[str]:
    """Single letters one after the other, as one word each run."""
    return [plain(run) for run in LETTER_RUN(text)]


def sentence_words(text: str) -> Iterator[list[str]]:
    for sentence in SENTENCES(text):
        words = sentence.split()
        for i in range(0, len(words), SENTENCE):
            yield words[i : i + SENTENCE]
    for run in letter_runs(text):
        yield [run]


def train_svm(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray, cost: float = 2.0, block: int = 1 << 14
) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps over blocks of
    rows from the machine ``w`` on; rows of weight 0 do not count, and the last
    weight is the offset. Ends when one row in a thousand changes sides."""
    width = x.shape[1] + 1
    ridge = np.eye(width)
    ridge[-1, -1] = 1e-6

    def inside(w: np.ndarray) -> np.ndarray:
        return (weight > 0) & (y * (x @ w[:-1].astype(np.float32) + w[-1]) < 1)

    active = inside(w)
    for _ in range(20):
        square, right = ridge.copy(), np.zeros(width)
        for i in range(0, len(x), block):
            some = np.flatnonzero(active[i : i + block]) + i
            own = np.column_stack([x[some], np.ones(len(some), np.float32)])
            weighted = own * (2 * cost * weight[some, None]).astype(np.float32)
            square += weighted.T @ own
            right += weighted.T @ y[some].astype(np.float32)
        w = np.linalg.solve(square, right)
        now = inside(w)
        moved = (now != active).sum()
        active = now
        if moved * 1000 <= len(x):
            break
    return w


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 4) -> Scorer:
    """From labelled documents (a bounded number)."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Scorer(None, np.zeros(0), np.zeros(FEATURES + 1))
    kernel = Kernel(choose_landmarks(texts, toxic))
    table: dict[str, int] = {}
    words, sizes, document_of = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for sentence in sentence_words(text):
            own = set(sentence)
            words.extend(table.setdefault(w, len(table)) for w in own)
            sizes.append(len(own))
            document_of.append(d)
    if not document_of:
        return Scorer(None, np.zeros(0), np.zeros(FEATURES + 1))
    words, sizes, document_of = (np.frombuffer(v, np.int32) for v in (words, sizes, document_of))
    similar = np.zeros((len(table), len(kernel.landmarks)), np.float16)
    order = list(table)
    for i in range(0, len(order), 4096):
        cut = [parts(plain(w)) for w in order[i : i + 4096]]
        first = np.cumsum([0] + [len(ps) for ps in cut[:-1]])
        similar[i : i + 4096] = np.maximum.reduceat(kernel([p for ps in cut for p in ps]), first)
    among = kernel(kernel.landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = (vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    starts = np.cumsum(sizes) - sizes
    mapped = np.zeros((len(sizes), len(kernel.landmarks)), np.float32)
    for i in range(0, len(sizes), 8192):
        stop = starts[i + 8192] if i + 8192 < len(sizes) else len(words)
        own = similar[words[starts[i] : stop]].astype(np.float32)
        mapped[i : i + 8192] = np.add.reduceat(own, starts[i : i + 8192] - starts[i], axis=0) @ root
    del similar, order, table, words
    positive = toxic[document_of]
    picked = positive.copy()
    w = np.zeros(mapped.shape[1] + 1)
    for _ in range(rounds):
        y = np.where(picked, 1.0, -1.0)
        weight = np.where(picked, 1000 / max(1, picked.sum()), np.where(positive, 0, 1000 / max(1, (~positive).sum())))
        w = train_svm(mapped, y, weight, w)
        score = mapped @ w[:-1] + w[-1]
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, document_of, score)
        picked = positive & ((score > 0) | (score == best[document_of]))
    scorer = Scorer(kernel, (root @ w[:-1]).astype(np.float32), np.zeros(FEATURES + 1))
    scorer.curve = _curve(shaped(scorer.measured(texts)), toxic.astype(float))
    return scorer


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def choose_landmarks(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Words that tell toxic documents most, and the commonest others."""
    count: dict[str, list[int]] = {}
    for text, label in zip(texts, toxic, strict=True):
        words = {p for w in text.split() for p in parts(plain(w)) if p} | set(letter_runs(text))
        for word in words:
            count.setdefault(word, [0, 0])[int(label)] += 1
    base = toxic.mean()
    gain = {
        w: p * np.log((p + 0.5 * base) / ((p + n + 0.5) * base)) for w, (n, p) in count.items() if p > 1
    }
    ranked = sorted((w for w in gain if gain[w] > 0), key=lambda w: (-gain[w], w))
    chosen = ranked[:TOXIC_LANDMARKS]
    common = sorted(count, key=lambda w: (-count[w][0], w))
    chosen += [w for w in common[: 4 * PLAIN_LANDMARKS] if w not in chosen][:PLAIN_LANDMARKS]
    return chosen


def training_sample(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``rows`` labelled documents, none held out."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # the documented bound of the fit
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sample = own.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
    found = sample.select("text", "toxic").toPandas()
    return found["text"].tolist(), found["toxic"].to_numpy().astype(int) == 1


def fitted(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Scorer:
    texts, toxic = training_sample(documents, labels, rows)
    return fit(texts, toxic)


def with_scores(documents: DataFrame, scorer: Scorer, name: str = "score") -> DataFrame:
    """The documents, all columns, and their score."""
    if name in documents.columns:
        raise ValueError(f"there is a column {name} already")
    landmarks = scorer.kernel.landmarks if scorer.kernel else []
    shared = documents.sparkSession.sparkContext.broadcast((landmarks, scorer.beta, scorer.curve))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        landmarks, beta, curve = shared.value
        own = Scorer(Kernel(landmarks) if landmarks else None, beta, curve)
        for some in texts:
            yield pd.Series(own.scores(some.tolist()), dtype="float64")
        del own
        hand_back()

    return documents.withColumn(name, score(text_of()))


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, all columns."""
    (name,) = unused(documents, "toxicity")
    scored = with_scores(documents, fitted(documents, labels), name)
    return scored.filter(F.col(name) < threshold).drop(name)


def toxicity_scores(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    scorer = fitted(documents, labels, rows)
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    scored = with_scores(own, scorer)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
