"""Toxic passages by maximum-scoring segments.

*Scores.* Words and their beginnings get the log-odds of being in toxic rather than
other documents. The counts of each are smoothed by a Dirichlet prior of strength
``PRIOR`` whose mean is what the next shorter beginning says, down to the share of
toxic documents; a word that was not seen has the odds of its longest known
beginning. Odds are reduced by their standard error, so that rare words count little.
All else costs ``PENALTY``.

*Segments.* One pass over the words finds all maximal segments: those that cannot be
extended or cut without losing score (Ruzzo and Tompa's algorithm). Those in which a
word comes again are divided, best part first: within a part a repeated word counts
``REPEATED`` of its score, behind it in full again. So one word said often is no strong
passage, near repeats stay in one, and a passage that comes again is found each time.

*Calibration.* The best segment of ``n`` ordinary words follows an extreme-value law:
its score times ``rate``, less the logarithm of ``n`` and a constant, has a Gumbel
distribution. Rate and constant come from documents that are not toxic; a segment is
significant if so high a score is unlikely by chance. A document's probability is a
logistic function of that excess, fitted on labelled documents that the scores were
not learned from.

Labels are learned from a bounded sample: at most ``SAMPLE`` labelled documents by a
hash of the id, and at most ``MOST_FEATURES`` word scores, which bounds what is sent
to the executors.

Defined results: NULL and empty texts have no segments and the probability of a text
with none; without labels nothing is toxic. Repeated rows get the same result (of
repeated texts one is learned from); an empty table gives an empty one; extra columns
are not looked at.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import Shared
from starloom.llm.decontam import words_of
from starloom.llm.lang_codes import fold
from starloom.llm.tables import only, ship, text_slices
from starloom.storage import materialize

SAMPLE = 20_000
MOST_FEATURES = 1 << 17
#: Features seen in fewer documents are left to a shorter beginning of the word.
LEAST_DOCS = 4
BEGINNINGS = (6, 5, 4, 3)
PRIOR = 10.0
#: Log-odds nearer to 0 than this are no evidence.
LEAST_ODDS = 1.0
PENALTY = 0.02
#: What a word's score is worth when the segment has the word already.
REPEATED = 0.1
#: The probability of a text in which nothing speaks for toxicity.
NO_SEGMENT = 1e-3
CACHED_WORDS = 200_000
#: Histogram of word scores, for the extreme-value rate.
STEP, REACH = 0.25, 16.0


def feature_names(word: bytes) -> list[bytes]:
    """The word, and its beginnings from long to short (marked, so that they are not words)."""
    return [word, *(word[:k] + b"-" for k in BEGINNINGS if len(word) >= k)]


class WordScores:
    """Scores of words from those of features."""

    def __init__(self, known: dict[bytes, float]):
        self.known = known
        self._cache: dict[bytes, float] = {}

    def __getstate__(self):
        return self.known

    def __setstate__(self, known):
        self.known, self._cache = known, {}

    def of(self, words: list[bytes]) -> np.ndarray:
        cache = self._cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        for word in set(words):
            if word in cache:
                continue
            score = next((self.known[f] for f in feature_names(word) if f in self.known), 0.0)
            cache[word] = score - PENALTY
        return np.fromiter(map(cache.__getitem__, words), np.float64, len(words))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments as (begin, end, score), in order."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    # begin, end, sum before it, sum at its end, and the nearest segment before it
    # whose sum before is smaller
    found: list[list] = []
    for at in np.flatnonzero(scores > 0).tolist():
        now = [at, at + 1, sums[at], sums[at + 1], -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= now[3]:
                now[4] = j
                found.append(now)
                break
            now = [found[j][0], now[1], found[j][2], now[3], -1]
            del found[j:]
    return [(a, b, float(r - l)) for a, b, l, r, _ in found]


def passages_of(words: list[bytes], scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Segments as (begin, end, score), in order, with repeats in a segment damped.

    Every word of a positive score is in one. A damped score is at most the sum of
    those of its parts, so the best parts lie in maximal segments of the plain scores.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    out = []
    for a, b, score in segments(scores):
        at = (np.flatnonzero(scores[a:b] > 0) + a).tolist()
        if len({words[p] for p in at}) == len(at):
            out.append((a, b, score))
        else:
            out += _divided(words, scores, sums, at)
    return sorted(out)


def _divided(words: list[bytes], scores: np.ndarray, sums: np.ndarray, at: list[int]) -> list[tuple[int, int, float]]:
    """The best damped segment over the positive words ``at``, and those left and right of it.

    A begin whose score has fallen to 0 is never better than a later one. When all
    begins up to the end of the best segment have, nothing that follows can change it.
    Of begins that have the same words behind them the best stays so, hence there are
    never more than different words.
    """
    out = []
    todo = [(0, len(at))]
    while todo:
        first, stop = todo.pop()
        if first >= stop:
            continue
        begins, values = np.empty(stop - first, np.int64), np.empty(stop - first)
        n, best, left, right = 0, 0.0, first, first
        last: dict[bytes, int] = {}
        lasts: list[int] = []
        for k in range(first, stop):
            p = at[k]
            if n:
                values[:n] += sums[p] - sums[at[k - 1] + 1]
                if values[:n].min() <= 0:
                    alive = values[:n] > 0
                    m = int(alive.sum())
                    begins[:m], values[:m], n = begins[:n][alive], values[:n][alive], m
                if not n or begins[0] > right:
                    break
            begins[n], values[n] = k, 0.0
            n += 1
            before = last.get(words[p], -1)
            again = int(np.searchsorted(begins[:n], before, "right"))
            values[:again] += REPEATED * scores[p]
            values[again:n] += scores[p]
            last[words[p]] = k
            if before >= 0:
                lasts.pop(bisect_left(lasts, before))
            lasts.append(k)
            if 0 < again < n and lasts[bisect_left(lasts, begins[again - 1])] >= begins[again]:
                worse = again if values[again - 1] >= values[again] else again - 1
                begins[worse : n - 1], values[worse : n - 1] = begins[worse + 1 : n], values[worse + 1 : n]
                n -= 1
            top = int(values[:n].argmax())
            if values[top] > best:
                best, left, right = float(values[top]), int(begins[top]), k
        out.append((at[left], at[right] + 1, best))
        todo += [(first, left), (right + 1, stop)]
    return out


@dataclass(frozen=True)
class ToxicModel:
    scores: WordScores = field(default_factory=lambda: WordScores({}))
    rate: float = 1.0
    constant: float = 0.0
    slope: float = 1.0
    offset: float = -8.0

    def excess(self, best: float, n_words: int) -> float:
        """How far a best score is above what so many words give by chance."""
        return self.rate * best - math.log(max(n_words, 1)) - self.constant

    def chance(self, best: float, n_words: int) -> float:
        """The probability that ordinary words have a segment of this score."""
        return -math.expm1(-math.exp(min(-self.excess(best, n_words), 700.0)))

    def probability(self, best: float, n_words: int) -> float:
        if best <= 0:
            return NO_SEGMENT
        z = max(-500.0, min(500.0, self.slope * self.excess(best, n_words) + self.offset))
        return 1 / (1 + math.exp(-z))


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, held_out: int, parts: int) -> DataFrame:
    """``toxic``, ``part`` and ``text`` of labelled documents outside the held-out fold, stored once."""
    given = only(labels, doc_id="doc_id", label=label_col).filter("doc_id is not null and label is not null")
    given = given.filter(fold("doc_id", parts) != held_out)
    given = given.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    given = given.filter("label = other").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.join(F.broadcast(given.select("doc_id", "label")), "doc_id").filter("text is not null")
    rows = rows.select(
        (F.col("label") == 1).cast("int").alias("toxic"),
        F.pmod(F.xxhash64(F.lit("calibrate"), "text"), F.lit(3)).cast("int").alias("part"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    return materialize(rows.dropDuplicates(["text_hash"]), "labelled")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, toxic and other, per slice."""
    for batch in text_slices(batches, 1):
        counts = Counter(), Counter()
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic].update({f for word in set(words_of(text)) for f in feature_names(word)})
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.binary()),
                pa.array([counts[1][f] for f in names], pa.int64()),
                pa.array([counts[0][f] for f in names], pa.int64()),
            ],
            names=["feature", "toxic", "other"],
        )


def learn_scores(sample: DataFrame) -> WordScores:
    """Smoothed log-odds of features, less (or, if negative, plus) their standard error."""
    ship(sample.sparkSession)
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return WordScores({})
    counts = sample.select("toxic", "text").mapInArrow(_count, "feature binary, toxic bigint, other bigint")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    often = F.col("toxic") + F.col("other")
    top = counts.filter(often >= LEAST_DOCS).orderBy(often.desc(), "feature").limit(MOST_FEATURES).collect()
    share = {b"": n1 / (n1 + n0)}
    known = {}
    # Beginnings end in a mark and are shorter than what they begin, so they come first.
    for feature, toxic, other in sorted(map(tuple, top), key=lambda row: (row[0][-1:] != b"-", len(row[0]))):
        feature = bytes(feature)
        parent = next(share[f] for f in [*_parents(feature), b""] if f in share)
        a, b = toxic + PRIOR * parent, other + PRIOR * (1 - parent)
        share[feature] = a / (a + b)
        odds = math.log((a + 0.5) / (b + 0.5)) - math.log((n1 + 0.5) / (n0 + 0.5))
        sure = max(abs(odds) - math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)), 0.0)
        known[feature] = math.copysign(sure, odds) if sure >= LEAST_ODDS else 0.0
    return WordScores(known)


def _parents(feature: bytes) -> list[bytes]:
    """Shorter beginnings of a word or of a (marked) beginning, from long to short."""
    word, size = (feature[:-1], len(feature) - 1) if feature[-1:] == b"-" else (feature, len(feature) + 1)
    return [word[:k] + b"-" for k in BEGINNINGS if k < size and k <= len(word)]


def calibrate(sample: DataFrame, scores: WordScores) -> ToxicModel:
    """Extreme-value law and logistic function, from documents that ``scores`` was not learned from."""
    shared = Shared(sample.sparkSession, scores)
    edges = np.arange(-REACH, REACH + STEP, STEP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in text_slices(batches, 1):
            best, sizes, spread = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                values = known.of(words)
                best.append(max((s for _, _, s in passages_of(words, values)), default=0.0))
                sizes.append(len(values))
                # Repeats are no evidence of their own.
                once = {words[at]: at for at in np.flatnonzero(values > 0).tolist()}
                values = np.where(values > 0, -PENALTY, values)
                values[list(once.values())] = known.of(list(once))
                spread.append(np.histogram(np.clip(values, -REACH, REACH - STEP), edges)[0].tolist())
            columns = [batch.column(0), pa.array(best), pa.array(sizes, pa.int64()), pa.array(spread, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "best", "n", "spread"])

    found = sample.select("toxic", "text").mapInArrow(run, "toxic int, best double, n bigint, spread array<bigint>")
    rows = found.collect()
    ordinary = [r for r in rows if not r.toxic]
    if not ordinary or len(ordinary) == len(rows):
        return ToxicModel(scores)
    spread = np.sum([r.spread for r in ordinary], axis=0, dtype=np.float64)
    rate = _rate(edges[:-1] + STEP / 2, spread)
    gumbel_mean = 0.5772156649
    constant = float(np.mean([rate * r.best - math.log(max(r.n, 1)) for r in ordinary])) - gumbel_mean
    model = ToxicModel(scores, rate, constant)
    judged = [r for r in rows if r.best > 0]
    x = np.array([model.excess(r.best, r.n) for r in judged])
    y = np.array([r.toxic for r in judged], np.float64)
    slope, offset = _logistic(x, y)
    return ToxicModel(scores, rate, constant, slope, offset)


def _rate(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive solution of ``sum(p * exp(rate * value)) = 1``; at most 4."""
    weights = weights.copy()
    weights[-1] += 1  # a word of the highest score may always turn up
    p = weights / weights.sum()
    if p @ values >= 0:
        return 0.1
    low, high = 0.0, 4.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if p @ np.exp(middle * values) < 1 else (low, middle)
    return max(low, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton's method."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + ridge * w
        bend = design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(2)
        change = np.linalg.solve(bend, slope)
        w -= np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", held_out: int = 0, parts: int = 5) -> ToxicModel:
    """Learn from labelled documents outside the held-out fold."""
    rows = only(docs, doc_id="doc_id", text="text")
    sample = _sample(rows, labels, label_col, held_out, parts)
    return calibrate(sample.filter("part = 2"), learn_scores(sample.filter("part < 2")))


def find_segments(
    docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", level: float = 0.01
) -> DataFrame:
    """One row per document: ``score``, ``predicted`` and the significant passages.

    ``passages`` holds first word, word behind the last, score and chance of each
    maximal segment whose chance is at most ``level``.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = Shared(docs.sparkSession, model)
    passage = pa.list_(
        pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in text_slices(batches, 1):
            scores, passages = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                values = known.scores.of(words)
                n = len(values)
                found = [(a, b, s, known.chance(s, n)) for a, b, s in passages_of(words, values)]
                scores.append(known.probability(max((s for _, _, s, _ in found), default=0.0), n))
                passages.append(
                    [{"start": a, "stop": b, "score": s, "chance": c} for a, b, s, c in found if c <= level]
                )
            predicted = pa.array([int(s >= 0.5) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), predicted, pa.array(passages, passage)],
                names=["doc_id", "score", "predicted", "passages"],
            )

    found = "array<struct<start:int,stop:int,score:double,chance:double>>"
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, passages {found}")


def report(docs: DataFrame, labels: DataFrame, held_out: int = 0, parts: int = 5) -> DataFrame:
    """Learn outside the held-out fold and score every document."""
    found = find_segments(docs, fit(docs, labels, held_out=held_out, parts=parts))
    held = F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", "predicted", F.size("passages").alias("n_passages"))
