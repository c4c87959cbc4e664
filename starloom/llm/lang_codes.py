"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary classifier on byte n-grams
predicts whether a text's language has it set (logistic regression, all bits at
once). Decoding adds up, over the bits, the logistic loss of the predicted margin
against each codeword, weighted by how reliable the bit proved on labelled texts that
it was not trained on; the codeword with the least loss names the language. The
softmax of the losses is the score, and a low one flags the text as ambiguous.

The classifiers are fitted on a bounded sample, ``GROUPS * PER_GROUP`` documents of
each language and ``SAMPLE`` in all, chosen by a hash of the id. Their n-gram counts are
made by Spark tasks; the driver sees one row of ``SIZE`` numbers for each.

Defined results: NULL texts and texts without letters are ``und`` with score 0 and
ambiguous; so is everything if there is nothing to learn from. With one language all
texts with letters have that one. Repeated rows get the same result; an empty table
gives an empty one; extra columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import Shared
from starloom.llm.tables import only, ship, text_slices

SIZE = 4096
#: Documents of a language are dealt into so many groups by hash, and so many of each are taken.
GROUPS, PER_GROUP = 16, 32
SAMPLE = 4096
PART = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def features(text: str) -> np.ndarray:
    """Hashed counts of byte pairs and triples of the whole text, damped and scaled to length 1."""
    data = text.encode().translate(_FOLD)
    counts = np.zeros(SIZE, np.int64)
    for begin in range(0, max(len(data) - 1, 1), PART):
        b = np.frombuffer(data, np.uint8, min(PART + 2, len(data) - begin), begin).astype(np.uint32)
        pairs = b[:-1] << np.uint32(8) | b[1:]
        triples = pairs[:-1] << np.uint32(8) | b[2:]
        # The last pair of a part but the last one begins the next part.
        pairs = pairs[:PART]
        for grams, factor in ((pairs, 0x9E3779B1), (triples, 0x85EBCA6B)):
            counts += np.bincount((grams * np.uint32(factor)) >> np.uint32(20), minlength=SIZE)
    damped = np.sqrt(counts, dtype=np.float64)
    length = math.sqrt(counts.sum())
    return (damped / length if length else damped).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """+1 and -1: a row for each of ``n`` languages, a column for each bit.

    Up to five languages get all bits that tell any two sets of them apart; more get
    random codes, the set with the largest least distance of a hundred.
    """
    if n <= 5:
        bits = range(1, 2 ** (n - 1))
        return np.array([[1 if row == 0 or not b >> (row - 1) & 1 else -1 for b in bits] for row in range(n)], float)
    rng = np.random.default_rng(seed)
    width = 2 + 8 * math.ceil(math.log2(n))
    best, best_gap = None, -1
    for _ in range(100):
        code = rng.choice([-1.0, 1.0], (n, width))
        split = np.abs(code.sum(0)) < n  # a bit that is the same for all tells nothing
        gap = (width - np.max(code @ code.T - 2 * width * np.eye(n), axis=1).max()) / 2 if split.all() else -1
        if best is None or gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass(frozen=True)
class Codebook:
    """Languages, their codewords, the bits' classifiers and weights."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    trust: np.ndarray

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language with the least loss, and the score."""
        margins = rows @ self.weights + self.offsets
        # (texts, languages): weighted logistic loss against each codeword
        losses = np.stack([np.logaddexp(0, -margins * word) @ self.trust for word in self.code], axis=1)
        best = losses.argmin(axis=1)
        gaps = losses - losses.min(axis=1, keepdims=True)
        return best, 1 / np.exp(-gaps).sum(axis=1)


def train(rows: np.ndarray, languages: list[str], rounds: int = 200, ridge: float = 1e-4) -> Codebook:
    """A codebook from feature rows and their languages; one row in four judges the bits."""
    names = tuple(sorted(set(languages)))
    code = codewords(len(names))
    row_of = {name: i for i, name in enumerate(names)}
    target = code[[row_of[x] for x in languages]]
    judged = np.arange(len(rows)) % 4 == 3
    x, y = rows[~judged].astype(np.float64), target[~judged]
    w, b = np.zeros((rows.shape[1], code.shape[1])), np.zeros(code.shape[1])
    # Rows have length 1, so the loss curves by at most a quarter of two (the offset adds one).
    step, ahead_w, ahead_b = 2.0, w, b
    for t in range(rounds):
        slope = -y / (1 + np.exp(y * (x @ ahead_w + ahead_b))) / max(len(x), 1)
        new_w = ahead_w - step * (x.T @ slope + ridge * ahead_w)
        new_b = ahead_b - step * slope.sum(0)
        pull = t / (t + 3)
        ahead_w, ahead_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    right = (np.sign(rows[judged] @ w + b) == target[judged]).sum(0) + 1.0
    share = np.clip(right / (judged.sum() + 2), 0.5, 0.999)
    trust = np.log(share / (1 - share)) + 1e-3
    return Codebook(names, code, w.astype(np.float32), b.astype(np.float32), trust / trust.mean() if len(trust) else trust)


def fold(id_col: str, parts: int) -> Column:
    """``crc32`` of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def fit(docs: DataFrame, held_out: int = 2, parts: int = 4) -> Codebook | None:
    """Learn from ``docs`` (``doc_id``, ``text``, ``lang``) outside the held-out fold."""
    ship(docs.sparkSession)
    taught = docs.filter("lang is not null and text is not null").filter(fold("doc_id", parts) != held_out)
    # One language may have most rows: its groups are ranked apart, after each task has kept the first of its own.
    grouped = taught.select("doc_id", "lang", F.pmod(F.xxhash64(F.lit("group"), "doc_id"), F.lit(GROUPS)).alias("part"))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = grouped.withColumn("place", place).filter(F.col("place") <= PER_GROUP)
    chosen = chosen.orderBy("place", "lang").limit(SAMPLE).select("doc_id", F.col("lang").alias("given"))
    # At most SAMPLE ids.
    sample = docs.join(F.broadcast(chosen.distinct()), "doc_id").filter("lang = given").select("given", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            rows = [features(text or "").tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["lang", "row"])

    found = sorted(tuple(r) for r in sample.mapInArrow(run, "lang string, row binary").collect())
    if not found:
        return None
    # Dealt out so that every fourth row of each language judges the bits.
    return train(np.stack([np.frombuffer(r, np.float32) for _, r in found]), [x for x, _ in found])


def identify(docs: DataFrame, book: Codebook | None, id_col: str = "doc_id", text_col: str = "text", clear: float = 0.6) -> DataFrame:
    """``lang_pred``, ``score`` and ``ambiguous`` (a score below ``clear``) of each document."""
    rows = only(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = Shared(docs.sparkSession, book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in text_slices(batches, 1):
            texts = batch.column(1).to_pylist()
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            spoken = [i for i, text in enumerate(texts) if known is not None and text and _LETTER.search(text)]
            for begin in range(0, len(spoken), 256):
                some = spoken[begin : begin + 256]
                best, score = known.predict(np.stack([features(texts[i]) for i in some]))
                for i, language, value in zip(some, best, score):
                    names[i], scores[i] = known.languages[language], value
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(scores < clear)],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def report(docs: DataFrame, held_out: int = 2, parts: int = 4) -> DataFrame:
    """Learn outside the held-out fold and identify every document."""
    rows = only(docs, doc_id="doc_id", text="text", lang="lang")
    found = identify(rows, fit(rows, held_out, parts))
    held = F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score", "ambiguous")
