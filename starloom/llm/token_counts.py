"""Token counts of byte-level BPE vocabularies by dynamic programming over prefixes.

For each byte prefix of a piece the count is the count of the prefix before its
last token, plus one (see :mod:`starloom.llm.byte_bpe` for the last tokens). With
the counts of all pieces before it this gives the exact number of tokens of every
prefix of a text: whether it fits a budget, and where to cut it so that it does,
is read off without encoding anything again.

Special strings of the vocabulary are found first and count as one token each, as
the tokenizers library does by default.

Defined results: NULL is counted as the empty text, 0 tokens; repeated rows get
the same counts; an empty table gives an empty one; extra columns are kept aside.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import MOST_VOCABULARY_BYTES, Merges, PieceCache, Shared, parts_of, worker_copy
from starloom.llm.tables import only, positional, text_slices


def printable_bytes() -> dict[str, int]:
    """The characters by which JSON vocabularies write bytes.

    Bytes that print as themselves in Latin-1 do so; the others follow, in order,
    from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def load_json(path: str) -> tuple[Merges, list[str]]:
    """Merges and special strings of a tokenizers file with byte-level BPE."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    parsed = json.loads(content)
    model, before = parsed["model"], parsed["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if model["type"] != "BPE" or not plain or parsed["normalizer"] or model.get("end_of_word_suffix"):
        raise ValueError(f"{path} is not plain byte-level BPE")
    added = parsed["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path} has special strings that take in their surroundings")
    byte_of = printable_bytes()

    def raw(token: str) -> bytes:
        return bytes(byte_of[c] for c in token)

    special = {t["content"] for t in added}
    vocabulary = {raw(token): i for token, i in model["vocab"].items() if token not in special}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return Merges.from_merges(vocabulary, ((raw(a), raw(b)) for a, b in pairs)), sorted(special, key=len, reverse=True)


class Counter:
    """Counts tokens of whole texts, keeping what it found for pieces."""

    def __init__(self, merges: Merges, pattern: str, special: list[str]):
        self.merges, self.pieces = merges, regex.compile(pattern)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.cache = PieceCache(merges, lambda last: merges.prefix_counts(last)[-1])

    def _plain(self, text: str) -> tuple[list[str], int]:
        """The stretches between special strings, and how many of those there are."""
        if self.special is None or not self.special.search(text):
            return [text], 0
        between = self.special.split(text)
        return between, len(between) - 1

    def count_all(self, texts: list[str]) -> list[int]:
        cut, special = [], []
        for text in texts:
            between, n = self._plain(text)
            cut.append([self.pieces.findall(part) for stretch in between for part in parts_of(stretch)])
            special.append(n)
        self.cache.learn(chain.from_iterable(chain.from_iterable(cut)))
        known = self.cache.__getitem__
        return [n + sum(map(known, chain.from_iterable(parts))) for parts, n in zip(cut, special)]

    def prefixes(self, text: str) -> PrefixCounts:
        return PrefixCounts(self, text)


#: Pieces of which every prefix is a piece too, but for a leading space alone, and runs of white space.
EVEN = regex.compile(r" ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)")
BLANK = regex.compile(r"\s+")


class PrefixCounts:
    """The number of tokens of every prefix of a text, by characters, stored once.

    The prefix that ends inside a piece consists of the pieces before it and a prefix of
    that piece, whose count is in the piece's own table; so one pass over the tables gives
    all counts, and any question after that is read off. Patterns of this kind cut a prefix
    otherwise than the text in few places: white space at the end of a prefix is one piece,
    whatever follows in the text; a contraction or a special string that is not complete yet
    is cut into plain pieces. Those have tables or short encodings of their own.
    """

    #: Pieces in front of an incomplete special string that it may be joined with.
    BACK = 3

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text = counter, text
        #: Tokens of ``text[:end]`` at ``end``.
        self.counts = np.zeros(len(text) + 1, np.int64)
        self._tables: dict[str, np.ndarray] = {}
        special = counter.special
        begin, cuts = 0, [0]
        for found in special.finditer(text) if special is not None else ():
            cuts = self._stretch(begin, found.start(), cuts)
            known = cuts[max(0, len(cuts) - 1 - self.BACK)]
            for end in range(found.start() + 1, found.end()):
                self.counts[end] = self.counts[known] + counter.count_all([text[known:end]])[0]
            begin = found.end()
            self.counts[begin] = self.counts[found.start()] + 1
            cuts = [begin]
        self._stretch(begin, len(text), cuts)

    def _table(self, piece: str) -> np.ndarray:
        """Tokens of each prefix of a piece, by characters, the empty one first."""
        if piece not in self._tables:
            merges = self.counter.merges
            data = piece.encode()
            counts = np.array(merges.prefix_counts(merges.table(data)), np.int64)
            if len(data) != len(piece):
                starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
                counts = counts[np.append(np.flatnonzero(starts), len(data))]
            self._tables[piece] = counts
        return self._tables[piece]

    def _stretch(self, begin: int, end: int, cuts: list[int]) -> list[int]:
        """Fill in the counts of a stretch without special strings; gives where its pieces end."""
        counts, text = self.counts, self.text
        pieces_before, run, before_run = counts[begin], None, 0
        for found in self.counter.pieces.finditer(text, begin, end):
            start, stop, piece = found.start(), found.end(), found.group()
            if BLANK.fullmatch(piece):
                if run is None:
                    run, before_run = start, pieces_before
                # The run goes on with the space that the next piece begins with.
                blank = stop + (stop < end and text[stop] == " ")
                counts[start + 1 : blank + 1] = before_run + self._table(text[run:blank])[start + 1 - run :]
            else:
                first = 2 if run is not None and piece[0] == " " else 1
                if EVEN.fullmatch(piece):
                    counts[start + first : stop + 1] = pieces_before + self._table(piece)[first:]
                else:
                    for at in range(start + first, stop):
                        counts[at] = pieces_before + self.counter.count_all([text[start:at]])[0]
                    counts[stop] = pieces_before + self._table(piece)[-1]
                run = None
            pieces_before += self._table(piece)[-1]
            cuts.append(stop)
        return cuts

    def total(self) -> int:
        return int(self.counts[-1])

    def count(self, end: int) -> int:
        """Tokens of ``text[:end]``."""
        return int(self.counts[end])

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.counts <= budget)[-1]) if budget >= 0 else 0


def count_tokens(
    docs: DataFrame,
    merges: Merges,
    special: list[str],
    pattern: str,
    budget: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Bytes and tokens of each whole text, whether it is over the budget, and the bytes that fit it."""
    shared = Shared(docs.sparkSession, merges)
    rows = only(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_copy(shared, lambda m: Counter(m, pattern, special))
        for batch in text_slices(batches, 1):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            counts = counter.count_all(texts)
            sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).cast(pa.int64())
            over = pa.array(np.array(counts, np.int64) > budget)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(counts, pa.int64()), over],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def truncate(
    docs: DataFrame, merges: Merges, special: list[str], pattern: str, budget: int, text_col: str = "text"
) -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens; NULL stays NULL."""
    shared = Shared(docs.sparkSession, merges)

    @F.pandas_udf("string")
    def cut(texts):
        counter = worker_copy(shared, lambda m: Counter(m, pattern, special))
        return texts.map(lambda t: t if t is None else t[: counter.prefixes(t).longest_within(budget)])

    at = f"_c{docs.columns.index(text_col)}"
    return positional(docs).withColumn(at, cut(F.col(at))).toDF(*docs.columns)
