"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are normalised to words: A-Z become a-z, everything in ASCII but letters and
digits separates. The automaton knows every sequence of words that occurs in an
item. A document's words are streamed through it; after each word its state stands
for the longest sequence ending there that some item has, and its length is kept.

* A window is ``window`` consecutive words of an item; an item of fewer words, but
  not none, is one window itself. A document word inside an occurrence of a window
  is *hit*: where the length reaches the window, or a short item ends.
* Spans of hits longer than ``most_words``, in documents where hits make up at
  least ``coverage`` of the words, exceed the limits and are removed.

The automaton of a block of items is sent to all executors, so a block is bounded
by ``BLOCK_WORDS``; more items make more blocks, each one pass over the documents,
and the positions hit in any pass are merged.

Defined results: NULL and empty texts have no words and no hits; items that are
NULL or empty have no windows; several items with the same words are all counted,
several rows of one item once; an item without an id is named by the empty text;
repeated document rows each get their result; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import Shared
from starloom.llm.tables import only, positional, text_slices, without

WINDOW = 13
BLOCK_WORDS = 1 << 20

_KEPT = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text."""
    return text.encode().translate(_FOLD).split() if text else []


class ItemAutomaton:
    """A suffix automaton over the words of several items."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[str] = []
        self.shortest = window
        whole: list[list[int]] = []
        for name, words in items:
            if not words:
                continue
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            self.names.append(name)
            whole.append(codes)
            self.shortest = min(self.shortest, len(codes))
            last = 0
            for code in codes:
                last = self._extend(last, code)
        self._windows(whole)

    def _extend(self, last: int, code: int) -> int:
        """Add a word behind state ``last``; gives the state of the longer sequence."""
        known = self.next[last].get(code)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, code, known)
        state = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            found = self.next[at][code]
            exact = self.length[found] == self.length[at] + 1
            self.link[state] = found if exact else self._clone(at, code, found)
        return state

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _clone(self, at: int, code: int, found: int) -> int:
        """Split off the sequences of ``found`` that end behind ``at``."""
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[found])
        self.link[copy] = self.link[found]
        self.link[found] = copy
        while at >= 0 and self.next[at].get(code) == found:
            self.next[at][code] = copy
            at = self.link[at]
        return copy

    def _windows(self, whole: list[list[int]]) -> None:
        """For states of windows: which items have the window. For short items: where they end."""
        held: dict[tuple[int, int], set[int]] = {}
        for item, codes in enumerate(whole):
            size = min(self.window, len(codes))
            for _, state, length in self.stream(codes):
                if length >= size:
                    held.setdefault((self._at(state, size), size), set()).add(item)
        # By state: the lengths of windows ending there, with their items.
        self.ends: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        for (state, size), items in sorted(held.items()):
            self.ends.setdefault(state, []).append((size, tuple(sorted(items))))

    def _at(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a sequence that ``state`` stands for."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def stream(self, codes: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """After each word: its place, the state, and the longest matching length."""
        state, length = 0, 0
        for place, code in enumerate(codes):
            while state and code not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if code in self.next[state]:
                state = self.next[state][code]
                length += 1
            else:
                length = 0
            yield place, state, length

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans ``[begin, end)`` of hit words, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        code_of = self.vocabulary.get
        codes = np.fromiter((code_of(w, -1) for w in words), np.int64, len(words))
        for begin, end in _runs(codes >= 0, self.shortest):
            # Words that no item has end every match, so only runs of known words are streamed.
            for place, state, length in self.stream(codes[begin:end].tolist()):
                if length < self.shortest:
                    continue
                longest = 0
                while state > 0:
                    for size, found in self.ends.get(state, ()):
                        if size <= length:
                            longest = max(longest, size)
                            items.update(found)
                    state = self.link[state]
                if longest:
                    first, behind = begin + place + 1 - longest, begin + place + 1
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, behind))
        return spans, items


def _runs(known: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Runs of true values, at least ``least`` long."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], known.astype(np.int8), [0]])))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= max(least, 1)
    return list(zip(begins[long].tolist(), ends[long].tolist()))


def item_blocks(items: DataFrame, most_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items (``item_id``, ``text``) in blocks of about ``most_words`` words.

    The items stream through the driver one at a time; a block is all it holds.
    """
    block, held = [], 0
    for name, text in items.toLocalIterator():
        words = words_of(text)
        if block and held + len(words) > most_words:
            yield block
            block, held = [], 0
        block.append(("" if name is None else str(name), words))
        held += len(words)
    yield block


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (array of begin and end word) and ``items`` (their ids as text).

    Spans (``start``, ``stop``) of one document do not touch; items are distinct and in order.
    """
    docs = without(docs, "n_words", "spans", "items")
    names, at = docs.columns, docs.columns.index(text_col)
    out = positional(docs)
    fields = "_n bigint, _spans array<struct<start:int,stop:int>>, _items array<string>"
    for number, block in enumerate(item_blocks(only(items, item_id=item_id, text=item_text), block_words)):
        shared = Shared(docs.sparkSession, ItemAutomaton(block, window))
        known = out.columns
        schema = f"{_ddl(out)}, {fields}"
        out = out.mapInArrow(_matcher(shared, at), schema)
        if number:
            merged = F.array_sort(F.concat("spans", "_spans"))
            items_of = F.array_distinct(F.concat("items", "_items"))
            out = out.select(*known[:-2], _merge_spans(merged).alias("spans"), items_of.alias("items"))
        else:
            renamed = {"_n": "n_words", "_spans": "spans", "_items": "items"}
            out = out.withColumnsRenamed(renamed)
    return out.withColumn("items", F.array_sort("items")).toDF(*names, "n_words", "spans", "items")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _merge_spans(spans):
    """Join sorted spans that touch or overlap."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last.start.alias("start"), F.greatest(last.stop, span.stop).alias("stop"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)).stop >= span.start)
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(spans, empty, add)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _matcher(shared: Shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in text_slices(batches, at):
            counts, spans, items = [], [], []
            for text in batch.column(at).to_pylist():
                words = words_of(text)
                counts.append(len(words))
                found, which = automaton.hits(words)
                spans.append([{"start": a, "stop": b} for a, b in found])
                items.append(sorted({automaton.names[i] for i in which}))
            columns = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            names = [*batch.schema.names, "_n", "_spans", "_items"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    return run


def _verdict(found: DataFrame, per: int) -> DataFrame:
    """``n_hit``, and ``contaminated``: at least one word in ``per`` is hit."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.stop - s.start)
    found = found.withColumn("n_hit", hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (per * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", per: int = 20) -> DataFrame:
    """One row per document: words, hit words, items found, and whether it is contaminated."""
    rows = find_hits(only(docs, doc_id=id_col, text=text_col), items)
    return _verdict(rows.drop("text"), per).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given spans of words and what stands between their words."""
    places = [m.span() for m in _KEPT.finditer(text.encode().translate(_FOLD))]
    data, out, at = text.encode(), [], 0
    for begin, end in spans:
        out.append(data[at : places[begin][0]])
        at = places[end - 1][1]
    return b"".join([*out, data[at:]]).decode()


def remove_spans(
    docs: DataFrame, items: DataFrame, text_col: str = "text", per: int = 20, most_words: int = 0, window: int = WINDOW
) -> DataFrame:
    """``docs`` with spans over the limits cut out of their texts.

    A span goes if it has more than ``most_words`` words and its document is
    contaminated (one word in ``per`` is hit). Other documents keep their text.
    """
    names, at = docs.columns, docs.columns.index(text_col)
    inner = positional(docs)
    found = _verdict(find_hits(inner, items, text_col=f"_c{at}", window=window), per)
    over = F.filter("spans", lambda s: F.col("contaminated") & (s.stop - s.start > most_words))
    found = found.select(*inner.columns, over.alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, at):
            texts = [
                cut_spans(text, [(s["start"], s["stop"]) for s in spans]) if spans else text
                for text, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist())
            ]
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[: len(names)])

    return found.mapInArrow(run, inner.schema).toDF(*names)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", per: int = 20) -> DataFrame:
    """``docs`` without the contaminated ones; the others as they are."""
    names, at = docs.columns, docs.columns.index(text_col)
    inner = positional(docs)
    found = _verdict(find_hits(inner, items, text_col=f"_c{at}"), per)
    return found.filter(~F.col("contaminated")).select(*inner.columns).toDF(*names)
