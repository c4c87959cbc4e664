"""Byte-level BPE by dynamic programming over byte prefixes.

The encoding of a string ends in exactly one token, and that token depends only
on the string up to there. So for every byte prefix one token is stored: the last
of its encoding. The token ending at byte ``i`` is the one token ``t`` of the
vocabulary that ends there and may stand next to the last token of the prefix
before ``t``. Reading the stored tokens backwards gives the encoding of any prefix:

* bytes can be appended, the table goes on from where it is;
* after an edit the table is kept before it and computed anew only until it has
  agreed with the old one over the length of the longest token.

Two tokens may stand next to each other if merging their joined bytes gives just
those two again; this is found by undoing their merges from the border outwards.

A text is first cut into pieces by a pattern; merges never cross pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.tables import only, positional, ship, text_slices, without

#: A rank file may have so many bytes; it is sent to every executor.
MOST_VOCABULARY_BYTES = 64 << 20

#: Entries of a worker's caches before they are emptied. They change speed only.
CACHED_PIECES = 500_000
CACHED_PAIRS = 600_000

#: Texts longer than this are cut into pieces part by part.
PART_CHARS = 1 << 20


class Merges:
    """Tokens in the order in which they are merged; the first 256 are the single bytes.

    ``splits[t]`` are the two tokens whose merge gives ``t`` (``t`` twice for a byte).
    ``ids[t]`` is the number that the vocabulary gives it. Tokens that merging
    never produces are left out.
    """

    def __init__(self, tokens: list[bytes], splits: list[tuple[int, int]], ids: list[int]):
        self.tokens, self.splits, self.ids = tokens, splits, ids
        self._prepare()

    def _prepare(self) -> None:
        self.number = {token: i for i, token in enumerate(self.tokens)}
        self.longest = max(map(len, self.tokens))
        self.merged = {pair: i for i, pair in enumerate(self.splits) if i >= 256}
        self.by_id = dict(zip(self.ids, self.tokens))
        self.sizes = [len(token) for token in self.tokens]
        self._pairs: dict[int, bool] = {}
        self._finder = None

    def __getstate__(self):
        return self.tokens, self.splits, self.ids

    def __setstate__(self, state):
        self.tokens, self.splits, self.ids = state
        self._prepare()

    @classmethod
    def from_ranks(cls, ranks: dict[bytes, int]) -> Merges:
        """From ranks: of two neighbours, those whose joined bytes rank least are merged first."""
        order = sorted(ranks, key=lambda t: (len(t) > 1, ranks[t]))
        if len(order) < 256 or any(len(t) != 1 for t in order[:256]):
            raise ValueError("every single byte needs a rank")
        tokens, splits, ids = [], [], []
        number: dict[bytes, int] = {}
        for token in order:
            if len(token) == 1:
                split = (len(tokens), len(tokens))
            else:
                parts = _merge_all(token, number)
                if len(parts) != 2:
                    continue
                split = (number[parts[0]], number[parts[1]])
            number[token] = len(tokens)
            tokens.append(token)
            splits.append(split)
            ids.append(ranks[token])
        return cls(tokens, splits, ids)

    @classmethod
    def from_merges(cls, vocabulary: dict[bytes, int], merges: Iterable[tuple[bytes, bytes]]) -> Merges:
        """From a list of merges, the first of which goes first."""
        tokens = [bytes([b]) for b in range(256)]
        number = {token: i for i, token in enumerate(tokens)}
        splits = [(i, i) for i in range(256)]
        for left, right in merges:
            if left + right in number:
                continue
            number[left + right] = len(tokens)
            tokens.append(left + right)
            splits.append((number[left], number[right]))
        return cls(tokens, splits, [vocabulary[token] for token in tokens])

    def fits(self, left: int, right: int) -> bool:
        """Whether the joined bytes of two tokens are encoded as these two."""
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        # Undo the later of the two tokens' last merges, again and again. A merge
        # across the border that comes before the merge just undone would have won.
        before = len(self.tokens)
        merged, splits = self.merged, self.splits
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                before, left = left, splits[left][1]
            else:
                before, right = right + 1, splits[right][0]

    def last_tokens(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """For each byte of ``data`` the last token of the prefix that ends there.

        ``last`` may hold the answers for the first bytes; it is extended.
        """
        last = [] if last is None else last
        token_of, longest, pairs = self.number.get, self.longest, self._pairs
        for end in range(len(last) + 1, len(data) + 1):
            for begin in range(max(end - longest, 0), end):
                token = token_of(data[begin:end])
                if token is None:
                    continue
                if not begin:
                    break
                left = last[begin - 1]
                fits = pairs.get(left << 32 | token)
                if fits is None:
                    fits = self.fits(left, token)
                if fits:
                    break
            last.append(token)
        return last

    def table(self, data: bytes) -> list[int]:
        """:meth:`last_tokens` of a piece from its beginning.

        An automaton finds the tokens that end at each byte, the longest first.
        """
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for number, token in enumerate(self.tokens):
                self._finder.add_word(token.decode("latin-1"), number)
            self._finder.make_automaton()
        last: list[int] = []
        sizes, pairs, done = self.sizes, self._pairs, -1
        for end, token in self._finder.iter(data.decode("latin-1")):
            if end == done:
                continue
            before = end - sizes[token]
            if before >= 0:
                left = last[before]
                fits = pairs.get(left << 32 | token)
                if fits is None:
                    fits = self.fits(left, token)
                if not fits:
                    continue
            last.append(token)
            done = end
        return last

    def edited(self, last: list[int], old: bytes, begin: int, end: int, new: bytes) -> list[int]:
        """The answers for ``old`` with ``old[begin:end]`` replaced, from those for ``old``."""
        data = old[:begin] + new + old[end:]
        shift = len(new) - (end - begin)
        table, same = last[:begin], 0
        for at in range(begin, len(data)):
            self.last_tokens(data[: at + 1], table)
            if at - shift >= end and table[at] == last[at - shift]:
                same += 1
                # All that the rest looks back on is as it was, and so is the rest.
                if same >= self.longest:
                    return table + last[at - shift + 1 :]
            else:
                same = 0
        return table

    def walk(self, last: list[int], end: int) -> list[int]:
        """The encoding of the first ``end`` bytes, as token numbers."""
        out, sizes = [], self.sizes
        while end:
            token = last[end - 1]
            out.append(token)
            end -= sizes[token]
        return out[::-1]

    def prefix_counts(self, last: list[int]) -> list[int]:
        """Tokens of each byte prefix of a piece, the empty one first, from its last tokens."""
        counts = [0]
        for end, token in enumerate(last, 1):
            counts.append(counts[end - self.sizes[token]] + 1)
        return counts

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.by_id.__getitem__, ids))


def _merge_all(data: bytes, number: dict[bytes, int]) -> list[bytes]:
    """Merge by the given ranks until nothing can be merged: how a token is split."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = min(
            ((number[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in number), default=None
        )
        if found is None:
            break
        i = found[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def load_ranks(path: str) -> Merges:
    """A file of lines of base64 bytes and rank."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    lines = (line.split() for line in content.splitlines() if line)
    return Merges.from_ranks({base64.b64decode(token): int(rank) for token, rank in lines})


def parts_of(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text where every pattern of this kind cuts: at a single space between letters."""
    begin = 0
    while len(text) - begin > most:
        cut = regex.compile(r"(?<=\p{L}) (?=\p{L})").search(text, begin + most)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


class PieceCache(dict):
    """What ``value`` makes of the last tokens of each piece; emptied between slices when full."""

    def __init__(self, merges: Merges, value, most: int = CACHED_PIECES):
        super().__init__()
        self.merges, self.value, self.most = merges, value, most

    def learn(self, pieces: Iterable[str]) -> None:
        """Add what is not known yet."""
        if len(self) >= self.most:
            self.clear()
        table, value = self.merges.table, self.value
        for piece in [piece for piece in set(pieces) if piece not in self]:
            self[piece] = value(table(piece.encode()))


class Encoder:
    """Encodes whole texts, keeping what it found for pieces."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pieces = merges, regex.compile(pattern)
        self.cache = PieceCache(merges, self._ids)
        self._packed = [np.int32(i).tobytes() for i in merges.ids]

    def _ids(self, table: list[int]) -> bytes:
        packed = self._packed
        return b"".join([packed[t] for t in self.merges.walk(table, len(table))])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text; a slice of texts at a time learns its new pieces together."""
        cut = [[self.pieces.findall(part) for part in parts_of(text)] for text in texts]
        self.cache.learn(chain.from_iterable(chain.from_iterable(cut)))
        known = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(known, chain.from_iterable(parts))), np.int32) for parts in cut]


class EditableText:
    """A text and its encoding, with exact appends and edits.

    Pieces before the one in front of an edit stay; new pieces are made until they
    meet an old cut behind the edit, and pieces after it stay too.
    """

    #: An appended or changed character can change so many pieces in front of it
    #: (a contraction such as ``'re`` begins as two pieces).
    BACK = 3

    def __init__(self, merges: Merges, pattern: str, text: str = ""):
        self.merges, self.pattern = merges, regex.compile(pattern)
        self.text, self.pieces, self.ids = "", [], []
        self.tables: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, begin: int, end: int, new: str) -> None:
        """Put ``new`` in place of ``text[begin:end]``."""
        text = self.text[:begin] + new + self.text[end:]
        shift = len(new) - (end - begin)
        cuts = [0]
        for piece in self.pieces:
            cuts.append(cuts[-1] + len(piece))
        kept = sum(cut <= begin for cut in cuts[1:])
        kept = max(0, kept - self.BACK)
        old_cuts = {cut: i for i, cut in enumerate(cuts) if cut >= end}
        fresh, meet = [], len(self.pieces)
        for match in self.pattern.finditer(text, cuts[kept]):
            if match.start() - shift in old_cuts and match.start() >= begin + len(new):
                meet = old_cuts[match.start() - shift]
                break
            fresh.append(match.group())
        old = dict(zip(self.pieces[kept:meet], self.tables[kept:meet]))
        tables = []
        for piece in fresh:
            data = piece.encode()
            near = next((p for p in old if p and piece.startswith(p)), None)
            # A piece that only grew goes on from its own table.
            tables.append(self.merges.last_tokens(data, list(old[near]) if near else None))
        self.text = text
        self.pieces[kept:meet], self.tables[kept:meet] = fresh, tables

    def encode(self) -> list[int]:
        merges = self.merges
        return [merges.ids[t] for table in self.tables for t in merges.walk(table, len(table))]


_encoders: dict[object, object] = {}


def worker_copy(broadcast, make):
    """``make(broadcast.value)``, once in each Python worker."""
    key = broadcast.id if hasattr(broadcast, "id") else id(broadcast)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = make(broadcast.value)
    return _encoders[key]


class Shared:
    """A broadcast that knows its number in the workers."""

    def __init__(self, spark, value):
        ship(spark)
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self):
        return self.broadcast.value


#: Tokens in one output batch.
BATCH_TOKENS = 1 << 19


def encode_texts(df: DataFrame, merges: Merges, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col`` (array of int), the encoding of each whole text.

    NULL is encoded as the empty text: an empty array. A column called ``ids_col``
    is replaced. Rows keep their number and order within a partition; repeated rows
    get the same ids; an empty table gives an empty one with the column added.
    """
    df = without(df, ids_col)
    keep = df.columns
    shared = Shared(df.sparkSession, merges)
    at = keep.index(text_col)
    inner = positional(df)
    schema = T.StructType([*inner.schema.fields, T.StructField("_ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_copy(shared, lambda m: Encoder(m, pattern))
        for batch in text_slices(batches, at):
            ids = encoder.encode_all(text or "" for text in batch.column(at).to_pylist())
            lengths, parts, held, begin = [], [], 0, 0
            for row in range(batch.num_rows):
                found = ids[row]
                lengths.append(len(found))
                parts.append(found)
                held += len(found)
                if held >= BATCH_TOKENS or row + 1 == batch.num_rows:
                    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))
                    rows = batch.slice(begin, row + 1 - begin)
                    yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "_ids"])
                    lengths, parts, held, begin = [], [], 0, row + 1

    return inner.mapInArrow(run, schema).toDF(*keep, ids_col)


def decode_ids(df: DataFrame, merges: Merges, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col`` (binary), the bytes that the ids stand for; NULL ids give NULL.

    Ids that the vocabulary does not have end the job with a KeyError. A column
    called ``bytes_col`` is replaced.
    """
    df = without(df, bytes_col)
    keep = df.columns
    shared = Shared(df.sparkSession, merges)
    at = keep.index(ids_col)
    inner = positional(df)
    schema = T.StructType([*inner.schema.fields, T.StructField("_bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                out = [None if ids is None else value.decode(ids.values.tolist()) for ids in _lists(batch.column(at))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "_bytes"]
                )

    return inner.mapInArrow(run, schema).toDF(*keep, bytes_col)


class _Ids:
    __slots__ = ("values",)

    def __init__(self, values):
        self.values = values


def _lists(column: pa.ListArray) -> Iterator[_Ids | None]:
    """The ids of each row without a Python object for every list element at once."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for row, valid in enumerate(column.is_valid().to_pylist()):
        yield _Ids(values[offsets[row] : offsets[row + 1]]) if valid else None


def digests(docs: DataFrame, merges: Merges, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of tokens, and hashes of the ids and of the bytes they are decoded to."""
    rows = only(docs, doc_id=id_col, text=text_col)
    rows = encode_texts(rows, merges, pattern).select("doc_id", "ids")
    rows = decode_ids(rows, merges)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
