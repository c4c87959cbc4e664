"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both encodings of a text cover the same bytes. A byte offset where a token of each ends
is a cut; the tokens between two cuts are a group, and each token of the first kind in
it is linked with each of the second. The cuts are found from the two arrays of token
ends:

* As long as tokens are alike, the ends agree at a constant shift of the index. Slices
  of the two arrays at that shift are compared, each twice as long as the one before;
  after a slice that differs the length is halved down to the last end that agrees. A
  stretch of one-to-one groups costs the logarithm of its length in comparisons.
* Where the ends differ, the side that is behind steps on until both meet: one irregular
  group. The stretch after it is compared at the new shift.

What a pair of ids is worth depends on how many documents link it. Documents are worked
on in blocks: each lists its distinct pairs once, with the number of its documents that
hold them, and each document keeps only places in that list. So one row per block and
pair, not per document and pair, is summed and joined with the sums, and a pair that
every document has is one row per block. The sums return to the blocks by block number.

Defined results: a text that is NULL, empty, or that one of the tokenizers does not give
back byte by byte has no tokens: zeros, and an empty string for the groups. Repeated rows
are documents of their own. An empty table gives an empty one; extra columns are not
looked at. A long text is a block of its own; groups of many tokens are linked by
distinct ids with multiplicities, never token by token.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.byte_bpe import MOST_VOCABULARY_BYTES, Encoder, Merges, Shared, worker_copy
from starloom.llm.tables import only, positional, text_slices, without
from starloom.storage import materialize

#: Distinct pairs of documents that a block holds before it is closed.
BLOCK_PAIRS = 1 << 20

#: Links of an irregular group that are written out one by one; larger ones go by distinct ids.
PLAIN_LINKS = 64

#: Characters above which a text is not given to the library.
LONG_CHARS = 1 << 16

#: Ends of a stretch that are compared before slices are.
NEAR = 16

SPACE = "▁"


class ByteTokens:
    """Byte-level tokens of a prefix and the text; strings of special tokens are plain text.

    The library for ranks encodes: with merges numbered in their order it gives what the
    merges give, as each token is also the encoding of its own bytes. Its pattern engine
    cannot take white space of millions of characters, so long texts go to our own encoder.
    """

    def __init__(self, merges: Merges, pattern: str, prefix: str):
        self.prefix = prefix
        self.bytes_of = [merges.by_id.get(i, b"") for i in range(max(merges.ids) + 1)]
        ranks = {token: rank for rank, token in enumerate(merges.tokens)}
        self.coder = tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ids = np.array(merges.ids, np.int32)
        self.patient = Encoder(merges, pattern)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        whole = [self.prefix + text for text in texts]
        encode = self.coder.encode_ordinary
        return [
            self.patient.encode(text) if len(text) > LONG_CHARS else self.ids[np.array(encode(text), np.int64)]
            for text in whole
        ]


class PieceTokens:
    """Tokens of a piece model, which puts a space in front by itself."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


def load_model(path: str) -> bytes:
    """The content of a piece model's file."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    return content


def cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each kind lie before the end of each group; both arrays end alike."""
    a_ends, b_ends = a_ends.astype(np.int64), b_ends.astype(np.int64)
    a, b = a_ends.tolist(), b_ends.tolist()
    # Slices of raw bytes are compared as a whole.
    raw_a, raw_b, width = a_ends.tobytes(), b_ends.tobytes(), 8
    i = j = 0
    begins_a, begins_b, sizes = [], [], []
    while i < len(a):
        if a[i] == b[j]:
            # The first few ends are compared one by one, which slices would not make faster.
            size, probe = 1, NEAR
            most = min(len(a) - i, len(b) - j)
            near = min(most, NEAR)
            while size < near and a[i + size] == b[j + size]:
                size += 1
            if size < near:
                most = size
            while size < most:
                probe = min(probe, most - size)
                from_a, from_b = width * (i + size), width * (j + size)
                if raw_a[from_a : from_a + width * probe] != raw_b[from_b : from_b + width * probe]:
                    break
                size += probe
                probe *= 2
            else:
                probe = 1
            while probe > 1:
                probe //= 2
                from_a, from_b = width * (i + size), width * (j + size)
                if raw_a[from_a : from_a + width * probe] == raw_b[from_b : from_b + width * probe]:
                    size += probe
            begins_a.append(i)
            begins_b.append(j)
            sizes.append(size)
            i, j = i + size, j + size
        else:
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            begins_a.append(i)
            begins_b.append(j)
            sizes.append(1)
            i, j = i + 1, j + 1
    sizes = np.array(sizes, np.int64)
    inside = np.arange(1, sizes.sum() + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(np.array(begins_a, np.int64), sizes) + inside, np.repeat(
        np.array(begins_b, np.int64), sizes
    ) + inside


def links(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs that are linked (first id in the upper 32 bits), and how often."""
    a, b = a.astype(np.int64) << 32, b.astype(np.int64)
    many_a, many_b = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    products = many_a * many_b
    one = products == 1
    parts = [a[a_cuts[one] - 1] | b[b_cuts[one] - 1]]
    some = ~one & (products <= PLAIN_LINKS)
    if some.any():
        each, columns = products[some], np.repeat(many_b[some], products[some])
        inside = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        from_a = np.repeat((a_cuts - many_a)[some], each) + inside // columns
        from_b = np.repeat((b_cuts - many_b)[some], each) + inside % columns
        parts.append(a[from_a] | b[from_b])
    pairs, times = np.unique(np.concatenate(parts), return_counts=True)
    large = np.flatnonzero(products > PLAIN_LINKS)
    if not len(large):
        return pairs, times
    all_pairs, all_times = [pairs], [times]
    for g in large.tolist():
        left, left_times = np.unique(a[a_cuts[g] - many_a[g] : a_cuts[g]], return_counts=True)
        right, right_times = np.unique(b[b_cuts[g] - many_b[g] : b_cuts[g]], return_counts=True)
        all_pairs.append((left[:, None] | right[None, :]).ravel())
        all_times.append((left_times[:, None] * right_times[None, :]).ravel())
    pairs, place = np.unique(np.concatenate(all_pairs), return_inverse=True)
    sums = np.zeros(len(pairs), np.int64)
    np.add.at(sums, place, np.concatenate(all_times))
    return pairs, sums


class Aligner:
    """Encodes texts with both tokenizers and aligns them."""

    def __init__(self, first: ByteTokens, second: PieceTokens):
        self.first, self.second = first, second
        self.a_sizes = np.array(list(map(len, first.bytes_of)), np.int64)
        self.b_sizes = np.array(list(map(len, second.bytes_of)), np.int64)
        # Ids in decimal, and what follows them within and at the end of a group.
        a, b = range(len(first.bytes_of)), range(len(second.bytes_of))
        self.written = [b"%d," % i for i in a] + [b"%d|" % i for i in a]
        self.written += [b"%d," % i for i in b] + [b"%d;" % i for i in b]

    def align_all(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...] | None]:
        """Ids of both kinds and the cuts of each text; None where there are no tokens."""
        filled = [text or "" for text in texts]
        for text, a, b in zip(filled, self.first.encode_all(filled), self.second.encode_all(filled)):
            yield self._align(text, a, b) if text else None

    def _align(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...] | None:
        whole = (self.first.prefix + text).encode()
        a_ends, b_ends = self.a_sizes[a].cumsum(), self.b_sizes[b].cumsum()
        # Byte-level tokens are cut from the text itself, so their sizes tell whether they cover it.
        if a_ends[-1] != len(whole) or b"".join(map(self.second.bytes_of.__getitem__, b.tolist())) != whole:
            return None
        return a, b, *cuts(a_ends, b_ends)

    def write(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> bytes:
        """The groups as text: ``a1,a2|b1;a3|b2,b3``."""
        many_a, many_b = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
        kinds_a, kinds_b = len(self.a_sizes), len(self.b_sizes)
        out = np.empty(len(a) + len(b), np.int64)
        codes = a.astype(np.int64)
        codes[a_cuts - 1] += kinds_a
        out[np.arange(len(a)) + np.repeat(b_cuts - many_b, many_a)] = codes
        codes = b + np.int64(2 * kinds_a)
        codes[b_cuts - 1] += kinds_b
        out[np.arange(len(b)) + np.repeat(a_cuts, many_b)] = codes
        return b"".join(map(self.written.__getitem__, out.tolist()))[:-1]


def _shared(spark, merges: Merges, pattern: str, model: bytes) -> Shared:
    return Shared(spark, (merges, pattern, model))


def _aligner(shared: Shared) -> Aligner:
    return worker_copy(shared, lambda v: Aligner(ByteTokens(v[0], v[1], " "), PieceTokens(v[2])))


ALIGNED = ("a_ids", "b_ids", "a_cuts", "b_cuts")


def align_texts(df: DataFrame, merges: Merges, pattern: str, model: bytes, text_col: str = "text") -> DataFrame:
    """Add the ids of both kinds and the cuts (tokens before the end of each group), arrays of int.

    They are empty where there are no tokens. Columns of these names are replaced.
    """
    df = without(df, *ALIGNED)
    keep, at = df.columns, df.columns.index(text_col)
    shared = _shared(df.sparkSession, merges, pattern, model)
    inner = positional(df)
    schema = T.StructType([*inner.schema.fields])
    for name in ALIGNED:
        schema = schema.add(f"_{name}", T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        for batch in text_slices(batches, at):
            empty = (np.empty(0, np.int32),) * 4
            found = [x or empty for x in aligner.align_all(batch.column(at).to_pylist())]
            columns = []
            for kind in zip(*found):
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in kind])]).astype(np.int32)
                values = pa.array(np.concatenate(kind).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), values))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return inner.mapInArrow(run, schema).toDF(*keep, *ALIGNED)


def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2**32, byte plane by byte plane, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents whose pairs are listed together."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.held, self.closed = schema, [], 0, 0

    def add(self, doc_id, figures: tuple, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows.append((doc_id, figures, pairs, times))
        self.held += len(pairs)

    def close(self) -> pa.RecordBatch:
        """All rows; the first one has the list of pairs."""
        number = (TaskContext.get().partitionId() << 40) | self.closed
        pairs, place, holders = np.unique(
            np.concatenate([row[2] for row in self.rows]), return_inverse=True, return_counts=True
        )
        columns, at = [[] for _ in self.schema], 0
        for doc_id, figures, own, times in self.rows:
            places = place[at : at + len(own)]
            at += len(own)
            # Pairs are sorted in both lists, so places only grow.
            steps = _pack(np.diff(places, prepend=0))
            for column, value in zip(columns, (doc_id, *figures, number, steps, _pack(times))):
                column.append(value)
        rest = [None] * (len(self.rows) - 1)
        columns[-2], columns[-1] = [pairs, *rest], [holders.astype(np.int32), *rest]
        self.rows, self.held, self.closed = [], 0, self.closed + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def blocks(
    docs: DataFrame, merges: Merges, pattern: str, model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document with its figures and packed links, pairs listed by block; see the module."""
    rows = only(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = _shared(docs.sparkSession, merges, pattern, model)
    columns = ", ".join(f"{name} bigint" for name in FIGURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = _aligner(shared), None
        for batch in text_slices(batches, 1):
            if block is None:
                schema = [("doc_id", batch.schema.field(0).type), *[(name, pa.int64()) for name in FIGURES]]
                schema += [("groups_sha256", pa.string()), ("block", pa.int64()), ("steps", pa.binary())]
                schema += [("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32()))]
                block = _Block(pa.schema(schema))
            none = np.empty(0, np.int64)
            for doc_id, found in zip(batch.column(0).to_pylist(), aligner.align_all(batch.column(1).to_pylist())):
                if found is None:
                    block.add(doc_id, (0, 0, 0, 0, ""), none, none)
                else:
                    pairs, times = links(*found)
                    groups = hashlib.sha256(aligner.write(*found)).hexdigest()
                    sizes = len(found[0]), len(found[1]), len(found[2]), int(times.sum())
                    block.add(doc_id, (*sizes, groups), pairs, times)
                if block.held >= BLOCK_PAIRS:
                    yield block.close()
        if block is not None and block.rows:
            yield block.close()

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, {columns}, groups_sha256 string, block bigint, steps binary, times binary, "
        "pairs array<bigint>, holders array<int>",
    )


def pair_rows(stored: DataFrame) -> DataFrame:
    """A row per block and pair: the place in the block's list and the documents of the block that hold it."""
    listed = stored.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "holders")))
    return listed.select("block", F.col("pos").alias("place"), F.col("col.pairs").alias("pair"), "col.holders")


def pair_counts(listed: DataFrame) -> DataFrame:
    """Documents that link each pair, and whether no pair of the same first id is linked by more."""
    counts = listed.groupBy("pair").agg(F.sum("holders").alias("documents"))
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("first")).agg(F.max("documents").alias("most"))
    joined = counts.withColumn("first", first).join(most, "first")
    return joined.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def vocabulary_map(
    docs: DataFrame, merges: Merges, pattern: str, model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Which ids of the two vocabularies stand for the same bytes: a_id, b_id, documents, best."""
    stored = materialize(blocks(docs, merges, pattern, model, id_col, text_col), "token-align")
    counts = pair_counts(pair_rows(stored))
    low = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    return counts.select(F.shiftright("pair", 32).alias("a_id"), low.alias("b_id"), "documents", "best")


def report(
    docs: DataFrame, merges: Merges, pattern: str, model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the sizes of its alignment, a hash of its groups, and the worth of its links."""
    stored = materialize(blocks(docs, merges, pattern, model, id_col, text_col), "token-align")
    listed = pair_rows(stored)
    worth = listed.join(pair_counts(listed), "pair").select("block", "place", "documents", "best")
    worth = worth.toDF("of_block", "place", "documents", "best")
    kind = stored.schema["doc_id"].dataType.simpleString()
    named = ["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"]

    def score(rows: pa.Table, worth: pa.Table) -> pa.Table:
        documents = np.zeros(worth.num_rows, np.int64)
        best = np.zeros(worth.num_rows, np.int64)
        place = worth.column("place").to_numpy()
        documents[place] = worth.column("documents").to_numpy()
        best[place] = worth.column("best").to_numpy()
        n_best, sums = [], []
        for steps, times in zip(rows.column("steps").to_pylist(), rows.column("times").to_pylist()):
            at, times = np.cumsum(_unpack(steps)), _unpack(times)
            n_best.append(int((best[at] * times).sum()))
            sums.append(int((documents[at] * times).sum()))
        kept = {name: rows.column(name) for name in named if name in rows.column_names}
        kept |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table({name: kept[name] for name in named})

    rows = stored.drop("pairs", "holders").groupBy("block").cogroup(worth.groupBy("of_block"))
    return rows.applyInArrow(
        score,
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
        "count_sum bigint, groups_sha256 string",
    )
