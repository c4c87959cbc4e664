"""Near copies by exact Jaccard similarity of word n-grams.

The documents are rows of a sparse matrix whose columns are n-grams, and the
product of the matrix with its transpose holds the overlap of every two documents.
The product is taken in blocks, and entries that cannot reach the similarity are
discarded by bounds that follow from the sizes of the sets:

1. *Columns in blocks.* N-grams are dealt out by hash. Each block finds the columns
   with more than one entry; others add to no overlap. A document with fewer such
   entries than ``similarity`` times its size cannot reach any other one and leaves.
   Entries travel packed, a row for each batch of documents and block, not each
   n-gram. N-grams that a bounded sample shows to be common are known to be shared
   and need not meet in a block, so no block is filled by one column.
2. Documents with the same set become one row (a *class*).
3. *Columns in order of rarity.* Two rows that reach the similarity meet in the
   first columns of both: those up to ``n - ceil(similarity * n) + 1``. The columns
   that a row has from the meeting on bound the overlap; pairs below
   ``similarity / (1 + similarity) * (n + m)`` are discarded.
4. *Pivots.* In each column the row that shares most is multiplied with all others.
   Rows that reach the similarity form components. Only columns that still hold
   several components are multiplied in full, and there only rows outside the
   column's largest component with the others, so the many copies of one text cost
   one product each and not one for every two.
5. Components of all links are the result.

No link is lost: a pair is left out only if a bound excludes it or both rows are in
one component already. The input must give the same rows when it is read again
(a stored table does).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import Shared
from starloom.llm.components import components
from starloom.llm.shingles import PART_BYTES, mix, shingle_sets
from starloom.llm.tables import only, ship, text_slices
from starloom.storage import materialize

WIDTH = 5
#: Similarity in hundredths.
PERCENT = 75

#: Documents looked at for common n-grams; those in at least ``COMMON_DOCS`` of them
#: count as common, at most ``COMMON_MOST``, which bounds what is broadcast to 512 kB.
SAMPLE_DOCS = 4096
COMMON_DOCS = 20
COMMON_MOST = 1 << 16

#: Entries in one batch of documents: enough for some in every block, but bounded.
BATCH_ENTRIES = 1 << 18
BATCH_MOST = 1 << 23

_ROWS = (
    "batch string, block int, row int, doc_id {id}, text_hash bigint, n int, class binary, counts binary, entries binary"
)


def _narrow(entries: np.ndarray) -> bytes:
    """The low 48 bits of each hash; with the block's number they tell n-grams apart."""
    return np.ascontiguousarray(entries, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _wide(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _common(docs: DataFrame, width: int) -> np.ndarray:
    """Hashes of n-grams that a sample of the documents has in common, in order."""
    ship(docs.sparkSession)
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 2, PART_BYTES):
            sets = shingle_sets(batch.column(2).to_pylist(), width)
            found, times = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], names=["gram", "n"])

    counted = chosen.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= COMMON_DOCS).orderBy(F.desc("n"), "gram").limit(COMMON_MOST)
    return np.sort(np.array([r.gram for r in top.collect()], np.int64).view(np.uint64))


def _pack(blocks: int, width: int, common: Shared):
    """Documents to packed rows: one for each document, and one for each batch and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        usual = common.value
        most = min(max(BATCH_ENTRIES, 256 * blocks), BATCH_MOST)
        held, sets, docs = 0, [], []

        def packed() -> Iterator[pa.RecordBatch]:
            name = f"{part}-{serial}"
            sizes = np.array([len(s) for s in sets], np.int32)
            ids = pa.concat_arrays([d.column(0) for d in docs])
            hashes = pa.concat_arrays([d.column(1) for d in docs])
            n = len(sets)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            block = pa.array((np.arange(n) + part) % blocks, pa.int32())
            names = ["batch", "block", "row", "doc_id", "text_hash", "n", "class", "counts", "entries"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n, pa.string()), block, pa.array(np.arange(n), pa.int32()), ids, hashes,
                    pa.array(sizes), pa.array(digests, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
            entries = np.concatenate([*sets, np.empty(0, np.uint64)])
            owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
            # Common n-grams pass under a block number of their own, which no block judges.
            place = (entries >> np.uint64(32)).astype(np.int64) % blocks
            if len(usual):
                at = np.minimum(np.searchsorted(usual, entries), len(usual) - 1)
                place[usual[at] == entries] = -1 - (part + serial) % blocks
            order = np.argsort(place, kind="stable")
            place, entries, owner = place[order], entries[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else []
            last = np.append(first[1:], len(place)) if len(place) else []
            which, counts, values = [], [], []
            for a, b in zip(first, last):
                which.append(int(place[a]))
                counts.append(np.bincount(owner[a:b], minlength=n).astype(np.int32).tobytes())
                values.append(_narrow(entries[a:b]))
            m = len(which)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * m, pa.string()), pa.array(which, pa.int32()), pa.nulls(m, pa.int32()),
                    pa.nulls(m, ids.type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()),
                    pa.array(counts, pa.binary()), pa.array(values, pa.binary()),
                ],
                names=names,
            )

        for batch in text_slices(batches, 2, PART_BYTES):
            found = shingle_sets(batch.column(2).to_pylist(), width)
            sets += found
            docs.append(batch)
            held += sum(map(len, found))
            if held >= most:
                yield from packed()
                held, sets, docs, serial = 0, [], [], serial + 1
        if sets:
            yield from packed()

    return run


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in column.to_pylist()]


def _keep_shared(rows: pa.Table) -> pa.Table:
    """One block of columns: entries whose column has another entry."""
    judged = pc.and_(pc.is_valid(rows["entries"]), pc.greater_equal(rows["block"], 0))
    packed = rows.filter(judged)
    if not packed.num_rows:
        return rows
    counts, entries = _arrays(packed["counts"]), [_wide(x) for x in packed["entries"].to_pylist()]
    row_ends, entry_ends = np.cumsum([len(c) for c in counts]), np.cumsum([len(e) for e in entries])
    each, whole = np.concatenate(counts), np.concatenate(entries)
    order = np.argsort(whole)
    same = whole[order][1:] == whole[order][:-1]
    shared = np.zeros(len(whole), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    kept = np.bincount(np.repeat(np.arange(len(each)), each)[shared], minlength=len(each)).astype(np.int32)
    new_counts = [kept[e - len(c) : e].tobytes() for c, e in zip(counts, row_ends)]
    new_entries = [_narrow(x[shared[e - len(x) : e]]) for x, e in zip(entries, entry_ends)]
    for name, values in (("counts", new_counts), ("entries", new_entries)):
        packed = packed.set_column(packed.schema.get_field_index(name), name, pa.array(values, pa.binary()))
    packed = packed.filter(pc.greater(pc.binary_length(packed["entries"]), 0))
    return pa.concat_tables([rows.filter(pc.invert(judged)), packed])


def _unpack(percent: int):
    """One batch of documents: each with its shared n-grams, if they are enough."""

    def run(rows: pa.Table) -> pa.Table:
        docs = rows.filter(pc.is_valid(rows["row"])).sort_by("row")
        packed = rows.filter(pc.is_valid(rows["entries"]))
        sizes = docs["n"].to_numpy().astype(np.int64)
        owner = [np.repeat(np.arange(len(sizes)), c) for c in _arrays(packed["counts"])]
        owner = np.concatenate([*owner, np.empty(0, np.int64)]).astype(np.int64)
        # All that passed as common has one number here, whatever way it took.
        places = [max(block, -1) for block in packed["block"].to_pylist()]
        entries = [
            mix(_wide(x) + mix(np.array([place + 1], np.uint64))) for place, x in zip(places, packed["entries"].to_pylist())
        ]
        entries = np.concatenate([*entries, np.empty(0, np.uint64)]).view(np.int64)
        entries = entries[np.argsort(owner, kind="stable")]
        shared = np.bincount(owner, minlength=len(sizes))
        ends = np.cumsum(shared)
        enough = (100 * shared >= percent * sizes) & (sizes > 0)
        grams = [entries[e - s : e] if ok else None for ok, s, e in zip(enough, shared, ends)]
        docs = docs.select(["doc_id", "text_hash", "n", "class"])
        return docs.append_column("grams", pa.array(grams, pa.list_(pa.int64())))

    return run


def incidence(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, blocks: int | None = None) -> DataFrame:
    """Rows (``doc_id``, ``text_hash``) with set size ``n``, ``class`` (hash of the set) and ``grams``.

    ``grams`` are the n-grams that another row has too, or NULL where they are too
    few for any link. ``blocks`` should be such that a block's n-grams fit a task's
    memory easily; four for each shuffle partition unless given.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _ROWS.format(id=kind)
    common = Shared(spark, _common(docs, width))
    packed = docs.mapInArrow(_pack(blocks, width, common), schema)
    judged = packed.groupBy("block").applyInArrow(_keep_shared, schema)
    return judged.groupBy("batch").applyInArrow(
        _unpack(percent), f"doc_id {kind}, text_hash bigint, n int, class binary, grams array<bigint>"
    )


def _reachable(n: Column, m: Column, overlap: Column, percent: int) -> Column:
    """Whether so much overlap makes sets of these sizes similar enough."""
    return (100 + percent) * overlap >= percent * (n + m)


def postings(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The first columns of each row, rarest first: ``gram``, ``class``, ``n``, ``shared``, ``rest``.

    ``rest`` counts the row's entries from this column on, so it bounds the overlap
    with a row first met here. Columns with one entry come first; they meet nobody.
    """
    entries = classes.select("class", "n", F.explode("grams").alias("gram"))
    often = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    rows = entries.join(often, "gram").groupBy("class", "n")
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("order"))
    rows = rows.withColumn("shared", F.size("order")).filter(100 * F.col("shared") >= percent * F.col("n"))
    needed = F.ceil(F.col("n") * percent / F.lit(100.0)).cast("int")
    first = F.col("n") - needed + 1 - (F.col("n") - F.col("shared"))
    rows = rows.withColumn("first", F.greatest(first, F.lit(0)))
    rows = rows.select("class", "n", "shared", F.posexplode(F.slice("order", F.lit(1), F.col("first"))))
    return rows.select("col.gram", "class", "n", "shared", (F.col("shared") - F.col("pos")).alias("rest"))


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar enough, by their whole overlap."""
    left = classes.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = classes.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("grams_a", "grams_b"))
    return both.filter(_reachable(F.col("n_a"), F.col("n_b"), overlap, percent)).select("a", "b")


def class_links(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(``node``, ``root``) of the components of similar classes."""
    columns = materialize(postings(classes, percent), "columns")
    # The row that shares the largest part of itself is likely the text that others were copied from.
    best = F.max(F.struct((F.col("shared") / F.col("n")).alias("part"), "class", "n", "rest")).alias("p")
    pivots = columns.groupBy("gram").agg(best, F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    met = columns.join(pivots, "gram").filter(F.col("class") != F.col("p.class"))
    met = met.filter(_reachable(F.col("n"), F.col("p.n"), F.least("rest", "p.rest"), percent))
    pair = F.least("class", "p.class").alias("a"), F.greatest("class", "p.class").alias("b")
    tried = materialize(met.select(*pair).distinct(), "pairs")
    links = materialize(_linked(tried, classes, percent), "links")
    roots = components(links)

    placed = columns.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    placed = placed.withColumn("root", F.coalesce("root", "class"))
    groups = placed.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("rows"))
    largest = groups.groupBy("gram").agg(
        F.max(F.struct("rows", "root")).alias("largest"), F.count(F.lit(1)).alias("groups")
    )
    mixed = materialize(placed.join(largest.filter("groups > 1"), "gram"), "mixed")
    left = mixed.filter("root != largest.root").select(
        "gram", F.col("class").alias("x"), F.col("root").alias("x_root"), F.col("n").alias("x_n"),
        F.col("rest").alias("x_rest"),
    )
    met = left.join(mixed, "gram").filter(F.col("x_root") != F.col("root"))
    met = met.filter(_reachable(F.col("n"), F.col("x_n"), F.least("rest", "x_rest"), percent))
    pair = F.least("class", "x").alias("a"), F.greatest("class", "x").alias("b")
    rest = met.select(*pair).distinct().join(tried, ["a", "b"], "left_anti")
    more = _linked(rest, classes, percent)
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(stars.union(more))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``.

    Two documents link when their sets of ``width``-word shingles have a Jaccard
    similarity of at least ``percent`` hundredths. ``component_id`` is the smallest
    id reachable by links.

    Defined results: NULL and empty texts, and texts of spaces, have no shingles and
    are linked with nothing, not even each other; their component is their own id.
    Rows with a NULL id take part, but their component is named by an id that is not
    NULL if it has one, else NULL. Repeated rows are documents like any other. An
    empty table gives an empty one; extra columns are not looked at.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = materialize(incidence(rows, width, percent), "incidence")
    # Only classes that may have links go on, by a short number given where they are stored.
    similar = found.filter("grams is not null").groupBy("class")
    similar = similar.agg(F.first("n").alias("n"), F.first("grams").alias("grams"), F.min("doc_id").alias("least"))
    similar = materialize(similar.withColumn("no", F.monotonically_increasing_id()), "classes")
    roots = class_links(similar.select(F.col("no").alias("class"), "n", "grams"), percent)

    placed = similar.select("class", "least", F.col("no").alias("node")).join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(named, "root").select("class", "component_id", F.lit(True).alias("placed"))
    # A class that cannot have links has one document: copies share all their n-grams.
    return found.drop("grams").join(named, "class", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("placed"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest id.

    Documents without words are no copies and stay. Ids may repeat or be NULL (those
    come last); of rows with the same id and text one stays.
    """
    groups = near_groups(docs, id_col, text_col)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    some = groups.filter("n_shingles > 0").withColumn("row", row)
    # Rows of a group without any id have no common name; each of their texts stays.
    best = some.groupBy(
        "component_id", F.when(F.col("component_id").isNull(), F.col("text_hash")).alias("alone")
    ).agg(F.min("row").alias("row"))
    best = best.select("row.doc_id", "row.text_hash")
    names = docs.columns
    inner = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    key_id, text = f"_c{names.index(id_col)}", f"_c{names.index(text_col)}"
    inner = inner.withColumn("_h", F.xxhash64(text))
    wordless = F.coalesce(~F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    kept = inner.filter(~wordless).join(
        best, inner[key_id].eqNullSafe(best["doc_id"]) & (inner["_h"] == best["text_hash"]), "left_semi"
    )
    kept = kept.dropDuplicates([key_id, "_h"])
    return kept.union(inner.filter(wordless)).drop("_h").toDF(*names)
