"""Hash tree and line windows."""

import zlib
from collections import Counter

from starloom.llm import line_windows, shard_tree
from starloom.llm.tables import SPACES
from tests.llm.conftest import PASSAGE, as_docs, messy_rows


def shards(spark, tree, n=4000):
    rows = spark.range(n).withColumnRenamed("id", "key")
    return {r.key: r.s for r in shard_tree.descend(rows, tree, "key", "s").collect()}


def test_shares_follow_weights(spark):
    tree = shard_tree.HashTree((((1.0, 3.0), (2.0,)), ((2.0, 0.0),)))
    counts = Counter(shards(spark, tree, 8000).values())
    assert counts[3 + 1] == 0
    for shard, weight in enumerate((1, 3, 2, 2)):
        assert abs(counts[shard] / 8000 - weight / 8) < 0.02


def test_growing_moves_rows_only_into_the_new_shard(spark):
    tree = shard_tree.HashTree.even(2, 2, 2)
    for _ in range(3):
        before, tree = shards(spark, tree), tree.grown()
        after = shards(spark, tree)
        moved = [key for key in before if before[key] != after[key]]
        assert {after[key] for key in moved} == {tree.shards - 1}
        assert abs(len(moved) / len(before) - 1 / tree.shards) < 0.02


def test_a_changed_weight_moves_rows_only_along_changed_paths(spark):
    before = shards(spark, shard_tree.HashTree((((1.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (1.0, 1.0)))))
    after = shards(spark, shard_tree.HashTree((((1.0, 2.0), (1.0, 1.0)), ((1.0, 1.0), (1.0, 1.0)))))
    region = lambda shard: shard // 4
    for key in before:
        # Nobody leaves the region that grew, and nobody moves inside the other one.
        assert region(after[key]) in (0, region(before[key]))
        if region(after[key]) == 1:
            assert after[key] == before[key]


def test_assign(messy, nothing):
    tree = shard_tree.HashTree.even(5, 2, 4)
    rows = shard_tree.assign(messy, tree).collect()
    given = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in messy_rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == given
    by_key = {}
    for r in rows:
        assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        assert by_key.setdefault(r.doc_id, r.shard) == r.shard
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert shard_tree.assign(nothing, tree).count() == 0


def test_one_key_with_all_rows_is_numbered(spark):
    rows = as_docs(spark, [(7, "same")] * 50).repartition(4)
    found = shard_tree.assign(rows, shard_tree.HashTree.even(2, 2, 2)).collect()
    assert sorted(r.slot for r in found) == list(range(50)) and len({r.shard for r in found}) == 1


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def dedup(rows):
    """The same by sets of windows."""
    docs = {}
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        content = [(k, x.strip(SPACES.replace("\n", ""))) for k, x in enumerate(lines)]
        content = [(k, x) for k, x in content if x]
        size = min(3, len(content))
        wins = []
        if size:
            for k in range(len(content) - size + 1):
                part = content[k : k + size]
                wins.append((part[0][0], part[-1][0], (size, *[x for _, x in part])))
        docs[i, t] = lines, wins
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    first, cut = {}, {d: set() for d in docs}
    for d in order:
        for a, b, w in docs[d][1]:
            if first.setdefault(w, (d, a)) != (d, a):
                cut[d] |= set(range(a, b + 1))
    return Counter(
        (i, t if not cut[i, t] else "\n".join(x for k, x in enumerate(docs[i, t][0]) if k not in cut[i, t]), len(cut[i, t]))
        for i, t in rows
    )


def test_lines_against_brute_force(messy, nothing):
    found = line_windows.dedup_lines(messy)
    assert found.columns == [*messy.columns, "n_removed"]
    positions = found.toDF("doc_id", "text", *[f"x{i}" for i in range(8)], "n_removed")
    got = Counter((r.doc_id, r.text, r.n_removed) for r in positions.collect())
    # Ids with several texts are ordered by the hash of the text; theirs share no window here.
    assert got == dedup(messy_rows())
    assert line_windows.dedup_lines(nothing).count() == 0


def test_overlapping_passages_are_merged(spark):
    a, b, c, d, e = ("alpha one", "beta two", "gamma three", "delta four", "epsilon five")
    rows = [(1, "\n".join([a, b, c, d])), (2, "\n".join(["own", a, "", b, c, d, "end"])), (3, "\n".join([c, d, e]))]
    found = {r.doc_id: r.text for r in line_windows.dedup_lines(plain(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: "own\nend", 3: rows[2][1]}


def test_a_passage_stays_once(spark):
    rows = [(i, f"start {i}\n{PASSAGE}\nend {i}") for i in range(40)]
    found = line_windows.dedup_lines(plain(spark, rows)).collect()
    assert [r.doc_id for r in found if "again and again" in r.text] == [0]
    assert all(r.text == f"start {r.doc_id}\nend {r.doc_id}" for r in found if r.doc_id)


def test_long_lines_are_passages(spark):
    long = " ".join(f"w{k}" for k in range(60))
    half, rest = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [
        (1, f"{long}\nx\ny\n{half}\n{rest}"), (2, f"own\n {long} \nend\nmore"), (3, long), (4, f"{half}\n\n{rest}"),
        (5, f"{half}\nz"), (6, None), (7, ""), (8, f"{long}\n{long}"),
    ]
    cleaned = line_windows.dedup_lines(plain(spark, rows), long_words=50)
    found = {r.doc_id: (r.text, r.n_removed) for r in cleaned.collect()}
    assert found == {
        1: (rows[0][1], 0), 2: ("own\nend\nmore", 1), 3: ("", 1), 4: ("", 3),
        5: (rows[4][1], 0), 6: (None, 0), 7: ("", 0), 8: ("", 2),
    }
