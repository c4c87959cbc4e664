"""N-gram join, components and decontamination, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import components, decontam, ngram_join
from starloom.llm.shingles import shingle_sets
from tests.llm.conftest import as_docs, lower, messy_rows, words


def shingles(text, width=5):
    w = words(lower(text))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def groups(rows, percent=75):
    """Smallest reachable id of each row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    near = list(range(len(rows)))

    def find(a):
        while near[a] != a:
            a = near[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                near[find(a)] = find(b)
    members = {}
    for a in range(len(rows)):
        members.setdefault(find(a), []).append(rows[a][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return Counter((rows[a][0], len(sets[a]), least[find(a)]) for a in range(len(rows)))


def found_groups(docs):
    rows = ngram_join.near_groups(docs).select("doc_id", "n_shingles", "component_id")
    return Counter(tuple(r) for r in rows.collect())


def test_messy(messy, nothing):
    assert found_groups(messy) == groups(messy_rows())
    assert ngram_join.near_groups(nothing).count() == 0


def edited(rng, base, n):
    out = base.split()
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def test_chains_common_passages_and_sizes(spark):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(400)]
    rows, common = [], " ".join(rng.choice(vocabulary) for _ in range(60))
    for family in range(6):
        base = " ".join(rng.choice(vocabulary) for _ in range(80 + 10 * family))
        for k in range(12):
            # Chains: each copy edits the one before it, so its ends may be far apart.
            rows.append((100 * family + k, base))
            base = edited(rng, base, rng.choice([0, 1, 2, 3, 4]))
    for k in range(30):  # a passage that makes up most of a text but not enough of it
        rows.append((1000 + k, common + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.choice([14, 20, 30])))))
    for k in range(20):  # prefixes of one text: sizes at the border of the bounds
        rows.append((2000 + k, " ".join(f"p{j}" for j in range(20 + 4 * k))))
    rng.shuffle(rows)
    assert found_groups(as_docs(spark, rows).repartition(5)) == groups(rows)


def test_common_shingles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON_DOCS", 2)
    monkeypatch.setattr(ngram_join, "BATCH_ENTRIES", 64)
    rng = random.Random(12)
    base = " ".join(f"b{rng.randrange(50)}" for _ in range(90))
    rows = [(k, edited(rng, base, rng.choice([1, 2, 3, 5]))) for k in range(40)]
    rows += [(100 + k, " ".join(f"o{rng.randrange(50)}" for _ in range(40))) for k in range(20)]
    assert found_groups(as_docs(spark, rows).repartition(3)) == groups(rows)


def test_keep_one(spark, messy, nothing):
    kept = ngram_join.keep_one(messy)
    assert kept.columns == messy.columns
    rows = Counter((r.c0, r.c1) for r in kept.toDF(*[f"c{i}" for i in range(len(messy.columns))]).collect())
    expected = Counter(set(messy_rows()))
    # 6 copies 5, 7 is near to it; 10 is near to 9; 14 has the words of 13.
    for gone in [r for r in messy_rows() if r[0] in (6, 10, 14) or (r[0] == 7 and "changed" in r[1])]:
        del expected[gone]
    assert rows == expected
    assert ngram_join.keep_one(nothing).count() == 0


def test_shingles_are_those_of_the_contract():
    texts = [t for _, t in messy_rows()] + ["a b c d e", "A B C D E f", "a a a a a a a"]
    for text, found in zip(texts, shingle_sets(texts)):
        assert len(found) == len(shingles(text)) and np.all(found[1:] > found[:-1])
    one, two = shingle_sets(["q a b c d e", "a b c d e z"])
    assert len(np.intersect1d(one, two)) == 1


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(5000))
    whole = shingle_sets([text, "x y", text])
    monkeypatch.setattr("starloom.llm.shingles.PART_BYTES", 100)
    parts = shingle_sets([text, "x y", text])
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(200, 200 + k) for k in range(1, 30)] + [(500, 500)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(pairs)
    near = {}

    def find(a):
        near.setdefault(a, a)
        while near[a] != a:
            a = near[a]
        return a

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        near[y] = x
    expected = {(a, find(a)) for a in near if find(a) != a}
    rows = components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def item_words(text):
    return decontam._KEPT.findall((text or "").encode().translate(decontam._FOLD))


def contamination(rows, items, window=13):
    windows = {}
    for name, text in items:
        w = item_words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(name))
    out = Counter()
    for i, text in rows:
        w, hit, which = item_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    which |= windows[tuple(w[k : k + size])]
        sha = hashlib.sha256(",".join(sorted(which)).encode()).hexdigest()
        out[i, len(w), len(hit), len(which), sha, len(hit) > 0 and 20 * len(hit) >= len(w)] += 1
    return out


def items_and_texts():
    rng = random.Random(21)
    items = [(k, " ".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 12, 13, 14, 30])))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "--"), (53, "Only, Short!"), (54, "only short"), (2, items[2][1])]
    rows = messy_rows() + [(100 + k, " ".join(rng.choice("abcd") for _ in range(rng.randrange(200)))) for k in range(40)]
    rows += [(200, f"x {items[5][1]} y"), (201, "It is ONLY   short, but")]
    return items, rows


def test_contamination(spark, nothing):
    items, rows = items_and_texts()
    for window in (13,):
        table = spark.createDataFrame(items, "item_id bigint, text string")
        found = decontam.report(as_docs(spark, rows).repartition(3), table)
        assert Counter(tuple(r) for r in found.collect()) == contamination(rows, items, window)
    assert decontam.report(nothing, table).count() == 0
    none = decontam.report(as_docs(spark, rows), table.limit(0)).collect()
    assert not any(r.contaminated or r.n_hit or r.n_items for r in none)


def test_blocks_of_items_agree_with_one(spark):
    items, rows = items_and_texts()
    table, docs = spark.createDataFrame(items, "item_id bigint, text string"), spark.createDataFrame(rows, "doc_id bigint, text string")
    one = decontam.find_hits(docs, table).collect()
    many = decontam.find_hits(docs, table, block_words=20).collect()
    assert Counter(map(str, one)) == Counter(map(str, many))


def test_removal(spark):
    passage = " ".join(f"item{k}" for k in range(20))
    table = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    filler = " ".join(f"f{k}" for k in range(600))
    rows = [(1, f"Before, {passage.upper()}; after."), (2, f"{filler} {passage}"), (3, None), (4, "clean")]
    docs = as_docs(spark, rows)
    cut = decontam.remove_spans(docs, table)
    assert cut.columns == docs.columns
    texts = {r.c0: r.c1 for r in cut.toDF(*[f"c{i}" for i in range(len(docs.columns))]).collect()}
    assert texts == {1: "Before, ; after.", 2: rows[1][1], 3: None, 4: "clean"}
    kept = decontam.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(F.col("c0")).collect()) == [2, 3, 4]
