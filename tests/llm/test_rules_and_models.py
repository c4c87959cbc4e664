"""Decision list, language codes and toxic segments."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import decision_list, lang_codes, toxic_segments
from tests.llm.conftest import as_docs, messy_rows, words


def stats(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    places = defaultdict(list)
    for k in range(len(w) - 2):
        places[tuple(w[k : k + 3])].append(k)
    covered = {k + j for p in places.values() if len(p) > 1 for k in p for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, dup, len(covered)


def test_statistics(spark):
    rng = random.Random(3)
    rows = messy_rows() + [
        (100 + k, rng.choice(" \n").join(rng.choice(["a", "bb", "#", "ç<|", "a\nbb", "  "]) for _ in range(rng.randrange(60))))
        for k in range(80)
    ]
    found = decision_list.judge(as_docs(spark, rows).repartition(3), decision_list.DecisionList())
    expected = Counter()
    for i, text in rows:
        s = stats(text)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        expected[(i, *s, failed, not failed, None)] += 1
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_no_python_in_the_plan(spark, messy):
    plan = decision_list.judge(messy, decision_list.DecisionList())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def labelled(spark, n=3000, seed=4):
    """Bad: many symbols, or long words with much repetition; both kinds occur alone in good rows."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        symbols, chars, repeat = rng.random(), 3 + 6 * rng.random(), rng.random() / 2
        bad = symbols > 0.7 or (chars > 7 and repeat > 0.3)
        rows.append((int(bad), k % 3, 100.0 + k % 50, chars, symbols, 0.0, repeat))
    columns = ", ".join(f"{f} double" for f in decision_list.FEATURES)
    return spark.createDataFrame(rows, f"bad int, part int, {columns}"), rows


def test_learns_conjunctions(spark):
    frame, rows = labelled(spark)
    rules = decision_list.learn(frame).rules
    names = list(decision_list.FEATURES)

    def rejects(row):
        for rule in rules:
            if all((row[2 + names.index(c.feature)] > c.limit) == c.above for c in rule):
                return 1
        return 0

    right = sum(rejects(row) == row[0] for row in rows) / len(rows)
    assert right > 0.95 and any(len(rule) > 1 for rule in rules)


def test_nothing_to_learn(spark, messy, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert decision_list.fit(messy.toDF(*fresh(messy)), labels).rules == ()
    assert decision_list.judge(nothing, decision_list.DecisionList()).count() == 0


def fresh(df):
    return ["doc_id", "text", "lang", *[f"x{i}" for i in range(len(df.columns) - 3)]]


def test_labels_that_contradict_or_miss_are_left_out(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(60))) for k in range(6)], "doc_id bigint, text string")
    labels = [(0, 0), (0, 1), (1, None), (None, 0), (2, 0), (2, 0), (3, 1), (99, 1)]
    found = decision_list.labelled_features(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), "quality", 0, 100)
    assert sorted(r.bad for r in found.collect()) == [0, 1]


def test_rules_apply_in_order_and_keep_columns(messy):
    rules = decision_list.DecisionList(
        ((decision_list.Condition("words", True, 3000.0),), (decision_list.Condition("words", True, 100.0),))
    )
    found = {r.doc_id: r for r in decision_list.judge(messy, rules).collect()}
    assert found[12].rule == 1 and found[5].rule == 2 and not found[5].kept and not found[4].kept
    kept = decision_list.keep_good(messy, rules)
    assert kept.columns == messy.columns
    assert kept.count() == sum(r.kept for r in decision_list.judge(messy, rules).collect())


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 9, 20])
def test_codewords_differ(n):
    code = lang_codes.codewords(n)
    gaps = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
    assert min(gaps) >= (1 if n == 2 else 2) and set(np.unique(code)) <= {-1.0, 1.0}


def spoken(n, seed):
    rng = random.Random(seed)
    sounds = {"aa": "ba da ga ka", "bb": "eth ith oth uth", "cc": "zum zim xum xim", "dd": "éa èo éi êu", "ee": "rrr nn mm sss", "ff": "quo qui qua que"}
    rows = []
    for k in range(n):
        lang = rng.choice(list(sounds))
        parts = sounds[lang].split()
        rows.append((k, " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(12)), lang))
    return rows


def test_languages(spark):
    rows = spoken(1200, 5)
    docs = spark.createDataFrame([*rows, (5000, None, "aa"), (5001, "12 -- 😀", "bb"), (None, rows[0][1], rows[0][2]), (5002, "bada", None)], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in lang_codes.report(docs).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items() if i is not None)
    held = [(i, lang) for i, _, lang in rows if found[i].held_out]
    assert sum(found[i].lang_pred == lang for i, lang in held) / len(held) > 0.98
    assert found[5000].lang_pred == found[5001].lang_pred == "und" and found[5000].score == 0 and found[5001].ambiguous
    assert found[None].lang_pred == rows[0][2] and not found[None].held_out
    assert all(0 <= r.score <= 1 for r in found.values())


def test_languages_of_messy_and_empty_tables(spark, messy, nothing):
    assert all(r.lang_pred in ("en", "und") for r in lang_codes.report(messy).collect())
    assert lang_codes.report(messy).count() == len(messy_rows())
    assert lang_codes.report(nothing).count() == 0
    none = lang_codes.identify(messy, None).collect()
    assert {(r.lang_pred, r.score, r.ambiguous) for r in none} == {("und", 0.0, True)}


def test_features_of_long_texts_do_not_depend_on_parts(monkeypatch):
    text = " ".join(t for _, t, _ in spoken(20, 6))
    whole = lang_codes.features(text)
    monkeypatch.setattr(lang_codes, "PART", 50)
    assert np.allclose(whole, lang_codes.features(text))
    assert lang_codes.features("").sum() == 0 and lang_codes.features("a").sum() == 0


def maximal(scores):
    """All maximal scoring segments by their definition: best first, then left and right of it."""
    def split(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        return [*split(a, best[3]), (best[3], best[4], best[0]), *split(best[4], b)]

    return split(0, len(scores))


def test_segments_against_their_definition():
    rng = random.Random(7)
    for _ in range(300):
        scores = [rng.choice([-3.25, -1.5, -1.0, 0.75, 2.0, 4.5]) + rng.random() / 100 for _ in range(rng.randrange(14))]
        found = toxic_segments.segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in maximal(scores)]


def damped(words, scores):
    """Best segment by brute force, with repeats in it damped; then left and right of it."""
    def value(i, j):
        seen, total = set(), 0.0
        for w, s in zip(words[i:j], scores[i:j]):
            total += s * toxic_segments.REPEATED if s > 0 and w in seen else s
            seen.add(w)
        return total

    def split(a, b):
        best = max(((value(i, j), -i, -j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        return [*split(a, best[3]), (best[3], best[4], best[0]), *split(best[4], b)]

    return split(0, len(words))


def test_damped_segments_against_their_definition():
    rng = random.Random(9)
    weights = {k: rng.choice([-0.9, -0.5, -0.3, 1.0, 2.0, 4.5]) + rng.random() / 100 for k in range(8)}
    for _ in range(300):
        text = [rng.randrange(8) for _ in range(rng.randrange(18))]
        # Small differences by place, so that no two segments are equal.
        scores = [weights[w] + rng.random() / 1000 for w in text]
        found, expected = toxic_segments.passages_of(text, np.array(scores)), damped(text, scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in found], [s for *_, s in expected])


def test_a_toxic_passage_that_comes_again_is_found_again(spark):
    known = {b"badword": 7.0, b"uglyword": 7.0, b"vile": 7.0}
    model = toxic_segments.ToxicModel(toxic_segments.WordScores(known), rate=0.8, constant=-3.0)
    rest = " ".join(["fine"] * 1200)
    passage = "badword uglyword vile"
    rows = [(1, f"{passage} {rest} {passage}"), (2, f"badword {rest} uglyword {rest} vile {rest} {passage}"), (3, "badword " * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.passages for r in toxic_segments.find_segments(docs, model).collect()}
    assert [(p.start, p.stop) for p in found[1]] == [(0, 3), (1203, 1206)]
    assert [(p.start, p.stop) for p in found[2]] == [(3603, 3606)]
    assert found[1][0].score == pytest.approx(found[1][1].score) == pytest.approx(found[2][0].score)
    assert [(p.start, p.stop) for p in found[3]] == [(0, 50)]


def test_toxic_documents(spark):
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(1500):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 300]))]
        toxic = rng.random() < 0.2
        for _ in range(rng.choice([2, 3, 4]) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(["badword", "uglyword", f"vile{rng.randrange(1000)}"])
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, "badword"), (9000, None), (9001, ""), (9002, "This.")], "doc_id bigint, text string")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in toxic_segments.report(docs, table).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items() if i is not None)
    held = [(i, t) for i, _, t in labels if found[i].held_out]
    assert sum(found[i].predicted == t for i, t in held) / len(held) > 0.97
    assert all(found[i].predicted == 0 for i in (9000, 9001, 9002))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    # The passages found are where the words are.
    model = toxic_segments.fit(docs, table)
    one = toxic_segments.find_segments(spark.createDataFrame([(1, "v1 v2 badword uglyword v3 " + "v4 " * 40)], "doc_id bigint, text string"), model)
    assert [(p.start, p.stop) for p in one.first().passages] == [(2, 4)]


def test_toxicity_without_labels(spark, messy, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.predicted == 0 for r in toxic_segments.report(messy, labels).collect())
    assert toxic_segments.report(nothing, labels).count() == 0
