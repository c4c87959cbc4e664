"""Repair of conversations, against plain loops over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given
from hypothesis import strategies as st

from starloom.llm import turn_repair
from starloom.llm.queries import op11_turn_repair

SF_DIR = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?")
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for _, _, role, text in turns:
        shown = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = None
        if not shown:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif shown[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def apply(turns, found, audit):
    """Repaired turns and the cost of an audit; None if it is not allowed."""
    rows, cost, at, initials = [], 0, 0, ""
    for edit in audit:
        due = "assistant" if initials[-1:] == "u" else "user"
        cost += COSTS[edit]
        if edit == "I":
            rows.append((due, ""))
        else:
            if at == len(turns) or (edit != "D" and found[at] in ("blank", "duplicate")):
                return None
            role, text = turns[at][2:]
            if edit != "D":
                cost += 3 * (found[at] == "truncated")
                rows.append((role if edit == "K" else due, text))
            at += 1
            if edit == "D":
                continue
        initials += rows[-1][0][:1] or "-"
        if not re.fullmatch("s?(ua)*u?", initials):
            return None
    if at < len(turns) or not GOOD.fullmatch(initials):
        return None
    return cost, rows


def cheapest(turns, found):
    """Cost and audit, by a table from the last turn to the first; inserts only lead on."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {}
    for i in range(len(turns), -1, -1):
        for s in due:
            ways = [(0, "")] if i == len(turns) and s in ("", "a") else []
            if i < len(turns):
                more = 3 * (found[i] == "truncated")
                nexts = [("D", s, 4)]
                if found[i] not in ("blank", "duplicate"):
                    nexts.append(("R", due[s], 3 + more))
                    if (s, turns[i][2][:1]) in step:
                        nexts.append(("K", step[s, turns[i][2][:1]], more))
                ways += [(c + best[i + 1, t][0], e + best[i + 1, t][1]) for e, t, c in nexts]
            best[i, s] = min(ways, default=(10**9, ""))
        for _ in range(4):
            for s in due:
                cost, audit = best[i, due[s]]
                best[i, s] = min(best[i, s], (cost + 3, "I" + audit))
    return best[0, ""]


def plain(rows, originals):
    of = defaultdict(list)
    for row in rows:
        of[row[0]].append(row)
    out = []
    for conv in {row[0] for row in originals}:
        turns = sorted(of[conv], key=lambda r: (r[1] is not None, r[1] or 0))
        found = faults(turns)
        numbers = [t[1] for t in turns if t[1] is not None]
        cost, audit = cheapest(turns, found)
        initials = [t[2][:1] for t in turns]
        again, repaired = apply(turns, found, audit)
        assert again == cost
        out.append(
            (
                conv,
                max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                *[found.count(name) for name in ("blank", "duplicate", "truncated")],
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost,
                audit,
                hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CODE = {(role, fault): code for code, (role, fault) in turn_repair.CODES.items()}
turn = st.tuples(st.sampled_from("suax"), st.sampled_from([0, 0, 0, 1, 2]))


def as_turns(drawn):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    found = [[None, "truncated", "blank"][fault] for _, fault in drawn]
    return [(1, i, names[role], f"t{i}") for i, (role, _) in enumerate(drawn)], found


@given(st.lists(turn, max_size=3))
def test_no_audit_is_better(drawn):
    turns, found = as_turns(drawn)
    tries = ("".join(a) for n in range(8) for a in product("DIKR", repeat=n) if sum(e != "I" for e in a) == len(drawn))
    ways = [(done[0], audit) for audit in tries if (done := apply(turns, found, audit))]
    assert turn_repair.cheapest("".join(CODE[t] for t in drawn), 0, turn_repair.ENDS) == min(ways)


@given(st.lists(turn, max_size=40))
def test_search_equals_the_plain_table(drawn):
    turns, found = as_turns(drawn)
    assert turn_repair.cheapest("".join(CODE[t] for t in drawn), 0, turn_repair.ENDS) == cheapest(turns, found)


@given(st.lists(st.lists(turn, min_size=1, max_size=9), min_size=1, max_size=6))
def test_blocks_put_together_equal_the_whole(parts):
    coded = ["".join(CODE[t] for t in part) for part in parts]
    tables = [turn_repair.search(c, i == 0, i == len(coded) - 1) for i, c in enumerate(coded)]
    assert turn_repair.join_tables(tables) == turn_repair.cheapest("".join(coded), 0, turn_repair.ENDS)


def messy_turns():
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No", " \t\n", "", None, "What?", "Well... ", "ü日本!", "x" * 5000 + "."]
    rows = []
    for conv in [*range(60), None]:
        for k in range(rng.choice([0, 1, 2, 5, 9, 30])):
            rows.append((conv, k * rng.choice([1, 1, 1, 3]) + 1000 * k, rng.choice(roles), rng.choice(texts)))
    rows += [(77, None, "user", "Only one without a number?"), (78, None, None, None), (79, 5, "user", "Hi.")]
    # One long conversation, over several partitions and blocks.
    rows += [(99, k, ["user", "assistant"][k % 2] if k % 7 else rng.choice(roles), f"{k}." if k % 5 else rng.choice(texts)) for k in range(900)]
    return rows


COLUMNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(*r, 1, "x", 2) for r in messy_turns()]
    return spark.createDataFrame(rows, COLUMNS + ", mark int, TEXT string, cost int").repartition(5)


@pytest.mark.parametrize("block", [512, 16])
def test_report_equals_the_plain_form(spark, turns, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK_TURNS", block)
    got = turn_repair.report(turn_repair.damage(turns), turns)
    assert as_rows(got) == plain(damaged(messy_turns()), messy_turns())


def test_damage(turns):
    assert as_rows(turn_repair.damage(turns)) == sorted(damaged(messy_turns()), key=repr)


def test_repaired_turns(spark, turns):
    got = defaultdict(list)
    rows = turn_repair.repaired(turn_repair.damage(turns)).collect()
    for r in sorted(rows, key=lambda r: r.position):
        assert r.position == len(got[r.conv_id])
        assert (r.turn is None and r.text == "") if r.edit == "I" else r.edit in "KR"
        got[r.conv_id].append((r.role, r.text))
    for conv, *_, digest in plain(damaged(messy_turns()), messy_turns()):
        text = "\n".join(f"{r}:{t}" for r, t in got.get(conv, []))
        assert hashlib.sha256(text.encode()).hexdigest() == digest
    assert all(GOOD.fullmatch("".join(r[0] for r, _ in turns)) for turns in got.values())


def test_turns_that_tie_go_by_role_and_text(spark):
    rows = [(1, 3, "user", "b."), (1, 3, "assistant", "a."), (1, 3, "user", "a."), (1, 3, "user", "a.")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        stored = turn_repair.in_order(spark.createDataFrame(rows, COLUMNS).repartition(3))
        in_order = [(r.role, r.text) for r in sorted(stored.collect(), key=lambda r: r.mark)]
        assert in_order == [("assistant", "a."), ("user", "a."), ("user", "a."), ("user", "b.")]
        faults = turn_repair.with_faults(stored)
        assert faults.filter("fault = 'duplicate'").count() == 1


def test_ids_of_other_types(spark):
    rows = [("c", 1, "user", "Hi."), ("c", 2, "user", "There."), (None, 1, "assistant", "Oh")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r.conv_id: (r.audit, r.cost) for r in turn_repair.report(df).collect()}
    assert got == {"c": ("KR", 3), None: ("D", 4)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert turn_repair.report(turn_repair.damage(empty), empty).count() == 0
    assert turn_repair.repaired(empty).count() == 0


def test_query_equals_the_plain_form(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op11_turn_repair(spark, SF_DIR)
    assert as_rows(got) == plain(damaged(rows), rows)
