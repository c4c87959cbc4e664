"""Quoted messages, the pipeline, and the registered queries."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

import check
from starloom import llm
from starloom.llm import byte_bpe, chat_quotes
from tests.llm.test_near_and_items import contamination, groups
from tests.llm.test_rules_and_models import stats
from tests.llm.test_shards_and_lines import dedup

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF_DIR = "/root/testdata/sf0.001"
MAIL = "id bigint, thread bigint, sent bigint, role string, body string, ROOT int, depth string"


def mail(spark, rows):
    return spark.createDataFrame([(i, t, s, "u", b, 0, "x") for i, t, s, b in rows], MAIL)


def found(spark, rows):
    out = chat_quotes.conversations(mail(spark, rows)).collect()
    return {r.id: (r.root, r.depth, r.parent, r.text) for r in out}


def test_nested_quotes(spark):
    rows = [
        (1, 1, 1, "How do I sort a list?\nIt is long."),
        (2, 1, 2, "On Monday A wrote:\n> How do I SORT  a list?\n> It is long.\nUse sorted for that."),
        (3, 1, 3, "> Use sorted for that.\n>> How do I sort a list?\n>> It is long.\nThanks a lot, works."),
        (4, 1, 4, ">  > It is long.\nSome other answer here."),
        (5, 2, 5, "> Use sorted for that.\nQuoted from elsewhere, too."),
        (6, 2, 6, "> nobody ever wrote this line\nMy own line."),
    ]
    got = found(spark, rows)
    assert got[1] == (1, 0, None, rows[0][3])
    assert got[2] == (1, 1, 1, "Use sorted for that.")
    assert got[3] == (1, 2, 2, "Thanks a lot, works.")
    assert got[4] == (1, 1, 1, "Some other answer here.")
    assert got[5] == (1, 2, 2, "Quoted from elsewhere, too.")
    assert got[6] == (6, 0, None, "My own line.")


def test_odd_messages(spark):
    rows = [
        (1, 1, 1, None), (2, 1, 2, ""), (3, 1, 3, "> > >"), (4, 1, 4, "same words here\n> same words here"),
        (5, 1, 5, "b words to repeat"), (5, 1, 5, "a words to repeat"), (None, 1, 6, "no id of mine"),
        (7, None, 7, "> same words here\nfine"), (8, 1, 0, "> same words here\ntoo early"), (9, 1, 9, "x" * 5000),
    ]
    got = found(spark, rows)
    assert set(got) == {1, 2, 3, 4, 5, 7, 8, 9}
    assert got[7][:3] == (4, 1, 4)
    every = chat_quotes.conversations(mail(spark, [*rows, rows[4]])).filter("id = 5").collect()
    assert sorted(r.text for r in every) == ["a words to repeat", "b words to repeat"]
    assert len({r.variant for r in every}) == 2
    assert all(got[k][:3] == (k, 0, None) for k in (1, 2, 3, 4, 5, 8, 9))
    assert chat_quotes.conversations(mail(spark, rows).limit(0)).count() == 0


def test_own_text_is_kept_as_it_stands(spark):
    first = "Hello there everyone.\n\nOn this topic Kant wrote:\nOne should read\t more. \n\n>>> print(1)\nbye now\n"
    rows = [
        (1, 1, 1, first),
        (2, 1, 2, "Yes.\n\nOn Monday A wrote:\n\n> Hello there everyone.\n> On this topic Kant wrote:\n> One should read more.\n\nFine.\r\nBye."),
        (3, 1, 3, "> On Monday B wrote:\n>> Hello there everyone.\n> Yes.\nOn Friday C wrote:"),
    ]
    out = {r.id: r for r in chat_quotes.conversations(mail(spark, rows)).collect()}
    assert out[1].text == first.replace(">>> print(1)\n", "") and out[1].quoted == ">>> print(1)"
    assert out[2].text == "Yes.\n\n\n\nFine.\r\nBye." and out[2].quoted.startswith("On Monday A wrote:\n> Hello")
    assert out[3].text == "On Friday C wrote:" and out[3].quoted.count("\n") == 2
    assert (out[2].parent, out[3].parent, out[3].depth) == (1, 2, 2)


def plain_links(rows):
    """Parents by plain loops, for messages that quote whole messages of one level."""
    def parts(body):
        levels = [(len(m[0].replace(" ", "")) if (m := re.match(r"(>[ ]*)+", line)) else 0, re.sub(r"^(>[ ]*)+", "", line)) for line in body.split("\n")]
        return levels

    out = {}
    for i, thread, sent, body in rows:
        score = Counter()
        for level, text in parts(body):
            normal = " ".join(text.lower().split())
            if level == 1 and normal:
                writers = [(s, j) for j, t, s, b in rows if t == thread and any(lv == 0 and " ".join(x.lower().split()) == normal for lv, x in parts(b))]
                if writers and min(writers) < (sent, i):
                    score[min(writers)] += len(normal.split())
        out[i] = min(score, key=lambda w: (-score[w], w))[1] if score else None
    return out


def test_random_mail_against_plain_loops(spark):
    rng = random.Random(8)
    rows, words = [], [f"w{k}" for k in range(40)]
    for i in range(120):
        thread = rng.randrange(6)
        own = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 7))) for _ in range(rng.randint(1, 3))]
        body = [*own[:1], *([""] if rng.random() < 0.4 else []), *own[1:]]
        before = [r for r in rows if r[1] == thread]
        if before and rng.random() < 0.8:
            quoted = rng.choice(before)[3].split("\n")
            lines = [line for line in quoted if line and not line.startswith(">")][:2]
            # One quoted line at a time, so that passages are lines.
            for line in lines:
                body += [f"> {line.upper()}", f"between {i} {rng.randrange(10**6)} lines"]
        rows.append((i, thread, i, "\n".join(body)))
    out = {r.id: r for r in chat_quotes.conversations(mail(spark, rows)).collect()}
    parents = plain_links(rows)
    for i, thread, sent, body in rows:
        assert out[i].text == "\n".join(line for line in body.split("\n") if not line.startswith(">"))
        assert out[i].parent == parents[i]
        depth, at = 0, i
        while parents[at] is not None:
            depth, at = depth + 1, parents[at]
        assert (out[i].root, out[i].depth) == (at, depth)


def test_short_messages_are_quoted_within_their_thread(spark):
    rows = [
        (1, 1, 1, "Shall we meet on Monday morning?"),
        (2, 1, 2, "> Shall we meet on Monday morning?\nOK thanks"),
        (3, 1, 3, "> OK thanks\n>> Shall we meet on Monday morning?\nはい"),
        (4, 1, 4, "> はい\nSee you there then."),
        (5, 2, 5, "> OK thanks\nQuoted from elsewhere."),
    ]
    got = found(spark, rows)
    assert [got[k][:3] for k in (1, 2, 3, 4)] == [(1, 0, None), (1, 1, 1), (1, 2, 2), (1, 3, 3)]
    assert got[5][:3] == (5, 0, None)


def test_long_chains_and_common_openings(spark):
    rows = [(100 * c, c, 0, "hello to all of you") for c in range(20)]
    for c in range(20):
        for k in range(1, 20 if c else 70):
            quote = "hello to all of you" if k == 1 else f"answer number {k - 1} of {c}"
            rows.append((100 * c + k, c, k, f"> {quote}\nanswer number {k} of {c}"))
    got = found(spark, rows)
    for i, (root, depth, parent, _) in got.items():
        assert (root, depth, parent) == (100 * (i // 100), i % 100, i - 1 if i % 100 else None)


def test_turns_as_mail_and_back(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = chat_quotes.conversations(chat_quotes.as_mail(turns)).collect()
    assert Counter((r.id.conv_id, r.id.turn, r.text) for r in rows) == Counter(
        (r.conv_id, r.turn, r.text) for r in turns.collect()
    )
    assert all((r.root.conv_id, r.root.turn, r.depth) == (r.id.conv_id, 0, r.id.turn) for r in rows)


def test_no_python_on_the_main_path(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    plan = chat_quotes.conversations(chat_quotes.as_mail(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    seen = dict(rows)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == (columns if number < 4 else [*columns, "ids"])
        got = {r.doc_id: r for r in out.collect()}
        before = [(i, r.text) for i, r in sorted(seen.items())]
        if name == "quality_rules":
            kept = {i for i, t in before if (s := stats(t))[0] >= 50 and 100 * s[4] <= 50 * s[0]}
            assert set(got) <= kept and all(got[i] == seen[i] for i in got)
            # What the list rejects has symbols that the rest does not have.
            assert all(stats(seen[i].text)[2] > 0.1 * stats(seen[i].text)[0] for i in kept - set(got))
        elif name == "line_dedup":
            assert {(i, r.text) for i, r in got.items()} == {(i, t) for i, t, n in dedup(before) if t.strip()}
            assert all(r.n_chars == len(r.text) for r in got.values())
        elif name == "near_copies":
            assert set(got) == {i for i, _, least in groups(before) if i == least}
        elif name == "decontamination":
            items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
            assert set(got) == {row[0] for row in contamination(before, items) if not row[-1]}
        else:
            import public_tokenizers

            merges = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
            assert all(merges.decode(r.ids).decode() == r.text for r in got.values()) and set(got) == set(seen)
        seen = got
        docs = spark.createDataFrame(list(got.values()), out.schema)
    final = corpus_pipeline.run(spark, SF_DIR)
    assert {(r.doc_id, tuple(r.ids)) for r in final.collect()} == {(i, tuple(r.ids)) for i, r in seen.items()}


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query(spark, name):
    assert check.compare(spark, SF_DIR, name, llm.oracle_sql().get(name)) == ""
    assert name.startswith("op")


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in llm.queries()) == list(range(1, 14))
