"""Alignment of two tokenizers, against a plain form that looks at all ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import token_align, token_counts
from starloom.llm.queries import op13_token_align
from starloom.llm.token_counts import printable_bytes
from tests.llm.conftest import messy_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts():
    merges, _ = token_counts.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    model = token_align.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    return merges, public_tokenizers.PATTERN, model


@pytest.fixture(scope="module")
def plain():
    """Tokens of both libraries as ids and bytes, and groups by comparing all ends."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = printable_bytes()

    def piece(i):
        text = second.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if text.startswith("<0x") else text.replace("▁", " ").encode()

    def groups(text):
        whole = (" " + (text or "")).encode()
        a = first.encode(whole.decode(), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [piece(i) for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return []
        a_ends, b_ends = (np.cumsum([*map(len, tokens)]).tolist() for tokens in (a_bytes, b_bytes))
        both, out = {*a_ends} & {*b_ends}, [([], [])]
        for end, kind, i in sorted([(e, 0, i) for e, i in zip(a_ends, a)] + [(e, 1, i) for e, i in zip(b_ends, b)], key=lambda x: x[0]):
            out[-1][kind].append(i)
            if end in both and kind:
                out.append(([], []))
        return out[:-1]

    return groups


def expected(rows, plain):
    """The report by plain loops over all links."""
    found = [(doc_id, plain(text)) for doc_id, text in rows]
    linked = [[(x, y) for a, b in groups for x in a for y in b] for _, groups in found]
    count = Counter(pair for pairs in linked for pair in set(pairs))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, groups), pairs in zip(found, linked):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(pairs),
                sum(count[pair] == most[pair[0]] for pair in pairs),
                sum(count[pair] for pair in pairs),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr)


HARD = [
    (20, "<|endoftext|> <s> </s> <unk> <0x41> plain"),
    (21, "a▁b"),
    (22, "   lead and trail   \n\n\t tabs"),
    (23, "x" * 700),
    (24, "=" * 300 + " " * 250 + "\n" * 40),
    (25, "日本語の文章 한국어 🤝🏽 ﬁ ½ é ́"),
    (26, " "),
    (27, "don't we'll I'VE 12345 3.14"),
    (27, "don't we'll I'VE 12345 3.14"),
    (28, "\x00\x01 \x7f \x85 \xa0"),
]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [token_align.BLOCK_PAIRS, 50])
def test_report_equals_the_plain_form(spark, parts, plain, monkeypatch, block):
    monkeypatch.setattr(token_align, "BLOCK_PAIRS", block)
    rows = [*messy_rows(), *HARD]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n_a int, block int, Text int")
    got = token_align.report(docs.repartition(3), *parts)
    assert as_rows(got) == expected(rows, plain)


def test_query_equals_the_plain_form(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = op13_token_align(spark, SF_DIR)
    assert got.columns[:4] == ["doc_id", "n_a", "n_b", "n_groups"]
    assert as_rows(got) == expected([tuple(d) for d in docs], plain)


def test_empty_table(spark, parts, nothing):
    assert token_align.report(nothing, *parts).count() == 0
    assert token_align.vocabulary_map(nothing, *parts).count() == 0
    assert token_align.align_texts(nothing, *parts).count() == 0


def test_texts_with_their_alignment(spark, parts, plain):
    docs = spark.createDataFrame([*messy_rows(), *HARD], "doc_id long, text string")
    for row in token_align.align_texts(docs, *parts).collect():
        groups, i, j = [], 0, 0
        for to_i, to_j in zip(row.a_cuts, row.b_cuts):
            groups.append((row.a_ids[i:to_i], row.b_ids[j:to_j]))
            i, j = to_i, to_j
        assert groups == plain(row.text)


def test_vocabulary_map(spark, parts, plain):
    rows = [(1, "the cat"), (2, "the dog"), (3, "the cat"), (4, None)]
    got = token_align.vocabulary_map(spark.createDataFrame(rows, "doc_id long, text string"), *parts)
    count = Counter()
    for _, text in rows:
        count.update({(x, y) for a, b in plain(text) for x in a for y in b})
    most = {x: max(n for (z, _), n in count.items() if z == x) for x, _ in count}
    assert {tuple(r) for r in got.collect()} == {(x, y, n, n == most[x]) for (x, y), n in count.items()}


def test_every_token_is_the_encoding_of_its_bytes(parts):
    # What makes ranks and merges agree: each token is found again from its own bytes.
    merges, _, _ = parts
    for rank, token in enumerate(merges.tokens):
        assert merges.walk(merges.table(token), len(token)) == [rank]


def test_long_texts_go_to_our_own_encoder(parts, monkeypatch):
    merges, pattern, _ = parts
    coder, text = token_align.ByteTokens(merges, pattern, " "), "plain words, and more 12 of them \n  " * 300
    whole = coder.encode_all([text])[0].tolist()
    monkeypatch.setattr(token_align, "LONG_CHARS", 100)
    assert coder.encode_all([text])[0].tolist() == whole
    assert len(coder.encode_all([" " * 2_000_000 + "x"])[0]) >= 1


@given(st.lists(st.integers(1, 4), max_size=60), st.data())
def test_cuts_of_any_ends(sizes, data):
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    drawn = data.draw(st.sets(st.integers(1, max(total, 1)), max_size=total)) if total else set()
    other = np.array(sorted({e for e in drawn if e <= total} | ({total} if total else set())), np.int64)
    both = sorted({*ends.tolist()} & {*other.tolist()})
    a, b = token_align.cuts(ends, other)
    assert a.tolist() == [int(np.searchsorted(ends, e)) + 1 for e in both]
    assert b.tolist() == [int(np.searchsorted(other, e)) + 1 for e in both]


def test_long_stretches_take_few_comparisons():
    rng = random.Random(2)
    ends = np.cumsum([rng.randint(1, 9) for _ in range(200_000)])
    other = np.delete(ends, [5, 70_000, 70_001, 150_000])
    a, b = token_align.cuts(ends, other)
    assert len(a) == len(other) and (ends[a - 1] == other[b - 1]).all()


@given(st.binary(max_size=400))
def test_packing(data):
    values = np.frombuffer(data[: len(data) // 4 * 4], "<u4").astype(np.int64)
    assert token_align._unpack(token_align._pack(values)).tolist() == values.tolist()
