"""Byte-level BPE and token counts, against the libraries."""

import base64
import hashlib
import random
import time
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from starloom.llm import byte_bpe, token_counts
from tests.llm.conftest import messy_rows

PIECES = ["a", "the", " the", "'", "'re", "s", " ", "  ", "\n", "é", "日本", "1", "23", "-", "<|endoftext|>", "<|end", "😀", "ing", "A"]


@pytest.fixture(scope="module")
def merges():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    merges, special = token_counts.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.Counter(merges, public_tokenizers.PATTERN, special)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False))


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_encoding_is_exact_and_comes_back(merges, reference):
    encoder = byte_bpe.Encoder(merges, public_tokenizers.PATTERN)
    some = [*texts(300, 1), "x" * 4000, " " * 4000, "ab" * 2000]
    for text, ids in zip(some, encoder.encode_all(some)):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert merges.decode(ids.tolist()).decode() == text


def test_other_rank_file(reference):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    theirs = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = byte_bpe.Encoder(byte_bpe.load_ranks(path), public_tokenizers.PATTERN)
    for text in texts(200, 9):
        assert ours.encode(text).tolist() == theirs.encode_ordinary(text)


def test_cache_that_overflows_changes_nothing(merges, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PAIRS", 5)
    encoder = byte_bpe.Encoder(merges, public_tokenizers.PATTERN)
    encoder.cache.most = 3
    for text in texts(100, 2):
        assert encoder.encode(text).tolist() == reference.encode_ordinary(text)


def test_long_texts_are_cut_where_pieces_end(merges, reference, monkeypatch):
    text = " ".join(texts(60, 3)) + " plain words here and there " * 20
    parts = list(byte_bpe.parts_of(text, 40))
    assert len(parts) > 5 and "".join(parts) == text
    assert sum((reference.encode_ordinary(p) for p in parts), []) == reference.encode_ordinary(text)


def test_appends_and_edits_are_exact(merges, reference):
    rng = random.Random(4)
    for start in texts(60, 5):
        text = byte_bpe.EditableText(merges, public_tokenizers.PATTERN, start)
        for _ in range(4):
            begin = rng.randint(0, len(text.text))
            end = min(len(text.text), begin + rng.randint(0, 4))
            text.replace(begin, end, "".join(rng.choice("ab' \nre1é") for _ in range(rng.randint(0, 4))))
            assert text.encode() == reference.encode_ordinary(text.text)
            text.append(rng.choice(PIECES))
            assert text.encode() == reference.encode_ordinary(text.text)


def test_table_after_an_edit(merges):
    rng = random.Random(6)
    for _ in range(40):
        old = bytes(rng.choice(b"thein ") for _ in range(300))
        begin = rng.randint(0, 280)
        end, new = begin + rng.randint(0, 6), bytes(rng.choice(b"the") for _ in range(rng.randint(0, 5)))
        table = merges.edited(merges.last_tokens(old), old, begin, end, new)
        assert table == merges.last_tokens(old[:begin] + new + old[end:])


def test_digests(messy, nothing, merges, reference):
    found = Counter(tuple(r) for r in byte_bpe.digests(messy, merges, public_tokenizers.PATTERN).collect())
    expected = Counter()
    for i, text in messy_rows():
        ids = reference.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        expected[i, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert found == expected
    assert byte_bpe.digests(nothing, merges, public_tokenizers.PATTERN).count() == 0


def test_other_columns_pass(messy, merges):
    encoded = byte_bpe.encode_texts(messy, merges, public_tokenizers.PATTERN)
    assert sorted(encoded.columns) == sorted(messy.columns) and encoded.columns[-1] == "ids"
    decoded = byte_bpe.decode_ids(encoded, merges).toDF(*[f"c{i}" for i in range(len(messy.columns) + 1)])
    assert all(bytes(r[-1]) == (r[1] or "").encode() for r in decoded.collect())


def test_counts(messy, nothing, counter, library):
    merges, special = token_counts.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    found = token_counts.count_tokens(messy, merges, special, public_tokenizers.PATTERN)
    expected = Counter()
    for i, text in messy_rows():
        n = library(text or "")
        expected[i, len((text or "").encode()), n, n > 512] += 1
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert token_counts.count_tokens(nothing, merges, special, public_tokenizers.PATTERN).count() == 0


def test_every_prefix_is_counted(counter, library):
    for text in texts(60, 7):
        prefixes = counter.prefixes(text)
        assert prefixes.total() == library(text)
        assert [prefixes.count(end) for end in range(len(text) + 1)] == [library(text[:end]) for end in range(len(text) + 1)]


def test_longest_prefix_within_a_budget(counter, library):
    for budget, text in enumerate(texts(60, 8)):
        budget %= 14
        best = max(end for end in range(len(text) + 1) if library(text[:end]) <= budget)
        assert counter.prefixes(text).longest_within(budget) == best


def test_prefixes_of_white_space_and_contractions(counter, library):
    rng = random.Random(12)
    some = ["a \n b", "a\n  b's 're", "\n \n  \t x", "it'll  've'd", "!!<|endoftext|> <|endoftext|>  y", " ", ""]
    some += ["".join(rng.choice([" ", "\n", "\t", "a", "'", "s", "l", "!", "1", "é", "\x1c", "\xa0"]) for _ in range(14)) for _ in range(150)]
    for text in some:
        prefixes = counter.prefixes(text)
        assert [prefixes.count(end) for end in range(len(text) + 1)] == [library(text[:end]) for end in range(len(text) + 1)]


def test_long_unbroken_texts_are_cut_in_time(counter, library):
    rng = random.Random(13)
    unbroken = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    begun = time.process_time()
    end = counter.prefixes(unbroken).longest_within(300)
    assert time.process_time() - begun < 30
    assert library(unbroken[:end]) <= 300 < library(unbroken[: end + 1])
    for run in (" " * 200_000 + "x", "\n" * 100_000 + " y"):
        prefixes = counter.prefixes(run)
        for at in (1, 1000, len(run) - 1, len(run)):
            assert prefixes.count(at) == library(run[:at])


def test_truncate(messy, library):
    merges, special = token_counts.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    cut = token_counts.truncate(messy, merges, special, public_tokenizers.PATTERN, 20)
    assert cut.columns == messy.columns
    for r in cut.toDF(*[f"c{i}" for i in range(len(messy.columns))]).collect():
        assert r.c1 is None or library(r.c1) <= 20
