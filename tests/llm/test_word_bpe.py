"""BPE with word ends, against the library."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import word_bpe
from starloom.llm.queries import op12_word_bpe
from tests.llm.conftest import messy_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"
PIECES = ["a", "b", "aa", "the", "ing", " ", "\n", "É", "é", "́", "Σ", "ς", "İ", "ﬁ", "日本", "<|endoftext|>"]
PIECES += ["<|startoftext|>", "<|end", "'S", "'re", "1", "23", "!!", "😀", "\U0001f9ff", "\x1c", "\x85", "　", "ß"]
PIECES += ["࢏", "한국", "ᄒ", "ᅡ", "ᆫ", "\x00", "_", "՘", "꟎"]


@pytest.fixture(scope="module")
def loaded():
    return word_bpe.load_json(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def long_words():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = ["".join(rng.choice(letters) for _ in range(n)) for n in (200, 3000)]
    out += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 900))) for _ in range(60)]
    out += ["a" * n for n in range(1, 70)] + ["haha" * 400 + "x", "!" * 3000]
    return out + ["".join(rng.choice(["th", "e", "in", "an", "er", "aa"]) for _ in range(700)) for _ in range(30)]


def ids_of(library, some):
    return [found.ids for found in library.encode_batch(some, add_special_tokens=False)]


@pytest.mark.parametrize("some", [texts(600, 1), long_words()], ids=["pieces", "long"])
def test_encoding_equals_the_library(loaded, library, some):
    found = word_bpe.WordEncoder(*loaded).encode_all(some)
    assert [ids.tolist() for ids in found] == ids_of(library, some)


def test_results_do_not_depend_on_batches_or_caches(loaded, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "BATCH_SYMBOLS", 7)
    monkeypatch.setattr(word_bpe, "CACHED_BYTES", 300)
    encoder = word_bpe.WordEncoder(*loaded)
    some = texts(120, 5)
    assert [encoder.encode_all([text])[0].tolist() for text in some] == ids_of(library, some)
    assert encoder.held < 20_000


def test_rounds_equal_the_plain_form(loaded, library):
    # The plain form merges one pair at a time, the least rank first, leftmost first.
    merges, _ = loaded
    for word in long_words()[:4]:
        symbols = [merges.plain[b] for b in word.encode()[:-1]] + [merges.final[word.encode()[-1]]]
        rank_of = {(left, right): (rank, made) for rank, (left, right, made) in reversed(list(enumerate(merges.merges)))}
        while True:
            ranked = [(rank_of[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank_of]
            if not ranked:
                break
            at = min(ranked)[1]
            symbols[at : at + 2] = [rank_of[symbols[at], symbols[at + 1]][1]]
        [found] = merges.encode_words([word.encode()])
        assert memoryview(found).cast("i").tolist() == symbols


def test_settled_characters_are_cut_as_the_library_cuts_them(loaded, library):
    _, rules = loaded
    settled = re.compile(f"[{word_bpe.SETTLED}]")
    some = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)]) if settled.match(c)]
    assert len(some) > 30_000
    for begin in range(0, len(some), 500):
        text = " ".join(f"a{c}b" for c in some[begin : begin + 500])
        normal = library.normalizer.normalize_str(text)
        assert [w.encode() for w in rules.cut(text)] == [
            bytes(rules.byte_of[c] for c in word) for word, _ in library.pre_tokenizer.pre_tokenize_str(normal)
        ]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        word_bpe.load_json(public_tokenizers.path("byte_bpe_50k.json"))


def test_frames_of_all_kinds(loaded, library, messy):
    rows = word_bpe.decode_ids(word_bpe.encode_texts(messy, *loaded), loaded[0])
    assert rows.columns == [*[c for c in messy.columns if c != "ids"], "ids", "decoded"]
    got = sorted((repr(r.doc_id), r.text or "", r.ids, r.decoded) for r in rows.collect())
    want = []
    for doc_id, text in messy_rows():
        [ids] = ids_of(library, [text or ""])
        want.append((repr(doc_id), text or "", ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_unknown_and_missing_ids(spark, loaded, library):
    rows = spark.createDataFrame([(1, [320, 10**6, 0]), (2, None), (3, [])], "n int, ids array<int>")
    got = {r.n: r.decoded for r in word_bpe.decode_ids(rows, loaded[0]).collect()}
    assert got == {1: library.decode([320, 10**6, 0], skip_special_tokens=False), 2: None, 3: ""}


def test_empty_table(loaded, nothing):
    assert word_bpe.encode_texts(nothing, *loaded).count() == 0
    assert word_bpe.digests(nothing, *loaded).count() == 0


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = set()
    for doc, ids in zip(docs, ids_of(library, [d.text or "" for d in docs])):
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), decoded)]
        want.add((doc.doc_id, len(ids), *digest))
    got = op12_word_bpe(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want
