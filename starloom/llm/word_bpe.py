"""BPE with word ends, merged in rounds over all words of a batch at once.

A text is normalised and cut into words as the vocabulary file says. The symbols of
many words lie in one flat array. In each round all neighbouring pairs become
numbers, a binary search over the sorted pair numbers gives their ranks, and every
pair that nothing can come before is merged in all words together:

* A pair comes first if no pair within the length of the longest token, on either
  side and in the same word, ranks lower. Whatever could take away one of its
  symbols earlier would have to be built of pairs in that stretch. So a word of any
  length needs about as many rounds as a short one.
* Of overlapping pairs with the same symbols (``aaa``) every second one is merged,
  counted from the first of the whole run.
* Two bytes that stand side by side in no token are never in one token; words are
  cut there beforehand.

Words that were met before come from a cache bounded by bytes, which changes speed
only.

Defined results: NULL is encoded as the empty text, no ids; special strings inside a
text are found first, as written, and are one id each; repeated rows get the same
ids; an empty table gives an empty one; extra columns are carried along, and a column
that has the name of a new one is replaced. NULL ids decode to NULL; ids that the
vocabulary lacks are left out, as the library does.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.byte_bpe import BATCH_TOKENS, MOST_VOCABULARY_BYTES, Shared, parts_of, worker_copy
from starloom.llm.tables import only, positional, text_slices, without
from starloom.llm.token_counts import printable_bytes

#: Bytes of a worker's cache of words before it is emptied, counted with Python's own share.
CACHED_BYTES = 96 << 20
ENTRY_BYTES = 200

#: Symbols that are merged together; a single longer word goes alone.
BATCH_SYMBOLS = 1 << 20

#: Rank of pairs that are never merged.
NEVER = np.int64(1) << 60

#: Characters whose case, composition and kind are the same in all Unicode versions at hand.
#: A text with any other is normalised and cut by the functions that the file itself names.
SETTLED = "\x00-՗ -⁤₠-₿ぁ-ゖァ-ヺ一-龥가-힣\U0001f300-\U0001f5ff"


class WordMerges:
    """Tokens by id, the symbols of a byte within and at the end of a word, and ordered merges."""

    def __init__(self, tokens: dict[int, str], plain: list[int], final: list[int], merges: list[tuple[int, int, int]]):
        self.tokens, self.plain, self.final, self.merges = tokens, plain, final, merges
        self._prepare()

    def __getstate__(self):
        return self.tokens, self.plain, self.final, self.merges

    def __setstate__(self, state):
        self.tokens, self.plain, self.final, self.merges = state
        self._prepare()

    def _prepare(self) -> None:
        base = [*self.plain, *self.final]
        self.base = np.int64(1 + max(max(base), max((max(m) for m in self.merges), default=0)))
        content = {symbol: (symbol,) for symbol in base}
        keys = np.empty(len(self.merges), np.int64)
        for rank, (left, right, made) in enumerate(self.merges):
            if left not in content or right not in content:
                raise ValueError("a merge comes before those that make its parts")
            content.setdefault(made, content[left] + content[right])
            keys[rank] = left * int(self.base) + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.made = np.array([m[2] for m in self.merges], np.int64)[self.order]
        self.longest = max(map(len, content.values()))
        # Which two single symbols stand side by side in some token.
        self.of_plain, self.of_final = np.array(self.plain, np.int64), np.array(self.final, np.int64)
        number = {symbol: i for i, symbol in enumerate(dict.fromkeys(base))}
        self.small = np.full(int(self.base), -1, np.int64)
        self.small[list(number)] = list(number.values())
        self.beside = np.zeros((len(number), len(number)), bool)
        for symbols in content.values():
            for left, right in zip(symbols, symbols[1:]):
                self.beside[number[left], number[right]] = True

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes each; words are not empty."""
        out: list[bytes] = []
        begin = held = 0
        for at, word in enumerate(words):
            if at > begin and held + len(word) > BATCH_SYMBOLS:
                out += self._encode_batch(words[begin:at])
                begin, held = at, 0
            held += len(word)
        return out + (self._encode_batch(words[begin:]) if begin < len(words) else [])

    def _encode_batch(self, words: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.of_plain[raw]
        symbols[ends - 1] = self.of_final[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        small = self.small[symbols]
        apart = np.ones(len(raw), bool)
        apart[1:] = (word[1:] != word[:-1]) | ~self.beside[small[:-1], small[1:]]
        part = np.cumsum(apart) - 1
        ids, part_of_id = self._merge(symbols, part)
        counts = np.bincount(word[apart][part_of_id], minlength=len(words))
        packed, at = ids.astype(np.int32).tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
        return [packed[begin:end] for begin, end in zip(at, at[1:])]

    def _merge(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge within each part (numbered, side by side) to the end; symbols and their parts, in order."""
        done_symbols, done_parts = [], []
        while len(symbols):
            rank, found = self._ranks(symbols, part)
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sizes = np.diff(np.append(first, len(part)))
            least = np.minimum.reduceat(rank, first)
            # Parts without a pair to merge are finished.
            live = np.repeat(least < NEVER, sizes)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_parts.append(part[~live])
                symbols, part, rank, found = symbols[live], part[live], rank[live], found[live]
                if not len(symbols):
                    break
                sizes = sizes[least < NEVER]
                first = np.cumsum(sizes) - sizes
            take = self._first_pairs(rank, part, first, sizes)
            symbols[take] = self.made[found[take]]
            keep = np.ones(len(symbols), bool)
            keep[take + 1] = False
            symbols, part = symbols[keep], part[keep]
        if not done_parts:
            return symbols, part
        symbols, part = np.concatenate(done_symbols), np.concatenate(done_parts)
        order = np.argsort(part, kind="stable")
        return symbols[order], part[order]

    def _ranks(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pair that begins at each symbol: its rank, and its place among the sorted keys."""
        rank = np.full(len(symbols), NEVER)
        found = np.zeros(len(symbols), np.int64)
        if len(self.keys) and len(symbols) > 1:
            pairs = symbols[:-1] * self.base + symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            hit = np.flatnonzero((self.keys[place] == pairs) & (part[1:] == part[:-1]))
            rank[hit], found[hit] = self.order[place[hit]], place[hit]
        return rank, found

    def _first_pairs(self, rank: np.ndarray, part: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of the pairs that nothing can come before."""
        inside = np.arange(len(rank)) - np.repeat(first, sizes)
        begins = inside % self.longest == 0
        block = np.cumsum(begins) - 1
        starts = np.flatnonzero(begins)
        least = np.minimum.reduceat(rank, starts)
        near = least.copy()
        joined = part[starts[1:]] == part[starts[:-1]]
        near[1:] = np.where(joined, np.minimum(near[1:], least[:-1]), near[1:])
        near[:-1] = np.where(joined, np.minimum(near[:-1], least[1:]), near[:-1])
        ready = (rank == near[block]) & (rank < NEVER)
        # Runs of one pair overlapping itself.
        opens = np.ones(len(rank), bool)
        opens[1:] = (rank[1:] != rank[:-1]) | (part[1:] != part[:-1]) | (rank[1:] == NEVER)
        run, runs = np.cumsum(opens) - 1, np.flatnonzero(opens)
        whole = np.logical_and.reduceat(ready, runs)
        return np.flatnonzero(whole[run] & ((np.arange(len(rank)) - runs[run]) % 2 == 0))


class Rules:
    """How texts are cut into words: special strings, normalisation, the pattern of words."""

    def __init__(self, special: dict[str, int], pattern: str, form: str, lower: bool, content: str):
        self.special, self.pattern, self.form, self.lower, self.content = special, pattern, form, lower, content
        self._prepare()

    def __getstate__(self):
        return self.special, self.pattern, self.form, self.lower, self.content

    def __setstate__(self, state):
        self.special, self.pattern, self.form, self.lower, self.content = state
        self._prepare()

    def _prepare(self) -> None:
        self.words = regex.compile(self.pattern)
        names = sorted(self.special, key=len, reverse=True)
        self.finder = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.unsettled = regex.compile(f"[^{SETTLED}]")
        self.byte_of = printable_bytes()
        self._library = None

    def stretches(self, text: str) -> list[str]:
        """Plain stretches and special strings in turn."""
        return self.finder.split(text) if self.finder else [text]

    def cut(self, stretch: str) -> list[bytes] | list[str]:
        """Words of a stretch without special strings."""
        if self.unsettled.search(stretch):
            return self._cut_by_library(stretch)
        text = unicodedata.normalize(self.form, stretch)
        if self.lower:
            # Character by character: a sigma at the end of a word is no special case.
            text = "σ".join(piece.lower() for piece in text.split("Σ"))
        return self.words.findall(text)

    def _cut_by_library(self, stretch: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.content)
        found = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(stretch))
        return [bytes(self.byte_of[c] for c in word).decode() for word, _ in found]


def load_json(path: str) -> tuple[WordMerges, Rules]:
    """Merges and rules of a tokenizers file of this kind; any other raises."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    parsed = json.loads(content)
    model, added = parsed["model"], parsed["added_tokens"]
    forms = (parsed["normalizer"] or {}).get("normalizers", [])
    steps = (parsed["pre_tokenizer"] or {}).get("pretokenizers", [])
    spaces = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    known = [form["type"] for form in forms] == ["NFC", "Replace", "Lowercase"] and forms[1] == spaces
    known &= [step["type"] for step in steps] == ["Split", "ByteLevel"]
    known = known and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"]
    known = known and not steps[1]["add_prefix_space"] and model["type"] == "BPE" and not parsed["decoder"]
    plain = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    if not known or any(model.get(name) for name in plain):
        raise ValueError(f"{path} is no BPE of words with NFC, lower case and removed spaces")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{path} has special strings that take in their surroundings")
    vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
    characters = {byte: c for c, byte in printable_bytes().items()}
    pairs = (tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])
    merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
    tokens = {i: token for token, i in vocabulary.items()} | {t["id"]: t["content"] for t in added}
    single = [characters[byte] for byte in range(256)]
    table = WordMerges(tokens, [vocabulary[c] for c in single], [vocabulary[c + end] for c in single], merges)
    special = {t["content"]: t["id"] for t in added}
    return table, Rules(special, steps[0]["pattern"]["Regex"], forms[0]["type"], True, content.decode())


class WordEncoder:
    """Encodes whole texts, merging the words that are new to it together."""

    def __init__(self, merges: WordMerges, rules: Rules):
        self.merges, self.rules = merges, rules
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.special = {name: np.int32(i).tobytes() for name, i in rules.special.items()}

    def _learn(self, words: Iterable[str]) -> None:
        if self.held >= CACHED_BYTES:
            self.known.clear()
            self.held = 0
        new = [word for word in set(words) if word not in self.known]
        raw = [word.encode() for word in new]
        for word, data, ids in zip(new, raw, self.merges.encode_words(raw)):
            self.known[word] = ids
            self.held += ENTRY_BYTES + len(data) + len(ids)

    def encode_all(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = []
        for text in texts:
            pieces = []
            for i, stretch in enumerate(self.rules.stretches(text)):
                if i % 2:
                    pieces.append(stretch)
                else:
                    pieces.append([self.rules.cut(part) for part in parts_of(stretch)])
            cut.append(pieces)
        plain = chain.from_iterable(p for pieces in cut for p in pieces[::2])
        self._learn(chain.from_iterable(plain))
        known = self.known.__getitem__
        out = []
        for pieces in cut:
            found = []
            for i, piece in enumerate(pieces):
                found += [self.special[piece]] if i % 2 else map(known, chain.from_iterable(piece))
            out.append(np.frombuffer(b"".join(found), np.int32))
        return out


def encode_texts(
    df: DataFrame, merges: WordMerges, rules: Rules, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """Add ``ids_col`` (array of int), the encoding of each whole text."""
    df = without(df, ids_col)
    keep, at = df.columns, df.columns.index(text_col)
    shared = Shared(df.sparkSession, (merges, rules))
    inner = positional(df)
    schema = T.StructType([*inner.schema.fields, T.StructField("_ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_copy(shared, lambda both: WordEncoder(*both))
        for batch in text_slices(batches, at):
            ids = encoder.encode_all([text or "" for text in batch.column(at).to_pylist()])
            ends = np.cumsum([len(found) for found in ids])
            begin = 0
            while begin < len(ids):
                # At least one text, at most about so many tokens.
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + BATCH_TOKENS, "right")))
                offsets = np.concatenate([[0], ends[begin:end] - before]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids[begin:end])))
                rows = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "_ids"])
                begin = end

    return inner.mapInArrow(run, schema).toDF(*keep, ids_col)


def decode_ids(df: DataFrame, merges: WordMerges, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``, the tokens of the ids with a space between them."""
    df = without(df, text_col)
    keep, at = df.columns, df.columns.index(ids_col)
    shared = Shared(df.sparkSession, merges.tokens)
    inner = positional(df)
    schema = T.StructType([*inner.schema.fields, T.StructField("_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                lists = batch.column(at)
                offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
                out = []
                for row, valid in enumerate(lists.is_valid().to_pylist()):
                    ids = values[offsets[row] : offsets[row + 1]].tolist()
                    out.append(" ".join([tokens[i] for i in ids if i in tokens]) if valid else None)
                texts = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "_text"])

    return inner.mapInArrow(run, schema).toDF(*keep, text_col)


def digests(
    docs: DataFrame, merges: WordMerges, rules: Rules, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Number of tokens, and hashes of the ids and of the text they are decoded to."""
    rows = only(docs, doc_id=id_col, text=text_col)
    rows = encode_texts(rows, merges, rules).select("doc_id", "ids")
    rows = decode_ids(rows, merges)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
