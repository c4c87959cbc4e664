"""Documents with everything that goes wrong, and plain Python forms of the contracts."""

from __future__ import annotations

import random
import re

import pytest

SCHEMA = "doc_id bigint, text string, lang string, DOC_ID string, spans int, n_words int, ids int, shard int, n int, _c1 int"


def as_docs(spark, rows):
    """``documents`` with extra columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, "en", "x", 1, 2, 3, 4, 5, 6) for i, t in rows], SCHEMA)


PASSAGE = "\n".join(f"line {k} of a passage that comes again and again" for k in range(4))


def messy_rows():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = text(120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (None, "no id here at all"),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, "Short."),
        (4, "Short."),
        (5, base),
        (6, base),
        (7, " ".join(near)),
        (7, "another text with the same id"),
        (8, "É à ß 日本語 😀 ️ \x00 <|endoftext|> it's we'RE"),
        (9, PASSAGE + "\nown line"),
        (10, "first\n" + PASSAGE),
        (2**53 + 1, "same line\n" * 9),
        (2**53 + 2, "x" * 3000),
        (12, "\n".join(text(9) for _ in range(400))),
        (13, "a b c d"),
        (14, "A  b\tC d"),
    ]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return as_docs(spark, messy_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return as_docs(spark, [(1, "x")]).limit(0)


def words(text):
    """``[^\\x20\\x09-\\x0D]+`` of a text."""
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
