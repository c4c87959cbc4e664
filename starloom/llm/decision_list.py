"""Quality rules: a decision list learned from labelled text statistics.

*Statistics* of a text: its words ``[^\\x20\\x09-\\x0D]+``, their characters, symbols,
repeated lines and words in repeated windows of three words. They are one expression
of built-in functions.

*Learning* is sequential covering. A rule is a conjunction of thresholds on ratios of
the statistics. It is grown one condition at a time by information gain on two thirds
of the labelled rows, pruned from its end on the other third, and kept if it is right
often enough there; the rows that it covers are set aside and the next rule is grown.
Every step is one aggregation over the labelled statistics, by feature and bin, of
which the driver sees a few hundred counts.

The list becomes one ordered ``CASE WHEN`` expression; a document that no rule rejects
is kept.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import let, only, positional
from starloom.storage import materialize

WORD = r"[^\x20\x09-\x0D]"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: Column) -> Column:
    """A struct of the statistics of ``text`` (NULL counts as empty).

    Repeated windows are found by hash: of the words of a text, 64 bits less those
    that its positions need. Two windows of a text of 1000 words are confused with a
    chance of about 1e-11.
    """

    def of(text: Column) -> Column:
        words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
        lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
        n_dup = let(lines, lambda seen: F.size(seen) - F.size(F.array_distinct(seen)))
        return let(
            words,
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
                n_dup.cast("bigint").alias("n_dup_lines"),
                _repeated(w).alias("n_repeat_words"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


def _repeated(w: Column) -> Column:
    """Words inside windows of three words that occur twice or more."""

    def of(positions: Column) -> Column:
        # A window adds three words, less those that the window before it has already.
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).cast("bigint").alias("last"))
        add = lambda acc, p: F.struct(
            (acc.n + F.least(F.lit(3).cast("bigint"), p - acc.last)).alias("n"), p.alias("last")
        )
        return F.aggregate(positions, start, add, lambda acc: acc.n)

    def by_hash(mask: Column) -> Column:
        # Hash in the high bits, position in the low ones: sorting brings equal windows together.
        packed = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
            .bitwiseAND(F.bitwise_not(mask))
            .bitwiseOR(i.cast("bigint")),
        )

        def twice(s: Column) -> Column:
            high = lambda x: x.bitwiseOR(mask)
            same = F.filter(
                s,
                lambda x, i: F.coalesce(high(x) == high(F.get(s, i + 1)), F.lit(False))
                | F.coalesce(high(x) == high(F.get(s, i - 1)), F.lit(False)),
            )
            return F.sort_array(F.transform(same, lambda x: x.bitwiseAND(mask)))

        return let(F.sort_array(packed), lambda s: of(twice(s)))

    bits = F.ceil(F.log2(F.size(w) + F.lit(1.0))).cast("int")
    mask = F.expr("1L")
    return let(F.call_function("shiftleft", mask, bits) - 1, by_hash)


#: What rules speak of, from the statistics; texts without words have 0.
FEATURES = {
    "words": lambda s: s.n_words.cast("double"),
    "chars_per_word": lambda s: _ratio(s.word_chars, s.n_words),
    "symbols_per_word": lambda s: _ratio(s.n_symbols, s.n_words),
    "dup_lines_per_word": lambda s: _ratio(s.n_dup_lines, s.n_words),
    "repeat_share": lambda s: _ratio(s.n_repeat_words, s.n_words),
}


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def base_failed(s: Column, least_words: int = 50, most_repeated: int = 50) -> Column:
    """Too few words, or more than ``most_repeated`` per cent of them repeated."""
    return (s.n_words < least_words) | (100 * s.n_repeat_words > most_repeated * s.n_words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, value: Column) -> Column:
        return value > F.lit(self.limit) if self.above else value <= F.lit(self.limit)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules that reject, in order; a document that none rejects is kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rule(self, s: Column) -> Column:
        """Number of the first rule that holds, from 1; NULL if none does."""
        out = None
        for number, rule in enumerate(self.rules, 1):
            holds = _all([c.holds(FEATURES[c.feature](s)) for c in rule])
            out = F.when(holds, F.lit(number)) if out is None else out.when(holds, F.lit(number))
        return F.lit(None).cast("int") if out is None else out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules)


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


#: Labelled documents that are looked at, those with the smallest hash of the id.
SAMPLE = 10_000
#: Cuts per feature come from so many quantiles of either class.
QUANTILES = 32


def labelled_features(docs: DataFrame, labels: DataFrame, label_col: str, bad, sample: int) -> DataFrame:
    """``bad`` (0 or 1), ``part`` (0, 1, 2) and the features of at most ``sample`` labelled ids.

    Ids with contradicting labels, NULL ids and NULL labels teach nothing, and neither
    do documents that the base rules reject anyway.
    """
    given = only(labels, doc_id="doc_id", label=label_col).filter("doc_id is not null and label is not null")
    given = given.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    given = given.filter("label = other").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` short rows.
    rows = docs.join(F.broadcast(given), "doc_id").select(
        (F.col("label") == F.lit(bad)).cast("int").alias("bad"),
        F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)).cast("int").alias("part"),
        statistics(F.col("text")).alias("s"),
    )
    rows = materialize(rows, "statistics").filter(~base_failed(F.col("s")))
    return rows.select("bad", "part", *[of(F.col("s")).alias(name) for name, of in FEATURES.items()])


def learn(
    rows: DataFrame, most_rules: int = 8, most_conditions: int = 3, precision: float = 0.9, least: int = 5
) -> DecisionList:
    """A decision list from :func:`labelled_features`.

    A rule must be right for at least ``precision`` of the pruning rows that it covers
    and cover at least ``least`` bad rows there. Without labels the list is empty.
    """
    cuts = _cuts(rows)
    rest = materialize(rows.select("bad", "part", *[_bin(f, cuts[f]) for f in FEATURES]), "bins")
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < most_rules:
        grown = _grow(rest.filter("part < 2"), cuts, most_conditions)
        pruned = _prune(rest.filter("part = 2"), grown, precision, least)
        if not pruned:
            break
        rules.append(tuple(Condition(f, above, cuts[f][at]) for f, above, at in pruned))
        rest = rest.filter(~_all([_holds(c) for c in pruned]))
    return DecisionList(tuple(rules))


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Half way between neighbouring quantiles of the two classes."""
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).collect()
    cuts = {}
    for f in FEATURES:
        values = sorted({v for row in found for v in row[f] or ()})
        cuts[f] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return cuts


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many cuts a value is above."""
    if not cuts:
        return F.lit(0).alias(feature)
    value = F.col(feature)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: value > cut)).alias(feature)


def _holds(condition: tuple[str, bool, int]) -> Column:
    """A condition on bins: a value in bin ``b`` is above the first ``b`` cuts."""
    feature, above, at = condition
    return F.col(feature) > at if above else F.col(feature) <= at


def _grow(rows: DataFrame, cuts: dict[str, list[float]], most: int) -> list[tuple[str, bool, int]]:
    """Add the condition with the largest information gain while good rows are covered."""
    chosen: list[tuple[str, bool, int]] = []
    while len(chosen) < most:
        covered = rows.filter(_all([_holds(c) for c in chosen]))
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES])
        counts = covered.select("bad", F.explode(pairs).alias("x")).groupBy("x.feature", "x.bin")
        table: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
        for row in counts.agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect():
            table[row.feature][row.bin] = (row.bad, row.n - row.bad)
        bad = sum(b for b, _ in table["words"].values())
        good = sum(g for _, g in table["words"].values())
        if not bad or not good:
            break
        best = None
        for f in FEATURES:
            for at in range(len(cuts[f])):
                for above in (True, False):
                    part = [v for b, v in table[f].items() if (b > at) == above]
                    b, g = sum(x for x, _ in part), sum(y for _, y in part)
                    if b and g < good:
                        gain = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good)))
                        best = max(best or (0.0,), (gain, -at, f, above, at))
        if not best or len(best) == 1:
            break
        chosen.append(best[2:])
    return chosen


def _prune(rows: DataFrame, rule: list, precision: float, least: int) -> list:
    """The beginning of the rule that is right most often on rows it was not grown on."""
    if not rule:
        return []
    sums = []
    for k in range(1, len(rule) + 1):
        holds = _all([_holds(c) for c in rule[:k]]).cast("int")
        sums += [F.sum(holds * F.col("bad")).alias(f"b{k}"), F.sum(holds).alias(f"n{k}")]
    found = rows.agg(*sums).first()
    scored = []
    for k in range(1, len(rule) + 1):
        b, n = found[f"b{k}"] or 0, found[f"n{k}"] or 0
        if b >= least and b >= precision * n:
            scored.append(((2 * b - n) / n, -k))
    return rule[: -max(scored)[1]] if scored else []


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bad=0, sample: int = SAMPLE) -> DecisionList:
    """Learn from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id`` and the label)."""
    return learn(labelled_features(only(docs, doc_id="doc_id", text="text"), labels, label_col, bad, sample))


def judge(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its statistics, and what the base rules and the list say.

    NULL and empty texts have no words and fail the base rules. Repeated rows are
    judged alike; an empty table gives an empty one; extra columns are not looked at.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", statistics(F.col("text")).alias("s"))
    failed = base_failed(F.col("s"))
    rule = rules.rule(F.col("s"))
    return rows.select(
        "doc_id",
        *[F.col(f"s.{name}") for name in STATISTICS],
        failed.alias("base_failed"),
        (~failed & rule.isNull()).alias("kept"),
        rule.alias("rule"),
    )


def keep_good(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``docs`` without those that the base rules or the list reject; columns as they are."""
    text = F.col(f"_c{docs.columns.index(text_col)}")
    good = let(statistics(text), lambda s: ~base_failed(s) & rules.rule(s).isNull())
    return positional(docs).filter(good).toDF(*docs.columns)
