"""Line deduplication by overlapping windows of three lines.

Lines with something on them, trimmed, are the content of a document. Every three
consecutive ones are a window; a document with one or two has one window of what it
has. A window that occurs more than once in the corpus is kept where it comes first
(smallest id, then hash of the text, then line) and covers lines to remove elsewhere.
Covered stretches that touch or overlap are merged and cut out, with the empty lines
between their lines. Every line of a removed stretch is still there in an earlier
place, because a window's first place comes before all its others.

With ``long_words``, one and two consecutive lines of at least so many words are
windows too, in documents of any length. Passages that begin or end inside a line
are not found. The SQL below is the rule without ``long_words``.

Only DataFrame functions are used. Windows are reduced to one row per hash on the
map side; the join back to their places is a plain equi-join that adaptive execution
splits where one window fills a partition; covered stretches are merged by a window
over one document, so nothing larger than a document is ever held together.

Defined results: NULL and empty texts have no windows and stay as they are. Rows
equal in id and text are one document that was stored twice: they are treated alike
and do not remove each other. A NULL id comes before all others. An empty table gives
an empty one. Other columns are passed through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import SPACES, let, positional, without

SIZE = 3
_TRIM = SPACES.replace("\n", "")


def _content(text: Column) -> Column:
    """Lines with something on them: their number and trimmed text."""
    lines = F.split(text, "\n", -1)
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("at"), F.btrim(line, F.lit(_TRIM)).alias("line")))
    return F.filter(numbered, lambda x: x["line"] != "")


def _window(lines: list[Column], first: Column, last: Column) -> Column:
    """Two independent 64-bit hashes of the lines, and the first and last line's number."""
    return F.struct(
        F.xxhash64(*lines).alias("h1"),
        F.xxhash64(F.lit("second"), *lines).alias("h2"),
        first.alias("a"),
        last.alias("b"),
    )


def _windows(content: Column) -> Column:
    def line(c: Column, i) -> Column:
        return F.get(c, i)["line"]

    def of(c: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(c) - SIZE),
            lambda i: _window([line(c, i + j) for j in range(SIZE)], F.get(c, i)["at"], F.get(c, i + SIZE - 1)["at"]),
        )
        short = F.array(
            _window(
                [F.size(c), *[line(c, F.lit(j)) for j in range(SIZE - 1)]], F.get(c, F.lit(0))["at"], F.get(c, F.size(c) - 1)["at"]
            )
        )
        return F.when(F.size(c) >= SIZE, each).when(F.size(c) > 0, short)

    return let(content, of)


def _long_windows(content: Column, long_words: int) -> Column:
    """Windows of one and of two lines that have at least ``long_words`` words."""
    counted = F.transform(
        content, lambda x: F.struct(x["at"], x["line"], F.size(F.split(x["line"], f"[{_TRIM}]+")).alias("words"))
    )

    def of(c: Column) -> Column:
        def starting(x: Column, i: Column) -> Column:
            then = F.get(c, i + 1)
            one = F.when(x["words"] >= long_words, _window([x["line"]], x["at"], x["at"]))
            two = F.when(x["words"] + then["words"] >= long_words, _window([x["line"], then["line"]], x["at"], then["at"]))
            return F.array_compact(F.array(one, two))

        return F.flatten(F.transform(c, starting))

    return let(counted, of)


def covered(rows: DataFrame, long_words: int | None = None) -> DataFrame:
    """For (``doc_id``, ``th``, ``text``): the stretches of lines to remove.

    Gives ``doc_id``, ``th`` and ``cuts``, an array of first and last lines in order.
    """

    def windows(content: Column) -> Column:
        if long_words is None:
            return _windows(content)
        return let(content, lambda c: F.concat(F.coalesce(_windows(c), F.array()), _long_windows(c, long_words)))

    places = rows.select("doc_id", "th", F.explode(windows(_content(F.col("text")))).alias("w"))
    places = places.select("doc_id", "th", "w.*")
    place = F.struct("doc_id", "th", "a")
    firsts = places.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    later = places.join(firsts.filter("times > 1"), ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    order = Window.partitionBy("doc_id", "th").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    stretches = later.select("doc_id", "th", "a", "b").distinct()
    stretches = stretches.withColumn("new", F.coalesce(F.col("a") > before + 1, F.lit(True)).cast("int"))
    stretches = stretches.withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = stretches.groupBy("doc_id", "th", "stretch").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return merged.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("cuts"))


def _without(text: Column, cuts: Column) -> Column:
    """The lines of ``text`` between the cuts."""

    def kept(lines: Column) -> Column:
        begins = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c.b + 1))
        ends = F.concat(F.transform(cuts, lambda c: c.a), F.array(F.size(lines)))
        gaps = F.zip_with(begins, ends, lambda b, e: F.slice(lines, b + 1, F.greatest(e - b, F.lit(0))))
        return F.array_join(F.flatten(gaps), "\n")

    return let(F.split(text, "\n", -1), kept)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    removed_col: str = "n_removed",
    long_words: int | None = None,
) -> DataFrame:
    """``docs`` with repeated passages cut from the texts, and the number of lines cut.

    One or two lines of at least ``long_words`` words count as a passage, if given.
    A column called ``removed_col`` is replaced.
    """
    docs = without(docs, removed_col)
    names, inner = docs.columns, positional(docs)
    key, text = f"_c{names.index(id_col)}", f"_c{names.index(text_col)}"
    inner = inner.withColumn("_h", F.xxhash64(text))
    cuts = covered(inner.select(F.col(key).alias("doc_id"), F.col("_h").alias("th"), F.col(text).alias("text")), long_words)
    both = inner.join(cuts, inner[key].eqNullSafe(cuts["doc_id"]) & (inner["_h"] == cuts["th"]), "left")
    removed = F.aggregate("cuts", F.lit(0).cast("bigint"), lambda n, c: n + c.b - c.a + 1)
    cleaned = F.when(F.col("cuts").isNotNull(), _without(F.col(text), F.col("cuts"))).otherwise(F.col(text))
    columns = [cleaned.alias(c) if c == text else F.col(c) for c in inner.columns[:-1]]
    return both.select(*columns, F.coalesce(removed, F.lit(0)).alias("_n")).toDF(*names, removed_col)


#: What :func:`dedup_lines` gives for ``documents`` with distinct ids, in SQL.
ORACLE = r"""
WITH lines AS (
    SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS raw
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
), content AS (
    SELECT *, row_number() OVER d AS k, count(*) OVER (PARTITION BY doc_id) AS n,
        pos AS a1, lead(pos) OVER d AS a2, lead(pos, 2) OVER d AS a3,
        line AS l1, lead(line) OVER d AS l2, lead(line, 2) OVER d AS l3
    FROM (SELECT doc_id, pos, trim(raw, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM lines)
    WHERE line <> ''
    WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), windows AS (
    SELECT doc_id, a1 AS a, CASE WHEN n >= 3 THEN a3 ELSE coalesce(a2, a1) END AS b,
        CASE WHEN n >= 3 THEN 3 ELSE n END AS size, l1, coalesce(l2, '') AS l2, coalesce(l3, '') AS l3
    FROM content WHERE (n >= 3 AND k <= n - 2) OR (n < 3 AND k = 1)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY size, l1, l2, l3 ORDER BY doc_id, a) AS place FROM windows
), cut AS (
    SELECT DISTINCT lines.doc_id, lines.pos
    FROM lines JOIN ranked ON lines.doc_id = ranked.doc_id AND lines.pos BETWEEN ranked.a AND ranked.b
    WHERE place > 1
), kept AS (
    SELECT lines.doc_id, coalesce(string_agg(raw, chr(10) ORDER BY lines.pos) FILTER (cut.pos IS NULL), '') AS text,
        count(cut.pos) AS n_removed
    FROM lines LEFT JOIN cut ON lines.doc_id = cut.doc_id AND lines.pos = cut.pos
    GROUP BY lines.doc_id
)
SELECT documents.doc_id, kept.text, coalesce(kept.n_removed, 0) AS n_removed
FROM documents LEFT JOIN kept ON documents.doc_id = kept.doc_id
"""
