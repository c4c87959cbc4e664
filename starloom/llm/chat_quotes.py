"""Conversations from messages that quote each other.

A message has lines of its own and lines that it quotes, marked with one ``>`` for
each level. Consecutive lines of one level are a *passage*. Passages are normalised
(marks, spaces and case do not count, nor do lines that only say who wrote) and
hashed, whole and line by line, and joined to the message that wrote the same first:
in the same thread, and anywhere. The message that explains most quoted words of the
first level is what is replied to; among equals one of the same thread, then the
earliest. Deeper levels name earlier ancestors and are used where the first level
finds nothing.

Replies then form trees. Every message finds its root and its depth by jumping over
its ancestors in doubled steps, so a chain of a thousand replies takes ten rounds.
The result has a row for each message, without quotes, in reply order.

Only DataFrame functions are used. A passage that many messages wrote is reduced to
one candidate for each thread and one for all, so common greetings make no pairs;
passages of fewer than ``least_words`` words are looked for in the same thread only;
conversations are never gathered in one place. What is joined are hashes; texts are cut
once, when the result is put together.

A message's own text is kept line by line as it stands, empty lines too, without quoted
lines and without a line that only says who wrote if a quote follows it. What was taken
out is in the column ``quoted``, since lines that begin with ``>`` need not be quotes.

Defined results: NULL and empty bodies quote nothing and are roots of their own; so
are messages whose quotes nobody wrote. A message never replies to itself or to a
later one. A message id with several bodies gives a row for each, told apart by
``variant``, a hash of the body; rows that repeat id and body are one, with the least
thread, time and role. Messages without an id are dropped, since nothing can refer to
them. A lone carriage return ends a line and becomes a line feed. An empty table gives
an empty one; extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import SPACES, let, only
from starloom.storage import materialize

MARKS = r"^[ \t]*((?:>[ \t]*)+)"
#: Lines such as "On Monday A wrote:" in front of a quote.
ATTRIBUTION = r"(?i)^(on\b.{0,200}\bwrote|am\b.{0,200}\bschrieb.{0,100}|le\b.{0,200}\ba écrit|el\b.{0,200}\bescribió)\s*:$"
#: Quoted pieces of fewer words prove nothing outside their thread.
LEAST_WORDS = 3


def lines_of(body: Column) -> Column:
    """Each line as it stands, its quote level, whether it has content, and whether it is ``own`` text.

    A line that says who wrote belongs to the quote if the next line with content is
    quoted deeper.
    """

    def line(raw: Column) -> Column:
        quoted = raw.rlike(r"^[ \t]*>")
        plain = F.when(quoted, F.regexp_replace(raw, MARKS, "")).otherwise(raw)
        marks = F.char_length(F.regexp_replace(F.regexp_extract(raw, MARKS, 1), "[^>]", ""))
        return F.struct(raw.alias("raw"), F.when(quoted, marks).otherwise(0).alias("level"), plain.alias("plain"))

    def judged(lines: Column) -> Column:
        def of(x: Column, at: Column) -> Column:
            shown = F.btrim(x["plain"], F.lit(SPACES))
            rest = F.slice(lines, at + 2, F.size(lines))
            after = F.try_element_at(F.filter(rest, lambda y: y["plain"].rlike(r"\S")), F.lit(1))
            says = shown.rlike(ATTRIBUTION) & F.coalesce(after["level"] > x["level"], F.lit(False))
            return F.struct(
                x["raw"].alias("raw"),
                x["level"].alias("level"),
                ((shown != "") & ~says).alias("content"),
                ((x["level"] == 0) & ~says).alias("own"),
                x["plain"].alias("plain"),
            )

        return F.transform(lines, of)

    raw = F.split(F.coalesce(body, F.lit("")), "\n|\r(?!\n)", -1)
    return let(F.transform(raw, line), judged)


def _normal(lines: Column) -> Column:
    """Lines with content in the form in which they are compared."""
    return F.transform(
        F.filter(lines, lambda x: x["content"]),
        lambda x: F.struct(
            x["level"].alias("level"), F.lower(F.btrim(F.regexp_replace(x["plain"], r"\s+", " "))).alias("normal")
        ),
    )


def _passages(lines: Column) -> Column:
    """Runs of lines of one level: (level, lines), where the level changes."""
    empty = F.array().cast("array<struct<level:int,lines:array<string>>>")

    def add(done: Column, line: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        alone = F.struct(line["level"].alias("level"), F.array(line["normal"]).alias("lines"))
        longer = F.struct(
            last["level"].alias("level"), F.concat(last["lines"], F.array(line["normal"])).alias("lines")
        )
        same = F.coalesce(last["level"] == line["level"], F.lit(False))
        return F.when(
            same, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        ).otherwise(F.concat(done, F.array(alone)))

    return F.aggregate(lines, empty, add)


def _piece(text: Column, level: Column) -> Column:
    words = F.size(F.split(text, " "))
    return F.struct(
        level.alias("level"),
        words.alias("words"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit("second"), text).alias("h2"),
    )


def _pieces(passages: Column) -> Column:
    """Hashes of each passage as a whole and of its lines."""

    def of(p: Column) -> Column:
        whole = F.array(_piece(F.array_join(p["lines"], " "), p["level"]))
        each = F.transform(p["lines"], lambda line: _piece(line, p["level"]))
        return F.when(F.size(p["lines"]) > 1, F.concat(whole, each)).otherwise(whole)

    return F.flatten(F.transform(passages, of))


def parse(body: Column) -> Column:
    """The hashed ``pieces`` of a message with their levels, and its ``whole`` own text as one passage.

    The latter is for quotes that leave out answers in between.
    """

    def hashed(lines: Column) -> Column:
        own = F.filter(lines, lambda x: x["level"] == 0)
        text = F.array_join(F.transform(own, lambda x: x["normal"]), " ")
        return F.struct(
            _pieces(_passages(lines)).alias("pieces"),
            let(text, lambda t: F.when(t != "", _piece(t, F.lit(0)))).alias("whole"),
        )

    return let(_normal(lines_of(body)), hashed)


def link(parsed: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(``id``, ``parent``) for messages whose quotes some earlier message wrote; ids are (id, variant)."""
    own = F.array_union(
        F.filter("pieces", lambda x: x["level"] == 0), F.filter(F.array("whole"), lambda x: x.isNotNull())
    )
    written = parsed.select("id", "thread", "sent", F.explode(own).alias("p"))
    written = written.select("id", "thread", "sent", "p.words", "p.h1", "p.h2").distinct()
    quoted = parsed.select("id", "thread", "sent", F.explode(F.filter("pieces", lambda x: x["level"] > 0)).alias("p"))
    quoted = materialize(quoted.select("id", "thread", "sent", "p.*"), "quoted")

    # One candidate for each passage and thread, and one for each passage: who wrote it first.
    writer = F.min(F.struct("sent", "id")).alias("w")
    here = quoted.join(written.groupBy("h1", "h2", "thread").agg(writer), ["h1", "h2", "thread"])
    telling = F.col("words") >= least_words
    elsewhere = quoted.filter(telling).join(written.filter(telling).groupBy("h1", "h2").agg(writer), ["h1", "h2"])
    earlier = (F.struct("w.sent", "w.id") < F.struct("sent", "id")) & (F.col("w.id.id") != F.col("id.id"))
    columns = ["id", "level", "words", F.col("w.id").alias("parent"), F.col("w.sent").alias("at")]
    here = here.filter(earlier).select(*columns, F.lit(1).alias("same"))
    elsewhere = elsewhere.filter(earlier).select(*columns, F.lit(0).alias("same"))

    # The shallowest level that found anybody decides, then the words explained, the thread, the time.
    votes = here.union(elsewhere).groupBy("id", "level", "parent", "same", "at").agg(F.sum("words").alias("words"))
    order = F.struct("level", (-F.col("words")).alias("words"), (-F.col("same")).alias("same"), "at", "parent")
    return votes.groupBy("id").agg(F.min(order).alias("best")).select("id", "best.parent")


def trees(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(``id``, ``parent``, ``root``, ``depth``): ancestors are jumped over in doubled steps."""
    state = ids.join(links, "id", "left").select(
        "id",
        "parent",
        F.coalesce("parent", "id").alias("jump"),
        F.col("parent").isNotNull().cast("bigint").alias("depth"),
        F.col("parent").isNull().alias("done"),
    )
    state = materialize(state, "replies")
    finished, moving = [state.filter("done")], state.filter("not done")
    while not moving.isEmpty():
        # A message that has reached a root needs no more steps and is not written again.
        known = reduce(DataFrame.union, finished, moving).filter("parent is not null")
        above = known.select(
            F.col("id").alias("jump"), F.col("jump").alias("next"), F.col("depth").alias("more"), F.col("done").alias("last")
        )
        stepped = moving.join(above, "jump", "left").select(
            "id",
            "parent",
            F.coalesce("next", "jump").alias("jump"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("last", F.lit(True)).alias("done"),
        )
        stepped = materialize(stepped, "replies")
        finished.append(stepped.filter("done"))
        moving = stepped.filter("not done")
    return reduce(DataFrame.union, finished).select("id", "parent", F.col("jump").alias("root"), "depth")


def conversations(
    messages: DataFrame,
    id_col: str = "id",
    thread_col: str = "thread",
    sent_col: str = "sent",
    role_col: str = "role",
    body_col: str = "body",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per message and body: ``root``, ``depth``, ``id``, ``variant``, ``parent``, ``role``, ``text``, ``quoted``.

    ``text`` is without quotes, ``quoted`` has the lines taken out, NULL if there are none.
    Ordered by root, depth and id the rows are conversations in reply order. ``sent``
    is a number or time that grows; ids are of one type that can be ordered.
    """
    rows = only(messages, id=id_col, thread=thread_col, sent=sent_col, role=role_col, body=body_col)
    rows = rows.filter("id is not null")
    key = F.struct("id", F.xxhash64(F.coalesce("body", F.lit(""))).alias("variant"))
    parsed = rows.select(key.alias("id"), "thread", "sent", "role", parse(F.col("body")).alias("p"))
    one = F.min(F.struct("thread", "sent", "role", "p.pieces", "p.whole")).alias("m")
    parsed = materialize(parsed.groupBy("id").agg(one, F.count("*").alias("rows")).select("id", "m.*", "rows"), "messages")
    found = trees(parsed.select("id"), link(parsed, least_words))
    texts = rows.select(key.alias("id"), "body")
    if not parsed.filter("rows > 1").isEmpty():
        texts = texts.dropDuplicates(["id"])
    found = found.join(parsed.select("id", "thread", "role"), "id").join(texts, "id")
    lines = found.withColumn("lines", lines_of(F.col("body")))

    def put_together(own: bool) -> Column:
        chosen = F.filter("lines", lambda x: x["own"] == F.lit(own))
        text = F.array_join(F.transform(chosen, lambda x: x["raw"]), "\n")
        return text if own else F.when(F.size(chosen) > 0, text)

    return lines.select(
        F.col("root.id").alias("root"),
        "depth",
        F.col("id.id").alias("id"),
        F.col("id.variant").alias("variant"),
        F.col("parent.id").alias("parent"),
        "thread",
        "role",
        put_together(True).alias("text"),
        put_together(False).alias("quoted"),
    )


def as_mail(turns: DataFrame, levels: int = 2) -> DataFrame:
    """Mail from chat turns: each turn quotes the ``levels`` turns before it, nested.

    Gives ``id``, ``thread``, ``sent``, ``role`` and ``body`` from ``conv_id``, ``turn``,
    ``role`` and ``text``. Earlier turns are found by joining on their numbers.
    """
    rows = only(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.filter("conv_id is not null and turn is not null")
    out = rows.withColumn("body", F.coalesce("text", F.lit("")))
    texts = rows.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    for level in range(1, levels + 1):
        earlier = texts.select("conv_id", (F.col("turn") + level).alias("turn"), F.col("text").alias("earlier"))
        out = out.join(earlier, ["conv_id", "turn"], "left")
        marked = F.regexp_replace("earlier", "(?m)^", ">" * level + " ")
        out = out.withColumn("body", F.concat_ws("\n", "body", marked)).drop("earlier")
    return out.select(
        F.struct("conv_id", "turn").alias("id"),
        F.col("conv_id").alias("thread"),
        F.col("turn").alias("sent"),
        "role",
        "body",
    )
