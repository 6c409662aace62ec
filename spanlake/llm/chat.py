"""Chat formatting by quotation linking, in DataFrame expressions only.

Lines that begin with ``>`` are quoted, one level per ``>``.  Quoted passages (runs of lines of one
level, and each of their lines) are normalised and hashed, and meet the passages of earlier messages
of the same conversation; the first message that has a passage is its original.  A message replies to
the original of most of its quoted characters, first at level one, else at the next level that has
an original; among equals to the latest.  Threads follow these links to their first message.  Ordered
by ``conv_id``, ``thread`` and ``turn``, every reply comes after what it replies to, and messages
without a known quotation keep their turn.

The result has one row per message, so a conversation of any length needs no single task.  A NULL
text is empty, a NULL role is written ``unknown``.  Messages without conversation or turn are linked
to nothing.  Repeated messages are all kept and share their links.  An empty table gives an empty
one.  Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import let, written

BLANKS = " \t\r\n"
MARK = r"^\s*((?:>\s*)+)"
ATTRIBUTION = r"(?i)^.{0,200}\b(wrote|schrieb|a écrit|escribió):\s*$"


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def parsed_lines(text: Column) -> Column:
    """``level`` and ``body`` of each line."""

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, MARK, 1)
        return F.struct(
            (F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).alias("level"),
            F.regexp_replace(line, MARK, "").alias("body"),
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), parse)


def passages(lines: Column) -> Column:
    """``level`` and normalised ``body`` of each run of lines of one level."""

    def add(runs: Column, line: Column) -> Column:
        last = F.element_at(runs, -1)
        joined = F.struct(
            last["level"].alias("level"), F.concat_ws(" ", last["body"], line["body"]).alias("body")
        )
        same = (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["level"] == line["level"])
        return F.when(
            same, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(joined))
        ).otherwise(F.concat(runs, F.array(line)))

    start = F.expr("CAST(array() AS array<struct<level:int,body:string>>)")
    return F.aggregate(lines, start, add)


def units(lines: Column) -> Column:
    """What is compared: the passages and their lines, normalised, each once per level."""
    whole = F.concat(passages(lines), lines)
    named = F.transform(
        whole, lambda p: F.struct(p["level"].alias("level"), normal(p["body"]).alias("body"))
    )
    return F.array_distinct(F.filter(named, lambda p: p["body"] != ""))


def own_text(lines: Column) -> Column:
    """Lines that are not quoted, without the line that announces a quotation."""
    kept = F.filter(
        F.transform(
            lines,
            lambda x, i: F.struct(
                x["body"].alias("body"),
                (
                    (x["level"] == 0)
                    & ~(
                        x["body"].rlike(ATTRIBUTION)
                        & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
                    )
                ).alias("own"),
            ),
        ),
        lambda x: x["own"],
    )
    return F.btrim(F.array_join(F.transform(kept, lambda x: x["body"]), "\n"), F.lit(BLANKS))


def reply_links(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn`` and ``parent`` of the messages whose quotations have an original."""
    named = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoting = named.where(F.col("text").rlike(r"(?m)^\s*>"))
    quoted = written(
        quoting.select(
            "conv_id", "turn", F.explode(let(parsed_lines(F.col("text")), units)).alias("u")
        )
        .where("u.level > 0")
        .selectExpr(
            "conv_id", "turn", "u.level AS level", "xxhash64(u.body) AS hash", "length(u.body) AS n"
        )
        .distinct(),
        "quoted",
    )
    talks = quoted.select("conv_id").distinct()
    originals = (
        named.join(talks, "conv_id", "left_semi")
        .select("conv_id", "turn", F.explode(let(parsed_lines(F.col("text")), units)).alias("u"))
        .where("u.level = 0")
        .groupBy("conv_id", F.xxhash64("u.body").alias("hash"))
        .agg(F.min("turn").alias("first"))
    )
    best = F.max(F.struct((-F.col("level")).alias("near"), "n", "first"))
    return (
        quoted.join(originals, ["conv_id", "hash"])
        .where("first < turn")
        .groupBy("conv_id", "turn", "level", "first")
        .agg(F.sum("n").alias("n"))
        .groupBy("conv_id", "turn")
        .agg(best.alias("best"))
        .select("conv_id", "turn", F.col("best.first").alias("parent"))
    )


def threads(links: DataFrame) -> DataFrame:
    """Links with ``thread``, the turn of the first message, and ``depth`` below it.

    Each round doubles the number of links that are followed, and is a written table.
    """
    now = written(links.selectExpr("*", "parent AS thread", "1 AS depth"), "threads")
    while True:
        above = now.selectExpr("conv_id", "turn AS thread", "thread AS up", "depth AS more")
        after = written(
            now.join(above, ["conv_id", "thread"], "left").selectExpr(
                "conv_id", "turn", "parent", "coalesce(up, thread) AS thread",
                "depth + coalesce(more, 0) AS depth", "up IS NOT NULL AS moved",
            ),
            "threads",
        )
        done = after.where("moved").isEmpty()
        now = after.drop("moved")
        if done:
            return now


def conversations(
    messages: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Messages without quotations, with what they reply to and their place in the conversation."""
    rows = messages.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    linked = threads(reply_links(rows))
    quoted = F.filter(F.col("lines"), lambda x: x["level"] > 0)
    said = rows.withColumn("lines", parsed_lines(F.col("text"))).select(
        "conv_id",
        "turn",
        "role",
        F.when(F.col("text").contains(">"), own_text(F.col("lines")))
        .otherwise(F.btrim("text", F.lit(BLANKS)))
        .alias("text"),
        F.when(F.col("text").contains(">"), F.size(quoted)).otherwise(0).cast("long").alias("n_quoted"),
    )
    return said.join(linked, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "parent",
        "role",
        "text",
        "n_quoted",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")).alias("formatted"),
    )
