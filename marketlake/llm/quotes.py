"""Chat formatting by quotation linking, in DataFrame operations only.

Messages are split into lines; the marks at a line's start give its quote level. Runs of lines of
one level are passages. Passages and their single lines are normalised and hashed, and a quoted
hash is joined to the latest earlier message of the conversation that has it unquoted. The message
with the most quoted characters at the first level is the one replied to. Replies form trees, which
order the conversation; the messages are returned without their quotes.

Scale: what is shuffled for linking are hashes, not texts, and only hashes that are quoted somewhere.
The latest earlier message is found in two levels, by chunks of turns, so a conversation or a
passage that holds a third of all rows is not gathered in one task. Depths come from doubling, a few
rounds of a join of links; the final order is a range sort, which splits long conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ascii_lower, pack, stored, text_or_empty, unpack
from marketlake.operators.periods import running_max_by_chunk

# A quote mark with what may stand before it; one is taken off per level.
MARKS = r"^(?:[ \t]*>)+ ?"
# A line that names the writer of the quotation after it, normalised.
ATTRIBUTION = r"(wrote|writes|said|says|schrieb|escribió|a écrit) ?:$"
# Turns of one chunk when the latest earlier message is looked for.
CHUNK = 1024


def quote_level(line: Column) -> Column:
    """How many quote marks begin a line: "> > text" and ">>text" are level 2."""
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normalised(text: Column) -> Column:
    """For comparison: A-Z in lower case, white space runs as one space, ends trimmed."""
    return F.trim(F.regexp_replace(ascii_lower(text), r"[\x20\x09-\x0D]+", " "))


def levelled_lines(text: Column) -> Column:
    """The lines of a text as an array of (level, text), quote marks taken off."""
    return F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(
            quote_level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("text")
        ),
    )


def spans(lines: Column) -> Column:
    """The runs of lines of one level without an empty one, as (first, last) places.

    `lines` is an array of (level, normalised text); the work is linear in its size.
    """
    places = F.sequence(F.lit(0), F.size(lines) - 1)

    def edge(i: Column, neighbour: Column) -> Column:
        other = F.get(lines, neighbour)
        apart = other.isNull() | (other["level"] != lines[i]["level"]) | (other["text"] == "")
        return (lines[i]["text"] != "") & apart

    begins = F.filter(places, lambda i: edge(i, i - 1))
    ends = F.filter(places, lambda i: edge(i, i + 1))
    return F.zip_with(
        begins, ends, lambda i, j: F.struct(i.alias("first"), j.alias("last"))
    )


def passage_text(lines: Column, span: Column) -> Column:
    """The lines of a span, joined by a space."""
    run = F.slice(lines, span["first"] + 1, span["last"] - span["first"] + 1)
    return F.array_join(F.transform(run, lambda x: x["text"]), " ")


def passages(lines: Column) -> Column:
    """The spans as (level, text)."""
    return F.transform(
        spans(lines),
        lambda s: F.struct(
            lines[s["first"]]["level"].alias("level"), passage_text(lines, s).alias("text")
        ),
    )


def parted(lines: Column, found: Column) -> Column:
    """(own, unlinked) of a message: its own lines, and quoted ones that are not linked, in order.

    `lines` is an array of (level, text), `found` the hashes of its linked units. A quoted line is
    linked if its passage is, or itself. Of the own lines an attribution ("... wrote:") goes if a
    linked quotation follows it.
    """
    cleaned = F.transform(
        lines,
        lambda x: F.struct(
            x["level"].alias("level"), normalised(x["text"]).alias("text"), x["text"].alias("raw")
        ),
    )

    def is_found(text: Column) -> Column:
        return F.array_contains(found, F.xxhash64(text))

    def of(clean: Column) -> Column:
        quoted = F.filter(spans(clean), lambda s: clean[s["first"]]["level"] > 0)
        judged = F.transform(
            quoted,
            lambda s: F.struct(
                s["first"].alias("first"),
                F.when(is_found(passage_text(clean, s)), F.array().cast("array<string>"))
                .otherwise(
                    F.transform(
                        F.filter(
                            F.slice(clean, s["first"] + 1, s["last"] - s["first"] + 1),
                            lambda x: ~is_found(x["text"]),
                        ),
                        lambda x: x["raw"],
                    )
                )
                .alias("left"),
                (s["last"] - s["first"] + 1).alias("n"),
            ),
        )
        return F.transform(
            F.array(judged),
            lambda spans_: F.struct(
                F.flatten(spans_["left"]).alias("unlinked"),
                F.transform(
                    F.filter(spans_, lambda s: F.size(s["left"]) < s["n"]), lambda s: s["first"]
                ).alias("starts"),
            ),
        )[0]

    # One-element arrays bind what is used more than once.
    return F.transform(
        F.array(cleaned),
        lambda clean: F.transform(
            F.array(of(clean)),
            lambda told: F.struct(
                F.transform(
                    F.filter(
                        clean,
                        lambda x, i: (x["level"] == 0)
                        & ~(x["text"].rlike(ATTRIBUTION) & F.array_contains(told["starts"], i + 1)),
                    ),
                    lambda x: x["raw"],
                ).alias("own"),
                told["unlinked"].alias("unlinked"),
            ),
        )[0],
    )[0]


def units(messages: DataFrame) -> DataFrame:
    """_conv, _turn, level, hash, chars: every passage and every line of the messages.

    `messages` has _conv, _turn and _lines (`levelled_lines`). The lines of a passage are joined by
    a space, so that other line breaks in a quotation do not matter. Empty lines are no units.
    """
    cleaned = F.transform(
        "_lines",
        lambda x: F.struct(x["level"].alias("level"), normalised(x["text"]).alias("text")),
    )
    # The one-element array binds the cleaned lines, so that they are made once per message.
    both = F.transform(F.array(cleaned), lambda x: F.concat(x, passages(x)))[0]
    return (
        messages.select("_conv", "_turn", F.explode(both).alias("_unit"))
        .filter(F.col("_unit.text") != "")
        .select(
            "_conv",
            "_turn",
            F.col("_unit.level").alias("level"),
            F.xxhash64("_unit.text").alias("hash"),
            F.length("_unit.text").alias("chars"),
        )
        .distinct()
    )


def link_quotes(found: DataFrame) -> DataFrame:
    """_conv, _turn, level, source, chars, hash: each quoted unit with the message it is from.

    The source is the latest earlier message that has the unit unquoted. A unit without one is left
    out.
    """
    quoted = found.filter(F.col("level") > 0).filter(F.col("_turn").isNotNull())
    wanted = quoted.select("_conv", "hash").distinct()
    own = found.filter((F.col("level") == 0) & F.col("_turn").isNotNull()).join(
        wanted, ["_conv", "hash"], "left_semi"
    )
    turns = (
        quoted.select("_conv", "hash", "_turn", F.lit(None).cast("bigint").alias("_own"))
        .union(own.select("_conv", "hash", "_turn", F.col("_turn").cast("bigint")))
        .groupBy("_conv", "hash", "_turn")
        .agg(F.max("_own").alias("_own"))
        .withColumn("_chunk", F.floor(F.col("_turn") / CHUNK))
    )
    latest = running_max_by_chunk(
        turns, ["_conv", "hash"], "_chunk", [F.col("_turn")], "_own", "source"
    ).select("_conv", "hash", "_turn", "source")
    return (
        quoted.join(latest, ["_conv", "hash", "_turn"])
        .filter(F.col("source").isNotNull())
        .select("_conv", "_turn", "level", "source", "chars", "hash")
    )


def parents(links: DataFrame) -> DataFrame:
    """_conv, _turn, parent, n_linked, hashes (of the linked units): the message each replies to.

    The shallowest level that has links counts; of its sources the one with the most quoted
    characters, and of equal ones the latest.
    """
    by_source = links.groupBy("_conv", "_turn", "level", "source").agg(
        F.sum("chars").alias("chars"),
        F.count("*").alias("n"),
        F.collect_set("hash").alias("hashes"),
    )
    best = F.max_by("source", F.struct(-F.col("level"), F.col("chars"), F.col("source")))
    return by_source.groupBy("_conv", "_turn").agg(
        best.alias("parent"),
        F.sum("n").alias("n_linked"),
        F.flatten(F.collect_list("hashes")).alias("hashes"),
    )


def threads(links: DataFrame) -> DataFrame:
    """_conv, _turn, thread, depth of each message with a parent, by doubling.

    `links` has _conv, _turn, parent; a parent is an earlier turn, so there are no circles.
    """
    state = stored(
        links.select("_conv", "_turn", F.col("parent").alias("thread"), F.lit(1).alias("depth"))
    )
    while not state.isEmpty():
        above = state.select(
            F.col("_conv").alias("_c"), F.col("_turn").alias("_t"),
            F.col("thread").alias("_up"), F.col("depth").alias("_more"),
        )
        raised = stored(
            state.join(
                above, (F.col("_conv") == F.col("_c")) & (F.col("thread") == F.col("_t")), "left"
            ).select(
                "_conv", "_turn",
                F.coalesce("_up", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
                F.col("_up").isNotNull().alias("_rose"),
            )
        )
        state = raised.drop("_rose")
        if raised.filter("_rose").isEmpty():
            break
    return state


def link_conversations(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    text_col: str = "text",
) -> DataFrame:
    """The messages without quotes, in reply order.

    All columns, the text without quoted lines and without white space at its ends, and `parent`
    (turn replied to, null for the first of a thread), `thread` (turn of that first message),
    `depth` (replies up to it), `n_quoted` (quoted lines), `n_linked` (quoted passages and lines
    found in earlier messages) and `unlinked`: the quoted lines that are from no earlier message,
    without their marks, so that nothing a message says is lost. A line that names the writer goes
    with a linked quotation right after it. Rows are sorted by conversation, thread, depth and turn, so every
    message stands after the one it replies to.

    Null texts stay null and quote nothing; empty texts stay empty. A message without conversation
    or turn is not linked; its thread is its turn. Rows that share a conversation and turn are one
    message: their quotes count together and each row is returned. Two turns are compared as long
    integers. A result column replaces one of its name; other columns pass through. Empty table: no
    rows.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`").cast("bigint")
    text = text_or_empty(text_col)
    split = messages.select(
        conv.alias("_conv"), turn.alias("_turn"), levelled_lines(text).alias("_lines"),
    )
    found = stored(units(split.filter(F.col("_conv").isNotNull())))
    replies = stored(parents(link_quotes(found)))
    trees = threads(replies)
    placed = replies.join(trees, ["_conv", "_turn"]).select(
        F.col("_conv").alias("_c"), F.col("_turn").alias("_t"),
        "parent", "thread", "depth", "n_linked", "hashes",
    )
    rows = messages.select(
        pack(messages), conv.alias("_conv"), turn.alias("_turn"),
        levelled_lines(text).alias("_lines"),
    )
    joined = rows.join(
        placed, (F.col("_conv") == F.col("_c")) & (F.col("_turn") == F.col("_t")), "left"
    )
    hashes = F.coalesce("hashes", F.array().cast("array<bigint>"))
    joined = joined.withColumn(
        "_parted",
        F.when(
            F.exists("_lines", lambda x: x["level"] > 0), parted(F.col("_lines"), hashes)
        ),
    )
    plain = F.btrim(F.array_join("_parted.own", "\n"), F.lit(" \t\n\x0b\f\r"))
    n_quoted = F.size(F.filter("_lines", lambda x: x["level"] > 0))
    packed_text = F.col("_row").getField(text_col)
    result = unpack(
        joined,
        messages.columns,
        **{
            text_col: F.when(packed_text.isNull() | (n_quoted == 0), packed_text).otherwise(plain),
            "parent": F.col("parent"),
            "thread": F.coalesce("thread", "_turn"),
            "depth": F.coalesce("depth", F.lit(0)).cast("bigint"),
            "n_quoted": n_quoted.cast("bigint"),
            "n_linked": F.coalesce("n_linked", F.lit(0)).cast("bigint"),
            "unlinked": F.coalesce("_parted.unlinked", F.array().cast("array<string>")),
        },
    )
    return result.orderBy(f"`{conv_col}`", "thread", "depth", f"`{turn_col}`")
