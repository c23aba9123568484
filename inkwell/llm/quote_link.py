"""Quotation linking: from messages that quote each other to reply-ordered conversations without quotes.

Quote levels are parsed from the line markers, paragraphs of one level are found inside the row, normalised and
hashed, and every quoted passage is linked to the latest earlier message of its conversation whose
own paragraph has the hash. Links follow a running maximum over (conversation, passage), never pairs, so a
passage that many messages repeat costs one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import stash

#: Turns of one conversation that are ordered together; a hot conversation is cut into spans of them.
SPAN = 1024
#: Least words of a line or sentence that links a quotation whose paragraph is not found.
LEAST_WORDS = 3
MARKS = "^(?:[ \\t]*>)+"


def parse_lines(text: Column) -> Column:
    """array<struct<level, line>>: every line without its quote marks (``>`` with optional blanks) and their number."""
    lines = F.split(F.regexp_replace(text, "\\r\\n?", "\n"), "\n")
    return F.transform(lines, lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(F.regexp_replace(x, MARKS, ""), "^[ \\t]", "").alias("line")))


def own_text(lines: Column) -> Column:
    """The lines of level 0, without blank lines at either end."""
    own = F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    return F.regexp_replace(own, "^(?:[ \\t]*\\n)+|(?:\\n[ \\t]*)+$", "")


def paragraphs(lines: Column) -> Column:
    """array<struct<run, level, lines>>: lines of one level between blank lines or lines of other levels; ``run`` numbers them.

    Normalised: white space runs are one blank, letters are lower-cased. Found inside the row, in one pass over
    its lines.
    """
    plain = F.transform(lines, lambda x: F.struct(
        x["level"].alias("level"), F.lower(F.trim(F.regexp_replace(x["line"], "\\s+", " "))).alias("line")))

    def cut(x: Column) -> Column:
        def starts(i: Column) -> Column:
            before = F.get(x, i - 1)
            return (i == 0) | (before["level"] != F.get(x, i)["level"]) | (before["line"] == "")

        def piece(at: Column, k: Column, first: Column) -> Column:
            end = F.coalesce(F.get(first, k + 1), F.size(x))
            kept = F.filter(F.transform(F.slice(x, at + 1, end - at), lambda p: p["line"]), lambda p: p != "")
            return F.struct(k.alias("run"), F.get(x, at)["level"].alias("level"), kept.alias("lines"))

        # a bound variable holds the list, so that no element computes it again
        first = F.array(F.filter(F.sequence(F.lit(0), F.size(x) - 1), starts))
        return F.get(F.transform(first, lambda f: F.transform(f, lambda at, k: piece(at, k, f))), F.lit(0))

    out = F.get(F.transform(F.array(plain), cut), F.lit(0))
    return F.filter(out, lambda p: F.size(p["lines"]) > 0)


def fragments(lines: Column) -> Column:
    """Distinct hashes of a paragraph's lines and sentences (these may cross lines); shorter ones than LEAST_WORDS are left
    out, as they stand in many messages by chance."""
    sentences = F.split(F.array_join(lines, " "), "(?<=[.!?]) ")
    long = F.filter(F.concat(lines, sentences), lambda x: F.size(F.split(x, " ")) >= LEAST_WORDS)
    return F.array_distinct(F.transform(long, digest))


def digest(text: Column) -> Column:
    """The 128-bit hash of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, row, run, level, lines) of every paragraph of ``messages`` (conv, turn, row, lines)."""
    return (messages.select("conv", "turn", "row", F.explode(paragraphs(F.col("lines"))).alias("p"))
            .select("conv", "turn", "row", "p.run", "p.level", "p.lines"))


def link_passages(parts: DataFrame) -> DataFrame:
    """(row, run, source) of the quoted ones of ``parts`` (conv, turn, row, run, level, hash): the latest earlier turn of the
    conversation that has the passage as its own; those without one are left out.

    Turns are cut into spans, and a span is given the last own turn of the spans before it. Copies of a turn's passage are
    one row before the order is made, so no conversation, passage or turn is ordered in one task.
    """
    start = F.col("turn") - F.pmod(F.col("turn"), F.lit(SPAN))
    turns = (parts.groupBy("conv", "hash", start.alias("span"), "turn")
             .agg(F.max(F.when(F.col("level") == 0, F.col("turn"))).alias("own"), F.max(F.col("level") > 0).alias("asked")))
    carry = Window.partitionBy("conv", "hash").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    before = (turns.groupBy("conv", "hash", "span").agg(F.max("own").alias("own")).withColumn("own", F.max("own").over(carry))
              .where("own IS NOT NULL")
              .select("conv", "hash", "span", (F.col("span") - 1).alias("turn"), "own", F.lit(False).alias("asked")))
    inside = Window.partitionBy("conv", "hash", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = (turns.unionByName(before).withColumn("source", F.max("own").over(inside))
             .where("asked AND source IS NOT NULL").select("conv", "hash", "turn", "source"))
    return parts.where("level > 0").join(found, ["conv", "hash", "turn"]).select("row", "run", "source")


def link_all(messages: DataFrame) -> DataFrame:
    """(row, run, level, source) of every quoted passage: linked by its paragraph, and where no paragraph of an earlier turn
    is the same, by its lines and sentences (the latest earlier turn with one of these in its own text); source may be null."""
    whole = stash(passages(messages).select("conv", "turn", "row", "run", "level", digest(F.array_join("lines", " ")).alias("hash"))
                  .dropDuplicates(["row", "run"]), "passages")
    linked = stash(whole.where("level > 0").select("conv", "row", "run", "level")
                   .join(link_passages(whole), ["row", "run"], "left"), "linked")
    lost = linked.where("source IS NULL").select("conv", "row", "run")
    if lost.isEmpty():
        return linked.drop("conv")
    # only conversations with such a passage are read again
    again = passages(messages.join(lost.select("conv").distinct(), "conv", "left_semi"))
    each = again.select("conv", "turn", "row", "run", "level", F.explode(fragments(F.col("lines"))).alias("hash"))
    each = stash(each.dropDuplicates(["row", "run", "hash"]), "parts")
    quoted = each.where("level > 0").join(lost.select("row", "run"), ["row", "run"], "left_semi")
    own = each.where("level = 0").join(quoted.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
    found = link_passages(stash(quoted.unionByName(own), "asked-parts")).groupBy("row", "run").agg(F.max("source").alias("found"))
    return (linked.join(found, ["row", "run"], "left")
            .select("row", "run", "level", F.coalesce("source", "found").alias("source")))


def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, turn, reply_to, span) in order -> (conv, turn, thread, depth, open): the first message of the chain inside the
    span and the steps to it; ``open`` where the chain leaves the span (thread is then the turn it goes on at)."""
    key, seen = None, {}
    for batch in batches:
        out = []
        for conv, turn, up, span in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (conv, span) != key:
                key, seen = (conv, span), {}
            if up is None:
                seen[turn] = (turn, 0, False)
            else:
                thread, depth, leaves = seen.get(up, (up, 0, True))
                seen[turn] = (thread, depth + 1, leaves)
            out.append(seen[turn])
        thread, depth, leaves = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(thread, pa.int64()),
                                          pa.array(depth, pa.int64()), pa.array(leaves, pa.bool_())],
                                         ["conv", "turn", "thread", "depth", "open"])


def threads(replies: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth): first message of the chain of replies and its length.

    ``replies``: (conv, turn, reply_to), a row for each turn; reply_to is an earlier turn of the table, so chains end. Chains
    are followed inside spans of SPAN turns; those that leave their span go on by pointer jumping over the table.
    """
    conv = replies.schema["conv"].dataType.simpleString()
    span = F.col("turn") - F.pmod(F.col("turn"), F.lit(SPAN))
    at = stash(replies.select("conv", "turn", "reply_to", span.alias("span")).repartition("conv", "span")
               .sortWithinPartitions("conv", "span", "turn")
               .mapInArrow(climb, f"conv {conv}, turn bigint, thread bigint, depth bigint, open boolean"), "threads")
    while not at.where("open").isEmpty():
        ends = at.where("open").select("conv", F.col("thread").alias("turn")).distinct()
        up = at.join(ends, ["conv", "turn"], "left_semi").select(
            "conv", F.col("turn").alias("thread"), F.col("thread").alias("up"), F.col("depth").alias("more"), F.col("open").alias("on"))
        moved = at.where("open").join(up, ["conv", "thread"]).select(
            "conv", "turn", F.col("up").alias("thread"), (F.col("depth") + F.col("more")).alias("depth"), F.col("on").alias("open"))
        at = stash(at.where("NOT open").unionByName(moved), "threads")
    return at.drop("open")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """(conv, turn, text, reply_to, n_quotes, n_linked, thread, depth) of every message; sorted by (conv, thread, turn) the
    rows are the reply-ordered conversations.

    A quoted passage is linked to the latest earlier turn with the same paragraph; where there is none, to the latest
    with one of its lines or sentences (of LEAST_WORDS words or more).
    ``text`` is the message without quotes; ``reply_to`` the latest turn that a level-1 passage is linked to; ``n_quotes`` and
    ``n_linked`` count passages of all levels. Null texts are empty and quote nothing. Rows with a null conversation
    or turn are kept, unlinked, their thread null. Rows that repeat a turn are messages of their own; a reply to
    the turn is a reply to all of them and the thread is that of the turn.
    """
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    # equal rows are one; a conversation's name is marked, so that none is taken for null or for another with a turn
    name = F.col("conv").cast("string")
    key = F.concat_ws("\n", F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-")),
                      F.coalesce(F.col("turn").cast("string"), F.lit("-")), "t")
    rows = rows.withColumn("row", digest(key)).withColumn("lines", parse_lines(F.col("t")))
    known = F.col("conv").isNotNull() & F.col("turn").isNotNull()
    linked = stash(link_all(rows.where(known).select("conv", "turn", "row", "lines")).groupBy("row").agg(
        F.max(F.when(F.col("level") == 1, F.col("source"))).alias("reply_to"), F.count(F.lit(1)).alias("n_quotes"),
        F.count("source").alias("n_linked")), "replies")
    # one narrow row for each message, and the texts are joined once
    ids = stash(rows.where(known).select("conv", "turn", "row").distinct().join(linked, "row", "left"), "messages")
    chains = threads(ids.groupBy("conv", "turn").agg(F.max("reply_to").alias("reply_to")))
    found = ids.join(chains, ["conv", "turn"]).select("row", "reply_to", "n_quotes", "n_linked", "thread", "depth")
    return rows.select("conv", "turn", "row", own_text(F.col("lines")).alias("text")).join(found, "row", "left").select(
        "conv", "turn", "text", "reply_to", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "thread", "depth")


def quote(text: Column) -> Column:
    """The text as a quotation: a mark before every line."""
    return F.concat(F.lit("> "), F.regexp_replace(text, "\\n", "\n> "))
