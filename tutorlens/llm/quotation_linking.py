"""Operator 8: chat formatting by quotation linking (native).

A line's quote level is its number of leading ``>``.  Neighbouring lines of one
level are a passage; passages and their lines are normalised, hashed and joined
to the messages of the same conversation that wrote them.  A message answers the latest earlier
message that one of its outermost linked quotes comes from, and otherwise the
turn before it.  Since every answer follows what it answers, the order by turn
within a conversation is a reply order; quotes leave the text.

Passages are cut inside the row by higher-order functions, so a text never meets
another row's.  Only conversations in which someone quotes are hashed, and the
texts are shuffled once, to meet the narrow table of what was found.

Windows never span a conversation: they work on ranges of ``SPAN`` turns, and
one row per range carries over what came before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tutorlens.llm.common import staged

#: Turns that one window sees.
SPAN = 4096
#: The quote marks of a line (one class after the first mark: nothing for a pattern to recurse on), and of a text with some.
_MARKS = r"^[ \t]*(>[> \t]*)"
_SOME = r"(?:^|\n)[ \t]*>"


def normalised(text: Column) -> Column:
    """Lower case, each run of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\n\x0B\f\r]+", " "))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def passages(text: Column) -> Column:
    """array(level, lines): the runs of lines of one quote level, in order; quote marks are taken off.

    A blank line ends a passage.
    """

    def leveled(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 1)
        content = F.regexp_replace(line, _MARKS, "")
        quoted = F.struct((F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).alias("level"), content.alias("content"))
        return F.when(F.contains(line, F.lit(">")), quoted).otherwise(F.struct(F.lit(0).alias("level"), line.alias("content")))

    def cut(lines: Column) -> Column:
        blank = lambda i: F.trim(F.element_at(lines, i)["content"]) == ""
        level = lambda i: F.element_at(lines, i)["level"]
        fresh = lambda i: F.when(i == 1, True).otherwise(blank(i) | blank(i - 1) | (level(i) != level(i - 1)))
        starts = F.filter(F.sequence(F.lit(1), F.size(lines)), fresh)

        def runs(starts: Column) -> Column:
            def run(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(starts, k + 1), F.size(lines) + 1)
                return F.struct(level(start).alias("level"), F.transform(F.slice(lines, start, end - start), lambda x: x["content"]).alias("lines"))

            return F.filter(F.transform(starts, run), lambda p: F.trim(F.get(p["lines"], F.lit(0))) != "")

        return let(starts, runs)

    return let(F.transform(F.split(text, r"\r?\n"), leveled), cut)


def _latest_before(events: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``events`` with ``before``: the largest ``value`` on a row of the same keys and an earlier turn.

    events: keys, turn, value (null on rows that only ask), distinct by keys and turn.
    """
    spans = events.withColumn("span", F.floor(F.col("turn") / SPAN))
    inner = Window.partitionBy(*keys, "span").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    each = spans.groupBy(*keys, "span").agg(F.max(value).alias("largest"))
    carried = each.select(*keys, "span", F.max("largest").over(outer).alias("carried"))
    return (
        spans.withColumn("inside", F.max(value).over(inner))
        .join(carried, [*keys, "span"])
        .withColumn("before", F.coalesce("inside", "carried"))
        .drop("span", "inside", "carried")
    )


def _places(turns: DataFrame) -> DataFrame:
    """conv_id, turn, previous, position: the turn before, and the place among the conversation's turns."""
    spans = turns.withColumn("span", F.floor(F.col("turn") / SPAN))
    inner, outer = Window.partitionBy("conv_id", "span").orderBy("turn"), Window.partitionBy("conv_id").orderBy("span")
    sizes = spans.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last"))
    sizes = sizes.select("conv_id", "span", (F.sum("n").over(outer) - F.col("n")).alias("earlier"), F.lag("last").over(outer).alias("carried"))
    placed = spans.withColumn("nth", F.row_number().over(inner)).withColumn("inside", F.lag("turn").over(inner))
    return placed.join(sizes, ["conv_id", "span"]).select(
        "conv_id", "turn", F.coalesce("inside", "carried").alias("previous"), (F.col("earlier") + F.col("nth")).alias("position")
    )


def _by_lines(several: DataFrame, lines: DataFrame, originals: DataFrame) -> DataFrame:
    """conv_id, turn, question, by_lines: the latest earlier turn that wrote every line of the quote, if any.

    several: conv_id, turn, question; lines: those of each question;
    originals: conv_id, turn, digest.  Only the turns that wrote a question's
    rarest line (fewest turns of the conversation) are asked for the others.
    """
    wrote = originals.select("conv_id", "digest", "wrote")
    writers = wrote.groupBy("conv_id", "digest").agg(F.count(F.lit(1)).alias("writers"))
    rarest = lines.join(writers, ["conv_id", "digest"]).groupBy("conv_id", "question", "needed").agg(
        F.count(F.lit(1)).alias("known"), F.min_by("digest", F.struct("writers", "digest")).alias("digest")
    )
    asked = rarest.where("known = needed").join(wrote, ["conv_id", "digest"]).select("conv_id", "question", "wrote")
    met = asked.join(lines, ["conv_id", "question"]).join(wrote, ["conv_id", "digest", "wrote"])
    met = met.groupBy("conv_id", "question", "wrote").agg(F.count(F.lit(1)).alias("met"), F.first("needed").alias("needed")).where("met = needed")
    events = met.select("conv_id", "question", F.col("wrote").alias("turn"), "wrote")
    events = events.unionByName(several.select("conv_id", "question", "turn").distinct(), allowMissingColumns=True)
    events = events.groupBy("conv_id", "question", "turn").agg(F.max("wrote").alias("wrote"))
    return _latest_before(events, ["conv_id", "question"], "wrote").select("conv_id", "question", "turn", F.col("before").alias("by_lines"))


def _messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: a null text is empty."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _key(text: Column) -> list[Column]:
    words = normalised(text)
    return [F.xxhash64(words).alias("hash"), F.sha2(words, 256).alias("digest")]


def _links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, sha, n_linked, quoted: for each quoting text of a turn, its linked quotes and the turn it answers.

    messages: conv_id, turn, text of the conversations that quote.
    """
    parts = messages.select("conv_id", "turn", F.sha2("text", 256).alias("sha"), passages(F.col("text")).alias("parts"))
    parts = staged(parts.distinct(), "chat-passages")
    joined = lambda lines: F.array_join(lines, "\n")
    # What a message wrote itself: its paragraphs, its lines, and all of it.
    own = parts.select("conv_id", "turn", F.filter("parts", lambda p: p["level"] == 0)["lines"].alias("own")).where("size(own) > 0")
    texts = F.concat(F.transform("own", joined), F.flatten("own"), F.array(joined(F.flatten("own"))))
    written = own.select("conv_id", "turn", F.explode(texts).alias("passage"))
    originals = written.select("conv_id", "turn", *_key(F.col("passage"))).distinct().withColumn("wrote", F.col("turn"))
    quotes = parts.select("conv_id", "turn", "sha", F.posexplode("parts").alias("run", "p")).where("p.level > 0")
    quotes = quotes.select("conv_id", "turn", "sha", "run", "p.level", *_key(joined(F.col("p.lines"))), F.col("p.lines").alias("lines"))
    quotes = staged(quotes, "chat-quotes")
    # Quotes of several lines, by their lines; equal ones of a conversation are one question.
    several = quotes.where("size(lines) > 1").select("conv_id", "turn", "sha", "run", F.filter(F.array_sort(F.array_distinct(F.transform("lines", normalised))), lambda x: x != "").alias("lines"))
    several = staged(several.withColumn("question", F.sha2(joined(F.col("lines")), 256)), "chat-quotes-of-lines")
    lines = several.select("conv_id", "question", F.size("lines").alias("needed"), F.explode("lines").alias("line"))
    lines = lines.select("conv_id", "question", "needed", F.xxhash64("line").alias("hash"), F.sha2("line", 256).alias("digest")).distinct()
    # Only what someone quotes in the conversation takes part.
    quoted = quotes.select("conv_id", "hash").unionAll(lines.select("conv_id", "hash")).distinct()
    originals = staged(originals.join(quoted, ["conv_id", "hash"], "left_semi"), "chat-originals")
    asked = quotes.select("conv_id", "turn", "hash", "digest").distinct()
    events = originals.unionByName(asked, allowMissingColumns=True).groupBy("conv_id", "turn", "hash", "digest").agg(F.max("wrote").alias("wrote"))
    found = _latest_before(events, ["conv_id", "hash", "digest"], "wrote").select("conv_id", "turn", "hash", "digest", "before")
    by_lines = _by_lines(several, lines, originals)
    by_lines = several.drop("lines").join(by_lines, ["conv_id", "question", "turn"]).select("conv_id", "turn", "sha", "run", "by_lines")
    linked = quotes.join(found, ["conv_id", "turn", "hash", "digest"], "left").join(by_lines, ["conv_id", "turn", "sha", "run"], "left")
    linked = linked.withColumn("before", F.greatest("before", "by_lines"))
    return linked.groupBy("conv_id", "turn", "sha").agg(
        F.count("before").alias("n_linked"),
        F.min_by(F.struct("before"), F.when(F.col("before").isNotNull(), F.struct("level", -F.col("before")))).getField("before").alias("quoted"),
    )


def link(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, reply_to, linked, n_quotes, n_linked, quote_depth, position, clean_text.

    One row for each row of ``conversations``.  reply_to is the turn that the
    message answers (null for the first); linked says that a quote told so.
    n_quotes counts the message's quoted passages, n_linked those written by an
    earlier message of the conversation (one of its paragraphs, its whole own
    text, or each quoted line as a line of its own); quote_depth is the deepest quote level.  position
    counts the conversation's turns from 1; rows that share a turn share it.
    clean_text is the message's own passages, a blank line between them, trimmed.  A null text is empty;
    rows without conv_id or turn stand alone: no reply_to, position 1.  Rows that repeat a message repeat its
    results; an empty table gives no rows; extra columns are not read.
    """
    messages = _messages(conversations)
    placed = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    # Conversations in which someone quotes; the others have nothing to link.
    quoting = staged(placed.where(F.col("text").rlike(_SOME)).select("conv_id").distinct(), "chat-quoting")
    links = staged(_links(placed.select("conv_id", "turn", "text").join(quoting, "conv_id", "left_semi")), "chat-links")
    turns = staged(placed.select("conv_id", "turn").distinct(), "chat-turns")
    # What is known of a turn, and of its quoting texts: the one narrow table that the texts meet.
    places = staged(_places(turns), "chat-places")
    plain = places.withColumn("sha", F.lit(""))
    facts = staged(plain.unionByName(places.join(links, ["conv_id", "turn"]), allowMissingColumns=True), "chat-facts")

    rows = messages.withColumn("parts", passages(F.col("text")))
    levels = F.filter(F.col("parts")["level"], lambda v: v > 0)
    paragraphs = F.transform(F.filter("parts", lambda p: p["level"] == 0)["lines"], lambda lines: F.array_join(lines, "\n"))
    rows = rows.select(
        "conv_id", "turn", "role",
        F.when(F.size(levels) > 0, F.sha2("text", 256)).otherwise("").alias("sha"),
        F.size(levels).alias("n_quotes"), F.array_max(levels).alias("quote_depth"), F.trim(F.array_join(paragraphs, "\n\n")).alias("clean_text"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return rows.join(facts, ["conv_id", "turn", "sha"], "left").select(
        "conv_id", "turn", "role",
        F.coalesce("quoted", "previous").alias("reply_to"),
        F.col("quoted").isNotNull().alias("linked"),
        zero("n_quotes"), zero("n_linked"), zero("quote_depth"),
        F.coalesce("position", F.lit(1)).cast("long").alias("position"),
        "clean_text",
    )


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, span, messages): the conversations as ordered (position, role, reply_to, text) messages.

    A conversation of more than ``SPAN`` turns comes in several rows, in the
    order of ``span``, so that no row grows without bound.
    """
    rows = link(conversations).where("conv_id IS NOT NULL AND turn IS NOT NULL")
    rows = rows.withColumn("span", F.floor((F.col("position") - 1) / SPAN))
    message = F.struct("position", "turn", "role", "reply_to", F.col("clean_text").alias("text"))
    return rows.groupBy("conv_id", "span").agg(F.array_sort(F.collect_list(message)).alias("messages"))
