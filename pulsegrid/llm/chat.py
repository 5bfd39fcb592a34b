"""Chat formatting by quotation linking.

A line's quote level is the number of `>` marks it begins with.  Runs of lines of
one level are quoted passages; each passage, each of its paragraphs (parts between
blank quoted lines) and each of its lines is normalised (lower case, single blanks)
and hashed, so a quote of some paragraphs links however its lines were broken anew.  The hashes are joined, within a
conversation, to the first message whose own words hold that passage as its whole
text, as a paragraph or as a line.  A message answers the original found at its
lowest quote level, the longest match first.  Messages linked by answers form a
thread named by its first turn; ordered by (conv_id, thread, turn), a
conversation reads in reply order, without quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.runtime import pin

# Normalised lines shorter than this are too common to link by; whole texts and passages of any length link.
LEAST_LINE = 12
QUOTED = r"(?m)^[ \t]*>"
_LINE_END = r"\r\n|\n|\r"
_MARKS = r"^[ \t]*((?:>[ \t]?)+)"


def own_words(text: Column) -> Column:
    """The text without quoted lines and without blank ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?m)^[ \t]*>.*(\r\n|\n|\r|$)", ""), r"^\s+|\s+$", "")


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def quote_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, _text, pos, level, body) of each quoted line; level counts nested marks."""
    lines = messages.select("conv_id", "turn", "_text", F.posexplode(F.split("text", _LINE_END)).alias("pos", "line"))
    marks = F.regexp_extract("line", _MARKS, 1)
    return lines.select(
        "conv_id", "turn", "_text", "pos", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.regexp_replace("line", _MARKS, "").alias("body")
    ).where("level > 0")


def passages(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, _text, passage, level, words): runs of quoted lines of one level, joined by blanks.

    The lines of one message meet in one task.
    """
    by_place = Window.partitionBy("conv_id", "turn", "_text").orderBy("pos")
    new = (F.lag("pos").over(by_place) == F.col("pos") - 1) & (F.lag("level").over(by_place) == F.col("level"))
    marked = lines.withColumn("_new", F.when(F.coalesce(new, F.lit(False)), 0).otherwise(1))
    numbered = marked.withColumn("passage", F.sum("_new").over(by_place))
    return numbered.groupBy("conv_id", "turn", "_text", "passage", "level").agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"])).alias("words")
    )


def _units(frame: DataFrame, *keep: str, long_only: str | None = None) -> DataFrame:
    unit = frame.withColumn("_norm", normalised(F.col("words"))).where(F.length("_norm") >= (LEAST_LINE if long_only else 1))
    return unit.select(*keep, F.md5("_norm").alias("hash"), F.length("_norm").alias("size"))


def _originals(messages: DataFrame) -> DataFrame:
    """(conv_id, hash, origin): the first turn whose own words hold a text, paragraph or line."""
    own = messages.select("conv_id", "turn", own_words(F.col("text")).alias("own"))
    whole = _units(own.withColumn("words", F.col("own")), "conv_id", "turn")
    part = lambda cut: own.select("conv_id", "turn", F.explode(F.split("own", cut)).alias("words"))
    paragraphs = _units(part(r"(?:\r\n|\n|\r)[ \t]*(?:\r\n|\n|\r)"), "conv_id", "turn", long_only="yes")
    lines = _units(part(_LINE_END), "conv_id", "turn", long_only="yes")
    return whole.union(paragraphs).union(lines).groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))


def answers(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, _text, reply_to, n_quotes) of each message with quotes; reply_to is null where no original is found."""
    quoting = messages.where(F.col("text").rlike(QUOTED)).dropDuplicates(["conv_id", "turn", "_text"])
    lines = quote_lines(quoting)
    runs = passages(lines)
    key = ["conv_id", "turn", "_text"]
    single = lines.select(*key, "level", F.col("body").alias("words"))
    paragraphs = passages(lines.where(normalised(F.col("body")) != ""))
    units = _units(runs, *key, "level").union(_units(paragraphs, *key, "level")).union(_units(single, *key, "level", long_only="yes"))
    talks = messages.join(quoting.select("conv_id").distinct(), "conv_id", "left_semi")
    found = units.join(_originals(talks), ["conv_id", "hash"]).where(F.col("origin") < F.col("turn"))
    best = found.groupBy(*key).agg(F.max(F.struct((-F.col("level")).alias("l"), "size", "origin")).alias("_best"))
    counted = runs.groupBy(*key).agg(F.count(F.lit(1)).alias("n_quotes"))
    return counted.join(best, key, "left").select(*key, F.col("_best.origin").alias("reply_to"), "n_quotes")


def _threads(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, thread): the first turn reached over answers, by repeatedly doubling the steps."""
    steps = pin(linked.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("up")))
    while True:
        above = steps.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("up").alias("_up"))
        after = pin(
            steps.join(above, (F.col("conv_id") == F.col("_c")) & (F.col("up") == F.col("_t")), "left")
            .select("conv_id", "turn", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("_moved"))
        )
        moved = after.where("_moved").limit(1).count()
        steps = after.select("conv_id", "turn", "up")
        if not moved:
            return steps.withColumnRenamed("up", "thread")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, reply_to, thread, n_quotes and text (own words) of every message.

    Other columns are dropped.  A null text stays null and has no quotes.  A message
    without a found original starts a thread of its own turn; so does every message
    of a null conversation or turn.  Repeated rows get equal results; of different
    messages with one turn, the thread follows the smallest turn answered.
    """
    messages = conversations.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("_text"))
    linked = pin(answers(messages))
    key = ["conv_id", "turn", "_text"]
    out = messages.join(linked, key, "left")
    followed = linked.where(F.col("reply_to").isNotNull())
    if followed.limit(1).count():
        out = out.join(_threads(followed), ["conv_id", "turn"], "left")
    else:
        out = out.withColumn("thread", F.lit(None).cast(conversations.schema["turn"].dataType))
    return out.select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), own_words(F.col("text")).alias("text"),
    )
