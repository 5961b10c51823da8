"""Chat formatting: messages that quote each other become reply-ordered conversations.

Mail and forum messages repeat what they answer behind ``>`` marks. The marks give each line a quote
level, runs of lines of one level are passages, and a passage's normalised hash finds the message
that first said it. Messages then carry what they reply to, stand in threads, and lose the
quotes that were found. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import whole_text, with_running_sums, written

# Fixed value: the marks in front of a quoted line.
QUOTE_MARKS = r"^(?:[ \t]*>)+"
LINKED = "array<struct<text_1: bigint, text_2: bigint, first: int, last: int>>"


def quoted_lines(text: Column) -> Column:
    """The lines of a message with their quote level, 0 for its own, and what they say: without the
    marks, without blanks at the ends."""

    def line_of(line: Column) -> Column:
        marks = F.regexp_extract(line, QUOTE_MARKS, 0)
        said = F.substring(line, F.length(marks) + 1, F.length(line))
        return F.struct(
            F.length(F.regexp_replace(marks, r"[^>]", "")).alias("level"),
            F.btrim(said, F.lit(" \t\r")).alias("content"),
        )

    return F.transform(F.split(text, "\n"), line_of)


def with_passages(messages: DataFrame) -> DataFrame:
    """Messages with ``passages``: an array of (level, first, last, hash_1, hash_2).

    A passage is a run of lines of one level, none of them empty; ``first`` and ``last`` are its lines by
    number from 0. Quoted lines without content behind a passage count as its last lines. Its hash
    ignores case and white space, so a quote that was wrapped anew still matches.

    Lines and the numbers where passages begin are columns of their own, so that a line is looked up
    in an array that is there, and the work is in proportion to the text.
    """

    def line(number: Column) -> Column:
        return F.element_at("lines", number + 1)

    def begins(number: Column) -> Column:
        before = line(number - 1)
        return (line(number)["content"] != "") & (
            (number == 0) | F.when(number > 0, (before["level"] != line(number)["level"]) | (before["content"] == ""))
        )

    def ends(number: Column) -> Column:
        """Whether the line before a number is a passage's last one with content."""
        return (number > 0) & F.when(number > 0, line(number - 1)["content"] != "") & (
            F.when(number < F.size("lines"), begins(number) | (line(number)["content"] == "")).otherwise(True)
        )

    def run(first: Column, number: Column) -> Column:
        end = F.element_at("ends", number + 1)
        further = F.when(number + 1 < F.size("begins"), F.element_at("begins", number + 2))
        gap = F.slice("lines", end + 1, F.coalesce(further, F.size("lines")) - end)
        # Up to the next passage all lines are empty; the first ones may be quoted.
        own = F.array_position(F.transform(gap, lambda one: one["level"] == 0), True).cast("int")
        empty = F.when(own > 0, own - 1).otherwise(F.size(gap))
        said = F.transform(F.slice("lines", first + 1, end - first), lambda one: one["content"])
        passage = F.btrim(F.regexp_replace(F.lower(F.array_join(said, " ")), r"\s+", " "))
        return F.struct(
            line(first)["level"].alias("level"),
            first.alias("first"),
            (end + empty - 1).alias("last"),
            F.xxhash64(passage).alias("hash_1"),
            F.xxhash64(F.lit("second"), passage).alias("hash_2"),
        )

    lined = messages.withColumn("lines", quoted_lines(whole_text()))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    bounded = lined.withColumns(
        {
            "begins": F.filter(numbers, begins),
            "ends": F.filter(F.sequence(F.lit(0), F.size("lines")), ends),
        }
    )
    return bounded.withColumn("passages", F.transform("begins", run)).drop("begins", "ends")


def without_passages(text: str, lines: str, removed: str) -> Column:
    """A text without some of its lines, given as (first, last) in order; all others byte for byte."""

    def kept(number: Column) -> Column:
        start = F.when(number > 0, F.element_at(removed, number)["last"] + 1).otherwise(0)
        end = F.when(number < F.size(removed), F.element_at(removed, number + 1)["first"])
        return F.slice(lines, start + 1, F.coalesce(end, F.size(lines)) - start)

    pieces = F.transform(F.sequence(F.lit(0), F.size(removed)), kept)
    return F.when(F.size(removed) > 0, F.array_join(F.flatten(pieces), "\n")).otherwise(F.col(text))


def text_hashes() -> list[Column]:
    return [F.xxhash64(whole_text()).alias("text_1"), F.xxhash64(F.lit("text"), whole_text()).alias("text_2")]


def link_quotes(messages: DataFrame) -> DataFrame:
    """What each message replies to: conv_id, turn, n_quotes, n_linked, reply_to, linked.

    A quoted passage belongs to the first message of the conversation that has it as its own text,
    if that comes before the quote. A message replies to the one its least nested linked passage
    comes from, to the latest of several. ``reply_to`` is null where nothing is linked. ``linked`` has the
    lines of linked passages, (text_1, text_2, first, last), for the texts of the message's rows.

    The first saying of a passage is one row per passage, so the join cannot multiply rows, and a
    passage that many messages quote is only a long side of it.
    """
    # Of a plain explode Spark infers a filter, which it pushes below all that passages are made of.
    found = with_passages(messages.select("conv_id", "turn", "text", *text_hashes())).select(
        "conv_id", "turn", "text_1", "text_2", F.explode_outer("passages").alias("passage")
    )
    found = found.select("conv_id", "turn", "text_1", "text_2", "passage.*")
    own = (
        found.filter("level = 0")
        .groupBy("conv_id", "hash_1", "hash_2")
        .agg(F.min("turn").alias("said_at"))
    )
    said_at = F.col("said_at")
    place = F.when(said_at.isNotNull(), F.struct("text_1", "text_2", "first", "last"))
    quote = F.struct("level", "hash_1", "hash_2")
    return (
        found.filter("level > 0")
        .join(own, ["conv_id", "hash_1", "hash_2"], "left")
        .withColumn("said_at", F.when(said_at < F.col("turn"), said_at))
        .groupBy("conv_id", "turn")
        .agg(
            F.count_distinct(quote).alias("n_quotes"),
            F.count_distinct(F.when(said_at.isNotNull(), quote)).alias("n_linked"),
            F.min(F.when(said_at.isNotNull(), F.struct("level", (-said_at).alias("back")))).alias("nearest"),
            F.array_sort(F.collect_set(place)).alias("linked"),
        )
        .select(
            "conv_id", "turn", "n_quotes", "n_linked", (-F.col("nearest.back")).alias("reply_to"), "linked"
        )
    )


def _thread_roots(links: DataFrame) -> DataFrame:
    """For each linked message the message its chain of replies begins with: conv_id, turn,
    thread. Each round doubles the length of the chains that are through."""
    roots = written(
        links.filter("reply_to IS NOT NULL").select(
            "conv_id", "turn", F.col("reply_to").alias("thread")
        ),
        "threads",
    )
    while True:
        further = roots.select(
            F.col("conv_id").alias("its_conv"),
            F.col("turn").alias("its_turn"),
            F.col("thread").alias("its_thread"),
        )
        met = roots.join(
            further,
            (F.col("conv_id") == F.col("its_conv")) & (F.col("thread") == F.col("its_turn")),
            "left",
        )
        if met.filter("its_thread IS NOT NULL").isEmpty():
            return roots
        roots = written(
            met.select("conv_id", "turn", F.coalesce("its_thread", "thread").alias("thread")),
            "threads",
        )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Messages in reply order: conv_id, position, thread, turn, role, reply_to, n_quotes,
    n_linked, content, chat.

    A thread is a message without a linked quote and all that replies to it, directly or not; it is
    named by that message's turn. Within a conversation threads stand in the order they begin, and
    messages in a thread by turn, so a reply is always after what it replies to. ``position``
    numbers them from 0. ``content`` is the message without the quoted passages that are linked, all else
    byte for byte: indented code, blank lines, line ends, and ``>`` lines that quote nothing said
    before, such as a Markdown block quote or a ``>>>`` prompt. Quoted lines without content that follow a linked passage
    go with it. ``chat`` has the role in front of it.

    A null text is an empty message, a null role reads ``unknown``. Messages without
    conv_id or turn are kept, with null position and thread, and link to nothing. Rows with the
    same conversation and turn are one place: they share position and links, and are all returned.
    An empty table gives no rows; columns beside the four are not looked at.

    The work per message is on the row. Positions come from sums over ranges, so a conversation
    with most of all messages is spread like the others.
    """
    placed = conversations.select("conv_id", "turn", "role", "text")
    known = placed.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    links = written(link_quotes(known), "links")
    roots = _thread_roots(links)
    places = (
        known.groupBy("conv_id", "turn")
        .agg(F.count(F.lit(1)).alias("rows_here"))
        .join(links, ["conv_id", "turn"], "left")
        .join(roots, ["conv_id", "turn"], "left")
        .withColumn("thread", F.coalesce("thread", "turn"))
    )
    ordered = with_running_sums(
        places, ["thread", "turn"], {"through": "rows_here"}, within=["conv_id"]
    ).select(
        "conv_id",
        "turn",
        (F.col("through") - F.col("rows_here")).alias("position"),
        "thread",
        "reply_to",
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "linked",
    )
    own_1, own_2 = text_hashes()
    of_row = F.filter("linked", lambda one: (one["text_1"] == F.col("own_1")) & (one["text_2"] == F.col("own_2")))
    removed = F.coalesce(of_row, F.array().cast(LINKED))
    role = F.coalesce("role", F.lit("unknown"))
    return (
        placed.withColumns({"own_1": own_1, "own_2": own_2})
        .join(ordered, ["conv_id", "turn"], "left")
        .withColumns({"text": whole_text(), "removed": removed, "text_lines": F.split(whole_text(), "\n")})
        .withColumn("content", without_passages("text", "text_lines", "removed"))
        .select(
            "conv_id",
            "position",
            "thread",
            "turn",
            role.alias("role"),
            "reply_to",
            "n_quotes",
            "n_linked",
            "content",
            F.concat(F.lit("<|"), role, F.lit("|>\n"), "content", F.lit("\n")).alias("chat"),
        )
    )
