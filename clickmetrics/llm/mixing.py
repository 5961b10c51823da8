"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order. A document's virtual finish time is
the number of words its source has sent when it is through, divided by the source's target, so that
every source reaches its target at time 1. All documents are sorted by finish time together, and
the mix is the front of that order up to the budget. A source may be read several times over;
each pass joins the end of its queue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.llm.common import (
    WORD,
    fields,
    row_hash,
    whole_text,
    with_running_sums,
    word_count,
    words_counted,
    written,
)

# Weights by a source's place in code point order, and the most passes.
WEIGHTS = (5, 2, 1)
PASSES = 3
TIME_STEPS = 65_536


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES
) -> DataFrame:
    """Targets of (source, source_size): the whole size shared by weight, no target above
    ``passes`` times its source, the excess shared again by weight among the others.

    Sources take the weights in turn, in code point order, null last. Sorted by how soon their
    cap is reached, the capped sources come first; the level of the rest is what remains, by weight.
    The windows run over one row per source. All sums are of integers, so reruns agree.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    soonest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = soonest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest_of_size = F.sum("source_size").over(everything) - F.coalesce(
        F.sum("cap").over(earlier), F.lit(0)
    )
    rest_of_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0)
    )
    return (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * passes)
        .withColumn("level", rest_of_size / rest_of_weight)
        .withColumn(
            "level",
            F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(
                everything
            ),
        )
        .select(
            "source",
            "source_size",
            F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def shuffle_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    passes: int = PASSES,
    seed: int = 1,
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, row_hash.

    A size is the number of words of the whole text; null and empty texts have size 0 and are
    not taken, since there is nothing to take. ``copies`` says how often the mix holds the document
    and ``taken`` is copies times size. Sources that are null form a source of their own, an empty
    table gives no rows. Whole documents are taken, so a source misses its target by less than one
    document, and the mix its budget likewise. Documents with one doc_id shuffle alike;
    repeated rows each have their own place in the queue. Other columns are not looked at.

    Only narrow rows are shuffled, and running sums are built by range, so a source with most of
    the rows is spread like any other. The sum over time steps is one small row per step.
    """
    sized = written(
        docs.select(
            F.col("doc_id"),
            F.col("source"),
            words_counted(text).alias("size"),
            shuffle_key(F.col("doc_id"), seed).alias("shuffle_key"),
            row_hash(docs).alias("row_hash"),
        ),
        "mix-sizes",
    )
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, passes
    )
    queued = with_running_sums(
        sized, ["shuffle_key", "doc_id", "size", "row_hash"], {"sent": "size"}, within=["source"]
    )
    named = targets.withColumnRenamed("source", "source_of_target")
    timed = (
        queued.join(named, F.col("source").eqNullSafe(F.col("source_of_target")))
        .select("doc_id", "source", "size", "source_size", "target", "shuffle_key", "row_hash", "sent")
        .withColumn("row_no", F.monotonically_increasing_id())
    )
    timed = written(timed, "mix-times")
    taken = _front(timed, passes)
    return (
        timed.join(taken, "row_no", "left")
        .withColumn("copies", F.coalesce("copies", F.lit(0)))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).cast("long").alias("taken"),
            "row_hash",
        )
    )


def _front(timed: DataFrame, passes: int) -> DataFrame:
    """Row number and copies of what lies within the budget, by finish time of each pass.

    Everything that finishes by time 1 is within the budget, as no source is past its target
    then. What follows is cut where the running sum of sizes passes the budget: found by the sums of
    equal steps of time first, then by order inside the one step where it happens. That
    step's rows are few: each source has at most a step's share of its target in it, and a document.
    """
    finish = (F.col("pass") * F.col("source_size") + F.col("sent")) / F.col("target")
    sent = (
        timed.filter("size > 0 AND target > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
        .select("row_no", "doc_id", "source", "size", "pass", "shuffle_key", "row_hash", finish.alias("finish"))
        .withColumn("step", _time_step(F.col("finish")))
    )
    budget = timed.agg(F.sum("size").alias("all_words"))
    by_step = sent.groupBy("step").agg(F.sum("size").alias("words"))
    steps = by_step.select(
        "step",
        "words",
        F.sum("words").over(Window.orderBy("step")).alias("words_through"),
    )
    placed = sent.join(steps.withColumnRenamed("step", "its_step"), F.col("step") == F.col("its_step"))
    limit = budget.scalar()
    sure = placed.filter(F.col("words_through") <= limit).select("row_no", "pass")
    in_order = Window.partitionBy("step").orderBy(
        "finish", "source", "pass", "shuffle_key", "doc_id", "size", "row_hash"
    )
    last = (
        placed.filter(
            (F.col("words_through") > limit) & (F.col("words_through") - F.col("words") < limit)
        )
        .withColumn("through", F.col("words_through") - F.col("words") + F.sum("size").over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .filter(F.col("through") <= limit)
        .select("row_no", "pass")
    )
    return sure.union(last).groupBy("row_no").agg(F.count(F.lit(1)).alias("copies"))


def _time_step(finish: Column) -> Column:
    """The number of a step of time, equal steps up to time 2 and longer and longer ones after."""
    later = 2 * TIME_STEPS + F.floor(F.log2(finish) * 64)
    return F.when(finish < 2, F.floor(finish * TIME_STEPS)).otherwise(later)


def mix_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    passes: int = PASSES,
    seed: int = 1,
    text: str = "text",
) -> DataFrame:
    """The mix itself: the documents' rows with all their columns, each as often as taken. Columns
    stay as they are, whatever their names and types; rows that are equal in full are interchangeable.

    In each pass over a source the mix takes the rows up to some place in the shuffled order.
    Documents meet that place, a small row per source and pass, and compare their own with it,
    so that no text is moved for a plan of its own, and they are read once for it. Words and hashes
    are looked at only where the shuffled order alone does not decide. Where the cut falls among rows
    equal in full, these few are counted off.
    """
    plan = written(_taken_places(docs, weights, passes, seed, text), "mix-places")
    of_pass = F.struct("pass", "last", "equal_taken")
    lasts = plan.groupBy("source").agg(F.collect_list(of_pass).alias("passes"))
    lasts = lasts.select(F.struct("*").alias("plan"))
    rows = docs.filter(F.regexp_like(whole_text(text), F.lit(WORD))).select(
        F.struct("*").alias("document"), shuffle_key(F.col("doc_id"), seed).alias("shuffle_key")
    )
    of_source = F.col("document").getField("source").eqNullSafe(F.col("plan.source"))
    met = rows.join(lasts, of_source)
    document = F.col("document")
    own = F.struct(
        "shuffle_key",
        document.getField("doc_id").alias("doc_id"),
        word_count(document.getField(text)).alias("size"),
        row_hash(docs, of="document").alias("row_hash"),
    )
    key = F.col("shuffle_key")

    def passes_where(test) -> Column:
        return F.filter("plan.passes", lambda one: test(one["last"]))

    def before(last: Column) -> Column:
        return (key < last["shuffle_key"]) | ((key == last["shuffle_key"]) & (own < last))

    def at(last: Column) -> Column:
        return (key == last["shuffle_key"]) & (own == last)

    if plan.filter("equal_taken < equal_rows").isEmpty():
        copies = F.size(passes_where(lambda last: before(last) | at(last)))
        taken = met.select("document", copies.alias("copies")).filter("copies > 0")
    else:
        below = F.size(passes_where(before))
        sure = met.select("document", below.alias("copies")).filter("copies > 0")
        edge = met.select("document", F.explode(passes_where(at)).alias("at"))
        alike = Window.partitionBy("at.pass", "at.last").orderBy("at.pass")
        edge = edge.withColumn("number", F.row_number().over(alike)).filter("number <= at.equal_taken")
        taken = sure.unionByName(edge.select("document", F.lit(1).alias("copies")))
    each = taken.select("document", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return each.select(*fields("document", docs.columns))


def _taken_places(
    docs: DataFrame, weights: Sequence[int], passes: int, seed: int, text: str
) -> DataFrame:
    """For each source and pass the place of the last row taken, how many rows are equal to it, and
    how many of them are taken."""
    place = F.struct(
        shuffle_key(F.col("doc_id"), seed).alias("shuffle_key"), "doc_id", "size", "row_hash"
    )
    plan = mix_plan(docs, weights, passes, seed, text).select("source", place.alias("place"), "copies")
    plan = written(plan, "mix-plan")
    passed = plan.filter("copies > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    lasts = passed.groupBy("source", "pass").agg(F.max("place").alias("last"))
    lasts = written(lasts, "mix-lasts").select(F.struct("*").alias("its"))
    same = F.col("source").eqNullSafe(F.col("its.source")) & (F.col("place") == F.col("its.last"))
    return (
        plan.join(lasts, same)
        .groupBy("its.source", "its.pass", "its.last")
        .agg(
            F.count_if(F.col("copies") >= F.col("its.pass")).alias("equal_taken"),
            F.count(F.lit(1)).alias("equal_rows"),
        )
    )
