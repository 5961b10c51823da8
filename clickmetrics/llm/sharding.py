"""Sharding by minimax contiguous partition.

Documents with equal texts are one group, which no cut may split. Groups stand in a fixed order; the
smallest capacity is searched for which a greedy pass over the order fills no more than the wanted
number of shards, and the cuts of that pass are the shards. No partition of this order into
as many pieces has a smaller largest piece.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import text_key, whole_text, with_running_sums, written

SHARDS = 16
#: Bytes on either side of a looked-up place whose group ends are fetched with it. A group has a
#: byte at least, and equal texts are one group, so this bounds the 16 bytes a group the driver holds.
WINDOW = 1 << 20


@dataclass
class GroupEnds:
    """Where groups end in the order: running sum of bytes and of documents, looked up in the
    stored table by ranges of bytes. ``place`` is the last group end up to a number of bytes.

    The table is sorted by ``group_end``, so that a range is found in few row groups. What was
    fetched stays as two rows of numbers, the ends and the documents up to them.
    """

    groups: DataFrame
    total: int
    window: int = WINDOW
    spans: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def place(self, limit: int) -> tuple[int, int]:
        """(bytes, documents) of all groups that end by ``limit``."""
        for low, high, ends in self.spans:
            if low <= limit < high and ends.size and ends[0, 0] <= limit:
                last = np.searchsorted(ends[0], limit, side="right") - 1
                return int(ends[0, last]), int(ends[1, last])
        low, high = limit - self.window, limit + self.window
        rows = (
            self.groups.filter((F.col("group_end") > low) & (F.col("group_end") < high))
            .select("group_end", "rows_end")
            .toArrow()
        )
        ends = np.array([rows["group_end"].to_numpy(), rows["rows_end"].to_numpy()], dtype=np.int64)
        ends = ends[:, np.argsort(ends[0])]
        if not ends.size or ends[0, 0] > limit:
            before = (
                self.groups.filter(F.col("group_end") <= limit)
                .agg(F.max(F.struct("group_end", "rows_end")).alias("last"))
                .collect()[0]
                .last
            )
            first = (before.group_end, before.rows_end) if before else (0, 0)
            ends = np.column_stack([np.array(first, dtype=np.int64), ends])
        self.spans.append((low, high, ends))
        return self.place(limit)


def greedy_cuts(ends: GroupEnds, capacity: int, shards: int) -> list[tuple[int, int]] | None:
    """Where shards end when each takes as many groups as fit; None if ``shards`` are not enough."""
    cuts, at = [], (0, 0)
    for _ in range(shards):
        at = ends.place(min(at[0] + capacity, ends.total))
        cuts.append(at)
        if at[0] == ends.total:
            return cuts
    return None


def smallest_capacity(ends: GroupEnds, largest: int, shards: int) -> int:
    """The smallest capacity that is enough: steps of doubling size up from the least conceivable,
    then halving. The places looked at stay close together, so few ranges are fetched."""
    low = max(largest, -(-ends.total // shards))
    if greedy_cuts(ends, low, shards) is not None:
        return low
    step = 1
    while greedy_cuts(ends, low + step, shards) is None:
        low, step = low + step, step * 2
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        if greedy_cuts(ends, middle, shards) is None:
            low = middle
        else:
            high = middle
    return high


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A size is the UTF-8 length of the whole text, plus 1; a null text counts as an empty one and
    is in one group with it. The order of groups is that of their texts' hashes, so it does not
    depend on how rows arrive. Slots number a shard's documents from 0 by hash and doc_id;
    repeated rows are interchangeable. With fewer groups than shards the last shards stay empty,
    an empty table gives no rows. The law is ``bytes``, so there is no grown shard. Other columns
    are not looked at.

    Documents are range-sorted once, as narrow rows, and a group of copies with most of them is
    split over ranges like any other rows. Shards follow from comparing a running sum with the
    cuts, without a join.
    """
    whole = whole_text(text)
    narrow = docs.select(
        "doc_id",
        *text_key(text),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = written(
        with_running_sums(
            narrow, ["hash_1", "hash_2", "doc_id"], {"bytes_through": "size", "rows_through": "one"}
        ),
        "shard-places",
    )
    groups = written(
        placed.groupBy("hash_1", "hash_2").agg(
            F.max("bytes_through").alias("group_end"),
            F.max("rows_through").alias("rows_end"),
            F.sum("size").alias("group_size"),
        )
        .repartitionByRange("group_end")
        .sortWithinPartitions("group_end"),
        "shard-groups",
    )
    whole_table = groups.agg(F.max("group_end").alias("total"), F.max("group_size").alias("largest"))
    total, largest = whole_table.collect()[0]
    if total is None:
        cuts = []
    else:
        ends = GroupEnds(groups, total)
        cuts = greedy_cuts(ends, smallest_capacity(ends, largest, shards), shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        _cuts_before(cuts, 0).alias("shard"),
        (F.col("rows_through") - 1 - _rows_before(cuts)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _cuts_before(cuts: list[tuple[int, int]], first: int) -> Column:
    shard = F.lit(first)
    for bytes_end, _ in cuts[:-1]:
        shard = shard + (F.col("bytes_through") > bytes_end).cast("int")
    return shard


def _rows_before(cuts: list[tuple[int, int]]) -> Column:
    rows = F.lit(0).cast("long")
    for bytes_end, rows_end in cuts[:-1]:
        rows = F.when(F.col("bytes_through") > bytes_end, F.lit(rows_end)).otherwise(rows)
    return rows
