"""What several operators share: the meaning of a word, written tables, distributed running sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.session import new_folder

# The characters that separate words, and the ASCII capitals that are folded.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(column: str | Column = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(column: str | Column = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("long")


def words_counted(column: str = "text", bytes_at_once: int = 8 << 20) -> Column:
    """The same as ``word_count``, without a string for each word: an Arrow UDF that looks for
    the bytes where words start, in parts of about ``bytes_at_once``."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.int64())
                continue
            texts = batch.cast(pa.large_binary())
            starts = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset :][: len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            parts = np.searchsorted(starts, np.arange(starts[0], starts[-1], bytes_at_once))
            cuts = np.unique(np.r_[0, parts, len(texts)])
            found = [_words_between(data, starts[a : b + 1]) for a, b in zip(cuts, cuts[1:])]
            yield pa.array(np.concatenate(found))

    return count(whole_text(column).cast("binary"))


def _words_between(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of the texts that lie between successive ``ends`` of UTF-8 data."""
    part, edges = data[ends[0] : ends[-1]], ends - ends[0]
    in_word = (part != 0x20) & ((part < 0x09) | (part > 0x0D))
    begins = in_word.copy()
    begins[1:] &= ~in_word[:-1]
    firsts = edges[:-1][edges[:-1] < len(part)]
    begins[firsts] = in_word[firsts]
    return np.diff(np.searchsorted(np.flatnonzero(begins), edges))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def text_key(column: str = "text") -> list[Column]:
    """Two independent 64-bit hashes that together stand for a whole text."""
    return [
        F.xxhash64(whole_text(column)).alias("hash_1"),
        F.xxhash64(F.lit("second"), whole_text(column)).alias("hash_2"),
    ]


def bounded_parts(batch: pa.Array, size_at_once: int) -> Iterator[list]:
    """The texts or bytes of a batch in parts of about a size, but for a single longer value."""
    part, size = [], 0
    for value in batch:
        part.append(value.as_py())
        size += len(part[-1])
        if size >= size_at_once:
            yield part
            part, size = [], 0
    if part:
        yield part


def row_hash(frame: DataFrame, of: str | None = None) -> Column:
    """A hash of all of a row's columns, or of its fields where a struct column ``of`` holds the row.
    Maps and variants, which cannot be hashed, count as text."""

    def hashable(name: str, kind: str) -> Column:
        value = F.col(of).getField(name) if of else column(name)
        return F.to_json(F.struct(value.alias("value"))) if "map<" in kind or "variant" in kind else value

    return F.xxhash64(*[hashable(name, kind) for name, kind in frame.dtypes])


def column(name: str) -> Column:
    """A column by its plain name, whatever characters are in there."""
    return F.col("`" + name.replace("`", "``") + "`")


def fields(of: str, names: Sequence[str]) -> list[Column]:
    """The fields of a struct column under their own names."""
    return [F.col(of).getField(name).alias(name) for name in names]


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder.

    It cuts the lineage, survives the loss of any executor, and keeps what Spark decided
    while it ran, such as partition numbers, the same for every later reader.
    """
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions_for(rows: int, rows_per_partition: int, spark) -> int:
    """Enough partitions that none is much above ``rows_per_partition``, and a full wave of them."""
    return max(-(-rows // rows_per_partition), int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_running_sums(
    frame: DataFrame,
    order: Sequence[str],
    sums: dict[str, str],
    within: Sequence[str] = (),
    rows_per_partition: int = 250_000,
) -> DataFrame:
    """Add running sums over rows in the order of ``order``, inclusive, restarting for each
    group of ``within``.

    No group or order has to fit one task. Rows are range-sorted by (within, order) into a
    written table that fixes each row's range; sums per range are small, and their running
    sums are the offsets of the ranges. Equal rows are interchangeable, so their order does not
    matter; rows that tie in the whole order land in one range.

    ``sums`` maps the new column to the column of longs that it adds up. The result also has
    ``range_no``, the number of the row's range, which grows with the order.
    """
    within, order = list(within), list(order)
    spark = frame.sparkSession
    staged = written(frame, "rows")
    ranges = partitions_for(staged.count(), rows_per_partition, spark)
    ranged = written(
        staged.repartitionByRange(ranges, *within, *order)
        .sortWithinPartitions(*within, *order)
        .withColumn("range_no", F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy(*within, "range_no").agg(
        *[F.sum(value).alias(f"{name}_of_range") for name, value in sums.items()]
    )
    earlier = Window.partitionBy(*within).orderBy("range_no").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *[F.col(name).alias(f"{name}_of_group") for name in within],
        F.col("range_no").alias("range_of_offset"),
        *[
            F.coalesce(F.sum(f"{name}_of_range").over(earlier), F.lit(0)).alias(f"{name}_before")
            for name in sums
        ],
    )
    inside = Window.partitionBy(*within, "range_no").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    same = F.col("range_no") == F.col("range_of_offset")
    for name in within:
        same = same & F.col(name).eqNullSafe(F.col(f"{name}_of_group"))
    return (
        ranged.withColumns({name: F.sum(value).over(inside) for name, value in sums.items()})
        .join(offsets, same)
        .withColumns({name: F.col(name) + F.col(f"{name}_before") for name in sums})
        .select(*frame.columns, "range_no", *sums)
    )
