"""Line dedup: frequent lines are found in compact arrays behind a minimal perfect hash.

Lines are counted by hash. The distinct hashes that enough documents have are dealt into shards, and
each shard becomes a minimal perfect hash over its hashes, with an array of fingerprints and an
array of counts behind it. Documents probe the arrays with their lines' hashes: every task has all
arrays while these are small, else the hashes go to their shards and back. No line is joined. A hash
that is not in a shard fails the fingerprint, which is a second, independent 64-bit hash of the line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import SPACES, lower_ascii, text_key, whole_text, written

SHARD_KEYS = 1 << 16
SHARD_SCHEMA = "shard long, documents long, bitmaps array<binary>, fingerprints binary, counts binary"
PROBED = "struct<text: string, n_dropped: bigint>"
LINE = ("text_1", "text_2", "hash_1", "hash_2")
#: Bytes of arrays that each task may hold. Beyond that the lines' hashes go to the arrays.
ARRAY_BYTES = 64 << 20
#: A fingerprint, a count and the bits and ranks of a key, in a file and in memory alike.
BYTES_PER_KEY = 13
#: Lines that a task answers where the arrays stay in their shards.
PROBE_ROWS = 1_000_000


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another hash of 64-bit hashes for each level (the finaliser of SplitMix64)."""
    mixed = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


@dataclass
class PerfectHash:
    """A minimal perfect hash as a cascade of bitmaps, kept as words of 64 bits.

    A key's bit is in the first level where no other remaining key hashes to the same place. Its
    number is the count of bits before it, so the numbers are 0 to the number of keys less one. A
    count per word and the bits below in the word give that number.
    """

    bitmaps: list[np.ndarray]

    def __post_init__(self) -> None:
        self.ranks, self.keys = [], 0
        for words in self.bitmaps:
            ones = np.bitwise_count(words)
            self.ranks.append((np.cumsum(ones, dtype=np.int64) - ones + self.keys).astype(np.uint32))
            self.keys += int(ones.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        bitmaps, left, level = [], keys, 0
        while len(left):
            size = 64 * -(-2 * len(left) // 64)
            places = (_mixed(left, level) % np.uint64(size)).astype(np.int64)
            counts = np.bincount(places, minlength=size)
            bitmaps.append(np.packbits(counts == 1, bitorder="little").view("<u8"))
            left = left[counts[places] > 1]
            level += 1
        return cls(bitmaps)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """A key's number; of a key it was not made for, any number or -1."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.bitmaps, self.ranks)):
            places = _mixed(keys[left], level) % np.uint64(64 * len(words))
            word, bit = places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63))
            bits = words[word]
            here = (bits & bit) != 0
            below = np.bitwise_count(bits[here] & (bit[here] - np.uint64(1)))
            found[left[here]] = ranks[word[here]] + below.astype(np.int64)
            left = left[~here]
        return found


@dataclass
class LineShard:
    """The arrays of one shard."""

    hashes: PerfectHash
    fingerprints: np.ndarray
    counts: np.ndarray

    @classmethod
    def packed(cls, hash_1: np.ndarray, hash_2: np.ndarray, counts: np.ndarray) -> dict:
        """The arrays as a row's values. Lines that agree in the first hash but not in the second
        cannot share a shard's slot: those past the first go to an overflow list at the end."""
        perfect = PerfectHash.of(np.unique(hash_1))
        numbers = perfect.numbers(hash_1)
        order = np.argsort(numbers, kind="stable")
        first = np.r_[True, np.diff(numbers[order]) != 0] if len(order) else np.array([], bool)
        order = np.concatenate([order[first], order[~first]])
        return {
            "bitmaps": [words.tobytes() for words in perfect.bitmaps],
            "fingerprints": hash_2[order].astype("<u8").tobytes(),
            "counts": np.minimum(counts[order], 0xFFFFFFFF).astype("<u4").tobytes(),
        }

    @classmethod
    def read(cls, bitmaps, fingerprints: bytes, counts: bytes) -> LineShard:
        return cls(
            PerfectHash([np.frombuffer(words, dtype="<u8") for words in bitmaps]),
            np.frombuffer(fingerprints, dtype="<u8"),
            np.frombuffer(counts, dtype="<u4"),
        )

    @property
    def nbytes(self) -> int:
        arrays = [*self.hashes.bitmaps, *self.hashes.ranks, self.fingerprints, self.counts]
        return sum(array.nbytes for array in arrays)

    def count(self, hash_1: np.ndarray, hash_2: np.ndarray) -> np.ndarray:
        """Documents of each line, 0 for lines that are not here."""
        numbers = self.hashes.numbers(hash_1)
        at = np.maximum(numbers, 0)
        known = (numbers >= 0) & (self.fingerprints[at] == hash_2)
        counts = np.where(known, self.counts[at], 0)
        slots = self.hashes.keys
        for extra, count in zip(self.fingerprints[slots:], self.counts[slots:]):
            counts = np.where(~known & (hash_2 == extra), count, counts)
        return counts


def line_keys(text: Column) -> Column:
    """For each line its key: without blanks at its ends, ASCII capitals folded."""
    return F.transform(
        F.split(text, "\n"), lambda line: lower_ascii(F.btrim(line, F.lit(SPACES)))
    )


def key_hashes(keys: Column, min_chars: int) -> Column:
    """For each key its two hashes; null for a key of fewer than ``min_chars`` characters."""

    def hashes(key: Column) -> Column:
        pair = F.struct(
            F.xxhash64(key).alias("hash_1"), F.xxhash64(F.lit("second"), key).alias("hash_2")
        )
        return F.when(F.char_length(key) >= min_chars, pair)

    return F.transform(keys, hashes)


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int, text: str = "text") -> DataFrame:
    """Hashes of the lines that at least ``min_docs`` documents have, with their number.

    A document counts once per line. Counts are added up before the shuffle, so a line that
    every document has costs one row per task. Keys are made distinct as strings, for which Spark
    has a hash set; among structs it would compare every line of a document with every other.
    """
    once = key_hashes(F.array_distinct(line_keys(whole_text(text))), min_chars)
    return (
        docs.select(F.explode(once).alias("line"))
        .filter("line IS NOT NULL")
        .groupBy("line.hash_1", "line.hash_2")
        .agg(F.count(F.lit(1)).alias("documents"))
        .filter(F.col("documents") >= min_docs)
    )


def line_shards(frequent: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard, with the sum of its counts."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        as_unsigned = lambda name: group[name].to_numpy(np.int64).view(np.uint64)
        counts = group["documents"].to_numpy(np.int64)
        arrays = LineShard.packed(as_unsigned("hash_1"), as_unsigned("hash_2"), counts)
        return pd.DataFrame([{"shard": group["shard"].iloc[0], "documents": counts.sum(), **arrays}])

    return (
        frequent.withColumn("shard", F.pmod("hash_1", F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(build, SHARD_SCHEMA)
    )


def _rewritten(texts: pa.Array, hashes: pa.Array, drop: np.ndarray) -> pa.Array:
    """The texts without the lines marked in ``drop``, which has all texts' lines one after the
    other, and how many lines each lost."""
    ends = np.cumsum(hashes.value_lengths().to_numpy(zero_copy_only=False))
    dropped = np.diff(np.r_[0, np.cumsum(drop)][np.r_[0, ends]])
    kept = []
    for row in np.flatnonzero(dropped).tolist():
        of_row = drop[ends[row - 1] if row else 0 : ends[row]]
        parts = texts[row].as_py().split("\n")
        kept.append("\n".join(p for p, gone in zip(parts, of_row.tolist()) if not gone))
    changed = pc.replace_with_mask(texts, pa.array(dropped > 0), pa.array(kept, texts.type))
    return pa.StructArray.from_arrays([changed, pa.array(dropped, pa.int64())], ["text", "n_dropped"])


def _hash_pair(lines) -> tuple[np.ndarray, np.ndarray]:
    return tuple(
        pc.fill_null(lines.field(i), 0).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)
    )


def _without_lines(tables, shards: int, least: int):
    """A function of text and line hashes that takes out lines with ``least`` documents or more.

    ``tables`` is the broadcast arrays of all shards.
    """

    @F.arrow_udf(PROBED)
    def probe(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        arrays = {
            row.shard: LineShard.read(row.bitmaps, row.fingerprints, row.counts)
            for row in tables.value
        }
        for texts, hashes in batches:
            lines = hashes.flatten()
            usable = np.asarray(lines.is_valid())
            hash_1, hash_2 = _hash_pair(lines)
            # A negative hash belongs to the shard that pmod gives it.
            shard = hash_1.view(np.int64) % shards
            counts = np.zeros(len(lines), dtype=np.int64)
            for number, table in arrays.items():
                here = np.flatnonzero(usable & (shard == number))
                counts[here] = table.count(hash_1[here], hash_2[here])
            yield _rewritten(texts, hashes, counts >= least)

    return probe


def _without_listed():
    """A function of text, line hashes and a list of hashes that takes out the lines listed."""

    @F.arrow_udf(PROBED)
    def rewrite(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, hashes, listed in batches:
            drop = [np.zeros(0, dtype=bool)]
            for row in range(len(texts)):
                lines, gone = hashes[row].values, listed[row].values
                if gone is None:
                    drop.append(np.zeros(len(lines), dtype=bool))
                    continue
                gone = set(zip(*(part.tolist() for part in _hash_pair(gone))))
                pairs = zip(*(part.tolist() for part in _hash_pair(lines)))
                usable = np.asarray(lines.is_valid())
                drop.append(usable & np.fromiter((pair in gone for pair in pairs), bool, len(lines)))
            yield _rewritten(texts, hashes, np.concatenate(drop))

    return rewrite


def _probe_shard(least: int):
    """The lines of a part of a shard that its arrays count ``least`` times or more."""

    def probe(arrays: pa.Table, lines: pa.Table) -> pa.Table:
        lines = lines.select(["text_1", "text_2", "hash_1", "hash_2"])
        if not len(arrays) or not len(lines):
            return lines.slice(0, 0)
        row = arrays.slice(0, 1).to_pylist()[0]
        shard = LineShard.read(row["bitmaps"], row["fingerprints"], row["counts"])
        hash_1, hash_2 = (lines[name].to_numpy().view(np.uint64) for name in ("hash_1", "hash_2"))
        return lines.filter(pa.array(shard.count(hash_1, hash_2) >= least))

    return probe


def lines_at_shards(
    docs: DataFrame, tables: DataFrame, shards: int, min_docs: int, min_chars: int, text: str
) -> DataFrame:
    """Hashes of the lines to drop from each text: text_1, text_2, the text's hashes, and ``listed``.

    Each text sends its distinct line hashes once to the shard that would hold them. Equal texts are
    one before that, and a shard with many lines to answer is dealt over as many tasks, each
    with the shard's arrays and about ``PROBE_ROWS`` lines.
    """
    once = key_hashes(F.array_distinct(line_keys(whole_text(text))), min_chars)
    of_text = [key.alias(name) for key, name in zip(text_key(text), ("text_1", "text_2"))]
    lines = written(
        docs.select(*of_text, F.explode(once).alias("line"))
        .filter("line IS NOT NULL")
        .select("text_1", "text_2", "line.hash_1", "line.hash_2")
        .distinct()
        .withColumn("shard", F.pmod("hash_1", F.lit(shards))),
        "text-lines",
    )
    others = lines.count() // shards
    tables = tables.withColumn("parts", F.ceil((F.col("documents") + others + 1) / PROBE_ROWS))
    dealt = tables.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    asked = lines.join(tables.select("shard", "parts"), "shard").withColumn(
        "part", F.pmod(F.xxhash64("text_1"), F.col("parts"))
    )
    found = (
        dealt.select("shard", "part", "bitmaps", "fingerprints", "counts")
        .groupBy("shard", "part")
        .cogroup(asked.select("shard", "part", *LINE).groupBy("shard", "part"))
        .applyInArrow(_probe_shard(min_docs), "text_1 long, text_2 long, hash_1 long, hash_2 long")
    )
    return found.groupBy("text_1", "text_2").agg(
        F.collect_list(F.struct("hash_1", "hash_2")).alias("listed")
    )


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    text: str = "text",
    into: str = "lines",
    array_bytes: int = ARRAY_BYTES,
) -> DataFrame:
    """The documents without the lines that ``min_docs`` of them have, all occurrences.

    ``into`` is a new struct column with n_lines, the lines before, and n_dropped. Other lines stay
    as they were, joined by line ends. A null text stays null and an empty one empty; both are one
    empty line, which is too short to be a key. A document that loses all lines keeps an empty
    text. Repeated rows are documents of their own and count as such. An empty table gives no rows. A
    column named ``into`` is replaced.

    At most ``array_bytes`` of arrays are sent to every task, through the driver. If there are more,
    the arrays stay in their shards: each text sends its line hashes there once, and is
    rewritten once by the hashes that come back. The result is the same.
    """
    if min_chars < 1:
        raise ValueError("a key has at least one character")
    spark = docs.sparkSession
    frequent = written(frequent_lines(docs, min_docs, min_chars, text), "frequent-lines")
    keys = frequent.count()
    shards = max(1, -(-keys // SHARD_KEYS))
    tables = written(line_shards(frequent, shards), "line-shards")

    whole = whole_text(text)
    hashes = key_hashes(line_keys(whole), min_chars)
    found = docs.withColumn(
        into,
        F.struct(F.size(F.split(whole, "\n")).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")),
    )
    if not keys:
        return found
    if keys * BYTES_PER_KEY <= array_bytes:
        probe = _without_lines(spark.sparkContext.broadcast(tables.collect()), shards, min_docs)
        probed = found.select(F.struct("*").alias("document"), probe(whole, hashes).alias("probed"))
    else:
        listed = lines_at_shards(docs, tables, shards, min_docs, min_chars, text)
        of_text = [key.alias(name) for key, name in zip(text_key(text), ("text_1", "text_2"))]
        within = whole_text(F.col("document").getField(text))
        probed = (
            found.select(F.struct("*").alias("document"), *of_text)
            .join(listed, ["text_1", "text_2"], "left")
            .select(
                "document",
                _without_listed()(within, key_hashes(line_keys(within), min_chars), "listed").alias("probed"),
            )
        )
    return probed.withColumn(
        "document",
        F.col("document")
        .withField(f"`{text}`", F.when(F.col(f"document.`{text}`").isNotNull(), F.col("probed.text")))
        .withField(
            f"`{into}`",
            F.struct(
                F.col(f"document.`{into}`.n_lines").alias("n_lines"),
                F.col("probed.n_dropped").alias("n_dropped"),
            ),
        ),
    ).select("document.*")
