"""SimHash near-dedup with tables of distances to pivots.

A text's fingerprint has a bit for each bit position that more than half of its shingles' hashes
set. Two fingerprints link when few bits differ. Pairs that can link agree in some blocks of bits, which
brings them into one bucket. Within buckets each fingerprint has a row of its Hamming distances to many
pivots: where two rows differ by more than the limit in any place, so do the fingerprints, by the
triangle inequality, and the pair is discarded; the pairs that survive are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.llm.common import fields, row_hash, whole_text, written
from clickmetrics.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
PIVOTS = np.random.default_rng(7).integers(0, 1 << 64, 16, dtype=np.uint64)
#: Buckets up to this size are compared by shifting, larger ones by spreading from member to member,
#: and those larger still are first split by finer blocks.
SMALL_BUCKET = 32
LARGE_BUCKET = 4096


def fingerprint_of(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text in UTF-8, 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(min(shingle_words, len(words)))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(b" ".join(shingle), HASH_SEED) for shingle in shingles), dtype="<u8"
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes)).view("<u8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Fingerprints as signed longs."""

    @F.arrow_udf("bigint")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint_of(text.as_py(), shingle_words) for text in batch]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return fingerprint(text.cast("binary"))


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Masks of which at least one covers no differing bit when at most ``max_bits`` differ: the
    choices of all blocks but ``max_bits``."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def blocks_for(fingerprints: int, max_bits: int) -> int:
    """Enough blocks that buckets of unrelated fingerprints hold less than one on average."""
    blocks = max_bits + 1
    while blocks < 3 * max_bits + 1 and 64 * (blocks - max_bits) // blocks < np.log2(
        max(fingerprints, 1) * 4
    ):
        blocks += 1
    return blocks


class _Linker:
    """Links fingerprints of buckets and remembers who is linked, as a forest."""

    def __init__(self, max_bits: int) -> None:
        self.max_bits = max_bits
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        top = node
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(node, node) != top:
            parent[node], node = top, parent[node]
        return top

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            a, b = self.root(a), self.root(b)
            self.parent.setdefault(a, a)
            self.parent.setdefault(b, b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def _near(self, left, right, rows_left, rows_right) -> np.ndarray:
        """Which pairs are within the limit: discarded by their pivot rows, or verified."""
        near = np.flatnonzero(
            np.abs(rows_left - rows_right).max(axis=1, initial=0) <= self.max_bits
        )
        bits = np.bitwise_count(left[near] ^ (right[near] if right.ndim else right))
        return near[bits <= self.max_bits]

    def buckets(self, values: np.ndarray, first: np.ndarray, blocks: int) -> None:
        """Link within buckets that follow each other; ``first`` is where each starts."""
        sizes = np.diff(np.r_[first, len(values)])
        small = np.repeat(sizes <= SMALL_BUCKET, sizes) & np.repeat(sizes > 1, sizes)
        bucket = np.repeat(np.arange(len(first)), sizes)[small]
        members = values[small]
        rows = _pivot_rows(members)
        for shift in range(1, int(sizes[sizes <= SMALL_BUCKET].max(initial=1))):
            at = np.flatnonzero(bucket[shift:] == bucket[:-shift])
            near = at[self._near(members[at], members[at + shift], rows[at], rows[at + shift])]
            self.link(members[near], members[near + shift])
        for number in np.flatnonzero(sizes > SMALL_BUCKET).tolist():
            self.large(values[first[number] : first[number] + sizes[number]], blocks)

    def large(self, values: np.ndarray, blocks: int) -> None:
        """A bucket of many: split by finer blocks while that can help, else spread."""
        if len(values) <= LARGE_BUCKET or blocks > 3 * self.max_bits:
            return self.spread(values)
        for mask in block_masks(blocks + 2, self.max_bits):
            keys = values & np.uint64(mask)
            order = np.argsort(keys, kind="stable")
            first = np.r_[0, np.flatnonzero(np.diff(keys[order])) + 1]
            self.buckets(values[order], first, blocks + 2)

    def spread(self, values: np.ndarray) -> None:
        """From each member reached to those not reached yet, so that a dense bucket costs little
        more than its size."""
        rows = _pivot_rows(values)
        waiting = np.arange(len(values))
        reached: list[int] = []
        while len(waiting):
            if not reached:
                reached.append(int(waiting[0]))
                waiting = waiting[1:]
            at = reached.pop()
            near = self._near(values[waiting], values[at], rows[waiting], rows[at])
            if len(near):
                found = waiting[near]
                self.link(np.full(len(found), values[at]), values[found])
                reached += found.tolist()
                waiting = np.delete(waiting, near)


def _pivot_rows(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ PIVOTS).astype(np.int8)


def _link_buckets(blocks: int, max_bits: int):
    """Over rows sorted by bucket, the forest of links found in the partition: one row per linked
    fingerprint that is not its tree's root."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = _Linker(max_bits)
        mask, key, value = (np.array([], dtype=np.int64) for _ in range(3))
        for batch in batches:
            mask, key, value = (
                np.concatenate([old, column.to_numpy()])
                for old, column in zip((mask, key, value), batch.columns)
            )
            first = np.r_[0, np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1]
            last = int(first[-1])
            if last:
                linker.buckets(value[:last].view(np.uint64), first[:-1], blocks)
                mask, key, value = mask[last:], key[last:], value[last:]
        if len(value):
            linker.buckets(value.view(np.uint64), np.array([0]), blocks)
        found = [(node, linker.root(node)) for node in linker.parent]
        pairs = np.array([p for p in found if p[0] != p[1]], dtype=np.uint64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, i].copy().view(np.int64)) for i in (0, 1)], ["a", "b"]
        )

    return link


def fingerprint_links(values: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links among distinct fingerprints (column ``fingerprint``) that join up all that are within
    ``max_bits`` of each other: (a, b), a forest for each task rather than all pairs.

    Each fingerprint goes to one bucket per choice of blocks. There are as many blocks as the number
    of fingerprints asks for, so that buckets stay small as the input grows.
    """
    blocks = blocks_for(values.count(), max_bits)
    masks = [mask - (1 << 64) if mask >> 63 else mask for mask in block_masks(blocks, max_bits)]
    fingerprint = F.col("fingerprint")
    keys = F.array(
        *[
            F.struct(F.lit(i).cast("long").alias("mask"), fingerprint.bitwiseAND(F.lit(mask)).alias("key"))
            for i, mask in enumerate(masks)
        ]
    )
    dealt = (
        values.select(F.explode(keys).alias("bucket"), "fingerprint")
        .select("bucket.mask", "bucket.key", "fingerprint")
        .repartition("mask", "key")
        .sortWithinPartitions("mask", "key")
    )
    return dealt.mapInArrow(_link_buckets(blocks, max_bits), "a long, b long")


def simhash_classes(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, row_hash, fingerprint (long), component, component_id.

    Documents are in one component when links lead from one to the other; ``component`` is its least
    fingerprint as a signed long and ``component_id`` its smallest doc_id, null only if all are.
    Null and empty texts have fingerprint zero and link like any other; so do repeated rows and
    exact copies, which share a fingerprint and are one node of the graph. Texts of any length are
    read whole. An empty table gives no rows. Other columns are not looked at.
    """
    marked = written(
        docs.select(
            "doc_id",
            row_hash(docs).alias("row_hash"),
            fingerprints(whole_text(text), shingle_words).alias("fingerprint"),
        ),
        "fingerprints",
    )
    distinct = written(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_doc")), "distinct"
    )
    roots = connected_components(fingerprint_links(distinct.select("fingerprint"), max_bits))
    of_node = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least_doc", F.coalesce("root", "fingerprint").alias("component")
    )
    of_node = written(of_node, "nodes")
    named = of_node.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    classes = of_node.join(named, "component").select("fingerprint", "component", "component_id")
    return marked.join(classes, "fingerprint").select(
        "doc_id", "row_hash", "fingerprint", "component", "component_id"
    )


def drop_near_copies(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    text: str = "text",
) -> DataFrame:
    """The documents with one row left of each component, the one with the smallest doc_id; of
    several with that id, the one with the least row hash. Rows equal in full are one. All columns
    stay as they are, whatever their names and types.

    Documents meet a narrow row for each one to drop, by doc_id and a hash of the row; where few
    are dropped, Spark sends these to the documents.
    """
    classes = written(simhash_classes(docs, shingle_words, max_bits, text), "classes")
    one = classes.groupBy("component", "doc_id", "row_hash").agg(F.count(F.lit(1)).alias("equal_rows"))
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")).alias("stays")
    stay = classes.groupBy("component").agg(best)
    marked = one.join(stay, "component").withColumn(
        "stays",
        F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("row_hash") == F.col("stays.row_hash")),
    )
    special = marked.filter("NOT stays OR equal_rows > 1").select("doc_id", "row_hash", "stays")
    special = written(special, "special-rows").select(F.struct("*").alias("plan"))
    rows = docs.select(F.struct("*").alias("document"), row_hash(docs).alias("hash"))
    met = F.col("document").getField("doc_id").eqNullSafe(F.col("plan.doc_id")) & (
        F.col("hash") == F.col("plan.row_hash")
    )
    left = rows.join(special, met, "left_anti")
    repeated = special.filter("plan.stays")
    if not repeated.isEmpty():
        equal = Window.partitionBy("plan.doc_id", "hash").orderBy("hash")
        first = rows.join(repeated, met).withColumn("number", F.row_number().over(equal)).filter("number = 1")
        left = left.select("document").unionByName(first.select("document"))
    return left.select(*fields("document", docs.columns))
