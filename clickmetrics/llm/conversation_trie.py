"""Prefix trie of conversations, in balanced parentheses per shard.

Conversations are sorted by their turns and cut into shards. The nodes of a shard's trie, in preorder,
are one opening and one closing parenthesis each. Where a node closes bounds its subtree; it is found
with a tree of the least excess of blocks. Leaves are the pairs "()", counted by rank, and what
a subtree saves is a difference of running sums. Only nodes on a shard's first and last path, its
spines, can go on in another shard: they are merged, and their trie is encoded in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import partitions_for, whole_text, written

#: Turns and conversations of a shard, at most, but for a single longer conversation.
TURNS_PER_SHARD = 250_000
#: Parentheses of a block of which the least excess is kept.
BLOCK = 64

NO_ENDS = sha256(b"").hexdigest()
NODE_SCHEMA = """
    shard long, node long, spine boolean, depth long, conv_id long, parent_conv_id long, n_convs long,
    n_children long, n_leaves long, saved_tokens long, chars long, parent long, key binary, ends binary,
    ends_sha256 string
"""
NODE_COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)
SPINE_SCHEMA = "key binary, " + ", ".join(f"{name} long" for name in NODE_COLUMNS[:-1])


class Parentheses:
    """A trie in balanced parentheses, from its nodes' depths in preorder."""

    def __init__(self, depths: np.ndarray) -> None:
        self.size = len(depths)
        self.depths = depths
        # Of the nodes before a node, all but its ancestors have closed.
        self.opens = 2 * np.arange(self.size) - depths
        bits = np.zeros(2 * self.size, dtype=np.int32)
        bits[self.opens] = 1
        self.excess = np.cumsum(2 * bits - 1, dtype=np.int32)
        self._build_blocks()
        self.closes = self.find_closes()
        #: Nodes of each node's subtree, itself included; they follow it in preorder.
        self.subtree = (self.closes - self.opens + 1) // 2
        leaf_pairs = np.zeros(2 * self.size + 1, dtype=np.int64)
        leaf_pairs[1:-1] = bits[:-1] > bits[1:]
        #: How many pairs "()" begin before a place.
        self.leaf_ranks = np.cumsum(leaf_pairs)

    def _build_blocks(self) -> None:
        """The least excess of each block, of two blocks and so on, one level after the other."""
        most = np.iinfo(np.int32).max
        count = 1
        while count * BLOCK < len(self.excess):
            count *= 2
        padded = np.full(count * BLOCK, most, dtype=np.int32)
        padded[: len(self.excess)] = self.excess
        levels = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).min(axis=1))
        self.level_starts = np.cumsum([0, *map(len, levels)])
        self.least = np.concatenate(levels)

    def _scan(self, at: np.ndarray, targets: np.ndarray, found: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Look on from places to the ends of their blocks; returns who has not found the target."""
        while len(who):
            inside = at % BLOCK != 0
            hit = self.excess[np.minimum(at, len(self.excess) - 1)] == targets[who]
            found[who[inside & hit]] = at[inside & hit]
            stay = inside & ~hit
            left = who[~inside]
            if len(left):
                self._waiting.append(left)
            at, who = at[stay] + 1, who[stay]
        left, self._waiting = self._waiting, []
        return np.concatenate(left) if left else who

    def find_closes(self) -> np.ndarray:
        """Where each node closes: the first place behind its opening with an excess less by one."""
        self._waiting: list[np.ndarray] = []
        found = np.full(self.size, -1, dtype=np.int64)
        targets = self.excess[self.opens] - 1
        who = self._scan(self.opens + 1, targets, found, np.arange(self.size))
        # The others climb from the next block until one has an excess so low, then come down to it.
        node, level = self.opens[who] // BLOCK + 1, np.zeros(len(who), dtype=np.int64)
        block = np.empty(self.size, dtype=np.int64)
        while len(who):
            low = self.least[self.level_starts[level] + node] <= targets[who]
            here = low & (level == 0)
            block[who[here]] = node[here]
            down = low & ~here
            up = ~low & (node % 2 == 1)
            level = level + np.where(down, -1, np.where(up, 1, 0))
            node = np.where(down, 2 * node, np.where(up, (node + 1) // 2, node + (~low)))
            who, node, level = who[~here], node[~here], level[~here]
        who = np.flatnonzero(found < 0)
        at = block[who] * BLOCK
        first = self.excess[at] == targets[who]
        found[who[first]] = at[first]
        self._scan(at[~first] + 1, targets, found, who[~first])
        return found

    def leaves(self) -> np.ndarray:
        """Leaves of each subtree."""
        return self.leaf_ranks[self.closes + 1] - self.leaf_ranks[self.opens]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of each subtree, the sum of its nodes' values."""
        through = np.concatenate([[0], np.cumsum(values)])
        nodes = np.arange(self.size)
        return through[nodes + self.subtree] - through[nodes]

    def parents(self) -> np.ndarray:
        """Each node's parent, -1 for the root: the last node before it that is less deep by one."""
        nodes = np.arange(self.size)
        by_depth = np.sort(self.depths * self.size + nodes)
        wanted = (self.depths - 1) * self.size + nodes
        at = np.searchsorted(by_depth, wanted) - 1
        return np.where(self.depths > 0, by_depth[np.maximum(at, 0)] % self.size, -1)


@dataclass
class Paths:
    """Conversations of a shard, sorted by turns and then by id. A turn is two hashes and a length."""

    conv_ids: np.ndarray
    lengths: np.ndarray
    hash_1: np.ndarray
    hash_2: np.ndarray
    chars: np.ndarray

    @classmethod
    def of(cls, parts: list[pa.RecordBatch]) -> Paths:
        table = pa.Table.from_batches(parts).combine_chunks()
        path = table["path"].combine_chunks()
        turns = path.flatten()
        return cls(
            table["conv_id"].to_numpy(),
            path.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
            *[turns.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)],
        )

    def shared_with_previous(self, rows: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """For each conversation how many first turns it has in common with the one before.

        ``rows`` and ``turn`` say for each turn whose it is and its number.
        """
        before = np.r_[0, self.lengths[:-1]]
        starts = np.cumsum(self.lengths) - self.lengths
        same = (turn < before[rows]) & (rows > 0)
        at = np.where(same, (starts - before)[rows] + turn, 0)
        same &= (self.hash_1[at] == self.hash_1) & (self.hash_2[at] == self.hash_2)
        shared = np.zeros(len(self.lengths), dtype=np.int64)
        some = self.lengths > 0
        first_other = np.where(same, self.lengths[rows], turn)
        if some.any():
            shared[some] = np.minimum.reduceat(first_other, starts[some])
        return shared

    def digests(self, row: int) -> list[bytes]:
        """A digest of each sequence of first turns of a conversation, from no turns on."""
        end = int(self.lengths[: row + 1].sum())
        start = end - int(self.lengths[row])
        both = np.stack([self.hash_1[start:end], self.hash_2[start:end]], axis=1)
        turns, state, digests = both.astype("<i8").tobytes(), blake2b(digest_size=16), []
        for at in range(0, len(turns), 16):
            digests.append(state.digest())
            state.update(turns[at : at + 16])
        return [*digests, state.digest()]

    def nodes(self, shard: int) -> pa.RecordBatch:
        """The shard's nodes as rows of ``NODE_SCHEMA``; those on the spines with what they have here
        besides other nodes on the spines."""
        rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
        turn = np.arange(len(rows)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        shared = self.shared_with_previous(rows, turn)
        new = turn >= shared[rows]
        trie = Parentheses(np.r_[0, turn[new] + 1])
        chars, nodes = np.r_[0, self.chars[new]], np.arange(trie.size)
        # A conversation ends at the last node that it or one before it, then an equal one, opened.
        last = np.cumsum(np.bincount(rows[new], minlength=len(self.lengths)))
        n_ends = np.bincount(last, minlength=trie.size)
        convs_before = np.r_[0, np.cumsum(n_ends)]
        first, n_convs = convs_before[:-1], trie.sums(n_ends)
        members = np.stack([first, first + n_convs], axis=1).ravel()
        conv_id = np.minimum.reduceat(np.r_[self.conv_ids, self.conv_ids[-1]], members)[::2]
        parents = trie.parents()

        on_last = nodes + trie.subtree == trie.size
        spine = (nodes <= self.lengths[0]) | on_last
        saved = (n_convs - 1) * chars
        is_leaf = trie.subtree == 1
        leaves = np.where(spine, trie.sums(is_leaf & ~spine), trie.leaves())
        children = np.bincount(parents[1:][~spine[1:]], minlength=trie.size)
        under_spine = ~spine & spine[parents]
        parent_conv = np.where(spine | under_spine, 0, conv_id[parents])

        keys: list[bytes | None] = [None] * trie.size
        ends, ends_sha256 = list(keys), [NO_ENDS] * trie.size
        keys[: self.lengths[0] + 1] = self.digests(0)
        for node, digest in zip(np.flatnonzero(on_last).tolist(), self.digests(len(self.lengths) - 1)):
            keys[node] = digest
        for node in np.flatnonzero(n_ends).tolist():
            own = self.conv_ids[convs_before[node] : convs_before[node + 1]]
            if spine[node]:
                ends[node] = own.astype("<i8").tobytes()
            else:
                ends_sha256[node] = sha256(",".join(map(str, own.tolist())).encode()).hexdigest()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(trie.size, shard)), pa.array(nodes), pa.array(spine), pa.array(trie.depths),
                pa.array(conv_id), pa.array(parent_conv), pa.array(n_convs), pa.array(children),
                pa.array(leaves), pa.array(trie.sums(np.where(spine, 0, saved))), pa.array(chars),
                pa.array(np.where(under_spine, parents, -1)), pa.array(keys, pa.binary()),
                pa.array(ends, pa.binary()), pa.array(ends_sha256),
            ],
            [field.split()[0] for field in NODE_SCHEMA.split(",")],
        )


def _shards(
    batches: Iterator[pa.RecordBatch], turns_per_shard: int
) -> Iterator[list[pa.RecordBatch]]:
    """Sorted conversations in parts that a task holds at a time."""
    parts, size = [], 0
    for batch in batches:
        cost = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False) + 1)
        start = 0
        while start < len(batch):
            before = cost[start - 1] if start else 0
            fits = int(np.searchsorted(cost, before + turns_per_shard - size, side="right"))
            end = min(len(batch), max(fits, start + (not parts)))
            if end > start:
                parts.append(batch.slice(start, end - start))
                size, start = size + cost[end - 1] - before, end
            if start < len(batch):
                yield parts
                parts, size = [], 0
    if parts:
        yield parts


def _tries(turns_per_shard: int):
    """A function of a partition's conversations that gives the nodes of its shards. Shards are
    numbered in the order of the turns."""

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for number, parts in enumerate(_shards(batches, turns_per_shard)):
            yield Paths.of(parts).nodes((partition << 32) + number)

    return tries


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """Each conversation as conv_id and path: its turns in order, a null turn first, as two hashes of
    (role, text) that stand for them and the text's characters.

    Null roles and texts read as empty. Turns with one number stand in the order of their hashes. Rows
    without conv_id are no conversation. A path is 24 bytes a turn; texts are not moved.
    """
    said = [F.coalesce(F.col("role"), F.lit("")), whole_text()]
    turn = F.struct(
        F.col("turn").isNotNull(),
        "turn",
        F.xxhash64(*said).alias("hash_1"),
        F.xxhash64(F.lit("second"), *said).alias("hash_2"),
        F.char_length(said[1]).alias("chars"),
    )
    return (
        conversations.filter("conv_id IS NOT NULL")
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select("conv_id", _turns(F.col("turns")).alias("path"))
    )


def _turns(turns: Column) -> Column:
    names = ("hash_1", "hash_2", "chars")
    return F.transform(turns, lambda turn: F.struct(*[turn[name].alias(name) for name in names]))


def with_common_heads(paths: DataFrame, every: int, lengths: int) -> DataFrame:
    """Conversations whose first turns are those of the conversation at the last multiple of ``every``.

    How many is the CRC-32 of the id's decimals modulo ``lengths``; all if it has fewer, none if it
    is not there. A conversation's own turns follow from that number on.
    """
    heads = paths.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, lengths - 1).alias("head")
    )
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lengths).cast("int")
    rest = F.slice("path", n + 1, F.greatest(F.size("path"), F.lit(1)))
    first = F.coalesce(F.slice("head", 1, n), F.slice("path", 1, 0))
    base = F.col("conv_id") - F.col("conv_id") % every
    joined = paths.join(heads, base == F.col("base"), "left")
    return joined.select("conv_id", F.concat(first, rest).alias("path"))


def _merged_spines(spines: DataFrame) -> DataFrame:
    """The nodes that several shards may have, once each, with their final values.

    Partial values are added up by node before one task gets them: a node a turn of the
    shards' first and last paths, whatever the number of conversations.
    """
    merged = spines.groupBy("key").agg(
        F.min(F.struct("shard", "node")).alias("place"),
        *[F.first(name).alias(name) for name in ("depth", "chars")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [part for part in batches if len(part)]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        numbers = ("depth", "chars", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
        of = {name: table[name].to_numpy() for name in numbers}
        trie, chars = Parentheses(of["depth"]), of["chars"]
        parents = trie.parents()
        children = of["n_children"] + np.bincount(parents[1:], minlength=trie.size)
        saved = (of["n_convs"] - 1) * chars
        is_root = parents < 0
        yield pa.RecordBatch.from_arrays(
            [
                table["key"].combine_chunks(), pa.array(of["conv_id"]), pa.array(of["depth"]),
                pa.array(of["conv_id"][parents], mask=is_root), pa.array(of["n_convs"]), pa.array(children),
                pa.array(of["n_leaves"] + trie.sums(children == 0)), pa.array(of["saved_tokens"] + trie.sums(saved)),
            ],
            [field.split()[0] for field in SPINE_SCHEMA.split(", ")],
        )

    return merged.repartition(1).sortWithinPartitions("place").mapInArrow(finish, SPINE_SCHEMA)


def _ends_of_spines(spines: DataFrame) -> DataFrame:
    """For each node where conversations end the digest of their ids, read from the shards in order.

    Equal conversations are sorted by id, so shard after shard has greater ids and one pass in
    bounded memory suffices, however many there are.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, state):
            values = [pa.array([key], pa.binary()), pa.array([state.hexdigest()])]
            return pa.RecordBatch.from_arrays(values, ["key", "ends_sha256"])

        now, state = None, None
        for batch in batches:
            for key, ends in zip(batch.column(0).to_pylist(), batch.column(2)):
                text = ",".join(map(str, np.frombuffer(ends.as_py(), dtype="<i8").tolist()))
                if key == now:
                    state.update(b"," + text.encode())
                    continue
                if now is not None:
                    yield row(now, state)
                now, state = key, sha256(text.encode())
        if now is not None:
            yield row(now, state)

    ends = spines.filter("ends IS NOT NULL").select("key", "shard", "ends")
    ordered = ends.repartition("key").sortWithinPartitions("key", "shard")
    return ordered.mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(paths: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """The nodes of the trie of conversations given as conv_id (bigint, not null) and path, see
    ``conversation_paths``.

    A node is a distinct sequence of first turns; the root has none. Its members are the conversations
    that begin with it, also those without turns. Per node: conv_id, the smallest member; depth;
    parent_conv_id, null for the root; n_convs; n_children; n_leaves, childless nodes of its subtree;
    saved_tokens, over the nodes of its subtree one less than their members times the characters of their
    last text; ends_sha256, the digest of the sorted ids of members without further turns, joined by
    commas. Ids that repeat are members of their own. An empty table has no nodes.

    Conversations are dealt by ranges of their turns, equal ones by id, so that neither a common
    beginning nor copies have to fit one task; a conversation's path does.
    """
    spark = paths.sparkSession
    staged = written(paths.select("conv_id", "path"), "paths")
    turns = staged.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0))).first()[0]
    ranges = partitions_for(turns, turns_per_shard, spark)
    turns_alone = F.transform("path", lambda turn: F.struct(turn["hash_1"], turn["hash_2"]))
    ranged = staged.withColumn("turns", turns_alone).repartitionByRange(ranges, "turns", "conv_id")
    ranged = ranged.sortWithinPartitions("turns", "conv_id").select("conv_id", "path")
    nodes = written(ranged.mapInArrow(_tries(turns_per_shard), NODE_SCHEMA), "nodes")

    spines = nodes.filter("spine")
    merged = written(_merged_spines(spines), "spines")
    whole = merged.join(_ends_of_spines(spines), "key", "left").fillna({"ends_sha256": NO_ENDS})
    inner = nodes.filter("NOT spine")
    # A shard's nodes below its own spines learn their parents' final ids.
    places = spines.select("shard", F.col("node").alias("parent"), "key").join(
        merged.select("key", F.col("conv_id").alias("final_id")), "key"
    )
    below = inner.filter("parent >= 0").drop("key").join(places, ["shard", "parent"])
    parts = (inner.filter("parent < 0"), below.withColumn("parent_conv_id", F.col("final_id")), whole)
    inside, below, whole = (part.select(*NODE_COLUMNS) for part in parts)
    return inside.unionByName(below).unionByName(whole)
