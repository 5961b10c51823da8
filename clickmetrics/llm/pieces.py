"""SentencePiece encoding and decoding with a table of distinct chunks.

A text is cut before each run of whitespace marks. Where no piece of the model goes on over such a mark,
no merge crosses a cut, so a chunk's ids do not depend on what stands around it: each distinct chunk is
segmented once and gets a number, a text is the list of its chunks' numbers by position, and its ids
are gathered from the table by those numbers, all texts of a block at once.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from clickmetrics.llm.common import bounded_parts, whole_text

# Fixed values of the model file's format: the mark for a blank, the kinds of pieces and models.
MARK = "▁"
CHUNK = re.compile("▁+[^▁]*")
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2

#: Characters of texts worked on at a time, but for a single longer text.
CHARS_AT_ONCE = 1_000_000
#: The table of chunks is emptied between blocks once it has so many chunks, or ids.
CHUNKS_KEPT, IDS_KEPT = 250_000, 4_000_000
#: Characters of a chunk that is segmented on its own.
LONG_CHUNK = 64
#: Behind every pair that merges.
NEVER = np.int64(1) << 60

codecs.register_error("by_byte", lambda error: ("�" * (error.end - error.start), error.end))


@dataclass(frozen=True)
class PieceModel:
    """A model file's content. It is of fixed size, whatever the data, and goes to the tasks with the
    code."""

    content: bytes

    @classmethod
    def from_file(cls, path: str) -> PieceModel:
        with open(path, "rb") as file:
            return cls(file.read())


@cache
def codec_of(model: PieceModel) -> PieceCodec:
    """The codec of a model, kept by a worker for its later tasks."""
    return PieceCodec(model)


class ChunkTable(dict):
    """The number of each distinct chunk. A chunk that is not there gets the next number when looked
    up, and waits in ``fresh`` for its ids."""

    def __init__(self, fixed: list[int]) -> None:
        """``fixed`` are ids that have the first numbers and no chunk."""
        super().__init__()
        self.fresh: list[str] = []
        self.ids = np.array(fixed, dtype=np.uint32)
        self.starts, self.lengths = np.arange(len(fixed)), np.ones(len(fixed), dtype=np.int64)

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self.starts) + len(self.fresh)
        self.fresh.append(chunk)
        return number

    def learn(self, segment_all) -> None:
        """Enter the ids of the fresh chunks."""
        ids, starts, lengths = segment_all(self.fresh)
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.fresh = []

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks at all positions, and how many each position has."""
        starts, lengths = self.starts[numbers], self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        return self.ids[at], lengths


class PieceCodec:
    """Encodes and decodes blocks of texts; holds the chunks met so far, up to a bound."""

    def __init__(self, model: PieceModel) -> None:
        stored = sentencepiece_model_pb2.ModelProto.FromString(model.content)
        normalizer, kinds = stored.normalizer_spec, [piece.type for piece in stored.pieces]
        names = [piece.piece for piece in stored.pieces]
        if stored.trainer_spec.model_type != BPE_MODEL or not stored.trainer_spec.byte_fallback:
            raise ValueError("not a BPE model that reads unknown characters as bytes")
        if (
            normalizer.precompiled_charsmap
            or normalizer.remove_extra_whitespaces
            or not normalizer.add_dummy_prefix
            or not normalizer.escape_whitespaces
            or stored.trainer_spec.treat_whitespace_as_suffix
            or stored.HasField("denormalizer_spec")
            and stored.denormalizer_spec.precompiled_charsmap
        ):
            raise ValueError("not a model that keeps texts as they are and marks their beginning")
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("a model with user-defined or unused pieces")
        if any(re.search(f"[^{MARK}]{MARK}", name) for name, kind in zip(names, kinds) if kind == NORMAL):
            raise ValueError("a piece crosses a whitespace mark, so chunks are not independent")
        self.ids = {name: i for i, name in enumerate(names) if kinds[i] == NORMAL}
        self.costs = {name: -stored.pieces[i].score for name, i in self.ids.items()}
        of_byte = {int(name[3:5], 16): i for i, name in enumerate(names) if kinds[i] == BYTE}
        self.byte_ids = np.array([of_byte[value] for value in range(256)], dtype=np.int32)
        trainer = stored.trainer_spec
        self.fixed = [trainer.bos_id, trainer.eos_id]
        shown = {NORMAL: lambda name: name.replace(MARK, " ").encode(), CONTROL: lambda name: b""}
        shown |= {BYTE: lambda name: bytes([int(name[3:5], 16)])}
        shown |= {UNKNOWN: lambda name: trainer.unk_surface.encode()}
        self.surfaces = [shown[kind](name) for name, kind in zip(names, kinds)]
        self.at_mark = [kind == NORMAL and name.startswith(MARK) for name, kind in zip(names, kinds)]
        self.table = ChunkTable(self.fixed)
        self._index_pairs()

    def _index_pairs(self) -> None:
        """All pairs of symbols that together are a piece, by their numbers: a piece's id, or beyond
        the ids the letters that only occur inside of pieces. Other characters are negative."""
        self.letters = np.arange(-1, -0x110001, -1, dtype=np.int32)
        symbols = dict(self.ids)
        for letter in sorted({letter for name in self.ids for letter in name}):
            self.letters[ord(letter)] = symbols.setdefault(letter, len(self.surfaces) + len(symbols))
        self.symbols = max(symbols.values(), default=0) + 1
        ranks = {cost: rank for rank, cost in enumerate(sorted(set(self.costs.values())))}
        pairs = sorted(
            (symbols[name[:cut]] * self.symbols + symbols[name[cut:]], ranks[self.costs[name]], i)
            for name, i in self.ids.items()
            for cut in range(1, len(name))
            if name[:cut] in symbols and name[cut:] in symbols
        )
        table = np.array([*pairs, (np.iinfo(np.int64).max, 0, 0)], dtype=np.int64)
        self.pair_keys, self.pair_ranks, self.pair_results = np.ascontiguousarray(table.T)

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair its rank and its piece in one number, NEVER for those that don't merge."""
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.symbols + right, -1)
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(
            self.pair_keys[at] == keys, self.pair_ranks[at] << 20 | self.pair_results[at], NEVER
        )

    def segment_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of chunks, in some order, and each chunk's start and length among them.

        All chunks take a step at a time: each merges the pair with the best rank, the
        leftmost of equals. A chunk with nothing left to merge leaves. Long ones take many steps and
        are segmented on their own.
        """
        lengths = np.array(list(map(len, chunks)), dtype=np.int64)
        long = np.flatnonzero(lengths > LONG_CHUNK).tolist()
        alone = [np.array(self.segment(chunks[i]), dtype=np.int32) for i in long]
        owners, sizes, parts = [np.array(long, dtype=np.int64)], [list(map(len, alone))], [*alone]

        owner = np.flatnonzero(lengths <= LONG_CHUNK)
        length = lengths[owner]
        joined = "".join([chunks[i] for i in owner.tolist()])
        symbols = self.letters[np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")]
        # The pair that begins at a symbol, in order of merging; none at a chunk's last symbol.
        pairs = np.full(len(symbols), NEVER)
        pairs[:-1] = self._ranked(symbols[:-1], symbols[1:])
        pairs[np.cumsum(length) - 1] = NEVER
        while len(owner):
            ends = np.cumsum(length)
            starts = ends - length
            ranks = np.minimum.reduceat(pairs >> 20, starts)
            done = ranks == NEVER >> 20
            if done.any():
                leave = np.repeat(done, length)
                owners.append(owner[done])
                sizes.append(length[done])
                parts.append(symbols[leave])
                symbols, pairs, owner, length = symbols[~leave], pairs[~leave], owner[~done], length[~done]
                ranks, ends = ranks[~done], np.cumsum(length)
                starts = ends - length
                if not len(owner):
                    break
            best = np.flatnonzero(pairs >> 20 == np.repeat(ranks, length))
            of_chunk = np.searchsorted(ends, best, side="right")
            best = best[np.r_[True, of_chunk[1:] != of_chunk[:-1]]]
            symbols[best] = pairs[best] & 0xFFFFF
            stays = np.ones(len(symbols), dtype=bool)
            stays[best + 1] = False
            # The pair of what was merged away went on to the symbol behind it, if any.
            follows = best + 2 < ends
            right = symbols[np.minimum(best + 2, len(symbols) - 1)]
            pairs[best] = np.where(follows, self._ranked(symbols[best], right), NEVER)
            after = best > starts
            pairs[best[after] - 1] = self._ranked(symbols[best[after] - 1], symbols[best[after]])
            symbols, pairs, length = symbols[stays], pairs[stays], length - 1
        ids, lengths = self._as_ids(np.concatenate(parts or [symbols]), np.concatenate(sizes).astype(np.int64))
        starts, of_chunk = np.empty_like(lengths), np.concatenate(owners)
        starts[of_chunk] = np.cumsum(lengths) - lengths
        ordered = np.empty_like(lengths)
        ordered[of_chunk] = lengths
        return ids, starts, ordered

    def _as_ids(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, the letters without a piece as their bytes, with the lengths they then have."""
        bare = np.flatnonzero((symbols < 0) | (symbols >= len(self.surfaces)))
        if not len(bare):
            return symbols.astype(np.uint32), lengths
        letters = [self.letter_of(symbol) for symbol in symbols[bare].tolist()]
        each = np.ones(len(symbols), dtype=np.int64)
        each[bare] = [len(letter.encode()) for letter in letters]
        ids = np.repeat(symbols, each)
        is_bare = np.zeros(len(symbols), dtype=bool)
        is_bare[bare] = True
        read = np.frombuffer("".join(letters).encode(), dtype=np.uint8)
        ids[np.repeat(is_bare, each)] = self.byte_ids[read]
        through = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(lengths)]]
        return ids.astype(np.uint32), np.diff(through)

    def letter_of(self, symbol: int) -> str:
        return chr(-1 - symbol) if symbol < 0 else chr(int(np.flatnonzero(self.letters == symbol)[0]))

    def segment(self, chunk: str) -> list[int]:
        """A chunk's symbols. Of all neighbours that together are a piece the best scored are merged
        first, the leftmost of equals, until none are left; pairs wait in a heap."""
        costs, symbols = self.costs, list(chunk)
        size = len(symbols)
        following, preceding = list(range(1, size + 1)), list(range(-1, size - 1))
        waiting = []
        for at in range(size - 1):
            merged = symbols[at] + symbols[at + 1]
            if merged in costs:
                waiting.append((costs[merged], at, merged))
        heapify(waiting)
        while waiting:
            _, at, merged = heappop(waiting)
            gone = following[at]
            if not symbols[at] or gone == size or symbols[at] + symbols[gone] != merged:
                continue
            symbols[at], symbols[gone] = merged, ""
            after = following[at] = following[gone]
            if after < size:
                preceding[after] = at
                joined = merged + symbols[after]
                if joined in costs:
                    heappush(waiting, (costs[joined], at, joined))
            before = preceding[at]
            if before >= 0:
                joined = symbols[before] + merged
                if joined in costs:
                    heappush(waiting, (costs[joined], before, joined))
        return [
            self.ids[symbol] if symbol in self.ids else int(self.letters[ord(symbol)])
            for symbol in symbols
            if symbol
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, begin and end included, as little-endian unsigned 32-bit integers."""
        if len(self.table) > CHUNKS_KEPT or len(self.table.ids) > IDS_KEPT:
            self.table = ChunkTable(self.fixed)
        number, positions, cuts = self.table.__getitem__, array("q"), [0]
        for text in texts:
            positions.append(0)
            if text:
                chunks = CHUNK.findall(MARK + text.replace(" ", MARK))
                positions.extend(map(number, chunks))
            positions.append(1)
            cuts.append(len(positions))
        if self.table.fresh:
            self.table.learn(self.segment_all)
        ids, lengths = self.table.gather(np.frombuffer(positions, np.int64))
        through = np.r_[0, np.cumsum(lengths)][cuts] * 4
        packed = ids.astype("<u4").tobytes()
        return [packed[start:end] for start, end in zip(through.tolist(), through[1:].tolist())]

    def decode(self, packed: bytes) -> str:
        """The text of ids. The mark in front of the text goes, as does what stands for no text; a
        byte that is not part of a character reads as U+FFFD."""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        text = b"".join(map(self.surfaces.__getitem__, ids)).decode(errors="by_byte")
        first = next((i for i in ids if self.surfaces[i]), None)
        return text[1:] if first is not None and self.at_mark[first] else text


def encoded(text: Column, model: PieceModel) -> Column:
    """A text's ids, packed as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(model)
        for batch in batches:
            for texts in bounded_parts(batch, CHARS_AT_ONCE):
                yield pa.array(codec.encode(texts), pa.binary())

    return encode(text)


def decoded(packed: Column, model: PieceModel) -> Column:
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(model)
        for batch in batches:
            for part in bounded_parts(batch, CHARS_AT_ONCE):
                yield pa.array(map(codec.decode, part), pa.string())

    return decode(packed)


def _both(text: Column, model: PieceModel) -> Column:
    """Ids and the text they decode to, by one worker instead of one for each."""

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def encode_and_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(model)
        for batch in batches:
            for texts in bounded_parts(batch, CHARS_AT_ONCE):
                ids = codec.encode(texts)
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())],
                    ["ids", "decoded"],
                )

    return encode_and_decode(text)


def piece_encode(
    docs: DataFrame, model: PieceModel, text: str = "text", into: str = "ids"
) -> DataFrame:
    """The documents with their ids, begin and end included, packed in a binary column, and
    ``n_tokens``.

    Null and empty texts have the two ids alone; blanks are kept and have ids. Texts are encoded whole,
    in time near proportional to their length, and so is a chunk without any blank. Repeated rows are
    encoded alike and an empty table gives no rows. Columns that already have the two names are
    replaced, all others stay.
    """
    return docs.withColumn(into, encoded(whole_text(text), model)).withColumn(
        "n_tokens", F.expr(f"octet_length(`{into}`) DIV 4").cast("long")
    )


def piece_decode(
    docs: DataFrame, model: PieceModel, packed: str = "ids", into: str = "decoded"
) -> DataFrame:
    """The documents with the text of their ids; null ids have the empty text."""
    return docs.withColumn(into, decoded(F.coalesce(F.col(packed), F.lit(b"")), model))


def piece_round_trip(
    docs: DataFrame,
    model: PieceModel,
    text: str = "text",
    ids: str = "ids",
    decoded_text: str = "decoded",
) -> DataFrame:
    """``piece_decode`` of ``piece_encode`` with half of its workers and transfers."""
    both = _both(whole_text(text), model)
    found = docs.select(F.struct("*").alias("document"), both.alias("both"))
    columns = [name for name in docs.columns if name not in (ids, decoded_text, "n_tokens")]
    return found.select(
        *[F.col("document").getField(name).alias(name) for name in columns],
        F.col("both.ids").alias(ids),
        F.expr("octet_length(both.ids) DIV 4").cast("long").alias("n_tokens"),
        F.col("both.decoded").alias(decoded_text),
    )
