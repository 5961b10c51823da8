"""BPE encoding and decoding with an index of where each pair occurs.

The distinct words of a partition lie one after the other in an array of symbols. An index maps
each pair of neighbouring symbols, by its rank in the vocabulary, to all its positions. Active ranks are
taken in ascending order: all positions of the pair are merged at once, and the pairs that arise beside
them join the index. A word's codes are then kept and used for all its occurrences.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickmetrics.llm.common import whole_text

#: Bytes of a batch that a task works on at a time, but for a single longer text.
BYTES_AT_ONCE = 2_000_000

#: Characters of new words that are indexed together, and the number of words kept, at most.
CHARS_AT_ONCE = 1_000_000
WORDS_KEPT = 250_000
POSITIONS_AT_ONCE = 250_000

# The normalisers and the splitting pattern of the files for which words of plain
# Western letters are cut without the library, and those letters, digits and signs.
PLAIN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_CHUNK = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PLAIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file's content. It is of fixed size, whatever the data, and goes to the tasks
    with the code. The file's own normaliser and splitter cut text into words."""

    content: str

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())


@cache
def encoder_of(vocabulary: Vocabulary) -> PairIndexEncoder:
    """The encoder of a vocabulary, kept by a worker for its later tasks."""
    return PairIndexEncoder(vocabulary)


@cache
def decoder_of(vocabulary: Vocabulary) -> TokenDecoder:
    """The decoder of a vocabulary, which needs no merges, kept likewise."""
    return TokenDecoder(vocabulary)


class TokenDecoder:
    """Decodes ids; holds the tokens only."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        stored = json.loads(vocabulary.content)
        if stored["decoder"]:
            raise ValueError("not a vocabulary whose tokens are joined by blanks")
        names = stored["model"]["vocab"] | {
            token["content"]: token["id"] for token in stored["added_tokens"]
        }
        self.tokens = [""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.tokens[number] = name

    def decode(self, packed: bytes) -> str:
        """Tokens of the ids, special ones too, joined by blanks."""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return " ".join(map(self.tokens.__getitem__, ids))


@dataclass
class PairIndexEncoder:
    """Encodes texts; holds the codes of words met so far, up to a bound."""

    vocabulary: Vocabulary
    codes: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        stored = json.loads(self.vocabulary.content)
        model = stored["model"]
        unsupported = {
            name: model.get(name)
            for name in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "fuse_unk")
            if model.get(name)
        }
        if model["type"] != "BPE" or unsupported or stored["decoder"] or stored["post_processor"]:
            raise ValueError(f"not a plain BPE vocabulary: {unsupported}")
        library = Tokenizer.from_str(self.vocabulary.content)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        normalizers = [step["type"] for step in stored["normalizer"].get("normalizers", ())]
        steps = stored["pre_tokenizer"].get("pretokenizers", [{}])
        self.plain = normalizers == PLAIN_NORMALIZERS and (
            steps[0].get("pattern") == {"Regex": PLAIN_PATTERN}
        )
        # The letters that stand for the bytes of plain letters beyond ASCII.
        self.byte_letters = {
            ord(char): self.split(char)[0][0] for char in "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
        } if self.plain else {}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids = model["vocab"]
        self.special = {token["content"]: token["id"] for token in stored["added_tokens"]}
        marks = sorted(self.special, key=len, reverse=True)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        letters = [name for name in self.ids if len(name) == 1]
        self.first_symbols = np.zeros(max(map(ord, letters)) + 1, dtype=np.int32)
        self.last_symbols = self.first_symbols.copy()
        for letter in letters:
            self.first_symbols[ord(letter)] = self.ids[letter]
            self.last_symbols[ord(letter)] = self.ids[letter + self.suffix]
        self._read_merges(model["merges"])

    def _read_merges(self, merges) -> None:
        pairs = [tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")) for pair in merges]
        left = np.array([self.ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([self.ids[b] for _, b in pairs], dtype=np.int64)
        self.rank_left, self.rank_right = left, right
        self.rank_result = np.array([self.ids[a + b] for a, b in pairs], dtype=np.int32)
        keys = (left << 32) | right
        self.key_order = np.argsort(keys)
        self.keys = keys[self.key_order]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for pairs that never merge."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_order[at], -1)

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The packed codes of words, none of them empty, in the letters that stand for bytes."""
        lengths = np.array(list(map(len, words)), dtype=np.int32)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        symbols = self.first_symbols[letters]
        size = len(symbols)
        if not size:
            return []
        ends = np.cumsum(lengths, dtype=np.int32)
        symbols[ends - 1] = self.last_symbols[letters[ends - 1]]
        following = np.arange(1, size + 1, dtype=np.int32)
        following[ends - 1] = -1
        preceding = np.arange(-1, size - 1, dtype=np.int32)
        preceding[ends - lengths] = -1
        alive = np.ones(size, dtype=bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray) -> None:
            ranks = self._ranks(symbols[positions], symbols[following[positions]])
            positions, ranks = positions[ranks >= 0], ranks[ranks >= 0]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            first = np.r_[0, np.flatnonzero(np.diff(ranks)) + 1]
            cuts = [*first.tolist(), len(ranks)]
            for rank, start, end in zip(ranks[first].tolist(), cuts, cuts[1:]):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(positions[start:end])

        del letters
        for start in range(0, size, POSITIONS_AT_ONCE):
            part = np.flatnonzero(following[start : start + POSITIONS_AT_ONCE] >= 0) + start
            enter(part.astype(np.int32))
        while active:
            rank = heapq.heappop(active)
            at = _sorted_once(index.pop(rank))
            left, right = self.rank_left[rank], self.rank_right[rank]
            after = following[at]
            at = at[alive[at] & (after >= 0) & (symbols[at] == left) & (symbols[after] == right)]
            if left == right:
                at = _not_overlapping(at, following)
            if not len(at):
                continue
            gone = following[at]
            beyond = following[gone]
            symbols[at] = self.rank_result[rank]
            alive[gone] = False
            following[at] = beyond
            preceding[beyond[beyond >= 0]] = at[beyond >= 0]
            before = preceding[at]
            enter(_sorted_once([before[before >= 0], at[beyond >= 0]]))

        packed = symbols[alive].astype("<u4").tobytes()
        cuts = [0, *(np.cumsum(alive, dtype=np.int32)[ends - 1] * 4).tolist()]
        return [packed[start:end] for start, end in zip(cuts, cuts[1:])]

    def _pieces(self, chunk: str) -> list[str | int]:
        """A stretch without blanks as special ids and words."""
        if self.plain and PLAIN_CHUNK.fullmatch(chunk) and "<|" not in chunk:
            lower = chunk.lower()
            words = [lower] if lower.isalpha() else PLAIN_WORD.findall(lower)
            return words if chunk.isascii() else [word.translate(self.byte_letters) for word in words]
        parts = self.cut_special.split(chunk) if self.cut_special else [chunk]
        found: list[str | int] = []
        for part in parts:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                found += [word for word, _ in self.split(self.normalize(part)) if word]
        return found

    def learn(self, chunks: set[str]) -> None:
        """Encode stretches not met before, all of them over one index."""
        pieces = {chunk: self._pieces(chunk) for chunk in chunks}
        words = list({word for parts in pieces.values() for word in parts if isinstance(word, str)})
        codes = dict(zip(words, self.merge_words(words)))
        for number in self.special.values():
            codes[number] = np.array([number], dtype="<u4").tobytes()
        for chunk, parts in pieces.items():
            self.codes[chunk] = b"".join(map(codes.__getitem__, parts))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        for group in self._learned(texts):
            for text in group:
                yield b"".join(map(self.codes.__getitem__, _chunks(text)))

    def _learned(self, texts: Iterable[str]) -> Iterator[list[str]]:
        """Groups of texts, all of whose words are known. The new words of a group are bounded, but
        for those of a single text."""
        if len(self.codes) > WORDS_KEPT:
            self.codes.clear()
        group, fresh, size = [], set(), 0
        for text in texts:
            new = set(_chunks(text)).difference(self.codes, fresh)
            if group and size + sum(map(len, new)) > CHARS_AT_ONCE:
                self.learn(fresh)
                yield group
                if len(self.codes) > WORDS_KEPT:
                    self.codes.clear()
                group, fresh, size = [], set(), 0
                new = set(_chunks(text)).difference(self.codes)
            group.append(text)
            fresh |= new
            size += sum(map(len, new))
        if fresh:
            self.learn(fresh)
        yield group


def _sorted_once(positions: list[np.ndarray]) -> np.ndarray:
    joined = np.sort(np.concatenate(positions))
    return joined[np.r_[True, joined[1:] != joined[:-1]]] if len(joined) else joined


def _not_overlapping(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions in order where a symbol pairs with itself, those that merge from the left."""
    kept, used = [], -1
    for position, after in zip(at.tolist(), following[at].tolist()):
        if position != used:
            kept.append(position)
            used = after
    return np.array(kept, dtype=np.int32)


def _chunks(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


def _parts(batch: pa.Array) -> Iterator[list]:
    """The values of a batch, a bounded part at a time."""
    part, size = [], 0
    for value in batch:
        part.append(value.as_py())
        size += len(part[-1])
        if size >= BYTES_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def encoded(text: Column, vocabulary: Vocabulary) -> Column:
    """A text's ids, packed as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            for texts in _parts(batch):
                yield pa.array(encoder.encode(texts), pa.binary())

    return encode(text)


def decoded(packed: Column, vocabulary: Vocabulary) -> Column:
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = decoder_of(vocabulary)
        for batch in batches:
            for part in _parts(batch):
                yield pa.array(map(decoder.decode, part), pa.string())

    return decode(packed)


def _both(text: Column, vocabulary: Vocabulary) -> Column:
    """Ids and the text they decode to, by one worker instead of one for each."""

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def encode_and_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = encoder_of(vocabulary), decoder_of(vocabulary)
        for batch in batches:
            for texts in _parts(batch):
                ids = list(encoder.encode(texts))
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(map(decoder.decode, ids), pa.string())],
                    ["ids", "decoded"],
                )

    return encode_and_decode(text)


def bpe_round_trip(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    ids: str = "ids",
    decoded_text: str = "decoded",
) -> DataFrame:
    """``bpe_decode`` of ``bpe_encode`` with half of its workers and transfers."""
    both = _both(whole_text(text), vocabulary)
    found = docs.select(F.struct("*").alias("document"), both.alias("both"))
    columns = [name for name in docs.columns if name not in (ids, decoded_text, "n_tokens")]
    return found.select(
        *[F.col("document").getField(name).alias(name) for name in columns],
        F.col("both.ids").alias(ids),
        F.expr("octet_length(both.ids) DIV 4").cast("long").alias("n_tokens"),
        F.col("both.decoded").alias(decoded_text),
    )


def bpe_encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids"
) -> DataFrame:
    """The documents with their ids packed in a binary column, and ``n_tokens``.

    Null and empty texts, and texts of blanks, have no ids. Texts are encoded whole; very long
    ones, and words of any length, take time in proportion to their length. Repeated rows are
    encoded alike. Columns that already have the two names are replaced. ``unpacked`` gives the
    ids as an array.
    """
    return docs.withColumn(into, encoded(whole_text(text), vocabulary)).withColumn(
        "n_tokens", F.expr(f"octet_length(`{into}`) DIV 4").cast("long")
    )


def bpe_decode(
    docs: DataFrame, vocabulary: Vocabulary, packed: str = "ids", into: str = "decoded"
) -> DataFrame:
    """The documents with the text of their ids."""
    return docs.withColumn(into, decoded(F.coalesce(F.col(packed), F.lit(b"")), vocabulary))


def unpacked(packed: Column) -> Column:
    """Packed ids as an array of longs."""

    @F.arrow_udf("array<bigint>")
    def unpack(batch: pa.Array) -> pa.Array:
        return pa.array(
            [np.frombuffer(ids.as_py() or b"", dtype="<u4").tolist() for ids in batch],
            pa.list_(pa.int64()),
        )

    return unpack(packed)
