"""Token counts under a unigram vocabulary, by dynamic programming over a trie of words.

The distinct words of a partition form a trie. The best score of reading a prefix depends on the prefix
alone, so it is computed once at the trie node that all words with this prefix share; where a word
ends, its number of tokens is stored. The trie is walked depth first by sorting the words: the
scores on the path from the root stay for as many characters as the next word has in common.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import SPACES, whole_text

# Fixed values of the vocabulary's format: the mark in front of a word, and pieces for single bytes.
WORD_MARK = "▁"
BLANKS = {ord(char): " " for char in SPACES}
TEXTS_AT_ONCE = 4096
WORDS_KEPT = 500_000
BYTE_SCORE = -20.0


@dataclass(frozen=True)
class UnigramVocabulary:
    """Pieces from the most to the least likely, scored by rank as log of 1 / (rank + 2).

    A character that no piece covers reads as its UTF-8 bytes, each with ``byte_score``.
    """

    pieces: tuple[str, ...]
    byte_score: float = BYTE_SCORE

    @classmethod
    def from_sentencepiece(cls, path: str) -> UnigramVocabulary:
        """The ordinary pieces of a model file, in the file's order."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ordinary = (
            i
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        )
        return cls(tuple(model.id_to_piece(i) for i in ordinary))

    def scores(self) -> dict[str, float]:
        return {piece: -math.log(rank + 2) for rank, piece in enumerate(self.pieces)}


@cache
def counter_of(vocabulary: UnigramVocabulary) -> TrieCounter:
    """The counter of a vocabulary, kept by a worker for its later tasks."""
    return TrieCounter(vocabulary)


@dataclass
class TrieCounter:
    """Counts tokens of words; keeps the counts of words met so far, up to a bound."""

    vocabulary: UnigramVocabulary
    counts: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        """Pieces by their characters, as nested dictionaries; the score is under no character."""
        self.pieces: dict = {}
        for piece, score in self.vocabulary.scores().items():
            node = self.pieces
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = score

    def learn(self, words: set[str]) -> None:
        """Store the token counts of words, shared prefixes scored once.

        ``best`` has the forward score and tokens of each prefix on the path, ``reading`` the pieces
        that may go on from it, each with the score it began at. Of readings with equal scores
        the one with fewer tokens counts, so the count is defined.
        """
        byte_score, root = self.vocabulary.byte_score, self.pieces
        best, reading = [(0.0, 0)], [[(0.0, 0, root)]]
        before = ""
        for word in sorted(words):
            shared = len(commonprefix((before, word)))
            del best[shared + 1 :], reading[shared + 1 :]
            for char in word[shared:]:
                width = 1 if char < "\x80" else len(char.encode("utf-8", "surrogatepass"))
                top, fewest = best[-1]
                top, fewest = top + width * byte_score, fewest + width
                going = []
                for begun, tokens, node in reading[-1]:
                    node = node.get(char)
                    if node is None:
                        continue
                    going.append((begun, tokens, node))
                    score = node.get("")
                    if score is not None:
                        score += begun
                        if score > top or (score == top and tokens + 1 < fewest):
                            top, fewest = score, tokens + 1
                best.append((top, fewest))
                going.append((top, fewest, root))
                reading.append(going)
            self.counts[word] = best[-1][1]
            before = word

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """Words and tokens of each text."""
        if len(self.counts) > WORDS_KEPT:
            self.counts.clear()
        fresh: set[str] = set()
        for text in texts:
            fresh.update(marked_words(text))
        self.learn(fresh.difference(self.counts))
        found = []
        for text in texts:
            words = marked_words(text)
            found.append((len(words), sum(map(self.counts.__getitem__, words))))
        return found


def marked_words(text: str) -> list[str]:
    return [WORD_MARK + word for word in text.translate(BLANKS).split(" ") if word]


def counted(text: Column, vocabulary: UnigramVocabulary) -> Column:
    """Struct of a text's n_words and n_tokens."""

    @F.arrow_udf("struct<n_words: bigint, n_tokens: bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = counter_of(vocabulary)
        for batch in batches:
            found = []
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                found += counter.count(batch.slice(start, TEXTS_AT_ONCE).to_pylist())
            words, tokens = zip(*found) if found else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["n_words", "n_tokens"]
            )

    return count(text)


def count_tokens(
    docs: DataFrame, vocabulary: UnigramVocabulary, text: str = "text", into: str = "counts"
) -> DataFrame:
    """The documents with a struct column of ``n_words`` and ``n_tokens``.

    Words are what blanks separate, each with the word mark in front. Null and empty texts have none.
    Whole texts are counted, of any length; words of any length take time in proportion to it.
    Repeated rows count alike. A column named ``into`` is replaced, others stay as they are.
    """
    return docs.withColumn(into, counted(whole_text(text), vocabulary))
