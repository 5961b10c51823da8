"""Ranked lexical search with sequential reads of impact-sorted lists (NRA, no random access).

Each shard of documents has a list per query term: its documents by falling impact, which is what the
term adds to a document's score. A query reads its lists from the top, all to the same depth. What
has been read of a document is its score's lower bound; the impacts last read in the lists where it has
not been met bound the rest. Reading goes on until the best documents, ties among them and
their scores are certain. The best of the shards are then ranked together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.llm.common import lower_ascii, whole_text, written

# Fixed values of terms and scores: ASCII letters and digits and all that is not ASCII, over characters
# and over bytes; the scale of weights and impacts; how a document's length counts.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WEIGHT_SCALE, IMPACT_SCALE, SATURATION, LENGTH_PERCENT = 1000, 1_000_000_000, 20, 50

#: Terms of queries that the driver and a task hold at a time; more are answered in rounds.
QUERY_TERMS_AT_ONCE = 1_000_000
#: What a shard of documents holds at most, but for a single document.
DOCS_AT_ONCE, POSTINGS_AT_ONCE = 32_768, 1_500_000
#: Depth of the first read of a query's lists; it doubles with each.
FIRST_READ = 64

COUNTED_SCHEMA = "doc_id bigint, n_terms bigint, terms array<int>, counts array<int>"
FOUND_SCHEMA = "query int, doc_id bigint, score bigint"


def distinct_terms(text: str) -> Column:
    """The terms of a text column, once each."""
    found = F.regexp_extract_all(lower_ascii(whole_text(text)), F.lit(TERM), F.lit(0))
    return F.array_distinct(found)


@dataclass
class Queries:
    """Queries of one round: ids, and the numbers of their terms in the list of all their terms."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: list[str]

    @classmethod
    def of(cls, rows) -> Queries:
        numbers: dict[str, int] = {}
        of_query: dict = {}
        for query_id, term in rows:
            of_query.setdefault(query_id, []).append(numbers.setdefault(term, len(numbers)))
        terms = [np.array(sorted(found), dtype=np.int64) for found in of_query.values()]
        return cls(list(of_query), terms, list(numbers))


def counted_terms(docs: DataFrame, vocabulary: Broadcast, text: str, doc_id: str) -> DataFrame:
    """Per document with a term: its number of terms, and which terms of the vocabulary it has how
    often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = {term.encode(): i for i, term in enumerate(vocabulary.value)}.get
        for batch in batches:
            kept, totals, terms, counts = [], [], [], []
            for row, value in enumerate(batch.column(1)):
                found = TERM_BYTES.findall(value.as_py().encode().lower())
                if found:
                    known = Counter(map(number_of, found))
                    known.pop(None, None)
                    kept.append(row)
                    totals.append(len(found))
                    terms.append(list(known))
                    counts.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept, pa.int64())),
                    pa.array(totals, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_terms", "terms", "counts"],
            )

    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole_text(f"`{text}`"))
    return narrow.mapInArrow(count, COUNTED_SCHEMA)


@dataclass(frozen=True)
class Corpus:
    """What scores need from the whole table: its documents with a term, all their terms, and the
    weight of each term of the vocabulary."""

    documents: int
    terms: int
    weights: np.ndarray

    @classmethod
    def of(cls, counted: DataFrame, vocabulary: int) -> Corpus:
        """The table's statistics; the driver gets one number for each term of the vocabulary."""
        total = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n_terms").alias("terms")).first()
        having = np.zeros(vocabulary, dtype=np.int64)
        frequencies = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
        for term, documents in frequencies.collect():
            having[term] = documents
        weights = [
            math.floor(WEIGHT_SCALE * math.log((2 * total.n + 2) / (2 * n + 1))) for n in having.tolist()
        ]
        return cls(total.n, total.terms or 0, np.array(weights, dtype=np.int64))

    def impacts(self, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What each posting adds to its document's score."""
        length = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * sizes * self.documents) // self.terms
        return self.weights[terms] * (IMPACT_SCALE * counts // (1000 * counts + SATURATION * length))


class ImpactLists:
    """The impact-sorted lists of a shard. Documents are numbered in the order in which ties rank."""

    def __init__(
        self, n_docs: int, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int
    ) -> None:
        some = impacts > 0
        terms, docs, impacts = terms[some], docs[some], impacts[some]
        order = np.lexsort((docs, -impacts, terms))
        self.n_docs, self.docs, self.impacts = n_docs, docs[order], impacts[order]
        bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.starts, self.lengths = bounds[:-1], np.diff(bounds)
        #: How many postings the queries so far have read; tests look at it.
        self.read = 0

    def best(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents with a score, best first, and their scores, fully resolved."""
        terms = terms[self.lengths[terms] > 0]
        starts, lengths = self.starts[terms], self.lengths[terms]
        lower = np.zeros(self.n_docs)
        open_ = np.ones(self.n_docs, dtype=bool)  # documents that may still be among the best
        met_docs, met_lists = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        depth, upto = 0, FIRST_READ
        while len(terms):
            first, end = np.minimum(depth, lengths), np.minimum(upto, lengths)
            sizes = end - first
            lists = np.repeat(np.arange(len(terms)), sizes)
            at = np.arange(len(lists)) + np.repeat(starts + first - (np.cumsum(sizes) - sizes), sizes)
            self.read += len(at)
            wanted = open_[self.docs[at]]
            at, lists = at[wanted], lists[wanted]
            lower += np.bincount(self.docs[at], self.impacts[at], self.n_docs)
            met_docs, met_lists = [*met_docs, self.docs[at]], [*met_lists, lists]
            # No unread posting of a list has more than the last one read; a list at its end has none.
            most = np.where(end < lengths, self.impacts[starts + end - 1], 0)
            met = most[np.concatenate(met_lists)]
            known = np.bincount(np.concatenate(met_docs), met.astype(float), self.n_docs)
            upper = lower + (most.sum() - known)
            bound = 1.0
            if self.n_docs > k:
                bound = max(bound, np.partition(lower, self.n_docs - k)[self.n_docs - k])
            open_ &= upper >= bound
            if (upper[open_] == lower[open_]).all():
                break
            depth, upto = upto, 2 * upto
        found = np.flatnonzero(open_ & (lower > 0))
        found = found[np.lexsort((found, -lower[found]))][:k]
        return found, lower[found].astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch], docs_at_once: int) -> Iterator[pa.Table]:
    """Documents in parts that a task holds at a time."""
    parts, docs, postings = [], 0, 0
    for batch in batches:
        through = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < len(batch):
            before = through[start - 1] if start else 0
            fits = int(np.searchsorted(through, before + POSTINGS_AT_ONCE - postings, side="right"))
            end = min(len(batch), start + docs_at_once - docs, max(fits, start + (not parts)))
            if end > start:
                parts.append(batch.slice(start, end - start))
                docs, postings, start = docs + end - start, postings + through[end - 1] - before, end
            if start < len(batch):
                yield pa.Table.from_batches(parts)
                parts, docs, postings = [], 0, 0
    if parts:
        yield pa.Table.from_batches(parts)


def _lists(shard: pa.Table, corpus: Corpus) -> tuple[ImpactLists, pa.Array]:
    """A shard's lists, and its documents' ids by number."""
    shard = shard.combine_chunks().sort_by([("doc_id", "ascending")]).combine_chunks()
    terms, counts = shard["terms"].combine_chunks(), shard["counts"].combine_chunks()
    each = terms.value_lengths().to_numpy(zero_copy_only=False)
    docs = np.repeat(np.arange(len(shard)), each)
    numbers, counted = (x.flatten().to_numpy().astype(np.int64) for x in (terms, counts))
    impacts = corpus.impacts(numbers, counted, shard["n_terms"].to_numpy()[docs])
    lists = ImpactLists(len(shard), numbers, docs, impacts, len(corpus.weights))
    return lists, shard["doc_id"].combine_chunks()


def best_of_shards(
    counted: DataFrame, queries: Broadcast, corpus: Broadcast, k: int, docs_at_once: int = DOCS_AT_ONCE
) -> DataFrame:
    """Each query's k best of each shard of documents."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, docs_at_once):
            lists, doc_ids = _lists(shard, corpus.value)
            for query, terms in enumerate(queries.value):
                docs, scores = lists.best(terms, k)
                number = pa.array(np.full(len(docs), query, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [number, doc_ids.take(pa.array(docs)), pa.array(scores)], ["query", "doc_id", "score"]
                )

    return counted.mapInArrow(search, FOUND_SCHEMA)


def _answered(
    docs: DataFrame, queries: Queries, k: int, text: str, doc_id: str, docs_at_once: int
) -> DataFrame:
    """The answers to the queries of one round."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    counted = written(counted_terms(docs, send(queries.vocabulary), text, doc_id), "counted-terms")
    corpus = Corpus.of(counted, len(queries.vocabulary))
    found = best_of_shards(counted, send(queries.terms), send(corpus), k, docs_at_once)
    by_rank = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)
    ids = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id bigint")
    return ranked.join(ids, "query").select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    docs_at_once: int = DOCS_AT_ONCE,
    terms_at_once: int = QUERY_TERMS_AT_ONCE,
) -> DataFrame:
    """For each item the k documents with the highest scores: item_id, rank from 1, doc_id, score.

    Terms are the maximal runs of ASCII letters and digits and of anything beyond ASCII, with A-Z
    lower-cased; a null text has none. Documents without a term do not count. A term has a weight
    by its rareness, a document's score adds up its impacts of the item's terms, once each, in whole numbers.
    Documents of score 0 are left out, equal scores rank by doc_id, a null doc_id first; documents
    are rows, so repeated rows rank one after the other. Rows of items with one item_id are one item
    with all their terms. Items without terms, and an empty table on either side, give no rows. Whole
    texts count, however long. Other columns play no part.

    Documents are not shuffled: each task counts the items' terms in its own and later ranks them in
    shards of at most ``docs_at_once`` documents. ``terms_at_once`` terms of items are held at a time; more
    items are answered in rounds, each with its own reading of the documents.
    """
    asked = items.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"),
        F.explode(distinct_terms(f"`{text}`")).alias("term"),
    ).distinct()
    asked = written(asked, "query-terms")
    rounds = max(1, -(-asked.count() // terms_at_once))
    answers = None
    for number in range(rounds):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == number)
        found = _answered(docs, Queries.of(part.collect()), k, text, doc_id, docs_at_once)
        answers = found if answers is None else answers.unionByName(found)
    return answers
