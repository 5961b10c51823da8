from __future__ import annotations

import random

import numpy as np
import pytest
from brute import ranked
from clickmetrics.llm.lexical import ImpactLists, ranked_search

ITEMS = "item_id bigint, text string, rank string, query string, term string"


def answers(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame([(*row, "r", "q", "t") for row in rows], ITEMS)

    return make


def made_up(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(draw.choices(words, weights, k=draw.randrange(1, 40)))) for i in range(n)]


@pytest.mark.parametrize("docs_at_once", [7, 32_768])
def test_like_scoring_every_document(spark, items, documents, docs_at_once):
    texts = made_up(1, 300)
    docs = documents([(i, text, "web") for i, text in texts])
    asked = made_up(2, 12)
    found = ranked_search(docs, items(asked), k=10, docs_at_once=docs_at_once, terms_at_once=50)
    assert answers(found) == sorted(ranked(texts, asked, 10), key=str)


def test_ties_rank_by_id_and_repeated_rows_stay(items, documents):
    rows = [(5, "tie here", "a"), (3, "tie here", "b"), (4, "tie here", "c"), (3, "tie here", "b"), (9, "no", "d")]
    found = ranked_search(documents(rows), items([(1, "TIE, tie!"), (2, "absent")]), k=3, docs_at_once=2)
    assert [r[:3] for r in answers(found)] == [(1, 1, 3), (1, 2, 3), (1, 3, 4)]


def test_edges(documents, edge_texts, items):
    texts = [*enumerate(edge_texts), (None, "same TEXT Ä ä"), (77, "naïve_x-ray ½")]
    docs = documents([(i, text, "s") for i, text in texts])
    asked = [(1, None), (2, ""), (3, " ,;"), (4, "same"), (4, "text é"), (None, "One 漢字 word5"), (6, "Ä x NAÏVE")]
    assert answers(ranked_search(docs, items(asked))) == sorted(ranked(texts, asked), key=str)
    long_item = [(8, " ".join(f"word{i % 977} stands" for i in range(20_000)))]
    assert answers(ranked_search(docs, items(long_item))) == sorted(ranked(texts, long_item), key=str)
    assert ranked_search(docs.limit(0), items(asked)).count() == 0
    assert ranked_search(docs, items(asked).limit(0)).count() == 0
    assert ranked_search(documents([None, ""]), items(asked)).count() == 0


def lists_of(rows, n_docs):
    terms, docs, impacts = (np.array(x) for x in zip(*rows))
    return ImpactLists(n_docs, terms, docs, impacts, int(terms.max()) + 1)


def test_reading_stops_when_all_is_certain():
    # One list decides: what is below its first documents cannot reach them.
    rows = [(0, d, 10_000 - d) for d in range(5_000)]
    lists = lists_of(rows, 5_000)
    docs, scores = lists.best(np.array([0]), 10)
    assert docs.tolist() == list(range(10)) and scores.tolist() == [10_000 - d for d in range(10)]
    assert lists.read < 200


def test_reading_goes_on_until_scores_and_ties_are_certain():
    draw = random.Random(3)
    rows = [(t, d, draw.randrange(1, 9)) for t in range(6) for d in range(900) if draw.random() < 0.4]
    lists, total = lists_of(rows, 900), np.zeros(900, dtype=int)
    for _, doc, impact in rows:
        total[doc] += impact
    expected = sorted(range(900), key=lambda d: (-total[d], d))[:25]
    docs, scores = lists.best(np.arange(6), 25)
    assert docs.tolist() == expected and scores.tolist() == total[expected].tolist()


def test_query_over_the_whole_table(spark, sf_dir):
    from clickmetrics.llm.queries import op11_lexical_search

    read = lambda name: [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    found = answers(op11_lexical_search(spark, sf_dir))
    assert found == sorted(ranked(read("documents"), read("benchmark")), key=str)
