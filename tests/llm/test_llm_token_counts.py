from __future__ import annotations

import public_tokenizers
from clickmetrics.llm import token_counts as tc
from hypothesis import given, settings
from hypothesis import strategies as st

SMALL = tc.UnigramVocabulary(("▁", "a", "b", "▁a", "ab", "ba", "aba", "▁ab", "bb", "é"), -9.0)
PUBLIC = tc.UnigramVocabulary.from_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))


def plain_count(word, vocabulary):
    """Tokens of the best reading, looking at every piece before every end."""
    scores = vocabulary.scores()
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(best[end - 1][0] + width * vocabulary.byte_score, -(best[end - 1][1] + width))]
        for start in range(end):
            if word[start:end] in scores:
                score, tokens = best[start]
                options.append((score + scores[word[start:end]], -(tokens + 1)))
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1][1]


@settings(max_examples=400, deadline=None)
@given(st.sets(st.text(alphabet="abé漢▁", max_size=12), max_size=12))
def test_shared_prefixes_change_no_count(words):
    counter = tc.TrieCounter(SMALL)
    counter.learn(words)
    assert counter.counts == {word: plain_count(word, SMALL) for word in words}


def test_public_vocabulary(spark, sf_dir):
    from clickmetrics.llm.queries import op7_token_counts

    scores = PUBLIC.scores()
    assert len(scores) > 30_000
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op7_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    known: dict[str, int] = {}
    for row in rows[:60]:
        words = tc.marked_words(texts[row.doc_id] or "")
        for word in set(words) - set(known):
            known[word] = plain_count(word, PUBLIC)
        assert (row.n_words, row.n_tokens) == (len(words), sum(known[w] for w in words))


def test_counts_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(tc, "WORDS_KEPT", 2)
    counter = tc.TrieCounter(SMALL)
    for text in ("ab ba", "aba bb a", "", "ab ab"):
        assert counter.count([text])[0][1] == sum(plain_count(w, SMALL) for w in tc.marked_words(text))


def test_edges(documents, edge_texts):
    docs = documents([*edge_texts, "ab"])
    rows = tc.count_tokens(docs, SMALL, into="size").select("text", "size.*").collect()
    assert len(rows) == len(edge_texts) + 1
    for row in rows:
        words = tc.marked_words(row.text or "")
        assert row.n_words == len(words)
        if len(words) < 100 and len(row.text or "") < 100:
            assert row.n_tokens == sum(plain_count(w, SMALL) for w in words)
    assert next(r.n_tokens for r in rows if (r.text or "").startswith("xxx")) == 150_001
    assert tc.count_tokens(docs.limit(0), SMALL).count() == 0
