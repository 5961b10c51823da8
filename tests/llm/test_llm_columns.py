"""Columns of any name and type go through every operator and stage as they are."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from clickmetrics import llm
from clickmetrics.llm import mixing, quality, simhash
from clickmetrics.llm.common import fields
from pyspark.sql import functions as F

NAMES = ("its_id", "its_hash", "lines", "row_hash", "plan", "a.b", "document", "place", "copies", "hash", "w`x")
ITEMS = "item_id bigint, text string"


@pytest.fixture
def odd(spark):
    """Documents with odd columns, one of them a map and one a variant, and repeated rows."""
    good = [" ".join(f"word{i}x{j} goes" for j in range(40 + i)) for i in range(6)]
    rows = [(i, text, "en", "web" if i % 2 else None, len(text)) for i, text in enumerate(good)]
    rows += [rows[0], rows[0], rows[3], (None, None, None, None, None), (7, "", "en", "web", 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    more = [F.concat(F.lit(name), F.coalesce("doc_id", F.lit(-1))).alias(name) for name in NAMES]
    tags = F.create_map(F.lit("k"), F.coalesce("text", F.lit("none"))).alias("tags")
    return frame.select("*", *more, tags, F.parse_json(F.to_json(F.struct("doc_id"))).alias("any")).repartition(3)


def as_text(frame):
    """Rows in full, in a form that can be compared."""
    whole = frame.select(F.struct("*").alias("row"))
    return sorted(r[0] for r in whole.select(F.to_json("row", {"ignoreNullFields": "false"})).collect())


def unchanged(found, odd):
    given = set(as_text(odd))
    rows = as_text(found.select(F.struct("*").alias("all")).select(*fields("all", odd.columns)))
    return set(rows) <= given and rows


def test_near_copies(odd):
    rows = unchanged(llm.drop_near_copies(odd), odd)
    assert len(rows) == len(set(rows)) == 7


def test_mix(odd):
    rows = unchanged(llm.mix_documents(odd), odd)
    plan = mixing.mix_plan(odd)
    assert len(rows) == plan.agg(F.sum("copies")).first()[0]
    by_doc = {r.doc_id: r.n for r in plan.groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
    found = {r.doc_id: r["count"] for r in llm.mix_documents(odd).groupBy("doc_id").count().collect()}
    assert found == {doc_id: n for doc_id, n in by_doc.items() if n}


def test_stages(spark, odd):
    frame = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = frame
        frame = stage(spark, frame, "unused")
        assert frame.columns == odd.columns and frame.dtypes == odd.dtypes
        assert unchanged(frame, before)
    assert corpus_pipeline.STAGES[-1][1](spark, frame, "unused").count() > 0


def test_other_operators(spark, odd):
    n = odd.count()
    vocabulary = llm.Vocabulary.from_file(public_tokenizers.path("word_bpe_49k.json"))
    model = llm.PieceModel.from_file(public_tokenizers.path("piece_bpe_32k.model"))
    items = spark.createDataFrame([(1, "word1x1 goes")], ITEMS)
    for found in (
        llm.find_secrets(odd),
        llm.judge_quality(odd),
        llm.bpe_encode(odd, vocabulary),
        llm.piece_encode(odd, model),
        llm.dedup_lines(odd, into="counted"),
        simhash.simhash_classes(odd),
        mixing.mix_plan(odd),
        llm.shard_documents(odd),
    ):
        assert found.count() == n
    assert llm.ranked_search(odd, items, k=3).count() == 3
    assert unchanged(quality.keep_good(odd), odd)


def test_the_quality_sample_stays_where_it_is(spark):
    """What is shuffled to order the rules is a row per rule and task, whatever the partitions."""
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('word ', id, ' goes on') AS text")
    for partitions in (4, 200):
        profile = quality.rule_profile(docs.repartition(partitions).cache(), sample_rows=100)
        assert [rule.name for rule, _, _ in profile] == [rule.name for rule in quality.RULES]
        assert 40 < max(rejected for *_, rejected in profile) < 200
    few = quality.rule_profile(docs.limit(7), sample_rows=100)
    assert max(rejected for *_, rejected in few) == 7
    empty = quality.rule_profile(docs.limit(0), sample_rows=100)
    assert all(rejected == 0 for *_, rejected in empty)
