from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from clickmetrics.llm.automaton import PatternError, compile_patterns, read_pattern
from clickmetrics.llm.queries import BASE_KINDS, op1_secret_scan
from clickmetrics.llm.secrets import find_secrets, scanner, span_text

PARTS = (
    "password token Secret api_key APIKEY passwd = : \" ' abc AKIA ABCDEFGHIJKLMNOPQRST == . é 漢 \n "
    "0123456789abcdef AKIA0 ffffffffffffffffffffffffffffff"
).split(" ") + [" ", "  "]


def base(text):
    return [secret for secret in scanner().find(text) if secret[0] in BASE_KINDS]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16).map("".join))
def test_base_kinds_match_plain_regular_expressions(text):
    assert base(text) == brute.secrets(text)


def test_failing_matches_use_up_their_text():
    assert base("token=token: abcdefgh") == []
    assert base("token=abc token=abcdef") == [("assign", 10, 22)]


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("private_key", "-----BEGIN RSA PRIVATE KEY-----"),
        ("code_host", "ghp_" + "a1B2" * 9),
        ("web_token", "eyJhbGci.eyJzdWIi.c2ln-_x"),
        ("bearer", "Bearer abcdefghijklmnopqrst"),
        ("url_login", "https://user:pw@"),
    ],
)
def test_further_kinds(kind, text):
    assert (kind, 3, 3 + len(text)) in scanner().find(f"ß: {text} end")


def test_plain_words_hold_no_secrets():
    assert scanner().find("The secret of the token is in the password, they said: AKIA, face, dead beef.") == []


@pytest.mark.parametrize("text", ["secret=" + "a" * 200_000, "f" * 200_000, "AKIA" * 50_000, "x" * 200_000])
def test_long_runs_take_linear_time(text):
    begun = time.perf_counter()
    assert base(text) == brute.secrets(text)
    assert time.perf_counter() - begun < 5


def test_patterns_agree_with_re():
    pieces = ["a", "b", "[ab]", "(a|bc)", "(ab|a)?", "c*", "[^b]", "b{2}", "a{1,3}", r"\x61", "c+", "(b{2,})"]
    random.seed(4)
    for _ in range(150):
        pattern = "".join(random.choice(pieces) for _ in range(random.randint(1, 5)))
        automaton = compile_patterns([read_pattern(pattern)])
        for _ in range(30):
            text = "".join(random.choice("abc") for _ in range(random.randint(0, 8)))
            ends = [n for n in range(len(text) + 1) if re.fullmatch(pattern, text[:n], re.DOTALL)]
            assert automaton.longest(text.encode(), 0) == max(ends, default=-1), (pattern, text)


@pytest.mark.parametrize("pattern", ["a)", "(a", "[a", "a{2"])
def test_bad_patterns_are_refused(pattern):
    with pytest.raises(PatternError):
        read_pattern(pattern)


def test_minimised_automata_are_small():
    assert compile_patterns([read_pattern("(a|b)(a|b)(a|b)")]).states == 5


def test_edges_and_extra_columns(documents, edge_texts):
    docs = documents([*edge_texts, "é password: hunter22", "é password: hunter22"])
    rows = find_secrets(docs, into="size").select("text", span_text(F.col("size")).alias("spans")).collect()
    assert len(rows) == len(edge_texts) + 2
    assert {r.spans for r in rows if (r.text or "").startswith("é p")} == {"assign:2:20"}
    for row in rows:
        if row.text is None or len(row.text) < 200:
            expected = [s for s in brute.secrets(row.text)]
            assert row.spans == ",".join(":".join(map(str, s)) for s in expected)


def test_empty_table(documents):
    assert find_secrets(documents(["x"]).limit(0)).count() == 0


def test_query_over_the_whole_table(spark, sf_dir):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = brute.secrets(texts[row.doc_id])
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(kind == k for k, *_ in found) for kind in BASE_KINDS
        ]
        spans = ",".join(":".join(map(str, s)) for s in found)
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(row.spans.split(","))
