from __future__ import annotations

import brute
from clickmetrics.llm import quality
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abé漢 \n\t\x0b\xa0#%", max_size=60))
def test_measures_match_plain_ones(text):
    found = quality.TextMeasures(text)
    assert {name: getattr(found, name) for name in (*quality.MEASURES, "n_lines")} == brute.measures(text)


def prose(n=80):
    return " ".join(f"some{i} words" for i in range(n // 2))


CASES = {
    "few_words": "too few words here",
    "repeated_words": "again and once more " * 40,
    "many_symbols": prose() + " ###$$$%%% <<<>>>" * 30,
    "odd_word_length": " ".join(f"a{i}" + "x" * 40 for i in range(60)),
    "repeated_lines": "\n".join([prose(60)] + [f"line {i % 9}" for i in range(40)]),
}


def test_each_rule_rejects_its_case(documents):
    names = {rule.name: rule for rule in quality.RULES}
    assert set(CASES) == set(names)
    for name, text in CASES.items():
        assert names[name].rejects(quality.TextMeasures(text)), name
    assert not any(rule.rejects(quality.TextMeasures(prose())) for rule in quality.RULES)


def test_the_order_changes_no_verdict(documents):
    docs = documents([*CASES.values(), prose(), None, ""])
    verdicts = []
    for rules in (quality.RULES, quality.RULES[::-1]):
        verdict = quality.judged(quality.whole_text("text"), rules)
        verdicts.append(sorted(docs.select("doc_id", verdict["kept"]).collect()))
    assert verdicts[0] == verdicts[1]
    assert [kept for _, kept in verdicts[0]] == [False] * 5 + [True, False, False]


def test_cascade_orders_by_rejections_per_cost():
    a, b, c, d = (quality.QualityRule(name, lambda t: False) for name in "abcd")
    profile = [(a, 1.0, 10), (b, 0.1, 5), (c, 0.2, 0), (d, 0.1, 0)]
    assert quality.cascade(profile) == (b, a, d, c)


def test_the_sample_is_bounded_and_profiled(documents):
    docs = documents(["one two"] * 300)
    profile = quality.rule_profile(docs, sample_rows=20)
    assert [rule.name for rule, _, _ in profile] == [rule.name for rule in quality.RULES]
    assert 5 <= profile[0][2] <= 60
    assert quality.rule_profile(docs.limit(0))[0][1:] == (0.0, 0)


def test_edges(documents, edge_texts):
    docs = documents([*edge_texts, prose(), prose()])
    rows = quality.judge_quality(docs, into="size", report=True).select("text", "size.*").collect()
    assert len(rows) == len(edge_texts) + 2
    for row in rows:
        expected = brute.measures(row.text)
        assert {name: row[name] for name in quality.MEASURES} == {
            name: expected[name] for name in quality.MEASURES
        }
        assert row.kept == brute.kept(row.text)
        assert row.kept == (row.rejected_by is None)
        assert row.base_failed <= (not row.kept)
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    assert sorted(r.text for r in good.collect()) == sorted(r.text for r in rows if r.kept)
    assert quality.keep_good(docs.limit(0)).count() == 0
