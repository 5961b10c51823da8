"""Quality rules as a short-circuit cascade.

A document is rejected by the first rule that it fails, so rules that reject much for little
work should come first. On a bounded sample each rule is timed and its rejections are counted; the
rules then run in the order of rejections per cost. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import whole_text

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)


class TextMeasures:
    """Measures of a text, each taken when first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text

    @cached_property
    def data(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.data) - sum(map(len, self.words)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data.translate(None, NOT_SYMBOLS))

    @cached_property
    def _lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_lines(self) -> int:
        """Lines with a word."""
        return len(self._lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self._lines) - len(set(self._lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three words that the text has more than once."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered, end = 0, 0
        for at, window in enumerate(windows):
            if counts[window] > 1:
                covered += at + 3 - max(at, end)
                end = at + 3
        return covered


@dataclass(frozen=True)
class QualityRule:
    """A named test; ``rejects`` tells whether a text with these measures goes."""

    name: str
    rejects: Callable[[TextMeasures], bool]


def _few_words(text: TextMeasures) -> bool:
    return text.n_words < 50


def _repeated_words(text: TextMeasures) -> bool:
    return 100 * text.n_repeat_words > 50 * text.n_words


def _many_symbols(text: TextMeasures) -> bool:
    return 100 * text.n_symbols > 10 * text.word_chars


def _odd_word_length(text: TextMeasures) -> bool:
    return not 2 * text.n_words <= text.word_chars <= 15 * text.n_words


def _repeated_lines(text: TextMeasures) -> bool:
    return text.n_lines > 4 and 100 * text.n_dup_lines > 50 * text.n_lines


# The rules that always hold.
BASE_RULES = (
    QualityRule("few_words", _few_words),
    QualityRule("repeated_words", _repeated_words),
)
# Rules of our own, set so wide that ordinary prose in any language passes.
MORE_RULES = (
    QualityRule("many_symbols", _many_symbols),
    QualityRule("odd_word_length", _odd_word_length),
    QualityRule("repeated_lines", _repeated_lines),
)
RULES = BASE_RULES + MORE_RULES

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = "kept boolean, rejected_by string"
REPORT = ", ".join(f"{name} bigint" for name in MEASURES) + ", base_failed boolean, " + VERDICT
ARROW_VERDICT = [("kept", pa.bool_()), ("rejected_by", pa.string())]
ARROW_REPORT = [(m, pa.int64()) for m in MEASURES] + [("base_failed", pa.bool_()), *ARROW_VERDICT]
PROFILE = "rule string, seconds double, rejected bigint, rows bigint"


def rule_profile(
    docs: DataFrame,
    rules: Sequence[QualityRule] = RULES,
    sample_rows: int = 500,
    text: str = "text",
) -> list[tuple[QualityRule, float, int]]:
    """Each rule's seconds and rejections on a sample of about ``sample_rows`` documents, or all
    of fewer.

    Every rule starts from the bare text, so its cost includes what it needs. The sample only
    decides the order. It is drawn and profiled where the documents are; a task with a
    part of it sends one row per rule, whose sums the driver gets.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(whole_text(text).alias("text")).sample(share, 1)
    rules = tuple(rules)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [value for batch in batches for value in batch.column(0).to_pylist()]
        for rule in rules if texts else ():
            begun = time.perf_counter()
            rejected = sum(rule.rejects(TextMeasures(text)) for text in texts)
            spent = time.perf_counter() - begun
            yield pa.RecordBatch.from_pylist(
                [{"rule": rule.name, "seconds": spent, "rejected": rejected, "rows": len(texts)}]
            )

    rows = (
        sample.mapInArrow(profile, PROFILE)
        .groupBy("rule")
        .agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
        .collect()
    )
    found = {row.rule: (row.seconds, row.rejected) for row in rows}
    return [(rule, *found.get(rule.name, (0.0, 0))) for rule in rules]


def cascade(profile: Sequence[tuple[QualityRule, float, int]]) -> tuple[QualityRule, ...]:
    """Rules by rejections per second, the best first; of rules that reject none, the cheap first."""
    ranked = sorted(profile, key=lambda p: (-(p[2] / max(p[1], 1e-9)), p[1], p[0].name))
    return tuple(rule for rule, _, _ in ranked)


def judged(text: Column, rules: tuple[QualityRule, ...], report: bool = False) -> Column:
    """Verdict on a text: ``kept`` and the rule it failed first, if any.

    ``report`` adds the measures of every text, rejected ones too, and whether it failed a base rule.
    """

    @F.arrow_udf(f"struct<{(REPORT if report else VERDICT).replace(' ', ': ').replace(',: ', ', ')}>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(
                [_verdict(value.as_py(), rules, report) for value in batch],
                pa.struct(ARROW_REPORT if report else ARROW_VERDICT),
            )

    return judge(text)


def _verdict(text: str, rules: tuple[QualityRule, ...], report: bool) -> dict:
    measures = TextMeasures(text)
    failed = next((rule.name for rule in rules if rule.rejects(measures)), None)
    verdict = {"kept": failed is None, "rejected_by": failed}
    if report:
        verdict |= {name: getattr(measures, name) for name in MEASURES}
        verdict["base_failed"] = any(rule.rejects(measures) for rule in BASE_RULES)
    return verdict


def judge_quality(
    docs: DataFrame,
    rules: Sequence[QualityRule] = RULES,
    text: str = "text",
    into: str = "verdict",
    report: bool = False,
    sample_rows: int = 500,
) -> DataFrame:
    """The documents with a struct column of the verdict on each.

    Null and empty texts have no words and fail the base rules; an empty table gives no rows. Very
    long texts are measured whole, in linear time. Repeated rows get equal verdicts. ``rejected_by``
    depends on the order found on the sample, which follows measured times and may differ between runs
    where rules are about equal; ``kept`` does not. A column named ``into`` is replaced.
    """
    ordered = cascade(rule_profile(docs, rules, sample_rows, text=text))
    return docs.withColumn(into, judged(whole_text(text), ordered, report))


def keep_good(docs: DataFrame, rules: Sequence[QualityRule] = RULES) -> DataFrame:
    """The documents that pass every rule, with their own columns."""
    verdict = judged(whole_text("text"), cascade(rule_profile(docs, rules)))
    return docs.filter(verdict["kept"])
