"""Secret scan: all rules in one automaton, all of them found in one pass over a text's bytes.

The rules are read backward into one minimal automaton. A pass from the last byte of a
text to the first marks, for every rule, each position where a match begins. From left to right,
a rule's first mark not inside its previous match is its leftmost match, and the rule's own
automaton runs over the matched bytes once to find its end. So each rule gives its leftmost
longest matches that do not overlap, in time linear in the text, however long the match.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.automaton import Automaton, compile_patterns, read_pattern
from clickmetrics.llm.common import whole_text

SECRET_TYPE = "array<struct<kind: string, start: long, end: long>>"
ARROW_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret: ``head`` then ``body``, in ASCII. A match whose body is shorter than
    ``least`` characters is dropped, after it has used up its text."""

    kind: str
    body: str
    head: str = ""
    least: int = 1
    any_case: bool = False


# The rules whose matches are always reported, in their order.
BASE_RULES = (
    SecretRule(
        "assign",
        head=r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        body=r"[A-Za-z0-9+/_.=-]+",
        least=6,
        any_case=True,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=20),
    # As plain [0-9a-f]+ with at least 24 characters, but only long runs are marked.
    SecretRule("hex", r"[0-9a-f]{24,}", least=24),
)
# Kinds of our own, by their public formats.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("code_host", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    SecretRule("bearer", head=r"bearer\x20+", body=r"[A-Za-z0-9+/_.=~-]+", least=20, any_case=True),
    SecretRule("url_login", r"[a-z]+://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES


@dataclass(frozen=True)
class SecretScanner:
    """Compiled rules; ``find`` gives (kind, start, end) in code points, end exclusive."""

    rules: tuple[SecretRule, ...]
    marker: Automaton
    whole: tuple[Automaton, ...]
    heads: tuple[Automaton | None, ...]

    def find(self, text: str) -> list[tuple[str, int, int]]:
        data = text.encode("utf-8", "surrogatepass")
        marks = self.marker.marks_backward(data)
        if not marks:
            return []
        free_from = [0] * len(self.rules)
        found = []
        for start, mask in reversed(marks):
            while mask:
                rule = (mask & -mask).bit_length() - 1
                mask &= mask - 1
                if start < free_from[rule]:
                    continue
                end = self.whole[rule].longest(data, start)
                free_from[rule] = max(end, start + 1)
                head = self.heads[rule]
                body = start if head is None else head.longest(data, start)
                if end - body >= self.rules[rule].least:
                    found.append((start, rule, end))
        found.sort()
        return self._in_characters(found, data, len(data) == len(text))

    def _in_characters(self, found, data: bytes, plain: bool) -> list[tuple[str, int, int]]:
        if plain:
            return [(self.rules[rule].kind, start, end) for start, rule, end in found]
        offsets = {}
        byte = char = 0
        for cut in sorted({at for start, _, end in found for at in (start, end)}):
            char += len(data[byte:cut].decode("utf-8", "surrogatepass"))
            byte = cut
            offsets[cut] = char
        return [(self.rules[r].kind, offsets[start], offsets[end]) for start, r, end in found]


@cache
def scanner(rules: tuple[SecretRule, ...] = RULES) -> SecretScanner:
    """The rules compiled, once in each process."""
    trees = [read_pattern(rule.head + rule.body, rule.any_case) for rule in rules]
    return SecretScanner(
        rules,
        compile_patterns(trees, backward=True, anywhere=True),
        tuple(compile_patterns([tree]) for tree in trees),
        tuple(
            compile_patterns([read_pattern(rule.head, rule.any_case)]) if rule.head else None
            for rule in rules
        ),
    )


def secrets_in(text: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """The secrets of a text, by start and then by rule."""

    @F.arrow_udf(SECRET_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find_in = scanner(rules).find
        names = ("kind", "start", "end")
        for batch in batches:
            yield pa.array(
                [[dict(zip(names, s)) for s in find_in(text.as_py() or "")] for text in batch],
                ARROW_TYPE,
            )

    return find(text)


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    into: str = "secrets",
    rules: tuple[SecretRule, ...] = RULES,
) -> DataFrame:
    """The documents with a column of the secrets found in their whole texts.

    A null or empty text has none. Texts are scanned where they are, without a shuffle. Very long
    texts take time in proportion to their length; repeated rows are scanned each. A column
    already named ``into`` is replaced.
    """
    return docs.withColumn(into, secrets_in(whole_text(text), rules))


def span_text(secrets: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Secrets as ``kind:start:end``, comma-joined, all of them or those of some kinds."""
    chosen = secrets if kinds is None else F.filter(secrets, lambda s: s["kind"].isin(*kinds))
    shown = F.transform(
        chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(shown, ",")


def count_of(secrets: Column, kind: str) -> Column:
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")
