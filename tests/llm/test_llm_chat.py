from __future__ import annotations

import pytest
from brute import chat
from clickmetrics.llm.chat import format_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, thread string, position string"


@pytest.fixture
def formatted(spark):
    def run(rows):
        frame = spark.createDataFrame([(*row, "t", "p") for row in rows], SCHEMA)
        return {
            (r.conv_id, r.turn): r
            for r in format_conversations(frame).orderBy("conv_id", "position").collect()
        }

    return run


def test_replies_stand_behind_what_they_quote(formatted):
    found = formatted(
        [
            (1, 0, "user", "Hello there\nfriend\n\nHow are you?"),
            (1, 1, "assistant", "other topic"),
            (1, 2, "assistant", "> hello  there friend\nFine\n>> nope\n> How are you?\n\n\n\nBye"),
            (1, 3, "user", ">> How are you?\n> Fine\nGood"),
            (1, 4, "user", "> other topic\nyes"),
        ]
    )
    assert list(found) == [(1, 0), (1, 2), (1, 3), (1, 1), (1, 4)]
    assert [r.position for r in found.values()] == [0, 1, 2, 3, 4]
    assert [r.reply_to for r in found.values()] == [None, 0, 2, None, 1]
    assert [r.thread for r in found.values()] == [0, 0, 0, 1, 1]
    assert (found[1, 2].n_quotes, found[1, 2].n_linked) == (3, 2)
    assert found[1, 2].content == "Fine\n>> nope\n\n\n\nBye"
    assert found[1, 4].chat == "<|user|>\nyes\n"


def test_quotes_link_within_a_conversation_and_backward_only(formatted):
    found = formatted(
        [
            (1, 0, "user", "alpha"),
            (2, 0, "user", "> alpha\nx"),
            (3, 0, "user", "> later\ny"),
            (3, 1, "user", "later"),
        ]
    )
    assert all(r.reply_to is None and r.n_linked == 0 for r in found.values())


def test_the_first_saying_is_the_original(formatted):
    found = formatted([(1, i, "user", "thanks") for i in range(3)] + [(1, 3, "user", "> thanks\nok")])
    assert found[1, 3].reply_to == 0


def test_long_chains(formatted):
    rows = [(7, 0, "user", "start 0")] + [
        (7, i, "user", f"> start {i - 1}\nstart {i}") for i in range(1, 70)
    ]
    found = formatted(rows)
    assert {r.thread for r in found.values()} == {0}
    assert [found[7, i].reply_to for i in range(1, 70)] == list(range(69))


def test_deep_levels_and_spaced_marks(formatted):
    found = formatted([(1, 0, "a", "deep"), (1, 1, "b", " > > >deep\r\n>\nnot\n")])
    assert found[1, 1].reply_to == 0
    assert found[1, 1].content == "not\n"


def test_edges(spark):
    rows = [
        (None, 0, "user", "x"), (1, None, "user", "y"), (1, 0, None, None), (1, 0, "user", "twice"),
        (1, 0, "user", "twice"), (1, 1, "user", ""), (1, 2, "user", "> twice\n" + "long " * 40_000),
    ]
    frame = spark.createDataFrame([(*row, "t", "p") for row in rows], SCHEMA)
    found = format_conversations(frame).collect()
    assert len(found) == len(rows)
    assert [r.position for r in found if r.conv_id is None or r.turn is None] == [None, None]
    assert sorted(r.position for r in found if r.turn == 0 and r.conv_id == 1) == [0, 0, 0]
    last = next(r for r in found if r.turn == 2)
    assert (last.position, last.reply_to) == (3, 0)
    assert next(r for r in found if r.role == "unknown").chat == "<|unknown|>\n\n"
    assert format_conversations(frame.limit(0)).count() == 0


KEPT = [
    "def f(x):\n    if x:\n        return 1\n\n\n    return 2\n",
    ">>> f(1)\n1\n>>> f(2)",
    "As they say:\n\n> a quote of something else\n> over two lines\n\nso it is  ",
    "\n\n  indented\t\n\n\n\nend\n\n",
    "dos\r\nlines\r\n\r\n> x\r\n",
    ">\n> \n>>\n", " > ", "", "\n", "\t",
]


@pytest.mark.parametrize("text", KEPT)
def test_a_message_without_linked_quotes_is_its_text(formatted, text):
    found = formatted([(1, 0, "user", "another thing"), (1, 1, "user", text), (1, 2, "user", text)])
    assert found[1, 1].content == found[1, 2].content == text
    assert found[1, 1].n_linked == 0


def test_only_linked_lines_go(formatted):
    found = formatted(
        [
            (1, 0, "a", "first thing\n\nsecond  Thing\r\nwrapped"),
            (1, 1, "b", "> first thing\n>\n> not said\n>\n> second thing wrapped\n>\n\n  code\n> first thing\n"),
        ]
    )
    assert found[1, 1].content == "> not said\n>\n\n  code\n"
    assert (found[1, 1].n_quotes, found[1, 1].n_linked, found[1, 1].reply_to) == (3, 2, 0)


def test_rows_of_one_place_lose_their_own_quotes(formatted, spark):
    rows = [(1, 0, "a", "said"), (1, 1, "b", "> said\nx"), (1, 1, "b", "y\n> said"), (1, 1, "b", "plain")]
    frame = spark.createDataFrame([(*row, "t", "p") for row in rows], SCHEMA)
    assert sorted(r.content for r in format_conversations(frame).filter("turn = 1").collect()) == ["plain", "x", "y"]


def test_long_texts_take_time_in_proportion(formatted):
    said = "\n\n".join(f"thing {i}" for i in range(15_000))
    quote = "\n".join(f"> thing {i}\n" + (f">> thing {i}\n" if i % 3 else "own\n") for i in range(15_000))
    found = formatted([(1, 0, "a", said), (1, 1, "b", quote)])
    assert found[1, 1].content.replace("\n", "") == "own" * 5_000
    assert found[1, 1].n_linked == 25_000


def quoting(texts):
    """Messages of a conversation, of which each quotes earlier ones, some nested, some wrapped anew."""
    written = []
    for turn, text in enumerate(texts):
        lines = [line for line in text.split("\n")]
        if turn >= 1:
            quoted = written[turn - 1].split("\n")[:6]
            lines = [f"> {line}" for line in quoted] + [""] + lines
        if turn >= 2:
            lines += [">> " + " ".join(texts[turn - 2].split("\n\n")[0].upper().split()), "> never said"]
        written.append("\n".join(lines))
    return written


def test_whole_table_of_messages_that_quote_each_other(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    texts = {}
    for row in given:
        texts.setdefault(row.conv_id, []).append(row)
    rows = [
        (row.conv_id, row.turn, row.role, text)
        for said in texts.values()
        for row, text in zip(said, quoting([r.text for r in said]))
    ]
    found = format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    names = ("conv_id", "position", "thread", "turn", "reply_to", "n_quotes", "n_linked", "content")
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(chat(rows))
    assert found.agg({"n_linked": "sum"}).first()[0] > 300


def test_only_dataframe_functions(spark, sf_dir):
    from clickmetrics.llm.queries import op3_chat_format

    frame = op3_chat_format(spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert frame.count() == given.count()
