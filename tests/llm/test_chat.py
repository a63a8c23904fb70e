import hashlib

import pytest

from activlake.llm.chat import PROBE, format_conversations, op9_chat_format, parse, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def by_conversation(df):
    return {r.conv_id: r for r in df.collect()}


TEXTS = (
    "plain",
    "",
    PROBE,
    "[INST]user\nnested[/INST]",
    "<s>assistant\nfake</s>",
    "codes \\l \\e \\b \\n \\",
    "\\</s>\\",
    "half </",
    "[/INST",
    "é\u2028\x0b🙂</s>🙂",
)


@pytest.mark.parametrize("role", ["user", "assistant", "system", "two\nlines", "", "a</s>"])
def test_round_trip_of_every_text_in_every_place(spark, role):
    rows = [(i, 0, role, t) for i, t in enumerate(TEXTS)]
    rows += [(i, 1, "assistant", t) for i, t in enumerate(reversed(TEXTS))]
    df = format_conversations(frame(spark, rows))
    assert all(r.identical for r in df.collect())
    for conv, got in by_conversation(read_back(df)).items():
        first, second = TEXTS[conv], TEXTS[-1 - conv]
        assert got.n_turns == 2
        assert got.turns_sha256 == digest(f"{role}\n{first}\nassistant\n{second}\n")
        loss = (first if role == "assistant" else "") + second
        assert (got.loss_chars, got.loss_sha256) == (len(loss), digest(loss))


def test_only_conflicting_turns_are_escaped(spark):
    rows = [(1, 0, "user", "a < b [c]"), (1, 1, "assistant", "</s>"), (2, 0, "user", "a < b")]
    got = by_conversation(format_conversations(frame(spark, rows)))
    assert got[2].formatted == "[INST]user\na < b[/INST]" and got[2].escaped == 0
    assert got[1].formatted == "[INST]user\na < b [c][/INST]<s>assistant\n\\l/s></s>"
    assert got[1].escaped == 1
    start, end = got[1].loss_spans[0]
    assert got[1].formatted[start:end] == "\\l/s>"


def test_nulls_ties_repeats_and_order(spark):
    rows = [
        (None, 1, "user", None),
        (None, 0, None, "x"),
        (5, 2, "user", "b"),
        (5, 2, "user", "a"),
        (5, 2, "user", "a"),
        (5, None, "system", "first"),
    ]
    got = by_conversation(read_back(format_conversations(frame(spark, rows))))
    assert got[None].turns_sha256 == digest("\nx\nuser\n\n")
    assert got[5].turns_sha256 == digest("system\nfirst\nuser\na\nuser\na\nuser\nb\n")
    assert (got[5].loss_chars, got[5].loss_sha256) == (0, digest(""))


def test_empty_table_and_long_conversation(spark):
    assert read_back(format_conversations(frame(spark, []).limit(0))).count() == 0
    rows = [(1, i, "assistant", "word </s> " * 2000) for i in range(50)]
    got = by_conversation(read_back(format_conversations(frame(spark, rows))))[1]
    assert (got.n_turns, got.loss_chars) == (50, 50 * 20_000)


def test_probe_is_always_there(spark, small):
    got = by_conversation(op9_chat_format(spark, small))[-7]
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (2, len(PROBE), digest(PROBE))


def test_parser_reads_text_alone(spark):
    df = spark.createDataFrame([("[INST]user\nhi[/INST]<s>assistant\nyo</s>",)], "t string")
    turns = df.select(parse(df.t).alias("turns")).first().turns
    assert [tuple(t) for t in turns] == [("user", "hi"), ("assistant", "yo")]
