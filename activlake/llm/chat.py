"""Chat formatting with a checked grammar.

A conversation becomes one text. Turns that are learned are written ``<s>role LF text</s>``, all
others ``[INST]role LF text[/INST]``. The text is parsed again by a deterministic parser; where
the turns that come back differ from the source, the turns with conflicting content are escaped,
and at last all of them, until both are identical.

The escape writes a backslash as ``\\e``, ``<`` as ``\\l``, ``[`` as ``\\b`` and a line feed inside
a role as ``\\n``. The parser always unescapes, so that a text which merely looks escaped is a
conflict as well.

Everything is built from DataFrame functions. A conversation is one output row, hence its turns
are brought together; nothing else is.

Edge cases: a null text or role is empty; turns are ordered by turn number (nulls first), ties by
role and then text; repeated rows stay repeated turns; rows with a null conversation id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, once

LOSS_ROLE = "assistant"
#: (content, code) in the order of escaping; unescaping goes backwards.
CODES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ROLE_CODE = ("\n", "\\n")
TURN = r"(?s)(\[INST\]|<s>)([^\n]*)\n(.*?)(\[/INST\]|</s>)"
CONFLICT = r"\[/INST\]|</s>|\\[elbn]"


def escape(text: Column, role: bool = False) -> Column:
    for content, code in (*CODES, *([ROLE_CODE] if role else [])):
        text = F.replace(text, F.lit(content), F.lit(code))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for content, code in reversed((*CODES, *([ROLE_CODE] if role else []))):
        text = F.replace(text, F.lit(code), F.lit(content))
    return text


def _conflicts(turn: Column) -> Column:
    return turn.text.rlike(CONFLICT) | turn.role.rlike(CONFLICT + r"|\n")


def _marked(turns: Column, escaped) -> Column:
    """The turns as they are written: opening mark, role, text and closing mark."""

    def mark(turn: Column) -> Column:
        role = F.when(escaped(turn), escape(turn.role, role=True)).otherwise(turn.role)
        text = F.when(escaped(turn), escape(turn.text)).otherwise(turn.text)
        learned = turn.role == LOSS_ROLE
        return F.struct(
            F.when(learned, "<s>").otherwise("[INST]").alias("open"),
            role.alias("role"),
            text.alias("text"),
            F.when(learned, "</s>").otherwise("[/INST]").alias("close"),
            learned.alias("learned"),
        )

    return F.transform(turns, mark)


def _written(marked: Column) -> Column:
    return F.array_join(
        F.transform(marked, lambda t: F.concat(t.open, t.role, F.lit("\n"), t.text, t.close)), ""
    )


def parse(formatted: Column) -> Column:
    """Turns read from a formatted text, as an array of role and text."""
    parts = [F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in (2, 3)]
    return F.transform(
        F.arrays_zip(parts[0].alias("role"), parts[1].alias("text")),
        lambda t: F.struct(
            unescape(t.role, role=True).alias("role"), unescape(t.text).alias("text")
        ),
    )


def format_conversations(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``formatted``, ``escaped`` (0: as it is, 1:
    conflicting turns, 2: all turns), ``identical`` and ``loss_spans``, the character ranges (end
    exclusive) of ``formatted`` to learn from."""
    empty = F.lit("")
    turns = (
        conversations.select(
            by_name(conversations, conv_id).alias("conv_id"),
            F.struct(
                by_name(conversations, turn).alias("turn"),
                F.coalesce(by_name(conversations, role).cast("string"), empty).alias("role"),
                F.coalesce(by_name(conversations, text).cast("string"), empty).alias("text"),
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select(
            "conv_id",
            F.transform("t", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias(
                "turns"
            ),
        )
    )
    # Each round is kept by the rounds after it unless its text did not parse to the source.
    rounds = (lambda t: F.lit(False), _conflicts, lambda t: F.lit(True))
    df = once(turns, marked=_marked(F.col("turns"), rounds[0]))
    df = once(df, formatted=_written(F.col("marked"))).withColumn("escaped", F.lit(0))
    for number in (1, 2):
        df = once(df, same=parse(F.col("formatted")).eqNullSafe(F.col("turns")))
        df = once(
            df,
            next_marked=F.when(F.col("same"), F.col("marked")).otherwise(
                _marked(F.col("turns"), rounds[number])
            ),
        )
        df = once(
            df,
            next_formatted=F.when(F.col("same"), F.col("formatted")).otherwise(
                _written(F.col("next_marked"))
            ),
            next_escaped=F.when(F.col("same"), F.col("escaped")).otherwise(number),
        ).select(
            "conv_id",
            "turns",
            F.col("next_marked").alias("marked"),
            F.col("next_formatted").alias("formatted"),
            F.col("next_escaped").alias("escaped"),
        )
    return df.select(
        "conv_id",
        "formatted",
        "escaped",
        parse(F.col("formatted")).eqNullSafe(F.col("turns")).alias("identical"),
        _loss_spans(F.col("marked")).alias("loss_spans"),
    )


def _loss_spans(marked: Column) -> Column:
    """Walk along the written turns; the state is the position and the spans so far."""
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )

    def step(state: Column, t: Column) -> Column:
        head = state.at + F.length(t.open) + F.length(t.role) + 1
        end = head + F.length(t.text)
        span = F.array(F.struct(head.alias("start"), end.alias("end")))
        return F.struct(
            (end + F.length(t.close)).alias("at"),
            F.when(t.learned, F.concat(state.spans, span)).otherwise(state.spans).alias("spans"),
        )

    return F.aggregate(marked, start, step, lambda s: s.spans)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, taken from the text and its loss spans alone."""
    turns = F.transform(
        parse(F.col("formatted")),
        lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")),
    )
    df = once(
        formatted,
        turns=turns,
        loss=F.array_join(
            F.transform(
                "loss_spans",
                lambda s: unescape(
                    F.substring(
                        F.col("formatted"), (s.start + 1).cast("int"), (s.end - s.start).cast("int")
                    )
                ),
            ),
            "",
        ),
    )
    return df.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: A conversation made of control strings, in every run of the query.
PROBE = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and the probe conversation -7."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return read_back(format_conversations(given.select(*own.columns).unionByName(own)))


#: The same rows: digests straight from the source, characters from the marks and the codes.
OP9_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), coded AS (
  SELECT *,
    regexp_matches(text, '\[/INST\]|</s>|\\[elbn]')
      OR regexp_matches(role, '\[/INST\]|</s>|\\[elbn]|\n') AS conflict,
    role = 'assistant' AS learned
  FROM given
), sized AS (
  SELECT *,
    length(role) + length(text) + CASE WHEN learned THEN 8 ELSE 14 END
      + CASE WHEN conflict THEN
          length(text) + length(role)
          - length(replace(replace(replace(text, '\', ''), '<', ''), '[', ''))
          - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '[', ''), chr(10), ''))
        ELSE 0 END AS chars
  FROM coded
), joined AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (learned), '') AS loss
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
