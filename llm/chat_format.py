"""Chat formatting from event logs with built-in functions only (operator 4).

A log is folded before it is rendered. Events of a conversation are ordered by turn and
sequence; ``message`` opens a message, ``delta`` adds streamed text to the latest message
of its turn, ``edit`` and ``regenerate`` replace that message's text (deltas that follow add to
the new one). A null kind counts as ``message``. An event before any message of its turn opens one.

The template is ``<|start|>ROLE<|message|>TEXT<|end|>`` and a newline per message. Every control
string begins with ``<|``; inside roles and texts a backslash is doubled and ``<|`` is
written ``<\\|``, so no text can imitate a mark and all text comes back unchanged. The loss mask
lists the code-point ranges of assistant texts in the formatted string.

Defined cases: null text or role is empty; a null turn or sequence comes first; repeated and
tied rows each count, in the order of role and text; a null conversation id is one
conversation of its own; an empty table gives no conversation; other columns are ignored. A conversation
becomes one string, so it must fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>\n"


def escape(text: Column) -> Column:
    """Text in which no control string can begin."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, turn, nth, role, text`` of a log.

    ``events`` has ``conv_id, turn, seq, kind, role, text``.
    """
    empty = F.lit("")
    log = events.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("seq").cast("long").alias("seq"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    opens = F.col("kind") == "message"
    order = ["seq", (~opens).cast("int"), "role", "text"]
    turn = Window.partitionBy("conv_id", "turn").orderBy(*order)
    so_far = turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = log.withColumn(
        "nth", F.greatest(F.lit(1), F.sum(opens.cast("long")).over(so_far))
    ).withColumn("place", F.row_number().over(turn))
    kept = numbered.groupBy("conv_id", "turn", "nth").agg(
        F.array_sort(F.collect_list(F.struct("place", "kind", "role", "text"))).alias("log")
    )
    # the last event that is no delta starts the final text; deltas after it follow
    last = F.array_max(
        F.transform(F.filter("log", lambda x: x["kind"] != "delta"), lambda x: x["place"])
    )
    tail = F.filter("log", lambda x: x["place"] >= F.coalesce(last, F.lit(0)))
    return kept.select(
        "conv_id",
        "turn",
        "nth",
        F.col("log")[0]["role"].alias("role"),
        F.array_join(F.transform(tail, lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask``; the mask holds (start, length) in code points."""
    body = escape(F.col("text"))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(MESSAGE))
    parts = messages.withColumn("head", head).withColumn("body", body)
    order = Window.partitionBy("conv_id").orderBy("turn", "nth", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + F.lit(len(END))
    placed = parts.select(
        "conv_id",
        F.row_number().over(order).alias("at"),
        F.concat("head", "body", F.lit(END)).alias("piece"),
        (F.col("role") == "assistant").alias("answer"),
        (F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")).alias("start"),
        F.length("body").cast("long").alias("size"),
    )
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("at", "piece", "answer", "start", "size"))
        ).alias("parts")
    )
    answers = F.filter("parts", lambda x: x["answer"])
    return whole.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(
            answers, lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"))
        ).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text`` from ``render``'s output alone."""
    pieces = F.slice(F.split("formatted", r"<\|start\|>"), 2, 2_000_000_000)
    turns = F.transform(
        pieces,
        lambda x: F.struct(
            unescape(F.substring_index(x, MESSAGE, 1)).alias("role"),
            unescape(
                F.substring_index(
                    F.substring(x, F.locate(MESSAGE, x) + len(MESSAGE), F.length(x)), END, 1
                )
            ).alias("text"),
        ),
    )
    under = F.transform(
        "loss_mask",
        lambda x: F.substring(
            F.col("formatted"), (x["start"] + 1).cast("int"), x["size"].cast("int")
        ),
    )
    return formatted.select(
        "conv_id", "formatted", turns.alias("turns"), unescape(F.array_join(under, "")).alias("loss_text")
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """One ``message`` event per row of ``conversations``."""
    return conversations.select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    probe = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    events = conversation_events(rows.unionByName(probe))
    back = read_back(render(fold_events(events)))
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, len(replace(replace(role, '\', '\\'), '<|', '<\|'))
          + len(replace(replace(text, '\', '\\'), '<|', '<\|')) + 28 AS size FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
         FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
