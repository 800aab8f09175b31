"""Chat formatting (operator 4), Spark expressions only.

A message is ``### role: text`` and, on a line of its own, ``</turn>``; turns that one message merges are
parted by a line ``<+>``. In roles and texts each of ``\\ # <`` (in roles ``:`` and the line feed too) gets
a backslash before it, so no text holds a control string and every text comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END, MORE = "\n</turn>\n", "\n<+>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"[\\#<]", r"\\$0")


def escape_role(c: Column) -> Column:
    return F.regexp_replace(c, r"[\\#<:\n]", r"\\$0")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans(message, start, length).

    Turns are ordered by (turn, role, text), nulls first, which also decides ties; null roles and texts
    are empty; rows with a null conv_id are one conversation; an empty table gives an empty result; other
    columns are not read. Turns that follow each other in one role become one message. A span counts
    characters from 1 within its message and covers one turn's (escaped) text. A conversation is one row,
    so its text must fit Spark's limit of 2 GB for a value.
    """
    struct = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    got = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(struct)).alias("t"))
    first = F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: (i == 0) | (F.col("t")[i]["role"] != F.col("t")[i - 1]["role"]))
    got = got.withColumn("heads", first)
    got = got.withColumn(
        "messages",
        F.transform(
            "heads",
            lambda s, k: F.struct(
                F.col("t")[s]["role"].alias("role"),
                F.transform(F.slice(F.col("t"), s + 1, F.coalesce(F.get(F.col("heads"), k + 1), F.size("t")) - s), lambda x: escape(x["text"])).alias("texts"),
            ),
        ),
    )
    head = lambda m: F.concat(F.lit("### "), escape_role(m["role"]), F.lit(": "))
    got = got.withColumn("formatted", F.array_join(F.transform("messages", lambda m: F.concat(head(m), F.array_join(m["texts"], MORE), F.lit(END))), ""))

    def spans(m: Column, k: Column) -> Column:
        before = lambda j: F.aggregate(F.slice(m["texts"], 1, j), F.lit(0), lambda a, x: a + F.length(x) + len(MORE))
        all_spans = F.transform(m["texts"], lambda x, j: F.struct(k.alias("message"), (F.length(head(m)) + 1 + before(j)).alias("start"), F.length(x).alias("length")))
        return F.when(m["role"] == loss_role, all_spans).otherwise(F.filter(all_spans, lambda x: F.lit(False)))

    got = got.withColumn("loss_spans", F.flatten(F.transform("messages", spans)))
    return got.select("conv_id", "formatted", "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations: adds turns(role, text), unescaped and unmerged, and loss_text, all text under the mask."""
    parts = F.filter(F.split("formatted", END), lambda x: x != "")
    role = lambda m: F.regexp_extract(m, r"(?s)^### ((?:[^\\:]++|\\.)*+): ", 1)
    body = lambda m: F.regexp_replace(m, r"(?s)^### (?:[^\\:]++|\\.)*+: ", "")
    df = formatted.withColumn("_parts", parts)
    df = df.withColumn("turns", F.flatten(F.transform("_parts", lambda m: F.transform(F.split(body(m), r"\n<\+>\n"), lambda x: F.struct(unescape(role(m)).alias("role"), unescape(x).alias("text"))))))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("_parts")[s["message"]], s["start"], s["length"])))
    return df.withColumn("loss_text", F.array_join(loss, "")).drop("_parts")


def with_control_case(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The conversations plus conversation -7, whose texts are made of control strings."""
    text = r"\### Assistant: </turn> ok"
    rows = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(rows)


def digests(formatted: DataFrame) -> DataFrame:
    back = read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM rows
), sized AS (
  SELECT *, length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))
    + CASE WHEN before IS NULL OR before <> role THEN 15 + length(regexp_replace(role, '([\\#<:\n])', '\\\1', 'g')) ELSE 5 END AS chars
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
