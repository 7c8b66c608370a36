"""Chat formatting: prefix-target expansion of conversations, native SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MID, END = "[INST]", "[/INST]", "</s>"
#: Strings that mark structure in this or the usual chat templates; none of them is left inside an escaped text.
CONTROL = r"(<|\[)(/?s>|/?INST\]|</?SYS>>|\|)"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    """A backslash is doubled, and one is put behind the first character of each control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_text(role: Column, text: Column) -> Column:
    """[INST]role[/INST]text</s> with both escaped."""
    return F.concat(F.lit(OPEN), escape(role), F.lit(MID), escape(text), F.lit(END))


def prefix_examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end): one example per assistant turn.

    formatted holds every turn up to that one; [loss_start, loss_end) are the code points of the reply, the only part
    that is trained. Turns after the last assistant turn (or all turns, where there is none) get one more example
    without loss, so that nothing is lost. Turns are ordered by turn, then role, then text; repeated turns stay. Null
    roles and texts are empty; conversations with a null id form one. A conversation's examples repeat its beginning,
    which is what this method makes; memory per task is that of one conversation.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("shown", turn_text(F.col("role"), F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    seen = rows.select(
        "conv_id",
        "role",
        "shown",
        F.row_number().over(order).alias("example"),
        F.lead("shown").over(order).isNull().alias("last"),
        F.array_join(F.collect_list("shown").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "").alias("formatted"),
    )
    trained = F.col("role") == TRAINED
    end = F.length("formatted") - len(END)
    start = F.length("formatted") - F.length("shown") + F.length(escape(F.col("role"))) + len(OPEN) + len(MID)
    return seen.where(trained | F.col("last")).select("conv_id", "example", "formatted", F.when(trained, start).otherwise(0).alias("loss_start"), F.when(trained, end).otherwise(0).alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """formatted -> array<struct<role, text>>."""
    parts = F.split(formatted, END.replace("/", "/"), -1)
    body = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(body, lambda p: F.struct(unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 2147483647), MID, 1)).alias("role"), unescape(F.substring_index(p, MID, -1)).alias("text")))


def op9_chat(conversations: DataFrame) -> DataFrame:
    """The digest columns per conversation, all read back from the formatted examples."""
    spark = conversations.sparkSession
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{probe}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{probe}'")
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    examples = prefix_examples(rows.unionByName(extra))
    trained = F.expr("substring(formatted, loss_start + 1, loss_end - loss_start)")
    each = examples.select("conv_id", "example", "formatted", F.length("formatted").alias("n"), unescape(trained).alias("reply"))
    whole = each.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.sum("n").alias("formatted_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "").alias("loss"),
    )
    turns = whole.withColumn("turns", read_turns(F.col("formatted")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, 17 + length(regexp_replace(replace(role, '\', '\\'), '(<|\[)(/?s>|/?INST\]|</?SYS>>|\|)', '\1\\\2', 'g')) + length(regexp_replace(replace(text, '\', '\\'), '(<|\[)(/?s>|/?INST\]|</?SYS>>|\|)', '\1\\\2', 'g')) AS n FROM c),
o AS (SELECT *, sum(n) OVER w AS upto, lead(n) OVER w IS NULL AS last FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR last THEN upto END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""
