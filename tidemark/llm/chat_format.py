"""Chat formatting in Spark expressions only: collected turn structs are sorted, adjacent turns of a role share a block.

The template::

    <turn:user>text of a turn<next>text of the next turn of the same role</turn>
    <turn:assistant>...</turn>

Texts and roles hold no raw ``<``: a backslash is written ``\\b``, ``<`` is ``\\l`` and, in roles, ``>`` is ``\\g``,
so every marker in the output is a real one and two plain replacements undo the escape.

Defined results: a null text or role is the empty one; turns sort by (turn, role, text), a null turn first, so
that ties and repeated rows have one order; rows with a null conversation id form one conversation; an empty
table gives no rows; further columns are not read. A conversation is one output value, so its size is bounded
by what one string can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

#: The conversation that the registered query adds: both of its texts look like control strings.
PROBE_ID = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    return F.replace(text, F.lit("<"), F.lit("\\l"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    for mark, char in (("\\l", "<"), ("\\g", ">"), ("\\b", "\\")):
        text = F.replace(text, F.lit(mark), F.lit(char))
    return text


def format_chats(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row for each conversation: its id, formatted string, loss_mask array<struct<start long, chars long>>.

    start counts the code points of formatted before a span; spans are the (escaped) texts of loss_roles.
    One shuffle, by conversation.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        escape_role(F.col(role_col)).alias("role"),
        escape(F.col(text_col)).alias("text"),
        F.coalesce(F.col(role_col).isin(*loss_roles), F.lit(False)).alias("loss"),
    )
    sorted_turns = turns.groupBy(F.col(conv_col).alias("conv")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    role_at = lambda i: F.get(F.col("turns.role"), i)
    # Numbers of the turns at which the role changes; a block runs from one to the next.
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    blocked = sorted_turns.withColumn("starts", starts).withColumn("ends", F.concat(F.slice("starts", 2, n), F.array(n)))
    blocks = F.transform(
        F.arrays_zip(F.col("starts").alias("a"), F.col("ends").alias("b")),
        lambda x: F.slice("turns", x["a"] + 1, x["b"] - x["a"]),
    )
    merged = blocked.withColumn("blocks", blocks)
    opened = lambda b: F.concat(F.lit("<turn:"), b[0]["role"], F.lit(">"))
    formatted = F.array_join(
        F.transform(
            "blocks",
            lambda b: F.concat(
                opened(b), F.array_join(F.transform(b, lambda t: t["text"]), "<next>"), F.lit("</turn>\n")
            ),
        ),
        "",
    )
    span = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("chars"))
    state = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.filter(F.array(span), lambda _: F.lit(False)).alias("spans"),
    )

    def add_text(acc: Column, t: Column) -> Column:
        chars = F.char_length(t["text"]).cast("long")
        here = F.array(F.struct(acc["at"].alias("start"), chars.alias("chars")))
        return F.struct(
            (acc["at"] + chars + F.lit(len("<next>"))).alias("at"),
            F.when(t["loss"], F.concat(acc["spans"], here)).otherwise(acc["spans"]).alias("spans"),
        )

    def add_block(acc: Column, b: Column) -> Column:
        first = F.struct((acc["at"] + F.char_length(opened(b))).alias("at"), acc["spans"].alias("spans"))
        last = F.aggregate(b, first, add_text)
        after = len("</turn>\n") - len("<next>")
        return F.struct((last["at"] + F.lit(after)).alias("at"), last["spans"].alias("spans"))

    mask = F.aggregate("blocks", state, add_block, lambda acc: acc["spans"])
    return merged.select(F.col("conv").alias(conv_col), formatted.alias("formatted"), mask.alias("loss_mask"))


def read_chats(chats: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """Formatted conversations parsed again: id, turns array<struct<role, text>> as before formatting, loss_text."""
    blocks = F.filter(F.split("formatted", "</turn>\n"), lambda b: b != "")

    def parse(block: Column) -> Column:
        head = F.substring_index(block, ">", 1)
        body = F.substr(block, F.char_length(head) + 2, F.char_length(block))
        role = unescape(F.substr(head, F.lit(len("<turn:") + 1), F.char_length(head)))
        return F.transform(F.split(body, "<next>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    loss = F.array_join(
        F.transform("loss_mask", lambda s: F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["chars"].cast("int"))),
        "",
    )
    return chats.select(
        conv_col,
        "formatted",
        F.flatten(F.transform(blocks, parse)).alias("turns"),
        unescape(loss).alias("loss_text"),
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    back = read_chats(format_chats(turns.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH rows_in AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), esc AS (
  SELECT *, replace(replace(text, '\', '\b'), '<', '\l') AS etext,
         replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') AS erole FROM rows_in
), numbered AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before
  FROM esc WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, erole, etext)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(etext) + CASE WHEN before IS NULL OR before <> role
           THEN length(erole) + 7 + 8 ELSE 6 END)::BIGINT AS formatted_chars
FROM numbered GROUP BY conv_id
"""
QUERIES = {"op8_chat_format": op8_chat_format}
ORACLES = {"op8_chat_format": OP8_SQL}
