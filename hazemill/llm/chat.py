"""Chat formatting by prefix-target expansion.

Each assistant turn becomes an example of its own: the transcript of its conversation up to the
end of the turn, where only the turn's own text is under the loss mask. What follows the last
assistant turn is in no example and is kept as the conversation's remainder.

Turns are rows, with their places in the transcript by a window over the conversation.
Examples written out grow with the square of a conversation; they are dealt out by conversation
and block, and a block writes about ``BLOCK_CHARS`` characters, so that a long conversation's
examples are made by many tasks. For that its transcript, which is linear, is sent to each of its blocks.
``read_back`` reads everything from the examples and remainders: an example's loss text and length, and the turns
from the last example and the remainder. Only those are gathered; ``formatted_chars`` counts the characters of
all examples and of the remainder.

A turn is ``[TURN]role[TEXT]text[END]``. Within roles and texts ``&``, ``<`` and ``[`` are
written ``&amp;``, ``&lt;`` and ``&lb;``, so no control string of this or another bracketed or
angled template appears there, and everything can be read back.

Null roles and texts are empty; turns with equal or null numbers are ordered by role and text,
null first; repeated rows are turns of their own; rows without a conv_id are one conversation;
extra columns are ignored; an empty table gives an empty result. A conversation's transcript is one
value, as its digests need it whole, however many turns it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of the examples that a block writes, about.
BLOCK_CHARS = 1 << 26
TURN, TEXT, END = "[TURN]", "[TEXT]", "[END]"
ASSISTANT = "assistant"
# In this order; undone in reverse.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def turns_of(conversations: DataFrame) -> DataFrame:
    """A row per turn: conv_id, place, role, written (the turn in the template), and where it and its text start."""
    empty = F.lit("")
    conv, turn = F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn")
    rows = conversations.select(conv, turn, F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = rows.select("conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"))
    rows = rows.withColumn("written", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.length("written").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)).cast("bigint")
    rows = rows.withColumns({"place": F.row_number().over(order), "start": start})
    text_start = F.col("start") + F.length("head")
    return rows.select("conv_id", "place", "role", "written", "start", text_start.alias("text_start"), F.length("body").cast("bigint").alias("length"))


def transcripts(turns: DataFrame) -> DataFrame:
    """conv_id, transcript, targets (where each assistant text starts, its length, its number) and blocks of each conversation."""
    target = F.when(F.col("role") == ASSISTANT, F.struct("text_start", "length"))
    rows = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "written"))).alias("turns"),
        F.sort_array(F.collect_list(target)).alias("targets"),
        F.sum(F.when(F.col("role") == ASSISTANT, F.col("text_start") + F.col("length") + len(END))).alias("chars"),
    )
    blocks = F.coalesce(F.expr(f"CAST((chars + {BLOCK_CHARS - 1}) DIV {BLOCK_CHARS} AS INT)"), F.lit(0))
    return rows.select("conv_id", F.array_join(F.col("turns")["written"], "").alias("transcript"), "targets", F.least(blocks, F.size("targets")).alias("blocks"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: its text, the range of it under the loss mask, whether it is its conversation's last."""
    blocks = formatted.filter("blocks > 0").select("conv_id", "transcript", "targets", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # Every blocks-th example: each block has long and short ones.
    own = F.filter(F.transform("targets", lambda t, i: F.struct(i.alias("example"), t["text_start"].alias("start"), t["length"].alias("length"))), lambda t: t["example"] % F.col("blocks") == F.col("block"))
    dealt = blocks.select("conv_id", "transcript", F.size("targets").alias("n"), own.alias("own"), "block").repartition("conv_id", "block")
    rows = dealt.select("conv_id", "transcript", "n", F.explode("own").alias("target"))
    start, length, example = F.col("target.start"), F.col("target.length"), F.col("target.example")
    text = F.substring("transcript", F.lit(1), (start + length + len(END)).cast("int"))
    return rows.select("conv_id", example.alias("example"), text.alias("text"), start.alias("loss_start"), (start + length).alias("loss_end"), (example == F.col("n") - 1).alias("last"))


def remainders(formatted: DataFrame) -> DataFrame:
    """What follows each conversation's last assistant turn."""
    last = F.element_at("targets", -1)
    end = F.when(F.size("targets") > 0, last["text_start"] + last["length"] + len(END)).otherwise(F.lit(0)).cast("int")
    return formatted.select("conv_id", F.substring("transcript", end + 1, F.length("transcript")).alias("text"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    return transcripts(turns_of(conversations))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of what is under the loss masks, all read from the examples and the remainders."""
    loss = F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    size = F.length("text").cast("bigint").alias("chars")
    of_examples = examples(formatted).select("conv_id", "example", loss.alias("loss"), F.when(F.col("last"), F.col("text")).alias("shown"), F.lit(None).cast("string").alias("after"), size)
    rest = remainders(formatted).select("conv_id", F.lit(-1).alias("example"), F.lit(None).cast("string").alias("loss"), F.lit(None).cast("string").alias("shown"), F.col("text").alias("after"), size)
    # The texts of the last example and of the remainder, and the loss texts; nothing else of an example is kept.
    by_conv = of_examples.unionByName(rest).groupBy("conv_id").agg(
        F.max("shown").alias("shown"),
        F.max("after").alias("after"),
        F.sort_array(F.collect_list(F.when(F.col("example") >= 0, F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    text = F.concat(F.coalesce("shown", F.lit("")), "after")
    turns = F.filter(F.split(text, r"\[TURN\]", -1), lambda t, i: i > 0)
    parts = F.transform(turns, lambda t: F.split(F.regexp_replace(t, r"\[END\]$", ""), r"\[TEXT\]", 2))
    rows = by_conv.select("conv_id", "formatted_chars", "losses", F.explode(F.array(parts)).alias("parts"))
    said = F.array_join(F.transform("parts", lambda p: F.concat(unescape(p[0]), F.lit("\n"), unescape(p[1]), F.lit("\n"))), "")
    loss = F.array_join(F.transform("losses", lambda x: unescape(x["loss"])), "")
    rows = rows.select("conv_id", F.size("parts").cast("bigint").alias("n_turns"), said.alias("said"), loss.alias("loss"), "formatted_chars")
    return rows.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: Each assistant turn's example goes up to its end; what follows the last one is the remainder.
ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), written AS (
  SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) + 17 AS chars FROM rows
), placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM written
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (WHERE role = 'assistant'), 0) + sum(chars)
    - coalesce(max(upto) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
