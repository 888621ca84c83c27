"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply is trainable (its span is the loss mask). Turns
after the last reply are kept in one closing row without a trainable span, so
the output holds every turn of every conversation.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control
strings inside roles and texts are escaped by one backslash after their first
character (any run of backslashes there grows by one), which ``unescape`` takes
back exactly; an escaped text never holds a control string.

Everything is built-in functions: one aggregation by conversation, then
row-wise work. A conversation is the unit of the result (one hash of its whole
text), so it must fit a row, as a document must; conversations are spread by
their ids. The examples of one conversation are generated one after the other
and never held together.

Defined cases: null role or text = empty; null conv_id = a conversation of its
own; null turn sorts first; rows of one turn number are ordered by role, then
text, and repeated rows are kept as turns; no assistant turn = only the closing
row; an empty table = an empty result; further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of the common chat templates, after their first character.
_TAIL = r"\|im_(?:start|end)\|>|/?s>|/?INST\]|</?SYS>>"
PROBE_ID = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])(\\*)({_TAIL})", r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])\\(\\*)({_TAIL})", r"$1$2$3")


def _escape_role(c: Column) -> Column:
    """A role ends at its line's end: percent-encode line ends in it."""
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows -> one row per example: conv_id,
    target_turn (place of its last turn, from 0), text (the formatted example),
    loss_start, loss_end (code points; the trainable span, null in a closing row)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = escape(text)
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), role.alias("role"),
        F.concat(F.lit(START), _escape_role(role), F.lit("\n"), body, F.lit(END + "\n")).alias("seg"),
        F.length(body).alias("n")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    each = (convs.select("conv_id", "turns", F.posexplode("turns").alias("target_turn", "t"))
            .filter((F.col("t.role") == "assistant") | (F.col("target_turn") == F.size("turns") - 1)))
    each = each.select(
        "conv_id", "target_turn",
        F.array_join(F.slice(F.col("turns.seg"), F.lit(1), F.col("target_turn") + 1), "").alias("text"),
        F.when(F.col("t.role") == "assistant", F.col("t.n")).alias("n"))
    end = F.length("text") - len(END) - 1
    return each.select("conv_id", "target_turn", "text",
                       (end + F.col("n") * 0 - F.col("n")).alias("loss_start"), (end + F.col("n") * 0).alias("loss_end"))


def read_back(examples: DataFrame) -> DataFrame:
    """Parse formatted examples: conversations with the digests of what their
    examples hold (turns from the longest example, replies from the loss masks)."""
    reply = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    per = examples.select("conv_id", "target_turn", "text", reply.alias("reply"))
    convs = per.groupBy("conv_id").agg(
        F.max(F.struct("target_turn", "text")).alias("last"),
        F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("target_turn", "reply")))).alias("replies"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"), F.count("reply").alias("n_examples"))
    parts = F.split("last.text", END.replace("|", r"\|") + "\n", -1)
    convs = convs.withColumn("parts", F.slice(parts, F.lit(1), F.size(parts) - 1))
    convs = convs.withColumn("loss", F.array_join(F.col("replies.reply"), ""))

    def turn(p: Column) -> Column:
        at = F.instr(p, "\n")
        return F.concat(_unescape_role(F.substr(p, F.lit(len(START) + 1), at - len(START) - 1)), F.lit("\n"),
                        unescape(F.substr(p, at + 1)), F.lit("\n"))

    return convs.select(
        "conv_id", F.size("parts").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("parts", turn), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations plus one whose two texts are control strings."""
    spark = turns.sparkSession
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
