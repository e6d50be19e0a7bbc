"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its text is
trainable.  Turns after the last assistant turn (or a conversation without one) make one more example with
an empty loss span, so that no turn is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The template's own marks, and control strings of common templates that texts may hold.
OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>\n"
GUARDED = [("<|", "<\\|"), ("</s>", "<\\/s>"), ("<s>", "<\\s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")]


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put into every control string; ``unescaped`` takes both back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, guarded in GUARDED:
        text = F.replace(text, F.lit(plain), F.lit(guarded))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(rows: DataFrame, target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length) from rows of (conv_id, turn, role, text).

    ``example`` is the number of turns in ``text``; the loss span counts code points of ``text``.  Turns are
    ordered by turn, ties by role and text; null roles and texts count as empty, a null conv_id is a
    conversation of its own, repeated rows are repeated turns.  Other columns are ignored.
    """
    turns = rows.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = whole.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t["role"] == target_role).alias("is_target"), escaped(t["role"]).alias("role"),
        escaped(t["text"]).alias("text"))).alias("turns"))
    pieces = pieces.withColumn("parts", F.transform(
        "turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(BODY), t["text"], F.lit(CLOSE))))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")),
                    lambda k: F.get("turns", k - 1)["is_target"] | (k == F.size("turns")))
    examples = pieces.select("conv_id", "turns", "parts", F.explode(ends).alias("example"))
    last = F.get("turns", F.col("example") - 1)
    examples = examples.select(
        "conv_id", "example", F.array_join(F.slice("parts", 1, F.col("example")), "").alias("text"),
        F.when(last["is_target"], F.length(last["text"])).otherwise(0).alias("loss_length"))
    return examples.select(
        "conv_id", "example", "text",
        (F.length("text") - len(CLOSE) - F.col("loss_length")).cast("long").alias("loss_start"),
        F.col("loss_length").cast("long"))


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted_chars): what the examples say, turns and texts unescaped.

    Turns are read from the longest example, which holds all; a loss text is read through its span.
    """
    def found(group: int) -> Column:
        pattern = r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n"
        return F.regexp_extract_all("whole", F.lit(pattern), group)

    loss = F.struct("example", unescaped(F.expr("substring(text, int(loss_start) + 1, int(loss_length))")).alias("text"))
    masked = F.when(F.col("loss_length") > 0, loss)
    per = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"), F.sort_array(F.collect_list(masked)).alias("losses"),
        F.sum(F.length("text")).alias("formatted_chars"))
    turns = F.arrays_zip(F.transform(found(1), unescaped).alias("role"), F.transform(found(2), unescaped).alias("text"))
    return per.select("conv_id", turns.alias("turns"), F.col("losses.text").alias("loss_texts"), "formatted_chars")
