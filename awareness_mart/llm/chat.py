"""Chat examples by prefix-target expansion: one per assistant turn, only that reply trainable.

A turn is written as ``### role: text</turn>`` and a line feed. Inside roles and texts a
backslash goes before every backslash, before a # that follows a #, and into </turn>; in
roles also before a colon. No escaped text holds a control string, and dropping each
backslash but the one after it gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = r"\\|(?<=#)#|(?<=<)/(?=turn>)"


def escaped(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, F.lit(_CONTROL + also), F.lit(r"\\$0"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def expanded(conversations: DataFrame, reply: str = "assistant") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end) of rows (conv_id, turn, role, text).

    Example k holds the first k turns; the loss span, in code points with the end
    exclusive, covers the escaped text of its last turn. A conversation that doesn't end
    with a reply gets one more example of all its turns, without loss. Turns are ordered by
    turn (null first), then role and text; rows that repeat are turns of their own; null
    roles and texts are empty; rows without conv_id are one conversation; no rows give no
    rows; other columns are not read. Roles and texts may have any length, but a conversation
    is one row, and its examples of all its prefixes must fit in a task.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == reply).alias("reply"),
            F.concat(F.lit(OPEN), escaped(t["role"], "|:"), F.lit(MIDDLE)).alias("head"),
            escaped(t["text"]).alias("text"),
        ),
    )
    rows = materialised(turns, parts=parts).drop("turns")
    rows = materialised(
        rows,
        written=F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))),
    )
    targets = rows.select("conv_id", "written", F.size("parts").alias("n"), F.posexplode("parts"))
    picked = targets.where(F.col("col.reply") | (F.col("pos") == F.col("n") - 1))
    examples = picked.select(
        "conv_id",
        (F.col("pos") + 1).alias("example"),
        F.array_join(F.slice("written", F.lit(1), F.col("pos") + 1), "").alias("formatted"),
        F.when(F.col("col.reply"), F.length("col.text")).otherwise(0).alias("loss"),
    )
    end = F.length("formatted") - len(CLOSE)
    return examples.select(
        "conv_id",
        "example",
        "formatted",
        (end - F.col("loss")).cast("bigint").alias("loss_start"),
        end.cast("bigint").alias("loss_end"),
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted example.

    The first colon that no backslash escapes ends the role; a search for it in a copy
    without the escaped characters takes roles of any length.
    """
    turns = F.split(formatted, CLOSE, -1)
    whole = F.slice(turns, F.lit(1), F.greatest(F.size(turns) - 1, F.lit(0)))

    def turn(t: Column) -> Column:
        colon = F.instr(F.regexp_replace(t, F.lit(r"(?s)\\."), F.lit("__")), ":")
        role = F.substring(t, F.lit(len(OPEN) + 1), colon - (len(OPEN) + 1))
        text = F.substring(t, colon + len(MIDDLE), F.length(t))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(whole, turn)


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say: turns, trained text and size."""
    loss = F.substring(
        F.col("formatted"),
        (F.col("loss_start") + 1).cast("int"),
        (F.col("loss_end") - F.col("loss_start")).cast("int"),
    )
    trained = examples.select(
        "conv_id",
        "example",
        "formatted",
        F.when(F.col("loss_end") > F.col("loss_start"), unescaped(loss)).otherwise("").alias("loss"),
    )
    grouped = trained.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    rows = materialised(
        grouped,
        turns=parsed(F.col("whole")),
        trained=F.array_join(F.transform("losses", lambda x: x["loss"]), ""),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return rows.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )
