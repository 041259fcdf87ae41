"""Chat formatting into budgeted, turn-aligned windows.

A turn is written ``<|im_start|>role\\n`` + text + ``<|im_end|>\\n``. Inside roles and texts ``\\`` becomes
``\\s``, ``<|`` becomes ``<\\|`` and, in roles, a newline becomes ``\\n`` spelled out; so no text can open or
close a turn, and ``unescape`` restores it.

Prefix sums of turn tokens cut a conversation into spans: a turn belongs to the stride in which its last token
falls. A stride is half of what the budget leaves after system turn and history, so a window keeps to the
budget unless one turn alone is longer than a stride, or the system turn leaves less than MIN_STRIDE; turns stay whole.
Tokens of a turn are those of its text, counted before (``tokens_col``, as token_counts gives them), or else its pieces by
TOKEN, and FRAME_TOKENS for its marks. Each window repeats the system
turn that opens the conversation and as many turns before the span as fit the history allowance. The loss mask
covers assistant texts of the span alone, so each target counts once.

One shuffle by conversation serves the windows and everything read back from them.

Cases: null text or role counts as empty; turns come by number (null first), equal ones by role and text, and
rows that repeat are turns of their own; rows with null conversation form one conversation; an empty table
gives an empty result; other columns are ignored. A conversation is one sequence with one digest, so it is
the unit that a task holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
BUDGET = 1024
HISTORY = 128
MIN_STRIDE = 64
#: What stands for a token where none are counted: up to three letters or digits or two other signs, with a space before them, or blanks.
TOKEN = r" ?\p{L}{1,3}| ?\p{N}{1,3}| ?[^\p{L}\p{N}\t\n\x0B\f\r ]{1,2}|[\t\n\x0B\f\r ]+"
#: Tokens of a turn's marks and role.
FRAME_TOKENS = 6


def _swap(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(c: Column, role: bool = False) -> Column:
    out = _swap(_swap(c, "\\", "\\s"), "<|", "<\\|")
    return _swap(out, "\n", "\\n") if role else out


def unescape(c: Column, role: bool = False) -> Column:
    out = _swap(c, "\\|", "|")
    return _swap(_swap(out, "\\n", "\n") if role else out, "\\s", "\\")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens_col: str | None = None) -> DataFrame:
    """From (conv_id, turn, role, text), and the text's tokens if named: conv_id, window, text, n_tokens, n_repeated and loss.

    n_repeated says how many turns at the front are repeats; loss holds (start, end) in characters.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = Window.partitionBy("conv_id")
    turn = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    by_n = conv.orderBy("n")
    numbered = (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col(tokens_col) if tokens_col else F.lit(None)).cast("long").alias("tokens"))
        .withColumn("n", F.row_number().over(turn))
        .withColumn("system", (F.col("n") == 1) & (F.col("role") == "system"))
        .withColumn("head", F.concat(F.lit(START), escape(F.col("role"), True), F.lit("\n")))
        .withColumn("body", escape(F.col("text")))
        .withColumn("cost", F.coalesce("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long")) + FRAME_TOKENS)
        .select("conv_id", "n", "system", "role", "head", "body", "cost")
    )
    own = F.when(F.col("system"), 0).otherwise(F.col("cost"))
    stride = F.greatest(F.lit(MIN_STRIDE), F.floor((budget - history - F.col("system_cost")) / 2))
    spans = (
        numbered.withColumn("system_cost", F.sum(F.when(F.col("system"), F.col("cost")).otherwise(0)).over(conv))
        .withColumn("upto", F.sum(own).over(by_n))
        .withColumn("span", F.when(~F.col("system"), F.floor((F.col("upto") - 1) / stride)))
        .withColumn("span", F.coalesce("span", F.min("span").over(conv), F.lit(0)))
        .withColumn("window", F.dense_rank().over(conv.orderBy("span")) - 1)
        .withColumn("last", F.max("window").over(conv))
        .withColumn("span_end", F.max("upto").over(Window.partitionBy("conv_id", "span")))
    )
    near = F.col("span_end") - F.col("upto") + F.col("cost") <= history
    repeats = F.when(F.col("system") & (F.col("last") > 0), F.sequence(F.lit(1), F.col("last"))).when(
        ~F.col("system") & near & (F.col("window") < F.col("last")), F.array(F.col("window") + 1)
    )
    placed = spans.withColumn("at", F.explode(F.concat(F.array("window"), F.coalesce(repeats, F.array().cast("array<int>")))))
    fresh = F.col("at") == F.col("window")
    turns = F.sort_array(F.collect_list(F.struct("n", fresh.alias("fresh"), "role", "head", "body", "cost")))
    chars = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(END)

    def walk(a: Column, t: Column) -> Column:
        start = a["at"] + F.char_length(t["head"])
        span = F.array(F.struct(start.alias("start"), (start + F.char_length(t["body"])).alias("end")))
        target = t["fresh"] & (t["role"] == "assistant")
        return F.struct((a["at"] + chars(t)).alias("at"), F.when(target, F.concat(a["loss"], span)).otherwise(a["loss"]).alias("loss"))

    none = F.array().cast("array<struct<start: int, end: int>>")
    return (
        placed.groupBy("conv_id", F.col("at").alias("window"))
        .agg(turns.alias("turns"))
        .select(
            "conv_id",
            "window",
            F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
            F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["cost"]).alias("n_tokens"),
            F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("n_repeated"),
            F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("loss")), walk, lambda a: a["loss"]).alias("loss"),
        )
    )


def fresh_turns(text: Column, n_repeated: Column) -> Column:
    """The (role, text) turns of a window that no earlier window holds."""
    raw = F.split(text, r"<\|im_end\|>\n")
    kept = F.slice(raw, n_repeated + 1, F.size(raw) - 1 - n_repeated)

    def parse(t: Column) -> Column:
        rest = F.substring(t, F.lit(len(START) + 1), F.char_length(t))
        role = F.substring_index(rest, "\n", 1)
        body = F.substring(rest, F.char_length(role) + 2, F.char_length(rest))
        return F.struct(unescape(role, True).alias("role"), unescape(body).alias("text"))

    return F.transform(kept, parse)


def loss_text(text: Column, loss: Column) -> Column:
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, from the windows alone: turns, digests and sizes."""
    turns = fresh_turns(F.col("text"), F.col("n_repeated"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = F.sort_array(F.collect_list(F.struct("window", "said", "target")))
    return (
        formatted.withColumn("turns", turns)
        .select(
            "conv_id",
            "window",
            F.size("turns").alias("n"),
            F.char_length("text").alias("chars"),
            said.alias("said"),
            loss_text(F.col("text"), F.col("loss")).alias("target"),
        )
        .groupBy("conv_id")
        .agg(parts.alias("parts"), F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
        .withColumn("said", F.array_join(F.col("parts.said"), ""))
        .withColumn("target", F.array_join(F.col("parts.target"), ""))
        .select(
            "conv_id",
            "n_turns",
            F.sha2("said", 256).alias("turns_sha256"),
            F.char_length("target").cast("long").alias("loss_chars"),
            F.sha2("target", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
