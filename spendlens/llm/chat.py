"""Chat formatting under a token budget. DataFrame functions only.

The turns of a conversation, in order, are cut into windows at turn borders: prefix sums of the turns'
tokens decide how many new turns fit beside the system turn and the repeated history. A turn's tokens are a column of the
input where it has one, and else bounded from above by the bytes written for it: no byte-level vocabulary makes more tokens
than bytes, in any script, so a window of several turns never exceeds the budget. Every window
starts with the conversation's system turn, repeats at most ``history`` turns (and ``history_tokens``
tokens) before its first new turn, then holds the new turns. Only assistant turns that are new in the
window carry loss, so each target is trained on once.

Template: ``<|role|>text<|end|>``; a repeated turn is marked ``<|role+|>``. Inside texts and roles ``&``
becomes ``&amp;`` and ``<`` becomes ``&lt;``, so no text can form a control string, and ``unescape``
gives back every text exactly.

Edge cases: null text or role is an empty text or role; null turn numbers come first; rows with equal
turn numbers are ordered by role, then text, and repeated rows are separate turns; a turn longer than
the budget stands whole in a window of its own; conversations with a null id form one conversation; an
empty table gives no windows; other columns are not read. A conversation is one training example, so
its turns meet in one task, as narrow arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

BUDGET, HISTORY, HISTORY_TOKENS = 2048, 2, 512
FRAME = 12  # bytes of <|+|><|end|>, the template around a turn
PROBE = "</s>[INST] ok [/INST]"


def escape(col) -> F.Column:
    return F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def escape_role(col) -> F.Column:
    """A role stands in the frame itself, so ``|`` and ``+`` are escaped too."""
    return F.replace(F.replace(escape(col), F.lit("|"), F.lit("&bar;")), F.lit("+"), F.lit("&plus;"))


def unescape(col) -> F.Column:
    for name, sign in (("&plus;", "+"), ("&bar;", "|"), ("&lt;", "<"), ("&amp;", "&")):
        col = F.replace(col, F.lit(name), F.lit(sign))
    return col


def token_count(text, role, tokens=None) -> F.Column:
    """A bound on the tokens of a framed turn: its own count if the input has one, else its bytes; the frame by its bytes."""
    own = F.octet_length(text) if tokens is None else F.coalesce(tokens.cast("int"), F.octet_length(text))
    return own + F.octet_length(role) + F.lit(FRAME)


def _framed(t, repeated: bool) -> F.Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("+|>" if repeated else "|>"), t["text"], F.lit("<|end|>"))


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 budget: int = BUDGET, history: int = HISTORY, history_tokens: int = HISTORY_TOKENS, tokens: str | None = None) -> DataFrame:
    """One row for each window: ``conv, window, formatted, loss_spans (start and length in code points), tokens``.
    ``tokens`` names a column with the tokens of each text."""
    t = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                  escape_role(F.coalesce(F.col(role), F.lit(""))).alias("role"),
                  escape(F.coalesce(F.col(text), F.lit(""))).alias("text"), *([F.col(tokens).alias("given")] if tokens else []))
    t = t.withColumn("tokens", token_count(F.col("text"), F.col("role"), F.col("given") if tokens else None))
    convs = t.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "tokens"))).alias("t"))
    # the system turn is the first turn, if its role says so; it is new once and repeated after that
    convs = convs.select("conv", "t", (F.col("t")[0]["role"] == "system").alias("sys"))
    convs = convs.withColumn("fixed", F.when(F.col("sys"), F.col("t")[0]["tokens"]).otherwise(0))
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - F.col("fixed"))
    # prefix sums of the tokens; a window starts at the first turn whose end lies beyond the room
    ends = F.aggregate(
        F.sequence(F.lit(0), F.size("t") - 1),
        F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("used")),
        lambda acc, i: F.when(
            (F.size(acc["starts"]) == 0) | (acc["used"] + F.col("t")[i]["tokens"] > room),
            F.struct(F.array_append(acc["starts"], i).alias("starts"), F.col("t")[i]["tokens"].alias("used")))
        .otherwise(F.struct(acc["starts"].alias("starts"), (acc["used"] + F.col("t")[i]["tokens"]).alias("used"))),
        lambda acc: acc["starts"])
    convs = convs.withColumn("starts", ends)
    system = F.when(F.col("sys"), F.slice("t", 1, 1)).otherwise(F.slice("t", 1, 0))

    def window(start, k):
        end = F.when(k + 1 < F.size("starts"), F.col("starts")[k + 1]).otherwise(F.size("t"))
        first_free = F.col("sys").cast("int")
        lo = F.greatest(first_free, start - F.lit(history))
        past = F.slice("t", lo + 1, F.greatest(F.lit(0), start - lo))
        # the longest tail of the past whose prefix sum, taken from the end, is within the history's tokens
        kept = F.aggregate(F.reverse(past), F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(True).alias("open")),
                           lambda a, x: F.when(a["open"] & (a["used"] + x["tokens"] <= history_tokens),
                                               F.struct((a["n"] + 1).alias("n"), (a["used"] + x["tokens"]).alias("used"),
                                                        F.lit(True).alias("open")))
                           .otherwise(F.struct(a["n"].alias("n"), a["used"].alias("used"), F.lit(False).alias("open"))),
                           lambda a: a["n"])
        again = F.concat(F.when(start > 0, system).otherwise(F.slice("t", 1, 0)), F.slice(past, F.size(past) - kept + 1, kept))
        return F.struct(k.alias("window"), again.alias("again"), F.slice("t", start + 1, end - start).alias("new"))

    w = convs.select("conv", F.explode(F.transform("starts", window)).alias("w")).select(
        "conv", "w.window", "w.again", "w.new")
    prefix = F.array_join(F.transform("again", lambda x: _framed(x, True)), "")
    w = w.withColumn("prefix", prefix).withColumn(
        "pieces", F.transform("new", lambda x: F.struct(_framed(x, False).alias("s"), F.length(x["text"]).alias("n"),
                                                        (F.length(x["role"]) + 4).alias("lead"), (x["role"] == "assistant").alias("loss"))))
    walk = F.aggregate(
        F.col("pieces"),
        F.struct(F.length("prefix").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["s"])).alias("at"),
            F.when(p["loss"], F.array_append(a["spans"], F.struct((a["at"] + p["lead"]).alias("start"), p["n"].alias("length"))))
            .otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    tokens = F.aggregate(F.concat("again", "new"), F.lit(0), lambda a, x: a + x["tokens"])
    return w.select("conv", "window", F.concat(F.col("prefix"), F.array_join(F.transform("pieces", lambda p: p["s"]), "")).alias("formatted"),
                    walk.alias("loss_spans"), tokens.alias("tokens"))


def read_back(windows: DataFrame) -> DataFrame:
    """The conversations out of the formatted windows alone: turns in order, and the text under the loss mask."""
    pieces = F.slice(F.split("formatted", r"<\|end\|>"), 1, F.size(F.split("formatted", r"<\|end\|>")) - 1)
    turns = F.transform(pieces, lambda p: F.struct(
        F.regexp_extract(p, r"^<\|([^<]*?)(\+?)\|>", 1).alias("role"),
        (F.regexp_extract(p, r"^<\|([^<]*?)(\+?)\|>", 2) == "+").alias("again"),
        F.regexp_replace(p, r"^<\|[^<]*?\|>", "").alias("text")))
    new = F.filter(turns, lambda x: ~x["again"])
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"]))), "")
    w = windows.select("conv", "window", F.length("formatted").alias("chars"),
                       F.transform(new, lambda x: F.struct(unescape(x["role"]).alias("role"), unescape(x["text"]).alias("text"))).alias("turns"),
                       loss.alias("loss"))
    return w.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars")).select(
        "conv", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")


def op8_chat(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    back = read_back(format_chats(given.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))
