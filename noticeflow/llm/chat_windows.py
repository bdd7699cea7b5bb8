"""Chat formatting in budgeted windows (DataFrame functions only).

A conversation is rendered turn by turn and cut into training windows:

* Prefix sums of turn tokens place every turn. Turns that lie inside one
  stretch of ``budget - history - system tokens`` tokens form a span; a turn
  that crosses a stretch border is a span of its own. So spans are
  turn-aligned and within the budget unless a single turn exceeds it.
* A window is the system turn (a first turn with role ``system``), then the
  turns that start at most ``history`` tokens before the span, then the span.
* Only assistant texts of the window's own span are under the loss mask; the
  repeated system turn and history are masked out, so each assistant text is
  a target exactly once.

Windows are groups of (conversation, window), bounded by the budget; no
conversation is collected to build them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|turn|>", "<|end|>\n"
#: (plain, escaped), in the order of escaping. Every control string of a chat
#: template starts with one of these characters, so none survives in a text.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "&#10;")]
#: One token: a run of ASCII letters, digits or _, or any other visible character.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]"


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape(text: Column) -> Column:
    return _swap(text, ESCAPES)


def unescape(text: Column) -> Column:
    return _swap(text, [(b, a) for a, b in reversed(ESCAPES)])


def unescape_role(role: Column) -> Column:
    return _swap(role, [(b, a) for a, b in reversed(ROLE_ESCAPES)])


def chat_windows(turns: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """Windows of ``turns(conv_id, turn, role, text)``, one row each:

    conv_id, window (from 0), formatted, n_tokens, n_repeated (leading turns
    that earlier windows hold as well), loss_spans (start and length in code
    points of ``formatted``, from 0).

    Turns are ordered by turn (null first); rows of the same turn by role,
    then text; repeated rows are turns of their own. A null role or text is
    empty. A null conv_id is a conversation. Extra columns are ignored; no
    rows give no windows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    header = F.concat(F.lit(BEGIN), _swap(role, ROLE_ESCAPES), F.lit("\n"))
    base = turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("plain"), header.alias("header"), escape(text).alias("body")
    )
    base = base.withColumn("n_tokens", F.regexp_count(F.concat("header", "body", F.lit(END)), F.lit(TOKEN)).cast("long"))
    conversation = Window.partitionBy("conv_id")
    ordered = conversation.orderBy(F.asc_nulls_first("turn"), "role", "plain")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    placed = base.withColumn("i", F.row_number().over(ordered))
    placed = placed.withColumn("is_system", (F.col("i") == 1) & (F.col("role") == "system"))
    placed = placed.withColumn("own_tokens", F.when(F.col("is_system"), 0).otherwise(F.col("n_tokens")))
    placed = placed.withColumn("stop", F.sum("own_tokens").over(upto)).withColumn(
        "system_tokens", F.max(F.when(F.col("is_system"), F.col("n_tokens")).otherwise(0)).over(upto)
    )
    placed = placed.withColumn("start", F.col("stop") - F.col("own_tokens"))
    placed = placed.withColumn("stretch", F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(1)))
    # (first stretch, last stretch) names the span; the system turn belongs to the first one.
    placed = placed.withColumn("low", F.floor(F.col("start") / F.col("stretch"))).withColumn(
        "high", F.floor((F.greatest("stop", F.lit(1)) - 1) / F.col("stretch"))
    )
    before = F.lag(F.when(~F.col("is_system"), F.struct("low", "high"))).over(ordered)
    opens = F.when(F.col("is_system"), 0).otherwise(
        F.coalesce((before != F.struct("low", "high")).cast("int"), F.lit(0))
    )
    placed = placed.withColumn("opens", opens).withColumn("span", F.sum("opens").over(upto))
    # The last span that starts at most ``history`` tokens after this turn.
    reach = conversation.orderBy("start").rangeBetween(0, history)
    placed = placed.withColumn("near", F.max("span").over(reach)).withColumn("final", F.max("span").over(conversation))
    last = F.when(F.col("is_system"), F.col("final")).otherwise(F.col("near"))
    shown = placed.withColumn("window", F.explode(F.sequence("span", last)))
    turn = F.struct(
        "i",
        F.concat("header", "body", F.lit(END)).alias("rendered"),
        F.length("header").alias("n_header"),
        F.length("body").alias("n_body"),
        (F.col("window") > F.col("span")).alias("repeated"),
        ((F.col("window") == F.col("span")) & (F.col("role") == "assistant")).alias("target"),
    )
    windows = shown.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.sum("n_tokens").alias("n_tokens")
    )
    offset = lambda acc: acc["at"]
    lengths = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (offset(acc) + F.length(t["rendered"])).alias("at"),
            F.when(
                t["target"],
                F.array_append(
                    acc["spans"],
                    F.struct((offset(acc) + t["n_header"]).alias("start"), t["n_body"].alias("length")),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        "n_tokens",
        F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"),
        lengths.alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Parse windows back: conv_id, window, turns (role and text of the turns
    that are new in this window), loss_texts (unescaped, by the mask)."""
    # The first piece is what stands before the first mark: nothing.
    every = F.split("formatted", r"<\|turn\|>", -1)
    parts = F.slice(every, F.col("n_repeated") + 2, F.size(every))
    body = lambda p: F.substr(p, F.lit(1), F.length(p) - len(END))
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(body(p), F.length(F.substring_index(p, "\n", 1)) + 2)).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    return windows.select(
        "conv_id", "window", turns.alias("turns"), loss.alias("loss_texts"), F.length("formatted").alias("n_chars")
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. A digest needs its
    conversation's text as one value."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per = read_windows(windows).select(
        "conv_id",
        F.size("turns").cast("long").alias("n"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.struct("window", said.alias("said"), F.array_join("loss_texts", "").alias("loss")).alias("w"),
    )
    joined = per.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"), F.sort_array(F.collect_list("w")).alias("w")
    )
    whole = joined.select(
        "conv_id", "n_turns", "formatted_chars",
        F.array_join(F.transform("w", lambda x: x["said"]), "").alias("said"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"),
    )
    return whole.select(
        "conv_id", "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
