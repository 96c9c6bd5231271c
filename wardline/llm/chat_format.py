"""Chat formatting in budgeted windows: turn-aligned spans, repeated history, and a loss mask over new answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template. A turn is TURN role TEXT text END.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Strings that mark turns here or in other common templates. Inside a text, a backslash follows their first character.
CONTROL = ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
#: Words, numbers and single marks: an estimate of tokens that needs no vocabulary.
TOKENS = r"[\p{L}\p{M}]+|\p{N}+|[^\x{9}-\x{d}\x{20}\p{L}\p{M}\p{N}]"
#: Tokens of a turn's own marks.
MARKS = 4
#: Turns numbered within one block are summed together; blocks are summed on their own.
BLOCK = 64


def escaped(c: Column) -> Column:
    """Reversible: backslashes are doubled, then control strings get one behind their first character."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _placed(turns: DataFrame) -> DataFrame:
    """Each turn with the tokens before it in its conversation.

    Sums run inside blocks of turn numbers first, then over blocks, so that a conversation of any length is spread
    over tasks.
    """
    rows = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    within = Window.partitionBy("k", "block").orderBy(F.asc_nulls_last("turn"), "role", "body")
    rows = rows.withColumn("inner", F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    along = Window.partitionBy("k").orderBy(F.asc_nulls_last("block")).rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.groupBy("k", "block").agg(F.sum("tokens").alias("sum"))
    blocks = blocks.select(
        F.col("k").alias("bk"), F.col("block").alias("bb"), (F.sum("sum").over(along) - F.col("sum")).alias("before")
    )
    joined = rows.join(blocks, (F.col("k") == F.col("bk")) & F.col("block").eqNullSafe(F.col("bb")))
    return joined.withColumn("start", F.col("before") + F.col("inner")).drop("bk", "bb", "before", "inner", "block")


def windows(
    turns: DataFrame,
    span: int = 768,
    history: int = 256,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """Formatted training windows of every conversation.

    Returns ``conv_id, window, text, loss, n_repeated, n_new, n_tokens``. Prefix sums of turn tokens cut a
    conversation into spans of whole turns with ``span`` tokens at most (a longer turn stands alone). Before its
    span, a window repeats the conversation's first turn if that is a system turn, and the whole turns that end
    within ``history`` tokens before the span. ``n_repeated`` turns lead the window; ``loss`` lists (start, end)
    code points of the trained role's new texts, so each text is trained on once.

    Rows are ordered by turn, then role and text; repeated rows are turns of their own. A null role or text is
    empty, a null turn comes last, and rows without a conversation form one. Other columns are ignored. An empty
    table gives no rows.
    """
    if not 0 <= history <= span:
        raise ValueError("history has to be between 0 and span")
    rows = turns.select(
        F.coalesce(F.col(conversation).cast("string"), F.lit("none")).alias("k"),
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
    ).withColumn("tokens", (F.regexp_count("body", F.lit(TOKENS)) + MARKS).cast("long"))
    head, tail = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)), escaped(F.col("body"))
    placed = (
        _placed(rows)
        .withColumn("cell", F.floor(F.col("start") / span))
        .withColumn("first", F.min("start").over(Window.partitionBy("k", "cell")))
        .withColumn("alone", F.col("start") + F.col("tokens") - F.col("first") > span)
        .withColumn("alone", F.col("alone") & (F.col("start") + F.col("tokens") > (F.col("cell") + 1) * span))
        .select(
            "k", "conv_id", "start", "tokens", "cell",
            (2 * F.col("cell") + F.col("alone").cast("long")).alias("window"),
            F.when(F.col("alone"), F.col("start")).otherwise(F.col("first")).alias("begins"),
            (F.col("start").eqNullSafe(F.lit(0)) & (F.col("role") == "system")).alias("is_system"),
            (F.col("role") == trained_role).alias("trained"),
            F.concat(head, tail, F.lit(END)).alias("piece"),
            F.length(head).cast("long").alias("skip"),
            F.length(tail).cast("long").alias("chars"),
        )
    )
    part = ["k", "conv_id", "window", "start", "tokens", "piece", "skip", "chars"]
    new = placed.select(*part, F.lit(False).alias("repeated"), "trained")
    heads = placed.select("k", "cell", "window", "begins", (F.col("is_system")).alias("own_system"))
    heads = heads.groupBy("k", "cell", "window").agg(F.min("begins").alias("begins"), F.max("own_system").alias("own_system"))
    again = (
        placed.where(~F.col("is_system"))
        .drop("window", "begins")
        .withColumn("cell", F.explode(F.sequence("cell", F.floor((F.col("start") + history) / span))))
        .join(heads.drop("own_system"), ["k", "cell"])
        .where((F.col("start") + F.col("tokens") <= F.col("begins")) & (F.col("start") >= F.col("begins") - history))
    )
    kept = placed.where("is_system").drop("window", "begins", "cell").join(
        heads.where(~F.col("own_system")).select("k", "window"), "k"
    )
    repeats = [x.select(*part, F.lit(True).alias("repeated"), F.lit(False).alias("trained")) for x in (again, kept)]
    parts = new.unionByName(repeats[0]).unionByName(repeats[1])
    fields = F.struct("start", "piece", "skip", "chars", "repeated", "trained")
    grouped = parts.groupBy("k", "conv_id", "window").agg(
        F.array_sort(F.collect_list(fields)).alias("parts"), F.sum("tokens").alias("n_tokens")
    )
    empty = F.expr("named_struct('at', 0L, 'loss', cast(array() as array<struct<start:bigint,end:bigint>>))")

    def walk(state: Column, p: Column) -> Column:
        begin = state["at"] + p["skip"]
        mark = F.array(F.struct(begin.alias("start"), (begin + p["chars"]).alias("end")))
        loss = F.when(p["trained"], F.concat(state["loss"], mark)).otherwise(state["loss"])
        return F.struct((state["at"] + F.length(p["piece"])).alias("at"), loss.alias("loss"))

    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"),
        F.aggregate("parts", empty, walk)["loss"].alias("loss"),
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_repeated"),
        F.size(F.filter("parts", lambda p: ~p["repeated"])).alias("n_new"),
        "n_tokens",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Conversations read from their windows: digests of all turns and of all text under the loss mask.

    One row per conversation: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. The
    digest of a whole conversation needs its text in one place, so the text of one conversation has to fit a task.
    """
    pattern = F.lit(r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n")
    roles = F.regexp_extract_all("text", pattern, F.lit(1))
    bodies = F.regexp_extract_all("text", pattern, F.lit(2))
    spelled = F.zip_with(roles, bodies, lambda r, b: F.concat(unescaped(r), F.lit("\n"), unescaped(b), F.lit("\n")))
    own = F.slice(spelled, F.col("n_repeated") + 1, F.size(spelled))
    cut = F.transform("loss", lambda s: F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    per_window = formatted.select(
        "conv_id",
        "window",
        "n_new",
        F.array_join(own, "").alias("turns"),
        F.array_join(F.transform(cut, unescaped), "").alias("loss"),
        F.length("text").cast("long").alias("chars"),
    )
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n_new").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = F.array_join(F.transform("w", lambda x: x["turns"]), "")
    loss = F.array_join(F.transform("w", lambda x: x["loss"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
