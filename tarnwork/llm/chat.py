"""Chat formatting: turn-aligned windows under a token budget, from prefix sums; column expressions only.

A formatted window is a row of turns between control strings::

    <|im_start|>role
    text<|im_end|>

Control strings inside a text get a backslash after their first character (one
more where some are there already), so no text can end its own turn, and taking one away restores it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import col, table
from tarnwork.llm.registry import query
from tarnwork.session import settle

# Control strings of common chat templates, which a text must not contain as they are.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")

START, END = "<|im_start|>", "<|im_end|>"
RESTS = "|".join(re.escape(c[1:]).replace("/", r"\/") for c in CONTROL)
BARE = rf"([<\[])(\\*)({RESTS})"
ESCAPED = rf"([<\[])(\\*)\\({RESTS})"
#: About what byte-pair encodings make of a text: short pieces of words, and each other mark by itself.
PIECE = r"[\p{L}\p{N}]{1,4}|[^\p{L}\p{N}\s]"
TURN = "struct<turn_no:bigint,role:string,text:string,tokens:bigint>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, BARE, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def role_name(role: Column) -> Column:
    """Roles of letters, digits and ``_-`` stand as they are, others as ``%`` and their UTF-8 bytes in hex; NULL is an empty name."""
    return F.when(role.isNull(), "").when(role.rlike(r"^[A-Za-z0-9_-]+$"), role).otherwise(F.concat(F.lit("%"), F.hex(role.cast("binary"))))


def role_of(name: Column) -> Column:
    return F.when(name == "", F.lit(None).cast("string")).when(name.startswith("%"), F.decode(F.unhex(F.substring(name, 2, 1 << 30)), "UTF-8")).otherwise(name)


def header(role: Column) -> Column:
    return F.concat(F.lit(START), role_name(role), F.lit("\n"))


def numbered(df: DataFrame, conv: str, turn: str, role: str, text: str, rows_per_block: int = 512) -> DataFrame:
    """``conv_id, turn_no, role, text, tokens, tokens_before``: turns counted from 0 per conversation, with prefix sums of tokens.

    Turns are numbered by ``turn``, then role and text, NULLs first. Sums are taken per block of turns first and blocks are
    added up after that, so a conversation with a large share of all rows is spread over many tasks.
    """
    body = F.coalesce(col(text), F.lit(""))
    rows = df.select(col(conv).alias("conv_id"), col(turn).alias("turn"), col(role).alias("role"), body.alias("text"))
    rows = rows.withColumn("tokens", (F.regexp_count(header(F.col("role")), F.lit(PIECE)) + F.regexp_count("text", F.lit(PIECE)) + 3).cast("long"))
    # Blocks must follow the order of turns; a whole-number turn is cut by value.
    block = F.floor(F.col("turn") / rows_per_block) if dict(df.dtypes)[turn] in ("bigint", "int", "smallint", "tinyint") else F.lit(0)
    rows = rows.withColumn("block", block.cast("long"))
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc("text")]
    sums = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t_before"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("k", F.row_number().over(within) - 1).withColumn("s", F.sum("tokens").over(upto) - F.col("tokens"))
    joined = local.join(offsets, local["conv_id"].eqNullSafe(offsets["c"]) & local["block"].eqNullSafe(offsets["b"]))
    numbered = joined.select("conv_id", (F.col("n_before") + F.col("k")).cast("long").alias("turn_no"), "role", "text", "tokens", (F.col("t_before") + F.col("s")).alias("tokens_before"))
    return settle(numbered, "turns")


def format_chats(
    df: DataFrame,
    budget: int = 2048,
    history: int = 512,
    system_share: float = 0.25,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per window: ``conv_id, window_no, formatted, loss, n_turns, n_repeated, tokens, over_budget, has_system, new_system``.

    ``window_no`` rises within the conversation, with gaps; ``n_turns`` and ``n_repeated`` leave the system turn out,
    which ``has_system`` and (in its first window) ``new_system`` tell of.

    A conversation's first turn is kept in all its windows if its role is ``system``. The other
    turns' prefix sums of tokens are cut at multiples of what the budget leaves: turns that lie
    within one multiple are a window's span, and a turn that crosses a cut is a span by itself.
    Before a span stand the system turn and as many of the turns just before it as end within
    ``history`` tokens. ``loss`` lists ``start, end`` (code points of ``formatted``, end
    exclusive) of the new assistant turns' escaped texts: what is repeated is masked, so every assistant text counts once.
    A turn, or a system turn, too long for the budget stays whole and its window is marked ``over_budget``.

    NULL texts are empty; NULL or odd roles are written reversibly and never targets; a NULL conversation id is a
    conversation; repeated turns all count; an empty table gives no windows; other columns are ignored.
    """
    if budget - history - int(system_share * budget) < 1:
        raise ValueError("the budget leaves no room for new turns")
    turns = numbered(df, conv_col, turn_col, role_col, text_col)
    system = (F.col("turn_no") == 0) & F.coalesce(F.col("role") == "system", F.lit(False))
    heads = turns.where(system).select(F.col("conv_id").alias("head_id"), F.struct("turn_no", "role", "text", "tokens").alias("head"))
    turns = turns.join(heads, turns["conv_id"].eqNullSafe(heads["head_id"]), "left").drop("head_id")
    head_tokens = F.coalesce(F.col("head.tokens"), F.lit(0))
    # A system turn beyond its share does not narrow the spans further; its windows are marked instead.
    room = F.lit(budget - history) - F.least(head_tokens, F.lit(int(system_share * budget)))
    begin = F.col("tokens_before") - head_tokens
    final = begin + F.col("tokens") - 1
    turns = turns.withColumns({"first_cut": F.floor(begin / room), "last_cut": F.floor(final / room), "begin": begin})
    crossing = (F.col("first_cut") != F.col("last_cut")).cast("long")
    # Spans in order: within cut k, then the turn that leaves it.
    body = turns.where(~(F.col("head").isNotNull() & (F.col("turn_no") == 0))).withColumn("span", 2 * F.col("first_cut") + crossing)
    turn = F.struct("turn_no", "role", "text", "tokens")
    firsts = body.groupBy("conv_id", "span").agg(F.min("begin").alias("opens"), F.min("first_cut").alias("cut"))
    # A window repeats turns that begin in the history before it. They lie in a few cuts, so they are sent there by number.
    cuts_back = F.lit(1) + F.ceil(F.lit(history) / F.least(room, F.lit(budget)))
    sent = body.where(F.col("tokens") <= history).select("conv_id", "begin", "first_cut", turn.alias("turn"), F.explode(F.sequence(F.col("first_cut"), F.col("first_cut") + cuts_back)).alias("cut"))
    f, s = firsts.alias("f"), sent.alias("s")
    near = F.col("f.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("f.cut") == F.col("s.cut"))
    before = (F.col("s.begin") < F.col("f.opens")) & (F.col("s.begin") >= F.col("f.opens") - history)
    repeated = f.join(s, near & before).select("f.conv_id", "f.span", F.col("s.turn").alias("turn"), F.lit(True).alias("repeated"))
    kept = body.select("conv_id", "span", turn.alias("turn"), F.lit(False).alias("repeated"))
    entries = kept.unionByName(repeated).groupBy("conv_id", "span").agg(F.sort_array(F.collect_list(F.struct(F.col("turn.turn_no"), "repeated", "turn"))).alias("entries"))
    # Conversations of a system turn alone still give a window.
    alone = heads.select(F.col("head_id").alias("conv_id"), "head")
    known = body.select("conv_id").distinct()
    only = alone.join(known.withColumnRenamed("conv_id", "known_id"), F.col("conv_id").eqNullSafe(F.col("known_id")), "left_anti")
    empty = F.array().cast(f"array<struct<turn_no:bigint,repeated:boolean,turn:{TURN}>>")
    windows = entries.join(alone.withColumnRenamed("conv_id", "head_id"), F.col("conv_id").eqNullSafe(F.col("head_id")), "left").select("conv_id", "span", "entries", "head")
    windows = windows.unionByName(only.select("conv_id", F.lit(0).cast("long").alias("span"), empty.alias("entries"), "head"))

    def piece(t: Column, repeated: Column) -> Column:
        """A formatted turn: header, text, and whether it is a target."""
        return F.struct(header(t["role"]).alias("head"), escaped(t["text"]).alias("body"), (~repeated & F.coalesce(t["role"] == "assistant", F.lit(False))).alias("target"))

    pieces = F.concat(
        F.when(F.col("head").isNotNull(), F.array(piece(F.col("head"), F.lit(True)))).otherwise(F.array().cast("array<struct<head:string,body:string,target:boolean>>")),
        F.transform("entries", lambda e: piece(e["turn"], e["repeated"])),
    )
    tail = END + "\n"
    # Running lengths: where each piece begins, and the loss spans so far.
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        return F.struct((end + len(tail)).alias("at"), F.when(p["target"], F.concat(acc["loss"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["loss"]).alias("loss"))

    n_repeated = F.size(F.filter("entries", lambda e: e["repeated"]))
    total = F.aggregate("entries", F.coalesce(F.col("head.tokens"), F.lit(0)).cast("long"), lambda acc, e: acc + e["turn"]["tokens"])
    windows = windows.withColumns({"pieces": pieces, "n_turns": F.size("entries"), "n_repeated": n_repeated, "tokens": total})
    windows = windows.withColumn("loss", F.aggregate("pieces", begun, step)["loss"])
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    has_system = F.col("head").isNotNull()
    opens = has_system & ((F.size("entries") == 0) | F.exists("entries", lambda e: ~e["repeated"] & (e["turn_no"] == 1)))
    return windows.select(
        "conv_id", F.col("span").alias("window_no"), formatted.alias("formatted"), "loss", "n_turns", "n_repeated", "tokens",
        (F.col("tokens") > budget).alias("over_budget"), has_system.alias("has_system"), opens.alias("new_system"),
    )


def read_chats(windows: DataFrame) -> DataFrame:
    """``conv_id, window_no, turns``: role and text of each window's new turns, read back from ``formatted`` alone but for the counts.

    The system turn counts as new in a conversation's first window; repeated turns are left out.
    """
    parts = F.filter(F.split("formatted", re.escape(START)), lambda p: p != "")
    turns = F.transform(parts, lambda p: F.struct(role_of(F.substring_index(p, "\n", 1)).alias("role"), unescaped(p.substr(F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END) - 1)).alias("text")))
    head = F.col("has_system").cast("int")
    first = F.slice("turns", 1, F.col("new_system").cast("int"))
    new = F.slice("turns", head + F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    return windows.withColumn("turns", turns).withColumn("turns", F.concat(first, new))


@query("op3_chat_formatting")
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    own = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    back = read_chats(format_chats(chats))
    text = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    lost = F.array_join(F.transform("loss", lambda m: unescaped(F.substring(F.col("formatted"), m["start"] + 1, m["end"] - m["start"]))), "")
    rows = back.select("conv_id", "window_no", F.size("turns").alias("n"), text.alias("text"), lost.alias("lost"), F.length("formatted").alias("chars"))
    # A digest of a whole conversation needs its text in one row; nothing else here does.
    whole = rows.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("window_no", "text", "lost"))).alias("w")
    )
    whole = whole.withColumns({"text": F.array_join("w.text", ""), "lost": F.array_join("w.lost", "")})
    return whole.select(
        "conv_id", "n_turns", F.sha2("text", 256).alias("turns_sha256"), F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"), "formatted_chars"
    )
