"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens choose turn-aligned spans; a conversation comes in blocks of bounded
size, in which windows are opened one after another. Each window after the first repeats the system
turn and a limited history; repeated turns are outside its loss mask, so that every assistant text
is a target once. A turn is written as

    [ROLE] role [/ROLE] text </s>

after the window's <s>. A control string inside a role or text gets a backslash before it; one
backslash before each such string is taken off again on reading, so any text survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

CONTROLS = r"(</?s>|\[/?INST\]|\[/?ROLE\])"
BEGIN, OPEN, CLOSE, END = "<s>", "[ROLE] ", " [/ROLE] ", " </s>"
KNOWN = "array<struct<role:string,text:string,cost:bigint>>"
TURN = r"(?s)\[ROLE\] (.*?) \[/ROLE\] (.*?) </s>"


def escape(c: Column) -> Column:
    some = F.contains(c, F.lit("[")) | F.contains(c, F.lit("<"))  # most texts need no pattern
    return F.when(some, F.regexp_replace(c, CONTROLS, r"\\$1")).otherwise(c)


def unescape(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\\")), F.regexp_replace(c, r"\\" + CONTROLS, "$1")).otherwise(c)


def format_conversations(rows: DataFrame, budget: int = 2048, history_turns: int = 2, history_budget: int = 256, bytes_per_token: int = 4, turn_overhead: int = 8, block_windows: int = 64) -> DataFrame:
    """One row per window: conv_id, first_turn, n_repeated, n_new, formatted, loss_spans.

    rows has conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn, then
    role and text, so ties and repeated rows all stay, in one order. Null roles and texts are empty;
    a null conv_id is a conversation of its own; a null turn comes first. A turn's tokens are
    estimated as ceil(bytes / bytes_per_token) + turn_overhead. A first turn of role system is kept
    in each window. New turns fill a window while they, the system turn and the room for history
    (history_budget, in windows after the first) stay within budget; a turn that is larger still gets
    a window alone and whole. History is the longest run of at most history_turns turns before the
    window within history_budget. first_turn is the place (from 0) of the first new turn in its
    conversation; loss_spans are (start, end) in code points of formatted.

    A conversation is cut into blocks of block_windows budgets by its prefix sums, where a window
    always begins anew. Turns come together only in blocks, with the system turn and the history
    before the block, so a row is bounded by these budgets and the longest turn; a conversation of any
    length is numbered and summed by a sort that can spill.
    """
    clean = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    cost = F.ceil(F.octet_length("text") / F.lit(bytes_per_token)) + F.lit(turn_overhead)
    clean = clean.withColumn("cost", cost.cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    fields = ["role", "text", "cost"]
    told = F.struct(*fields)
    clean = clean.select(
        "conv_id", *fields, (F.row_number().over(order) - 1).cast("long").alias("i"), F.sum("cost").over(upto).alias("upto"), F.lag("cost", 1, 0).over(order).alias("cost_before"),
        F.first(F.when(F.col("role") == "system", told)).over(upto).alias("system"), F.array(*(F.lag(told, j).over(order) for j in range(history_turns, 0, -1))).cast(KNOWN).alias("before"),
    )
    # a system turn isn't counted, so that the turn after it is in the first block
    n_sys = F.when(F.col("system").isNotNull(), 1).otherwise(0)
    sys = F.coalesce(F.col("system.cost"), F.lit(0).cast("long"))
    block = lambda start: F.floor(F.greatest(F.lit(0), start - sys) / F.lit(block_windows * budget))
    start = F.col("upto") - F.col("cost")
    clean = clean.withColumn("n_sys", n_sys).withColumn("sys", sys).withColumn("block", block(start))
    opens = (F.col("i") == 0) | (F.col("block") != block(start - F.col("cost_before")))
    known = F.slice("before", F.greatest(F.lit(1), history_turns + 1 - (F.col("i") - F.col("n_sys")).cast("int")), history_turns)
    like = lambda t: F.struct(F.lit(-1).cast("long").alias("i"), F.lit(0).cast("long").alias("upto"), *(t[f].alias(f) for f in fields))  # noqa: E731  as turns are
    known = F.transform(F.when(F.col("block") == 0, F.slice("before", 1, 0)).otherwise(known), like)
    first = F.when(opens, F.struct(known.alias("before"), F.when(F.col("n_sys") == 1, like(F.col("system"))).alias("system"), "n_sys", "sys"))
    turns = clean.select("conv_id", "block", F.struct("i", "upto", *fields).alias("t"), first.alias("first"))
    conv = turns.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.first("first", ignorenulls=True).alias("first"))
    conv = conv.select("conv_id", "block", "ts", "first.*").withColumn("lead", F.when(F.col("block") == 0, F.col("n_sys")).otherwise(0))

    # The fold keeps the first turns of windows and the prefix sum before the open one.
    room = F.greatest(F.lit(0), F.lit(budget) - F.col("sys"))
    later_room = F.greatest(F.lit(0), room - F.lit(history_budget)).cast("long")
    base = F.col("ts")[0]["upto"] - F.when(F.col("lead") == 1, 0).otherwise(F.col("ts")[0]["cost"])
    zero = F.struct(F.array(F.col("lead")).alias("starts"), base.cast("long").alias("base"), F.when(F.col("block") == 0, room.cast("long")).otherwise(later_room).alias("room"))

    def step(acc, i):
        # ts is 1-based in element_at: i + 1 is turn i, i is the turn before
        here = F.element_at(F.col("ts"), i + 1)["upto"]
        before = F.element_at(F.col("ts"), i)["upto"]
        opens = here - acc["base"] > acc["room"]
        return F.struct(
            F.when(opens, F.concat(acc["starts"], F.array(i))).otherwise(acc["starts"]).alias("starts"),
            F.when(opens, before).otherwise(acc["base"]).alias("base"), F.when(opens, later_room).otherwise(acc["room"]).alias("room"),
        )

    later = F.when(F.size("ts") > F.col("lead") + 1, F.sequence(F.col("lead") + 1, F.size("ts") - 1)).otherwise(F.array().cast("array<int>"))
    conv = conv.withColumn("starts", F.aggregate(later, zero, step)["starts"])

    def window(s, k):
        stop = F.coalesce(F.try_element_at(F.col("starts"), k + 2), F.size("ts"))
        again = (k > 0) | (F.col("block") > 0)
        own = F.least(F.lit(history_turns), s - F.col("lead"))  # no transform here, as it would copy texts
        behind = F.concat("before", F.slice("ts", s - own + 1, own))
        near = F.slice(behind, F.greatest(F.lit(1), F.size(behind) - history_turns + 1), history_turns)
        places = F.when(F.size(near) > 0, F.sequence(F.lit(1), F.size(near))).otherwise(F.array().cast("array<int>"))
        tokens_from = lambda j: F.aggregate(F.slice(near, j, F.size(near)), F.lit(0).cast("long"), lambda n, t: n + t["cost"])
        from_here = F.coalesce(F.array_min(F.filter(places, lambda j: tokens_from(j) <= history_budget)), F.size(near) + 1)
        history = F.slice(near, from_here, F.size(near) + 1 - from_here)
        kept_sys = F.when(again & (F.col("n_sys") == 1), F.array("system")).otherwise(F.slice(F.array("system"), 1, 0))
        first_new = F.when(again, s).otherwise(F.lit(0))
        repeated = F.when(again, F.concat(kept_sys, history)).otherwise(kept_sys)
        return F.struct(
            F.element_at("ts", first_new + 1)["i"].alias("first_turn"), F.size(repeated).alias("n_repeated"), F.concat(repeated, F.slice("ts", first_new + 1, stop - first_new)).alias("turns"),
        )

    wins = conv.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.*")
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE))
    wins = wins.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), head(t).alias("head"), escape(t["text"]).alias("body"))))
    size_of = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END)

    def place(acc, t):
        at = acc["at"] + F.length(t["head"])
        target = (t["role"] == "assistant") & (acc["i"] >= F.col("n_repeated"))
        span = F.array(F.struct(at.alias("start"), (at + F.length(t["body"])).alias("end")))
        return F.struct((acc["i"] + 1).alias("i"), (acc["at"] + size_of(t)).alias("at"), F.when(target, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    zero = F.struct(F.lit(0).alias("i"), F.lit(len(BEGIN)).alias("at"), none.alias("spans"))
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return wins.select(
        "conv_id", "first_turn", "n_repeated", (F.size("turns") - F.col("n_repeated")).alias("n_new"), F.concat(F.lit(BEGIN), body).alias("formatted"), F.aggregate("turns", zero, place)["spans"].alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """From formatted windows: conv_id, first_turn, turns (role, text; the new ones), targets, formatted_chars."""
    roles, texts = (F.regexp_extract_all("formatted", F.lit(TURN), F.lit(g)) for g in (1, 2))
    turns = F.arrays_zip(roles.alias("role"), texts.alias("text"))
    new = F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size(turns) - F.col("n_repeated"), F.lit(0)))
    new = F.transform(new, lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))
    targets = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"])))
    return windows.select("conv_id", "first_turn", new.alias("turns"), targets.alias("targets"), F.length("formatted").cast("long").alias("formatted_chars"))


def op7_chat_formatting(spark, sf_dir):
    sample = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(sample).alias("text"))
    rows = rows.unionByName(extra)
    got = read_windows(format_conversations(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct("first_turn", F.size("turns").cast("long").alias("n"), said.alias("said"), F.array_join("targets", "").alias("target"), "formatted_chars")
    # a digest is of one sequence: this alone puts a conversation's texts together, each of them once
    whole = got.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("ws"))
    total = lambda f: F.aggregate("ws", F.lit(0).cast("long"), lambda n, w: n + w[f])
    joined = lambda f: F.array_join(F.transform("ws", lambda w: w[f]), "").cast("binary")
    loss_chars = F.aggregate("ws", F.lit(0).cast("long"), lambda n, w: n + F.length(w["target"]))
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(joined("said"), 256).alias("turns_sha256"), loss_chars.alias("loss_chars"), F.sha2(joined("target"), 256).alias("loss_sha256"),
        total("formatted_chars").alias("formatted_chars"),
    )


ORACLE_OP7 = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, regexp_replace(role, '(</?s>|\[/?INST\]|\[/?ROLE\])', '\\\1', 'g') AS erole,
        regexp_replace(text, '(</?s>|\[/?INST\]|\[/?ROLE\])', '\\\1', 'g') AS etext,
        CAST(ceil(strlen(text) / 4.0) AS BIGINT) + 8 AS cost
    FROM t
), n AS (
    SELECT *, row_number() OVER w - 1 AS i, sum(cost) OVER w AS upto, length(erole) + length(etext) + 21 AS chars
    FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
), c AS (
    SELECT conv_id, list(struct_pack(role := role, upto := upto, cost := cost, chars := chars) ORDER BY i) AS ts,
        CASE WHEN min(CASE WHEN i = 0 THEN role END) = 'system' THEN 1 ELSE 0 END AS n_sys
    FROM n GROUP BY conv_id
), s AS (
    SELECT *, CASE WHEN n_sys = 1 THEN ts[1].upto ELSE 0 END AS sys FROM c
), b AS (
    SELECT *, list_transform(ts, lambda x: greatest(0, x.upto - x.cost - sys) // 131072) AS blocks FROM s
)
"""


def oracle_sql() -> str:
    """DuckDB SQL for op7_chat_formatting; a recursive query walks the turns to open windows."""
    return (
        ORACLE_OP7.replace("WITH t AS", "WITH RECURSIVE t AS").rstrip()
        + r""", f AS (
    SELECT conv_id, n_sys AS i, n_sys AS first, CAST(sys AS BIGINT) AS base, CAST(greatest(0, 2048 - sys) AS BIGINT) AS room FROM b
    UNION ALL
    SELECT conv_id, i + 1, CASE WHEN o THEN i + 1 ELSE first END, CAST(CASE WHEN o THEN before ELSE base END AS BIGINT), CAST(CASE WHEN o THEN later ELSE room END AS BIGINT)
    FROM (
        SELECT f.*, b.ts[f.i + 1].upto AS before, greatest(0, greatest(0, 2048 - b.sys) - 256) AS later, b.ts[f.i + 2].upto - f.base > f.room OR b.blocks[f.i + 2] <> b.blocks[f.i + 1] AS o
        FROM f JOIN b USING (conv_id) WHERE f.i + 1 < len(b.ts)
    )
), opened AS (
    SELECT DISTINCT f.conv_id, f.first, s.n_sys, s.ts FROM f JOIN s USING (conv_id)
), repeats AS (
    SELECT conv_id, first, CASE WHEN first = n_sys THEN 3 ELSE 3 + CASE WHEN n_sys = 1 THEN ts[1].chars ELSE 0 END
        + CASE WHEN first - 2 >= n_sys AND ts[first].upto - CASE WHEN first = 2 THEN 0 ELSE ts[first - 2].upto END <= 256 THEN ts[first].chars + ts[first - 1].chars
               WHEN first - 1 >= n_sys AND ts[first].cost <= 256 THEN ts[first].chars ELSE 0 END END AS extra
    FROM opened
)
SELECT n.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) + (SELECT sum(extra) FROM repeats r WHERE r.conv_id = n.conv_id) AS BIGINT) AS formatted_chars
FROM n GROUP BY n.conv_id
"""
    )
