"""Chat formatting: logged snapshots of growing conversations collapse into the longest, which are rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

#: Turns of a conversation that are held together at a time; longer conversations are rendered in parts.
PART = 256

#: How a turn is rendered.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def numbered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, role, text, pos)``: the turns of each conversation numbered from 0.

    In order of turn (nulls first), then role, then text. Turns are counted in blocks of
    neighbouring turn numbers, and a block starts after all turns of the blocks before it,
    so a conversation of any length is never sorted in one task.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / PART), F.lit(-(1 << 62))).cast("long"))
    within = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = rows.withColumn("within", F.row_number().over(within))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    blocks = blocks.select("conv", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return _with(rows, blocks, "conv", "block").select(
        "conv", "role", "text", (F.col("within") + F.col("earlier") - 1).alias("pos")
    )


def _with(rows: DataFrame, facts: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with the one row of ``facts`` that has the same keys, nulls equal to each other."""
    same = [rows[k].eqNullSafe(facts[k]) for k in keys]
    return rows.join(facts, same).drop(*(facts[k] for k in keys))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``(conv, n, h1, h2)``: two hashes of the first ``n`` turns of each conversation, for every ``n``.

    A turn's hash covers its position, role and text, and a prefix is the exclusive or of
    its turns' hashes: rolled forward turn by turn within blocks of ``PART`` positions, and
    from block to block over one hash per block.
    """
    marked = [F.coalesce(F.col(c).isNull(), F.lit(False)) for c in ("role", "text")]
    rows = turns.select(
        "conv",
        "pos",
        F.floor(F.col("pos") / PART).alias("block"),
        *(F.xxhash64(F.lit(seed), "pos", "role", "text", *marked).alias(f"t{seed}") for seed in (1, 2)),
    )
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv", "block", *(F.coalesce(F.bit_xor(b).over(before), F.lit(0).cast("long")).alias(b) for b in ("b1", "b2"))
    )
    upto = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "conv", "pos", "block", F.bit_xor("t1").over(upto).alias("t1"), F.bit_xor("t2").over(upto).alias("t2")
    )
    return _with(rows, sums, "conv", "block").select(
        "conv", (F.col("pos") + 1).alias("n"), F.expr("t1 ^ b1").alias("h1"), F.expr("t2 ^ b2").alias("h2")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv, n_turns)`` of the conversations (``conv, role, text, pos``) that no longer one begins with.

    Of equal conversations the smallest id stays, nulls last.
    """
    prefixes = written(prefix_hashes(turns), "prefixes")
    ends = turns.groupBy("conv").agg(F.count("*").alias("n"))
    same = prefixes["conv"].eqNullSafe(ends["conv"]) & (prefixes["n"] == ends["n"])
    whole = prefixes.join(ends.select("conv", "n"), same, "left_semi")
    # One row per distinct conversation: equal ones are combined before anything else is compared.
    distinct = whole.groupBy("n", "h1", "h2").agg(F.min("conv").alias("conv"))
    proper = prefixes.join(ends.select("conv", "n"), same, "left_anti").select("n", "h1", "h2").distinct()
    return distinct.join(proper, ["n", "h1", "h2"], "left_anti").select("conv", F.col("n").alias("n_turns"))


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn as text; a null role or text is empty."""
    return F.concat(
        F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(CLOSE)
    )


def formatted(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Training texts of the maximal conversations: ``conv_id``, ``part``, ``n_turns``, ``text``.

    A conversation that equals the beginning of a longer one is a snapshot of it and goes;
    of equal conversations the one with the smallest id stays. What stays is rendered turn
    by turn. A conversation of more than ``PART`` turns comes in parts of ``PART`` turns, so
    no row grows without bound; ``n_turns`` counts the whole conversation.

    Turns stand in order of turn number (nulls first), role and text; repeated rows are
    turns of their own. Null roles and texts render as empty but differ from empty ones
    when conversations are compared. Rows with a null conversation id form one
    conversation. Other columns are ignored, an empty table gives no rows. DataFrame
    functions only.
    """
    rows = written(numbered(turns, conv_col, turn_col, role_col, text_col), "turns")
    kept = maximal(rows)
    rows = _with(rows, kept, "conv")
    parts = rows.groupBy("conv", F.floor(F.col("pos") / PART).alias("part"), "n_turns").agg(
        F.sort_array(F.collect_list(F.struct("pos", rendered_turn(F.col("role"), F.col("text")).alias("text")))).alias("t")
    )
    return parts.select(
        F.col("conv").alias(conv_col), "part", "n_turns", F.concat_ws("", F.col("t.text")).alias("text")
    )


#: The same for DuckDB, over the table ``conversations``.
SQL = """
WITH t AS (
    SELECT conv_id, role, text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
    FROM conversations),
p AS (
    SELECT conv_id, pos, role, text,
        list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
        count(*) OVER (PARTITION BY conv_id) AS n
    FROM t),
h AS (SELECT conv_id, pos, n, md5(CAST(prefix AS VARCHAR)) AS h FROM p),
w AS (SELECT n, h, min(conv_id) AS conv_id FROM h WHERE pos + 1 = n GROUP BY n, h),
k AS (
    SELECT * FROM w WHERE NOT EXISTS (
        SELECT 1 FROM h WHERE h.pos + 1 < h.n AND h.pos + 1 = w.n AND h.h = w.h))
SELECT t.conv_id, t.pos // 256 AS part, k.n AS n_turns, string_agg(
    '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
    ORDER BY pos) AS text
FROM t JOIN k USING (conv_id) GROUP BY ALL
"""
