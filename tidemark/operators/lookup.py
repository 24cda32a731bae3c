"""Point-in-time lookup join, with retry on a miss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.rowkind import UPDATE_BEFORE, adds, byte_size
from tidemark.functions.temporal import interval_micros, micros
from tidemark.operators.skew import (
    BROADCAST_BYTES,
    Profile,
    carry_over,
    is_heavy,
    last_before,
    profile,
)
from tidemark.session import written

BROADCAST_VERSIONS_PER_KEY = 32
MAX_REPEATS = 4


def lookup_as_of(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    values: Sequence[str],
    *,
    retry_delay: str | int | None = None,
    max_retries: int = 0,
    now: Column | None = None,
    attempt: str | None = None,
    plan: str = "auto",
    parts: int | None = None,
) -> DataFrame:
    """Left join of each fact with the version of its key valid at time ``at``.

    ``versions`` is a changelog (``op``, ``commit_ts``, ``seq``, key, values). A miss is
    looked up again after each ``retry_delay``, up to ``max_retries`` times; the first
    hit counts, later changes of the version do not. ``now`` bounds the attempts made so
    far: attempts after it are not seen. ``attempt`` names a column for the number
    of the attempt that hit. Facts may be equal in all columns; every fact gives one row.

    All plans give the same rows. Plans, chosen from measured sizes unless ``plan`` names one (a named ``broadcast`` is
    the caller's word that the versions are few):

    * ``broadcast``: few versions in total and per key; facts are not shuffled.
    * ``walk``: facts and versions share one shuffle and one sort on (key, time).
      All attempts are range frames over that same sort, each ending one retry delay
      later than the one before.

    * ``plain``: a walk whose caller knows that no key has many rows; nothing is measured.

    A walk cuts heavy keys into cells of time. The version in force enters each cell as
    its first row, and versions that only a retry can see are repeated in the cells
    before them. Where the retries reach over many cells, the attempts of heavy keys
    become rows of their own instead.
    """
    if plan not in ("auto", "broadcast", "walk", "plain"):
        raise ValueError(f"unknown plan {plan!r}")
    on, values = list(on), list(values)
    delay = interval_micros(retry_delay)
    tries = max_retries if delay else 0
    history = versions.filter((F.col("op") != UPDATE_BEFORE) & _all_present(on)).select(
        *on,
        F.struct(
            micros("commit_ts").alias("t"),
            F.col("seq").alias("s"),
            adds().alias("alive"),
            *values,
        ).alias("_version"),
    )
    probes = facts.withColumn("_t", micros(at))
    limit = micros(now) if now is not None else None

    seen = None
    if plan == "auto" and _are_few(history, on):
        plan = "broadcast"
    if plan in ("auto", "walk"):
        seen = _measure(probes, history, on, parts)
    if plan == "broadcast":
        found = _broadcast_lookup(probes, history, on, delay, tries, limit)
    elif seen is None or not seen.heavy:
        found = _walk_lookup(probes, history, on, delay, tries, limit)
    elif not tries or seen.cells().most_within(delay * tries) <= MAX_REPEATS:
        found = _celled_lookup(probes, history, on, delay, tries, limit, seen)
    else:
        hot = is_heavy(on, seen.heavy)
        light = _walk_lookup(probes.filter(~hot), history.filter(~hot), on, delay, tries, limit)
        split = _attempt_lookup(
            probes.filter(hot), history.filter(hot), on, delay, tries, limit, seen.heavy, parts
        )
        found = light.unionByName(split)
    out = [F.col(f"_hit.version.{v}").alias(v) for v in values]
    if attempt:
        out.append(F.col("_hit.attempt").alias(attempt))
    return found.select(*facts.columns, *out)


def _all_present(columns: list[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def _are_few(history: DataFrame, on: list[str]) -> bool:
    """Whether the versions, in total and of each key, may be broadcast; the facts are not looked at."""
    size = byte_size(history.schema, ["_version", *on])
    keys = history.groupBy(*on).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"))
    total = keys.agg(F.max("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    return (total["n"] or 0) <= BROADCAST_VERSIONS_PER_KEY and (total["bytes"] or 0) <= BROADCAST_BYTES


def _measure(probes: DataFrame, history: DataFrame, on: list[str], parts: int | None) -> Profile:
    """The keys and times of both sides."""
    both = probes.select(*on, "_t").unionByName(history.select(*on, F.col("_version.t").alias("_t")))
    return profile(both, on, "_t", parts=parts)


def _first_hit(seen: list[Column], delay: int, limit: Column | None) -> Column:
    """The earliest attempt that was made and saw a live version, as (attempt, version)."""
    hits = []
    for k, version in enumerate(seen):
        made = F.lit(True) if limit is None or k == 0 else F.col("_t") + k * delay <= limit
        hit = F.struct(F.lit(k).alias("attempt"), version.alias("version"))
        hits.append(F.when(made & version["alive"], hit))
    return F.coalesce(*hits)


def _broadcast_lookup(probes, history, on, delay, tries, limit) -> DataFrame:
    # One bounded array per key: its length and the total were measured.
    kept = history.groupBy(*on).agg(F.collect_list("_version").alias("_versions"))
    joined = probes.join(F.broadcast(kept), on, "left")

    def seen(k: int) -> Column:
        upto = F.col("_t") + k * delay
        return F.array_max(F.filter("_versions", lambda v: v["t"] <= upto))

    return joined.withColumn("_hit", _first_hit([seen(k) for k in range(tries + 1)], delay, limit))


def _walk_lookup(probes, history, on, delay, tries, limit) -> DataFrame:
    rows = probes.withColumn("_fact", F.lit(True)).unionByName(
        history.select(*on, "_version", F.col("_version.t").alias("_t")), allowMissingColumns=True
    )
    return _walk(rows, probes.columns, on, delay, tries, limit)


def _walk(rows, columns, group, delay, tries, limit) -> DataFrame:
    by_time = Window.partitionBy(*group).orderBy("_t")
    seen = {
        f"_seen{k}": F.max("_version").over(by_time.rangeBetween(Window.unboundedPreceding, k * delay))
        for k in range(tries + 1)
    }
    walked = rows.withColumns(seen).filter("_fact")
    hit = _first_hit([F.col(c) for c in seen], delay, limit)
    return walked.select(*columns, hit.alias("_hit"))


def _celled_lookup(probes, history, on, delay, tries, limit, seen) -> DataFrame:
    cells, hot = seen.cells(), is_heavy(on, seen.heavy)
    reads = cells.assign(probes, "_t", F.lit(True), hot).withColumn("_fact", F.lit(True))
    versions = history.withColumn("_t", F.col("_version.t"))
    own = cells.assign(versions, "_t", F.lit(False), hot)
    tails = own.filter("_cell >= 0").groupBy(*on, "_cell").agg(F.max("_version").alias("_version"))
    carried = carry_over(tails, on, "_version", cells)
    if tries:
        early = own.withColumn("_early", F.col("_t") - delay * tries)
        early = cells.assign(early, "_early", F.lit(False), hot, "_first")
        own = early.withColumn("_cell", F.explode(F.sequence("_first", "_cell"))).drop("_first", "_early")
    rows = (
        reads.unionByName(own, allowMissingColumns=True)
        .unionByName(carried, allowMissingColumns=True)
        .repartition(*on, "_cell")
    )
    return _walk(rows, probes.columns, [*on, "_cell"], delay, tries, limit)


def _attempt_lookup(probes, history, on, delay, tries, limit, heavy, parts) -> DataFrame:
    """Each attempt as a row of its own; only the first carries the columns of the fact.

    Facts are numbered and written before they are taken apart, so attempts find together
    by that number whatever the columns hold, nulls and equal rows included.
    """
    columns = probes.columns
    writers = history.select(
        *on, "_version", F.col("_version.t").alias("_at"), F.col("_version.s").alias("_s")
    )
    numbered = written(probes.withColumn("_number", F.monotonically_increasing_id()), "lookup-facts")
    reads = numbered.withColumn("_attempt", F.explode(F.sequence(F.lit(0), F.lit(tries))))
    reads = reads.select(
        "_number",
        *on,
        F.when(F.col("_attempt") == 0, F.struct(*columns)).alias("_row"),
        "_attempt",
        (F.col("_t") + F.col("_attempt") * delay).alias("_at"),
    )
    if limit is not None:
        reads = reads.filter((F.col("_attempt") == 0) | (F.col("_at") <= limit))
    # Readers sort after every writer of the same instant.
    rows = reads.withColumn("_s", F.lit(2**63 - 1)).unionByName(writers, allowMissingColumns=True)
    walked = last_before(
        rows, on, "_at", "_version", "_seen", ties=["_s"], heavy=heavy, parts=parts
    ).filter(F.col("_attempt").isNotNull())
    hit = F.struct(F.col("_attempt").alias("attempt"), F.col("_seen").alias("version"))
    best = walked.groupBy("_number").agg(
        F.first("_row", ignorenulls=True).alias("_row"), F.min(F.when(F.col("_seen.alive"), hit)).alias("_hit")
    )
    return best.select("_row.*", "_hit")
