"""Plans for heavy keys give the rows of the plain plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import changelog_of
from tidemark.operators.lookup import lookup_as_of
from tidemark.operators import lookup
from tidemark.operators.joins import last_match
from tidemark.operators.skew import Cells, even_marks, heavy_keys, last_before, profile

T0 = dt.datetime(2024, 1, 1)


def facts(spark, n=3000):
    """A third of the facts name product 1, a tenth of them at one instant; some name none."""
    i = F.col("id")
    return spark.range(n).select(
        i.alias("seq"),
        F.when(i % 3 == 0, 1).when(i % 50 == 1, None).otherwise(i % 17 + 2).cast("int").alias("k"),
        F.timestamp_seconds(F.when(i % 10 == 0, 5000).otherwise(1 + i * 7919 % 10_000)).alias("at"),
    )


def versions(spark, n=900):
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 5 == 4, "-D").otherwise("+I").alias("op"),
        (i * 2 + 1).alias("seq"),
        F.when(i % 3 == 0, 1).otherwise(i % 19).cast("int").alias("k"),
        F.timestamp_seconds(F.when(i % 90 == 0, 5000).otherwise(i * 31 % 10_000)).alias("commit_ts"),
        F.concat(F.lit("v"), i.cast("string")).alias("name"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute_force(spark, delay, tries):
    kept = {}
    for v in sorted(versions(spark).collect(), key=lambda v: (v["commit_ts"], v["seq"])):
        kept.setdefault(v["k"], []).append(v)
    out = []
    for f in facts(spark).collect():
        name = attempt = None
        for k in range(tries + 1):
            at = f["at"] + k * dt.timedelta(seconds=delay)
            seen = [v for v in kept.get(f["k"], []) if v["commit_ts"] <= at]
            if f["k"] is not None and seen and seen[-1]["op"] != "-D":
                name, attempt = seen[-1]["name"], k
                break
        out.append((f["seq"], f["k"], f["at"], name, attempt))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tries", [0, 3])
@pytest.mark.parametrize("plan", ["broadcast", "plain", "walk", "cells", "attempts"])
def test_lookup_plans_agree_with_brute_force(spark, plan, tries, request, monkeypatch):
    if plan in ("cells", "attempts"):
        request.getfixturevalue("split_everything")
        monkeypatch.setattr(lookup, "MAX_REPEATS", 1000 if plan == "cells" else 0)
    found = lookup_as_of(
        facts(spark), versions(spark), ["k"], "at", ["name"],
        retry_delay="200 seconds", max_retries=tries, attempt="attempt",
        plan=plan if plan in ("broadcast", "plain") else "walk",
    )
    assert rows(found) == brute_force(spark, 200, tries)


def test_lookup_without_any_version(spark):
    none = versions(spark).limit(0)
    found = lookup_as_of(facts(spark), none, ["k"], "at", ["name"], retry_delay="1 second", max_retries=1)
    assert found.count() == 3000
    assert found.filter("name is not null").isEmpty()


def test_lookup_sees_no_attempt_after_now(spark):
    now = F.lit("1970-01-01 01:00:00").cast("timestamp")
    full = lookup_as_of(
        facts(spark), versions(spark), ["k"], "at", ["name"], retry_delay="200 seconds", max_retries=3,
        attempt="attempt", plan="walk",
    )
    part = lookup_as_of(
        facts(spark), versions(spark), ["k"], "at", ["name"], retry_delay="200 seconds", max_retries=3,
        attempt="attempt", plan="walk", now=now,
    )
    allowed = (F.col("attempt") == 0) | (F.unix_seconds("at") + F.col("attempt") * 200 <= 3600)
    expected = full.select(
        "seq", F.when(allowed, F.col("name")).alias("name"), F.when(allowed, F.col("attempt")).alias("attempt")
    )
    assert rows(part.select("seq", "name", "attempt")) == rows(expected)


def test_heavy_keys_are_the_big_ones(spark, split_everything):
    hot = heavy_keys(facts(spark).select("k"), ["k"], parts=8)
    assert hot == [r[0] for r in spark.sql("select xxhash64(1)").collect()]


def test_small_data_has_no_heavy_keys(spark):
    assert heavy_keys(facts(spark), ["k"]) == []


def test_cells_hold_similar_shares(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), "id", F.lit(None).cast("int").alias("p"))
    cells = profile(df, ["k"], "id", parts=16).cells()
    sizes = [r["count"] for r in cells.assign(df, "id", F.lit(True), F.lit(True)).groupBy("_cell").count().collect()]
    assert len(sizes) == 16
    assert max(sizes) < 2 * 10_000 / 16


def test_one_instant_is_dealt_over_cells(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("row"), F.lit(7).cast("bigint").alias("id"))
    cells = profile(df, ["k"], "id", parts=16).cells()
    sizes = [r["count"] for r in cells.assign(df, "id", F.lit(True), F.lit(True)).groupBy("_cell").count().collect()]
    assert max(sizes) < 2 * 10_000 / 15


def test_last_before_split_equals_plain(spark, split_everything):
    df = facts(spark).withColumn("p", F.when(F.col("seq") % 4 == 0, F.col("seq")))
    plain = last_before(df, ["k"], "seq", "p", "before", heavy=())
    split = last_before(df, ["k"], "seq", "p", "before")
    assert rows(plain) == rows(split)


def test_changelog_of_a_hot_key(spark, split_everything):
    history = versions(spark).withColumn("price", (F.col("seq") % 11).cast("int"))
    split = changelog_of(history, ["k"], ["price"])
    expected = []
    live = {}
    for v in sorted(history.collect(), key=lambda v: v["seq"]):
        old, new = live.get(v["k"]), None if v["op"] == "-D" else v["price"]
        live[v["k"]] = new
        if old == new:
            continue
        if old is not None:
            expected.append(("-U" if new is not None else "-D", v["k"], v["seq"], old))
        if new is not None:
            expected.append(("+U" if old is not None else "+I", v["k"], v["seq"], new))
    assert rows(split) == sorted(expected, key=repr)


@pytest.mark.parametrize("plan", ["broadcast", "plain", "walk", "cells", "attempts"])
def test_every_fact_gives_a_row_whatever_the_plan(spark, plan, request, monkeypatch):
    """Facts that share their id, have none, or are equal in all columns."""
    if plan in ("cells", "attempts"):
        request.getfixturevalue("split_everything")
        monkeypatch.setattr(lookup, "MAX_REPEATS", 1000 if plan == "cells" else 0)
    some = facts(spark, 400)
    several = (
        some.unionByName(some.filter("seq < 150"))
        .unionByName(some.withColumn("seq", F.lit(None).cast("bigint")).filter("k < 4"))
        .withColumn("seq", F.when(F.col("seq") > 300, F.col("seq") % 7).otherwise(F.col("seq")))
    )
    named = {}
    for delay, tries in ((200, 3),):
        found = lookup_as_of(
            several, versions(spark), ["k"], "at", ["name"], retry_delay=f"{delay} seconds", max_retries=tries,
            attempt="attempt", plan=plan if plan in ("broadcast", "plain") else "walk",
        )
        plain = lookup_as_of(
            several, versions(spark), ["k"], "at", ["name"], retry_delay=f"{delay} seconds", max_retries=tries,
            attempt="attempt", plan="broadcast",
        )
        named[delay] = rows(found)
        assert len(named[delay]) == several.count() and named[delay] == rows(plain)


@pytest.mark.parametrize("plan", ["broadcast", "plain", "walk", "cells", "attempts"])
def test_facts_that_differ_in_nulls_only(spark, plan, request, monkeypatch):
    """A null here is not the same as a null there, also without a position."""
    if plan in ("cells", "attempts"):
        request.getfixturevalue("split_everything")
        monkeypatch.setattr(lookup, "MAX_REPEATS", 1000 if plan == "cells" else 0)
    pairs = [("x", None), (None, "x"), (None, None), ("x", "x"), ("x", None)]
    seq = [(None if n % 2 else n // 10, n % 4 and 1, a, b) for n in range(40) for a, b in pairs]
    facts_df = spark.createDataFrame(seq, "seq bigint, k int, a string, b string").withColumn(
        "at", F.timestamp_seconds(F.lit(4000) + F.coalesce("seq", F.lit(9)))
    )
    found = lookup_as_of(
        facts_df, versions(spark), ["k"], "at", ["name"], retry_delay="200 seconds", max_retries=3,
        plan=plan if plan in ("broadcast", "plain") else "walk",
    )
    assert rows(found.select("seq", "k", "a", "b")) == rows(facts_df.select("seq", "k", "a", "b"))
    plain = lookup_as_of(
        facts_df, versions(spark), ["k"], "at", ["name"], retry_delay="200 seconds", max_retries=3, plan="broadcast"
    )
    assert rows(found) == rows(plain)


def test_even_marks_of_many_input_partitions(spark):
    df = spark.range(0, 40_000, 1, 40).select((F.col("id") * 7919 % 40_000).alias("at"))
    marks = even_marks(df, "at", 20)
    assert len(marks) == 19 and all(abs(m - 2000 * (i + 1)) < 800 for i, m in enumerate(marks))
    assert even_marks(df.limit(0), "at", 4) == []


def test_cells_within_a_distance():
    cells = Cells.between([10, 20, 20, 20, 30, 90])
    assert cells.count == 1 + 1 + 4 + 1 + 1 + 1
    assert cells.most_within(0) == 5
    assert cells.most_within(1) == 6
    assert cells.most_within(1000) == cells.count


def test_changelog_join_of_a_hot_customer(spark, split_everything):
    """Against every meeting of every pair of versions, on few rows."""
    import random

    rng = random.Random(3)
    seqs = iter(range(1, 10_000))
    orders, names = [], []
    for _ in range(300):
        if rng.random() < 0.7:
            key = rng.randrange(60)
            orders.append((rng.choice(["+I", "+U", "+U", "-D"]), next(seqs), key, 1 if rng.random() < 0.4 else rng.randrange(8)))
        else:
            key = rng.randrange(8)
            seq = next(seqs)
            names.append((rng.choice(["+I", "+U", "+U", "-D"]), seq, key, f"n{seq}"))
    facts_df = spark.createDataFrame(orders, "op string, seq bigint, o int, c int")
    dims_df = spark.createDataFrame(names, "op string, seq bigint, c int, name string")
    got = last_match(facts_df, dims_df, ["c"], ["o"], ["name"]).select("o", "seq", "name")

    def lives(log, key):
        out = []
        for i, row in enumerate(log):
            until = next((r[1] for r in log[i + 1 :] if r[key] == row[key]), 10**9)
            if row[0] != "-D":
                out.append((row, row[1], until))
        return out

    expected = []
    for order, start, end in lives(orders, 2):
        met = [
            (max(start, s), n[3])
            for n, s, e in lives(names, 2)
            if n[2] == order[3] and max(start, s) < min(end, e)
        ]
        if met:
            seq, name = max(met)
            expected.append((order[2], seq, name))
    assert rows(got) == sorted(expected, key=repr)
