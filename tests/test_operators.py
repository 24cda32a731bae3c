"""Merge rules, derived changes, sources, sinks and steps."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import TableSpec, scratch_dir, session
from tidemark.functions.temporal import interval_micros
from tidemark.operators import merge, sinks, steps
from tidemark.operators.aggregates import customer_total, hourly_sales
from tidemark.operators.changes import apply_changes, changelog_of, diff_states
from tidemark.operators.joins import join_changes
from tidemark.operators.repair import repair, result_gap
from tidemark.operators.travel import history_as_of, snapshot_as_of, validity, write_history
from tidemark.plans.retail import retail_specs
from tidemark.sources import envelope, files
from tidemark.sources.catalog import load_catalog

LATEST = TableSpec("t", "id int, name string, price int", pk=("id",))
PARTIAL = TableSpec("t", "id int, name string, price int", pk=("id",), merge="partial-update", ignore_delete=True)
SUMS = TableSpec("s", "name string, price bigint", pk=("name",), merge="aggregation", aggregates={"price": "sum"})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def history(spark, seed=7, n=400):
    """Random versions of 20 rows as (op, seq, id, name, price)."""
    rng = random.Random(seed)
    data = []
    for seq in range(n):
        op = rng.choice(["+I", "+U", "+U", "-D"])
        data.append((op, seq, rng.randrange(20), rng.choice(["a", "b", None]), rng.choice([1, 2, 0, None])))
    return spark.createDataFrame(data, "op string, seq bigint, id int, name string, price int").withColumn(
        "commit_ts", F.timestamp_seconds("seq")
    )


def test_history_as_of_equals_the_fold(spark):
    """At every moment, before the first change and after the last; also where changes share an instant."""
    for changes in (history(spark), history(spark).withColumn("commit_ts", F.timestamp_seconds(F.floor(F.col("seq") / 7)))):
        folder = scratch_dir(spark, "history")
        write_history(validity(changes, LATEST), folder)
        stored = spark.read.parquet(folder)
        for second in (-1, 0, 3, 25, 56, 200, 399, 1000):
            moment = second * 1000
            assert rows(history_as_of(stored, moment)) == rows(snapshot_as_of(changes, LATEST, moment)), second
    plan = history_as_of(stored, 25_000)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(valid_from" in plan.split("PushedFilters")[1]


@pytest.mark.parametrize("spec", [LATEST, PARTIAL], ids=["latest", "partial"])
@pytest.mark.parametrize("cuts", [(1,), (50, 51, 300), (399,)])
def test_merging_batches_equals_one_fold(spark, spec, cuts):
    changes = history(spark)
    if spec is LATEST:
        # A delete in one batch and the insert before it in another needs the key gone.
        changes = changes.filter("op <> '-U'")
    state, low = None, -1
    for high in (*cuts, 1000):
        batch = changes.filter((F.col("seq") > low) & (F.col("seq") <= high))
        state = merge.merge_into(state, batch, spec)
        low = high
    assert rows(merge.live(state, spec)) == rows(merge.current_state(changes, spec))


@pytest.mark.parametrize("spec", [LATEST, PARTIAL], ids=["latest", "partial"])
def test_batches_in_any_order_equal_one_fold(spark, spec):
    changes = history(spark).filter("op <> '-U'")
    bounds = [0, 60, 130, 270, 1000]
    batches = [changes.filter((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip(bounds, bounds[1:])]
    for order in ((3, 2, 1, 0), (1, 3, 0, 2)):
        state = None
        for at in order:
            state = merge.merge_into(state, batches[at], spec)
        assert rows(merge.live(state, spec)) == rows(merge.current_state(changes, spec))


@pytest.mark.parametrize("cut", [0, 120, 399])
def test_sums_over_retractions_equal_sums_of_the_state(spark, cut):
    log = changelog_of(history(spark), ["id"], ["name", "price"]).withColumn("price", F.col("price").cast("bigint"))
    first = merge.merge_into(None, log.filter(F.col("seq") <= cut), SUMS)
    sums = merge.merge_into(first, log.filter(F.col("seq") > cut), SUMS)
    assert rows(sums) == rows(merge.current_state(log, SUMS))
    live = merge.current_state(history(spark), LATEST).groupBy("name").agg(
        F.coalesce(F.sum("price"), F.lit(0)).alias("price"), F.count(F.lit(1)).alias("n")
    )
    kept = sums.filter("live_rows > 0").select("name", F.coalesce("price", F.lit(0)), "live_rows")
    assert rows(kept) == rows(live)


def test_smallest_and_largest_values(spark):
    spec = TableSpec(
        "m", "name string, low int, high int", pk=("name",), merge="aggregation", aggregates={"low": "min", "high": "max"}
    )
    data = [("+I", 1, "a", 5, 5), ("+U", 2, "a", 3, 3), ("+I", 3, "a", None, 9), ("+I", 4, "b", 1, 1)]
    changes = spark.createDataFrame(data, "op string, seq bigint, name string, low int, high int")
    whole = merge.current_state(changes, spec).select("name", "low", "high")
    assert rows(whole) == [("a", 3, 9), ("b", 1, 1)]
    first = merge.merge_into(None, changes.filter("seq > 1"), spec)
    state = merge.merge_into(first, changes.filter("seq = 1"), spec)
    assert rows(merge.live(state, spec).select(*spec.columns)) == rows(whole)


def test_extremes_and_averages_take_rows_back(spark):
    """Any cut of a history with updates and deletes gives what the rows that are left give."""
    rules = {"low": "min", "high": "max", "mean": "avg", "total": "sum"}
    spec = TableSpec(
        "v", "name string, low bigint, high bigint, mean bigint, total bigint", pk=("name",), merge="aggregation",
        aggregates=rules,
    )
    versions = history(spark)
    values = {c: F.col("price") for c in rules}
    log = changelog_of(versions, ["id"], ["name", "price"]).withColumns(values)
    left = merge.current_state(versions, LATEST).groupBy("name").agg(
        F.min("price"), F.max("price"), F.avg("price"), F.sum("price"), F.count(F.lit(1))
    )
    columns = ["name", *rules, "live_rows"]
    whole = merge.current_state(log, spec).filter("live_rows > 0").select(columns)
    assert rows(whole) == rows(left)
    for cut in (3, 11):
        state = None
        for part in range(cut):
            state = merge.merge_into(state, log.filter(F.col("seq") % cut == cut - 1 - part), spec)
        assert rows(merge.live(state, spec).filter("live_rows > 0").select(columns)) == rows(left)


def test_partial_update_places_late_values(spark):
    changes = spark.createDataFrame(
        [("+U", 5, 1, "new", None), ("+U", 3, 1, "old", 30), ("+U", 4, 1, None, 40), ("-D", 9, 1, None, None)],
        "op string, seq bigint, id int, name string, price int",
    )
    assert rows(merge.current_state(changes, PARTIAL)) == [(1, "new", 40)]
    state = merge.fold_partial_update(changes.filter("seq = 5"), PARTIAL, keep_order=True)
    late = merge.merge_partial_update(state, changes.filter("seq < 5"), PARTIAL)
    assert rows(late.select("id", "name", "price")) == [(1, "new", 40)]


def test_null_overwrites_is_opt_in(spark):
    spec = TableSpec("t", PARTIAL.schema, ("id",), merge="partial-update", ignore_delete=True, null_overwrites=("price",))
    changes = spark.createDataFrame(
        [("+I", 1, 1, "a", 10), ("+U", 2, 1, None, None)], "op string, seq bigint, id int, name string, price int"
    )
    assert rows(merge.current_state(changes, spec)) == [(1, "a", None)]


def test_partial_update_refuses_retractions_unless_ignored(spark):
    spec = TableSpec("t", PARTIAL.schema, ("id",), merge="partial-update")
    with pytest.raises(Exception, match="retraction"):
        merge.current_state(history(spark), spec).collect()


def test_ignore_delete(spark):
    spec = TableSpec("t", LATEST.schema, ("id",), ignore_delete=True)
    changes = spark.createDataFrame(
        [("+I", 1, 1, "a", 10), ("-D", 2, 1, None, None)], "op string, seq bigint, id int, name string, price int"
    )
    assert rows(merge.current_state(changes, spec)) == [(1, "a", 10)]
    assert merge.current_state(changes, LATEST).isEmpty()


def test_diff_and_apply_are_inverse(spark):
    log = history(spark)
    old = merge.current_state(log.filter("seq < 150"), LATEST)
    new = merge.current_state(log, LATEST)
    assert rows(apply_changes(old, diff_states(old, new, ["id"]), ["id"])) == rows(new)
    assert diff_states(new, new, ["id"]).isEmpty()


def test_fixed_width_folds_aggregate_by_hash(spark):
    spec = TableSpec("t", "id int, price int", pk=("id",))
    plan = merge.current_state(history(spark), spec)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_filter_on_the_key_reaches_the_scan(spark):
    folder = scratch_dir(spark, "pushdown")
    history(spark).write.parquet(folder)
    state = merge.current_state(spark.read.parquet(folder), LATEST).filter("id = 3").select("id", "price")
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan


# -- sources -------------------------------------------------------------------

SPECS = retail_specs()


def record(op, table, before=None, after=None, ts_ms=1000, lsn=1):
    source = {"db": "d", "schema": "s", "table": table, "ts_ms": ts_ms, "lsn": lsn}
    return json.dumps({"op": op, "before": before, "after": after, "source": source})


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_row_kinds(spark):
    a, b = {"customer_id": "1", "customer_name": "ann"}, {"customer_id": "1", "customer_name": "amy"}
    records = raw(
        spark,
        record("r", "customers", after=a, ts_ms=0, lsn=1),
        record("u", "customers", a, b, 2000, 2),
        record("d", "customers", b, None, 4000, 4),
    )
    decoded = envelope.decode_changes(records, SPECS.customers).select("seq", "op", "customer_name")
    assert rows(decoded) == [(1, "+I", "ann"), (2, "+U", "amy"), (2, "-U", "ann"), (4, "-D", "amy")]
    first = envelope.decode_changes(records, SPECS.customers).filter("seq = 1").first()
    assert first["commit_ts"] == dt.datetime(1970, 1, 1)


def test_bad_records_are_kept_with_a_reason(spark):
    a = {"customer_id": "1", "customer_name": "ann"}
    records = raw(
        spark,
        "not json",
        record("c", "suppliers", after=a),
        record("c", "customers", after=a),
        record("x", "customers", after=a),
        record("d", "customers"),
        record("c", "customers", after={"customer_name": "nobody"}),
        record("u", "customers", after=a),
        record("u", "customers", before={"customer_name": "nobody"}, after=a),
        record("c", "customers", after=a, lsn=None),
        record("c", "customers", after=[1]),
        record("c", "heartbeat"),
    )
    assert envelope.route_changes(records, SPECS.sources)["customers"].count() == 1
    judged = envelope.judge(records, SPECS.sources)
    assert judged.count() == records.count() and judged.filter("reason is null").count() == 1
    assert judged._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    got = {(r["table"], r["reason"]) for r in envelope.quarantine(records, SPECS.sources).collect()}
    assert got == {
        (None, "malformed"),
        ("suppliers", "unknown table"),
        ("customers", "unknown operation"),
        ("customers", "no row image"),
        ("customers", "null key"),
        ("customers", "no old image"),
        ("customers", "no position"),
        ("customers", "malformed"),
    }
    assert envelope.route_changes(records, SPECS.sources)["orders"].isEmpty()


def test_timestamps_keep_microseconds_and_zone(spark):
    order = {"order_id": "1", "purchase_timestamp": "2024-01-01T10:00:00.123456+02:00"}
    got = envelope.decode_changes(raw(spark, record("c", "orders", after=order)), SPECS.orders).first()
    assert got["purchase_timestamp"] == dt.datetime(2024, 1, 1, 8, 0, 0, 123456)


def test_bootstrap_loads_once(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,customer_name\n1,ann\n2,bob\n")
    target = scratch_dir(spark, "boot")
    assert files.load_bootstrap(spark, SPECS.customers, str(tmp_path / "c.csv"), target)
    assert not files.load_bootstrap(spark, SPECS.customers, str(tmp_path / "c.csv"), target)
    log = files.read_changelog(spark, SPECS.customers, target)
    assert rows(merge.current_state(log, SPECS.customers)) == [("1", "ann"), ("2", "bob")]
    assert {"pts", "ts"} <= set(log.columns)


def test_bootstrap_refuses_bad_lines(spark, tmp_path):
    spec = TableSpec("t", "id int, name string", pk=("id",))
    (tmp_path / "t.csv").write_text("id,name\n1,ann\nx,bob\n")
    with pytest.raises(Exception, match="(?i)malformed|fail"):
        files.load_bootstrap(spark, spec, str(tmp_path / "t.csv"), scratch_dir(spark, "boot"))


def test_jdbc_options():
    options = files.jdbc_options(
        "jdbc:postgresql://db:5432/shop", "orders", user="u", password="p", partition_column="id", bounds=(0, 100), partitions=8
    )
    assert options["numPartitions"] == "8" and options["upperBound"] == "100"
    with pytest.raises(ValueError):
        files.jdbc_options("jdbc:x", "t", partition_column="id")


def test_catalog():
    specs = load_catalog(
        """
connectors:
  shop: {options: {host: db, schema: public}}
tables:
  dws.sales:
    schema: product_id string, hh bigint, sales bigint
    primary_key: [product_id, hh]
    merge: aggregation
    aggregates: {sales: sum}
temporary_tables:
  cdc_orders:
    connector: shop
    options: {table: orders, schema: other}
    schema: order_id string, at timestamp
    primary_key: [order_id]
    watermark: {column: at, delay: 5 seconds}
"""
    )
    assert specs["dws.sales"].merge == "aggregation" and specs["dws.sales"].values == ["sales"]
    assert specs["cdc_orders"].options == {"host": "db", "schema": "other", "table": "orders"}
    assert specs["cdc_orders"].delay == "5 seconds"
    with pytest.raises(ValueError):
        load_catalog("tables: {t: {connector: nope, schema: a int}}")


def test_spec_checks():
    with pytest.raises(ValueError):
        TableSpec("t", "a int", pk=("b",))
    with pytest.raises(ValueError):
        TableSpec("t", "a int", pk=("a",), merge="newest")
    with pytest.raises(ValueError):
        TableSpec("t", "a int, b int", pk=("a",), merge="aggregation", aggregates={"b": "median"})
    assert interval_micros("6 hours") == 6 * 3_600_000_000
    with pytest.raises(ValueError):
        interval_micros("soon")


def test_moved_and_removed_facts_are_retracted(spark):
    left = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "C")], "id int, k string")
    right = spark.createDataFrame([("A", "ann"), ("B", "bob"), ("C", "cy")], "k string, name string")
    moves = spark.createDataFrame([("+U", 1, "B"), ("-D", 3, None), ("+I", 5, "A")], "op string, id int, k string")
    names = spark.createDataFrame([("+U", "A", "amy"), ("-D", "C", None)], "op string, k string, name string")
    got = join_changes(left, moves, right, names, ["k"], ["id"], ["k"]).select("op", "id", "k", "name")
    assert rows(got) == sorted([
        ("-U", 1, "A", "ann"), ("+U", 1, "B", "bob"), ("-U", 2, "A", "ann"), ("+U", 2, "A", "amy"),
        ("-D", 3, "B", "bob"), ("-D", 4, "C", "cy"), ("+I", 5, "A", "amy"),
    ], key=repr)


def test_prices_keep_their_cents(spark):
    enriched = spark.createDataFrame([(1, 1.75), (1, 1.75)], "customer_id int, sale_price double")
    assert rows(customer_total(enriched)) == [(1, 3.5)]
    at = dt.datetime(2024, 1, 1, 5)
    orders = spark.createDataFrame([(1, at), (1, at)], "product_id int, purchase_timestamp timestamp")
    products = spark.createDataFrame([(1, 1.75)], "product_id int, sale_price double")
    assert rows(hourly_sales(orders, products)) == [(1, 5, 3.5)]


# -- sinks and steps -------------------------------------------------------------


def test_write_and_overwrite_touched_partitions(spark):
    folder = scratch_dir(spark, "hours")
    spec = TableSpec("t", "id int, name string, hh int", pk=("id",), partition_by=("hh",))
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, hh int")
    sinks.write_table(df, spec, folder)
    sinks.overwrite_table(df.filter("hh = 2").withColumn("name", F.lit("c")), spec, folder, touched_only=True)
    assert rows(spark.read.parquet(folder).select("id", "name", "hh")) == [(1, "a", 1), (2, "c", 2)]
    sinks.overwrite_table(df.filter("hh = 1"), spec, folder)
    assert rows(spark.read.parquet(folder).select("id")) == [(1,)]


def test_align_columns(spark):
    got = sinks.align_columns(spark.createDataFrame([("7",)], "id string"), LATEST)
    assert rows(got) == [(7, None, None)] and got.schema["id"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        sinks.align_columns(spark.range(1), SUMS)


def test_repair_rewrites_only_wrong_partitions(spark):
    import glob
    import os

    folder = scratch_dir(spark, "repair")
    spec = TableSpec("t", "id int, total bigint, dd string", pk=("id", "dd"), partition_by=("dd",))
    streamed = spark.createDataFrame([(1, 10, "d1"), (2, 5, "d2")], "id int, total bigint, dd string")
    sinks.write_table(streamed, spec, folder)
    before = glob.glob(f"{folder}/dd=d1/*.parquet")
    full = spark.createDataFrame([(1, 10, "d1"), (2, 7, "d2"), (3, 1, "d2")], "id int, total bigint, dd string")
    repair(spark, folder, spec, full)
    assert rows(spark.read.parquet(folder).select("id", "total", "dd")) == [(1, 10, "d1"), (2, 7, "d2"), (3, 1, "d2")]
    assert before and all(os.path.exists(f) for f in before)
    assert result_gap(spark.read.parquet(folder), full, spec.pk, "total").isEmpty()


def test_repair_compares_all_columns_and_removes_partitions(spark):
    folder = scratch_dir(spark, "repair")
    spec = TableSpec("t", "id int, total bigint, n bigint, dd string", pk=("id", "dd"), partition_by=("dd",))
    streamed = [(1, 10, 1, "d1"), (2, 5, 1, "d2"), (3, 7, 1, "d3"), (4, 8, 1, "d 4/x")]
    full = [(1, 10, 2, "d1"), (2, 5, 1, "d2")]
    sinks.write_table(spark.createDataFrame(streamed, spec.schema), spec, folder)
    repair(spark, folder, spec, spark.createDataFrame(full, spec.schema))
    assert rows(spark.read.schema(spec.schema).parquet(folder)) == full


def test_outputs(spark):
    folder = scratch_dir(spark, "out")
    df = spark.range(3)
    sinks.write_output(df, folder, mode="append")
    sinks.write_output(df, folder, mode="append")
    assert spark.read.parquet(folder).count() == 6
    with pytest.raises(ValueError):
        sinks.write_output(df, folder, mode="upsert")
    stream = spark.readStream.schema("id bigint").parquet(folder)
    with pytest.raises(ValueError):
        sinks.write_output(stream, folder)
    sinks.console_sink(df)
    sinks.console_sink(stream).awaitTermination()


def test_scratch_of_one_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_scratch_root", lambda _: f"file://{tmp_path}/app")
    assert session.written(spark.range(3), "numbers").count() == 3
    assert list(tmp_path.rglob("*.parquet"))
    session.clear_scratch(spark)
    assert not list(tmp_path.rglob("*.parquet"))


def test_steps(spark):
    variables = spark.sql("select 2 as a")
    assert steps.variable_values(variables) == {"a": 2}
    got = spark.sql("select concat('a => ', :a) as b", args=steps.variable_values(variables))
    assert rows(got) == [("a => 2",)]
    assert rows(steps.with_variables(spark.range(2), variables)) == [(0, 2), (1, 2)]
    with pytest.raises(ValueError):
        steps.variable_values(spark.range(3))
    assert steps.has_rows(spark.range(1)) and not steps.has_rows(spark.range(0))


def test_two_inserts_into_one_sink(spark):
    schema = "id bigint, data string"
    first = files.inline_rows(spark, [(1, "Hi"), (2, "Hello")], schema)
    second = files.inline_rows(spark, [(3, "Hi"), (4, "Hello")], schema)
    assert rows(sinks.union_inserts([first, second])) == [(1, "Hi"), (2, "Hello"), (3, "Hi"), (4, "Hello")]


def files_of(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_a_batch_rewrites_the_partitions_it_touches(spark, tmp_path):
    """Rows that move between partitions, come late, go, or have no partition; the same batch again changes nothing."""
    spec = TableSpec("p", "id int, price int, dd string", pk=("id", "dd"), partition_by=("dd",))
    log = [
        [("+I", 1, 1, 10, "a"), ("+I", 2, 2, 20, "a"), ("+I", 3, 3, 30, "b"), ("+I", 4, 4, 40, "c"), ("+I", 5, 5, 50, None)],
        [("-U", 6, 1, 10, "a"), ("+U", 6, 1, 11, "b"), ("-D", 7, 3, 30, "b")],
        [("+U", 0, 1, 9, "b"), ("-U", 8, 5, 50, None), ("+U", 8, 5, 51, "a")],
    ]
    batches = [spark.createDataFrame(rows_, "op string, seq bigint, id int, price int, dd string") for rows_ in log]
    folder = tmp_path / "table"
    seen = []
    for batch in batches:
        sinks.merge_partitions(batch, spec, str(folder))
        seen.append(files_of(folder))
    want = [(1, 11, "b"), (2, 20, "a"), (4, 40, "c"), (5, 51, "a")]
    assert rows(sinks.read_merged(spark, spec, str(folder))) == want
    whole = merge.current_state(batches[0].unionByName(batches[1]).unionByName(batches[2]), spec)
    assert rows(whole.select("id", "price", "dd")) == want
    kept = {f: at for f, at in seen[0].items() if f.startswith("dd=c")}
    assert kept and all({f: at for f, at in after.items() if f.startswith("dd=c")} == kept for after in seen)
    nowhere = {f: at for f, at in seen[0].items() if "HIVE_DEFAULT" in f}
    assert nowhere and {f: at for f, at in seen[1].items() if "HIVE_DEFAULT" in f} == nowhere
    sinks.merge_partitions(batches[1], spec, str(folder))
    assert rows(sinks.read_merged(spark, spec, str(folder))) == want


def test_a_stream_begins_with_what_the_table_holds(spark):
    """Contents once, then each later change once, also after a restart."""
    folder = scratch_dir(spark, "contents")
    log = history(spark).select("op", "commit_ts", "seq", *LATEST.columns)
    bounds = [150, 151, 300, 400]
    for start, stop in zip([0, *bounds], bounds):
        log.filter((F.col("seq") >= start) & (F.col("seq") < stop)).write.mode("append").parquet(f"{folder}/log")
        stream = files.read_with_contents(spark, LATEST, f"{folder}/log", f"{folder}/start")
        sinks.write_output(stream, f"{folder}/out", checkpoint=f"{folder}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    first = merge.current_state(log.filter("seq < 150"), LATEST)
    assert rows(out.filter("seq < 150").select(*LATEST.columns)) == rows(first)
    assert rows(out.filter("seq >= 150").select("seq", "op")) == rows(log.filter("seq >= 150").select("seq", "op"))
    assert rows(merge.current_state(out, LATEST)) == rows(merge.current_state(log, LATEST))


def test_one_pass_feeds_every_sink_whose_condition_holds(spark):
    folder = scratch_dir(spark, "split")
    source = spark.range(10).withColumn("half", F.when(F.col("id") != 7, F.col("id") % 2))
    sinks.write_split(source, {"even": F.col("half") == 0, "low": F.col("id") < 3, "none": F.lit(False)}, folder)
    stored = spark.read.parquet(folder)
    assert rows(stored.groupBy("sink").agg(F.sort_array(F.collect_list("id")))) == [
        ("even", [0, 2, 4, 6, 8]),
        ("low", [0, 1, 2]),
    ]
    with pytest.raises(ValueError, match="column of the source"):
        sinks.write_split(source, {}, folder, by="id")


def test_watermark_is_set_on_streams_only(spark):
    folder = scratch_dir(spark, "marks")
    spark.range(0).write.parquet(folder)
    stream = files.read_changes(spark, SPECS.orders, folder)
    assert "EventTimeWatermark" in stream._jdf.queryExecution().analyzed().toString()
    assert {"pts", "ts"} <= set(stream.columns)
