"""The registered queries, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.rowkind import UPDATE_AFTER, adds
from tidemark.functions.temporal import day_of, hour_of, to_millis
from tidemark.operators import aggregates, changes, joins, merge, repair, sinks, steps, travel
from tidemark.operators.lookup import lookup_as_of
from tidemark.operators.skew import last_before
from tidemark.plans import tables
from tidemark.plans.retail import (
    enriched_history,
    customer_half,
    enriched_orders,
    product_half,
    product_sales,
    with_hour_partition,
)
from tidemark.plans.tables import ENTITY, SPECS
from tidemark.session import scratch_dir
from tidemark.sources import envelope, files
from tidemark.specs import TableSpec
from tidemark.streaming.layered import RetailLayers, start_layers
from tidemark.streaming.windows import closed_hours, hourly_totals

Query = Callable[[SparkSession, str], DataFrame]

# A moment inside the covered month, and a retry budget wide enough for
# events that are minutes apart.
PAST = dt.datetime(2024, 1, 15)
RETRY_DELAY = "6 hours"
MAX_RETRIES = 3
SHARDS = 3

ENTITY_ROW = ("product_id", "price", "hh")
ENTITY_SPEC = TableSpec("entity", "user_id bigint, product_id int, price bigint, hh int", pk=("user_id",))
ENTITY_SUMS = TableSpec(
    "entity_sums",
    "product_id int, hh int, price bigint",
    pk=("product_id", "hh"),
    merge="aggregation",
    aggregates={"price": "sum"},
)
ORDER_VIEW = ("order_id", "product_id", "customer_id")

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a query under its name; a trailing underscore avoids an operator's name."""
    _QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _past():
    return F.lit(PAST.isoformat(sep=" ")).cast("timestamp")


def _plain(ts: str):
    """A timestamp column without zone, as the given tables have it."""
    return F.col(ts).cast("timestamp_ntz").alias(ts)


# -- sources ---------------------------------------------------------------------


def _wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change records as files, read back as text."""
    folder = scratch_dir(spark, "records")
    tables.wire_events(spark, sf_dir).select("value").write.text(folder)
    return spark.read.text(folder)


@query
def cdc_decode(spark, sf_dir):
    records = tables.wire_events(spark, sf_dir)
    products = records.filter(envelope.source_table() == "products")
    rows = envelope.decode_changes(products, SPECS.products)
    return rows.select("op", _plain("commit_ts"), "seq", "product_id", "product_name", "sale_price")


@query
def cdc_route_counts(spark, sf_dir):
    """Records by the table that takes them or that nobody declares, in one pass over them."""
    judged = envelope.judge(_wire(spark, sf_dir), SPECS.sources)
    return judged.groupBy(F.col("table").alias("source_table")).agg(F.count(F.lit(1)).alias("n"))


@query
def cdc_quarantine(spark, sf_dir):
    """What becomes of every record, some of them broken: taken, or refused with a reason."""
    broken = tables.broken_records(spark, sf_dir).select("value")
    judged = envelope.judge(_wire(spark, sf_dir).unionByName(broken), SPECS.sources)
    return judged.groupBy("table", F.coalesce("reason", F.lit("taken")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _routed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the tables that one pass over all records has written."""
    records = tables.wire_events(spark, sf_dir).select("value")
    return envelope.route_written(records, SPECS.sources, scratch_dir(spark, "routed"))[table]


@query
def cdc_route_orders(spark, sf_dir):
    rows = with_hour_partition(_routed(spark, sf_dir, "orders"))
    return rows.select("op", "seq", *ORDER_VIEW, _plain("purchase_timestamp"), "dd", "hh")


@query
def cdc_route_products(spark, sf_dir):
    rows = _routed(spark, sf_dir, "products")
    return rows.select("op", "seq", _plain("commit_ts"), "product_id", "product_name", "sale_price")


@query
def cdc_route_customers(spark, sf_dir):
    return _routed(spark, sf_dir, "customers").select("op", "seq", "customer_id", "customer_name")


@query
def cdc_route_refused(spark, sf_dir):
    """What the same pass sets aside, some records being broken."""
    broken = tables.broken_records(spark, sf_dir).select("value")
    records = tables.wire_events(spark, sf_dir).select("value").unionByName(broken)
    rows = envelope.fan_out(records, SPECS.sources)
    return rows.groupBy("routed", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def cdc_row_kinds(spark, sf_dir):
    """Inserts, updates and deletes as records of their kind, and back."""
    image = F.struct("user_id", *ENTITY_ROW)
    rows = tables.entity_changes(spark, sf_dir).withColumn("now", F.struct(adds().alias("alive"), image.alias("row")))
    rows = last_before(rows, ["user_id"], "seq", "now", "prior")
    rows = rows.withColumns(
        {"before": F.when(F.col("prior.alive"), F.col("prior.row")), "after": F.when(adds(), F.col("now.row"))}
    )
    op = F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d").otherwise("u")
    records = rows.filter("before is not null or after is not null").withColumn("op", op)
    text = envelope.encode_events(records, "entity", records.columns)
    return envelope.decode_changes(text, ENTITY_SPEC).select("op", "seq", "user_id", *ENTITY_ROW)


@query
def state_latest(spark, sf_dir):
    return merge.current_state(tables.entity_changes(spark, sf_dir), ENTITY)


@query
def state_followed(spark, sf_dir):
    """The entity table from a stream that begins halfway: what it holds then, and what changes after."""
    folder = scratch_dir(spark, "followed")
    middle = tables.events(spark, sf_dir).agg((F.max("event_id") / 2).cast("bigint")).first()[0]
    log = tables.entity_changes(spark, sf_dir).select("op", "commit_ts", "seq", *ENTITY.columns)
    for part in (F.col("seq") <= middle, F.col("seq") > middle):
        log.filter(part).write.mode("append").parquet(f"{folder}/log")
        stream = files.read_with_contents(spark, ENTITY, f"{folder}/log", f"{folder}/start")
        sinks.write_output(stream, f"{folder}/out", checkpoint=f"{folder}/checkpoint").awaitTermination()
    return merge.current_state(spark.read.parquet(f"{folder}/out"), ENTITY)


@query
def changes_passthrough(spark, sf_dir):
    folder = scratch_dir(spark, "feed")
    orders = with_hour_partition(tables.order_changes(spark, sf_dir))
    orders.select("op", "commit_ts", "seq", *SPECS.orders.columns).write.parquet(f"{folder}/changes")
    feed = files.read_changes(spark, SPECS.orders, f"{folder}/changes")
    out = sinks.write_output(
        feed.drop("pts"), f"{folder}/out", checkpoint=f"{folder}/checkpoint", availableNow=True
    )
    out.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("op", "seq", *ORDER_VIEW, _plain("ts"), "dd", "hh")


@query
def time_travel_latest(spark, sf_dir):
    rows = tables.entity_changes(spark, sf_dir)
    return travel.snapshot_as_of(rows, ENTITY_SPEC, _past())


@query
def time_travel_sum(spark, sf_dir):
    """Sums as of a moment, over the changes as they were: updates retract, deletes remove."""
    return travel.snapshot_as_of(_retracting(spark, sf_dir, "commit_ts"), ENTITY_SUMS, _past())


@query
def bootstrap_snapshot(spark, sf_dir):
    folder = scratch_dir(spark, "bootstrap")
    spec = TableSpec("customers", "c_custkey bigint, c_name string, c_mktsegment string", pk=("c_custkey",))
    spark.read.parquet(f"{sf_dir}/customer.parquet").select(*spec.columns).write.option("header", True).csv(
        f"{folder}/csv"
    )
    files.load_bootstrap(spark, spec, f"{folder}/csv", f"{folder}/changes")
    files.load_bootstrap(spark, spec, f"{folder}/csv", f"{folder}/changes")
    return merge.current_state(files.read_changelog(spark, spec, f"{folder}/changes"), spec)


@query
def inline_rows(spark, sf_dir):
    kinds = files.inline_rows(
        spark, [("purchase", "order"), ("signup", "product"), ("click", "customer")], "event_type string, label string"
    )
    counts = tables.events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(kinds), "event_type").select("label", "n")


# -- sinks and merge rules -------------------------------------------------------


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter(F.col("commit_ts") <= _past()), rows.filter(F.col("commit_ts") > _past())


@query
def merge_latest(spark, sf_dir):
    first, second = _halves(tables.entity_changes(spark, sf_dir))
    return _merged(ENTITY_SPEC, first, second)


@query
def merge_latest_late(spark, sf_dir):
    """The same table when the second half of the changes comes first."""
    first, second = _halves(tables.entity_changes(spark, sf_dir))
    return _merged(ENTITY_SPEC, second, first)


def _merged(spec: TableSpec, *batches: DataFrame) -> DataFrame:
    state = None
    for batch in batches:
        state = merge.merge_into(state, batch, spec)
    return merge.live(state, spec)


@query
def merge_latest_partition_move(spark, sf_dir):
    """A row whose hour changes leaves the partition it was in."""
    rows = tables.entity_changes(spark, sf_dir).withColumn("dd", day_of("commit_ts"))
    moved = changes.changelog_of(rows, ["user_id"], ["product_id", "price", "dd", "hh"])
    spec = TableSpec(
        "entity_by_hour",
        "user_id bigint, product_id int, price bigint, dd string, hh int",
        pk=("user_id", "dd", "hh"),
        partition_by=("dd", "hh"),
    )
    return merge.current_state(moved, spec)


PARTIAL = TableSpec(
    "entity_partial",
    "user_id bigint, price bigint, event_type string",
    pk=("user_id",),
    merge="partial-update",
    ignore_delete=True,
)


def _partial_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices come from purchases only, deletes carry a type that must not be taken."""
    price = F.when(F.col("event_type") == "purchase", F.col("price"))
    return tables.entity_changes(spark, sf_dir).withColumn("price", price)


@query
def merge_partial_update(spark, sf_dir):
    return _merged(PARTIAL, *_halves(_partial_changes(spark, sf_dir)))


@query
def merge_partial_late(spark, sf_dir):
    """The same table when the second half of the changes comes first."""
    return _merged(PARTIAL, *reversed(_halves(_partial_changes(spark, sf_dir))))


@query
def merge_ignore_delete(spark, sf_dir):
    spec = TableSpec(ENTITY.name, ENTITY.schema, ENTITY.pk, ignore_delete=True)
    return merge.current_state(tables.entity_changes(spark, sf_dir), spec)


@query
def merge_partial_two_writers(spark, sf_dir):
    """Orders and customer names write disjoint columns of one table."""
    spec = TableSpec(
        "two_writers",
        "customer_id bigint, product_id bigint, customer_name string",
        pk=("customer_id",),
        merge="partial-update",
        ignore_delete=True,
    )
    orders = tables.order_changes(spark, sf_dir).select("op", "seq", "customer_id", "product_id")
    names = tables.customer_changes(spark, sf_dir).select("op", "seq", "customer_id", "customer_name")
    return merge.current_state(orders.unionByName(names, allowMissingColumns=True), spec)


def _retracting(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Full changes with old and new rows; ``extra`` columns are those of the row a change is made by."""
    rows = tables.entity_changes(spark, sf_dir)
    full = changes.changelog_of(rows, ["user_id"], list(ENTITY_ROW))
    return full.join(rows.select("user_id", "seq", *extra), ["user_id", "seq"]) if extra else full


@query
def merge_sum_retract(spark, sf_dir):
    return merge.current_state(_retracting(spark, sf_dir), ENTITY_SUMS)


@query
def merge_sum_live(spark, sf_dir):
    sums = merge.current_state(_retracting(spark, sf_dir), ENTITY_SUMS)
    return sums.filter(F.col(merge.LIVE) > 0)


def _valued(spark: SparkSession, sf_dir: str, rules: dict[str, str]) -> DataFrame:
    """Prices of entities by product and hour, each column by its rule; keys that lost all rows are left out."""
    columns = ", ".join(f"{c} bigint" for c in rules)
    spec = TableSpec(
        "valued", f"product_id int, hh int, {columns}", pk=("product_id", "hh"), merge="aggregation", aggregates=rules
    )
    rows = _retracting(spark, sf_dir).withColumns({c: F.col("price") for c in rules})
    return merge.current_state(rows, spec).filter(F.col(merge.LIVE) > 0)


@query
def merge_min_retract(spark, sf_dir):
    """Smallest and largest prices, of which the smallest or largest may be taken back."""
    return _valued(spark, sf_dir, {"lowest": "min", "highest": "max", "total": "sum"})


@query
def merge_avg_retract(spark, sf_dir):
    return _valued(spark, sf_dir, {"average": "avg"})


@query
def lookup_nulls(spark, sf_dir):
    """Facts without a position that differ in where they have a null only."""
    orders = tables.order_changes(spark, sf_dir).select("product_id", "commit_ts", "order_id")
    sides = F.explode(F.array(F.lit(1), F.lit(2))).alias("side")
    halves = orders.select("*", sides).select(
        "product_id",
        "commit_ts",
        F.lit(None).cast("bigint").alias("seq"),
        *[F.when(F.col("side") == n, F.col("order_id")).alias(c) for n, c in ((1, "left_id"), (2, "right_id"))],
    )
    return lookup_as_of(
        halves,
        tables.product_changes(spark, sf_dir),
        ["product_id"],
        "commit_ts",
        ["product_name", "sale_price"],
        retry_delay=RETRY_DELAY,
        max_retries=MAX_RETRIES,
    ).select("product_id", _plain("commit_ts"), "left_id", "right_id", "product_name", "sale_price")


@query
def state_diff(spark, sf_dir):
    rows = tables.entity_changes(spark, sf_dir)
    old = travel.snapshot_as_of(rows, ENTITY_SPEC, _past())
    return changes.diff_states(old, merge.current_state(rows, ENTITY_SPEC), ["user_id"])


@query
def changelog_lag(spark, sf_dir):
    rows = tables.entity_changes(spark, sf_dir)
    return changes.changelog_of(rows, ["user_id"], list(ENTITY_ROW))


@query
def partition_counts(spark, sf_dir):
    folder = scratch_dir(spark, "partitions")
    orders = with_hour_partition(tables.order_changes(spark, sf_dir)).select(*SPECS.orders.columns)
    sinks.write_table(orders, SPECS.orders, folder)
    stored = spark.read.schema(SPECS.orders.schema).parquet(folder)
    return stored.groupBy("dd", "hh").agg(F.count(F.lit(1)).alias("n"))


@query
def insert_subset(spark, sf_dir):
    orders = tables.order_changes(spark, sf_dir).select("order_id", "customer_id")
    rows = sinks.align_columns(orders, SPECS.enriched)
    return rows.select("order_id", "product_id", "customer_id", "product_name", "sale_price", "customer_name")


def _current(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = tables.order_changes(spark, sf_dir)
    products = merge.current_state(
        tables.product_changes(spark, sf_dir), TableSpec("p", "product_id bigint, product_name string, sale_price int", pk=("product_id",))
    )
    customers = merge.current_state(tables.customer_changes(spark, sf_dir), SPECS.customers)
    return orders, products, customers


ENRICHED_VIEW = ("order_id", "product_id", "customer_id", "product_name", "sale_price", "customer_name")


@query
def repair_overwrite(spark, sf_dir):
    """The enriched table replaced by a batch recomputation; customer names are lost."""
    folder = scratch_dir(spark, "overwrite")
    orders, products, customers = _current(spark, sf_dir)
    columns = [*ORDER_VIEW, "purchase_timestamp"]
    stale = repair.enriched_recompute(orders.select(*columns), products, customers)
    sinks.overwrite_table(stale, SPECS.enriched, folder)
    sinks.overwrite_table(repair.enriched_recompute(orders.select(*columns), products), SPECS.enriched, folder)
    return spark.read.parquet(folder).select(*ENRICHED_VIEW)


@query
def enriched_recompute_names(spark, sf_dir):
    orders, products, customers = _current(spark, sf_dir)
    return repair.enriched_recompute(orders.select(*ORDER_VIEW), products, customers).select(*ENRICHED_VIEW)


@query
def output_append(spark, sf_dir):
    folder = scratch_dir(spark, "append")
    first, second = _halves(tables.order_changes(spark, sf_dir))
    for part in (first, second):
        sinks.write_output(part.select("order_id", "product_id"), folder, mode="append")
    return spark.read.parquet(folder)


@query
def multi_insert_union(spark, sf_dir):
    rows = tables.events(spark, sf_dir)
    inserts = [
        rows.filter(F.col("event_type") == kind).select(F.col("event_id").alias("id"), F.lit(data).alias("data"))
        for kind, data in (("purchase", "Hi"), ("click", "Hello"))
    ]
    return sinks.union_inserts(inserts)


@query
def multi_sink_counts(spark, sf_dir):
    """One read of the events feeding three tables."""
    folder = scratch_dir(spark, "sinks")
    kinds = ("purchase", "signup", "click")
    sinks.write_split(tables.events(spark, sf_dir), {k: F.col("event_type") == k for k in kinds}, folder)
    return sinks.union_inserts(
        spark.read.parquet(f"{folder}/sink={k}").agg(
            F.lit(k).alias("sink"), F.count(F.lit(1)).alias("n"), F.sum("price").alias("price")
        )
        for k in kinds
    )


# -- projections and steps -------------------------------------------------------


@query
def ods_orders_projection(spark, sf_dir):
    rows = with_hour_partition(tables.order_changes(spark, sf_dir))
    rows = rows.withColumn("ts", to_millis("purchase_timestamp"))
    return rows.select(*ORDER_VIEW, _plain("purchase_timestamp"), "dd", "hh", _plain("ts"))


@query
def cast_types(spark, sf_dir):
    return tables.events(spark, sf_dir).select(
        "event_id",
        F.hour("ts").cast("int").alias("hour_int"),
        F.hour("ts").cast("bigint").alias("hour_bigint"),
        to_millis("ts").cast("timestamp_ntz").alias("ts_millis"),
        F.lit(None).cast("string").alias("nothing"),
        F.col("event_id").cast("string").alias("id_text"),
    )


@query
def limit_exists(spark, sf_dir):
    """``LIMIT 1`` as a test for any row."""
    rows = tables.events(spark, sf_dir)
    checks = {
        "has events": rows,
        "has negative values": rows.filter("value < 0"),
        "has orders": spark.read.parquet(f"{sf_dir}/orders.parquet"),
    }
    return sinks.union_inserts(
        df.select(F.lit(1).alias("one")).limit(1).agg(F.lit(name).alias("test"), (F.count("one") > 0).alias("answer"))
        for name, df in checks.items()
    )


@query
def variable_scalar(spark, sf_dir):
    rows = tables.events(spark, sf_dir)
    limit = rows.agg(F.max("price").alias("a"))
    top = steps.with_variables(rows, limit).filter(F.col("price") * 2 > F.col("a"))
    return top.select("event_id", F.concat(F.lit("a => "), F.col("a").cast("string")).alias("b"))


@query
def observe_counts(spark, sf_dir):
    """Values of a query logged while another result is written, in the same pass."""
    folder = scratch_dir(spark, "observed")
    rows = tables.events(spark, sf_dir)
    watched, seen = steps.observe_metrics(
        rows, "events", F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"), F.max("event_id").alias("last")
    )
    watched.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).write.parquet(folder)
    logged = {name: F.lit(value).cast("bigint") for name, value in seen.get.items()}
    return spark.read.parquet(folder).withColumnRenamed("n", "type_n").withColumns(logged)


# -- joins -----------------------------------------------------------------------


def _look_up(spark: SparkSession, sf_dir: str, retries: int) -> DataFrame:
    return lookup_as_of(
        tables.order_changes(spark, sf_dir).select("order_id", "product_id", "commit_ts", "seq"),
        tables.product_changes(spark, sf_dir),
        ["product_id"],
        "commit_ts",
        ["product_name", "sale_price"],
        retry_delay=RETRY_DELAY,
        max_retries=retries,
        attempt="attempt",
    ).select("order_id", "product_id", "product_name", "sale_price", "attempt")


@query
def lookup_as_of_(spark, sf_dir):
    return _look_up(spark, sf_dir, 0).drop("attempt")


@query
def lookup_retry(spark, sf_dir):
    return _look_up(spark, sf_dir, MAX_RETRIES)


@query
def lookup_duplicates(spark, sf_dir):
    """Facts without a position, each of them twice: every one gives a row."""
    orders = tables.order_changes(spark, sf_dir).select("product_id", "commit_ts")
    twice = orders.withColumn("seq", F.lit(None).cast("bigint")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return lookup_as_of(
        twice.drop("copy"),
        tables.product_changes(spark, sf_dir),
        ["product_id"],
        "commit_ts",
        ["product_name", "sale_price"],
        retry_delay=RETRY_DELAY,
        max_retries=MAX_RETRIES,
    ).select("product_id", _plain("commit_ts"), "product_name", "sale_price")


@query
def join_current(spark, sf_dir):
    orders, _, customers = _current(spark, sf_dir)
    return joins.join_current(orders.select(*ORDER_VIEW), customers, ["customer_id"])


@query
def changelog_join(spark, sf_dir):
    """The name each order version last met; equal to the join of the changelogs, folded."""
    met = customer_half(tables.order_changes(spark, sf_dir), tables.customer_changes(spark, sf_dir))
    return met.select("order_id", "seq", "customer_name")


@query
def join_changes(spark, sf_dir):
    """What the second half of the month changes in customers joined with orders."""
    old_orders, new_orders = _halves(tables.order_changes(spark, sf_dir).select("op", "seq", "commit_ts", *ORDER_VIEW))
    old_names, new_names = _halves(tables.customer_changes(spark, sf_dir))
    columns = SPECS.customers.columns
    before = merge.current_state(old_names, SPECS.customers)
    after = merge.current_state(new_names, SPECS.customers)
    return joins.join_changes(
        old_orders.select(*ORDER_VIEW),
        new_orders.select("op", *ORDER_VIEW),
        before.select(*columns),
        after.withColumn("op", F.lit(UPDATE_AFTER)).select("op", *columns),
        ["customer_id"],
        ["order_id"],
        ["customer_id"],
    ).select("op", *ORDER_VIEW, "customer_name")


@query
def join_changes_moves(spark, sf_dir):
    """The same for orders that move between products as single updates, and products that go."""
    orders = tables.order_changes(spark, sf_dir).withColumn("order_id", F.col("customer_id"))
    spec = TableSpec("moves", "order_id bigint, product_id bigint", pk=("order_id",))
    products = TableSpec("p", "product_id bigint, product_name string, sale_price int", pk=("product_id",))
    old_orders, new_orders = _halves(orders.select("op", "seq", "commit_ts", *spec.columns))
    old_versions, new_versions = _halves(tables.product_changes(spark, sf_dir))
    moves = merge.merge_into(None, new_orders, spec).withColumn("op", F.lit(UPDATE_AFTER))
    return joins.join_changes(
        merge.current_state(old_orders, spec),
        moves.select("op", *spec.columns),
        merge.current_state(old_versions, products),
        merge.merge_into(None, new_versions, products).select("op", *products.columns),
        ["product_id"],
        ["order_id"],
        ["product_id"],
    ).select("op", *spec.columns, "product_name", "sale_price")


@query
def join_left_batch(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_retailprice")
    lined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    priced = lined.join(parts.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "left")
    return priced.select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey", "p_name", "p_retailprice")


# -- aggregations ----------------------------------------------------------------


@query
def hourly_sales_batch(spark, sf_dir):
    orders, products, _ = _current(spark, sf_dir)
    return aggregates.hourly_sales(orders, products)


@query
def hourly_sales_retail(spark, sf_dir):
    """Sales at the list price of each part, exact to the cent."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast("decimal(15,2)").alias("sale_price")
    )
    sales = aggregates.hourly_sales(tables.order_changes(spark, sf_dir), parts)
    return sales.withColumn("sales", F.col("sales").cast("double"))


@query
def hourly_sales_as_of(spark, sf_dir):
    orders, products, _ = _current(spark, sf_dir)
    return aggregates.hourly_sales(travel.changes_until(orders, _past()), products)


def _stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched orders as a stored table of all their versions."""
    seen = enriched_history(
        tables.order_changes(spark, sf_dir),
        tables.product_changes(spark, sf_dir),
        retry_delay=RETRY_DELAY,
        max_retries=MAX_RETRIES,
    )
    columns = [f for f in SPECS.enriched.schema.fields if f.name != "customer_name"]
    spec = TableSpec("history", StructType(columns), pk=SPECS.enriched.pk)
    folder = scratch_dir(spark, "history")
    travel.write_history(travel.validity(seen, spec), folder)
    return spark.read.parquet(folder)


@query
def customer_total_as_of(spark, sf_dir):
    """From the stored table, read as of a moment."""
    return aggregates.customer_total(travel.history_as_of(_stored_history(spark, sf_dir), _past()))


@query
def state_history(spark, sf_dir):
    """Every row the entity table ever had, and for how long."""
    rows = travel.validity(tables.entity_changes(spark, sf_dir), ENTITY_SPEC)
    return rows.select("user_id", *ENTITY_ROW, _plain("valid_from"), _plain("valid_to"))


@query
def customer_total_of_one(spark, sf_dir):
    """The total of the customer with the smallest id."""
    orders, products, _ = _current(spark, sf_dir)
    table = orders.join(products, "product_id", "left")
    first = table.agg(F.min("customer_id")).first()[0]
    return aggregates.customer_total(table, customer=first)


# -- streams ---------------------------------------------------------------------


@query
def stream_tumbling(spark, sf_dir):
    rows = tables.shard_by_time(_stream_rows(spark, sf_dir), SHARDS)
    return _closed(spark, _streamed_totals(spark, rows, SHARDS))


@query
def stream_commit_interval(spark, sf_dir):
    """The same stream run continuously, with a commit at every interval, while files arrive."""
    rows = tables.shard_by_time(_stream_rows(spark, sf_dir), SHARDS)
    return _closed(spark, _streamed_totals(spark, rows, SHARDS, interval="1 second"))


@query
def late_gap(spark, sf_dir):
    """Hours whose streamed totals miss late rows."""
    rows = _late_rows(spark, sf_dir)
    streamed = _closed(spark, _streamed_totals(spark, rows, SHARDS + 1))
    full = _closed(spark, closed_hours(hourly_totals(rows, ["event_type"], "price"), rows))
    return repair.result_gap(streamed, full, ["hour_start", "event_type"], "total")


@query
def repair_closed_hours(spark, sf_dir):
    """The same totals after the wrong days were replaced by a batch recomputation."""
    spec = TableSpec(
        "hourly_totals",
        "dd string, hour_start timestamp_ntz, event_type string, total bigint, n bigint",
        pk=("dd", "hour_start", "event_type"),
        partition_by=("dd",),
    )
    rows = _late_rows(spark, sf_dir)
    served = scratch_dir(spark, "served")
    streamed = _closed(spark, _streamed_totals(spark, rows, SHARDS + 1))
    sinks.overwrite_table(streamed.withColumn("dd", day_of("hour_start")), spec, served)
    full = _closed(spark, closed_hours(hourly_totals(rows, ["event_type"], "price"), rows))
    repair.repair(spark, served, spec, full.withColumn("dd", day_of("hour_start")))
    return spark.read.schema(spec.schema).parquet(served).select("hour_start", "event_type", "total", "n")


def _stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.events(spark, sf_dir).select("ts", "event_type", "price", "k")


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which some products' arrive one shard late."""
    rows = tables.shard_by_time(_stream_rows(spark, sf_dir), SHARDS)
    late = F.when(F.col("k") % 10 == 3, 1).otherwise(0)
    return rows.withColumn("shard", F.col("shard") + late)


def _streamed_totals(spark: SparkSession, rows: DataFrame, shards: int, interval: str | None = None) -> DataFrame:
    folder = scratch_dir(spark, "totals")
    arrivals = f"{folder}/arrivals"
    schema = rows.drop("shard").schema

    def run(shard: int) -> None:
        stream = spark.readStream.schema(schema).parquet(arrivals)
        totals = hourly_totals(stream, ["event_type"], "price")
        trigger = {"processingTime": interval} if interval else {}
        running = sinks.write_output(totals, f"{folder}/out", checkpoint=f"{folder}/checkpoint", **trigger)
        if interval:
            running.processAllAvailable()
            running.stop()
        running.awaitTermination()

    tables.replay(rows, shards, "parquet", arrivals, run)
    return spark.read.parquet(f"{folder}/out")


def _closed(spark: SparkSession, totals: DataFrame) -> DataFrame:
    return totals.select(_plain("hour_start"), "event_type", "total", "n")


def _layers(spark: SparkSession, sf_dir: str, records_of: Query, late: str = "false") -> tuple[RetailLayers, int]:
    """The layers run over records that arrive in shards; the last one ends all waiting.

    Records that ``late`` selects arrive one shard after their time.
    """
    folder = scratch_dir(spark, "layers")
    times = tables.events(spark, sf_dir).select("ts", F.col("event_id").alias("seq"))
    rows = tables.shard_by_time(records_of(spark, sf_dir), SHARDS, span_of=times)
    after = F.when(F.expr(late.replace("source_table", "get_json_object(value, '$.source.table')")), 1).otherwise(0)
    rows = rows.withColumn("shard", F.least(F.col("shard") + after, F.lit(SHARDS - 1)))
    layers = RetailLayers(spark, f"{folder}/tables", SPECS, retry_delay=RETRY_DELAY, max_retries=MAX_RETRIES)
    records = f"{folder}/records"

    def run(shard: int) -> None:
        if shard == SHARDS - 1:
            tables.heartbeat(spark, 30, times).write.mode("append").text(records)
        stream = spark.readStream.text(records)
        start_layers(stream, layers, f"{folder}/checkpoint", availableNow=True).awaitTermination()

    tables.replay(rows.select("value", "shard"), SHARDS, "text", records, run)
    return layers, SHARDS - 1


@query
def layered_dwd(spark, sf_dir):
    layers, last = _layers(spark, sf_dir, tables.wire_events)
    return layers.enriched_table(last)


@query
def layered_dws(spark, sf_dir):
    layers, last = _layers(spark, sf_dir, tables.wire_events)
    return layers.sales_table(last).select("product_id", "hh", "sales")


@query
def layered_late(spark, sf_dir):
    """Orders of which some arrive days after their time, long past the retry budget."""
    layers, last = _layers(spark, sf_dir, tables.wire_events, late="source_table = 'orders' and seq % 10 = 3")
    return layers.enriched_table(last)


@query
def enriched_feed(spark, sf_dir):
    """The enriched table rebuilt from its streamed changes."""
    layers, _ = _layers(spark, sf_dir, tables.wire_events)
    folder = scratch_dir(spark, "feed")
    sinks.write_output(layers.enriched_stream(), f"{folder}/out", checkpoint=f"{folder}/checkpoint").awaitTermination()
    seq = F.shiftleft(F.col("v").cast("bigint"), 32) + F.col("b")
    feed = spark.read.parquet(f"{folder}/out").withColumn("seq", seq)
    spec = TableSpec("feed", SPECS.enriched.schema, pk=SPECS.enriched.pk)
    return merge.current_state(feed, spec)


@query
def layered_reorders_dwd(spark, sf_dir):
    """Orders that move between products, hours and prices again and again."""
    layers, last = _layers(spark, sf_dir, tables.reorder_records)
    return layers.enriched_table(last)


@query
def layered_orders(spark, sf_dir):
    """The partitioned order table behind them, each order under the day and hour it has now."""
    layers, _ = _layers(spark, sf_dir, tables.reorder_records)
    return layers.orders_table().withColumn("purchase_timestamp", F.col("purchase_timestamp").cast("timestamp_ntz"))


@query
def layered_reorders_dws(spark, sf_dir):
    """Their sales, after all retractions; keys no order is left in are not shown."""
    layers, last = _layers(spark, sf_dir, tables.reorder_records)
    return layers.sales_table(last).filter(F.col(merge.LIVE) > 0)


def _enriched_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_orders(
        tables.order_changes(spark, sf_dir),
        tables.product_changes(spark, sf_dir),
        tables.customer_changes(spark, sf_dir),
        SPECS,
        retry_delay=RETRY_DELAY,
        max_retries=MAX_RETRIES,
    )


@query
def enriched_orders_batch(spark, sf_dir):
    return _enriched_batch(spark, sf_dir)


@query
def product_sales_by_hour(spark, sf_dir):
    """Sales by product and hour at the price valid when each order arrived."""
    orders = tables.order_changes(spark, sf_dir)
    found = product_half(
        orders, tables.product_changes(spark, sf_dir), retry_delay=RETRY_DELAY, max_retries=MAX_RETRIES
    )
    return product_sales(found, SPECS).select("product_id", "hh", "sales")


@query
def stream_vs_batch_gap(spark, sf_dir):
    """Where the streamed sales, at the prices of their time, and a batch at the latest prices differ."""
    orders, products, _ = _current(spark, sf_dir)
    layers, last = _layers(spark, sf_dir, tables.wire_events)
    return repair.result_gap(
        layers.sales_table(last).select("product_id", "hh", "sales"),
        aggregates.hourly_sales(orders, products),
        ["product_id", "hh"],
        "sales",
    )
