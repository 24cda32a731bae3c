"""The retail changelogs, derived from the given tables.

Purchases are orders, sign-ups and errors are versions and removals of the product named
in the event, clicks rename the customer. ``event_id`` is the log position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rowkind import DELETE, INSERT, UPDATE_AFTER
from tidemark.functions.temporal import micros
from tidemark.operators.skew import last_before
from tidemark.plans.retail import retail_specs
from tidemark.sources.envelope import CREATE, HEARTBEAT, REMOVE, TIMESTAMP_TEXT, UPDATE
from tidemark.specs import TableSpec

SPECS = retail_specs("bigint")

ENTITY = TableSpec(
    "entity", "user_id bigint, product_id int, price bigint, hh int, event_type string", pk=("user_id",)
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their product key ``k`` and whole-number ``price``."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.floor("value").cast("bigint").alias("price"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'purchase'").select(
        F.lit(INSERT).alias("op"),
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("order_id"),
        F.col("k").cast("bigint").alias("product_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("purchase_timestamp"),
    )


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = events(spark, sf_dir).filter("event_type in ('signup', 'error')").select(
        F.when(F.col("event_type") == "signup", INSERT).otherwise(DELETE).alias("op"),
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
        F.col("k").cast("bigint").alias("product_id"),
        F.col("price").cast("int").alias("sale_price"),
    )
    names = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
    return versions.join(names, "product_id", "left")


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = events(spark, sf_dir).filter("event_type = 'click'").select(
        F.lit(UPDATE_AFTER).alias("op"),
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("customer_id"),
    )
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("_name")
    )
    named = clicks.join(names, "customer_id", "left")
    return named.withColumn("customer_name", F.concat("_name", F.lit("#"), F.col("seq").cast("string"))).drop("_name")


def entity_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per user: sign-ups insert, errors delete, everything else updates."""
    kind = F.when(F.col("event_type") == "signup", INSERT).when(F.col("event_type") == "error", DELETE)
    return events(spark, sf_dir).select(
        kind.otherwise(UPDATE_AFTER).alias("op"),
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
        "user_id",
        F.col("k").alias("product_id"),
        "price",
        F.hour("ts").alias("hh"),
        "event_type",
    )


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a text record, with its time ``ts`` and position ``seq``.

    Views are records of a table nobody declares.
    """
    orders = order_changes(spark, sf_dir)
    products = product_changes(spark, sf_dir)
    customers = customer_changes(spark, sf_dir)
    views = events(spark, sf_dir).filter("event_type = 'view'").select(
        F.lit(INSERT).alias("op"), F.col("ts").alias("commit_ts"), F.col("event_id").alias("seq"), "user_id"
    )
    parts = [
        _records(orders, "orders", SPECS.orders.columns),
        _records(products, "products", SPECS.products.columns),
        _records(customers, "customers", SPECS.customers.columns),
        _records(views, "page_views", ["user_id"]),
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def _records(changes: DataFrame, table: str, columns: list[str]) -> DataFrame:
    image = F.struct(*[c for c in columns if c in changes.columns])
    removed = F.col("op") == DELETE
    record = F.struct(
        F.when(removed, REMOVE).otherwise(CREATE).alias("op"),
        F.when(removed, image).alias("before"),
        F.when(~removed, image).alias("after"),
        provenance(F.lit(table)).alias("source"),
    )
    text = F.to_json(record, {"timestampFormat": TIMESTAMP_TEXT})
    return changes.select(F.col("commit_ts").alias("ts"), "seq", text.alias("value"))


def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click as a record with one fault, by the last digit of its position: kinds 0 to 5, the rest are sound."""
    clicks = customer_changes(spark, sf_dir).withColumn("kind", F.pmod("seq", F.lit(10)))
    kind = F.col("kind")
    image = F.struct(F.when(kind != 0, F.col("customer_id")).alias("customer_id"), "customer_name")
    source = F.struct(
        F.lit("shop").alias("db"),
        F.lit("public").alias("schema"),
        F.when(kind == 1, "suppliers").otherwise("customers").alias("table"),
        F.unix_millis("commit_ts").alias("ts_ms"),
        F.when(kind != 2, F.col("seq")).alias("lsn"),
    )
    record = F.struct(
        F.when(kind == 3, UPDATE).when(kind == 4, "x").otherwise(CREATE).alias("op"),
        image.alias("after"),
        source.alias("source"),
    )
    text = F.to_json(record)
    text = F.when(kind == 5, F.substring(text, 1, 40)).otherwise(text)
    return clicks.select(F.col("commit_ts").alias("ts"), "seq", text.alias("value"))


def reorder_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``wire_events``, but each user has one order, which every purchase changes."""
    placed = order_changes(spark, sf_dir).withColumn("order_id", F.col("customer_id"))
    image = F.struct(*[c for c in SPECS.orders.columns if c in placed.columns])
    updates = last_before(placed.withColumn("after", image), ["order_id"], "seq", "after", "before")
    op = F.when(F.col("before").isNull(), CREATE).otherwise(UPDATE)
    record = F.struct(op.alias("op"), "before", "after", provenance(F.lit("orders")).alias("source"))
    text = F.to_json(record, {"timestampFormat": TIMESTAMP_TEXT})
    return (
        updates.select(F.col("commit_ts").alias("ts"), "seq", text.alias("value"))
        .unionByName(_records(product_changes(spark, sf_dir), "products", SPECS.products.columns))
        .unionByName(_records(customer_changes(spark, sf_dir), "customers", SPECS.customers.columns))
    )


def provenance(table: Column) -> Column:
    return F.struct(
        F.lit("shop").alias("db"),
        F.lit("public").alias("schema"),
        table.alias("table"),
        F.unix_millis("commit_ts").alias("ts_ms"),
        F.col("seq").alias("lsn"),
    )


def heartbeat(spark: SparkSession, days_later: int, last: DataFrame) -> DataFrame:
    """A record that only says that time went on, ``days_later`` after the last event."""
    moment = F.max("ts") + F.make_dt_interval(F.lit(days_later))
    late = last.agg(moment.alias("commit_ts"), F.max("seq").alias("seq"))
    record = F.struct(F.lit(CREATE).alias("op"), provenance(F.lit(HEARTBEAT)).alias("source"))
    return late.select(F.to_json(record).alias("value"))


def shard_by_time(rows: DataFrame, shards: int, span_of: DataFrame | None = None) -> DataFrame:
    """Adds ``shard``: the equal stretch of the time covered by ``span_of`` a row falls into."""
    us = micros("ts")
    span = (rows if span_of is None else span_of).agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    if span["lo"] is None:
        return rows.withColumn("shard", F.lit(0))
    width = span["hi"] - span["lo"] + 1
    return rows.withColumn("_offset", (us - F.lit(span["lo"])) * F.lit(shards)).withColumn(
        "shard", F.expr(f"cast(_offset div {width} as int)")
    ).drop("_offset")


def replay(rows: DataFrame, shards: int, fmt: str, folder: str, run: Callable[[int], None]) -> None:
    """Lets the shards of ``rows`` arrive one after the other as files, running after each.

    The rows are computed once, into one partition per shard.
    """
    staged = f"{folder}-staged"
    rows.write.partitionBy("shard").parquet(staged)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(staged)
    for shard in range(shards):
        part = stored.filter(F.col("shard") == shard).drop("shard")
        part.write.mode("append").format(fmt).save(folder)
        run(shard)
