"""The retail layers advanced one micro-batch of change events at a time."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from tidemark.functions.rowkind import adds
from tidemark.functions.temporal import interval_micros
from tidemark.operators.changes import expand_pairs
from tidemark.operators.merge import LIVE, fold_aggregation
from tidemark.operators.sinks import merge_partitions, read_merged
from tidemark.plans.retail import (
    COMMIT_INTERVAL,
    MAX_RETRIES,
    ORDER_COLUMNS,
    PRODUCT_VALUES,
    RETRY_DELAY,
    RetailSpecs,
    sales_changes,
    with_hour_partition,
)
from tidemark.session import path_exists
from tidemark.sources.envelope import fan_out, fan_out_schema, routed_rows, tag_events
from tidemark.specs import table_schema
from tidemark.streaming.states import change_schema, halves_and_meetings, images_of, lookup_when_due, meetings, merged_pairs

#: Where the stateful queries keep their state.
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RetailLayers:
    """Raw, enriched and summed tables under one folder.

    ``process`` is the body of ``foreachBatch``. It writes the changes of a batch by table, merges
    the orders into their partitions, then lets three streaming queries take what is new, from checkpoints of their own:

    * *lookup*: orders wait in keyed state for their product, until it comes or a timer ends
      the retries; orders and customers meet in a stream-stream join.
    * *enriched*: a streaming aggregation merges both halves by order and gives out the old
      image with the new.
    * *sales*: a streaming aggregation of these changes, where old rows subtract.

    State is Spark's: it costs what a batch touches and is restored from its checkpoint. A
    batch that is run again finds its changes written and no state to move. Results depend
    on the events and their log order, not on where the stream was cut into batches.

    Time is the largest event time seen in this batch or an earlier one. All product
    versions are kept, so an order that arrives however late finds the version of its time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        specs: RetailSpecs,
        *,
        retry_delay: str | int = RETRY_DELAY,
        max_retries: int = MAX_RETRIES,
        cells: int = 8,
    ) -> None:
        self.spark = spark
        self.path = path
        self.specs = specs
        self.delay = interval_micros(retry_delay)
        self.retries = max_retries
        self.cells = cells
        self.version = -1
        image = images_of(specs.enriched)
        (pk,) = specs.enriched.pk
        stored = [specs.enriched.schema[pk], StructField("old", image), StructField("new", image)]
        batch = table_schema("v int, b int").fields
        self._pairs = StructType([*stored, *batch])
        self._sums = StructType([*specs.sales.schema.fields, *table_schema(f"{LIVE} bigint").fields, *batch])

    # -- one batch -----------------------------------------------------------

    def process(self, events: DataFrame, version: int) -> None:
        """Takes the events of one batch (text column ``value``) through all layers."""
        self.version = version
        self._ingest(events, version)
        merge_partitions(with_hour_partition(self.raw("orders", version)), self.specs.orders, f"{self.path}/orders")
        with self._state_settings():
            self._advance("lookup", self._look_up(), "append")
            self._advance("enriched", self._enrich(), "update")
            self._advance("sales", self._sum(), "update")

    def _ingest(self, events: DataFrame, version: int) -> None:
        """All tables' changes and what is refused, in one pass and one write, unless the batch was written before."""
        if path_exists(self.spark, f"{self.path}/clock/v={version}/_SUCCESS"):
            return
        seen = Observation()
        tagged = tag_events(events).observe(seen, F.max("ts_ms").alias("ms"))
        _replace(fan_out(tagged, self.specs.sources), f"{self.path}/raw/v={version}", "routed")
        latest = seen.get["ms"]
        if version > 0:
            folder = f"{self.path}/clock/v={version - 1}"
            earlier = self.spark.read.schema("ms bigint").parquet(folder).first()["ms"]
            latest = max((ms for ms in (latest, earlier) if ms is not None), default=None)
        _replace(self.spark.createDataFrame([(latest,)], "ms bigint").coalesce(1), f"{self.path}/clock/v={version}")

    def _look_up(self) -> DataFrame:
        """The streaming plan of both lookups: order versions, what their product was once that is settled, and the customer versions they meet."""
        spec = self.specs.enriched
        (pk,) = spec.pk
        orders, products, customers = (self._raw_stream(table) for table in ("orders", "products", "customers"))
        ticks = self.spark.readStream.schema("ms bigint, v int").parquet(f"{self.path}/clock")
        placed = orders.withColumn("purchase_timestamp", F.col("purchase_timestamp").cast("timestamp_ntz"))
        found = lookup_when_due(
            placed.filter(adds()).select("op", "commit_ts", "seq", *ORDER_COLUMNS),
            products,
            ticks.select(F.timestamp_millis("ms").alias("clock")),
            "product_id",
            "order_id",
            PRODUCT_VALUES,
            delay=self.delay,
            retries=self.retries,
            cells=self.cells,
        )
        met = meetings(orders, customers, "customer_id", pk, "customer_name")
        return halves_and_meetings(found, orders.select("op", "seq", pk), met, spec, "customer_name")

    def _enrich(self) -> DataFrame:
        """The streaming plan of the enriched table: its changes as old and new images."""
        spec = self.specs.enriched
        schema = StructType([*change_schema(spec).fields, *table_schema("v int, b int").fields])
        changes = self.spark.readStream.schema(schema).parquet(f"{self.path}/lookup")
        return merged_pairs(changes, spec, "customer_name", "v")

    def _raw_stream(self, table: str) -> DataFrame:
        schema = StructType([*fan_out_schema(self.specs.sources).fields, *table_schema("v int").fields])
        return routed_rows(self.spark.readStream.schema(schema).parquet(f"{self.path}/raw"), table)

    def _sum(self) -> DataFrame:
        """The streaming plan of the sales table: the sums of the keys a batch changes."""
        return fold_aggregation(sales_changes(self.enriched_stream()), self.specs.sales)

    def _advance(self, name: str, plan: DataFrame, mode: str) -> None:
        """Runs a stateful query over what is new, into folders of this version."""

        def store(rows: DataFrame, batch: int) -> None:
            _replace(rows, f"{self.path}/{name}/v={self.version}/b={batch}")

        running = (
            plan.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{self.path}/checkpoints/{name}")
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
        )
        running.awaitTermination()

    @contextmanager
    def _state_settings(self):
        before = self.spark.conf.get(STATE_PROVIDER, None)
        self.spark.conf.set(STATE_PROVIDER, ROCKS_DB)
        try:
            yield
        finally:
            self.spark.conf.unset(STATE_PROVIDER) if before is None else self.spark.conf.set(STATE_PROVIDER, before)

    # -- tables --------------------------------------------------------------

    def raw(self, table: str, version: int) -> DataFrame:
        """The changelog of one source table in one batch."""
        return routed_rows(self._raw(version), table)

    def orders_table(self) -> DataFrame:
        """The orders as they are, kept by day and hour of purchase: a batch rewrites the partitions it touches."""
        return read_merged(self.spark, self.specs.orders, f"{self.path}/orders")

    def quarantine(self, version: int) -> DataFrame:
        """The records of one batch that no table takes, with the reason."""
        return self._raw(version).filter("routed is null").select("value", "reason")

    def enriched_table(self, version: int) -> DataFrame:
        spec = self.specs.enriched
        last = self._last(self._stored("enriched", self._pairs, version), list(spec.pk), ["new"])
        return last.filter(F.col("new").isNotNull()).select(*spec.pk, "new.*").select(*spec.columns)

    def sales_table(self, version: int) -> DataFrame:
        spec = self.specs.sales
        values = [c for c in self._sums.names if c not in (*spec.pk, "v", "b")]
        return self._last(self._stored("sales", self._sums, version), list(spec.pk), values)

    def enriched_stream(self) -> DataFrame:
        """All changes of the enriched table, old and new rows, as a stream; ``v`` and ``b`` say when they were made."""
        spec = self.specs.enriched
        pairs = self.spark.readStream.schema(self._pairs).parquet(f"{self.path}/enriched")
        return expand_pairs(pairs, ["v", "b", *spec.pk])

    def sales_stream(self) -> DataFrame:
        """The sums of the sales table as they change, as a stream; ``v`` and ``b`` say when they were made."""
        return self.spark.readStream.schema(self._sums).parquet(f"{self.path}/sales")

    def version_at(self, moment_ms: int) -> int:
        """The last batch committed by ``moment_ms``, in event time; -1 before the first."""
        clocks = self.spark.read.schema("ms bigint, v int").parquet(f"{self.path}/clock")
        return clocks.filter(F.col("ms") <= moment_ms).agg(F.coalesce(F.max("v"), F.lit(-1)).alias("v")).first()["v"]

    def enriched_as_of(self, moment_ms: int) -> DataFrame:
        """The enriched table as it was stored at a moment of event time."""
        return self.enriched_table(self.version_at(moment_ms))

    def sales_as_of(self, moment_ms: int) -> DataFrame:
        """The sales table as it was stored at a moment of event time."""
        return self.sales_table(self.version_at(moment_ms))

    def _raw(self, version: int) -> DataFrame:
        return self.spark.read.schema(fan_out_schema(self.specs.sources)).parquet(f"{self.path}/raw/v={version}")

    def _stored(self, name: str, schema: StructType, version: int) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").filter(F.col("v") <= version)

    def _last(self, rows: DataFrame, pk: list[str], values: list[str]) -> DataFrame:
        last = rows.groupBy(*pk).agg(F.max_by(F.struct(*values), F.struct("v", "b")).alias("_last"))
        return last.select(*pk, "_last.*")


def _replace(rows: DataFrame, folder: str, *partition_by: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)


def start_layers(
    events: DataFrame, layers: RetailLayers, checkpoint: str, name: str = "retail-layers", **trigger
) -> StreamingQuery:
    """Runs the layers over a stream of events; results appear once per commit interval."""
    return (
        events.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL}))
        .foreachBatch(layers.process)
        .start()
    )
