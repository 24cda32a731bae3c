"""The retail layers: raw changes, enriched orders, hourly product sales."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowkind import adds
from tidemark.functions.temporal import day_of, hour_of, interval_micros, micros
from tidemark.operators.joins import last_match
from tidemark.operators.lookup import lookup_as_of
from tidemark.operators.merge import fold_aggregation, fold_partial_update
from tidemark.specs import TableSpec

# Retry budget of a missed lookup, watermark delay, commit interval.
RETRY_DELAY = "10 seconds"
MAX_RETRIES = 3
WATERMARK_DELAY = "5 seconds"
COMMIT_INTERVAL = "10 seconds"

PRODUCT_VALUES = ("product_name", "sale_price")
ORDER_COLUMNS = ("order_id", "product_id", "customer_id", "purchase_timestamp")


@dataclass(frozen=True)
class RetailSpecs:
    orders: TableSpec
    products: TableSpec
    customers: TableSpec
    enriched: TableSpec
    sales: TableSpec

    @property
    def sources(self) -> dict[str, TableSpec]:
        """Specs by the name of their source table."""
        return {"orders": self.orders, "products": self.products, "customers": self.customers}


def retail_specs(id_type: str = "string") -> RetailSpecs:
    return RetailSpecs(
        orders=TableSpec(
            "ods.orders",
            f"order_id {id_type}, product_id {id_type}, customer_id {id_type}, "
            "purchase_timestamp timestamp, dd string, hh int",
            pk=("order_id", "dd", "hh"),
            partition_by=("dd", "hh"),
            computed={
                "pts": "current_timestamp()",
                "ts": "date_trunc('millisecond', purchase_timestamp)",
            },
            event_time="ts",
            delay=WATERMARK_DELAY,
        ),
        products=TableSpec(
            "ods.products",
            f"product_id {id_type}, product_name string, sale_price int, product_rating double",
            pk=("product_id",),
            computed={"pts": "current_timestamp()", "ts": "date_trunc('millisecond', commit_ts)"},
        ),
        customers=TableSpec(
            "ods.customers",
            f"customer_id {id_type}, customer_name string",
            pk=("customer_id",),
            computed={"pts": "current_timestamp()", "ts": "date_trunc('millisecond', commit_ts)"},
        ),
        enriched=TableSpec(
            "dwd.order_enriched",
            f"order_id {id_type}, product_id {id_type}, customer_id {id_type}, "
            "purchase_timestamp timestamp_ntz, product_name string, sale_price int, customer_name string",
            pk=("order_id",),
            merge="partial-update",
            ignore_delete=True,
        ),
        sales=TableSpec(
            "dws.product_sales_by_hh",
            f"product_id {id_type}, hh bigint, sales bigint",
            pk=("product_id", "hh"),
            merge="aggregation",
            aggregates={"sales": "sum"},
        ),
    )


def with_hour_partition(orders: DataFrame) -> DataFrame:
    """Orders with the day and hour they are stored under."""
    return orders.withColumns(
        {"dd": day_of("purchase_timestamp"), "hh": hour_of("purchase_timestamp")}
    )


def product_half(
    orders: DataFrame,
    products: DataFrame,
    *,
    at: str = "commit_ts",
    retry_delay: str | int = RETRY_DELAY,
    max_retries: int = MAX_RETRIES,
    **kwargs,
) -> DataFrame:
    """Each order version with the product as it was when the order arrived.

    Retractions are left out: the enriched table ignores them, and the price they
    would find is not the one they retract.
    """
    return lookup_as_of(
        orders.filter(adds()).select("op", "seq", *({at} - {*ORDER_COLUMNS}), *ORDER_COLUMNS),
        products,
        ["product_id"],
        at,
        PRODUCT_VALUES,
        retry_delay=retry_delay,
        max_retries=max_retries,
        **kwargs,
    )


def enriched_history(
    orders: DataFrame,
    products: DataFrame,
    *,
    retry_delay: str | int = RETRY_DELAY,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """The changes of the enriched orders as they became visible, without the customer's name.

    An order shows at once, without a product if that is missing, and again when a retry finds it.
    """
    found = product_half(orders, products, retry_delay=retry_delay, max_retries=max_retries, attempt="attempt")
    later = F.col("attempt") > 0
    nothing = F.struct(F.lit(0).alias("after"), *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in PRODUCT_VALUES])
    hit = F.struct(F.coalesce("attempt", F.lit(0)).alias("after"), *PRODUCT_VALUES)
    seen = found.select(
        "op", "seq", "commit_ts", *ORDER_COLUMNS, F.inline(F.when(later, F.array(nothing, hit)).otherwise(F.array(hit)))
    )
    shown = F.timestamp_micros(micros("commit_ts") + F.col("after") * interval_micros(retry_delay))
    # Positions stay in the order of the log, and a hit follows its own miss.
    return seen.withColumns({"commit_ts": shown, "seq": F.col("seq") * (max_retries + 1) + F.col("after")}).drop("after")


def customer_half(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The customer name of each order version."""
    return last_match(orders, customers, ["customer_id"], ["order_id"], ["customer_name"])


def as_enriched_changes(half: DataFrame, spec: TableSpec) -> DataFrame:
    """One writer's rows with all columns of the table, nulls where it has none."""
    missing = [f for f in spec.schema.fields if f.name not in half.columns]
    wide = half.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return wide.select(
        "op", "seq", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    )


def enriched_orders(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    specs: RetailSpecs,
    *,
    retry_delay: str | int = RETRY_DELAY,
    max_retries: int = MAX_RETRIES,
    at: str = "commit_ts",
) -> DataFrame:
    """The enriched order table from three changelogs."""
    first = product_half(orders, products, at=at, retry_delay=retry_delay, max_retries=max_retries)
    second = customer_half(orders, customers)
    changes = as_enriched_changes(first, specs.enriched).unionByName(
        as_enriched_changes(second, specs.enriched)
    )
    return fold_partial_update(changes, specs.enriched)


def sales_changes(enriched_changes: DataFrame) -> DataFrame:
    """Changes of enriched orders as changes of the sales table.

    An order whose product half is still missing has no key there yet.
    """
    keyed = enriched_changes.select(
        "op", "product_id", hour_of("purchase_timestamp", "bigint").alias("hh"), F.col("sale_price").alias("sales")
    )
    return keyed.filter(F.col("product_id").isNotNull() & F.col("hh").isNotNull())


def product_sales(enriched: DataFrame, specs: RetailSpecs) -> DataFrame:
    """The sales table of a given state of the enriched orders."""
    inserts = enriched.withColumn("op", F.lit("+I"))
    return fold_aggregation(sales_changes(inserts), specs.sales)
