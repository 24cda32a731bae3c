"""Comparing streamed results with a batch recomputation, and correcting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sinks import overwrite_table
from tidemark.session import written
from tidemark.specs import TableSpec


def result_gap(streamed: DataFrame, recomputed: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys whose two results differ, with both values."""
    keys = list(keys)
    left = streamed.select(*keys, F.col(value).alias("streamed"), F.lit(True).alias("_in_stream"))
    right = recomputed.select(*keys, F.col(value).alias("recomputed"), F.lit(True).alias("_in_batch"))
    differs = ~F.col("streamed").eqNullSafe(F.col("recomputed")) | ~F.col("_in_stream").eqNullSafe(
        F.col("_in_batch")
    )
    return left.join(right, keys, "full").filter(differs).drop("_in_stream", "_in_batch")


def repair(spark: SparkSession, path: str, spec: TableSpec, recomputed: DataFrame) -> None:
    """Replaces the partitions of a streamed table that disagree with ``recomputed`` in any column.

    Partitions that agree are not rewritten. A partition that the recomputation has no row
    for is removed.
    """
    parts = list(spec.partition_by)
    streamed = spark.read.schema(spec.schema).parquet(path)
    row = F.struct(*spec.values).alias("row")
    gap = result_gap(streamed.select(*spec.pk, row), recomputed.select(*spec.pk, row), spec.pk, "row")
    wrong = written(gap.select(*parts).distinct(), "wrong")
    stale = wrong.join(recomputed.select(*parts).distinct(), parts, "left_anti")
    # A list of folders: as many as there are partitions to remove.
    folder = F.regexp_extract(F.input_file_name(), "^(.*)/[^/]*$", 1)
    gone = streamed.withColumn("folder", folder).join(stale, parts, "left_semi").select("folder").distinct().collect()
    overwrite_table(recomputed.join(wrong, parts, "left_semi"), spec, path, touched_only=True)
    for r in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(r["folder"]))
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def enriched_recompute(orders: DataFrame, products: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Enriched orders from the current tables: latest product for every order.

    Without ``customers`` the customer name is null in every row, as a plain
    recomputation of the product half leaves it.
    """
    rows = orders.join(products.select("product_id", "product_name", "sale_price"), "product_id", "left")
    if customers is None:
        return rows.withColumn("customer_name", F.lit(None).cast("string"))
    return rows.join(customers.select("customer_id", "customer_name"), "customer_id", "left")
