"""Values carried between the steps of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


def with_variables(df: DataFrame, variables: DataFrame) -> DataFrame:
    """Adds the columns of a one-row query to every row, as scalar subqueries.

    The query runs with the rest of the plan, and fails if it gives more than one row.
    """
    return df.withColumns({c: variables.select(c).scalar() for c in variables.columns})


def variable_values(variables: DataFrame) -> dict[str, object]:
    """The values of a one-row query, for ``spark.sql(text, args=...)``."""
    rows = variables.take(2)
    if len(rows) != 1:
        raise ValueError("a variables query gives exactly one row")
    return rows[0].asDict()


def observe_metrics(df: DataFrame, name: str, *aggs: Column) -> tuple[DataFrame, Observation]:
    """Measures ``aggs`` while ``df`` runs; ``observation.get`` has them after an action."""
    seen = Observation(name)
    return df.observe(seen, *aggs), seen


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
