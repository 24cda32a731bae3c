"""Tables declared in YAML.

::

    connectors:
      shop: {options: {host: db, schema: public}}
    tables:
      ods.orders:
        schema: order_id string, customer_id string, purchase_timestamp timestamp, dd string, hh int
        primary_key: [order_id, dd, hh]
        partition_by: [dd, hh]
        computed: {ts: "date_trunc('millisecond', purchase_timestamp)"}
        watermark: {column: ts, delay: 5 seconds}
      dws.sales:
        schema: product_id string, hh bigint, sales bigint
        primary_key: [product_id, hh]
        merge: aggregation
        aggregates: {sales: sum}
    temporary_tables:
      cdc_orders: {connector: shop, options: {table: orders}, schema: ..., primary_key: [order_id]}

The options of a connector apply to each table naming it; a table's own come on top.
"""

from __future__ import annotations

from collections.abc import Mapping

from tidemark.specs import TableSpec


def load_catalog(text: str) -> dict[str, TableSpec]:
    """Specs by table name, from YAML text."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading a YAML catalog needs PyYAML; use specs_from_dict instead") from error
    return specs_from_dict(yaml.safe_load(text) or {})


def specs_from_dict(declared: Mapping) -> dict[str, TableSpec]:
    connectors = declared.get("connectors") or {}
    tables = {**(declared.get("tables") or {}), **(declared.get("temporary_tables") or {})}
    return {name: _spec(name, entry, connectors) for name, entry in tables.items()}


def _spec(name: str, entry: Mapping, connectors: Mapping) -> TableSpec:
    options: dict[str, str] = {}
    if "connector" in entry:
        if entry["connector"] not in connectors:
            raise ValueError(f"{name}: unknown connector {entry['connector']!r}")
        options |= connectors[entry["connector"]].get("options") or {}
    options |= entry.get("options") or {}
    watermark = entry.get("watermark") or {}
    return TableSpec(
        name=name,
        schema=entry["schema"],
        pk=tuple(entry.get("primary_key") or ()),
        partition_by=tuple(entry.get("partition_by") or ()),
        merge=entry.get("merge", "latest"),
        aggregates=entry.get("aggregates") or {},
        ignore_delete=bool(entry.get("ignore_delete", False)),
        null_overwrites=tuple(entry.get("null_overwrites") or ()),
        computed=entry.get("computed") or {},
        event_time=watermark.get("column"),
        delay=watermark.get("delay"),
        options={k: str(v) for k, v in options.items()},
    )
