"""A small shop as change events, for the golden tests."""

import datetime as dt
import json

START = dt.datetime(2023, 5, 18, 10, 0, 0, tzinfo=dt.timezone.utc)

ORDERS = ("order_id", "product_id", "customer_id", "purchase_timestamp")
PRODUCTS = ("product_id", "product_name", "sale_price", "product_rating")
CUSTOMERS = ("customer_id", "customer_name")
COLUMNS = {"orders": ORDERS, "products": PRODUCTS, "customers": CUSTOMERS}


class Shop:
    """Keeps the tables of the shop to give full before images."""

    def __init__(self):
        self.rows = {t: {} for t in COLUMNS}
        self.events = []
        self.lsn = 0

    def _emit(self, t, table, op, before, after):
        self.lsn += 1
        ms = int((START + dt.timedelta(seconds=t)).timestamp() * 1000)
        source = {"db": "shop", "schema": "public", "table": table, "ts_ms": ms, "lsn": self.lsn}
        self.events.append((t, json.dumps({"op": op, "before": before, "after": after, "source": source})))

    def put(self, t, table, *values):
        row = dict(zip(COLUMNS[table], values))
        if table == "orders":
            row["purchase_timestamp"] = (START + dt.timedelta(seconds=t)).isoformat()
        before = self.rows[table].get(values[0])
        self.rows[table][values[0]] = row
        self._emit(t, table, "u" if before else "c", before, row)

    def change(self, t, table, key, **values):
        before = self.rows[table][key]
        after = {**before, **values}
        self.rows[table][key] = after
        self._emit(t, table, "u", before, after)

    def drop(self, t, table, key):
        self._emit(t, table, "d", self.rows[table].pop(key), None)

    def beat(self, t):
        self._emit(t, "heartbeat", "c", None, None)


def enrichment():
    """Products known in time, never, late, and re-priced between two orders."""
    shop = Shop()
    shop.put(0, "products", "1", "p1", 100, 0.0)
    shop.put(20, "orders", "1", "1", "1")
    shop.put(60, "orders", "2", "2", "1")
    shop.put(61, "orders", "3", "2", "1")
    shop.put(120, "orders", "4", "3", "1")
    shop.put(135, "products", "3", "p3", 300, 0.0)
    shop.change(180, "products", "1", sale_price=200)
    shop.put(195, "orders", "5", "1", "1")
    return shop


def with_customer():
    shop = enrichment()
    shop.put(220, "customers", "1", "ann")
    return shop
