"""The shop scenarios: one batch, and the same events cut into micro-batches."""

import random

import pytest
import scenario
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark import scratch_dir
from tidemark.operators.aggregates import customer_total, hourly_sales
from tidemark.operators.merge import current_state
from tidemark.operators.repair import enriched_recompute
from tidemark.operators.travel import changes_until, snapshot_as_of
from tidemark.plans.retail import enriched_orders, product_sales, retail_specs, with_hour_partition
from tidemark.sources.envelope import route_changes
from tidemark.streaming.layered import RetailLayers, start_layers
from tidemark.streaming.states import change_schema, merged_pairs

SPECS = retail_specs()


def changelogs(spark, shop):
    raw = spark.createDataFrame([(v,) for _, v in shop.events], "value string")
    routed = route_changes(raw, SPECS.sources)
    routed["orders"] = with_hour_partition(routed["orders"])
    return routed


def enriched_rows(df):
    cols = ("order_id", "product_id", "customer_id", "product_name", "sale_price", "customer_name")
    return {r["order_id"]: tuple(r[c] for c in cols[1:]) for r in df.select(*cols).collect()}


def sales_rows(df):
    return {(r["product_id"], r["hh"]): r["sales"] for r in df.collect()}


def batch(spark, shop):
    logs = changelogs(spark, shop)
    enriched = enriched_orders(logs["orders"], logs["products"], logs["customers"], SPECS)
    return enriched_rows(enriched), sales_rows(product_sales(enriched, SPECS))


def streamed(spark, shop, cuts, end=100_000):
    """Runs the events through the layers, cut after the given times."""
    shop.beat(end)
    layers = RetailLayers(spark, scratch_dir(spark, "golden"), SPECS)
    bounds = [*cuts, end + 1]
    low, version = -1, 0
    for high in bounds:
        rows = [(v,) for t, v in shop.events if low < t <= high]
        layers.process(spark.createDataFrame(rows, "value string"), version)
        low, version = high, version + 1
    return layers, version - 1


BASE = {
    "1": ("1", "1", "p1", 100, None),
    "2": ("2", "1", None, None, None),
    "3": ("2", "1", None, None, None),
    "4": ("3", "1", "p3", 300, None),
    "5": ("1", "1", "p1", 200, None),
}
BASE_SALES = {("1", 10): 300, ("2", 10): None, ("3", 10): 300}


def test_enrichment_in_batch(spark):
    rows, sales = batch(spark, scenario.enrichment())
    assert rows == BASE
    assert sales == BASE_SALES


def test_late_product_is_found_by_the_second_retry(spark):
    layers, _ = streamed(spark, scenario.enrichment(), (125, 139, 145))
    shown = lambda v: enriched_rows(layers.enriched_table(v))
    assert "4" not in shown(0)
    assert "4" not in shown(1)
    assert shown(3)["4"] == ("3", "1", "p3", 300, None)


def named(rows, name="ann"):
    return {k: (*v[:4], name) for k, v in rows.items()}


def order_to_other_product(s):
    s.change(300, "orders", "1", product_id="3")


def order_to_other_customer(s):
    s.put(290, "customers", "2", "bob")
    s.change(300, "orders", "5", customer_id="2")


ANN = named(BASE)
MATRIX = {
    "customer arrives": (lambda s: None, {}, {}),
    "product price changes": (lambda s: s.change(300, "products", "3", sale_price=350), {}, {}),
    "order to another product": (
        order_to_other_product,
        {"1": ("3", "1", "p3", 300, "ann")},
        {("1", 10): 200, ("3", 10): 600},
    ),
    "order to another customer": (order_to_other_customer, {"5": ("1", "2", "p1", 200, "bob")}, {}),
    "customer renamed": (
        lambda s: s.change(300, "customers", "1", customer_name="amy"),
        {k: (*v[:4], "amy") for k, v in ANN.items()},
        {},
    ),
    "order deleted": (lambda s: s.drop(300, "orders", "4"), {}, {}),
    "product deleted": (lambda s: s.drop(300, "products", "3"), {}, {}),
    "customer deleted": (lambda s: s.drop(300, "customers", "1"), {}, {}),
    "order to a missing product keeps the old name and price": (
        lambda s: s.change(300, "orders", "1", product_id="9"),
        {"1": ("9", "1", "p1", 100, "ann")},
        {("1", 10): 200, ("9", 10): 100},
    ),
    "order changed after a re-price is looked up again": (
        lambda s: s.change(300, "orders", "1", customer_id="1"),
        {"1": ("1", "1", "p1", 200, "ann")},
        {("1", 10): 400},
    ),
    "order to a missing customer keeps the old name": (
        lambda s: s.change(300, "orders", "1", customer_id="7"),
        {"1": ("1", "7", "p1", 200, "ann")},
        {("1", 10): 400},
    ),
}


@pytest.mark.parametrize("case", MATRIX)
def test_outcome_matrix_in_batch(spark, case):
    change, rows, sales = MATRIX[case]
    shop = scenario.with_customer()
    change(shop)
    got_rows, got_sales = batch(spark, shop)
    assert got_rows == {**ANN, **rows}
    assert got_sales == {**BASE_SALES, **sales}


def busy_shop():
    """All of the changes above, one after the other."""
    shop = scenario.with_customer()
    order_to_other_product(shop)
    shop.put(305, "customers", "2", "bob")
    shop.change(310, "orders", "5", customer_id="2")
    shop.change(315, "customers", "1", customer_name="amy")
    shop.change(316, "products", "3", sale_price=350)
    shop.change(320, "orders", "2", product_id="9")
    shop.change(325, "orders", "2", customer_id="7")
    shop.put(340, "products", "9", "p9", 900, 0.0)
    shop.drop(345, "customers", "2")
    shop.change(350, "orders", "3", customer_id="2")
    shop.put(355, "customers", "2", "ben")
    shop.drop(360, "orders", "4")
    shop.drop(365, "products", "1")
    shop.put(370, "orders", "6", "1", "2")
    shop.put(395, "products", "1", "p1 again", 111, 0.0)
    return shop


@pytest.mark.parametrize("cuts", [(133, 312), (300, 330, 360)])
def test_any_cut_gives_the_batch_result(spark, cuts):
    shop = busy_shop()
    rows, sales = batch(spark, shop)
    layers, last = streamed(spark, shop, cuts)
    assert enriched_rows(layers.enriched_table(last)) == rows
    live = layers.sales_table(last).filter("live_rows > 0")
    assert sales_rows(live) == sales


def test_stream_shows_the_scenario_and_repeats_safely(spark):
    shop = scenario.enrichment()
    layers, last = streamed(spark, shop, (125,))
    shown = enriched_rows(layers.enriched_table(last)), sales_rows(layers.sales_table(last))
    assert shown == (BASE, BASE_SALES)
    for version, (low, high) in enumerate([(-1, 125), (125, 200_000)]):
        rows = [(v,) for t, v in shop.events if low < t <= high]
        layers.process(spark.createDataFrame(rows, "value string"), version)
    assert shown == (enriched_rows(layers.enriched_table(last)), sales_rows(layers.sales_table(last)))


def test_customer_half_first_is_counted_once(spark):
    """An order waits for its product while its customer is known already."""
    shop = scenario.Shop()
    shop.put(0, "customers", "1", "ann")
    shop.put(10, "orders", "1", "1", "1")
    shop.put(25, "products", "1", "p1", 100, 0.0)
    layers, last = streamed(spark, shop, (12, 22))
    assert enriched_rows(layers.enriched_table(0)) == {"1": (None, None, None, None, "ann")}
    assert sales_rows(layers.sales_table(0)) == {}
    assert enriched_rows(layers.enriched_table(last)) == {"1": ("1", "1", "p1", 100, "ann")}
    assert sales_rows(layers.sales_table(last)) == {("1", 10): 100}


def test_batch_reads_latest_prices(spark):
    logs = changelogs(spark, scenario.enrichment())
    orders = current_state(logs["orders"], SPECS.orders)
    products = current_state(logs["products"], SPECS.products)
    rows = {r["order_id"]: r["sale_price"] for r in enriched_recompute(orders, products).collect()}
    assert rows == {"1": 200, "2": None, "3": None, "4": 300, "5": 200}
    assert sales_rows(hourly_sales(orders, products)) == {("1", 10): 400, ("2", 10): None, ("3", 10): 300}


def test_customer_totals_before_and_after_overwrite(spark):
    logs = changelogs(spark, scenario.enrichment())
    streamed_table = enriched_orders(logs["orders"], logs["products"], logs["customers"], SPECS)
    assert [r["sales"] for r in customer_total(streamed_table, "1").collect()] == [600]
    orders = current_state(logs["orders"], SPECS.orders)
    redone = enriched_recompute(orders, current_state(logs["products"], SPECS.products))
    assert [r["sales"] for r in customer_total(redone, "1").collect()] == [700]
    assert redone.filter("customer_name is not null").isEmpty()


def test_customer_total_as_of(spark):
    shop = scenario.enrichment()
    logs = changelogs(spark, shop)
    moment = int((scenario.START.timestamp() + 100) * 1000)
    past = {t: changes_until(c, moment) for t, c in logs.items()}
    table = enriched_orders(past["orders"], past["products"], past["customers"], SPECS)
    assert [r["sales"] for r in customer_total(table, "1").collect()] == [100]
    assert snapshot_as_of(logs["orders"], SPECS.orders, moment).count() == 3
    assert snapshot_as_of(logs["orders"], SPECS.orders, 0).isEmpty()


def test_stream_differs_from_batch_by_the_price_change(spark):
    logs = changelogs(spark, scenario.enrichment())
    enriched = enriched_orders(logs["orders"], logs["products"], logs["customers"], SPECS)
    stream = product_sales(enriched, SPECS)
    products = current_state(logs["products"], SPECS.products)
    full = hourly_sales(current_state(logs["orders"], SPECS.orders), products)
    gap = stream.alias("s").join(full.alias("b"), ["product_id", "hh"]).filter(
        ~F.col("s.sales").eqNullSafe(F.col("b.sales"))
    )
    assert [(r[0], r[2], r[4]) for r in gap.collect()] == [("1", 300, 400)]


def in_batches(spark, *batches):
    layers = RetailLayers(spark, scratch_dir(spark, "late"), SPECS)
    for version, events in enumerate(batches):
        layers.process(spark.createDataFrame([(v,) for _, v in events], "value string"), version)
    return enriched_rows(layers.enriched_table(len(batches) - 1))


def test_an_order_that_comes_after_its_price_changed(spark):
    """However late, it finds the price of its own time, as a batch does."""
    shop = scenario.Shop()
    shop.put(0, "products", "1", "p1", 100, 0.0)
    shop.put(100, "orders", "1", "1", "1")
    shop.change(500, "products", "1", sale_price=200)
    shop.beat(10_000)
    first, order, second, beat = shop.events
    assert in_batches(spark, [first], [second], [beat], [order]) == {"1": ("1", "1", "p1", 100, None)}
    assert batch(spark, shop)[0] == {"1": ("1", "1", "p1", 100, None)}


def test_versions_that_come_out_of_order(spark):
    shop = scenario.Shop()
    shop.put(0, "products", "1", "p1", 100, 0.0)
    shop.put(0, "customers", "1", "ann")
    shop.change(500, "products", "1", sale_price=200)
    shop.change(500, "customers", "1", customer_name="amy")
    shop.put(600, "orders", "1", "1", "1")
    shop.beat(10_000)
    old, ann, new, amy, order, beat = shop.events
    got = in_batches(spark, [new, amy], [beat], [old, ann], [order], [])
    assert got == {"1": ("1", "1", "p1", 200, "amy")}


def test_stored_tables_as_of_a_moment(spark):
    shop = scenario.enrichment()
    layers, last = streamed(spark, shop, [70, 140])
    at = lambda t: int((scenario.START.timestamp() + t) * 1000)
    assert layers.version_at(at(-1)) == -1 and layers.enriched_as_of(at(-1)).isEmpty()
    assert layers.version_at(at(135)) == 1 and layers.version_at(at(200_000)) == last
    early = enriched_rows(layers.enriched_as_of(at(135)))
    assert early["1"] == BASE["1"] and "5" not in early
    assert enriched_rows(layers.enriched_as_of(at(200_000))) == BASE
    assert sales_rows(layers.sales_as_of(at(200_000))) == sales_rows(layers.sales_table(last))


def test_layers_run_at_a_commit_interval(spark):
    """The job as it is started by default: a processing-time trigger."""
    shop = scenario.enrichment()
    shop.beat(100_000)
    folder = scratch_dir(spark, "interval")
    spark.createDataFrame([(v,) for _, v in shop.events], "value string").write.text(f"{folder}/events")
    layers = RetailLayers(spark, f"{folder}/tables", SPECS)
    running = start_layers(spark.readStream.text(f"{folder}/events"), layers, f"{folder}/checkpoint")
    running.processAllAvailable()
    progress = running.lastProgress
    running.stop()
    assert progress["batchId"] >= 0
    assert enriched_rows(layers.enriched_table(0)) == BASE


def test_state_lies_in_the_state_store_and_outlives_the_job(spark):
    """Each batch by a job of its own, as after a crash; a batch that comes again moves nothing."""
    shop = busy_shop()
    shop.beat(100_000)
    folder = scratch_dir(spark, "restarted")
    cuts = [-1, 130, 320, 200_000]
    parts = [[(v,) for t, v in shop.events if low < t <= high] for low, high in zip(cuts, cuts[1:])]
    for version, again in ((0, False), (1, False), (1, True), (2, False), (2, True)):
        before = enriched_rows(RetailLayers(spark, folder, SPECS).enriched_table(version)) if again else None
        RetailLayers(spark, folder, SPECS).process(spark.createDataFrame(parts[version], "value string"), version)
        if again:
            assert enriched_rows(RetailLayers(spark, folder, SPECS).enriched_table(version)) == before
    layers = RetailLayers(spark, folder, SPECS)
    assert (enriched_rows(layers.enriched_table(2)), sales_rows(layers.sales_table(2).filter("live_rows > 0"))) == batch(spark, shop)
    current = current_state(changelogs(spark, shop)["orders"], SPECS.orders)
    assert sorted(map(tuple, layers.orders_table().collect())) == sorted(map(tuple, current.select(*SPECS.orders.columns).collect()))
    operators = {
        r["operatorName"]
        for name in ("lookup", "enriched", "sales")
        for r in spark.read.format("state-metadata").load(f"{folder}/checkpoints/{name}").collect()
    }
    assert operators == {"applyInPandasWithState", "symmetricHashJoin", "stateStoreSave"}


def test_the_clock_does_not_run_back(spark):
    shop = scenario.Shop()
    shop.put(0, "orders", "1", "1", "1")
    shop.beat(10_000)
    shop.beat(1)
    order, late, early = shop.events
    assert in_batches(spark, [late], [order], [early]) == {"1": ("1", "1", None, None, None)}


def test_orders_are_merged_without_a_python_state_each(spark):
    """A group of Python rows per order and batch made the layered job slow."""
    shop = scenario.with_customer()
    layers, _ = streamed(spark, shop, ())
    operators = [r["operatorName"] for r in spark.read.format("state-metadata").load(f"{layers.path}/checkpoints/enriched").collect()]
    assert operators == ["stateStoreSave"]


def merged_by_hand(changes, newest):
    """Column by column, and meeting by meeting, of the changes up to a batch."""
    changes = [c for c in changes if c["v"] <= newest]
    row = {}
    for column in ("product_id", "sale_price"):
        held = [(c["seq"], c["image"][column]) for c in changes if c["kind"] == "half" and c["image"][column] is not None]
        row[column] = max(held)[1] if held else None
    starts = sorted({c["seq"] for c in changes if c["kind"] == "fact"})
    row["customer_name"] = None
    for start, end in zip(starts, [*starts[1:], float("inf")]):
        lives = sorted((c["met"], c["value"]) for c in changes if c["kind"] == "met" and c["seq"] == start)
        for (since, found), until in zip(lives, [*[m for m, _ in lives[1:]], float("inf")]):
            if found is not None and max(start, since) < min(end, until):
                row["customer_name"] = found
    return row if any(v is not None for v in row.values()) else None


def test_merged_pairs_against_a_merge_by_hand(spark):
    rng = random.Random(7)
    changes = {}
    for order in range(60):
        key = str(order)
        facts = rng.sample(range(100), rng.randint(0, 4))
        own = changes[key] = []
        for seq in facts:
            own.append({"kind": "fact", "seq": seq})
            if rng.random() < 0.7:
                image = {"product_id": rng.choice([None, "1", "2"]), "sale_price": rng.choice([None, 5, 6])}
                own.append({"kind": "half", "seq": seq, "image": image})
            for met in rng.sample(range(100, 130) if rng.random() < 0.2 else range(100), rng.randint(0, 4)):
                own.append({"kind": "met", "seq": seq, "met": met, "value": rng.choice([None, "ann", "amy", "bob"])})
        since = {seq: rng.randint(0, 2) for seq in facts}
        for change in own:  # nothing comes before the fact version it belongs to
            change["v"] = since[change["seq"]] if change["kind"] == "fact" else rng.randint(since[change["seq"]], 2)
        own.extend(rng.sample(own, min(len(own), 2)))
    schema = StructType([*change_schema(SPECS.enriched).fields, StructField("v", IntegerType())])
    blank = dict.fromkeys(schema.fieldNames())
    rows = [blank | {"order_id": key, **change} for key, own in changes.items() for change in own]
    df = spark.createDataFrame(rows, schema)
    got = {r["order_id"]: (r["old"], r["new"]) for r in merged_pairs(df, SPECS.enriched, "customer_name", "v").collect()}
    want = {}
    for key, own in changes.items():
        newest = max((c["v"] for c in own), default=-1)
        old, new = merged_by_hand(own, newest - 1), merged_by_hand(own, newest)
        if old != new:
            want[key] = (old, new)
    shown = lambda image: image and {c: image[c] for c in ("product_id", "sale_price", "customer_name")}
    assert {k: tuple(map(shown, pair)) for k, pair in got.items()} == want
    assert len(want) > 30
