"""Versions of batch tables, replay and file sizes of streaming tables, rule
results, columns that appear later, and JSON without loss."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailflow import schemas
from retailflow.operators import bronze, gold, json_orders
from retailflow.operators.distinct import agg_with_distinct, dense
from retailflow.operators.expectations import VALID_ORDER_ID_DROP, VALID_TIMESTAMP_DROP, Expectation
from retailflow.operators.json_orders import utc_timestamp
from retailflow.operators.ranking import in_ranges, ranked, written
from retailflow.sources import files
from retailflow.sources.columns import csv_columns, csv_headers, header_names, joined, read_csv_by_header
from retailflow.streaming import runner
from retailflow.streaming.runner import (
    Warehouse,
    current_version,
    expectation_results,
    known_columns,
    quarantined,
    read_all_columns,
    refresh_table,
    remove_old_versions,
    run_customer_bronze,
    run_json_streams,
    run_orders_bronze,
    run_stream_table,
    versions,
    write_batch,
)

HEADER = "customer_id,first_name,last_name,email,phone,geography_id,registration_date"


def land(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def bag(df):
    return Counter(map(tuple, df.collect()))


# ---- batch tables


def test_a_reader_that_started_before_a_refresh_finishes(spark, scratch):
    wh = Warehouse(scratch)
    refresh_table(spark.range(5), wh, "t")
    before = spark.read.parquet(wh.table("t"))
    refresh_table(spark.range(100, 107), wh, "t")
    assert sorted(r.id for r in before.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in spark.read.parquet(wh.table("t")).collect()) == list(range(100, 107))


def test_a_crash_before_the_pointer_leaves_the_table(spark, scratch, monkeypatch):
    wh = Warehouse(scratch)
    refresh_table(spark.range(5), wh, "t")

    def crash(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(runner, "_pointer", crash)
    with pytest.raises(RuntimeError):
        refresh_table(spark.range(9), wh, "t")
    assert spark.read.parquet(wh.table("t")).count() == 5
    monkeypatch.undo()
    refresh_table(spark.range(7), wh, "t")
    assert spark.read.parquet(wh.table("t")).count() == 7 and len(versions(spark, wh, "t")) == 2


def test_old_versions_stay_for_the_retention_time(spark, scratch):
    wh = Warehouse(scratch)
    first, second, third = (refresh_table(spark.range(n), wh, "t") for n in (1, 2, 3))
    assert remove_old_versions(spark, wh, "t", retention=3600) == []
    assert spark.read.parquet(first).count() == 1
    assert remove_old_versions(spark, wh, "t", retention=0) == [first, second]
    assert wh.table("t") == third and spark.read.parquet(third).count() == 3
    assert remove_old_versions(spark, wh, "t", retention=0) == []
    assert current_version(spark, wh, "never") is None


def test_stored_order_gives_files_of_disjoint_ranges(spark, scratch):
    """Also where one value holds a third of all rows: the next key splits it."""
    wh, n = Warehouse(scratch), 30_000
    i = F.col("id")
    rows = spark.range(n).select(F.when(i % 3 == 0, 7.0).otherwise((i * 7919 % 5000).cast("double")).alias("total_revenue"), i.alias("category"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would become one
    try:
        refresh_table(rows, wh, "t", cluster_by=(F.desc("total_revenue"), F.asc("category")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    place = F.struct(-F.col("total_revenue"), "category")
    found = spark.read.parquet(wh.table("t")).groupBy(F.col("_metadata.file_name").alias("f"))
    ranges = sorted((tuple(r.lo), tuple(r.hi), r.n) for r in found.agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n")).collect())
    assert len(ranges) > 4 and sum(r[2] for r in ranges) == n and max(r[2] for r in ranges) < n / 3
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    in_file = spark.read.parquet(wh.table("t")).select(F.col("_metadata.file_name"), F.monotonically_increasing_id().alias("i"), place.alias("p"))
    by_file = {}
    for name, _, p in sorted(map(tuple, in_file.collect()), key=lambda r: r[1]):
        by_file.setdefault(name, []).append(tuple(p))
    assert all(x == sorted(x) for x in by_file.values())


# ---- streaming tables


def test_a_replayed_batch_changes_nothing(spark, scratch):
    wh = Warehouse(scratch)
    spark.range(50).write.parquet(f"{scratch}/src")
    run_stream_table(spark.readStream.schema("id long").parquet(f"{scratch}/src"), wh, "t")
    whole = bag(spark.read.parquet(wh.table("t")))
    write_batch(spark.range(50), wh, "t", 0)  # as after a driver lost between write and commit
    assert bag(spark.read.parquet(wh.table("t"))) == whole and sum(whole.values()) == 50
    rules = (Expectation("small", "id < 40", "drop"),)
    for _ in range(2):
        write_batch(spark.range(50), wh, "u", 3, rules)
    assert spark.read.parquet(f"{wh.kept('u')}/_batch=3").count() == 40
    assert quarantined(spark, wh, "u", rules).count() == 10
    assert [(r.rows_seen, r.violations) for r in expectation_results(spark, wh).collect()] == [(50, 10)]


def test_files_follow_the_bytes_and_not_the_tasks(spark, scratch):
    wh = Warehouse(scratch)
    spark.range(0, 4000, 1, 64).write.parquet(f"{scratch}/src")
    write_batch(spark.read.parquet(f"{scratch}/src").repartition(64), wh, "t", 0)
    found = spark.read.parquet(wh.table("t")).select("_metadata.file_path").distinct().count()
    assert found == 1
    assert spark.read.parquet(wh.table("t")).count() == 4000


def test_a_lost_commit_replays_the_batch(spark, scratch):
    """The write of a batch fails after its rows are there; the next run
    repeats the batch under its number."""
    wh = Warehouse(scratch)
    spark.range(20).write.parquet(f"{scratch}/src")
    stream = spark.readStream.schema("id long").parquet(f"{scratch}/src")
    once, calls = runner.write_batch, []

    def fails(df, wh, name, batch_id, rules=()):
        once(df, wh, name, batch_id, rules)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost after the write")

    runner.write_batch = fails
    try:
        with pytest.raises(Exception, match="lost after the write"):
            run_stream_table(stream, wh, "t")
        run_stream_table(stream, wh, "t")
    finally:
        runner.write_batch = once
    assert calls == [0, 0] and spark.read.parquet(wh.table("t")).count() == 20


def test_rules_leave_results_and_quarantine(spark, scratch):
    lines = ['{"order_id":1,"order_timestamp":"2022-01-01 00:00:00"}', '{"order_id":"A-2","order_timestamp":"2022-01-01 00:00:00","x":[1]}',
             '{"order_id":3,"order_timestamp":"2020-01-01 00:00:00"}', "{broken"]
    land(spark, f"{scratch}/json/orders", *lines)
    wh = Warehouse(f"{scratch}/wh")
    warned = Expectation("has_customer", "customer_id IS NOT NULL", "warn")
    run_json_streams(spark, f"{scratch}/json", wh, (VALID_ORDER_ID_DROP, warned), (VALID_TIMESTAMP_DROP,))
    got = {(r.dataset, r.rule): (r.action, r.rows_seen, r.violations) for r in expectation_results(spark, wh).collect()}
    assert got == {
        ("orders_bronze_demo3", "valid_order_id"): ("drop", 4, 2), ("orders_bronze_demo3", "has_customer"): ("warn", 4, 4),
        ("orders_silver_demo3", "valid_timestamp"): ("drop", 2, 1),
    }
    out = quarantined(spark, wh, "orders_bronze_demo3", (VALID_ORDER_ID_DROP, warned))
    assert {(r.order_id_text, r.broken_line): sorted(r.violated_rules) for r in out.collect()} == {
        ("A-2", None): ["has_customer", "valid_order_id"], (None, "{broken"): ["has_customer", "valid_order_id"],
    }
    assert [r.order_id for r in spark.read.parquet(wh.table("orders_silver_demo3")).collect()] == [1]
    land(spark, f"{scratch}/json/orders", '{"order_id":null}')
    run_json_streams(spark, f"{scratch}/json", wh, (VALID_ORDER_ID_DROP, warned), (VALID_TIMESTAMP_DROP,))
    seen = expectation_results(spark, wh).where("dataset = 'orders_bronze_demo3' AND rule = 'valid_order_id'")
    assert [(r.batch_id, r.rows_seen, r.violations) for r in seen.orderBy("batch_id").collect()] == [(0, 4, 2), (1, 1, 1)]


def test_declared_rules_come_from_the_conf(spark, scratch):
    import importlib
    import sys

    from pyspark.pipelines.graph_element_registry import graph_element_registration_context

    from test_declarative import Recorder

    rec = Recorder()
    sys.modules.pop("retailflow.plans.declarative", None)
    with graph_element_registration_context(rec):
        importlib.import_module("retailflow.plans.declarative")
    land(spark, f"{scratch}/json/orders", '{"order_id":1}', '{"order_id":"B"}')
    spark.conf.set("retailflow.source", scratch)
    spark.conf.set("retailflow.rules.orders_bronze_demo3", '[{"name": "id", "condition": "order_id IS NOT NULL", "action": "drop"}]')
    try:
        df = rec.flows["orders_bronze_demo3"].func()
    finally:
        spark.conf.unset("retailflow.rules.orders_bronze_demo3")
        spark.conf.unset("retailflow.source")
    run_stream_table(df, Warehouse(f"{scratch}/wh"), "t")
    assert [r.order_id for r in spark.read.parquet(Warehouse(f"{scratch}/wh").table("t")).collect()] == [1]


# ---- columns that appear later


def test_later_columns_batch_equals_stream(spark, scratch):
    path, wh = f"{scratch}/customers", Warehouse(f"{scratch}/wh")
    land(spark, path, HEADER, "1,A,B,,5,2.0,2020-01-02", '2,"A, x",B,,5,X,2020-01-02', "")
    run_customer_bronze(spark, path, wh)
    land(spark, path, "last_name,customer_id,first_name,Email,phone,geography_id,registration_date,tier", "Li,7,Ann,,1,2.0,2020-01-02,gold", "x,8")
    run_customer_bronze(spark, path, wh)
    run_customer_bronze(spark, path, wh)  # nothing new
    streamed = read_all_columns(spark, wh, "customer_bronze_v1").drop(*bronze.AUDIT_COLUMNS)
    headers = csv_headers(spark, path, wh.folder("columns"))
    raw = read_csv_by_header(spark, path, csv_columns(headers), headers, stream=False)
    batch = bronze.customer_bronze(raw, audit=False)
    assert bag(streamed.select(*batch.columns)) == bag(batch)
    rows = {r.customer_id: r for r in batch.collect()}
    assert set(rows) == {1, 2, 7, 8} and rows[2].first_name == "A, x" and rows[2].geography_id is None
    assert (rows[7].last_name, rows[7].tier, rows[7].phone, rows[1].tier) == ("Li", "gold", 1, None)


def test_a_file_without_a_known_header_fails(spark, scratch):
    path = land(spark, f"{scratch}/c", HEADER, "1,A,B,,5,2.0,2020-01-02")
    headers = csv_headers(spark, path, scratch)
    late = read_csv_by_header(spark, path, csv_columns(headers), headers, stream=False)
    assert late.count() == 1
    land(spark, path, "customer_id,tier", "9,gold")
    late = read_csv_by_header(spark, path, csv_columns(headers), headers, stream=False, corrupt_column="line")
    with pytest.raises(Exception, match="no header was taken"):
        late.collect()


def test_broken_csv_lines_keep_their_text(spark, scratch):
    path = land(spark, f"{scratch}/c", "a,b", "1,2", "3", "4,5,6")
    headers = csv_headers(spark, path, scratch)
    rows = read_csv_by_header(spark, path, csv_columns(headers), headers, stream=False, corrupt_column="line").collect()
    assert {(r.a, r.b): r.line for r in rows} == {("1", "2"): None, ("3", None): "3", ("4", "5"): "4,5,6"}


def test_header_names():
    assert header_names('a,"b, c",d') == ["a", "b, c", "d"]
    with pytest.raises(ValueError, match="repeated"):
        header_names("a,A")


def test_later_parquet_columns(spark, scratch):
    wh, one = Warehouse(f"{scratch}/wh"), spark.createDataFrame([(1, None, 2, "2024-01-01", 1, 1.0, 0.0, 0.0)], schemas.order_schema())
    one.write.parquet(f"{scratch}/orders/year_month=2024-01")
    run_orders_bronze(spark, f"{scratch}/orders", wh)
    one.withColumns({"order_id": F.lit(2).cast("long"), "channel": F.lit("web")}).write.parquet(f"{scratch}/orders/year_month=2024-02")
    _, columns = run_orders_bronze(spark, f"{scratch}/orders", wh)
    got = {r.order_id: r.channel for r in read_all_columns(spark, wh, "orders_bronze_v1").collect()}
    assert got == {1: None, 2: "web"} and "channel" in columns.names and "year_month" not in columns.names


def test_the_registry_keeps_columns_that_files_no_longer_have(spark, scratch):
    wh, declared = Warehouse(scratch), schemas.geography_schema()
    more = joined(declared, csv_columns(spark.createDataFrame([("f", "geography_id,zone")], "file string, header string")))
    assert known_columns(spark, wh, "g", declared, more).names == [*declared.names, "zone"]
    assert known_columns(spark, wh, "g", declared, declared).names == [*declared.names, "zone"]
    assert len(versions(spark, wh, "columns/g")) == 1


# ---- sources without loss


@pytest.mark.parametrize("stream", [False, True])
def test_json_records_keep_every_row_and_field(spark, scratch, stream):
    lines = ['{"order_id":"A-17","extra":{"k":[1,"x"]}}', '{"order_id":5.0,"customer_id":"12","order_timestamp":1640390400}', "{broken", "", "  ",
             '[{"order_id":1},{"order_id":2.5}]', '{"a":1,"a":2}', "7", '{"notifications":{"mail":true}}']
    land(spark, f"{scratch}/json/orders", *lines)
    df = json_orders.json_orders_bronze(files.read_json_records(spark, f"{scratch}/json", stream=stream))
    if stream:
        run_stream_table(df, Warehouse(scratch), "t")
        df = spark.read.parquet(Warehouse(scratch).table("t"))
    rows = df.select("order_id", "order_id_text", "customer_id", "order_timestamp", "notifications", F.to_json("record").alias("r"), "broken_line")
    assert bag(rows) == Counter([
        (None, "A-17", None, None, None, '{"extra":{"k":[1,"x"]},"order_id":"A-17"}', None),
        (5, "5", 12, "1640390400", None, '{"customer_id":"12","order_id":5,"order_timestamp":1640390400}', None),
        (None, None, None, None, None, None, "{broken"), (1, "1", None, None, None, '{"order_id":1}', None),
        (None, "2.5", None, None, None, '{"order_id":2.5}', None), (None, None, None, None, None, None, '{"a":1,"a":2}'),
        (None, None, None, None, None, "7", None), (None, None, None, None, '{"mail":true}', '{"notifications":{"mail":true}}', None),
    ])


def test_long_numbers_are_no_seconds(spark):
    texts = ["20220101123000", "1640390400000", "16403904000", "9" * 30, "12345678901234567890", "0"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(utc_timestamp("t").cast("string")).collect()
    assert [r[0] for r in got] == [None, "2021-12-25 00:00:00", "2489-10-26 00:00:00", None, None, "1970-01-01 00:00:00"]


def test_geography_by_header(spark, scratch):
    path = land(spark, f"{scratch}/g", "geography_id,state,country,zone,city,postal_code", "X9,Ohio,USA,z,Akron,44301", "2.0,Ohio,USA,z,Dayton", "3,Ohio,USA,z,Lima,01234")
    raw = files.read_geographies(spark, path, corrupt_column="line")
    assert raw.columns == ["geography_id", "country", "state", "city", "postal_code", "zone", "line"]
    rows = {r.geography_id: r for r in raw.collect()}
    assert rows["X9"].country == "USA" and rows["X9"].line is None and rows["2.0"].line == "2.0,Ohio,USA,z,Dayton"
    assert rows["3"].postal_code == "01234"
    assert [r.geography_id for r in bronze.geography_bronze(raw, audit=False).orderBy("city").collect()] == [None, 2, 3]
    with pytest.raises(ValueError, match="postal_code"):
        files.read_geographies(spark, land(spark, f"{scratch}/h", "geography_id,country,state,city", "1,a,b,c"))


# ---- rank and distinct counts


@pytest.mark.parametrize("ties", [(), ("k",)])
def test_ranks_carry_over_ranges(spark, scratch, ties):
    """A value that a third of all rows share spans several ranges and counts once."""
    values = [None if i % 10 == 0 else 50.0 if i % 3 == 0 else float(i * 7919 % 900) for i in range(6000)]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v double").repartition(3)
    order = sorted({v for v in values if v is not None}, reverse=True)
    want = {v: n for n, v in enumerate([*order, None], 1)}
    rows = written(in_ranges(df, "v", ties, 16), f"{scratch}/r{len(ties)}")
    spread = rows.where("v = 50").select("_range").distinct().count()
    assert spread > 3 if ties else spread == 1
    got = ranked(rows, "v", "rank")
    assert all(r["rank"] == want[r.v] for r in got.collect()) and got.count() == 6000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_bitmap_counts_equal_count_distinct(spark):
    n, i = 5000, F.col("id")
    df = spark.range(n).select(
        F.when(i % 7 == 0, None).otherwise(i % 5).alias("g"), (i % 2 == 0).alias("h"),
        F.when(i % 11 == 0, None).otherwise((i * 7919 % 100_003 - 50_000)).alias("a"), F.when(i % 5 == 3, None).otherwise(i % 40_000 * 1_000_003).alias("b"),
    )
    want = df.groupBy("g", "h").agg(F.count("*").alias("n"), F.count_distinct("a").alias("x"), F.count_distinct("b").alias("y"))
    got = agg_with_distinct(df, ("g", "h"), [F.count("*").alias("n")], {"x": "a", "y": "b"})
    assert bag(got.select(*want.columns)) == bag(want)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_gold_tables_by_bitmaps(spark):
    from retailflow.plans.queries import enriched_of

    enriched = enriched_of(spark, "/root/testdata/sf0.001")
    for fn in (gold.sales_by_date, gold.sales_by_category, gold.monthly_sales_trend):
        plain, maps = fn(enriched, sort=False), fn(enriched, sort=False, bitmaps=True)
        assert maps.columns == plain.columns and bag(maps) == bag(plain)
        assert "Expand" not in maps._jdf.queryExecution().executedPlan().toString()


def test_dense_ids(spark):
    ids = spark.range(100_000).select("id", (F.col("id") * 1000).alias("sparse"), F.lit(None).cast("long").alias("none"))
    assert dense(ids, "id") and not dense(ids, "id", "sparse") and not dense(ids, "none") and not dense(ids.limit(0), "id")


def test_distinct_ids_of_many_groups_are_counted_without_bitmaps(spark):
    """Days and ids so many that nearly every row has a day and range of ids of its own."""
    from retailflow.operators.distinct import agg_with_distinct, value_counts

    rows = [(i % 400 if i % 9 else None, (i * 7919) % 3_000_000 - 500 if i % 11 else None, f"t{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "day int, id long, text string")
    got = agg_with_distinct(df, ("day",), [F.count("*").alias("n")], {"ids": "id", "texts": "text"}, value_counts)
    want = df.groupBy("day").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("text").alias("texts"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap" not in plan and "Expand" not in plan


def test_the_gold_layer_counts_no_bitmaps(spark, scratch, monkeypatch):
    """Ids dense in the table, few to a day: bitmaps would be a day's and a range's each."""
    from datetime import date, timedelta
    from decimal import Decimal

    from retailflow.operators import distinct, gold
    from retailflow.plans.pipeline import run_gold
    from retailflow.streaming.runner import Warehouse, refresh_table

    monkeypatch.setattr(distinct, "bitmap_counts", lambda *a: pytest.fail("bitmaps"))
    money, columns = "decimal(18,2)", "order_id long, order_date date, customer_id long, product_id long, quantity long"
    schema = f"{columns}, unit_price {money}, discount {money}, shipping_cost {money}, product_name string, category string, price {money}, cost {money}, full_name string, country string, state string, city string"
    d = Decimal("1.25")
    rows = [
        (i, date(2020, 1, 1) + timedelta(i % 50), i % 1500, i % 1400, 2, d, Decimal(0), d, f"p{i % 1400}", f"c{i % 3}", d, Decimal(1), f"n{i % 1500}", "a", "b", None)
        for i in range(3000)
    ]
    wh = Warehouse(f"{scratch}/warehouse")
    refresh_table(spark.createDataFrame(rows, schema), wh, "orders_silver")
    run_gold(spark, wh, as_of=date(2021, 1, 1))
    enriched = spark.read.parquet(wh.table("gold_orders_enriched"))
    for name in ("sales_by_date", "sales_by_geography", "monthly_sales_trend", "sales_by_category"):
        want = gold.GOLD_TABLES[name](enriched, sort=False)
        assert sorted(map(str, spark.read.parquet(wh.table(name)).collect())) == sorted(map(str, want.collect()))


def test_a_batch_is_written_where_it_is(spark, scratch):
    """No shuffle before a write: a file for each part of the batch."""
    from retailflow.streaming.runner import Warehouse, write_batch

    wh = Warehouse(f"{scratch}/warehouse")
    write_batch(spark.range(0, 3000, 1, 3), wh, "numbers", 0)
    back = spark.read.parquet(f"{wh.kept('numbers')}/_batch=0")
    assert back.count() == 3000 and len(back.inputFiles()) == 3


def test_customers_may_be_joined_before_products(spark):
    from retailflow.plans.queries import orders_silver_of

    first, last = (orders_silver_of(spark, "/root/testdata/sf0.001", products_last=x) for x in (False, True))
    assert first.columns == last.columns and sorted(map(str, first.collect())) == sorted(map(str, last.collect()))


# ---- bytes on disk of a whole run


ODD_ORDERS = """order_id long, order_date date, customer_id long, product_id long, quantity long, unit_price decimal(18,2), discount decimal(18,2),
    shipping_cost decimal(18,2), product_name string, category string, price decimal(18,2), cost decimal(18,2), full_name string, country string,
    state string, city string"""


def odd_enriched(spark):
    """A customer with a third of all rows, ids with two names, products in two categories, NULL ids, places and costs."""
    from datetime import date, timedelta
    from decimal import Decimal

    def row(i):
        customer = None if i % 17 == 0 else 7 if i % 3 == 0 else i * 7919 % 400
        product = None if i % 23 == 0 else 5 if i % 4 == 0 else i * 31 % 300
        place = (None, None, None) if i % 11 == 0 else (f"k{(customer or 0) % 2}", "s", None)
        return (
            None if i % 13 == 0 else i, date(2020, 1, 1) + timedelta(i % 90), customer, product, i % 7 - 1, Decimal(i % 500) / 100, Decimal(i % 5) / 10,
            Decimal(1), None if product is None else f"p{product % 9}", None if i % 29 == 0 else f"c{(product or 0) % 4 + i % 2}", Decimal(2),
            None if i % 19 == 0 else Decimal(i % 300) / 100, f"n{(customer or 0) % 10}{'x' if i % 50 == 0 else ''}", *place,
        )

    return gold.orders_enriched(spark.createDataFrame([row(i) for i in range(5000)], ODD_ORDERS))


def test_customers_and_products_are_shuffled_by_ranges(spark, scratch):
    from datetime import date

    refresh_table(odd_enriched(spark), Warehouse(scratch), "e")
    enriched = spark.read.parquet(Warehouse(scratch).table("e"))
    for fn in (lambda **k: gold.customer_analytics(enriched, date(2021, 1, 1), sort=False, **k), lambda **k: gold.product_sales(enriched, **k)):
        plain, ranged = fn(), fn(stored=True)
        assert ranged.schema == plain.schema and bag(ranged) == bag(plain) and sum(bag(plain).values()) > 300
        plan = fn(stored=True)._jdf.queryExecution().executedPlan().toString()  # as it is before it runs
        assert "Expand" not in plan and plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning") == 1  # of products, after their rows were added up in the ranges


def test_the_gold_layer_does_not_expand_customers(spark, scratch, monkeypatch):
    from retailflow.plans import pipeline

    plans = {}

    def kept(df, wh, name, cluster_by=()):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return refresh_table(df, wh, name, cluster_by)

    monkeypatch.setattr(pipeline, "refresh_table", kept)
    wh = Warehouse(scratch)
    refresh_table(odd_enriched(spark).select(*(f.strip().split(" ")[0] for f in ODD_ORDERS.replace("(18,2)", "").split(","))), wh, "orders_silver")
    pipeline.run_gold(spark, wh)
    assert set(plans) == {"gold_orders_enriched", *gold.GOLD_TABLES} and not [n for n, p in plans.items() if "Expand" in p]


def test_shuffle_files_go_with_their_job(spark, scratch):
    import time

    from retailflow.config import FREE_SHUFFLES, freed_shuffles

    def shuffles():
        files_ = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files_.size()) if (n := files_.apply(i).getName()).startswith("shuffle_")}

    def gone(before):
        end = time.time() + 20  # executors are told, not waited for
        while shuffles() - before and time.time() < end:
            time.sleep(0.2)
        return not shuffles() - before

    spark.range(0, 2000, 1, 4).selectExpr("id", "id % 7 AS k").write.parquet(f"{scratch}/src")
    src, wh, was = spark.read.parquet(f"{scratch}/src"), Warehouse(f"{scratch}/wh"), spark.conf.get(FREE_SHUFFLES, None)
    before = shuffles()
    by_k = src.groupBy("k").agg(F.count("*").alias("n"))
    with freed_shuffles(spark):
        refresh_table(by_k, wh, "n", cluster_by=("n",))
        stream = spark.readStream.schema(src.schema).parquet(f"{scratch}/src")
        run_stream_table(stream.join(src.selectExpr("id", "k AS j").hint("merge"), "id", "left"), wh, "joined")
    assert gone(before) and spark.conf.get(FREE_SHUFFLES, None) == was
    assert spark.read.parquet(wh.table("n")).count() == 7 and spark.read.parquet(wh.table("joined")).count() == 2000


def test_tables_are_stored_with_zstd(spark, scratch):
    from retailflow.sources.landing import write_by_category

    wh, rows = Warehouse(scratch), spark.range(9).selectExpr("id", "'a' AS category")
    refresh_table(rows, wh, "t")
    write_batch(rows, wh, "b", 0)
    write_batch(rows, wh, "r", 0, (Expectation("small", "id < 4", "drop"),))
    write_by_category(rows, f"{scratch}/products")
    for path in (wh.table("t"), f"{wh.kept('b')}/_batch=0", f"{wh.kept('r')}/_batch=0", f"{scratch}/products"):
        found = spark.read.parquet(path).inputFiles()
        assert found and all(f.endswith(".zstd.parquet") for f in found)


def test_steps_run_a_few_at_a_time(spark):
    import threading
    import time

    running, most, lock = [], [], threading.Lock()

    def step(n):
        def run():
            with lock:
                running.append(n)
                most.append(len(running))
            time.sleep(0.05)
            with lock:
                running.remove(n)
            return n

        return run

    assert runner.run_concurrently(*map(step, range(7)), at_once=3) == list(range(7)) and max(most) == 3
