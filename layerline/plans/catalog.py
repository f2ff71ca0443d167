"""Every operator as a query over the star-schema tables, each with its SQL equivalent.

A query takes (spark, folder of parquet tables). Its SQL says the same in plain relational
terms over views of those tables, written independently of the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerline.functions.checkdigit import is_valid_access_key, is_valid_cnpj, with_cnpj
from layerline.functions.dates import calendar, calendar_columns, date_key, year_month
from layerline.functions.hashing import change_hash
from layerline.functions.text import by_prefix, digits_only
from layerline.operators.asof import Take, as_of_join, interval_join
from layerline.operators.bitemporal import Bitemporal, as_known, empty_history, record
from layerline.operators.clean import duplicate_keys
from layerline.operators.contracts import conform, conform_nested, nested_findings, observed_types
from layerline.operators.diff import diff_counts, keyed_diff
from layerline.operators.digest import reconcile_rows
from layerline.operators.incremental import MaintainedAggregate
from layerline.operators.merge import ACTION, merge_counts, merge_frames
from layerline.operators.metrics import merged_metrics, rule_sketches
from layerline.operators.quality import (
    Expectation,
    RuleSet,
    mark_reprocessed,
    passing_rows,
    quarantine_rows,
    rejected_rows,
    rule_metrics,
    summary,
)
from layerline.operators.scale import lean_disk, materialize, scratch_dir
from layerline.operators.scd2 import full_history, history_from_facts, initial_load, scd2_merge
from layerline.plans.checks import invariants, reconcile
from layerline.plans.control import BatchControl
from layerline.plans.gold import cfop_dimension, revenue_by, revenue_measures, tax_burden_by
from layerline.plans.medallion import run_medallion
from layerline.plans.stand_in import (
    ISSUER,
    ITEM_GRAIN,
    MONEY,
    PRODUCT,
    Tables,
    issuer_changes,
    item_cfop,
    latest_items,
    orders_with_status,
    raw_sources,
    stretched,
    tables,
    with_order_key,
)
from layerline.sources.readers import (
    cdc_rows,
    checked_payload,
    parse_payload,
    plan_splits,
    run_report,
    split_payload,
    with_audit,
)
from layerline.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function over the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(tables(spark, folder))

        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = dedent(sql).strip()
        return run

    return register


def _store(t: Tables, label: str) -> TableStore:
    return TableStore(t.spark, scratch_dir(t.spark, label))


def _until(column: str = "valid_to"):
    """Open ends as null, since not every client can hold the year 9999."""
    return F.when(~F.col("is_current"), F.col(column)).alias("valid_to")


# -- SQL building blocks --------------------------------------------------------------------

ITEMS = """items AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC
    ) AS rn FROM lineitem) WHERE rn = 1)"""

HEADERS = """cancelled AS (
  SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS dh_cancelamento
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1),
headers AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
    c.dh_cancelamento, c.dh_cancelamento IS NOT NULL AS is_cancelada,
    CASE WHEN c.dh_cancelamento IS NOT NULL THEN 'CANCELADA' ELSE o.o_orderstatus END AS o_orderstatus
  FROM orders o LEFT JOIN cancelled c ON c.o_orderkey = o.o_orderkey)"""

CHANGES = """changes AS (
  SELECT user_id, event_type, ts, event_id,
    CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op
  FROM events)"""

VERSIONS = """changed AS (
  SELECT * FROM (
    SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
    FROM changes) WHERE before IS NULL OR before <> event_type),
versions AS (
  SELECT user_id, event_type, ts AS valid_from,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM changed)"""

SPLIT = "TIMESTAMP '2024-01-15'"


# -- sources and clean-up -------------------------------------------------------------------


@query(f"WITH {ITEMS} SELECT *, 'b1' AS _batch_id FROM items")
def q01_dedup_latest(t: Tables) -> DataFrame:
    """Latest row per key, with an audit column."""
    return with_audit(latest_items(t.lineitem), "b1").drop("_ingest_ts")


@query("SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1")
def q02_json_payload(t: Tables) -> DataFrame:
    """S3: JSON text to typed rows."""
    rows = parse_payload(t.events, "props", T.StructType.fromDDL("k int"))
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH planted AS (
      SELECT event_id, CASE event_id % 20
        WHEN 1 THEN left(props, length(props) - 1) WHEN 2 THEN '{"k": "many"}' WHEN 3 THEN NULL WHEN 4 THEN '  '
        WHEN 5 THEN '[' || props || ']' WHEN 6 THEN '{"k": null, "other": [1]}' WHEN 7 THEN '{}' WHEN 8 THEN '17'
        ELSE props END AS props FROM events)
    SELECT event_id, props AS payload, CASE
        WHEN props IS NULL OR trim(props) = '' THEN 'missing'
        WHEN NOT json_valid(props) THEN 'not json'
        WHEN json_type(props) <> 'OBJECT' THEN 'not an object'
        WHEN json_type(props, '$.k') NOT IN ('NULL', 'BIGINT', 'UBIGINT') THEN 'wrong type' END AS problem,
      CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' AND json_type(props, '$.k') IN ('BIGINT', 'UBIGINT')
        THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
    FROM planted""")
def q02_malformed_payload(t: Tables) -> DataFrame:
    """Texts that do not parse are told apart with their reason; good and rejected are all there are."""
    kind = F.col("event_id") % 20
    planted = (
        F.when(kind == 1, F.expr("left(props, length(props) - 1)"))
        .when(kind == 2, '{"k": "many"}')
        .when(kind == 3, F.lit(None))
        .when(kind == 4, "  ")
        .when(kind == 5, F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == 6, '{"k": null, "other": [1]}')
        .when(kind == 7, "{}")
        .when(kind == 8, "17")
        .otherwise(F.col("props"))
    )
    events = t.events.select("event_id", planted.alias("props"))
    checked = checked_payload(events, "props", T.StructType.fromDDL("k int"), carry=["event_id"])
    good, bad = split_payload(checked, carry=["event_id"])
    accepted = good.select("event_id", F.col("_payload").alias("payload"), F.lit(None).cast("string").alias("problem"), "k")
    return accepted.unionByName(bad.select("event_id", F.col("_payload").alias("payload"), F.col("_problem").alias("problem"), F.lit(None).cast("int").alias("k")))


@query("""
    SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n
    FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def q02_change_log(t: Tables) -> DataFrame:
    """One table's rows out of a shared change log."""
    rows = cdc_rows(
        t.events,
        "purchase",
        T.StructType.fromDDL("k int"),
        table_column="event_type",
        payload_column="props",
    )
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT count(*) AS n, count(*) AS n_covered_once, 24::BIGINT AS n_parts, TRUE AS even FROM lineitem""")
def q33_split_plan(t: Tables) -> DataFrame:
    """Predicates that read a skewed table in parts of equal size, each row once.

    A third of all rows share one key, and some have none; part sizes stay within a fifth of the mean.
    """
    key = F.when(F.col("l_orderkey") % 3 == 0, 7).when(F.col("l_orderkey") % 50 != 1, F.col("l_orderkey"))
    rows = t.lineitem.select(key.alias("k"), F.col("l_partkey").alias("second"))
    predicates = plan_splits(rows, "k", 24, second="second")
    counted = rows.agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(predicates))
    )
    hits = F.array(*(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates))
    once = rows.agg(F.count_if(F.aggregate(hits, F.lit(0), lambda s, x: s + x) == 1).alias("n_covered_once"))
    sizes = F.array(*(f"p{i}" for i in range(len(predicates))))
    mean = F.col("n") / len(predicates)
    even = F.forall(sizes, lambda size: F.abs(size - mean) <= 0.2 * mean)
    # Two rows of one each.
    return counted.crossJoin(once).select(
        "n", "n_covered_once", F.lit(len(predicates)).cast("long").alias("n_parts"), even.alias("even")
    )


@query("""
    SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS c_name,
      regexp_replace(c_mktsegment, '[^0-9]', '', 'g') AS c_mktsegment FROM customer""")
def q03_digits_only(t: Tables) -> DataFrame:
    """P1."""
    chosen = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return digits_only(chosen, "c_name", "c_mktsegment")


@query("""
    SELECT p_partkey, CASE WHEN p_type LIKE 'ECO%' THEN 'ELETRONICOS'
      WHEN p_type LIKE 'ST%' THEN 'MOVEIS' WHEN p_type LIKE 'PRO%' THEN 'VESTUARIO'
      ELSE 'UTILIDADES' END AS family FROM part""")
def q03_prefix_family(t: Tables) -> DataFrame:
    """P2."""
    labels = {"ECO": "ELETRONICOS", "ST": "MOVEIS", "PRO": "VESTUARIO"}
    return t.part.select("p_partkey", by_prefix("p_type", labels, "UTILIDADES").alias("family"))


# -- data quality ---------------------------------------------------------------------------


def _order_rules() -> RuleSet:
    return RuleSet(
        Expectation("priority_known", F.col("o_orderpriority") != "4-NOT SPECIFIED", "drop"),
        Expectation("total_floor", F.col("o_totalprice") >= 5000, "drop"),
        Expectation("not_pending", F.col("o_orderstatus") != "P", "warn"),
    )


@query("""
    SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'WARN' ELSE 'PASS' END AS _dq_status
    FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' AND o_totalprice >= 5000""")
def q04_passing_rows(t: Tables) -> DataFrame:
    """Rows that break no drop rule, with their status."""
    return passing_rows(t.orders, _order_rules())


def _quarantined(t: Tables) -> DataFrame:
    # Money and time as text of one form, so that the whole row has one JSON form.
    exact = {
        "o_totalprice": F.col("o_totalprice").cast(MONEY).cast("string"),
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    }
    rejected = rejected_rows(t.orders, _order_rules()).withColumns(exact)
    key = F.concat_ws(":", "o_orderkey", "o_custkey")
    return quarantine_rows(rejected, source_table="orders", natural_key=key, batch_id="b1")


REJECTED = """rejected AS (
  SELECT *, '[' || concat_ws(',',
      CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '"priority_known"' END,
      CASE WHEN o_totalprice < 5000 THEN '"total_floor"' END) || ']' AS failed_expectations,
    concat_ws(':', o_orderkey, o_custkey) AS natural_key
  FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' OR o_totalprice < 5000),
quarantine AS (
  SELECT natural_key, failed_expectations, 'orders' AS source_table, 'b1' AS batch_id, o_orderstatus,
    '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
      || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":"' || CAST(o_totalprice AS DECIMAL(18,2))
      || '","o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      || '","o_orderpriority":"' || o_orderpriority
      || '","_failed_expectations":' || failed_expectations || '}' AS row_payload_json
  FROM rejected)"""


@query(f"""
    WITH {REJECTED}
    SELECT sha256(concat_ws('␟', source_table, natural_key, batch_id, row_payload_json)) AS quarantine_id,
      source_table, natural_key, failed_expectations, row_payload_json,
      FALSE AS is_reprocessed, batch_id FROM quarantine""")
def q05_quarantine(t: Tables) -> DataFrame:
    """Rejected rows with failed rules and the whole row as JSON."""
    return _quarantined(t).drop("_quarantined_ts")


@query("""
    SELECT name, severity, n AS rows_evaluated, n - f AS rows_passed, f AS rows_failed,
      CAST(n - f AS DOUBLE) / n AS pass_rate
    FROM (
      SELECT 'priority_known' AS name, 'drop' AS severity, count(*) AS n,
        count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS f FROM orders
      UNION ALL SELECT 'total_floor', 'drop', count(*), count(*) FILTER (o_totalprice < 5000) FROM orders
      UNION ALL SELECT 'not_pending', 'warn', count(*), count(*) FILTER (o_orderstatus = 'P') FROM orders)""")
def q06_rule_metrics(t: Tables) -> DataFrame:
    """One row per rule, all counted in one pass."""
    return rule_metrics(t.orders, _order_rules())


@query("""
    SELECT count(*) AS rows_evaluated, f AS rows_failed, 1 - CAST(f AS DOUBLE) / count(*) AS pass_rate
    FROM orders, (SELECT count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED')
      + count(*) FILTER (o_totalprice < 5000) AS f FROM orders) GROUP BY f""")
def q06_quality_summary(t: Tables) -> DataFrame:
    """D7."""
    return summary(rule_metrics(t.orders, _order_rules()))


@query(f"""
    WITH {REJECTED}
    SELECT failed_expectations, o_orderstatus = 'P' AS is_reprocessed, count(*) AS n
    FROM quarantine GROUP BY 1, 2""")
def q07_mark_reprocessed(t: Tables) -> DataFrame:
    """K5, P10: flag quarantined rows by natural key."""
    pending = t.orders.filter("o_orderstatus = 'P'")
    keys = pending.select(F.concat_ws(":", "o_orderkey", "o_custkey").alias("natural_key"))
    marked = mark_reprocessed(_quarantined(t), keys, "b1")
    return marked.groupBy("failed_expectations", "is_reprocessed").agg(F.count(F.lit(1)).alias("n"))


# -- control --------------------------------------------------------------------------------


@query("""
    SELECT 'b1' AS batch_id, 'bronze' AS stage, 'orders' AS target_table, count(*) AS rows_written,
      TRUE AS applied FROM orders
    UNION ALL SELECT 'b1', 'bronze', 'lineitem', count(*), TRUE FROM lineitem
    UNION ALL SELECT 'b1', 'bronze', 'events', count(*), TRUE FROM events""")
def q08_batch_ledger(t: Tables) -> DataFrame:
    """Ledger rows, and whether each batch is known as applied."""
    control = BatchControl(_store(t, "ledger"))
    rows = {n: getattr(t, n).count() for n in ("orders", "lineitem", "events")}
    control.register_batch(batch_id="b1", stage="bronze", rows=rows)
    applied = F.lit(False)
    for name in rows:
        known = control.is_batch_applied(batch_id="b1", stage="bronze", target_table=name)
        applied = applied | ((F.col("target_table") == name) & F.lit(known))
    columns = ("batch_id", "stage", "target_table", "rows_written")
    return control.batches().select(*columns, applied.alias("applied"))


@query(f"""
    WITH mark AS (SELECT max(event_id) AS m FROM events WHERE ts < {SPLIT})
    SELECT event_id, user_id, event_type, -1::BIGINT AS mark_before, m AS mark_at,
      (SELECT max(event_id) FROM events) AS mark_after FROM events, mark WHERE event_id > m""")
def q28_watermark(t: Tables) -> DataFrame:
    """Only rows past the stored watermark, which then moves on."""
    control = BatchControl(_store(t, "watermark"))
    before = control.read_watermark("events")
    early = t.events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    control.write_watermark("events", early.agg(F.max("event_id")).first()[0])
    at = control.read_watermark("events")
    batch = control.new_rows(t.events, "events", "event_id")
    newest = batch.agg(F.max("event_id")).first()[0]
    if newest is not None:
        control.write_watermark("events", newest)
    return batch.select(
        "event_id",
        "user_id",
        "event_type",
        F.lit(before).cast("bigint").alias("mark_before"),
        F.lit(at).cast("bigint").alias("mark_at"),
        F.lit(control.read_watermark("events")).cast("bigint").alias("mark_after"),
    )


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def q08_append(t: Tables) -> DataFrame:
    """K1: two batches appended, the second with a column the first did not have."""
    table = _store(t, "append").table("bronze", "orders")
    recent = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    early = t.orders.filter(~recent).drop("o_orderpriority")
    later = t.orders.filter(recent)
    table.append(early, batch_id="b1", stage="bronze")
    table.append(later, batch_id="b2", stage="bronze", merge_schema=True)
    return table.read()


# -- joins, merges --------------------------------------------------------------------------


@query("SELECT c_custkey, c_nationkey FROM customer")
def q10_merge_into_empty(t: Tables) -> DataFrame:
    """K3, L4: an upsert into a stored table that exists and is empty, twice."""
    table = _store(t, "empty").table("silver", "customers")
    customers = t.customer.select("c_custkey", "c_nationkey")
    table.overwrite(customers.limit(0), batch_id="b0", stage="create")
    for batch in ("b1", "b2"):
        table.merge(customers, keys=["c_custkey"], order_by=["c_nationkey"], batch_id=batch, stage="merge")
    return table.read()


@query(f"""
    WITH {HEADERS}
    SELECT o_orderkey, o_orderstatus, is_cancelada, dh_cancelamento FROM headers""")
def q09_cancellations(t: Tables) -> DataFrame:
    """Headers with their last cancellation."""
    return orders_with_status(t.orders, t.lineitem).select(
        "o_orderkey", "o_orderstatus", "is_cancelada", "dh_cancelamento"
    )


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Target: orders as loaded before 2000. Source: all orders, cancelled ones with status X."""
    loaded = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    flagged = orders_with_status(t.orders, t.lineitem)
    status = F.when(F.col("is_cancelada"), "X").otherwise(F.col("o_orderstatus"))
    source = flagged.withColumn("o_orderstatus", status).select(*t.orders.columns)
    return t.orders.filter(loaded), source


MERGED = f"""{HEADERS},
merged AS (
  SELECT o.o_orderkey, o.o_custkey,
    CASE WHEN h.is_cancelada THEN 'X' ELSE o.o_orderstatus END AS o_orderstatus,
    o.o_totalprice, o.o_orderdate, o.o_orderpriority,
    CASE WHEN o.o_orderdate >= TIMESTAMP '2000-01-01' THEN 'insert'
      WHEN h.is_cancelada AND o.o_orderstatus <> 'X' THEN 'update'
      ELSE 'keep' END AS _action
  FROM orders o JOIN headers h ON h.o_orderkey = o.o_orderkey)"""


@query(f"WITH {MERGED} SELECT * FROM merged")
def q10_merge(t: Tables) -> DataFrame:
    """Null-safe upsert."""
    return merge_frames(*_merge_sides(t), ["o_orderkey"], order_by=["o_orderdate"])


@query(f"""
    WITH {MERGED}
    SELECT count(*) FILTER (_action = 'insert') AS rows_inserted,
      count(*) FILTER (_action = 'update') AS rows_updated,
      count(*) FILTER (_action = 'keep') AS rows_kept FROM merged""")
def q11_merge_counts(t: Tables) -> DataFrame:
    """K4."""
    return merge_counts(merge_frames(*_merge_sides(t), ["o_orderkey"]))


@query("SELECT 0::BIGINT AS rows_inserted, 0::BIGINT AS rows_updated, count(*) AS rows_kept FROM orders")
def q12_merge_again(t: Tables) -> DataFrame:
    """K3: the same source a second time changes nothing."""
    target, source = _merge_sides(t)
    once = merge_frames(target, source, ["o_orderkey"]).drop(ACTION)
    return merge_counts(merge_frames(once, source, ["o_orderkey"]))


@query(f"WITH {MERGED} SELECT * EXCLUDE (_action) FROM merged")
def q10_stored_merge(t: Tables) -> DataFrame:
    """The upsert on a stored table; only changed rows and their folders are written."""
    target, source = _merge_sides(t)
    table = _store(t, "merge").table("silver", "orders")
    table.overwrite(target, batch_id="b1", stage="load")
    table.merge(
        source, keys=["o_orderkey"], order_by=["o_orderdate"], batch_id="b2", stage="merge"
    )
    return table.read()


@query(f"""
    WITH {MERGED}
    SELECT o_orderkey, CASE _action WHEN 'insert' THEN 'added' ELSE 'changed' END AS _change
    FROM merged WHERE _action <> 'keep'""")
def q25_keyed_diff(t: Tables) -> DataFrame:
    """K7 by key."""
    target, source = _merge_sides(t)
    after = merge_frames(target, source, ["o_orderkey"]).drop(ACTION)
    return keyed_diff(target, after, ["o_orderkey"])


ALTERED = f"""{ITEMS},
    altered AS (
      SELECT * REPLACE (
        CASE WHEN l_orderkey % 701 = 1 THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice,
        CASE WHEN l_orderkey % 701 = 2 THEN NULL ELSE l_shipdate END AS l_shipdate)
      FROM items WHERE l_orderkey % 701 <> 3
      UNION ALL SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM items WHERE l_orderkey % 701 = 4)"""


@query(f"""
    WITH {ALTERED}
    SELECT 'item' AS entity,
      coalesce(i.l_orderkey, a.l_orderkey)::VARCHAR || ':' || coalesce(i.l_linenumber, a.l_linenumber)::VARCHAR AS natural_key,
      CASE WHEN i.l_orderkey IS NULL THEN 'added' WHEN a.l_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM items i FULL JOIN altered a ON a.l_orderkey = i.l_orderkey AND a.l_linenumber = i.l_linenumber
    WHERE i.l_orderkey IS NULL OR a.l_orderkey IS NULL OR i.l_extendedprice <> a.l_extendedprice
      OR i.l_shipdate IS DISTINCT FROM a.l_shipdate""")
def q22_digest_reconciliation(t: Tables) -> DataFrame:
    """Keys that two layers hold differently, by digests that descend where they differ."""
    items = materialize(latest_items(t.lineitem), "items")
    kind = F.col("l_orderkey") % 701
    altered = items.where(kind != 3).withColumns(
        {
            "l_extendedprice": F.when(kind == 1, F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice")),
            "l_shipdate": F.when(kind != 2, F.col("l_shipdate")),
        }
    )
    altered = altered.unionByName(items.where(kind == 4).withColumn("l_orderkey", -F.col("l_orderkey")))
    return reconcile_rows({"item": (items, altered, ["l_orderkey", "l_linenumber"])})


# -- slowly changing dimensions -------------------------------------------------------------


@query("""
    SELECT s_suppkey, sha256(coalesce(s_name, '∅') || '␟' || coalesce(CAST(s_nationkey AS VARCHAR), '∅')
      || '␟' || coalesce(CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR), '∅')) AS scd_hash FROM supplier""")
def q13_change_hash(t: Tables) -> DataFrame:
    """Over all attributes, money as decimal."""
    exact = t.supplier.withColumn("s_acctbal", F.col("s_acctbal").cast(MONEY))
    return exact.select("s_suppkey", change_hash(["s_name", "s_nationkey", "s_acctbal"]).alias("scd_hash"))


LATEST_TWO = f"""{CHANGES},
ranked AS (
  SELECT *, ts < {SPLIT} AS early, row_number() OVER (
    PARTITION BY user_id, ts < {SPLIT} ORDER BY ts DESC, event_id DESC) AS rn FROM changes),
b1 AS (SELECT * FROM ranked WHERE early AND rn = 1),
b2 AS (SELECT * FROM ranked WHERE NOT early AND rn = 1)"""


@query(f"""
    WITH {LATEST_TWO},
    hits AS (
      SELECT b2.*, b1.user_id IS NULL AS is_new FROM b2 LEFT JOIN b1 ON b1.user_id = b2.user_id
      WHERE b1.user_id IS NULL OR b2.op = 'D' OR b2.event_type <> b1.event_type)
    SELECT b1.user_id, b1.event_type, b1.ts AS valid_from, h.ts AS valid_to, h.ts IS NULL AS is_current,
      CASE WHEN h.ts IS NULL THEN 'keep' ELSE 'close' END AS _action
    FROM b1 LEFT JOIN hits h ON h.user_id = b1.user_id
    UNION ALL SELECT user_id, event_type, ts, NULL, TRUE,
      CASE WHEN is_new THEN 'start' ELSE 'open' END FROM hits""")
def q14_scd2_merge(t: Tables) -> DataFrame:
    """A second batch of changes against a loaded dimension."""
    changes = issuer_changes(t.events)
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    names = {"change_ts": "ts", "tie_break": "event_id"}
    dim = initial_load(changes.filter(F.col("ts") < split), ISSUER, **names)
    merged = scd2_merge(dim, changes.filter(F.col("ts") >= split), ISSUER, **names)
    return merged.select("user_id", "event_type", "valid_from", _until(), "is_current", ACTION)


@query(f"""
    WITH {CHANGES},
    late AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM changes WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12') WHERE rn = 1),
    kept AS (SELECT * FROM changes WHERE NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12')),
    {VERSIONS.replace("FROM changes)", "FROM kept)")},
    split_at AS (
      SELECT v.*, l.ts AS cut_at, l.event_type AS new_type FROM versions v LEFT JOIN late l
        ON l.user_id = v.user_id AND v.valid_from < l.ts AND (v.valid_to IS NULL OR l.ts < v.valid_to)
        AND (l.op = 'D' OR l.event_type <> v.event_type)),
    firsts AS (SELECT user_id, min(valid_from) AS valid_from FROM versions GROUP BY 1)
    SELECT user_id, event_type, valid_from, coalesce(cut_at, valid_to) AS valid_to FROM split_at
    UNION ALL SELECT user_id, new_type, cut_at, valid_to FROM split_at WHERE cut_at IS NOT NULL
    UNION ALL SELECT l.user_id, l.event_type, l.ts, f.valid_from FROM late l
      LEFT JOIN firsts f ON f.user_id = l.user_id WHERE f.user_id IS NULL OR l.ts < f.valid_from""")
def q14_late_changes(t: Tables) -> DataFrame:
    """Changes older than a key's current version land inside its history."""
    changes = issuer_changes(t.events)
    day = F.col("ts").cast("date")
    late = day.between("2024-01-10", "2024-01-11")
    names = {"change_ts": "ts", "tie_break": "event_id"}
    dim = full_history(changes.filter(~late), ISSUER, **names)
    merged = scd2_merge(dim, changes.filter(late), ISSUER, **names)
    return merged.select("user_id", "event_type", "valid_from", _until())


def _history(t: Tables) -> DataFrame:
    return full_history(
        issuer_changes(t.events), ISSUER, change_ts="ts", tie_break="event_id"
    )


@query(f"""
    WITH {CHANGES}, {VERSIONS}
    SELECT user_id, event_type, valid_from, valid_to, valid_to IS NULL AS is_current FROM versions""")
def q15_full_history(t: Tables) -> DataFrame:
    """Every version a key ever had."""
    return _history(t).select("user_id", "event_type", "valid_from", _until(), "is_current")


def _issuer_dim(t: Tables) -> DataFrame:
    """The dimension as a stored table."""
    return materialize(
        _history(t).select(
            "user_id", "event_type", "valid_from", "valid_to", "is_current", "sk_emitente"
        ),
        "dim",
    )


@query(f"""
    WITH {CHANGES}, {VERSIONS}
    , facts AS (
      SELECT event_id, user_id, ts FROM events
      UNION ALL SELECT -event_id, user_id, ts - INTERVAL 1 DAY FROM events
      UNION ALL SELECT c_custkey + 1000000000, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END,
        TIMESTAMP '2024-01-10' FROM customer)
    SELECT e.event_id, e.user_id, e.ts, v.event_type AS version_type, v.valid_from AS version_from,
      v.user_id IS NOT NULL AS known
    FROM facts e LEFT JOIN versions v ON v.user_id = e.user_id
      AND v.valid_from <= e.ts AND (v.valid_to IS NULL OR e.ts < v.valid_to)""")
def q16_as_of_join(t: Tables) -> DataFrame:
    """Facts with the version valid at their time, the unknown member where none is.

    The facts are the events, the same a day earlier, and customers: some before any version, some
    with an unknown key or none.
    """
    dim = _issuer_dim(t)
    events = t.events.select("event_id", "user_id", "ts")
    earlier = events.select(-F.col("event_id"), "user_id", F.col("ts") - F.expr("INTERVAL 1 DAY"))
    strangers = t.customer.select(
        F.col("c_custkey") + 1_000_000_000,
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")),
        F.lit("2024-01-10").cast("timestamp_ntz"),
    )
    found = as_of_join(
        events.unionAll(earlier).unionAll(strangers),
        dim,
        on={"user_id": "user_id"},
        event_ts="ts",
        take={
            "version_type": Take("event_type"),
            "version_from": Take("valid_from"),
            "sk_emitente": Take("sk_emitente", ISSUER.unknown_member_sk),
        },
        grain=["event_id"],
    )
    return found.withColumn("known", F.col("sk_emitente") != -1).drop("sk_emitente")


@query(f"""
    WITH {LATEST_TWO}, unioned AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2)
    SELECT e.event_id, v.event_type AS version_type FROM events e
    LEFT JOIN unioned v ON v.user_id = e.user_id AND v.ts <= e.ts""")
def q16_interval_join(t: Tables) -> DataFrame:
    """J3 with versions that overlap: the fact row is repeated, once per valid version.

    By dyadic ranges also on small tables, where versions would be broadcast.
    """
    changes = issuer_changes(t.events)
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    names = {"change_ts": "ts", "tie_break": "event_id"}
    early = initial_load(changes.filter(F.col("ts") < split), ISSUER, **names)
    later = initial_load(changes.filter(F.col("ts") >= split), ISSUER, **names)
    return interval_join(
        t.events.select("event_id", "user_id", "ts"),
        early.unionByName(later),
        on={"user_id": "user_id"},
        event_ts="ts",
        take={"version_type": Take("event_type")},
        grain=["event_id"],
        allow_broadcast=False,
    ).select("event_id", "version_type")


@query("""
    SELECT l_partkey, p_type, p_brand, min(o_orderdate) AS valid_from, TRUE AS is_current
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    GROUP BY 1, 2, 3""")
def q30_product_dimension(t: Tables) -> DataFrame:
    """Attributes seen on fact rows, valid from their first sale on."""
    sold = _sold_items(t, t.lineitem)
    dim = history_from_facts(sold, PRODUCT, event_ts="o_orderdate", tie_break=["l_orderkey"])
    return dim.select("l_partkey", "p_type", "p_brand", "valid_from", "is_current")


def _sold_items(t: Tables, lineitem: DataFrame) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    parts = t.part.select("p_partkey", "p_type", "p_brand")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )


# -- reference dimensions -------------------------------------------------------------------


EASTER = """
    y1 AS (SELECT ano, ano % 19 AS a, ano // 100 AS b, ano % 100 AS c FROM y),
    y2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM y1),
    y3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM y2),
    y4 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM y3),
    easter AS (
      SELECT ano, make_date(ano, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS sunday
      FROM y4)"""

DAY = """CAST(strftime(data, '%Y%m%d') AS INTEGER) AS sk_data, data, year(data)::INTEGER AS ano,
      month(data)::INTEGER AS mes, day(data)::INTEGER AS dia, isodow(data)::INTEGER AS dia_semana,
      list_extract(['janeiro','fevereiro','março','abril','maio','junho','julho','agosto',
        'setembro','outubro','novembro','dezembro'], month(data)) AS nome_mes,
      list_extract(['segunda-feira','terça-feira','quarta-feira','quinta-feira','sexta-feira',
        'sábado','domingo'], isodow(data)) AS nome_dia_semana,
      isodow(data) >= 6 AS is_fim_semana,
      (date_diff('day', sunday, data) IN (-48, -47, -2, 60) OR strftime(data, '%m-%d') IN
        ('01-01','04-21','05-01','09-07','10-12','11-02','11-15','12-25')) AS is_feriado_nacional"""


@query(f"""
    WITH days AS (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS data),
    y AS (SELECT DISTINCT year(data) AS ano FROM days), {EASTER},
    seen AS (SELECT CAST(ts AS DATE) AS data, count(*) AS n FROM events GROUP BY 1)
    SELECT {DAY}, coalesce(n, 0) AS events
    FROM days JOIN easter ON easter.ano = year(data) LEFT JOIN seen USING (data)""")
def q17_whole_calendar(t: Tables) -> DataFrame:
    """All 4,018 days of the generated calendar, with the events of each."""
    day = F.col("ts").cast("date").alias("data")
    seen = t.events.groupBy(day).agg(F.count(F.lit(1)).alias("events"))
    return calendar(t.spark).join(seen, "data", "left").fillna(0, ["events"])


@query(f"""
    WITH days AS (
      SELECT CAST(o_orderdate AS DATE) AS data, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
      FROM orders GROUP BY 1),
    y AS (SELECT DISTINCT year(data) AS ano FROM days), {EASTER}
    SELECT {DAY}, orders, total
    FROM days JOIN easter ON easter.ano = year(data)""")
def q17_calendar(t: Tables) -> DataFrame:
    """Calendar attributes of every day with orders."""
    day = F.col("o_orderdate").cast("date").alias("day")
    total = F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("total")
    days = t.orders.groupBy(day).agg(F.count(F.lit(1)).alias("orders"), total)
    columns = [c.alias(n) for n, c in calendar_columns(F.col("day")).items()]
    return days.select(*columns, "orders", "total")


@query("""
    SELECT r_name, n_name, c_mktsegment, count(*) AS customers,
      CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    GROUP BY 1, 2, 3""")
def q18_reference_join(t: Tables) -> DataFrame:
    """Facts by attributes of small reference tables."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    balance = F.sum(F.col("c_acctbal").cast(MONEY)).cast("double").alias("balance")
    return (
        t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "n_name", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("customers"), balance)
    )


@query(f"""
    WITH {ITEMS},
    cfop(cfop, grupo, tipo_operacao, gera_receita) AS (VALUES
      ('5101', 'venda_producao', 'saida', TRUE), ('5102', 'venda_terceiros', 'saida', TRUE),
      ('6101', 'venda_producao', 'saida', TRUE), ('6102', 'venda_terceiros', 'saida', TRUE),
      ('5202', 'devolucao', 'saida', FALSE), ('6202', 'devolucao', 'saida', FALSE)),
    coded AS (SELECT *, list_extract(['5101','5102','6101','6102','5202','6202'],
      CAST((l_orderkey + l_linenumber) % 6 AS INTEGER) + 1) AS cfop FROM items)
    SELECT grupo, tipo_operacao, gera_receita, count(*) AS items,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
    FROM coded JOIN cfop USING (cfop) GROUP BY 1, 2, 3""")
def q18_operation_codes(t: Tables) -> DataFrame:
    """Items by operation-code group, and whether the group earns revenue."""
    items = latest_items(t.lineitem, "l_extendedprice").withColumn("cfop", item_cfop())
    valor = F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("valor")
    return (
        items.join(cfop_dimension(t.spark), "cfop")
        .groupBy("grupo", "tipo_operacao", "gera_receita")
        .agg(F.count(F.lit(1)).alias("items"), valor)
    )


@query("""
    WITH b AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS base FROM customer),
    d1 AS (SELECT *, (SELECT sum(CAST(substr(base, i, 1) AS INTEGER) * list_extract([5,4,3,2,9,8,7,6,5,4,3,2], i))
      FROM (SELECT unnest(range(1, 13))::INTEGER AS i)) % 11 AS r1 FROM b),
    b2 AS (SELECT *, base || CASE WHEN r1 < 2 THEN '0' ELSE CAST(11 - r1 AS VARCHAR) END AS one FROM d1),
    d2 AS (SELECT *, (SELECT sum(CAST(substr(one, i, 1) AS INTEGER) * list_extract([6,5,4,3,2,9,8,7,6,5,4,3,2], i))
      FROM (SELECT unnest(range(1, 14))::INTEGER AS i)) % 11 AS r2 FROM b2)
    SELECT c_custkey, cnpj, length(replace(cnpj, '0', '')) > 0 AS valid, FALSE AS altered_valid
    FROM (SELECT *, one || CASE WHEN r2 < 2 THEN '0' ELSE CAST(11 - r2 AS VARCHAR) END AS cnpj FROM d2)""")
def q26_company_ids(t: Tables) -> DataFrame:
    """build and check company ids; one altered digit makes them invalid."""
    base = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    last = F.substring("cnpj", 14, 1).cast("int")
    altered = F.concat(F.substring("cnpj", 1, 13), ((last + 1) % 10).cast("string"))
    keyed = with_cnpj(t.customer, "cnpj", base).withColumn("altered", altered)
    return keyed.select(
        "c_custkey",
        "cnpj",
        is_valid_cnpj("cnpj").alias("valid"),
        is_valid_cnpj("altered").alias("altered_valid"),
    )


CNPJ_OF = """lpad(CAST(n + 1 AS VARCHAR), 8, '0') || '0001'"""


@query(f"""
    WITH n AS (SELECT o_orderkey, o_custkey, o_orderdate, o_custkey // 10 AS n FROM orders),
    b AS (SELECT *, {CNPJ_OF} AS base FROM n),
    d1 AS (SELECT *, list_sum(list_transform(range(1, 13), lambda i: CAST(substr(base, i, 1) AS INTEGER)
      * list_extract([5,4,3,2,9,8,7,6,5,4,3,2], i))) % 11 AS r1 FROM b),
    b2 AS (SELECT *, base || CASE WHEN r1 < 2 THEN '0' ELSE CAST(11 - r1 AS VARCHAR) END AS one FROM d1),
    d2 AS (SELECT *, list_sum(list_transform(range(1, 14), lambda i: CAST(substr(one, i, 1) AS INTEGER)
      * list_extract([6,5,4,3,2,9,8,7,6,5,4,3,2], i))) % 11 AS r2 FROM b2),
    c AS (SELECT *, one || CASE WHEN r2 < 2 THEN '0' ELSE CAST(11 - r2 AS VARCHAR) END AS cnpj FROM d2),
    body AS (SELECT o_orderkey, CAST(o_custkey % 25 + 11 AS VARCHAR) || strftime(o_orderdate, '%y%m') || cnpj
      || '55' || lpad(CAST(o_orderkey % 999 + 1 AS VARCHAR), 3, '0')
      || lpad(CAST(o_orderkey % 1000000000 AS VARCHAR), 9, '0') || '1'
      || lpad(CAST(o_orderkey // 1000000000 AS VARCHAR), 8, '0') AS body FROM c),
    dv AS (SELECT *, 11 - list_sum(list_transform(range(1, 44), lambda i: CAST(substr(body, i, 1) AS INTEGER)
      * (2 + (43 - i) % 8))) % 11 AS digit FROM body)
    SELECT o_orderkey, body || CASE WHEN digit >= 10 THEN '0' ELSE CAST(digit AS VARCHAR) END AS chave_acesso,
      TRUE AS valid, FALSE AS altered_valid FROM dv""")
def q26_access_keys(t: Tables) -> DataFrame:
    """build and check invoice access keys."""
    keyed = with_order_key(t.orders).select("o_orderkey", "chave_acesso")
    last = F.substring("chave_acesso", 44, 1).cast("int")
    altered = F.concat(F.substring("chave_acesso", 1, 43), ((last + 1) % 10).cast("string"))
    return keyed.withColumn("altered", altered).select(
        "o_orderkey",
        "chave_acesso",
        is_valid_access_key("chave_acesso").alias("valid"),
        is_valid_access_key("altered").alias("altered_valid"),
    )


KNOWN_AT = ("2024-02-01", "2024-02-02", "2024-02-03")


@query("""
    WITH log AS (
      SELECT user_id, event_type, ts, event_id, CAST(event_id % 3 AS INTEGER) AS batch,
        event_type = 'error' AND event_id % 2 = 0 AS withdrawn FROM events
      UNION ALL
      SELECT user_id, event_type, ts, event_id + 1000000000, 2, TRUE FROM events WHERE event_id % 21 = 1
      UNION ALL
      SELECT user_id, 'corrected', ts, event_id + 2000000000, 1, FALSE FROM events WHERE event_id % 18 = 3),
    asked AS (SELECT unnest([0, 1, 2]) AS known),
    ranked AS (
      SELECT known, user_id, event_type, ts, withdrawn,
        row_number() OVER (PARTITION BY known, user_id, ts ORDER BY batch DESC, event_id DESC) AS rn
      FROM log JOIN asked ON batch <= known),
    starts AS (SELECT * FROM ranked WHERE rn = 1 AND NOT withdrawn),
    versions AS (
      SELECT known, user_id, event_type, ts AS valid_from,
        lead(ts) OVER (PARTITION BY known, user_id ORDER BY ts) AS valid_to FROM starts)
    SELECT CAST(known AS INTEGER) AS known, user_id, event_type, valid_from, valid_to FROM versions""")
def q35_bitemporal_history(t: Tables) -> DataFrame:
    """The history of each user as it was known after each of three batches, from one table of rectangles.

    Batches bring late changes, corrections of earlier starts and withdrawals; the last one comes twice.
    """
    cfg = Bitemporal(["user_id"], ["event_type"], "ts", "event_id")
    number, kind = F.col("event_id"), F.col("event_type")
    log = t.events.select(
        "user_id",
        "event_type",
        "ts",
        "event_id",
        (number % 3).cast("int").alias("batch"),
        F.when((kind == "error") & (number % 2 == 0), "W").otherwise("U").alias("op"),
    )
    withdrawn = log.where(number % 21 == 1).withColumns(
        {"event_id": number + 1_000_000_000, "batch": F.lit(2), "op": F.lit("W")}
    )
    corrected = log.where(number % 18 == 3).withColumns(
        {"event_type": F.lit("corrected"), "event_id": number + 2_000_000_000, "batch": F.lit(1), "op": F.lit("U")}
    )
    log = materialize(log.unionByName(withdrawn).unionByName(corrected), "log")
    history = empty_history(log, cfg)
    for batch in (0, 1, 2, 2):
        history = materialize(record(history, log.where(F.col("batch") == batch), cfg, F.lit(KNOWN_AT[batch])), "history")
    shown = [
        as_known(history, F.lit(at).cast("timestamp_ntz")).select(
            F.lit(i).alias("known"),
            "user_id",
            "event_type",
            "valid_from",
            F.when(F.col("valid_to") < F.lit("9999-01-01").cast("timestamp_ntz"), F.col("valid_to")).alias("valid_to"),
        )
        for i, at in enumerate(KNOWN_AT)
    ]
    return reduce(DataFrame.unionAll, shown)


# -- facts and aggregates -------------------------------------------------------------------


@query(f"""
    WITH {ITEMS}, {HEADERS}
    SELECT strftime(o_orderdate, '%Y%m') AS ano_mes, n_name, o_orderpriority,
      CAST(sum(CASE WHEN is_cancelada THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE)
        AS valor_liquido,
      count(DISTINCT CASE WHEN NOT is_cancelada THEN o_orderkey END) AS qtd_notas,
      count(DISTINCT CASE WHEN is_cancelada THEN o_orderkey END) AS qtd_notas_canceladas_excluidas
    FROM items JOIN headers ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3""")
def q19_revenue(t: Tables) -> DataFrame:
    """Net revenue and exact counts of live and cancelled invoices."""
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name"
    )
    headers = orders_with_status(t.orders, t.lineitem).join(
        places, F.col("o_custkey") == F.col("c_custkey")
    )
    # Folded to one row per order before the join, so that an order with very many lines
    # is no more than any other there.
    value = F.sum(F.col("l_extendedprice").cast(MONEY)).alias("valor_produto")
    sold = latest_items(t.lineitem, "l_extendedprice").groupBy("l_orderkey").agg(value)
    facts = sold.join(headers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        year_month(F.col("o_orderdate")).alias("ano_mes"),
        "n_name",
        "o_orderpriority",
        "o_orderkey",
        "is_cancelada",
        "valor_produto",
    )
    group = ("ano_mes", "n_name", "o_orderpriority")
    revenue = revenue_by(facts, group, invoice="o_orderkey")
    net = F.col("valor_liquido").cast("double")
    return revenue.withColumn("valor_liquido", net).orderBy(*group)


@query(f"""
    WITH {ITEMS}, {HEADERS},
    live AS (
      SELECT strftime(o_orderdate, '%Y%m') AS ano_mes, p_type,
        sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v,
        sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
          + CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS x
      FROM items JOIN headers ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
      WHERE NOT is_cancelada GROUP BY 1, 2)
    SELECT ano_mes, p_type, CAST(v AS DOUBLE) AS valor_produtos, CAST(x AS DOUBLE) AS valor_tributos,
      round(CAST(x AS DOUBLE) / CAST(v AS DOUBLE), 6) AS carga_tributaria_efetiva FROM live""")
def q20_tax_burden(t: Tables) -> DataFrame:
    """Taxes over value of live items."""
    price = F.col("l_extendedprice").cast(MONEY)
    headers = orders_with_status(t.orders, t.lineitem).select(
        "o_orderkey", "o_orderdate", "is_cancelada"
    )
    kinds = t.part.select("p_partkey", "p_type")
    facts = (
        latest_items(t.lineitem, "l_tax", "l_discount")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(kinds, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            year_month(F.col("o_orderdate")).alias("ano_mes"),
            "p_type",
            "is_cancelada",
            price.alias("valor_produto"),
            (price * F.col("l_tax").cast("decimal(4,2)")).alias("imposto"),
            (price * F.col("l_discount").cast("decimal(4,2)")).alias("contribuicao"),
        )
    )
    burden = tax_burden_by(facts, ("ano_mes", "p_type"), taxes=("imposto", "contribuicao"))
    rounded = F.round("carga_tributaria_efetiva", 6)
    return burden.select(
        "ano_mes",
        "p_type",
        F.col("valor_produtos").cast("double").alias("valor_produtos"),
        F.col("valor_tributos").cast("double").alias("valor_tributos"),
        rounded.cast("double").alias("carga_tributaria_efetiva"),
    ).orderBy("ano_mes", "p_type")


STRETCHED = f"""{CHANGES.replace(" ts,", " TIMESTAMP '1995-01-01' + (ts - TIMESTAMP '2024-01-01') * 80 AS ts,")},
{VERSIONS}"""


@query(f"""
    WITH {ITEMS}, {HEADERS}, {STRETCHED},
    product AS (
      SELECT l_partkey, min(o_orderdate) AS first_sale FROM items JOIN orders ON o_orderkey = l_orderkey
      GROUP BY 1)
    SELECT l_orderkey, l_linenumber, i.l_partkey, o_custkey // 10 AS user_id,
      CAST(l_extendedprice AS DOUBLE) AS valor_produto, o_orderstatus AS status, is_cancelada,
      CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS sk_data,
      strftime(o_orderdate, '%Y%m') AS ano_mes_emissao,
      v.event_type AS issuer_type, v.valid_from AS issuer_from, v.user_id IS NOT NULL AS issuer_known,
      p.first_sale AS product_from
    FROM items i JOIN headers ON o_orderkey = l_orderkey
    JOIN product p ON p.l_partkey = i.l_partkey
    LEFT JOIN versions v ON v.user_id = o_custkey // 10 AND v.valid_from <= o_orderdate
      AND (v.valid_to IS NULL OR o_orderdate < v.valid_to)""")
def q27_item_fact(t: Tables) -> DataFrame:
    """G11, J2, J3 twice, P7, P8: items with invoice status, as-of dimensions and date keys."""
    changes = issuer_changes(t.events).withColumn("ts", stretched(F.col("ts")))
    issuers = materialize(
        full_history(changes, ISSUER, change_ts="ts", tie_break="event_id").select(
            "user_id", "event_type", "valid_from", "valid_to"
        ),
        "dim",
    )
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    items = materialize(latest_items(t.lineitem, *columns).select(*columns), "items")
    sold = _sold_items(t, items)
    products = materialize(
        history_from_facts(sold, PRODUCT, event_ts="o_orderdate", tie_break=["l_orderkey"]).select(
            "l_partkey", "valid_from", "valid_to"
        ),
        "dim",
    )
    headers = orders_with_status(t.orders, t.lineitem).select(
        "o_orderkey",
        F.floor(F.col("o_custkey") / 10).cast("long").alias("user_id"),
        "o_orderdate",
        F.col("o_orderstatus").alias("status"),
        "is_cancelada",
    )
    facts = items.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    facts = as_of_join(
        facts,
        products,
        on={"l_partkey": "l_partkey"},
        event_ts="o_orderdate",
        take={"product_from": Take("valid_from")},
        grain=ITEM_GRAIN,
    )
    facts = as_of_join(
        facts,
        issuers,
        on={"user_id": "user_id"},
        event_ts="o_orderdate",
        take={"issuer_type": Take("event_type"), "issuer_from": Take("valid_from")},
        grain=ITEM_GRAIN,
        write_once=True,
    )
    issued = F.col("o_orderdate")
    return facts.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "user_id",
        F.col("l_extendedprice").alias("valor_produto"),
        "status",
        "is_cancelada",
        date_key(issued).alias("sk_data"),
        year_month(issued).alias("ano_mes_emissao"),
        "issuer_type",
        "issuer_from",
        F.col("issuer_from").isNotNull().alias("issuer_known"),
        "product_from",
    )


# -- reconciliation, versions, contracts ----------------------------------------------------


def _chain_sql(source: str) -> str:
    return f"""
      SELECT '{source}' AS dimension, 'one_current' AS invariant, count(*) AS violations FROM (
        SELECT user_id FROM {source} GROUP BY 1 HAVING sum(CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END) <> 1)
      UNION ALL SELECT '{source}', 'no_gap_no_overlap', count(DISTINCT user_id) FROM (
        SELECT user_id, valid_to, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS n
        FROM {source}) WHERE n IS NOT NULL AND (valid_to IS NULL OR valid_to <> n)"""


@query(f"""
    WITH {ITEMS}, {HEADERS}
    SELECT strftime(o_orderdate, '%Y%m') AS ano_mes, n_name AS place,
      CAST(sum(CASE WHEN is_cancelada THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE)
        AS valor_liquido,
      count(DISTINCT CASE WHEN NOT is_cancelada THEN o_orderkey END) AS qtd_notas,
      count(DISTINCT CASE WHEN is_cancelada THEN o_orderkey END) AS qtd_notas_canceladas_excluidas
    FROM items JOIN headers ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def q19_revenue_text(t: Tables) -> DataFrame:
    """The revenue report, run as SQL text over named tables."""
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    headers = orders_with_status(t.orders, t.lineitem).join(
        places.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey")
    )
    items = latest_items(t.lineitem, "l_extendedprice").join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    items = items.select(
        F.col("o_orderkey").alias("invoice"),
        F.col("o_orderdate").alias("issued"),
        F.col("n_name").alias("place"),
        F.col("is_cancelada").alias("cancelled"),
        F.col("l_extendedprice").cast(MONEY).alias("value"),
    )
    report = run_report(t.spark, "monthly_revenue", {"items": items})
    return report.withColumn("valor_liquido", F.col("valor_liquido").cast("double"))


@query(f"""
    WITH {ITEMS}, {HEADERS},
    live AS (
      SELECT strftime(o_orderdate, '%Y%m') AS ano_mes, p_type AS family,
        sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v,
        sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS x
      FROM items JOIN headers ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
      WHERE NOT is_cancelada GROUP BY 1, 2)
    SELECT ano_mes, family, CAST(v AS DOUBLE) AS valor_produtos, CAST(x AS DOUBLE) AS valor_tributos,
      round(CAST(x AS DOUBLE) / CAST(v AS DOUBLE), 6) AS carga_tributaria_efetiva FROM live""")
def q20_tax_burden_text(t: Tables) -> DataFrame:
    """The burden report, run as SQL text with the library's ratio."""
    headers = orders_with_status(t.orders, t.lineitem).select("o_orderkey", "o_orderdate", "is_cancelada")
    price = F.col("l_extendedprice").cast(MONEY)
    items = (
        latest_items(t.lineitem, "l_tax")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_orderdate").alias("issued"),
            F.col("p_type").alias("family"),
            F.col("is_cancelada").alias("cancelled"),
            price.alias("value"),
            (price * F.col("l_tax").cast("decimal(4,2)")).alias("taxes"),
        )
    )
    report = run_report(t.spark, "tax_burden", {"items": items})
    numbers = ("valor_produtos", "valor_tributos", "carga_tributaria_efetiva")
    return report.withColumns({n: F.col(n).cast("double") for n in numbers})


@query(f"""
    WITH {CHANGES}, {VERSIONS},
    planted AS (
      SELECT user_id, valid_to IS NULL AND user_id % 50 <> 1 AS is_current,
        user_id % 50 = 2 AS reversed FROM versions)
    SELECT 'users' AS dimension, user_id AS natural_key,
      count(CASE WHEN is_current THEN 1 END) AS current_versions, count(CASE WHEN reversed THEN 1 END) AS reversed_versions
    FROM planted GROUP BY user_id
    HAVING count(CASE WHEN is_current THEN 1 END) <> 1 OR count(CASE WHEN reversed THEN 1 END) > 0""")
def q21_history_invariants_text(t: Tables) -> DataFrame:
    """The invariants of a history as SQL text with named parameters, over planted faults."""
    kind = F.col("user_id") % 50
    history = _issuer_dim(t).select(
        F.col("user_id").alias("natural_key"),
        "valid_from",
        F.when(kind == 2, F.col("valid_from")).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & (kind != 1)).alias("is_current"),
    )
    return run_report(t.spark, "history_invariants", {"history": history}, name="users", currents=1)


@query("""
    SELECT 'access' AS kind, 2 * count(*) AS n, count(*) AS n_valid FROM orders
    UNION ALL SELECT 'company', 2 * count(*), count(CASE WHEN c_custkey <> 0 THEN 1 END) FROM customer""")
def q26_key_checks_text(t: Tables) -> DataFrame:
    """the check-digit rules called from SQL text, over whole keys and keys with one altered digit.

    Customer 0 has a company id of zeros alone, which is none.
    """

    def both(keys: DataFrame, kind: str, length: int) -> DataFrame:
        last = F.substring("key", length, 1).cast("int")
        altered = F.concat(F.substring("key", 1, length - 1), ((last + 1) % 10).cast("string"))
        kinds = F.lit(kind).alias("kind")
        return keys.select(kinds, "key").unionAll(keys.select(kinds, altered))

    companies = with_cnpj(t.customer, "key", F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
    orders = with_order_key(t.orders).select(F.col("chave_acesso").alias("key"))
    keys = both(orders, "access", 44).unionAll(both(companies.select("key"), "company", 14))
    return run_report(t.spark, "key_checks", {"keys": keys})


@query(f"""
    WITH {CHANGES}, {VERSIONS}, holed AS (SELECT * FROM versions WHERE event_type <> 'click')
    {_chain_sql("versions")} UNION ALL {_chain_sql("holed")}""")
def q21_scd2_invariants(t: Tables) -> DataFrame:
    """Violations in a sound history, and in one with versions taken out."""
    dim = _issuer_dim(t)  # written once, read for each check
    found = [
        invariants(d, ["user_id"]).select(F.lit(name).alias("dimension"), "*")
        for name, d in (("versions", dim), ("holed", dim.filter("event_type <> 'click'")))
    ]
    return found[0].unionAll(found[1])


@query(f"""
    WITH {ITEMS}
    SELECT 'nfe_item' AS entity, (SELECT count(*) FROM lineitem) AS bronze_count,
      (SELECT count(*) FROM items) AS silver_count
    WHERE (SELECT count(*) FROM lineitem) <> (SELECT count(*) FROM items)""")
def q22_reconciliation(t: Tables) -> DataFrame:
    """Only entities whose layers differ in size."""
    return reconcile(
        {
            "nfe_header": (t.orders, orders_with_status(t.orders, t.lineitem)),
            "nfe_item": (t.lineitem, latest_items(t.lineitem, "l_linenumber")),
        }
    )


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q23_duplicate_grain(t: Tables) -> DataFrame:
    """A2, L3: keys that break the grain."""
    return duplicate_keys(t.lineitem, ITEM_GRAIN)


@query(f"""
    WITH {ITEMS}, old AS (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, count(*) AS n FROM lineitem),
    new AS (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, count(*) AS n FROM items)
    SELECT 0 AS first_version, 1 AS last_version, CAST(old.v AS DOUBLE) AS revenue_before,
      CAST(new.v AS DOUBLE) AS revenue_after, 0::BIGINT AS rows_added, old.n - new.n AS rows_removed
    FROM old, new""")
def q24_time_travel(t: Tables) -> DataFrame:
    """Two versions, their revenue and their difference."""
    table = _store(t, "versions").table("gold", "items")
    table.overwrite(t.lineitem, batch_id="b1", stage="load")
    table.overwrite(latest_items(t.lineitem), batch_id="b2", stage="dedup")
    first, last = table.span()
    before = table.read_version(first)
    newest = table.history(1).first()
    after = table.read_timestamp(newest.timestamp)

    def revenue(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias(name))

    changed = diff_counts(before, after)
    # One row each, in the plan and not through the driver.
    sums = revenue(before, "revenue_before").join(revenue(after, "revenue_after"))
    return changed.join(sums).select(
        F.lit(first).cast("int").alias("first_version"),
        F.lit(last).cast("int").alias("last_version"),
        "revenue_before",
        "revenue_after",
        "rows_added",
        "rows_removed",
    )


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS chave_acesso, l_linenumber AS num_item,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS valor_produto,
      CAST(NULL AS VARCHAR) AS cest FROM lineitem""")
def q29_conform(t: Tables) -> DataFrame:
    """Cast, reorder and fill up rows to a contract."""
    observed = t.lineitem.select(
        F.col("l_extendedprice").alias("valor_produto"),
        F.col("l_linenumber").alias("num_item"),
        F.col("l_orderkey").alias("chave_acesso"),
        F.col("l_tax").alias("extra"),
    )
    contract = T.StructType.fromDDL(
        "chave_acesso string, num_item int, valor_produto decimal(18,2), cest string"
    )
    return conform(observed, contract).withColumn(
        "valor_produto", F.col("valor_produto").cast("double")
    )


CHANGED_SALES = f"""{ITEMS}, {HEADERS},
    sales AS (
      SELECT l_orderkey, l_linenumber, strftime(o_orderdate, '%Y%m') AS ano_mes, o_orderpriority, is_cancelada,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS valor
      FROM items JOIN headers ON o_orderkey = l_orderkey),
    changed AS (
      SELECT l_orderkey, l_linenumber,
        CASE l_orderkey % 500 WHEN 4 THEN '199901' ELSE ano_mes END AS ano_mes,
        CASE l_orderkey % 500 WHEN 5 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
        CASE l_orderkey % 500 WHEN 6 THEN NOT is_cancelada ELSE is_cancelada END AS is_cancelada,
        CAST(CASE l_orderkey % 500 WHEN 7 THEN valor * 2 ELSE valor END AS DECIMAL(18,2)) AS valor
      FROM sales WHERE l_orderkey % 500 <> 3 OR l_linenumber > 2)"""


@query(f"""
    WITH {CHANGED_SALES}
    SELECT ano_mes, o_orderpriority,
      CAST(sum(CASE WHEN is_cancelada THEN 0 ELSE valor END) AS DOUBLE) AS valor_liquido,
      count(DISTINCT CASE WHEN NOT is_cancelada THEN l_orderkey END) AS qtd_notas,
      count(DISTINCT CASE WHEN is_cancelada THEN l_orderkey END) AS qtd_notas_canceladas_excluidas
    FROM changed GROUP BY 1, 2""")
def q32_incremental_revenue(t: Tables) -> DataFrame:
    """Monthly revenue that follows its facts by signed deltas.

    Loaded without orders 8 modulo 500 and then brought up to date by 1 % of the items: new ones, deleted
    ones, other months, priorities, states and values. The last batch comes twice.
    """
    group = ("ano_mes", "o_orderpriority")
    facts = materialize(
        latest_items(t.lineitem, "l_extendedprice")
        .join(orders_with_status(t.orders, t.lineitem), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            year_month(F.col("o_orderdate")).alias("ano_mes"),
            "o_orderpriority",
            "is_cancelada",
            F.col("l_extendedprice").cast(MONEY).alias("valor_produto"),
        ),
        "sales",
    )
    kind = F.col("l_orderkey") % 500
    aggregate = MaintainedAggregate(
        t.spark,
        scratch_dir(t.spark, "revenue"),
        revenue_measures(group, "ano_mes", invoice="l_orderkey"),
        facts,
    ).create(facts.where(kind != 8))
    aggregate.apply(facts.limit(0), facts.where(kind == 8), "new orders")
    gone = (kind == 3) & (F.col("l_linenumber") <= 2)
    before = facts.where(gone | kind.between(4, 7))
    after = before.where(~gone).withColumns(
        {
            "ano_mes": F.when(kind == 4, "199901").otherwise(F.col("ano_mes")),
            "o_orderpriority": F.when(kind != 5, F.col("o_orderpriority")),
            "is_cancelada": F.when(kind == 6, ~F.col("is_cancelada")).otherwise(F.col("is_cancelada")),
            "valor_produto": F.when(kind == 7, F.col("valor_produto") * 2).otherwise(F.col("valor_produto")).cast(MONEY),
        }
    )
    for _ in range(2):
        aggregate.apply(before, after, "corrections")
    return aggregate.read().withColumn("valor_liquido", F.col("valor_liquido").cast("double"))


@query("""
    WITH kinds AS (SELECT DISTINCT event_type FROM events),
    plain(path, expected, observed, finding, merged) AS (VALUES
      ('k', 'bigint', 'bigint', 'same', 'bigint'),
      ('items', 'array<struct<price:decimal(4,2),sku:string>>', NULL, 'absent', 'array<struct<price:decimal(4,2),sku:string>>')),
    nested(path, expected, observed, finding, merged) AS (VALUES
      ('k', 'bigint', 'variant', 'widened', 'variant'),
      ('items[].price', 'decimal(4,2)', 'decimal(2,1)', 'narrowed', 'decimal(4,2)'),
      ('items[].sku', 'string', 'string', 'same', 'string'),
      ('items[].weight', NULL, 'bigint', 'new', 'bigint'),
      ('note', NULL, 'struct<x:boolean>', 'new', 'struct<x:boolean>'))
    SELECT event_type, f.* FROM kinds, plain f WHERE event_type <> 'purchase'
    UNION ALL SELECT event_type, f.* FROM kinds, nested f WHERE event_type = 'purchase'""")
def q29_nested_drift(t: Tables) -> DataFrame:
    """How the texts of each kind of event differ from their contract, at every depth.

    The observed types are merged over all texts. Purchases carry other fields in some texts, and a text for
    their number in others.
    """
    text = (
        F.when(F.col("event_type") != "purchase", F.col("props"))
        .when(F.col("event_id") % 3 == 0, '{"k": "many", "items": [{"price": 2.5, "weight": 3}, {"sku": "a"}]}')
        .when(F.col("event_id") % 3 == 1, '{"k": 5, "note": {"x": true}, "items": []}')
        .otherwise(F.col("props"))
    )
    contract = T.StructType.fromDDL("k bigint, items array<struct<price:decimal(4,2),sku:string>>")
    events = t.events.select("event_type", text.alias("props"))
    found = [
        (group[0], f.path, f.expected, f.observed, f.finding, f.merged)
        for group, kind in observed_types(events, "props", ["event_type"]).items()
        for f in nested_findings(kind, contract)
    ]
    return t.spark.createDataFrame(
        found, "event_type string, path string, expected string, observed string, finding string, merged string"
    )


@query(f"""
    WITH {ITEMS}
    SELECT l_orderkey, l_linenumber::BIGINT AS line, CAST(l_extendedprice AS DECIMAL(12,2))::DOUBLE AS price,
      CAST(NULL AS DOUBLE) AS tax, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber::INTEGER END AS even_line
    FROM items""")
def q29_nested_conform(t: Tables) -> DataFrame:
    """Lists of records brought to their contract at every depth."""
    text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber").cast("string")).otherwise("odd")
    record = F.struct(
        F.col("l_extendedprice").alias("price"), F.col("l_linenumber").cast("int").alias("line"), text.alias("even_line"), F.lit("x").alias("more")
    )
    orders = latest_items(t.lineitem).groupBy("l_orderkey").agg(F.struct(F.collect_list(record).alias("rows")).alias("body"))
    contract = T.StructType.fromDDL(
        "l_orderkey bigint, body struct<rows:array<struct<line:bigint,price:decimal(12,2),tax:double,even_line:int>>>"
    )
    rows = conform_nested(orders, contract).select("l_orderkey", F.explode("body.rows").alias("r"))
    return rows.select("l_orderkey", "r.*").withColumn("price", F.col("price").cast("double"))


@query("""
    WITH rows AS (
      SELECT l_orderkey::VARCHAR AS key, l_orderkey % 10 AS batch, l_quantity <= 45 AS few, l_discount < 0.09 AS cheap
      FROM lineitem
      UNION ALL SELECT l_orderkey::VARCHAR, 3, l_quantity <= 45, l_discount < 0.09 FROM lineitem WHERE l_orderkey % 10 = 5)
    SELECT r.name, r.severity, count(*) AS rows_evaluated, count(CASE WHEN failed THEN 1 END) AS rows_failed,
      count(DISTINCT CASE WHEN failed THEN key END) AS keys_failed, count(DISTINCT key) AS keys_evaluated,
      1 - count(DISTINCT CASE WHEN failed THEN key END)::DOUBLE / count(DISTINCT key) AS key_pass_rate
    FROM (
      SELECT 'few' AS name, 'drop' AS severity, key, NOT coalesce(few, FALSE) AS failed FROM rows
      UNION ALL SELECT 'cheap', 'drop', key, NOT coalesce(cheap, FALSE) FROM rows
      UNION ALL SELECT '* drop', 'drop', key, NOT (coalesce(few, FALSE) AND coalesce(cheap, FALSE)) FROM rows) r
    GROUP BY r.name, r.severity""")
def q06_merged_metrics(t: Tables) -> DataFrame:
    """Rule metrics of ten batches merged by their sketches; a row that comes again is one.

    Order numbers in the fifth batch come again in the third; the last batch is kept twice.
    """
    rules = RuleSet(
        Expectation("few", F.col("l_quantity") <= 45, "drop"), Expectation("cheap", F.col("l_discount") < 0.09, "drop")
    )
    batch = F.col("l_orderkey") % 10
    kept = []
    for number in (*range(10), 9):
        rows = t.lineitem.where(batch.isin(3, 5) if number == 3 else batch == number)
        kept.append(rule_sketches(rows, rules, F.col("l_orderkey"), f"b{number}"))
    return merged_metrics(materialize(reduce(DataFrame.unionAll, kept), "sketches"))


# -- the whole run --------------------------------------------------------------------------


@query(f"""
    WITH {ITEMS}, {HEADERS}
    SELECT strftime(o_orderdate, '%Y%m') AS ano_mes_emissao,
      list_extract(['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR',
        'RJ','RN','RO','RR','RS','SC','SE'], CAST(o_custkey % 25 AS INTEGER) + 1) AS uf_emitente,
      list_extract(['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR',
        'RJ','RN','RO','RR','RS','SC','SE'], CAST((o_orderkey * 7 + 3) % 25 AS INTEGER) + 1) AS uf_destinatario,
      list_extract(['5101','5102','6101','6102','5202','6202'],
        CAST((l_orderkey + l_linenumber) % 6 AS INTEGER) + 1) AS cfop,
      CAST(sum(CASE WHEN is_cancelada THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE)
        AS valor_liquido,
      count(DISTINCT CASE WHEN NOT is_cancelada THEN o_orderkey END) AS qtd_notas,
      count(DISTINCT CASE WHEN is_cancelada THEN o_orderkey END) AS qtd_notas_canceladas_excluidas
    FROM items JOIN headers ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    WHERE p_size <> 13 GROUP BY 1, 2, 3, 4""")
def q31_medallion(t: Tables) -> DataFrame:
    """Bronze, silver and gold from JSON and typed sources; monthly revenue."""
    store = _store(t, "medallion")
    with lean_disk(t.spark):
        run_medallion(store, raw_sources(t), "b1")
    revenue = store.table("gold", "agg_faturamento_mensal_uf").read()
    return revenue.withColumn("valor_liquido", F.col("valor_liquido").cast("double"))
