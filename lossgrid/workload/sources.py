"""Queries over reads, writes and small relational operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrid.functions import calendar
from lossgrid.operators import predictions, summaries
from lossgrid.session import run_dir
from lossgrid.sources import catalog, sinks, staging
from lossgrid.workload.query import Query

STEPS: dict[str, str] = {}


def _fresh_path(spark: SparkSession, name: str) -> str:
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers united with an upstream table that does not exist."""
    customer = staging.read_table(spark, sf_dir, "customer")
    return catalog.union_all([customer, catalog.scan_or_empty(spark, f"missing_{uuid.uuid4().hex}", customer.schema)])


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second one with a column the first did not have."""
    path, events = _fresh_path(spark, "append"), staging.read_table(spark, sf_dir, "events")
    sinks.append_table(events.where("event_type = 'click'").select("event_id", "value"), path)
    sinks.append_table(events.where("event_type <> 'click'").select("event_id", "value", "event_type"), path)
    return sinks.read_appended(spark, path)


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh_path(spark, "csv")
    orders = staging.read_table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    orders = orders.withColumn("tags", F.array("o_orderstatus")).withColumn("note", F.when(F.col("o_orderkey") % 3 == 0, "x"))
    columns = sinks.export_csv(orders, path, 4000)
    schema = ", ".join(f"{c} {orders.schema[c].dataType.simpleString()}" for c in columns)
    return spark.read.option("header", True).schema(schema).csv(path)


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = staging.read_table(spark, sf_dir, "part")
    view = sinks.temp_view(part, f"parts_{uuid.uuid4().hex}")
    return view.groupBy("p_brand").agg(F.count("*").alias("parts"), F.max("p_retailprice").alias("top_price"))


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = staging.read_table(spark, sf_dir, "supplier")
    name = f"suppliers_{uuid.uuid4().hex}"
    atexit.register(lambda: spark.sql(f"DROP TABLE IF EXISTS {name}"))
    return sinks.materialise_table(supplier, name)


def _payload_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload tables of three models, found by their prefix."""
    prefix = f"pay{uuid.uuid4().hex}"
    payload = staging.stage(spark, sf_dir, "payload")
    for model in ("m0", "m1", "m2"):
        extra = payload.withColumn("extra", F.lit(1)) if model == "m2" else payload
        sinks.temp_view(extra.where(F.col("model_name") == model), f"{prefix}_{model}_payload_flat")
    return catalog.tables_by_prefix(spark, prefix)


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = staging.read_table(spark, sf_dir, "part")
    text = F.to_json(F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("type"), F.col("p_type")))
    info = catalog.models_info_frame(part.select("p_partkey", text.alias("model_config")))
    return info.select("p_partkey", F.col("model_config")["size"].alias("size"), F.col("model_config")["type"].alias("type"), F.col("ts").isNotNull().alias("stamped"))


def _odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = staging.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order-Key"), F.col("o_custkey").alias("CUSTKEY"), F.col("o_totalprice").alias("price")
    )
    return catalog.resolve_columns(odd, ["orderkey", "custkey", "price"])


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = staging.read_table(spark, sf_dir, "supplier")
    named = predictions.rename_first(supplier, {"id": ["s_id", "s_suppkey"], "balance": ["s_acctbal", "acctbal"], "s_name": ["name"]})
    return predictions.ensure_columns(named, {"rating": "double", "s_name": "string"})


def _latest_by_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = staging.stage(spark, sf_dir, "payload")
    return summaries.value_at_greatest(
        payload, ["model_name", "segment"], "prediction",
        {"at_highest_lag": (F.lit(True), ["lag", "ts", "event_id"]), "latest_inference": (F.col("is_inference"), ["ts", "event_id"])},
    )


QUERIES = {
    "src1_catalog_scan": Query(
        lambda s, d: catalog.catalog_scan(s, {"clients": f"{d}/customer.parquet"}, "clients"),
        "c_custkey:i c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s",
        "SELECT * FROM customer",
    ),
    "src2_scan_or_empty": Query(_optional, "c_custkey:i c_name:s c_acctbal:d", "SELECT * FROM customer"),
    "src4_load_xy": Query(
        lambda s, d: catalog.load_xy(
            staging.read_table(s, d, "orders"), ["o_orderkey", "O_CustKey"], "o_totalprice", ["o_orderstatus"], "o_orderdate", "1997-01-01", "1998-12-31"
        ),
        "o_orderkey:i O_CustKey:i o_totalprice:d o_orderstatus:s",
        "SELECT * FROM orders WHERE o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'",
    ),
    "src5_temporal_filter": Query(
        lambda s, d: catalog.temporal_filter(staging.read_table(s, d, "lineitem"), "l_shipdate", lower="1999-05-05"),
        "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_shipdate:t",
        "SELECT * FROM lineitem WHERE l_shipdate >= DATE '1999-05-05'",
    ),
    "src6_resolve_columns": Query(
        _odd_names, "orderkey:i custkey:i price:d", "SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_totalprice AS price FROM orders"
    ),
    "src7_tables_by_prefix": Query(
        _payload_tables, "event_id:i model_name:s prediction:d extra:i", "SELECT *, CASE WHEN model_name = 'm2' THEN 1 END AS extra FROM stg_payload"
    ),
    "src8_models_info": Query(
        _models, "p_partkey:i size:s type:s stamped:b", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, p_type AS type, TRUE AS stamped FROM part"
    ),
    "snk1_table": Query(_table, "s_suppkey:i s_name:s s_nationkey:i s_acctbal:d", "SELECT * FROM supplier"),
    "snk2_view": Query(
        _named, "p_brand:s parts:i top_price:d", "SELECT p_brand, count(*) AS parts, max(p_retailprice) AS top_price FROM part GROUP BY 1"
    ),
    "snk3_append": Query(
        _appended, "event_id:i value:d event_type:s", "SELECT event_id, value, CASE WHEN event_type <> 'click' THEN event_type END AS event_type FROM events"
    ),
    "snk4_export_csv": Query(
        _csv,
        "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s note:s",
        "SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'x' END AS note FROM orders",
    ),
    "prj2_column_variants": Query(
        _variants, "id:i s_name:s balance:d rating:d", "SELECT s_suppkey AS id, s_name, s_acctbal AS balance, CAST(NULL AS DOUBLE) AS rating FROM supplier"
    ),
    "wn2_value_at_highest_lag": Query(
        _latest_by_lag,
        "model_name:s segment:i at_highest_lag:d latest_inference:d",
        """SELECT model_name, segment, max(prediction) FILTER (WHERE a = 1) AS at_highest_lag, max(prediction) FILTER (WHERE b = 1 AND is_inference) AS latest_inference
           FROM (SELECT *, row_number() OVER (PARTITION BY model_name, segment ORDER BY lag DESC, ts DESC, event_id DESC) AS a,
                        row_number() OVER (PARTITION BY model_name, segment, is_inference ORDER BY ts DESC, event_id DESC) AS b FROM stg_payload) x GROUP BY 1, 2""",
    ),
    "so2_preview": Query(
        lambda s, d: summaries.preview(staging.read_table(s, d, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 200),
        "o_orderkey:i o_totalprice:d",
        "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200",
    ),
    "so3_union_missing": Query(
        lambda s, d: catalog.union_all([
            staging.read_table(s, d, "customer").select(F.col("c_name").alias("name"), "c_mktsegment"),
            staging.read_table(s, d, "supplier").select(F.col("s_name").alias("name"), "s_suppkey"),
        ]),
        "name:s c_mktsegment:s s_suppkey:i",
        "SELECT c_name AS name, c_mktsegment, CAST(NULL AS BIGINT) AS s_suppkey FROM customer UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier",
    ),
    "fe11_month_calendar": Query(
        lambda s, d: calendar.month_span(staging.read_table(s, d, "orders"), "o_orderdate"),
        "month:t",
        "SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders), (SELECT date_trunc('month', max(o_orderdate)) FROM orders), INTERVAL 1 MONTH)) AS DATE) AS month",
    ),
    "ag1_monthly_totals": Query(
        lambda s, d: summaries.totals(
            staging.read_table(s, d, "orders").withColumn("month", F.trunc(F.to_date("o_orderdate"), "MM")), ["month", "o_orderstatus"],
            {"total": F.sum("o_totalprice"), "mean": F.avg("o_totalprice"), "orders": F.count("*"), "customers": F.count_distinct("o_custkey")},
        ),
        "month:t o_orderstatus:s total:d mean:d orders:i customers:i",
        "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, sum(o_totalprice) AS total, avg(o_totalprice) AS mean, count(*) AS orders, "
        "count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1, 2",
    ),
    "ag6_distinct_dims": Query(
        lambda s, d: summaries.distinct_rows(staging.stage(s, d, "invoicebase"), ["SystemID", "MajorICDGroupingDescription"]),
        "SystemID:s MajorICDGroupingDescription:s",
        "SELECT DISTINCT SystemID, MajorICDGroupingDescription FROM stg_invoicebase",
    ),
}
