"""Queries over splits, transformers, models and scores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrid.operators import evaluate, forecast, learners, linear, reserving, sampling, splits, transforms, tuning
from lossgrid.plans import scoring
from lossgrid.session import materialise, run_dir
from lossgrid.sources import staging
from lossgrid.workload.claims import gold
from lossgrid.workload.query import Query
from lossgrid.workload.steps import SEGMENTS

SEED = 42
CL_SEGMENTS = [*SEGMENTS, "treatment_date_month"]
LINE_KEYS = "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i"

STEPS = {
    "st_lines": """
        SELECT *, l_returnflag AS flag, l_linestatus AS status, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS gappy,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS gappy_flag FROM lineitem""",
    "st_hashed": """
        SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR)))) - 1 AS rn, count(*) OVER () AS n,
               row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR)))) - 1 AS class_rn,
               count(*) OVER (PARTITION BY o_orderpriority) AS class_n FROM orders""",
    "st_factors": """
        SELECT *, product(factor) OVER (PARTITION BY PolicySubType, SystemID, treatment_date_month ORDER BY lag DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS to_ultimate
        FROM (SELECT PolicySubType, SystemID, treatment_date_month, lag, coalesce(avg(ratio), 1.0) AS factor
              FROM (SELECT *, CASE WHEN cumulative_amount_paid > 0 THEN lead(cumulative_amount_paid) OVER (PARTITION BY PolicySubType, SystemID, treatment_date_month, treatment_date ORDER BY lag)
                           / cumulative_amount_paid END AS ratio FROM st_gold) r GROUP BY ALL) f""",
    "st_ols": """
        SELECT l_returnflag, l_linestatus, count(*) AS rows, regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_slope(l_extendedprice, l_quantity) AS slope
        FROM lineitem GROUP BY 1, 2""",
    "st_thresholds": """
        SELECT t.threshold, count(*) FILTER (WHERE score > threshold AND label = 1) AS tp, count(*) FILTER (WHERE score > threshold AND label = 0) AS fp,
               count(*) FILTER (WHERE score <= threshold AND label = 1) AS fn, count(*) FILTER (WHERE score <= threshold AND label = 0) AS tn
        FROM stg_scores CROSS JOIN (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(1, 100) r(i)) t GROUP BY 1""",
}
STEPS["st_sweep"] = """
        SELECT threshold, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
               fp AS false_positives, fn AS false_negatives FROM st_thresholds"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.run_sql(spark, sf_dir, STEPS["st_lines"].replace("FROM lineitem", "FROM {lineitem}"))


def _table(name: str):
    return lambda spark, sf_dir: staging.read_table(spark, sf_dir, name)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.read_table(spark, sf_dir, "orders")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(spark, sf_dir, "scores")


def _hard_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).withColumn("guess", (F.col("score") > 0.5).cast("int"))


def _guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).withColumn("guess", F.col("l_quantity") * 1500)


def _regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.regression_metrics(_guessed(spark, sf_dir), "l_extendedprice", "guess")


def _tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _regression(spark, sf_dir)
    counted = _lines(spark, sf_dir).agg(F.count("*").alias("val_rows"))
    wide = wide.withColumn("val_rows", counted.scalar()).withColumn("val_features", F.lit(1)).withColumn("broken", F.lit(float("inf")))
    names = ["rmse", "mse", "r2", "explained_variance", "val_rows", "val_features", "broken"]
    return evaluate.tall_metrics(wide, names, {"run": F.lit("run1"), "model_version": F.lit(1)})


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(
        [("rmse", "<=", 1e9), ("r2", ">=", 0.99), ("rmse", "!=", 1.0), ("broken", ">", 0.0), ("absent", ">", 0.0), ("val_features", "==", 1.0)],
        "metric_name string, op string, bound double",
    )
    return evaluate.gate_report(_tall(spark, sf_dir), rules)


def _impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    shown = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "gappy_flag", *[F.col("gappy").alias(f"by_{s}") for s in ("mean", "median", "constant")]
    )
    for strategy in ("mean", "median", "constant"):
        shown = transforms.fit_impute(shown, [f"by_{strategy}"], strategy, -1.0).transform(shown)
    return transforms.fit_impute(shown, ["gappy_flag"], "most_frequent").transform(shown)


def _clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.col("l_extendedprice").alias(c) for c in ("by_percentile", "by_range", "by_value")]
    )
    lines = transforms.fit_clip(lines, ["by_percentile"]).transform(lines)
    lines = transforms.fit_clip(lines, ["by_range"], "median_range").transform(lines)
    return transforms.fit_clip(lines, ["by_value"], "fixed_values", 1000.0, 20000.0).transform(lines)


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    blocks = [([transforms.fit_clip, transforms.fit_standard], ["l_extendedprice"]), ([transforms.fit_min_max], ["l_quantity"])]
    return transforms.column_transformer(lines, blocks, ["l_tax"])[0]


def _target_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    fitted = transforms.fit_robust(lines, ["l_extendedprice"])
    scaled = fitted.transform(lines).withColumnRenamed("l_extendedprice", "scaled").withColumn("prediction", F.col("scaled") * 2)
    return fitted.invert(scaled, "prediction", "l_extendedprice")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("value"))
    fitted = transforms.fit_log1p(["value"])
    logged = fitted.transform(lines).withColumn("back", F.col("value"))
    return fitted.invert(logged, "back", "value")


def _scaled(fit):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = _lines(spark, sf_dir)
        return fit(lines, ["l_quantity", "l_extendedprice"]).transform(lines)

    return build


def _ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear.segment_fit(_lines(spark, sf_dir), ["l_returnflag", "l_linestatus"], ["l_quantity"], "l_extendedprice")


def _factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reserving.chain_ladder_fit(gold(spark, sf_dir), "cumulative_amount_paid", CL_SEGMENTS)


def _chain_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(gold(spark, sf_dir))  # read by the fit and by the prediction
    factors = reserving.chain_ladder_fit(rows, "cumulative_amount_paid", CL_SEGMENTS)
    return reserving.chain_ladder_predict(rows.where("is_inference"), factors, "cumulative_amount_paid", CL_SEGMENTS)


def _huber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a very large delta no error is cut, so the fit is the ridge regression on the scaled columns."""
    rows = _lines(spark, sf_dir)
    models = reserving.huber_fit(rows, ["l_quantity"], "l_extendedprice", ["l_returnflag"], delta=1e12, alpha=1.0)
    return reserving.huber_predict(rows, models, ["l_quantity"], "l_extendedprice", ["l_returnflag"])


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel of monthly order value per market segment, with the order count as a regressor."""
    orders = _orders(spark, sf_dir).join(staging.read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    month = F.trunc(F.to_date("o_orderdate"), "MM").alias("month")
    return orders.groupBy("c_mktsegment", month).agg(F.sum("o_totalprice").alias("sales"), F.count("*").alias("orders"))


# days of orders per priority with a value made of a line and one yearly wave, whose size follows from the table
WAVE_SQL = """
    SELECT o_orderpriority, day, level + 0.01 * level * n / 100 + 0.2 * level * sin(2 * pi() * n / 365.25) AS value
    FROM (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS day, datediff(CAST(o_orderdate AS DATE), DATE'1970-01-01') AS n, max(o_orderkey) OVER (PARTITION BY o_orderpriority) * 1.0 AS level FROM {orders}) x"""


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = staging.run_sql(spark, sf_dir, WAVE_SQL)
    configs = panel.select("o_orderpriority").distinct().withColumn("config", F.create_map(F.lit("yearly_seasonality"), F.lit("true")))
    models = forecast.trend_seasonal_fit(panel, ["o_orderpriority"], "day", "value", configs=configs)
    fitted = forecast.trend_seasonal_predict(panel, models, ["o_orderpriority"], "day")
    close = F.abs(F.col("prediction") - F.col("value")) <= 0.01 * F.abs("value")
    return fitted.groupBy("o_orderpriority").agg(F.count("*").alias("days"), F.count_if(close).alias("close"))


def _autoregression(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = monthly_sales(spark, sf_dir)
    models = forecast.ar_fit(panel, "c_mktsegment", "month", "orders", 1, 1, 2.0)
    return forecast.ar_forecast(panel, models, "c_mktsegment", "month", "orders", 1, 1)


FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a 0/1 feature, missing in some, and a label: what every learner fits in closed form is a mean per value."""
    heavy = F.when(F.col("l_partkey") % 7 != 0, (F.col("l_quantity") > 25).cast("double"))
    return _lines(spark, sf_dir).withColumn("returned", (F.col("l_returnflag") == "R").cast("double")).withColumn("heavy", heavy)


def _learner(task: str, kind: str, **params):
    label = "returned" if task == "classification" else "l_extendedprice"

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _returned(spark, sf_dir)
        scored = learners.predict(learners.fit_learner(rows, ["heavy"], label, task, kind, **params), rows)
        return scored.withColumn("p", F.element_at("probability", 2)) if "probability" in scored.columns else scored

    return build


def _early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _returned(spark, sf_dir)
    rows = materialise(splits.random_split(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], SEED, 0.1, 0.2))
    model = learners.fit_early_stopping(rows, ["heavy"], "l_extendedprice", "regression", maxIter=1, maxDepth=1)
    return learners.predict(model, rows)


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).withColumn("fold", (F.col("l_orderkey") % 3).cast("int"))


def _cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.cross_validate(_folded(spark, sf_dir), "fold", ["l_quantity"], "l_extendedprice", ALPHAS, ["l_returnflag"])


def _learner_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _returned(spark, sf_dir).withColumn("fold", (F.col("l_orderkey") % 3).cast("int"))
    tuned = learners.tune_learner(rows, ["heavy"], "l_extendedprice", "regression", "ridge", {"regParam": [0.0, 20000.0]}, 3, "fold", "rmse", solver="normal")
    return learners.search_table(spark, tuned).withColumn("penalty", F.col("params")["regParam"].cast("double"))


def _halving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.successive_halving(_folded(spark, sf_dir), ["l_orderkey"], "fold", ["l_quantity"], "l_extendedprice", ALPHAS)


ALPHAS = [10.0**i for i in range(9)]
# sums of each fold, and error of the ridge line of the other folds on it, for one feature
FOLD_SQL = """
    t AS (SELECT {by} sum(n) AS n, sum(x) AS x, sum(y) AS y, sum(xx) AS xx, sum(xy) AS xy, sum(yy) AS yy FROM f GROUP BY {group}),
    r AS (SELECT {tby} alpha, f.n AS hn, f.x AS hx, f.y AS hy, f.xx AS hxx, f.xy AS hxy, f.yy AS hyy, t.n - f.n AS n, t.x - f.x AS x, t.y - f.y AS y, t.xx - f.xx AS xx, t.xy - f.xy AS xy
          FROM f JOIN t ON {same} CROSS JOIN (SELECT CAST(power(10, i) AS DOUBLE) AS alpha FROM range(0, 9) a(i)) a),
    b AS (SELECT *, (xy - x * y / n) / (xx - x * x / n + alpha) AS slope FROM r),
    c AS (SELECT *, y / n - slope * x / n AS cut FROM b),
    scored AS (SELECT {by} alpha, avg(sqrt((hyy + cut * cut * hn + slope * slope * hxx - 2 * cut * hy - 2 * slope * hxy + 2 * cut * slope * hx) / hn)) AS rmse FROM c GROUP BY {rgroup})"""
FOLD_SUMS = "count(*) * 1.0 AS n, sum(l_quantity) AS x, sum(l_extendedprice) AS y, sum(l_quantity * l_quantity) AS xx, sum(l_quantity * l_extendedprice) AS xy, sum(l_extendedprice * l_extendedprice) AS yy"


def _rung_sql(rung: int) -> str:
    """Scores of all penalties on the rows of a rung, as a subquery."""
    sums = f"SELECT l_orderkey % 3 AS fold, {FOLD_SUMS} FROM (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', '0', CAST(l_orderkey AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0 AS share FROM lineitem) l WHERE share < {3.0 ** (rung - 2)!r} GROUP BY 1"
    folds = FOLD_SQL.format(by="", group="ALL", tby="", same="TRUE", rgroup="alpha")
    return f"(WITH f AS ({sums}), {folds} SELECT * FROM scored)"


def _segment_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = staging.read_table(spark, sf_dir, "customer")
    rows = customer.select("c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    configs = staging.run_sql(spark, sf_dir, CONFIG_SQL)
    return linear.segment_config(rows, configs, ["c_mktsegment", "nation"], "default")


CONFIG_SQL = """
    SELECT DISTINCT CASE WHEN c_nationkey % 3 = 0 THEN concat('(''', c_mktsegment, ''', ''', CAST(c_nationkey AS STRING), ''')')
                         WHEN c_nationkey % 3 = 1 THEN concat_ws('__', c_mktsegment, CAST(c_nationkey AS STRING))
                         ELSE concat_ws('-', c_mktsegment, CAST(c_nationkey AS STRING)) END AS segment_key, concat('cfg', CAST(c_nationkey AS STRING)) AS config
    FROM {customer}"""


def _batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    models = linear.segment_fit(lines, ["l_returnflag", "l_linestatus"], ["l_quantity"], "l_extendedprice")
    return scoring.batch_score(
        lines, models, ["l_returnflag", "l_linestatus"], ["l_quantity"], ["l_extendedprice", "l_tax"], "l_shipdate", 0.75, "m1",
        F.lit("2001-08-15").cast("timestamp"),
    )


def _probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = _scores(spark, sf_dir).withColumn("other", 1 - F.col("score"))
    scored = evaluate.with_probabilities(two, ["0", "1"], ["other", "score"])
    return scored.withColumn("p0", F.col("prediction_proba")["0"]).withColumn("p1", F.col("prediction_proba")["1"])


def _probability_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of class 1 out of a list, JSON text and a bare number; text that cannot be read gives none."""
    score = F.col("score")
    rows = _scores(spark, sf_dir).select(
        "doc_id", F.array(1 - score, score).alias("listed"), F.format_string('{"0": %.3f, "1": %.3f}', 1 - score, score).alias("text"),
        F.format_string(" %.3f ", score).alias("number"), F.lit("no number").alias("broken"),
    )
    for name, form in (("from_list", "listed"), ("from_text", "text"), ("from_number", "number"), ("unreadable", "broken")):
        parsed = evaluate.parsed_probabilities(rows, form).withColumnRenamed("prediction_proba", "_map")
        rows = parsed.withColumn(name, F.col("_map").isNull() if form == "broken" else F.col("_map")["0" if form == "number" else "1"]).drop("_map")
    return rows


def _appended_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to one table, the second with a column the first has not."""
    path = f"{run_dir(spark)}/scores-{uuid.uuid4().hex}"
    scored = materialise(_batch_score(spark, sf_dir))
    scoring.append_scores(scored, path)
    return scoring.append_scores(scored.withColumn("model_id", F.lit("m2")).withColumn("proba", F.lit(0.5)), path)


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = splits.random_split(_probabilities(spark, sf_dir), ["doc_id"], SEED, 0.25)
    table = evaluate.baseline_table(labelled, "label", "m1", "int")
    return table.withColumn("p_one", F.col("probability")["1"])


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.run_sql(
        spark, sf_dir,
        "SELECT p_brand AS model_name, CAST(p_partkey AS STRING) AS version, CASE WHEN p_size = 7 THEN 'champion' END AS alias FROM {part}",
    )


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir).join(staging.read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text"), "doc_id")
    return rows.select("doc_id", "label", "score", F.log1p("n_chars").alias("size"), F.size(F.split("text", " ")).cast("double").alias("words"))


def _smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance the doubtful documents by their length and lexical features."""
    return sampling.smote(_featured(spark, sf_dir), ["score", "size", "words"], "label", 0, ["doc_id"], 5, SEED)


def _balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class before and after."""
    rows = materialise(_featured(spark, sf_dir))
    extra = sampling.smote(rows, ["score", "size", "words"], "label", 0, ["doc_id"], 5, SEED)
    both = rows.select("label", F.lit(0).alias("made")).unionAll(extra.select("label", F.lit(1).alias("made")))
    return both.groupBy("label").agg(F.count("*").alias("rows"))


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other distinct points of every distinct point (length, words), as distances by rank."""
    points = _featured(spark, sf_dir).select(F.col("score").cast("double").alias("x"), "words").distinct()
    keyed = points.withColumn("_id", F.concat_ws("|", F.col("x").cast("decimal(10,3)").cast("string"), F.col("words").cast("int").cast("string")))
    near = sampling.nearest_neighbours(keyed, ["x", "words"], 5, SEED)
    return near.select("_id", F.posexplode("near").alias("place", "n")).select(F.col("_id").alias("id"), (F.col("place") + 1).alias("rank"), F.col("n.distance").alias("distance"))


def _wrap(fold):
    return lambda s, d: fold(_orders(s, d))


MEANS_SQL = """
    WITH r AS (SELECT *, CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_quantity > 25 AS DOUBLE) END AS heavy, CAST(l_returnflag = 'R' AS DOUBLE) AS returned FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {shown} FROM (SELECT *, CASE WHEN heavy IS NOT NULL THEN avg({target}) OVER (PARTITION BY heavy) END AS fitted FROM r) x"""

QUERIES = {
    "sp1_drop_null_target": Query(
        lambda s, d: splits.drop_null_target(staging.stage(s, d, "invoicebase"), "PaidDate"),
        "InvoiceKey:s tie1:i tie2:i PaidDate:t AmountPaid:d",
        "SELECT * FROM stg_invoicebase WHERE PaidDate IS NOT NULL",
    ),
    "sp2_random_split": Query(
        _wrap(lambda df: splits.random_split(df, ["o_orderkey"], SEED, 0.1, 0.1)),
        "o_orderkey:i split_name:s",
        "SELECT o_orderkey, CASE WHEN rn < ceil(n * 0.1) THEN 'test' WHEN rn < ceil(n * 0.1) + ceil((n - ceil(n * 0.1)) * 0.1) THEN 'val' ELSE 'train' END AS split_name FROM st_hashed",
    ),
    "sp3_stratified_split": Query(
        _wrap(lambda df: splits.random_split(df, ["o_orderkey"], SEED, 0.2, None, "o_orderpriority")),
        "o_orderkey:i o_orderpriority:s split_name:s",
        "SELECT o_orderkey, o_orderpriority, CASE WHEN class_rn < ceil(class_n * 0.2) THEN 'test' ELSE 'train' END AS split_name FROM st_hashed",
    ),
    "sp4_time_split": Query(
        _wrap(lambda df: splits.time_split(df, "o_orderdate", 0.75, 0.1)),
        "o_orderkey:i o_orderdate:t split_name:s",
        """SELECT o_orderkey, o_orderdate, CASE WHEN r >= floor(n * 0.75) THEN 'test' WHEN r >= floor(floor(n * 0.75) * (1 - 0.1)) THEN 'val' ELSE 'train' END AS split_name
           FROM (SELECT *, dense_rank() OVER (ORDER BY o_orderdate) - 1 AS r, (SELECT CAST(count(DISTINCT o_orderdate) AS DOUBLE) FROM orders) AS n FROM orders) x""",
    ),
    "sp5_cutoff_split": Query(
        _wrap(lambda df: splits.cutoff_split(df, "o_orderdate", "2000-01-01", "1999-06-01")),
        "o_orderkey:i split_name:s",
        "SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN 'test' WHEN o_orderdate >= DATE '1999-06-01' THEN 'val' ELSE 'train' END AS split_name FROM orders",
    ),
    "sp8_k_fold": Query(
        _wrap(lambda df: splits.k_folds(df, "o_orderkey", 7)),
        "o_orderkey:i fold:i",
        """SELECT o_orderkey, CASE WHEN rn < (n % 7) * (n // 7 + 1) THEN rn // (n // 7 + 1) ELSE n % 7 + (rn - (n % 7) * (n // 7 + 1)) // (n // 7) END AS fold
           FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders) x""",
    ),
    "sp8_stratified_k_fold": Query(
        _wrap(lambda df: splits.stratified_k_folds(df, "o_orderpriority", "o_orderkey", 3)),
        "o_orderkey:i o_orderpriority:s fold:i",
        """SELECT o.o_orderkey, o.o_orderpriority, CASE WHEN o.rn < a0 THEN 0 WHEN o.rn < a0 + a1 THEN 1 ELSE 2 END AS fold
           FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS rn FROM orders) o
           JOIN (SELECT o_orderpriority, count(*) FILTER (WHERE place % 3 = 0) AS a0, count(*) FILTER (WHERE place % 3 = 1) AS a1
                 FROM (SELECT o_orderpriority, row_number() OVER (ORDER BY first_key) - 1 AS place
                       FROM (SELECT o_orderpriority, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS first_key FROM orders) f) p GROUP BY 1) a
             ON a.o_orderpriority = o.o_orderpriority""",
    ),
    "sp8_expanding_folds": Query(
        lambda s, d: splits.expanding_folds(staging.read_table(s, d, "events"), "event_id", 3),
        "event_id:i fold:i role:s",
        """SELECT event_id, fold, CASE WHEN rn < n - (3 - fold) * (n // 4) THEN 'train' ELSE 'test' END AS role
           FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS rn, count(*) OVER () AS n FROM events) x CROSS JOIN (VALUES (0), (1), (2)) f(fold)
           WHERE rn < n - (3 - fold) * (n // 4) + n // 4""",
    ),
    "tr1_min_max": Query(
        _scaled(transforms.fit_min_max),
        f"{LINE_KEYS} l_quantity:d l_extendedprice:d",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()) AS l_quantity,
                  (l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()) AS l_extendedprice FROM lineitem""",
    ),
    "tr2_standard": Query(
        _scaled(transforms.fit_standard),
        f"{LINE_KEYS} l_quantity:d l_extendedprice:d",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS l_quantity,
                  (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS l_extendedprice FROM lineitem""",
    ),
    "tr3_robust": Query(
        _scaled(transforms.fit_robust),
        f"{LINE_KEYS} l_quantity:d l_extendedprice:d",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - m1) / r1 AS l_quantity, (l_extendedprice - m2) / r2 AS l_extendedprice
           FROM lineitem CROSS JOIN (SELECT median(l_quantity) AS m1, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS r1,
                median(l_extendedprice) AS m2, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS r2 FROM lineitem) q""",
    ),
    "tr3_segment_scales": Query(
        lambda s, d: transforms.segment_robust_scales(_lines(s, d), ["l_quantity", "l_extendedprice"], ["l_returnflag", "l_linestatus"]),
        "l_returnflag:s l_linestatus:s feature:s center:d scale:d",
        " UNION ALL ".join(
            f"SELECT l_returnflag, l_linestatus, '{c}' AS feature, median({c}) AS center, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS scale FROM lineitem GROUP BY 1, 2"
            for c in ("l_quantity", "l_extendedprice")
        ),
    ),
    "tr4_quantile": Query(
        lambda s, d: transforms.fit_quantile(_orders(s, d), ["o_totalprice"], 200).transform(_orders(s, d)),
        "o_orderkey:i o_totalprice:d",
        f"""WITH k AS (SELECT unnest(range(0, 200)) AS i, unnest(q) AS knot FROM (SELECT quantile_cont(o_totalprice, {[i / 199 for i in range(200)]}) AS q FROM orders) l),
                d AS (SELECT knot, min(i) AS first, max(i) AS last FROM k GROUP BY knot),
                e AS (SELECT knot, first, last, lead(knot) OVER (ORDER BY knot) AS next_knot, lead(first) OVER (ORDER BY knot) AS next_first FROM d)
           SELECT o_orderkey, CASE WHEN o_totalprice = knot THEN (first + last) / 2.0 / 199 ELSE (last + (o_totalprice - knot) / (next_knot - knot) * (next_first - last)) / 199 END AS o_totalprice
           FROM orders ASOF JOIN e ON o_totalprice >= knot""",
    ),
    "tr5_one_hot": Query(
        lambda s, d: transforms.one_hot(_lines(s, d), "flag"),
        f"{LINE_KEYS} flag_A:i flag_N:i flag_R:i",
        "SELECT *, CAST(flag = 'A' AS INT) AS flag_A, CAST(flag = 'N' AS INT) AS flag_N, CAST(flag = 'R' AS INT) AS flag_R FROM st_lines",
    ),
    "tr6_ordinal": Query(
        lambda s, d: transforms.ordinal(staging.read_table(s, d, "part"), "p_name"),
        "p_partkey:i p_name:s p_name_code:i",
        "SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS p_name_code FROM part",
    ),
    "tr7_impute": Query(
        _impute,
        f"{LINE_KEYS} by_mean:d by_median:d by_constant:d gappy_flag:s",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(gappy, avg(gappy) OVER ()) AS by_mean, coalesce(gappy, (SELECT median(gappy) FROM st_lines)) AS by_median,
                  coalesce(gappy, -1) AS by_constant, coalesce(gappy_flag, (SELECT gappy_flag FROM st_lines WHERE gappy_flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS gappy_flag
           FROM st_lines""",
    ),
    "tr8_log": Query(
        _log,
        f"{LINE_KEYS} value:d back:d",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ln(1 + l_extendedprice) AS value, l_extendedprice AS back FROM lineitem",
    ),
    "tr9_clip": Query(
        _clipped,
        f"{LINE_KEYS} by_percentile:d by_range:d by_value:d",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(least(l_extendedprice, p99), p1) AS by_percentile,
                  greatest(least(l_extendedprice, m + h), m - h) AS by_range, greatest(least(l_extendedprice, 20000), 1000) AS by_value
           FROM lineitem CROSS JOIN (SELECT quantile_cont(l_extendedprice, 0.01) AS p1, quantile_cont(l_extendedprice, 0.99) AS p99, median(l_extendedprice) AS m,
                (max(l_extendedprice) - min(l_extendedprice)) / 2 AS h FROM lineitem) q""",
    ),
    "tr11_column_transformer": Query(
        _columns,
        f"{LINE_KEYS} l_quantity:d l_extendedprice:d l_discount:d",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()) AS l_quantity,
                  (c - avg(c) OVER ()) / stddev_pop(c) OVER () AS l_extendedprice, l_discount
           FROM (SELECT *, greatest(least(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)), (SELECT quantile_cont(l_extendedprice, 0.01) FROM lineitem)) AS c FROM lineitem) x""",
    ),
    "tr12_target_transform": Query(
        _target_round_trip,
        f"{LINE_KEYS} scaled:d prediction:d",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_extendedprice - m) / r AS scaled, 2 * (l_extendedprice - m) + m AS prediction
           FROM lineitem CROSS JOIN (SELECT median(l_extendedprice) AS m, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS r FROM lineitem) q""",
    ),
    "tr13_smote": Query(_smote, "score:d size:d words:d label:i"),
    "tr13_class_sizes": Query(
        _balanced, "label:i rows:i", "SELECT label, (SELECT max(n) FROM (SELECT count(*) AS n FROM stg_scores GROUP BY label) x) AS rows FROM stg_scores GROUP BY 1"
    ),
    "tr13_neighbours": Query(
        _neighbours,
        "id:s rank:i distance:d",
        """WITH p AS (SELECT DISTINCT score AS x, CAST(len(string_split(text, ' ')) AS DOUBLE) AS words FROM stg_scores JOIN documents USING (doc_id))
           SELECT concat_ws('|', CAST(CAST(x AS DECIMAL(10, 3)) AS VARCHAR), CAST(CAST(words AS INT) AS VARCHAR)) AS id, rank, distance
           FROM (SELECT a.x, a.words, sqrt((a.x - b.x) ** 2 + (a.words - b.words) ** 2) AS distance,
                        row_number() OVER (PARTITION BY a.x, a.words ORDER BY (a.x - b.x) ** 2 + (a.words - b.words) ** 2) AS rank
                 FROM p a JOIN p b ON a.x <> b.x OR a.words <> b.words) n WHERE rank <= 5""",
    ),
    "wn6_age_to_age": Query(
        lambda s, d: reserving.age_to_age(gold(s, d), "cumulative_amount_paid", CL_SEGMENTS),
        "PolicySubType:s SystemID:s treatment_date:t lag:i ratio:d",
        """SELECT *, CASE WHEN cumulative_amount_paid > 0 THEN lead(cumulative_amount_paid) OVER (PARTITION BY PolicySubType, SystemID, treatment_date ORDER BY lag) / cumulative_amount_paid END AS ratio
           FROM st_gold""",
    ),
    "ml1_chain_ladder_fit": Query(
        _factors, "PolicySubType:s SystemID:s treatment_date_month:i lag:i factor:d to_ultimate:d", "SELECT * FROM st_factors"
    ),
    "wn7_reverse_product": Query(
        lambda s, d: reserving.chain_ladder_fit(gold(s, d), "cumulative_nb_invoice_paid", SEGMENTS),
        "PolicySubType:s SystemID:s lag:i to_ultimate:d",
        """SELECT PolicySubType, SystemID, lag, product(factor) OVER (PARTITION BY PolicySubType, SystemID ORDER BY lag DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS to_ultimate
           FROM (SELECT PolicySubType, SystemID, lag, coalesce(avg(ratio), 1.0) AS factor
                 FROM (SELECT *, CASE WHEN cumulative_nb_invoice_paid > 0 THEN lead(cumulative_nb_invoice_paid) OVER (PARTITION BY PolicySubType, SystemID, treatment_date ORDER BY lag)
                              / CAST(cumulative_nb_invoice_paid AS DOUBLE) END AS ratio FROM st_gold) r GROUP BY ALL) f""",
    ),
    "ml2_chain_ladder_predict": Query(
        _chain_ladder,
        "PolicySubType:s SystemID:s treatment_date:t lag:i cumulative_amount_paid:d prediction:d",
        """SELECT g.PolicySubType, g.SystemID, g.treatment_date, g.lag, g.cumulative_amount_paid, g.cumulative_amount_paid * coalesce(f.to_ultimate, 1.0) AS prediction
           FROM st_gold g LEFT JOIN st_factors f USING (PolicySubType, SystemID, treatment_date_month, lag) WHERE g.is_inference""",
    ),
    "ml3_segment_fit": Query(
        lambda s, d: _ols(s, d).select("l_returnflag", "l_linestatus", "rows", F.col("coef")[0].alias("intercept"), F.col("coef")[1].alias("slope")),
        "l_returnflag:s l_linestatus:s rows:i intercept:d slope:d",
        "SELECT * FROM st_ols",
    ),
    "ml4_segment_predict": Query(
        lambda s, d: linear.segment_predict(_lines(s, d), _ols(s, d), ["l_returnflag", "l_linestatus"], ["l_quantity"]),
        f"{LINE_KEYS} prediction:d",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, intercept + slope * l_quantity AS prediction FROM lineitem JOIN st_ols USING (l_returnflag, l_linestatus)",
    ),
    "ml5_segment_config": Query(
        _segment_config,
        "c_mktsegment:s nation:s config:s",
        "SELECT DISTINCT c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation, CASE WHEN c_nationkey % 3 = 2 THEN 'default' ELSE concat('cfg', c_nationkey) END AS config FROM customer",
    ),
    "ml6_robust_regression": Query(
        _huber,
        f"{LINE_KEYS} prediction:d",
        """WITH s AS (SELECT l_returnflag, median(l_quantity) AS mx, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS rx,
                          median(l_extendedprice) AS my, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS ry FROM lineitem GROUP BY 1),
                z AS (SELECT l.*, (l_quantity - mx) / rx AS x, (l_extendedprice - my) / ry AS y, my, ry FROM lineitem l JOIN s USING (l_returnflag)),
                b AS (SELECT l_returnflag, avg(x) AS ax, avg(y) AS ay, covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 1) AS slope FROM z GROUP BY 1)
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (ay + slope * (x - ax)) * ry + my AS prediction FROM z JOIN b USING (l_returnflag)""",
    ),
    "ml7_trend_seasonal": Query(
        _trend, "o_orderpriority:s days:i close:i", "SELECT o_orderpriority, count(DISTINCT o_orderdate) AS days, count(DISTINCT o_orderdate) AS close FROM orders GROUP BY 1"
    ),
    "ml8_autoregression": Query(
        _autoregression,
        "c_mktsegment:s month:t prediction:d",
        """WITH m AS (SELECT c_mktsegment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(count(*) AS DOUBLE) AS y FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
                p AS (SELECT a.c_mktsegment, b.y AS x, a.y FROM m a JOIN m b ON a.c_mktsegment = b.c_mktsegment AND a.month = b.month + INTERVAL 1 MONTH),
                w AS (SELECT c_mktsegment, avg(x) AS ax, avg(y) AS ay, covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 2) AS slope FROM p GROUP BY 1)
           SELECT c_mktsegment, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, ay + slope * (y - ax) AS prediction
           FROM (SELECT *, max(month) OVER (PARTITION BY c_mktsegment) AS newest FROM m) l JOIN w USING (c_mktsegment) WHERE month = newest""",
    ),
    "ml9_random_forest": Query(
        _learner("classification", "random_forest", numTrees=1, maxDepth=1, seed=1, bootstrap=False, featureSubsetStrategy="all"),
        f"{LINE_KEYS} returned:i p:d prediction:d",
        # leaves that predict the same class are merged
        "SELECT * REPLACE (CASE WHEN p IS NULL OR min(prediction) OVER () < max(prediction) OVER () THEN p ELSE avg(CASE WHEN p IS NOT NULL THEN returned END) OVER () END AS p) FROM ("
        + MEANS_SQL.format(target="returned", shown="CAST(returned AS INT) AS returned, fitted AS p, CAST(fitted > 0.5 AS INT) AS prediction") + ") m",
    ),
    "ml9_logistic": Query(
        _learner("classification", "logistic", maxIter=200, tol=1e-12),
        f"{LINE_KEYS} returned:i p:d prediction:d",
        MEANS_SQL.format(target="returned", shown="CAST(returned AS INT) AS returned, fitted AS p, CAST(fitted > 0.5 AS INT) AS prediction"),
    ),
    "ml9_ridge": Query(
        _learner("regression", "ridge", regParam=1000.0, solver="normal"),
        f"{LINE_KEYS} l_extendedprice:d prediction:d",
        """WITH r AS (SELECT *, CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_quantity > 25 AS DOUBLE) END AS heavy FROM lineitem),
                b AS (SELECT avg(heavy) AS ax, avg(l_extendedprice) AS ay,
                             covar_pop(heavy, l_extendedprice) / (var_pop(heavy) * (1 + 1000 / stddev_pop(l_extendedprice))) AS slope FROM r WHERE heavy IS NOT NULL)
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, ay + slope * (heavy - ax) AS prediction FROM r CROSS JOIN b""",
    ),
    "ml9_gradient_boosting": Query(
        _learner("regression", "gradient_boosting", maxIter=1, maxDepth=1, seed=1),
        f"{LINE_KEYS} l_extendedprice:d prediction:d",
        MEANS_SQL.format(target="l_extendedprice", shown="l_extendedprice, fitted AS prediction"),
    ),
    "ml10_early_stopping": Query(
        _early_stop,
        f"{LINE_KEYS} split_name:s prediction:d",
        """WITH h AS (SELECT *, CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_quantity > 25 AS DOUBLE) END AS heavy, count(*) OVER () AS n,
                          row_number() OVER (ORDER BY md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey))) - 1 AS rn FROM lineitem),
                s AS (SELECT *, CASE WHEN rn < ceil(n * 0.1) THEN 'test' WHEN rn < ceil(n * 0.1) + ceil((n - ceil(n * 0.1)) * 0.2) THEN 'val' ELSE 'train' END AS split_name FROM h)
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split_name, CASE WHEN heavy IS NOT NULL THEN avg(l_extendedprice) FILTER (WHERE split_name = 'train') OVER (PARTITION BY heavy) END AS prediction FROM s""",
    ),
    "ml11_threshold_sweep": Query(
        lambda s, d: evaluate.threshold_sweep(_scores(s, d), "label", "score"),
        "threshold:d accuracy:d f1:d false_positives:i false_negatives:i",
        "SELECT * FROM st_sweep",
    ),
    "ml11_best_threshold": Query(
        lambda s, d: evaluate.best_threshold(evaluate.threshold_sweep(_scores(s, d), "label", "score"), "f1"),
        "threshold:d score:d",
        "SELECT threshold, f1 AS score FROM st_sweep ORDER BY f1 DESC, threshold LIMIT 1",
    ),
    "ml13_cross_validate": Query(
        _cross_validate,
        "l_returnflag:s alpha:d rmse:d best:b",
        f"WITH f AS (SELECT l_returnflag, l_orderkey % 3 AS fold, {FOLD_SUMS} FROM lineitem GROUP BY 1, 2), "
        + FOLD_SQL.format(by="l_returnflag,", group="l_returnflag", tby="f.l_returnflag,", same="f.l_returnflag = t.l_returnflag", rgroup="l_returnflag, alpha")
        + " SELECT l_returnflag, alpha, rmse, row_number() OVER (PARTITION BY l_returnflag ORDER BY rmse, alpha) = 1 AS best FROM scored",
    ),
    "ml13_learner_search": Query(
        _learner_search,
        "penalty:d score:d best:b",
        """WITH r AS (SELECT l_orderkey % 3 AS fold, CAST(l_quantity > 25 AS DOUBLE) AS x, l_extendedprice AS y FROM lineitem WHERE l_partkey % 7 <> 0),
                b AS (SELECT f.fold, p.penalty, avg(x) AS ax, avg(y) AS ay, covar_pop(x, y) / (var_pop(x) * (1 + p.penalty / stddev_pop(y))) AS slope
                      FROM r JOIN (VALUES (0), (1), (2)) f(fold) ON r.fold <> f.fold CROSS JOIN (VALUES (0.0), (20000.0)) p(penalty) GROUP BY 1, 2),
                e AS (SELECT b.fold, penalty, sqrt(avg((y - ay - slope * (x - ax)) ** 2)) AS rmse FROM r JOIN b USING (fold) GROUP BY 1, 2),
                s AS (SELECT penalty, avg(rmse) AS score FROM e GROUP BY 1)
           SELECT CAST(penalty AS DOUBLE) AS penalty, score, score = (SELECT min(score) FROM s) AS best FROM s""",
    ),
    "ml14_successive_halving": Query(
        _halving,
        "alpha:d rung:i rmse:d",
        f"""WITH a AS (SELECT *, row_number() OVER (ORDER BY rmse, alpha) AS place FROM {_rung_sql(0)} x),
                 b AS (SELECT x.*, row_number() OVER (ORDER BY x.rmse, x.alpha) AS place FROM {_rung_sql(1)} x WHERE alpha IN (SELECT alpha FROM a WHERE place <= 3)),
                 c AS (SELECT * FROM {_rung_sql(2)} x WHERE alpha IN (SELECT alpha FROM b WHERE place <= 1))
            SELECT alpha, 0 AS rung, rmse FROM a WHERE place > 3 UNION ALL SELECT alpha, 1, rmse FROM b WHERE place > 1 UNION ALL SELECT alpha, 2, rmse FROM c""",
    ),
    "ml15_probabilities": Query(
        _probabilities,
        "doc_id:i label:i prediction:s p0:d p1:d",
        "SELECT doc_id, label, CASE WHEN 1 - score >= score THEN '0' ELSE '1' END AS prediction, 1 - score AS p0, score AS p1 FROM stg_scores",
    ),
    "ml15_probability_forms": Query(
        _probability_forms,
        "doc_id:i from_list:d from_text:d from_number:d unreadable:b",
        "SELECT doc_id, score AS from_list, score AS from_text, score AS from_number, TRUE AS unreadable FROM stg_scores",
    ),
    "ev1_regression": Query(
        _regression,
        "rmse:d mse:d r2:d explained_variance:d",
        """SELECT sqrt(avg(e * e)) AS rmse, avg(e * e) AS mse, 1 - avg(e * e) / var_pop(y) AS r2, 1 - var_pop(e) / var_pop(y) AS explained_variance
           FROM (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 1500 AS e FROM lineitem) x""",
    ),
    "ev2_classification": Query(
        lambda s, d: evaluate.classification_metrics(_hard_scores(s, d), "label", "guess"),
        "accuracy:d precision:d recall:d f1:d false_positives:i false_negatives:i",
        """SELECT (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(tp + fn AS DOUBLE) AS recall,
                  2.0 * tp / (2 * tp + fp + fn) AS f1, fp AS false_positives, fn AS false_negatives FROM st_thresholds WHERE threshold = 0.5""",
    ),
    "ev3_roc_auc": Query(
        lambda s, d: evaluate.roc_auc(_scores(s, d), "label", "score"),
        "roc_auc:d",
        """SELECT (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0) / (p * n) AS roc_auc
           FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r, count(*) FILTER (WHERE label = 1) OVER () AS p,
                        count(*) FILTER (WHERE label = 0) OVER () AS n FROM stg_scores) x GROUP BY p, n""",
    ),
    "ev5_metric_gate": Query(
        _gate,
        "metric_name:s op:s bound:d outcome:s",
        """SELECT 'rmse' AS metric_name, '<=' AS op, 1e9 AS bound, CASE WHEN sqrt(avg(e * e)) <= 1e9 THEN 'passed' ELSE 'failed' END AS outcome FROM (SELECT l_extendedprice - l_quantity * 1500 AS e FROM lineitem) x
           UNION ALL SELECT 'r2', '>=', 0.99, CASE WHEN 1 - avg(e * e) / var_pop(y) >= 0.99 THEN 'passed' ELSE 'failed' END FROM (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 1500 AS e FROM lineitem) x
           UNION ALL SELECT 'rmse', '!=', 1.0, 'unknown operator' UNION ALL SELECT 'broken', '>', 0.0, 'not a number'
           UNION ALL SELECT 'absent', '>', 0.0, 'missing metric' UNION ALL SELECT 'val_features', '==', 1.0, 'passed'""",
    ),
    "ev6_tall_metrics": Query(
        _tall,
        "run:s model_version:i metric_name:s metric_value:d",
        """SELECT 'run1' AS run, 1 AS model_version, metric_name, metric_value FROM (
             UNPIVOT (SELECT sqrt(avg(e * e)) AS rmse, avg(e * e) AS mse, 1 - avg(e * e) / var_pop(y) AS r2, 1 - var_pop(e) / var_pop(y) AS explained_variance,
                             CAST(count(*) AS DOUBLE) AS val_rows, CAST(1 AS DOUBLE) AS val_features
                      FROM (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 1500 AS e FROM lineitem) x) ON COLUMNS(*) INTO NAME metric_name VALUE metric_value)
           UNION ALL SELECT 'run1', 1, 'broken', CAST(NULL AS DOUBLE)""",
    ),
    "ev8_batch_score": Query(
        _batch_score,
        "l_returnflag:s l_linestatus:s l_shipdate:t l_quantity:d l_extendedprice:d l_tax:d split_name:s prediction:d model_id:s ts:ts",
        """SELECT l_returnflag, l_linestatus, l_shipdate, l_quantity, l_extendedprice, l_tax, CASE WHEN r >= floor(n * 0.75) THEN 'test' ELSE 'train' END AS split_name,
                  intercept + slope * l_quantity AS prediction, 'm1' AS model_id, TIMESTAMP '2001-08-15 00:00:00' AS ts
           FROM (SELECT *, dense_rank() OVER (ORDER BY l_shipdate) - 1 AS r, (SELECT CAST(count(DISTINCT l_shipdate) AS DOUBLE) FROM lineitem) AS n FROM lineitem) x
           JOIN st_ols USING (l_returnflag, l_linestatus)""",
    ),
    "ev8_append_scores": Query(
        lambda s, d: _appended_scores(s, d).groupBy("model_id", "proba", "split_name", "l_returnflag").agg(F.count("*").alias("rows"), F.avg("prediction").alias("prediction")),
        "model_id:s proba:d split_name:s l_returnflag:s rows:i prediction:d",
        """SELECT model_id, proba, CASE WHEN r >= floor(n * 0.75) THEN 'test' ELSE 'train' END AS split_name, l_returnflag, count(*) AS rows, avg(intercept + slope * l_quantity) AS prediction
           FROM (SELECT *, dense_rank() OVER (ORDER BY l_shipdate) - 1 AS r, (SELECT CAST(count(DISTINCT l_shipdate) AS DOUBLE) FROM lineitem) AS n FROM lineitem) x
           JOIN st_ols USING (l_returnflag, l_linestatus) CROSS JOIN (VALUES ('m1', CAST(NULL AS DOUBLE)), ('m2', 0.5)) m(model_id, proba) GROUP BY 1, 2, 3, 4""",
    ),
    "ev9_baseline": Query(
        _baseline,
        "doc_id:i label:i prediction:i model_id:s p_one:d",
        """SELECT doc_id, label, CASE WHEN 1 - score >= score THEN 0 ELSE 1 END AS prediction, 'm1' AS model_id, score AS p_one
           FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR)))) - 1 AS rn, count(*) OVER () AS n FROM stg_scores) x WHERE rn < ceil(n * 0.25)""",
    ),
    "ev10_model_versions": Query(
        lambda s, d: evaluate.chosen_versions(_registry(s, d), "champion"),
        "model_name:s latest:i chosen:i",
        "SELECT p_brand AS model_name, max(p_partkey) AS latest, coalesce(max(p_partkey) FILTER (WHERE p_size = 7), max(p_partkey)) AS chosen FROM part GROUP BY 1",
    ),
}
