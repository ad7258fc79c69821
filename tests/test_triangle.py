import random
from collections import defaultdict
from datetime import date

from pyspark.sql import Window, functions as F

from lossgrid import constants as K
from lossgrid.operators import triangle

SEGMENTS = ["PolicySubType", "SystemID"]


def _rows():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        hot = i % 3 == 0  # a third of the rows shares one segment and month
        month = date(2020, 1, 1) if hot else date(2020, rng.randint(1, 6), 1)
        dims = ("A", "0_20", "North", "S1", "icd") if hot else (rng.choice("AB"), rng.choice(["0_20", "21_35"]), rng.choice(["North", None]), "S" + rng.choice("12"), rng.choice(["icd", "x"]))
        lag = rng.choice([0, 1, 2, 5, 9, 40, -1, 99])
        rows.append((month, *dims, lag, float(rng.randint(1, 100)), rng.choice([None, f"c{rng.randint(1, 60)}"]), f"i{i}"))
    return rows


def _by_definition(rows, max_lag):
    kept = [r for r in rows if None not in r[:6] and 0 <= r[6] <= max_lag]
    lags = sorted({r[6] for r in kept})
    grains = defaultdict(list)
    for r in kept:
        grains[r[:6]].append(r)
    cells = defaultdict(lambda: [0.0, 0, 0])
    for grain, members in grains.items():
        for lag in lags:
            seen = [m for m in members if m[6] <= lag]
            cell = cells[grain[0], grain[1], grain[4], lag]
            cell[0] += sum(m[7] for m in seen)
            cell[1] += len({m[8] for m in seen if m[8]})
            cell[2] += len({m[9] for m in seen})
    top = lags[-1]
    return {k: (*v, *cells[k[0], k[1], k[2], top]) for k, v in cells.items()}


def test_triangle_equals_its_definition(spark):
    rows = _rows()
    schema = "treatment_date date, PolicySubType string, AgeBucket string, UKMemberRegion string, SystemID string, MajorICDGroupingDescription string, delay int, amount_paid double, claim_id string, invoice_id string"
    cells = triangle.loss_triangle(spark.createDataFrame(rows, schema), "delay", SEGMENTS).collect()
    ours = {
        (r["treatment_date"], r["PolicySubType"], r["SystemID"], r["delay"]): (
            r["cumulative_amount"], r["cumulative_nb_claim"], r["cumulative_nb_invoice"], r["ultimate_amount"], r["ultimate_nb_claim"], r["ultimate_nb_invoice"],
        )
        for r in cells
    }
    assert ours == _by_definition(rows, K.MAX_RUNOFF_YEARS * 12)


def test_cumulatives_never_fall(spark):
    schema = "treatment_date date, PolicySubType string, AgeBucket string, UKMemberRegion string, SystemID string, MajorICDGroupingDescription string, delay int, amount_paid double, claim_id string, invoice_id string"
    cells = triangle.loss_triangle(spark.createDataFrame(_rows(), schema), "delay", SEGMENTS)


    before = F.lag("cumulative_amount").over(Window.partitionBy("treatment_date", *SEGMENTS).orderBy("delay"))
    assert cells.withColumn("b", before).where("b > cumulative_amount").isEmpty()


def test_every_month_has_four_weeks(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2023-01-01', DATE '2024-12-31')) AS payment_date_full").select(
        "payment_date_full", F.trunc("payment_date_full", "MM").alias("payment_date"), F.lit(1).alias("daily_lag_reception_payment")
    )
    times = triangle.processing_times(days)
    assert times.count() == 24
    assert times.where(" AND ".join(f"avg_processing_time_w{w} = 1" for w in (1, 2, 3, 4))).count() == 24


def test_inference_rows_are_one_diagonal(spark):
    cells = spark.sql(
        "SELECT m AS treatment_date, CAST(l AS INT) AS lag, 'a' AS s FROM (SELECT explode(sequence(DATE '2020-01-01', DATE '2021-12-01', interval 1 month)) AS m) LATERAL VIEW explode(sequence(0, 11)) t AS l"
    )
    gold = triangle.gold_slice(cells, ["s"], "2021-01-01", "2021-12-01", 1)
    found = {(r["treatment_date"].month, r["lag"]) for r in gold.where("is_inference").collect()}
    assert found == {(m, 12 - m) for m in range(1, 13)}
    assert gold.count() == 24 * 12
