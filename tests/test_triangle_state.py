"""A triangle merged month by month against one run over all invoices."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid import constants as K
from lossgrid.operators import triangle
from lossgrid.operators.triangle_state import TriangleState

COLUMNS = f"invoice_id string, claim_id string, {K.OCCURRENCE_COL} date, {', '.join(f'{d} string' for d in K.ALL_DIMS)}, lag int, amount_paid double, extra int"


def invoice(rng, number):
    return (
        f"i{number}", None if rng.random() < 0.05 else f"c{rng.integers(0, 60)}", date(2024, int(rng.integers(1, 7)), 1),
        *[f"{d[:2]}{rng.integers(0, 2)}" if rng.random() > 0.02 else None for d in K.ALL_DIMS], int(rng.integers(-1, 39)), None if rng.random() < 0.03 else float(rng.integers(1, 100)), 1,
    )


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_month_by_month_equals_one_run(spark, tmp_path):
    rng = np.random.default_rng(4)
    state, held, segments = TriangleState(spark, str(tmp_path / "state")), {}, K.ALL_DIMS[:2]
    for month in range(4):
        batch = {f"i{n}": invoice(rng, n) for n in range(month * 80, month * 80 + 80)}  # late invoices, of any month
        batch |= {k: invoice(rng, int(k[1:])) for k in rng.choice(sorted(held), 25, replace=False)} if held else {}  # corrected: all may change
        gone = [str(k) for k in rng.choice(sorted(set(held) - set(batch)), 6, replace=False)] if held else []
        frame = spark.createDataFrame(list(batch.values()), COLUMNS)
        assert state.merge(frame, spark.createDataFrame([(g,) for g in [*gone, "never seen"]], "invoice_id string") if month else None) == month + 1
        held = {k: v for k, v in held.items() if k not in gone} | batch
        whole = triangle.loss_triangle(spark.createDataFrame(list(held.values()), COLUMNS), "lag", segments)
        found = state.triangle(segments)
        assert found.columns == whole.columns or sorted(found.columns) == sorted(whole.columns)
        assert rows(found.select(*whole.columns)) == rows(whole)
    assert rows(state.triangle([]).select(K.OCCURRENCE_COL, "lag", "cumulative_nb_claim")) == rows(
        triangle.loss_triangle(spark.createDataFrame(list(held.values()), COLUMNS), "lag", []).select(K.OCCURRENCE_COL, "lag", "cumulative_nb_claim")
    )


def test_only_touched_rows_are_recounted(spark, tmp_path):
    state = TriangleState(spark, str(tmp_path / "state"))
    many = [(f"i{n}", f"c{n // 2}", date(2024, 1, 1), "a", "b", "c", "d", "e", n % 5, 1.0, 1) for n in range(200)]
    state.merge(spark.createDataFrame(many, COLUMNS))
    state.merge(spark.createDataFrame([(*many[0][:8], 4, 7.0, 1)], COLUMNS))
    change = spark.read.parquet(f"{state.path}/cells/2")
    assert change.agg(F.sum("amount"), F.sum("rows"), F.sum("nb_claim")).first() == (6.0, 0, 0) and change.count() <= 3


def test_empty_and_wrong_batches(spark, tmp_path):
    state = TriangleState(spark, str(tmp_path / "state"))
    none = spark.createDataFrame([], COLUMNS)
    assert state.triangle(["SystemID"]).count() == 0
    assert state.merge(none) == 1 and state.triangle(["SystemID"]).count() == 0
    row = ("i1", "c1", date(2024, 1, 1), "a", "b", "c", "d", "e", 2, 1.0, 1)
    with pytest.raises(ValueError, match="twice"):
        state.merge(spark.createDataFrame([row, row], COLUMNS))
    with pytest.raises(ValueError, match="without an id"):
        state.merge(spark.createDataFrame([(None, *row[1:])], COLUMNS))


def test_a_failed_batch_changes_nothing(spark, tmp_path):
    state = TriangleState(spark, str(tmp_path / "state"))
    row = ("i1", "c1", date(2024, 1, 1), "a", "b", "c", "d", "e", 2, 1.0, 1)
    state.merge(spark.createDataFrame([row], COLUMNS))
    before = rows(state.triangle(["SystemID"]))
    bad = spark.createDataFrame([("i2", *row[1:])], COLUMNS).withColumn("amount_paid", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        state.merge(bad)
    assert rows(state.triangle(["SystemID"])) == before
    good = spark.createDataFrame([("i2", *row[1:])], COLUMNS)
    with pytest.raises(RuntimeError, match="begun elsewhere"):
        state.merge(good)
    state.release(2)
    assert state.merge(good) == 2
    state.release(2)  # a finished batch stays
    assert rows(state.triangle(["SystemID"])) != before
