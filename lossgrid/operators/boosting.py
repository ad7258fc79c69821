"""Gradient boosting from histograms: regression, two classes or more, missing values, early stopping.

Features are cut into bins once and rows are laid into blocks of small integers beside their labels and scores. A level of all
trees of a round is one job: every task adds up gradients and hessians per (class, node, feature, bin), the histograms are
added, and the best cut of each (class, node, feature) comes back, one row each. Leaf values follow from the same sums. Work
per level is one pass over the blocks, whatever the number of nodes and classes; the driver holds the trees and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.session import materialise

BLOCK_ROWS, REFRESH = 16_384, 8
MOST_BINS, MOST_CLASSES = 254, 64


@dataclass
class Tree:
    """Nodes in order of their making. A row goes left where its bin is at most ``cut``, or is missing and ``missing_left``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, values: tuple[float, float]) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node], self.left[node] = feature, cut, missing_left, at
        for value in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.missing_left.append(True)
            self.left.append(-1)
            self.value.append(value)
        return at, at + 1

    def nodes(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins; ``missing[f]`` is the bin that stands for a missing value of feature f."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        by_default = np.array(self.missing_left)
        node = np.zeros(len(bins), np.int64)
        moving = np.flatnonzero(left[node] >= 0)
        while len(moving):
            at = node[moving]
            f = feature[at]
            b = bins[moving, f]
            goes_left = np.where(b == missing[f], by_default[at], b <= cut[at])
            node[moving] = left[at] + np.where(goes_left, 0, 1)
            moving = moving[left[node[moving]] >= 0]
        return node


@dataclass
class Boosted:
    """A fitted ensemble. ``history`` holds (round, train loss, validation loss); rounds after ``best`` are dropped."""

    features: list[str]
    task: str
    classes: list
    cuts: list[list[float]]
    base: list[float]
    rate: float
    trees: list[list[Tree]] = field(default_factory=list)
    history: list[tuple[int, float, float | None]] = field(default_factory=list)
    best: int = 0

    @property
    def missing(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts])

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin of each value: the number of cuts below it; a missing value has the bin after the last."""
        out = np.zeros(x.shape, np.uint8)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.where(np.isnan(x[:, f]), len(cuts) + 1, np.searchsorted(cuts, x[:, f], side="left"))
        return out

    def add_scores(self, scores: np.ndarray, bins: np.ndarray, first: int = 0) -> np.ndarray:
        for trees in self.trees[first:]:
            for k, tree in enumerate(trees):
                scores[:, k] += self.rate * np.array(tree.value)[tree.nodes(bins, self.missing)]
        return scores


def loss_terms(task: str, scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(loss of each row, gradients, hessians) by class: squared error, logistic or softmax; y is a number or a class index."""
    if task == "regression":
        error = scores[:, 0] - y
        return 0.5 * error * error, error[:, None], np.ones((len(y), 1))
    if scores.shape[1] == 1:
        p = 1 / (1 + np.exp(-scores[:, 0]))
        return np.logaddexp(0, scores[:, 0]) - y * scores[:, 0], (p - y)[:, None], (p * (1 - p))[:, None]
    shifted = scores - scores.max(axis=1, keepdims=True)
    p = np.exp(shifted)
    total = p.sum(axis=1)
    p /= total[:, None]
    rows, member = np.arange(len(y)), np.zeros_like(p)
    member[rows, y.astype(int)] = 1
    return np.log(total) - shifted[rows, y.astype(int)], p - member, p * (1 - p)


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, cuts: int, l2: float, least: float) -> tuple | None:
    """(gain, cut, missing_left, left sums, right sums) of one histogram whose last bin holds the missing rows.

    Both ways for missing rows are tried. Ties go to the lower cut, then to the left.
    """
    total_g, total_h, best = g.sum(), h.sum(), None
    for missing_left in (True, False):
        left_g, left_h, left_n = (np.cumsum(v[:-1])[: cuts] + (v[-1] if missing_left else 0) for v in (g, h, n))
        right_g, right_h, right_n = total_g - left_g, total_h - left_h, n.sum() - left_n
        fine = (left_n > 0) & (right_n > 0) & (left_h >= least) & (right_h >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * (left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - total_g**2 / (total_h + l2))
        gain = np.where(fine, np.nan_to_num(gain, nan=-np.inf, posinf=-np.inf), -np.inf)
        if len(gain) and np.isfinite(gain.max()):
            at = int(np.flatnonzero(gain >= gain.max() - 1e-9 * max(abs(gain.max()), 1e-12))[0])
            found = (float(gain[at]), at, missing_left, (float(left_g[at]), float(left_h[at])), (float(right_g[at]), float(right_h[at])))
            if best is None or found[0] > best[0] + 1e-9 * max(abs(best[0]), 1e-12):
                best = found
    return best


def _cuts(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Up to ``bins`` cuts per feature at approximate percentiles of its present values, in one pass."""
    steps = F.array(*[F.lit(i / bins) for i in range(bins)])
    present = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features]
    row = df.agg(*[F.percentile_approx(p, steps, F.lit(100 * bins)).alias(f"c{i}") for i, p in enumerate(present)]).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(len(features))]


def _blocks(df: DataFrame, model: Boosted, label: Column, validation: Column) -> DataFrame:
    """(bins, y, validation, scores) of up to ``BLOCK_ROWS`` rows each, made where the rows are."""
    places = {c: i for i, c in enumerate(model.classes)}
    names, k = model.features, len(model.base)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for low in range(0, len(pdf), BLOCK_ROWS):
                part = pdf.iloc[low : low + BLOCK_ROWS]
                x = part[[f"_x{i}" for i in range(len(names))]].to_numpy(float)
                y = part["_y"].map(places).to_numpy(float) if places else part["_y"].to_numpy(float)
                scores = np.tile(np.array(model.base), (len(part), 1))
                yield pd.DataFrame([{"bins": model.binned(x).tobytes(), "y": y.tobytes(), "validation": part["_v"].to_numpy(np.uint8).tobytes(), "scores": scores.tobytes()}])

    chosen = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)], label.alias("_y"), validation.cast("tinyint").alias("_v"))
    return chosen.mapInPandas(run, "bins binary, y binary, validation binary, scores binary")


def _open(row, model: Boosted) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    y = np.frombuffer(row["y"])
    bins = np.frombuffer(row["bins"], np.uint8).reshape(len(y), len(model.features))
    return bins, y, np.frombuffer(row["validation"], np.uint8) > 0, np.frombuffer(row["scores"]).reshape(len(y), len(model.base)).copy()


def _scored(laid: DataFrame, model: Boosted, first: int) -> DataFrame:
    """Blocks with the trees from round ``first`` on added to their scores."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            pdf["scores"] = [model.add_scores(_open(row, model)[3], _open(row, model)[0], first).tobytes() for row in pdf.to_dict("records")]
            yield pdf

    return laid.mapInPandas(run, laid.schema)


def _histograms(model: Boosted, first: int, growing: list[Tree], open_nodes: list[list[int]]):
    """Per task: sums per (class, node, feature) over training rows, and the losses of both sides."""
    missing, width = model.missing, int(model.missing.max()) + 1

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        losses = np.zeros(4)
        for pdf in parts:
            for row in pdf.to_dict("records"):
                bins, y, held, scores = _open(row, model)
                loss, gradient, hessian = loss_terms(model.task, model.add_scores(scores, bins, first), y)
                losses += [loss[~held].sum(), (~held).sum(), loss[held].sum(), held.sum()]
                bins, gradient, hessian = bins[~held], gradient[~held], hessian[~held]
                for k, tree in enumerate(growing):
                    node = tree.nodes(bins, missing)
                    for one in open_nodes[k]:
                        mine = np.flatnonzero(node == one)
                        table = sums.setdefault((k, one), np.zeros((len(missing), 3, width)))
                        for f in range(len(missing)):
                            b = bins[mine, f]
                            table[f] += [np.bincount(b, gradient[mine, k], width), np.bincount(b, hessian[mine, k], width), np.bincount(b, minlength=width)]
        rows = [{"class": -1, "node": 0, "feature": 0, "sums": losses.tolist()}]
        rows += [{"class": k, "node": node, "feature": f, "sums": table[f].ravel().tolist()} for (k, node), table in sums.items() for f in range(len(missing))]
        yield pd.DataFrame(rows)

    return run


FOUND = "gain double, cut int, missing_left boolean, left_g double, left_h double, right_g double, right_h double, losses array<double>"


def _search(model: Boosted, l2: float, least: float):
    """Best cut of each histogram, its parts of all tasks added first."""

    @F.pandas_udf(FOUND)
    def run(classes: pd.Series, features: pd.Series, parts: pd.Series) -> pd.DataFrame:
        out = []
        for k, f, arrays in zip(classes, features, parts):
            total = np.sum([np.asarray(a, float) for a in arrays], axis=0)
            row = dict.fromkeys(["gain", "cut", "missing_left", "left_g", "left_h", "right_g", "right_h", "losses"])
            if k < 0:
                row["losses"] = total.tolist()
            else:
                cuts = len(model.cuts[f])
                g, h, n = total.reshape(3, -1)[:, : cuts + 2]
                found = best_cut(g, h, n, cuts, l2, least)
                if found:
                    row |= {"gain": found[0], "cut": found[1], "missing_left": found[2], "left_g": found[3][0], "left_h": found[3][1], "right_g": found[4][0], "right_h": found[4][1]}
            out.append(row)
        return pd.DataFrame(out)

    return run


def fit_boosted(
    df: DataFrame, features: list[str], label: str, task: str = "regression", rounds: int = 50, depth: int = 4, bins: int = 64, rate: float = 0.1,
    l2: float = 1.0, least_hessian: float = 1e-3, least_gain: float = 1e-9, split_col: str | None = None, patience: int | None = None,
) -> Boosted:
    """Fit on the rows with a label; a missing feature value (null or NaN) is a value of its own that each cut sends one way.

    With ``split_col`` only rows marked train grow trees and rows marked val are judged; ``patience`` rounds without a better
    validation loss end the fit, and the best round is restored. Classification takes any labels, up to ``MOST_CLASSES``.
    """
    if bins > MOST_BINS:
        raise ValueError(f"at most {MOST_BINS} bins")
    if patience is not None and split_col is None:
        raise ValueError("patience needs validation rows: name the split column")
    known = df.where(F.col(label).isNotNull())
    validation = F.lit(False)
    if split_col:
        known = known.where(F.col(split_col).isin("train", "val"))
        validation = F.col(split_col) == "val"
    train = known.where(~validation)
    y = F.col(label).cast("double") if task == "regression" else F.col(label)
    if task == "regression":
        known = known.where(~F.isnan(F.col(label).cast("double")))
        classes, base = [], [float(train.where(~F.isnan(F.col(label).cast("double"))).agg(F.avg(y)).first()[0] or 0.0)]
    else:
        counts = {r[0]: r[1] for r in train.groupBy(label).count().limit(MOST_CLASSES + 1).collect()}
        if not 2 <= len(counts) <= MOST_CLASSES:
            raise ValueError(f"classification needs 2 to {MOST_CLASSES} classes, not {len(counts)}")
        classes = sorted(counts)
        known = known.where(F.col(label).isin(classes))
        shares = np.array([counts[c] for c in classes]) / sum(counts.values())
        base = [float(np.log(shares[1] / shares[0]))] if len(classes) == 2 else np.log(shares).tolist()
    model = Boosted(list(features), task, classes, _cuts(train, features, bins), base, rate)
    laid, kept = materialise(_blocks(known, model, y, validation)), 0
    search = _search(model, l2, least_hessian)

    def job(growing: list[Tree], open_nodes: list[list[int]]) -> tuple[list, list]:
        sums = laid.mapInPandas(_histograms(model, kept, growing, open_nodes), "class int, node int, feature int, sums array<double>")
        added = sums.groupBy("class", "node", "feature").agg(F.collect_list("sums").alias("_parts"))  # a row per task
        rows = added.select("class", "node", "feature", search("class", "feature", "_parts").alias("found")).select("class", "node", "feature", "found.*").collect()
        losses = next((r["losses"] for r in rows if r["class"] < 0), [0.0, 0, 0.0, 0])
        return [r for r in rows if r["class"] >= 0 and r["gain"] is not None], losses

    def note(losses: list) -> None:
        model.history.append((len(model.trees), losses[0] / max(losses[1], 1), losses[2] / losses[3] if losses[3] else None))

    def waited() -> bool:
        judged = [v for _, _, v in model.history]
        return patience is not None and judged[-1] is not None and len(judged) - 1 - int(np.argmin(judged)) >= patience

    while len(model.trees) < rounds:
        growing, open_nodes = [Tree() for _ in base], [[0] for _ in base]
        for level in range(depth):
            rows, losses = job(growing, open_nodes)
            if level == 0:
                note(losses)
                if waited():
                    break
            cuts: dict[tuple[int, int], object] = {}
            for r in sorted(rows, key=lambda r: r["feature"]):
                old = cuts.get((r["class"], r["node"]))
                if old is None or r["gain"] > old["gain"] + 1e-9 * max(abs(old["gain"]), 1e-12):
                    cuts[r["class"], r["node"]] = r
            for k, nodes in enumerate(open_nodes):
                after = []
                for node in nodes:
                    r = cuts.get((k, node))
                    if r is not None and r["gain"] > least_gain:
                        values = -r["left_g"] / (r["left_h"] + l2), -r["right_g"] / (r["right_h"] + l2)
                        after += growing[k].split(node, r["feature"], r["cut"], r["missing_left"], values)
                open_nodes[k] = after
            if not any(open_nodes):
                break
        if len(model.history) > len(model.trees) and waited() or all(len(t.value) == 1 for t in growing):
            break
        model.trees.append(growing)
        if len(model.trees) - kept >= REFRESH:
            laid, kept = materialise(_scored(laid, model, kept)), len(model.trees)
    if len(model.history) == len(model.trees):
        note(job([Tree() for _ in base], [[] for _ in base])[1])
    judged = [v for _, _, v in model.history]
    model.best = int(np.argmin(judged)) if patience is not None and judged[0] is not None else len(model.trees)
    model.trees = model.trees[: model.best]
    return model


def predict_boosted(df: DataFrame, model: Boosted) -> DataFrame:
    """Every row with ``prediction``, and ``probability`` by class for classification. Missing values take their learned ways."""

    @F.pandas_udf("array<double>")
    def scores(columns: pd.DataFrame) -> pd.Series:
        bins = model.binned(columns.to_numpy(float))
        return pd.Series(list(model.add_scores(np.tile(np.array(model.base), (len(columns), 1)), bins)))

    scored = df.withColumn("_scores", scores(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(model.features)])))
    if model.task == "regression":
        return scored.withColumn("prediction", F.col("_scores")[0]).drop("_scores")
    if len(model.classes) == 2:
        p = 1 / (1 + F.exp(-F.col("_scores")[0]))
        probability = F.array(1 - p, p)
    else:
        top = F.array_max("_scores")
        powers = F.transform("_scores", lambda s: F.exp(s - top))
        probability = F.transform(powers, lambda e: e / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))
    scored = scored.withColumn("probability", probability)
    names = F.array(*[F.lit(c) for c in model.classes])
    return scored.withColumn("prediction", F.element_at(names, F.array_position("probability", F.array_max("probability")).cast("int"))).drop("_scores")
