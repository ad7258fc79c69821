"""Configuration search for any learner: density-ratio proposals, and rungs with promotion, fits running as concurrent jobs.

A trial is a function of a configuration (and of a share of the rows) to a score, and does its work as Spark jobs. The driver
keeps scores and configurations only. Several trials run at a time; what is decided uses only trials whose turn has come, never
those that happened to end first, so a seed gives the same search whatever the cluster's timing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.operators import boosting, learners
from lossgrid.session import materialise

Config = dict[str, object]
KINDS = ("uniform", "loguniform", "quniform", "qloguniform", "int", "qint", "choice")


class Range:
    """One parameter: ``(kind, low, high[, step])``, or ``("choice", values)``. Integers lie in low..high - 1."""

    def __init__(self, kind: str, *bounds) -> None:
        if kind not in KINDS:
            raise ValueError(f"unknown range {kind}: one of {KINDS}")
        self.kind, self.values, self.step = kind, None, None
        if kind == "choice":
            self.values = list(bounds[0])
            return
        low, high, *step = bounds
        if not low < high or kind.endswith("loguniform") and low <= 0:
            raise ValueError(f"{kind} needs low < high, and low > 0 for logarithms: {bounds}")
        self.bounds, self.step, self.log = (low, high), step[0] if step else None, "log" in kind
        if kind.startswith("q") and not self.step:
            raise ValueError(f"{kind} needs a step")
        high = high - (1 if self.kind == "int" else 0)
        self.low, self.high = (math.log(low), math.log(high)) if self.log else (float(low), float(high))

    def draw(self, rng: np.random.Generator) -> float:
        """A place on the parameter's own scale: the index of a choice, the logarithm for log ranges."""
        if self.values is not None:
            return float(rng.integers(len(self.values)))
        return float(rng.integers(self.bounds[0], self.bounds[1])) if self.kind == "int" else float(rng.uniform(self.low, self.high))

    def value(self, place: float) -> object:
        if self.values is not None:
            return self.values[int(place)]
        x = math.exp(place) if self.log else place
        if self.step:
            x = min(max(round(x / self.step) * self.step, math.ceil(self.bounds[0] / self.step) * self.step), math.floor(self.bounds[1] / self.step) * self.step)
        x = min(max(x, self.bounds[0]), self.bounds[1])
        return int(round(x)) if self.kind in ("int", "qint") else float(x)

    def log_density(self, places: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Parzen estimate around the places seen, mixed with the flat prior as one more observation."""
        if self.values is not None:
            counts = np.bincount(seen.astype(int), minlength=len(self.values)) + 1.0
            return np.log(counts / counts.sum())[places.astype(int)]
        width = self.high - self.low
        if width <= 0:
            return np.zeros(len(places))
        spread = self._widths(seen)
        inside = _normal((self.high - seen) / spread) - _normal((self.low - seen) / spread)
        bumps = np.exp(-0.5 * ((places[:, None] - seen) / spread) ** 2) / (spread * math.sqrt(2 * math.pi) * np.maximum(inside, 1e-12))
        return np.log((bumps.sum(axis=1) + 1 / width) / (len(seen) + 1))

    def _widths(self, seen: np.ndarray) -> np.ndarray:
        """The larger gap to a neighbour on either side, within bounds that narrow as more is seen."""
        order = np.argsort(seen)
        edges = np.concatenate(([self.low], seen[order], [self.high]))
        gaps = np.maximum(np.diff(edges)[:-1], np.diff(edges)[1:])
        out = np.empty(len(seen))
        out[order] = np.clip(gaps, (self.high - self.low) / min(100, len(seen) + 1), self.high - self.low)
        return out

    def near(self, seen: np.ndarray, rng: np.random.Generator) -> float:
        """A place from the Parzen mixture."""
        pick = int(rng.integers(len(seen) + 1))
        if pick == len(seen):
            return self.draw(rng)
        if self.values is not None:
            return float(seen[pick])
        spread = self._widths(seen)[pick]
        for _ in range(100):
            place = rng.normal(seen[pick], spread)
            if self.low <= place <= self.high:
                return float(round(place)) if self.kind == "int" else float(place)
        return float(seen[pick])


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


def _ranges(space: dict[str, tuple]) -> dict[str, Range]:
    return {name: Range(*bounds) for name, bounds in space.items()}


def propose(ranges: dict[str, Range], places: list[dict[str, float]], losses: list[float], rng: np.random.Generator, start: int = 10, share: float = 0.2, candidates: int = 8) -> dict[str, float]:
    """Places of the next trial: drawn near the better trials, the one whose density there most exceeds that of the others."""
    if len(losses) < start:
        return {name: r.draw(rng) for name, r in ranges.items()}
    order = np.argsort(losses, kind="stable")
    good = order[: max(1, math.ceil(share * len(order)))]
    rest = order[len(good) :]
    found = {}
    for name, r in ranges.items():
        seen = np.array([p[name] for p in places])
        tried = np.array([r.near(seen[good], rng) for _ in range(candidates)])
        ratio = r.log_density(tried, seen[good]) - r.log_density(tried, seen[rest])
        found[name] = float(tried[int(ratio.argmax())])
    return found


@dataclass
class Trial:
    number: int
    config: Config
    scores: list[float] = field(default_factory=list)
    stopped: str = ""


def _failed(score: float | None, larger: bool) -> float:
    """Score as a loss: smaller is better, a missing or NaN score is worst."""
    if score is None or math.isnan(score):
        return math.inf
    return -score if larger else score


def density_search(trial: Callable[[Config], float], space: dict[str, tuple], trials: int, seed: int, larger: bool = False, parallel: int = 4, start: int = 10) -> list[Trial]:
    """Scores of ``trials`` configurations, best first. Trial i is proposed from trials 0 .. i - parallel, which have ended by then."""
    ranges, done, places = _ranges(space), [], []
    with ThreadPoolExecutor(parallel) as pool:
        running: list[Future] = []
        for i in range(trials):
            for j in range(len(done), i - parallel + 1):
                done[j:] = [running[j].result()]
            place = propose(ranges, places[: len(done)], [_failed(s, larger) for s in done], np.random.default_rng([seed, i]), start)
            places.append(place)
            running.append(pool.submit(trial, {name: ranges[name].value(p) for name, p in place.items()}))
        scores = [f.result() for f in running]
    tried = [Trial(i, {name: ranges[name].value(p) for name, p in place.items()}, [score]) for i, (place, score) in enumerate(zip(places, scores))]
    return sorted(tried, key=lambda t: (_failed(t.scores[-1], larger), t.number))


def promote(
    trial: Callable[[Config, int], float], configs: list[Config], rungs: int, factor: int = 3, larger: bool = False, parallel: int = 4, median_after: int | None = None,
) -> list[Trial]:
    """Successive halving without waiting for whole rungs: ``trial(config, rung)`` scores a configuration on the rows of a rung.

    Whenever a place is free, the highest rung in which a configuration is among the best 1/factor of those scored sends it up;
    else the next new configuration starts. Once all have started, the best of each rung, at least one, still go up, so the last
    rung is never empty. With ``median_after``, a configuration worse than the median of at least so many others on its rung
    stops there. A decision uses the jobs whose turn has come: job i those up to i - parallel.
    """
    held = [Trial(i, dict(config)) for i, config in enumerate(configs)]
    started, sent = 0, [set() for _ in range(rungs)]
    board: list[dict[int, float]] = [{} for _ in range(rungs)]
    jobs: list[tuple[int, int, Future]] = []
    counted = 0

    def settle(upto: int) -> None:
        nonlocal counted
        while counted < upto:
            number, rung, future = jobs[counted]
            score = _failed(future.result(), larger)
            held[number].scores.append(future.result())
            others = list(board[rung].values())
            board[rung][number] = score
            if median_after is not None and len(others) >= median_after and score > float(np.median(others)):
                held[number].stopped = "median"
            counted += 1

    def ready(final: bool) -> tuple[int, int] | None:
        for rung in range(rungs - 2, -1, -1):
            scored = sorted((s, n) for n, s in board[rung].items())
            quota = max(1, len(scored) // factor) if final and scored else len(scored) // factor
            for _, number in scored[:quota]:
                if number not in sent[rung] and not held[number].stopped:
                    return number, rung + 1
        return None

    with ThreadPoolExecutor(parallel) as pool:
        while True:
            settle(max(0, len(jobs) - parallel + 1))
            final = started == len(held) and counted == len(jobs)
            choice = ready(final)
            if choice is None and started < len(held):
                choice, started = (started, 0), started + 1
            if choice is None:
                if final:
                    break
                settle(counted + 1)
                continue
            number, rung = choice
            if rung:
                sent[rung - 1].add(number)
            jobs.append((number, rung, pool.submit(trial, held[number].config, rung)))
    for t in held:
        t.stopped = t.stopped or ("" if len(t.scores) == rungs else "rung")
    return sorted(held, key=lambda t: (-len(t.scores), _failed(t.scores[-1], larger), t.number))


def row_share(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) for each row from its keys, the same in every run: rows below a share form nested samples."""
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 13), 16, 10)
    return place.cast("double") / float(16**13)


LOSSES = {"rmse": False, "log_loss": False, "accuracy": True}


def score(df: DataFrame, label: str, metric: str, positive=None) -> float | None:
    """One metric of rows with ``prediction`` (and ``probability`` for the log loss of ``positive``); rows without a prediction do not count."""
    rows = df.where(F.col(label).isNotNull() & F.col("prediction").isNotNull())
    if metric == "rmse":
        return rows.agg(F.sqrt(F.avg((F.col(label) - F.col("prediction")) ** 2))).first()[0]
    if metric == "accuracy":
        return rows.agg(F.avg((F.col(label) == F.col("prediction")).cast("double"))).first()[0]
    p = F.greatest(F.least(F.col("probability")[1], F.lit(1 - 1e-15)), F.lit(1e-15))
    return rows.agg(-F.avg(F.when(F.col(label) == F.lit(positive), F.log(p)).otherwise(F.log(1 - p)))).first()[0]


def _fit_and_score(train: DataFrame, held: DataFrame, features: list[str], label: str, task: str, kind: str, metric: str, positive, params: Config) -> float | None:
    if kind == "histogram_boosting":
        return score(boosting.predict_boosted(held, boosting.fit_boosted(train, features, label, task, **params)), label, metric, positive)
    return score(learners.predict(learners.fit_learner(train, features, label, task, kind, **params), held), label, metric, positive)


def search_learner(
    df: DataFrame, features: list[str], label: str, task: str, kind: str, space: dict[str, tuple], trials: int, fold_col: str, metric: str, seed: int = 0,
    parallel: int = 4, positive=1.0, start: int = 10, **params,
) -> list[Trial]:
    """Density-ratio search over a learner's ranges by the mean score of the folds in ``fold_col``; fixed settings as keywords."""
    rows = materialise(df.select(*features, label, F.col(fold_col).alias("_fold")))
    folds = sorted(r[0] for r in rows.select("_fold").distinct().collect())  # a handful

    def trial(config: Config) -> float | None:
        scores = [_fit_and_score(rows.where(F.col("_fold") != f), rows.where(F.col("_fold") == f), features, label, task, kind, metric, positive, params | config) for f in folds]
        return None if None in scores else float(np.mean(scores))

    return density_search(trial, space, trials, seed, LOSSES[metric], parallel, start)


def halve_learner(
    df: DataFrame, features: list[str], label: str, task: str, kind: str, configs: list[Config], keys: list[str], held_col: str, metric: str, rungs: int = 3, factor: int = 3,
    seed: int = 0, parallel: int = 4, positive=1.0, median_after: int | None = None, **params,
) -> list[Trial]:
    """Rungs over nested samples of the training rows, judged on the rows where ``held_col`` is true.

    The last rung sees all training rows, each one before a ``factor``-th of them, chosen by a hash of ``keys``.
    """
    rows = materialise(df.select(*features, label, F.col(held_col).alias("_held"), row_share(keys, seed).alias("_share")))
    held = rows.where("_held")

    def trial(config: Config, rung: int) -> float | None:
        sample = rows.where(~F.col("_held") & (F.col("_share") < float(factor) ** (rung - rungs + 1)))
        return _fit_and_score(sample, held, features, label, task, kind, metric, positive, params | config)

    return promote(trial, configs, rungs, factor, LOSSES[metric], parallel, median_after)
