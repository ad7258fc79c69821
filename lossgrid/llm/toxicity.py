"""Toxicity by a support vector machine on a gapped-subsequence string kernel, with Nyström landmarks.

The kernel of two words counts their common subsequences of four letters, gaps allowed inside a window of six, each gap
weighted by ``DECAY``; white space, punctuation and inserted letters therefore cost little. Landmark words give a Nyström
map, a linear machine is trained in it, and because both are linear the machine folds into one weight per subsequence:
scoring a word is a sum over its subsequences. A sentence is as toxic as its worst word, a text as its worst sentence.

Labels say which texts are toxic, not where. Words of the labelled sentences are therefore chosen in rounds: words that
explain most toxic texts and hardly occur in clean ones come first, then the worst word of each toxic text that is left;
clean words that score high join the other side.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossgrid.llm.common import batches, fold, fold_column, written

#: Labelled rows the machine is fitted on, chosen by hash: at most so many of each kind.
TOXIC_ROWS, CLEAN_ROWS = 1500, 3000
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
LENGTH, WINDOW, DECAY = 4, 6, 0.6
#: Toxic texts that no frequent word explains and that are compared by kernel, the kernel from which two words are alike,
#: and the size of the sketch of a word's subsequences that this comparison uses.
UNEXPLAINED, ALIKE, SKETCH = 30, 0.45, 1024
LANDMARKS, NEGATIVES, SEED = 360, 8_000, 5
#: Words a worker remembers the score of.
REMEMBERED = 400_000

#: Symbols: 1 to 26 for a to z, 32 to 63 for the accented Latin letters, which tell words apart in many languages; all other
#: code points from 0x100 on get a number of their own by hash, from 64 on.
_DIGIT, _START, _END, _OTHER = 27, 28, 29, 30
#: Numbers of subsequences: a hash of the four symbols to so many bits.
NUMBERS = 1 << 20
#: Places of the letters of a subsequence and the weight of its gaps.
PATTERNS = [((0, *c), DECAY ** (c[-1] - LENGTH + 1)) for c in combinations(range(1, WINDOW), LENGTH - 1)]
_SPACED = re.compile(r"(?:(?<=\s)|^)(?:\w\s+){2,}\w(?=\s|$)")


def _symbols() -> np.ndarray:
    """Symbol of each code point below 0x100; 0 for signs, which are left out. Digits that look like a letter count as it."""
    out = np.zeros(0x100, np.int64)
    look = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
    for code in range(0x100):
        char = look.get(chr(code), chr(code).lower()[:1])
        accented = 32 + (ord(char) & 31) if ord(char) >= 0xC0 and char.isalpha() else _OTHER
        out[code] = ord(char) - 96 if "a" <= char <= "z" else _DIGIT if char.isdigit() else accented if char.isalpha() else 0
    return out


SYMBOLS = _symbols()


def units(text: str | None) -> list[str]:
    """The words of a text in lower case; a run of single letters is one word more."""
    low = (text or "").lower()
    found = low.split()
    if _SPACED.search(low):
        found += ["".join(m.group().split()) for m in _SPACED.finditer(low)]
    return found


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words in a row, each word between its marks, and where each word starts. Other signs are left out."""
    codes = np.frombuffer(("\n" + "\n\n".join(words) + "\n").encode("utf-32-le", "replace"), np.uint32)
    symbols = np.where(codes < 0x100, SYMBOLS[np.minimum(codes, 0xFF)], 64 + (codes.astype(np.int64) * 0x9E3779B1 >> 12 & 0xFFFFF))
    line = codes == 10
    mark = np.flatnonzero(line)
    symbols[mark[0::2]], symbols[mark[1::2]] = _START, _END
    kept = symbols > 0
    starts = (np.cumsum(kept) - 1)[mark[0::2]]
    return symbols[kept], starts


def _occurrences(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pattern: positions at which it fits inside a word, the subsequence's number, the weight."""
    sizes = np.diff(np.append(starts, len(symbols)))
    end = np.repeat(starts + sizes, sizes)
    for places, weight in PATTERNS:
        at = np.flatnonzero(np.arange(len(symbols)) + places[-1] < end)
        number = symbols[at]
        for p in places[1:]:
            number = number * 64 + symbols[at + p]
        yield at, (number * 0x9E3779B1 >> 8) & (NUMBERS - 1), weight


def _scale(starts: np.ndarray, total: int) -> np.ndarray:
    """Norm of each word: the root of the summed squared weights of its subsequences, by its length."""
    sizes = np.diff(np.append(starts, total))
    squares = sum(w * w * np.maximum(sizes - p[-1], 0) for p, w in PATTERNS)
    return np.sqrt(np.maximum(squares, 1e-9))


def score_words(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Margin of each word."""
    out = []
    for low in range(0, len(words), 20_000):
        symbols, starts = _flat(words[low : low + 20_000])
        value = np.zeros(len(symbols))
        for at, number, weight in _occurrences(symbols, starts):
            value[at] += weight * weights[number]
        out.append(np.add.reduceat(value, starts) / _scale(starts, len(symbols)) + bias)
    return np.concatenate(out) if out else np.zeros(0)


def _kernel(words: list[str], landmarks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Kernel of words with landmarks, whose scaled subsequence weights are the rows of the table for the used numbers."""
    used, table = landmarks
    out = []
    for low in range(0, len(words), 250):
        symbols, starts = _flat(words[low : low + 250])
        sums = np.zeros((len(symbols), table.shape[1]), np.float32)
        for at, number, weight in _occurrences(symbols, starts):
            row = used[number]
            hit = row >= 0
            sums[at[hit]] += np.float32(weight) * table[row[hit]]
        out.append((np.add.reduceat(sums, starts, axis=0) / _scale(starts, len(symbols))[:, None]).astype(np.float32))
    return np.concatenate(out) if out else np.zeros((0, table.shape[1]))


def _landmark_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    symbols, starts = _flat(words)
    word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(symbols))))
    found = [(number, word[at], weight) for at, number, weight in _occurrences(symbols, starts)]
    numbers = np.unique(np.concatenate([f[0] for f in found]))
    used = np.full(NUMBERS, -1, np.int32)
    used[numbers] = np.arange(len(numbers))
    table = np.zeros((len(numbers), len(words)), np.float32)
    for number, owner, weight in found:
        np.add.at(table, (used[number], owner), np.float32(weight))
    table /= _scale(starts, len(symbols))[None, :].astype(np.float32)
    return used, table


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 2e-4, rounds: int = 25) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps; the last column of ``x`` is the bias."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        inside = np.flatnonzero(1 - y * (x @ w) > 0)
        hessian, right = penalty * np.eye(len(w)), np.zeros(len(w))
        for low in range(0, len(inside), 1000):  # few rows at a time, in double precision
            part = inside[low : low + 1000]
            xi, wi = x[part].astype(float), weight[part] / weight.sum()
            hessian += (xi * wi[:, None]).T @ xi
            right += xi.T @ (wi * y[part])
        new = np.linalg.solve(hessian, right)
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


@dataclass(frozen=True)
class Machine:
    """Weights of subsequences, bias, and the logistic curve from the worst margin to a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def _distinct(texts: list[set[str]]) -> list[set[str]]:
    """One text of those that share their smallest word hashes: near copies would make each of their words look toxic."""
    kept = {}
    for text in sorted(texts, key=lambda t: (len(t), sorted(t))):
        kept.setdefault(tuple(sorted(zlib.crc32(w.encode("utf-8", "replace")) for w in text)[:3]), text)
    return list(kept.values())


def _cover(toxic: list[set[str]], clean: dict[str, int], clean_texts: int) -> tuple[list[str], list[set[str]]]:
    """Words that explain toxic texts, the one that explains most of those left first, rare in clean texts; and the texts left."""
    where: dict[str, list[int]] = {}
    for i, text in enumerate(toxic):
        for word in text:
            where.setdefault(word, []).append(i)
    share = clean_texts / max(1, len(toxic))
    good = {w: t for w, t in where.items() if len(t) >= 3 and clean.get(w, 0) <= 0.02 * len(t) * share}
    left, chosen = set(range(len(toxic))), []
    for word in sorted(good, key=lambda w: (-len(good[w]), w)):
        fresh = [i for i in good[word] if i in left]
        if len(fresh) >= 2 and 4 * len(fresh) >= len(good[word]) or len(good[word]) >= 0.02 * len(toxic):
            chosen.append(word)
            left -= set(fresh)
    return chosen, [toxic[i] for i in sorted(left)]


def _sketched(words: list[str]) -> np.ndarray:
    """Subsequence weights of each word, hashed with signs to ``SKETCH`` numbers: dot products estimate the kernel."""
    symbols, starts = _flat(words)
    word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(symbols))))
    out = np.zeros((len(words), SKETCH), np.float32)
    for at, number, weight in _occurrences(symbols, starts):
        mixed = number * 2654435761 % (1 << 32)
        np.add.at(out, (word[at], (mixed >> 8) % SKETCH), np.where(mixed >> 31, weight, -weight))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _cover_alike(left: list[set[str]], clean: dict[str, int], negative: list[str]) -> list[str]:
    """Words for texts that no frequent word explains: those with like words in most of the other texts, and few clean ones."""
    left = sorted(left, key=lambda t: (len(t), sorted(t)))[:UNEXPLAINED]  # the shortest say most about their words
    pairs = [(w, i) for i, t in enumerate(left) for w in sorted(t) if w not in clean and len(w) > 3]
    while len(pairs) > 6000:
        left.pop()
        pairs = [(w, i) for w, i in pairs if i < len(left)]
    if len(left) < 2 or not pairs:
        return []
    words, owner = [w for w, _ in pairs], np.array([i for _, i in pairs])
    x, z = _sketched(words), _sketched(negative)
    near = np.concatenate([x[low : low + 500] @ x.T >= ALIKE for low in range(0, len(x), 500)])
    support = np.zeros((len(words), len(left)), bool)
    for i in range(len(left)):
        support[:, i] = near[:, owner == i].any(axis=1)
    against = np.zeros(len(words))
    for low in range(0, len(z), 2000):
        against += (x @ z[low : low + 2000].T >= ALIKE).sum(axis=1)
    open_, chosen = np.ones(len(left), bool), []
    while open_.any():
        gain = support[:, open_].sum(axis=1) - against
        best = int(gain.argmax())
        if gain[best] < 2:
            break
        group = near[best] & open_[owner]
        chosen += [words[i] for i in np.flatnonzero(group) if against[i] <= against[best] + 1]
        open_ &= ~support[best]
    return chosen


def fit(toxic: list[set[str]], clean: dict[str, int], clean_texts: int) -> Machine:
    """A machine from the word sets of toxic texts and the number of clean texts each word occurs in."""
    rng = np.random.default_rng(SEED)
    positive, left = _cover(_distinct(toxic), clean, clean_texts)
    names = sorted(clean)
    if not toxic or not clean:
        return _blank(toxic, clean_texts)
    often = sorted(names, key=lambda w: (-clean[w], w))[: NEGATIVES // 3]
    negative = set(often) | {names[i] for i in rng.choice(len(names), min(len(names), NEGATIVES), replace=False)}
    positive += _cover_alike(left, clean, sorted(negative))
    if not positive:
        return _blank(toxic, clean_texts)
    for _ in range(3):
        pos, neg = list(dict.fromkeys(positive)), sorted(negative - set(positive))
        picked = pos[: LANDMARKS // 2] + [neg[i] for i in rng.choice(len(neg), min(len(neg), LANDMARKS // 2), replace=False)]
        used, table = _landmark_table(picked)
        gram = _kernel(picked, (used, table))
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        kept = values > 1e-6 * values.max()
        root = vectors[:, kept] / np.sqrt(values[kept])
        z = _kernel(pos + neg, (used, table)) @ root.astype(np.float32)
        y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
        weight = np.concatenate([np.full(len(pos), len(neg) / len(pos)), np.ones(len(neg))])
        w = _svm(np.hstack([z, np.ones((len(z), 1), np.float32)]), y, weight)
        weights = np.zeros(NUMBERS, np.float32)
        weights[used >= 0] = (table @ (root @ w[:-1]))[used[used >= 0]]
        bias = float(w[-1])
        margins = score_words(names, weights, bias)
        hard = np.argsort(-margins)[:2000]
        negative |= {names[i] for i in hard if margins[i] > -0.7}
        worst = [_worst(sorted(t), weights, bias) for t in toxic]
        positive += sorted({word for word, margin in worst if margin > 0 and clean.get(word, 0) == 0})
    at_toxic = np.array([_worst(sorted(t), weights, bias)[1] for t in toxic])
    slope, offset = _curve(at_toxic, margins, np.array([clean[n] for n in names]), clean_texts)
    return Machine(weights, bias, slope, offset)


def _blank(toxic: list[set[str]], clean_texts: int) -> Machine:
    """Without a word to learn from, every text has the share of toxic texts as its probability."""
    return Machine(np.zeros(NUMBERS, np.float32), 0.0, 0.0, float(np.log((len(toxic) + 0.5) / (clean_texts + 0.5))))


def _worst(words: list[str], weights: np.ndarray, bias: float) -> tuple[str, float]:
    if not words:
        return "", -1.0
    margins = score_words(words, weights, bias)
    return words[int(np.argmax(margins))], float(margins.max())


def _curve(toxic: np.ndarray, clean_words: np.ndarray, occurrences: np.ndarray, clean_texts: int) -> tuple[float, float]:
    """Logistic curve through the margin that best parts toxic texts from clean ones.

    A clean text is above a cut if one of its words is: at most the summed occurrences of the words above it.
    """
    order = np.argsort(-clean_words)
    above, at = np.cumsum(occurrences[order]), clean_words[order]
    best, cut = -1.0, 0.0
    for c in np.linspace(-0.9, 1.0, 77):
        i = int(np.searchsorted(-at, -c, side="right"))
        wrong = min(1.0, (above[i - 1] if i else 0) / max(1, clean_texts))
        gain = float((toxic > c).mean()) - 6 * wrong  # clean texts are many more
        if gain > best + 1e-9:
            best, cut = gain, c
    slope = 8.0
    return slope, -slope * cut + float(np.log(THRESHOLD / (1 - THRESHOLD)))


def text_margins(texts: list[str | None], machine: Machine, known: dict[str, float]) -> np.ndarray:
    """Margin of the worst word of each text, -1 without words; ``known`` keeps the margins of words met before."""
    if len(known) > REMEMBERED:
        known.clear()
    words = [set(units(t)) for t in texts]
    new = list({w for own in words for w in own if w not in known})
    if new:
        known.update(zip(new, score_words(new, machine.weights, machine.bias).tolist()))
    return np.array([max(map(known.__getitem__, own)) if own else -1.0 for own in words])


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on a bounded sample, by hash, of labelled rows outside the held-out fold. Null labels and texts do not count.

    One task fits, as its arrays would crowd the driver's memory: it gets each word of the clean texts with its count, and the
    words of each toxic text. The driver gets the machine alone.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where("_toxic is not null and _id is not null").where(fold_column(F.col("_id"), FOLDS) != HELD_OUT).distinct()
    chosen = []
    for kind, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        chosen.append(known.where(F.col("_toxic") == kind).orderBy(F.xxhash64("_id", F.lit(SEED)), "_id").limit(rows))
    sample = written(chosen[0].unionAll(chosen[1]))
    clean_texts = sample.where("_toxic = 0").count()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kinds, texts in batches(rows, ["_toxic", "text"]):
            words = [sorted(set(units(t))) for t in texts]
            yield pa.record_batch({"toxic": pa.array(kinds, pa.int32()), "words": pa.array(words, pa.list_(pa.string()))})

    def learn(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        one: dict[str, str] = {}  # one string for each word
        texts = []
        for found, numbers, toxic in batches(rows, ["word", "n", "words"]):
            counts.update((one.setdefault(w, w), n) for w, n in zip(found, numbers) if w is not None)
            texts += [{one.setdefault(w, w) for w in own} for own in toxic if own is not None]
        del one
        machine = fit(texts, counts, clean_texts)
        yield pa.record_batch({"weights": pa.array([machine.weights.tobytes()], pa.binary()), **{name: pa.array([float(getattr(machine, name))]) for name in ("bias", "slope", "offset")}})

    joined = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string")).where("text is not null").join(sample, "_id").select("_toxic", "text")
    found = written(joined.mapInArrow(run, "toxic int, words array<string>"))
    clean = found.where("toxic = 0").select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    toxic = found.where("toxic = 1").select("words")
    gathered = clean.unionByName(toxic, allowMissingColumns=True).repartition(1)
    learned = gathered.mapInArrow(learn, "weights binary, bias double, slope double, offset double").collect()
    if not learned:  # no partition, no task
        return fit([], {}, clean_texts)
    return Machine(np.frombuffer(learned[0]["weights"], np.float32), learned[0]["bias"], learned[0]["slope"], learned[0]["offset"])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted, margin) for every row; null and empty texts score by the curve at margin -1."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # one number per subsequence: a fixed 4 MB

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for ids, texts in batches(rows, ["doc_id", "text"]):
            margins = text_margins(texts, model.value, known)
            p = model.value.probability(margins)
            yield pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([fold(i, FOLDS) == HELD_OUT for i in ids]), "score": pa.array(p),
                "predicted": pa.array((p >= THRESHOLD).astype(np.int32)), "margin": pa.array(margins),
            })

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, margin double")


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every row by a machine that learns from labelled rows of the training folds alone.

    Null and empty texts get the score of a text without any word. Labels that are null, or of documents that do not exist,
    are not used; repeated rows score alike. Without labels of both kinds the machine knows no toxic word. No rows give no rows.
    """
    return score(docs, train(docs, labels))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, texts untouched.

    Null and empty texts have no toxic word and stay; repeated rows are judged alike, so all copies stay or go.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    @F.pandas_udf("boolean")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for texts in parts:
            yield pd.Series(model.value.probability(text_margins(texts.tolist(), model.value, known)) < THRESHOLD)

    return docs.where(clean(F.col("text")))
