"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

A sketch therefore grows with its text, and its limit does not depend on the text. Two sketches, of one fraction or two, are
compared below the lower of their limits, where both are complete: a short text can be held against a very long one, and
sketches of parts merge by union. Of n shingles about n / 8 are kept, so a share p is estimated with a standard error of about
sqrt(7 p (1 - p) / n): at p = 0.5, 0.06 for 500 shingles and 0.19 for 50. Where neither text keeps a hash, nothing is known of
their shingles, and likeness tells equal words from other ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lossgrid.llm.common import batches, lower_words, shingle_spans, written

SHINGLE, SEED = 5, 17
#: Hashes have 32 bits; those below FRACTION of the range are kept.
RANGE, FRACTION = 1 << 32, 1 / 8


class Sketch:
    """All distinct hashes of a set of shingles below ``limit``, sorted."""

    def __init__(self, hashes: np.ndarray, limit: int = int(RANGE * FRACTION)) -> None:
        self.hashes, self.limit = hashes[: np.searchsorted(hashes, limit)], limit

    @classmethod
    def of(cls, text: str | None, size: int = SHINGLE, fraction: float = FRACTION) -> Sketch:
        joined, starts, ends = shingle_spans(lower_words(text), size)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts)) >> np.uint64(32)
        return cls(np.unique(hashes[hashes < np.uint64(RANGE * fraction)]).astype(np.int64), int(RANGE * fraction))

    @classmethod
    def unpack(cls, data: bytes) -> Sketch:
        """The sketch of its binary form: the limit in five bytes, then each hash in four."""
        return cls(np.frombuffer(data[5:], ">u4").astype(np.int64), int.from_bytes(data[:5], "big"))

    def pack(self) -> bytes:
        return self.limit.to_bytes(5, "big") + self.hashes.astype(">u4").tobytes()

    def text(self) -> str:
        return self.pack().hex()

    def merge(self, other: Sketch) -> Sketch:
        """Sketch of the union of both shingle sets."""
        return Sketch(np.union1d(self.hashes, other.hashes), min(self.limit, other.limit))

    def _common(self, other: Sketch) -> tuple[int, int, int]:
        limit = min(self.limit, other.limit)
        a, b = (x.hashes[: np.searchsorted(x.hashes, limit)] for x in (self, other))
        return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))

    def likeness(self, other: Sketch) -> float:
        """Estimated share of common shingles among all of both; two sketches without hashes are alike."""
        a, b, both = self._common(other)
        return both / (a + b - both) if a + b else 1.0

    def inside(self, other: Sketch) -> float:
        """Estimated share of this text's shingles that the other has."""
        a, _, both = self._common(other)
        return both / a if a else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


ROW = "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, inside_edited double"
KEPT = f"kind int, part int, {ROW}, head string, tail string"


def _compare(doc_id: int | None, text: str, own: Sketch, following: str, next_sketch: Sketch) -> tuple:
    changed = edited(text, following)
    other = Sketch.of(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "replace")).digest()
    near = [own.likeness(s) if len(own.hashes) or len(s.hashes) else float(lower_words(text) == lower_words(t)) for s, t in ((other, changed), (next_sketch, following))]
    return doc_id, len(text), digest, own.pack(), other.pack(), *near, own.inside(other)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.strip().split() for f in schema.split(",")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.record_batch([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _in_order(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document against the next one of its partition; the first and last texts go on to the step after."""
    part, first, last = TaskContext.get().partitionId(), None, None
    blank = (None,) * 8
    for ids, texts in batches(rows, ["doc_id", "text"]):
        out = []
        for doc_id, text in zip(ids, texts):
            text = text or ""
            own = Sketch.of(text)
            if last is not None:
                out.append((0, part, *_compare(*last, text, own), None, None))
            else:
                first = text
            last = (doc_id, text, own)
        if out:
            yield _batch(out, KEPT)
    if last is not None:
        yield _batch([(1, part, last[0], *blank[1:], first, last[1])], KEPT)


def _seams(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, tails, heads in batches(rows, ["doc_id", "tail", "following"]):
        yield _batch([_compare(i, t, Sketch.of(t), h, Sketch.of(h)) for i, t, h in zip(ids, tails, heads)], ROW)


def op6(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, in descending doc_id, ties by text, null ids last.

    Null texts count as empty. A lone document is its own successor. Texts move once, by range of doc_id; the documents
    at the end of a partition, one per partition, meet their successor in a second step.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()]
    chosen = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranged = chosen.repartitionByRange(order[0], F.xxhash64("text")).sortWithinPartitions(order[0], F.xxhash64("text"), order[1])
    kept = written(ranged.mapInArrow(_in_order, KEPT))
    ends = kept.where("kind = 1").select("part", "doc_id", "head", "tail")
    lone = Window.orderBy("part")
    numbered = ends.select("part").select("part", F.lead("part").over(lone).alias("after"), F.min("part").over(lone.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("start"))
    pairs = numbered.select("part", F.coalesce("after", "start").alias("after"))
    seams = ends.select("part", "doc_id", "tail").join(pairs, "part").join(ends.select(F.col("part").alias("after"), F.col("head").alias("following")), "after")
    names = [f.strip().split()[0] for f in ROW.split(",")]
    found = kept.where("kind = 0").select(*names).unionByName(seams.select("doc_id", "tail", "following").mapInArrow(_seams, ROW))
    return found.select(*[F.lower(F.hex(n)).alias(n) if "sha256" in n or "fingerprint" in n else F.col(n) for n in names])
