"""Token ids in a word-aligned binary format: Simple-8b with escapes and block offsets.

Every 64-bit word holds a selector in its top four bits and, below, as many ids of one width as the selector says:
120 zeros or 60 x 1, 30 x 2, 20 x 3, ... 1 x 60 bits. Selector 15 is an escape: the word after it is one raw 64-bit value.
Ids are cut into blocks of 512; a word never crosses a block, and the offset of each block's first word is kept, so all
blocks decode at once with numpy. A file is a Parquet table of chunks: whole documents in ascending doc_id, the words,
the block offsets, the places of raw words and the number of ids before the chunk in its part.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lossgrid.llm.transducer import check_supported
from lossgrid.session import run_dir

#: Fixed values of the format: selector -> (ids in a word, bits of each).
PACKING = [(120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
BLOCK = 512
CHUNK_IDS = 1 << 17
END_ID = 2
#: Pieces of text a worker remembers before it forgets half of them, and the characters of the longest it remembers.
PIECES, LONGEST = 800_000, 100
#: Bytes of text handled at once, but for longer texts.
POOL_BYTES = 1 << 22
#: Characters handed to the library at once, but for longer pieces.
LIBRARY_CHARS = 200_000
#: Pieces without white space beyond a leading space or line feed.
PLAIN = r"^[ \n]?[!-~\x{A1}-\x{AC}\x{AE}-\x{167F}\x{1681}-\x{180A}\x{1810}-\x{1FFF}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{2070}-\x{2FFF}\x{3001}-\x{FEFE}\x{FF00}-\x{FFF8}]+$"
CHUNKS = "part int, seq int, before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, words binary, offsets binary, raw binary"


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, positions of raw words) for unsigned 64-bit ids."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    blocks, pad = -(-n // BLOCK), PACKING[0][0]
    grid = np.zeros((blocks, BLOCK + pad), np.uint64)  # zeros after a block's end fit everywhere
    grid[: n // BLOCK, :BLOCK] = ids[: n // BLOCK * BLOCK].reshape(-1, BLOCK)
    grid[n // BLOCK :, : n % BLOCK] = ids[n // BLOCK * BLOCK :]
    grid = grid.ravel()
    place = np.arange(n)
    left = np.minimum(BLOCK - place % BLOCK, n - place)
    selector = np.full(len(grid), ESCAPE, np.int8)
    top = int(ids.max())
    widest = next((s for s, (_, bits) in enumerate(PACKING) if top < 1 << bits), len(PACKING) - 1)  # wider ones are never needed
    for s in range(widest, -1, -1):
        count, bits = PACKING[s]
        fits, reach = grid < np.uint64(1 << bits), 1  # whether the ids from here on fit, as many as ``reach``
        while reach < count and fits.any():
            step = min(reach, count - reach)
            fits[:-step] &= fits[step:]
            reach += step
        selector[fits] = s
    selector = selector.reshape(blocks, -1)[:, :BLOCK].ravel()[:n]
    jump = np.minimum(np.array([count for count, _ in PACKING] + [1])[selector], left)
    at, begins = np.arange(0, n, BLOCK), np.zeros(n, bool)
    ends = np.minimum(at + BLOCK, n)
    while len(at):
        begins[at] = True
        at = at + jump[at]
        more = at < ends
        at, ends = at[more], ends[more]
    starts = np.flatnonzero(begins)
    chosen, held = selector[starts], jump[starts]
    width = 1 + (chosen == ESCAPE)
    offset = np.cumsum(width) - width
    packed = np.zeros(int(width.sum()), np.uint64)
    padded = np.concatenate([ids, np.zeros(128, np.uint64)])
    for s, (count, bits) in enumerate(PACKING):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            word = np.full(len(mine), s << 60, np.uint64)
            for k in range(count if bits else 0):
                value = np.where(k < held[mine], padded[starts[mine] + k], np.uint64(0))
                word |= value << np.uint64(k * bits)
            packed[offset[mine]] = word
    mine = np.flatnonzero(chosen == ESCAPE)
    packed[offset[mine]] = np.uint64(ESCAPE << 60)
    packed[offset[mine] + 1] = ids[starts[mine]]
    return packed, offset[np.searchsorted(starts, np.arange(0, n, BLOCK))].astype(np.int32), (offset[mine] + 1).astype(np.int32)


def decode(packed: np.ndarray, offsets: np.ndarray, raw: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids, all blocks at once: one pass per selector."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (packed >> np.uint64(60)).astype(np.int64)
    selector[raw] = -1
    counts = np.array([c for c, _ in PACKING] + [1, 0])[selector]  # the last entry is for raw words
    before = np.cumsum(counts) - counts
    block = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets, len(packed))))
    place = block * BLOCK + before - before[offsets][block]
    limit = np.minimum((block + 1) * BLOCK, n)
    for s, (count, bits) in enumerate(PACKING):
        mine = np.flatnonzero(selector == s)
        if bits and len(mine):
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                to = place[mine] + k
                inside = to < limit[mine]
                out[to[inside]] = (packed[mine[inside]] >> np.uint64(k * bits)) & mask
    if len(raw):
        out[place[raw - 1]] = packed[raw]
    return out


def _doubtful() -> np.ndarray:
    """UTF-8 of the characters beyond ASCII that may be white space, as numbers; they are separators, controls or formats."""
    kinds = ("Zs", "Zl", "Zp", "Cc", "Cf")
    return np.array([int.from_bytes(chr(c).encode(), "big") for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) in kinds], np.int32)


DOUBTFUL = _doubtful()


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Which bytes of a UTF-8 text start a piece: a space, tab or line end after a character that is not white space and, in
    ASCII, a sign after a letter or digit. The vocabulary's pattern always cuts there, and looks ahead no farther."""
    blank = (data == 32) | (data == 9) | (data == 10) | (data == 13)
    plain = (data > 32) & (data < 127)
    word = ((data | 32) - 97 < 26) | (data - 48 < 10)
    starts = np.zeros(len(data), bool)
    starts[1:] = blank[1:] & plain[:-1] | word[:-1] & (plain & ~word)[1:]
    open_ = 1 + np.flatnonzero(blank[1:] & (data[:-1] > 127))
    before = data[np.maximum(open_[:, None] - [3, 2, 1], 0)].astype(np.int32)
    code = before[:, 1] << 8 | before[:, 2]
    starts[open_[~np.isin(np.where(before[:, 1] < 0xC0, before[:, 0] << 16 | code, code), DOUBTFUL)]] = True
    return starts


class PieceEncoder:
    """Encodes texts with a tokenizer of the tokenizers library, each different piece of text about once per worker.

    Texts are handled many at once: numpy finds where pieces start, Arrow numbers the different ones, only these are looked
    up among the pieces met before, and numpy puts the ids of all pieces in a row. A special token's string is never cut.
    Pieces not known yet are encoded together, a line feed between two of them, and the ids are cut at the line feed's id;
    pieces in which that could change something are encoded one by one. Where the pattern is not the one of byte-level
    vocabularies, a text is one piece. Long pieces are not remembered.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            source = json.load(file)
        self.special = [t["content"] for t in source["added_tokens"]]
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        try:
            check_supported(source)
            self.cuts = True
        except ValueError:
            self.cuts = False
        self.known: dict[str, int] = {}
        #: Ids of the known pieces in a row, where those of each begin, how many they are, and in how many pools it was met.
        self.flat, self.first, self.size, self.met = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Offsets of the pieces of joined texts."""
        starts = piece_starts(data) if self.cuts else np.zeros(len(data), bool)
        joined = data.tobytes()
        for special in (s.encode() for s in self.special):
            at = joined.find(special)
            while at >= 0:
                starts[at + 1 : at + len(special)] = False
                at = joined.find(special, at + 1)
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.append(np.flatnonzero(starts), len(data))

    def _encoded(self, keys: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each has), from the library."""
        together = np.zeros(len(keys), bool)
        if self.cuts and self.feed is not None:
            together = pc.match_substring_regex(keys, PLAIN).to_numpy(zero_copy_only=False)
            for special in self.special:
                together &= ~pc.match_substring(keys, special).to_numpy(zero_copy_only=False)
        texts = keys.to_numpy(zero_copy_only=False)
        found: list[np.ndarray] = [None] * len(keys)
        for some, is_plain in ((np.flatnonzero(together), True), (np.flatnonzero(~together), False)):
            chars = np.cumsum([len(texts[i]) for i in some])
            for part in np.split(some, 1 + np.flatnonzero(np.diff(chars // LIBRARY_CHARS))) if len(some) else ():
                if not is_plain:
                    found_here = self._ids(texts[part].tolist())
                else:
                    words = [t[1:] if t[0] == "\n" else t for t in texts[part]]
                    flat = np.concatenate(self._ids(["\n" + "\n".join(words[i : i + 500]) for i in range(0, len(words), 500)]))
                    feeds = np.flatnonzero(flat == self.feed).tolist()
                    found_here = [flat[low + (texts[i][0] != "\n") : high] for i, low, high in zip(part.tolist(), feeds, feeds[1:] + [len(flat)], strict=True)]
                for i, ids in zip(part.tolist(), found_here):
                    found[i] = ids
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def _numbers(self, keys: pa.StringArray) -> np.ndarray:
        """Numbers of different pieces; those met for the first time are encoded and get the next ones."""
        texts = keys.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter((self.known.get(t, -1) for t in texts), np.int64, len(texts))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            short = np.array([len(texts[i]) <= LONGEST for i in new])
            new, kept = np.concatenate([new[short], new[~short]]), int(short.sum())
            flat, size = self._encoded(keys.take(pa.array(new)))
            numbers[new] = len(self.size) + np.arange(len(new))
            self.known.update(zip([texts[i] for i in new[:kept]], numbers[new[:kept]].tolist()))
            self.first = np.append(self.first, len(self.flat) + np.cumsum(size) - size)
            self.flat, self.size, self.met = np.append(self.flat, flat), np.append(self.size, size), np.append(self.met, np.zeros(len(new), np.int64))
        self.met[numbers] += 1
        return numbers

    def _row(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the numbered pieces in a row, where those of each end)."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.first[numbers] - ends + size, size) + np.arange(int(size.sum()))], ends

    def _forget(self) -> None:
        """Forget long pieces and, of too many, the half that was met in the fewest pools."""
        n = len(self.known)
        if n < len(self.size):  # long pieces have the last numbers
            self.flat, self.first, self.size, self.met = self.flat[: self.first[n]].copy(), self.first[:n], self.size[:n], self.met[:n]
        if n > PIECES:
            kept = np.sort(np.argsort(-self.met, kind="stable")[: PIECES // 2])
            self.flat, ends = self._row(kept)
            self.size, self.met = self.size[kept], self.met[kept] // 2
            self.first = ends - self.size
            texts = list(self.known)
            self.known = {texts[i]: n for n, i in enumerate(kept.tolist())}

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where those of each end); a null text is empty."""
        texts = pa.concat_arrays([texts.fill_null("")])  # without an offset
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cuts = self._pieces(data, offsets)
        pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        numbers = self._numbers(pieces.dictionary)
        flat, ends = self._row(numbers[pieces.indices.to_numpy()])
        self._forget()
        return flat, np.append(0, ends)[np.searchsorted(cuts, offsets[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        flat, ends = self.ids(pa.array(texts, pa.string()))
        return [ids.astype("<u4").tobytes() for ids in np.split(flat, ends)[: len(texts)]]


@lru_cache(maxsize=2)
def _encoder(tokenizer_path: str) -> PieceEncoder:
    """One encoder per worker process, which keeps its pieces from task to task."""
    return PieceEncoder(tokenizer_path)


def _pools(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.StringArray]]:
    """(ids, texts) of rows, some megabytes of text at once; a longer text ends its pool."""
    doc_ids, texts, held = [], [], 0
    for batch in rows:
        ids, column = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.string())
        ends = held + np.cumsum(np.append(0, pc.binary_length(column).fill_null(0)))
        low = 0
        for high in (1 + np.flatnonzero(np.diff(ends // POOL_BYTES))).tolist():
            yield doc_ids + ids[low:high], pa.concat_arrays([*texts, column.slice(low, high - low)])
            doc_ids, texts, low = [], [], high
        doc_ids += ids[low:]
        texts.append(column.slice(low))
        held = int(ends[-1]) % POOL_BYTES
    if doc_ids:
        yield doc_ids, pa.concat_arrays(texts)


def _chunks(tokenizer_path: str, end_id: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _encoder(tokenizer_path)
        end = np.array([end_id], np.uint32)
        seq, before, held, ids, found, lengths = 0, 0, 0, [], [], []

        def chunk() -> pa.RecordBatch:
            flat = np.concatenate(found).astype(np.uint64)
            packed, offsets, raw = encode(flat)
            values = {
                "part": part, "seq": seq, "before": before, "n_ids": len(flat), "doc_ids": ids, "lengths": lengths,
                "words": packed.tobytes(), "offsets": offsets.tobytes(), "raw": raw.tobytes(),
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.record_batch([pa.array([v], k) for v, k in zip(values.values(), kinds)], names=list(values))

        for doc_ids, texts in _pools(rows):
            flat, ends = encoder.ids(texts)
            for doc_id, coded in zip(doc_ids, np.split(flat, ends)):
                ids.append(doc_id)
                found += [coded, end]
                lengths.append(len(coded) + 1)
                held += lengths[-1]
                if held >= CHUNK_IDS:
                    yield chunk()
                    seq, before, held, ids, found, lengths = seq + 1, before + held, 0, [], [], []
        if ids:
            yield chunk()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Write the ids of all texts, each closed by ``end_id``, in ascending doc_id; null ids come first, ties by text.

    Null texts count as empty and hold the end id alone; repeated rows are written as often as they occur. ``docs``
    needs doc_id and text, other columns are not read. A chunk holds whole documents.
    """
    ordered = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_chunks(tokenizer_path, end_id), CHUNKS).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files.

    ``start`` counts the ids of all documents before it: those before it in its part, which the chunk knows, and the
    totals of earlier parts, one number per part.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in rows for r in batch.to_pylist()):
            ids = decode(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["offsets"], np.int32), np.frombuffer(row["raw"], np.int32), row["n_ids"])
            lengths = np.array(row["lengths"], np.int64)
            starts = np.cumsum(lengths) - lengths
            flat = ids.astype("<u4")
            crc = [zlib.crc32(flat[s : s + n]) for s, n in zip(starts, lengths)]
            yield pa.record_batch({
                "part": pa.array(np.full(len(lengths), row["part"]), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "within": pa.array(starts + row["before"]), "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc, pa.int64()),
            })

    chunks = spark.read.schema(CHUNKS).parquet(path)
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    earlier = totals.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    decoded = chunks.mapInArrow(run, "part int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    return decoded.join(earlier, "part").select("doc_id", (F.col("within") + F.col("earlier")).alias("start"), "n_tokens", "ids_crc32")


def op1(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row, read back from the written files.

    Null and empty texts hold the end id alone. Null ids come first, rows with one id go by text, and repeated rows are
    written as often as they occur. No rows give no rows. Columns besides doc_id and text are not read.
    """
    import uuid

    spark = docs.sparkSession
    path = f"{folder or run_dir(spark)}/token_ids/{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer_path)
    return read_documents(spark, path)
