"""Prefix trie of conversations: member intervals by range minima over sorted longest common prefixes.

Conversations are sequences of turns. Sorted by their turns, the members of each prefix are neighbours, and a prefix of
depth d ends where the longest common prefix (LCP) of two neighbours is below d. So each candidate, a conversation and a
depth, searches its interval by itself: a sparse table of range minima over the LCPs is descended by powers of two, to the
left and to the right. The candidate that is the first of its interval stands for the node.

The sorted rows are cut into blocks, each worked on by one task; only the LCPs across the cuts are shared. What a node holds
adds up over blocks: members, children, leaves and saved tokens are sums over its rows. A node inside one block is done
there; one that crosses a cut gives a part per block, and these few parts are merged by the digest of the prefix. Many
copies of one conversation are therefore spread over blocks. A turn is held as 16 bytes of a SHA-256 and its code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossgrid.llm.common import parallelism, written

GROUP, HEADS = 100, 6
TURN = 16
#: Conversations of a block, about; a bound on what one task holds besides the number of partitions.
BLOCK_ROWS = 100_000
SORTED = "block int, conv_id bigint, key binary, chars array<bigint>"
NODES = (
    "depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, "
    "crosses boolean, prefix binary, parent_prefix binary, block int, ends binary"
)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of each conversation: an array of (hash, chars) ordered by turn, null first.

    Equal turn numbers go by role and then by the hash of role and text; a null role or text counts as empty.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN)
    rows = turns.select(F.col("conv_id").cast("bigint"), F.struct(F.col("turn").cast("bigint"), role.alias("role"), digest.alias("hash"), F.length(text).cast("bigint").alias("chars")).alias("t"))
    ordered = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["hash"].alias("hash"), t["chars"].alias("chars"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, key, chars): the first h turns of conversation c - c % 100, then c's own after its first h; h = crc32(c) % 6.

    ``key`` is the turns' hashes in a row, so byte order is the order of sequences.
    """
    own = written(sequences(turns))
    heads = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, HEADS - 1).alias("_head"))
    take = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.withColumn("_h", take).withColumn("_base", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "_base", "left")
    whole = F.expr("concat(slice(coalesce(_head, slice(turns, 1, 0)), 1, _h), slice(turns, _h + 1, greatest(size(turns), 1)))")
    made = joined.select("conv_id", whole.alias("t"))
    return made.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["hash"]), "")).alias("key"), F.transform("t", lambda t: t["chars"]).alias("chars"))


def common_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns two keys share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    differ = np.flatnonzero(np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8))
    return int(differ[0]) // TURN


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values; the k-th row is indexed by the start of the run."""
    rows, width = [values], 1
    while 2 * width <= len(values):
        rows.append(np.minimum(rows[-1][:-width], rows[-1][width:]))
        width *= 2
    return rows


def extents(lcp: np.ndarray, rows: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the interval around each row whose neighbours share at least its depth of turns.

    ``lcp[i]`` is what rows i - 1 and i share. Each candidate descends the sparse table by itself, in either direction.
    """
    table, last = sparse_table(lcp), len(lcp) - 1
    left, right = rows.copy(), rows.copy()
    for k in range(len(table) - 1, -1, -1):
        reach = 1 << k
        can = left - reach >= 0
        left -= reach * (can & (table[k][np.where(can, left - reach + 1, 0)] >= depths))
        can = right + reach <= last
        right += reach * (can & (table[k][np.where(can, right + 1, 0)] >= depths))
    return left, right


def range_minimum(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of the values first..last of a sparse table, from two runs that overlap."""
    k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), np.int64)
    for level in np.unique(k).tolist():
        mine = k == level
        out[mine] = np.minimum(table[level][first[mine]], table[level][last[mine] - (1 << level) + 1])
    return out


def block_nodes(conv: np.ndarray, keys: list[bytes], chars: list[np.ndarray], before: int, after: int) -> dict[str, list]:
    """The nodes of a sorted block, or their parts; ``before`` and ``after`` are the LCPs across its cuts, -1 at the ends."""
    m = len(keys)
    length = np.array([len(k) // TURN for k in keys], np.int64)
    lcp = np.array([before] + [common_turns(keys[i - 1], keys[i]) for i in range(1, m)], np.int64)
    following = np.append(lcp[1:], after)
    first = np.cumsum(length + 1) - (length + 1)
    row = np.repeat(np.arange(m), length + 1)
    depth = np.arange(len(row)) - first[row]
    left, right = extents(lcp, row, depth)
    #: code points of the first d turns of each row
    path = np.zeros(len(row), np.int64)
    path[depth > 0] = np.concatenate([np.asarray(c, np.int64) for c in chars]) if m else 0
    path = np.cumsum(path)
    path -= path[first][row]
    shared = np.maximum(np.minimum(lcp, length), 0)
    saved_before = np.concatenate(([0], np.cumsum(path[first + shared])))
    leaf_before = np.concatenate(([0], np.cumsum(length > following)))
    node = first[left] + depth  # the candidate that stands for each candidate's node in this block
    child = depth > np.maximum(lcp, 0)[row]
    children = np.bincount(node[np.flatnonzero(child) - 1], minlength=len(row))
    ending = np.bincount(node[first + length], minlength=len(row))
    picked = np.flatnonzero(left == row)
    l, r, d = row[picked], right[picked], depth[picked]
    starts_here = lcp[l] < d
    counted = r - l + 1 - starts_here
    above = np.where(d > 0, path[np.maximum(picked - 1, 0)], 0)
    saved = saved_before[r + 1] - saved_before[l] - np.where(starts_here, path[first + shared][l], 0) - counted * above
    crosses = ((l == 0) & (lcp[0] >= d)) | ((r == m - 1) & (after >= d))
    least = range_minimum(sparse_table(conv), l, r)
    place = np.full(len(row), -1)
    place[picked] = np.arange(len(picked))
    parent = np.where(d > 0, place[node[np.maximum(picked - 1, 0)]], -1)
    out: dict[str, list] = {
        "depth": d.tolist(), "conv_id": least.tolist(), "n_convs": (r - l + 1).tolist(), "n_children": children[picked].tolist(),
        "n_leaves": (leaf_before[r + 1] - leaf_before[l]).tolist(), "saved_tokens": saved.tolist(), "crosses": crosses.tolist(),
    }
    ids = [str(c) for c in conv.tolist()]
    empty = hashlib.sha256(b"").hexdigest()
    digests, prefixes, listed, parents, parent_prefixes = [], [], [], [], []

    def prefix(i: int, depth_: int) -> bytes:
        return hashlib.sha256(keys[i][: TURN * depth_]).digest()

    for i, (a, dd, e, over, p) in enumerate(zip(l.tolist(), d.tolist(), ending[picked].tolist(), out["crosses"], parent.tolist())):
        ends = ",".join(ids[a : a + e]).encode()
        digests.append(None if over else hashlib.sha256(ends).hexdigest() if e else empty)
        prefixes.append(prefix(a, dd) if over else None)
        listed.append(ends if over else None)
        open_parent = p >= 0 and out["crosses"][p]
        parents.append(None if p < 0 or open_parent else out["conv_id"][p])
        parent_prefixes.append(prefix(a, dd - 1) if open_parent else None)
    return out | {"ends_sha256": digests, "prefix": prefixes, "ends": listed, "parent_conv_id": parents, "parent_prefix": parent_prefixes}


def _blocks(cuts: dict[int, tuple[int, int]]):
    """Nodes of each block of rows sorted by (block, key, conv_id)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
            ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("crosses", pa.bool_()), ("prefix", pa.binary()), ("parent_prefix", pa.binary()), ("block", pa.int32()), ("ends", pa.binary()),
        ])

        def finish() -> Iterator[pa.RecordBatch]:
            made = block_nodes(np.array(conv, np.int64), keys, chars, *cuts[now])
            made["block"] = [now] * len(made["depth"])
            yield from pa.Table.from_pydict({f.name: made[f.name] for f in schema}, schema=schema).to_batches(max_chunksize=20_000)

        now, conv, keys, chars = None, [], [], []
        for batch in rows:
            for block, c, key, n in zip(*[batch.column(x).to_pylist() for x in ("block", "conv_id", "key", "chars")]):
                if block != now:
                    if conv:
                        yield from finish()
                    now, conv, keys, chars = block, [], [], []
                conv.append(c)
                keys.append(key)
                chars.append(n)
        if conv:
            yield from finish()

    return run


def _ends(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per prefix over its parts in order, as a stream: no list of ids is held whole."""
    now, digest, some = None, None, False
    for batch in rows:
        for prefix, ends in zip(batch.column("prefix").to_pylist(), batch.column("ends").to_pylist()):
            if prefix != now:
                if now is not None:
                    yield pa.record_batch([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["prefix", "ends_sha256"])
                now, digest, some = prefix, hashlib.sha256(), False
            if ends:
                digest.update((b"," if some else b"") + ends)
                some = True
    if now is not None:
        yield pa.record_batch([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["prefix", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of (conv_id, key, chars); see ``op13`` for the columns."""
    spark = conversations.sparkSession
    rows = written(conversations)
    parts = max(parallelism(spark), -(-rows.count() // BLOCK_ROWS))
    cut = written(rows.repartitionByRange(parts, "key", "conv_id").withColumn("block", F.spark_partition_id()))
    ends = cut.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("block").collect()  # two keys a block
    shared = [-1, *[common_turns(a["last"], b["first"]) for a, b in zip(ends, ends[1:])], -1]
    cuts = {row["block"]: (shared[i], shared[i + 1]) for i, row in enumerate(ends)}
    placed = cut.repartition(parts, "block").sortWithinPartitions("block", "key", "conv_id").select("block", "conv_id", "key", "chars")
    nodes = written(placed.mapInArrow(_blocks(cuts), NODES))
    crossing = nodes.where("crosses")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = crossing.groupBy("prefix").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_prefix").alias("parent_prefix"), *sums)
    lists = crossing.select("prefix", "block", "ends").repartition("prefix").sortWithinPartitions("prefix", "block").mapInArrow(_ends, "prefix binary, ends_sha256 string")
    wide = written(merged.join(lists, "prefix"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    every = nodes.where("not crosses").select(*columns, "parent_prefix").unionByName(wide.withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*columns, "parent_prefix"))
    above = wide.select(F.col("prefix").alias("parent_prefix"), F.col("conv_id").alias("_parent"))
    found = every.where("parent_prefix is not null").join(above, "parent_prefix").withColumn("parent_conv_id", F.col("_parent"))
    return every.where("parent_prefix is null").select(*columns).unionByName(found.select(*columns))


def op13(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of rebuilt conversations, the root included.

    Rows without conv_id take no part; null roles and texts count as empty; rows with equal (conv_id, turn) go by role and
    hash, and repeated rows are turns of their own. Without any conversation the result is empty. Other columns are not read.
    """
    return trie(rebuilt(turns))


def _sql() -> str:
    """crc32 is spelled out: eight conditional shifts for each byte of the decimal id."""
    return f"""WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, s, 0 AS step, CAST(4294967295 AS BIGINT) AS v FROM ids
UNION ALL SELECT c, s, step + 1, (CASE WHEN w % 2 = 1 THEN xor(w // 2, CAST(3988292384 AS BIGINT)) ELSE w // 2 END)
FROM (SELECT c, s, step, CASE WHEN step % 8 = 0 THEN xor(v, CAST(ascii(s[step // 8 + 1]) AS BIGINT)) ELSE v END AS w FROM crc WHERE step < 8 * length(s))),
heads AS (SELECT c, CAST(xor(v, CAST(4294967295 AS BIGINT)) % {HEADS} AS INTEGER) AS h FROM crc WHERE step = 8 * length(s)),
own AS (SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''),
sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:{2 * TURN}]) AS t
FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
whole AS (SELECT o.c, list_concat(coalesce(b.t, [])[1:h.h], o.t[h.h + 1:]) AS t FROM own o JOIN heads h USING (c) LEFT JOIN own b ON b.c = o.c - o.c % {GROUP}),
members AS (SELECT c, d, t[1:d] AS p, len(t) = d AS last, CASE WHEN d > 0 THEN length(t[d].text) END AS chars FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM whole)),
nodes AS (SELECT d, p, min(c) AS c, count(*) AS n, any_value(chars) AS chars,
sha256(coalesce(string_agg(CASE WHEN last THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends FROM members GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1, 2),
own_nodes AS (SELECT n.*, coalesce(k.k, 0) AS k FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.p = n.p),
up AS (SELECT e AS d, p[1:e] AS p, k, (n - 1) * coalesce(chars, 0) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM own_nodes)),
below AS (SELECT d, p, CAST(sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS BIGINT) AS leaves, CAST(sum(saved) AS BIGINT) AS saved FROM up GROUP BY d, p)
SELECT n.c AS conv_id, n.d AS depth, q.c AS parent_conv_id, n.n AS n_convs, n.k AS n_children, b.leaves AS n_leaves, b.saved AS saved_tokens, n.ends AS ends_sha256
FROM own_nodes n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = n.p[1:n.d - 1]"""


SQL_OP13 = _sql()
