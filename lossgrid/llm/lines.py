"""Line dedup by distinct-site spread.

Each line hash has a HyperLogLog sketch of the sites it occurs on, kept as rows (line, register, rank) that merge by
taking the maximum. The estimate of the merged sketch settles lines clearly above the threshold: while registers are empty
and the estimate is small, it is a count of filled registers and sites fill no more registers than they are, so an estimate
of at least that of ``sites`` filled registers proves them; for thresholds of more sites than registers, an estimate
``SURE`` standard errors above the threshold is taken (it errs once in about 3 million such lines). Lines with fewer
occurrences than the threshold cannot reach it. All lines between get an exact count of distinct sites; none is dropped on
its estimate. Of a line that reaches the threshold only the first occurrence stays, so the text of a page that was copied to
many sites is kept once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.llm.common import SPACE, by_key, columns, fresh, written

#: Distinct sites that make a line boilerplate.
SITES = 6
#: Words from which a line is a passage, and the documents that make it a repeated one, on whatever sites they are.
LONG, COPIES = 50, 2
#: HyperLogLog: registers (a power of two), their bias constant, and the standard errors that settle a large estimate.
REGISTERS, SURE = 256, 5
ALPHA = 0.7213 / (1 + 1.079 / REGISTERS)


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, key, pos, line, site): the lines of each text that are not blank, as hashes of their trimmed text."""
    base = docs.select(F.col("doc_id"), F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.col(site)).alias("site"), F.split("text", "\n").alias("_lines"))
    split = base.select("doc_id", "key", "site", F.posexplode("_lines").alias("pos", "_line"))
    long = (F.size(F.split(F.trim("_line"), f"[{SPACE}]+")) >= LONG).alias("long")
    return split.withColumn("_line", F.trim("_line")).where("_line <> ''").select("doc_id", "key", "pos", F.xxhash64("_line").alias("line"), "site", long)


def _estimate(inverse: Column, used: Column) -> Column:
    """Cardinality from the sum of 2^-rank over used registers: linear counting while registers are empty and it is small."""
    m = float(REGISTERS)
    raw = ALPHA * m * m / (inverse + (m - used))
    empty = m - used
    return F.when((raw <= 2.5 * m) & (empty > 0), m * F.log(m / empty)).otherwise(raw)


def spread(lines: DataFrame) -> DataFrame:
    """(line, estimate, used, n): distinct sites per line by its HyperLogLog sketch, registers filled, and occurrences."""
    bits = REGISTERS.bit_length() - 1
    rest = F.shiftrightunsigned("site", bits)
    rank = F.expr(f"{64 - bits} - if(rest = 0, 0, int(floor(log2(double(rest)))) + 1) + 1")
    registers = lines.select("line", F.col("site").bitwiseAND(F.lit(REGISTERS - 1)).alias("register"), rest.alias("rest")).withColumn("rank", rank)
    merged = registers.groupBy("line", "register").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
    sketch = merged.groupBy("line").agg(F.sum(F.expr("pow(2D, -rank)")).alias("inverse"), F.count("*").alias("used"), F.sum("n").alias("n"))
    return sketch.select("line", _estimate(F.col("inverse"), F.col("used")).alias("estimate"), "used", "n")


def settled(sites: int) -> float:
    """The estimate from which a line has at least ``sites`` sites."""
    m = float(REGISTERS)
    counted = m * math.log(m / (m - sites)) if sites < m else math.inf
    if counted <= 2.5 * m:
        return counted * (1 - 1e-9)
    return max(2.5 * m, sites * (1 + SURE * 1.04 / math.sqrt(m)))


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(line): hashes of lines on at least ``sites`` distinct sites."""
    open_ = written(spread(lines).where(F.col("n") >= sites).select("line", "estimate"))
    enough = F.col("estimate") >= settled(sites)
    near = open_.where(~enough).select("line")
    exact = lines.select("line", "site").join(near, "line", "left_semi").distinct().groupBy("line").count().where(F.col("count") >= sites)
    return open_.where(enough).select("line").unionAll(exact.select("line"))


def removals(docs: DataFrame, site: str = "source", sites: int = SITES, copies: int | None = None) -> DataFrame:
    """(key, cut): positions of the lines to remove, for the texts that lose any; key is the hash of doc_id and text.

    With ``copies``, lines of at least ``LONG`` words are removed where so many documents carry them, inside one site too.
    """
    lines = written(_lines(docs, site))
    if copies is None:
        found = written(boilerplate(lines, sites))
    else:
        passages = lines.where("long").select("line", F.col("key").alias("site"))
        found = written(boilerplate(lines.where("not long"), sites).unionAll(boilerplate(passages, copies)))
    hits = lines.join(found, "line", "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "pos")
    first = hits.groupBy("line").agg(F.min(place).alias("first"))
    again = hits.join(first, "line").where(~place.eqNullSafe(F.col("first")))
    return again.groupBy("key").agg(F.collect_set("pos").alias("cut"))


def _without(cut: str) -> Column:
    """The text without the lines whose positions ``cut`` lists, if it lists any."""
    return F.expr(f"if({cut} is null, text, array_join(filter(split(text, '\\n'), (x, i) -> not array_contains({cut}, i)), '\\n'))")


def dedup_lines(docs: DataFrame, site: str = "source", sites: int = SITES, copies: int | None = COPIES) -> DataFrame:
    """The documents without repeated cross-site lines, with all their columns; n_chars follows the text if it exists.

    Passages (lines of at least ``LONG`` words) are repeated from ``copies`` documents on, inside one site too; None
    holds them to ``sites`` like all lines.

    Lines are compared without the white space around them; blank lines stay. A null site counts as one site. Null and
    empty texts stay as they are, a text that loses all lines becomes empty. The first occurrence by doc_id (null last)
    and line stays; rows with equal doc_id and text are the same occurrence.
    """
    key, cut, kept = fresh(docs, "_key", "_cut", "_kept")
    cuts = written(removals(docs, site, sites, copies)).withColumnsRenamed({"key": key, "cut": cut})
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(by_key(cuts), key, "left").withColumn(kept, _without(cut))
    changed = {"text": F.col(kept)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(cut).isNotNull(), F.length(kept)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return marked.select(*[changed[c].alias(c) if c in changed else column for c, column in zip(docs.columns, columns(docs))])


def op9(docs: DataFrame) -> DataFrame:
    """Per document: its id, lines removed, and the kept text's length and hash."""
    cuts = written(removals(docs))
    marked = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).join(by_key(cuts), "key", "left")
    kept = F.coalesce(_without("cut"), F.lit(""))
    removed = F.when(F.col("cut").isNull(), 0).otherwise(F.size("cut")).cast("bigint")
    return marked.select("doc_id", removed.alias("lines_removed"), F.length(kept).cast("bigint").alias("kept_chars"), F.md5(kept.cast("binary")).alias("kept_md5"))


SQL_OP9 = f"""
WITH docs AS (SELECT doc_id, text, coalesce(source, chr(0)) AS site FROM documents),
split_up AS (SELECT doc_id, text, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM docs WHERE text IS NOT NULL),
lines AS (SELECT doc_id, text, site, trim(line, ' ') AS line, pos FROM split_up WHERE trim(line, ' ') <> ''),
spread AS (SELECT line, min((doc_id IS NULL, doc_id, pos)) AS first FROM lines GROUP BY line HAVING count(DISTINCT site) >= {SITES}),
cuts AS (SELECT DISTINCT l.doc_id, l.text, l.pos FROM lines l JOIN spread s ON l.line = s.line WHERE (l.doc_id IS NULL, l.doc_id, l.pos) IS DISTINCT FROM s.first),
kept AS (
  SELECT u.doc_id, u.text, string_agg(u.line, chr(10) ORDER BY u.pos) AS left_text
  FROM (SELECT DISTINCT doc_id, text, line, pos FROM split_up) u
  LEFT JOIN cuts c ON u.doc_id IS NOT DISTINCT FROM c.doc_id AND u.text = c.text AND u.pos = c.pos WHERE c.pos IS NULL GROUP BY ALL
),
counts AS (SELECT doc_id, text, count(*) AS n FROM cuts GROUP BY ALL)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS lines_removed, CAST(coalesce(length(k.left_text), 0) AS BIGINT) AS kept_chars, md5(coalesce(k.left_text, '')) AS kept_md5
FROM docs d
LEFT JOIN counts c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text IS NOT DISTINCT FROM c.text
LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.text IS NOT DISTINCT FROM k.text
"""
