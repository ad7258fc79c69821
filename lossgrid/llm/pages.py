"""Main text of web pages by differencing each page with the nearest URL of its host.

The html is cut into text blocks. Pages of a host are ordered by URL path, and each is paired with the neighbour whose
path has the longer common beginning. All blocks of a page are aligned with all of the partner's by a longest common
subsequence, and blocks both share are deleted. Differencing alone would also delete passages that two articles quote and
keep menus that differ from page to page, so the markup has a say: blocks inside an article or main element go only if most
pages of the host have them too, and blocks inside navigation, advert, form or script elements never stay.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lossgrid.llm.common import batches, written

#: Elements whose content is not text of a page, and those that are never part of the article.
RAW = frozenset("script style noscript template textarea title svg math iframe object".split())
RAW_END = {name: re.compile(rf"</{name}[^>]*(?:>|$)", re.I) for name in RAW}
ASIDE = frozenset("nav header footer aside form button select dialog menu head".split())
ARTICLE = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = ARTICLE | ASIDE | frozenset(
    "address blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li ol p pre section summary table tbody td tfoot th thead tr ul".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation "
    "newsletter notice notices popup promo related replies respond share sharing sidebar social sponsored subscribe widget".split())
#: Words of a class or id that tell of a page's state, before and after a mark; and those whose header is the article's own.
BEFORE, AFTER = frozenset("no not has have with without hide hidden show is".split()), frozenset("open opened closed fixed enabled disabled on off left right none".split())
OWN = frozenset("article content entry post story".split())
#: Elements whose class and id say nothing about their text.
FRAMES = ARTICLE | {"html", "body"}
TAG = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|$)""", re.S)
ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
HTML = re.compile(r"(?i)^(?:complementary|navigation|banner|contentinfo|search|form|alert|dialog|menu)$")
INSIDE, OUTSIDE, BESIDE = 0, 1, 2
#: Pages of a host that must share a block before it can count as part of the site.
SITES = 5


@lru_cache(maxsize=10_000)
def _marked(value: str, inside: bool) -> bool:
    """Whether a class or id has a mark: a word of ``MARKS`` without a modifier before or after it."""
    for name in value.lower().split():
        parts = re.split("[_-]", name)
        for i, part in enumerate(parts):
            if part in MARKS and BEFORE.isdisjoint(parts[:i]) and AFTER.isdisjoint(parts[i + 1 :]):
                if part != "header" or not inside and OWN.isdisjoint(parts[:i]):
                    return True
    return False


def _set_aside(attributes: str, inside: bool = False) -> tuple[bool, bool]:
    """Whether an element is beside the article by its role or because it is hidden, and whether by its class or id."""
    firm = loose = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        firm |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and bool(HTML.match(value))
        loose |= name in ("class", "id") and _marked(value, inside)
    return firm, loose


def blocks(html: str | None) -> list[tuple[str, int]]:
    """Text blocks in page order, and whether each is inside the article, outside of it, or beside it by its markup.

    A form, or an element with a marked class or id, is only a wrapper if it holds the main element, or if it holds an
    article and no text is inside one elsewhere (comments and teasers are often articles too), or if it is a form and
    the page has no other text.
    """
    wrappers: frozenset[int] = frozenset()
    found, holders = _cut(html, wrappers)
    for name in ("main", "article"):
        if holders[name] - wrappers and (name == "main" or all(k != INSIDE for _, k in found)):
            wrappers |= holders[name]
            found, _ = _cut(html, wrappers)
    if holders["form"] - wrappers and all(k == BESIDE for _, k in found):
        found, _ = _cut(html, wrappers | holders["form"])
    return found


def _cut(html: str | None, wrappers: frozenset[int]) -> tuple[list[tuple[str, int]], dict[str, frozenset[int]]]:
    """The blocks, with the elements that start at ``wrappers`` not set aside; and where forms and marked elements start
    that hold a main element, or an article, and where all forms do.

    Elements that are not closed end with the element around them; an end tag without a start is passed over.
    """
    html = html or ""
    found: list[tuple[str, int]] = []
    stack: list[tuple[str, int, int, int | None]] = []  # (element, articles around, set-aside elements around, start if a form or marked)
    holders: dict[str, set[int]] = {"main": set(), "article": set(), "form": set()}
    articles = beside = 0
    parts: list[str] = []

    def close() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((text, BESIDE if beside else INSIDE if articles else OUTSIDE))

    at = 0
    while at < len(html):
        tag = TAG.search(html, at)
        if tag is None:
            parts.append(html[at:])
            break
        parts.append(html[at : tag.start()])
        start, at = tag.start(), tag.end()
        if tag.group(2) is None:
            if tag.group().startswith("<![CDATA["):
                parts.append(tag.group()[9:].removesuffix("]]>"))
            continue
        name = tag.group(2).lower()
        if name in RAW and not tag.group(1):
            if not tag.group(3).rstrip().endswith("/"):
                end = RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
            continue
        if name == "br":
            parts.append(" ")
        if name in BLOCKS:
            close()
        if name in VOID or name in RAW:
            continue
        if tag.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if any(s[0] in BLOCKS for s in stack[i:]):
                        close()
                    articles, beside = stack[i][1], stack[i][2]
                    del stack[i:]
                    break
            continue
        firm, loose = _set_aside(tag.group(3), articles > 0)
        firm |= name in ASIDE and name != "form" and not (name == "header" and articles)
        loose = loose and name not in FRAMES or name == "form"
        aside = firm or loose and start not in wrappers
        if name == "form":
            holders["form"].add(start)
        if name in BLOCKS or aside:
            if name == "p":  # a paragraph ends where the next block starts
                while stack and stack[-1][0] == "p":
                    _, articles, beside, _ = stack.pop()
            if aside:
                close()
            if name in ARTICLE:
                holders[name].update(s[3] for s in stack if s[3] is not None)
            stack.append((name, articles, beside, start if loose and not firm else None))
            articles += name in ARTICLE
            beside += aside
    close()
    return found, {k: frozenset(v) for k, v in holders.items()}


def common(a: list, b: list) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``: equal ends are taken off, then matches are chained."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared = set(range(head)) | set(range(len(a) - tail, len(a)))
    where: dict[object, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    chain = links[-1] if links else None
    while chain:
        shared.add(chain[0])
        chain = chain[1]
    return shared


PARSED = "key bigint, site bigint, host string, path string, hashes array<bigint>, kinds array<int>, sizes array<int>"


def _parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block of every page, inside articles too, as hash, kind and length; texts do not move."""
    for keys, urls, pages in batches(rows, ["key", "url", "html"]):
        cut = [blocks(p) for p in pages]
        split = [re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", u or "") for u in urls]
        hosts = [m.group(1).lower() if m else "" for m in split]
        yield pa.record_batch({
            "key": pa.array(keys, pa.int64()), "site": pa.array([_hash(h) for h in hosts], pa.int64()), "host": pa.array(hosts, pa.string()),
            "path": pa.array([m.group(2) if m else u or "" for m, u in zip(split, urls)], pa.string()),
            "hashes": pa.array([[_hash(t) for t, _ in c] for c in cut], pa.list_(pa.int64())),
            "kinds": pa.array([[k for _, k in c] for c in cut], pa.list_(pa.int32())), "sizes": pa.array([[len(t) for t, _ in c] for c in cut], pa.list_(pa.int32())),
        })


def _hash(text: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "replace")), "little", signed=True)


def nearest(pages: DataFrame) -> DataFrame:
    """(key, partner): for each page (key, host, path) the neighbour in path order on its host with the longer common path.

    Pages are placed by a sort over ranges, so a large host is spread over many tasks; ties go to the page before.
    """
    spread = pages.select("key", "host", "path").repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    placed = written(spread.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    totals = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    rank = F.col("place") - F.shiftleft(F.shiftright("place", 33), 33) + F.col("earlier")
    ranked = written(placed.withColumn("part", part).join(earlier, "part").select("key", "host", "path", rank.alias("rank")))
    same = F.expr("size(filter(sequence(1, greatest(1, least(length(path), length(other_path)))), i -> left(path, i) = left(other_path, i)))")
    near = None
    for step in (-1, 1):
        other = ranked.select(F.col("key").alias("partner"), F.col("host").alias("other_host"), F.col("path").alias("other_path"), (F.col("rank") - step).alias("rank"))
        pairs = ranked.join(other, "rank").where("host = other_host").select("key", "partner", same.alias("same"), F.lit(-step).alias("before"))
        near = pairs if near is None else near.unionAll(pairs)
    return near.groupBy("key").agg(F.max_by("partner", F.struct("same", "before")).alias("partner"))


def differ(hashes: list[int], kinds: list[int], sizes: list[int], other: list[int]) -> tuple[list[int], list[int]]:
    """Places of the main blocks that go because the partner has them, and of those that go if most pages of the host have them.

    Main blocks are those inside the article, or outside of set-aside elements on a page without article. All blocks of
    both pages are aligned. What markup calls the article is not deleted on one partner's word, as two articles may quote
    one passage, and not at all if half of its text is shared: then the partner is a copy. A bare page that would lose
    all its text has a copy for partner as well, and only what most pages have goes.
    """
    shared = common(hashes, other)
    article = INSIDE in kinds
    main = [i for i, k in enumerate(kinds) if k == (INSIDE if article else OUTSIDE)]
    found = [i for i in main if i in shared]
    if not article:
        return (found, []) if len(found) < len(main) else ([], found)
    return [], found if 2 * sum(sizes[i] for i in found) < sum(sizes[i] for i in main) else []


def widespread(parsed: DataFrame) -> DataFrame:
    """(site, hash): the blocks that stand, outside of set-aside elements, on more than half of a host's pages, and on ``SITES`` at least."""
    own = F.expr(f"array_distinct(transform(filter(arrays_zip(hashes, kinds), b -> b.kinds <> {BESIDE}), b -> b.hashes))")
    counts = parsed.select("site", F.explode(own).alias("hash")).groupBy("site", "hash").agg(F.count("*").alias("n")).where(f"n >= {SITES}")
    totals = parsed.groupBy("site").agg(F.count("*").alias("pages"))
    return counts.join(totals, "site").where("2 * n > pages").select("site", "hash")


def dropped(parsed: DataFrame) -> DataFrame:
    """(key, drop): the places of the main blocks that differencing deletes, for every page (``PARSED``, distinct keys) that loses any."""
    partners = nearest(parsed)
    others = parsed.select(F.col("key").alias("partner"), F.col("hashes").alias("other"))
    pairs = partners.join(others, "partner").join(parsed, "key").select("key", "site", "hashes", "kinds", "sizes", "other")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sites, *lists in batches(rows, ["key", "site", "hashes", "kinds", "sizes", "other"]):
            found = [(k, s, h, *differ(h, *rest)) for k, s, h, *rest in zip(keys, sites, *lists)]
            found = [f for f in found if f[3] or f[4]]
            if found:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["key", "site", "hashes", "drop", "asked"])

    found = written(pairs.mapInArrow(run, "key bigint, site bigint, hashes array<bigint>, drop array<int>, asked array<int>"))
    asked = found.select("key", "site", F.explode("asked").alias("place"), "hashes").select("key", "site", "place", F.expr("hashes[place]").alias("hash"))
    answered = asked.join(widespread(parsed), ["site", "hash"], "left_semi").select("key", "place")
    return found.select("key", F.explode("drop").alias("place")).unionAll(answered).groupBy("key").agg(F.collect_list("place").alias("drop"))


def main_text(html: str | None, drop: list[int] | None) -> str:
    """The blocks inside the article, or on a page without one those outside of set-aside elements, but for the places in ``drop``."""
    cut, gone = blocks(html), frozenset(drop or ())
    main = INSIDE if any(k == INSIDE for _, k in cut) else OUTSIDE
    return "\n\n".join(t for i, (t, k) in enumerate(cut) if k == main and i not in gone)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html).

    Null or empty html gives empty text. Pages without host share one; a host with one page has nothing to compare.
    Rows with equal ids, URLs and html are one page, given as often as they occur; other rows are pages of their own.
    Every page is aligned with its partner; hashes of blocks move, and html meets the places that go.
    """
    chosen = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    chosen = chosen.withColumn("key", F.xxhash64("page_id", F.coalesce("url", F.lit("")), F.lit(1), F.coalesce("html", F.lit(""))))
    parsed = written(chosen.mapInArrow(_parse, PARSED).dropDuplicates(["key"]))
    drops = written(dropped(parsed))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, html, drop in batches(rows, ["page_id", "url", "html", "drop"]):
            texts = [main_text(h, d) for h, d in zip(html, drop)]
            yield pa.record_batch({"page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()), "text": pa.array(texts, pa.string())})

    found = chosen.join(drops, "key", "left").select("page_id", "url", "html", "drop").mapInArrow(run, "page_id bigint, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
