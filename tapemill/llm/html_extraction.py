"""Main text of web pages by removal of what a site repeats on its pages.

Every block-level element is hashed with all below it. Spark counts for each host on how many different articles a
subtree occurs, and subtrees that recur on many of them are templates and are deleted, wherever they stand. What a
single page shows by itself (a menu's tag, an advert's class) is ruled out by its markup; see `page_tree`.

A page is told from others by its longest block, so copies and near copies of an article count as one and its
own words are no template. Many is at least the square root of the host's articles, and three; blocks of running
text within an article go only if at least half of the host's articles have them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.llm import page_tree
from tapemill.llm.common import bound_batches, stored
from tapemill.operators.joins import fits_broadcast, sized

LEAST_PAGES = 3
# Templates are broadcast by host up to so many in all and on one host; beyond, every page gets those it holds.
BROADCAST_TEMPLATES = 200_000
HOST_TEMPLATES = 2_000
# Levels of a template: recurring on many of a host's articles, on most of them.
MANY, MOST = 1, 2


def host_of(url: Column) -> Column:
    """Lower-case host of an address; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _recurring(nodes: list[page_tree.Node]) -> list[int]:
    """Elements that may be templates: blocks with text."""
    return [
        k
        for k, n in enumerate(nodes)
        if k and n.chars and n.tag not in page_tree.INLINE and n.tag not in page_tree.PARTS
        and n.tag not in ("html", "head", "body", "title") and n.tag not in page_tree.RAW
    ]


def subtrees(html: str | None) -> tuple[list[int], list[int]]:
    """Hashes of a page's blocks and, for each, the block by which its page is told from others; first the page itself."""
    nodes = page_tree.parse(html or "")
    blocks = _recurring(nodes)
    own = [k for k in blocks if not nodes[k].has_block and not nodes[k].dropped]
    inside = [k for k in own if nodes[k].in_article] or own
    longest = sorted(inside, key=lambda k: (-nodes[k].chars, nodes[k].hash))
    tops = list(dict.fromkeys(nodes[k].hash for k in longest))[:2] + [0, 0]
    hashes = dict.fromkeys(nodes[k].hash for k in blocks)
    return [0, *map(_signed, hashes)], [_signed(tops[0]), *(_signed(tops[1] if h == tops[0] else tops[0]) for h in hashes)]


def article_text(html: str | None, templates: dict[int, int]) -> str:
    """A page's article without templates, given as level by signed hash, and without what its markup rules out."""
    nodes = page_tree.parse(html or "")
    if templates:
        for k in _recurring(nodes):
            node = nodes[k]
            level = templates.get(_signed(node.hash), 0)
            node.dropped |= level == MOST or level == MANY and not (node.in_article and node.tag in page_tree.PROSE)
        for node in nodes[1:]:
            node.dropped |= nodes[node.parent].dropped
    return page_tree.text_of(nodes, page_tree.roots_of_article(nodes))


def _found_subtrees(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([subtrees(h) for h in batch], columns=["hashes", "pages"])


def _texts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for html, hashes, levels in batches:
        yield pd.Series(
            [article_text(h, {} if k is None else dict(zip(k, v))) for h, k, v in zip(html, hashes, levels)], dtype=object
        )


def _occurrences(pages: DataFrame, *more: str) -> DataFrame:
    """site, hash, page (and more columns) of every block of a page with a host."""
    listed = F.pandas_udf(_found_subtrees, "hashes array<long>, pages array<long>")
    found = pages.where("host <> ''").select(*more, F.xxhash64("host").alias("site"), listed("html").alias("s"))
    return found.select(*more, "site", F.explode(F.arrays_zip("s.hashes", "s.pages")).alias("o")).select(
        *more, "site", F.col("o.hashes").alias("hash"), F.col("o.pages").alias("page")
    )


def site_templates(pages: DataFrame) -> DataFrame:
    """site, hash, level of subtrees that recur on a host, from pages (host, html); stored.

    Occurrences are made distinct before they are counted, so a menu on a third of all pages is no hot key.
    """
    counted = _occurrences(pages).distinct().groupBy("site", "hash").agg(F.count("*").alias("n"))
    counted = stored(counted.where((F.col("n") >= LEAST_PAGES) | (F.col("hash") == 0)), "subtrees")
    sites = counted.where("hash = 0").select("site", F.col("n").alias("articles"))
    many = F.greatest(F.lit(LEAST_PAGES), F.ceil(F.sqrt("articles")))
    most = F.greatest(F.lit(LEAST_PAGES), F.ceil(F.col("articles") / 2))
    level = F.when(F.col("n") >= most, MOST).when(F.col("n") >= many, MANY)
    found = counted.where("hash <> 0").join(sized(sites, fits_broadcast(sites)), "site")
    return stored(found.select("site", "hash", level.alias("level")).where("level IS NOT NULL"), "templates")


def _listed(rows: DataFrame, *key: str) -> DataFrame:
    lists = rows.groupBy(*key).agg(F.collect_list(F.struct("hash", "level")).alias("t"))
    return lists.select(*key, F.col("t.hash").alias("template_hashes"), F.col("t.level").alias("template_levels"))


def main_texts(
    pages: DataFrame, broadcast_templates: int = BROADCAST_TEMPLATES, host_templates: int = HOST_TEMPLATES
) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    NULL and empty pages have an empty text. Repeated rows are repeated. Pages without a host share no site,
    so only their markup counts; so it is on hosts with fewer articles than LEAST_PAGES.
    """
    bound_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    templates = site_templates(pages.select("host", "html"))
    per_site = templates.groupBy("site").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0)))
    total, most = per_site.first()
    if total <= broadcast_templates and most <= host_templates:
        lists = F.broadcast(_listed(templates, "site"))
        rows = pages.join(lists, F.xxhash64("host") == lists["site"], "left")
    else:
        # Copies of a page share their templates, so they are listed once; 128 bits tell pages apart.
        keyed = pages.withColumns({"k1": F.xxhash64("host", "html"), "k2": F.xxhash64(F.lit(1), "html", "host")})
        held = _occurrences(keyed.select("k1", "k2", "host", "html").dropDuplicates(["k1", "k2"]), "k1", "k2")
        lists = _listed(held.join(templates, ["site", "hash"]), "k1", "k2")
        rows = keyed.join(lists, ["k1", "k2"], "left")
    extracted = F.pandas_udf(_texts, "string")
    texts = rows.select("page_id", "url", extracted("html", "template_hashes", "template_levels").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
