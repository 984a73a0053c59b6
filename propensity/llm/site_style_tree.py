"""Main text of web pages by site style trees.

The pages of a host are merged into one tree (``page_blocks.tree`` says how a
page is cut into block elements and text runs). An element node holds the style
nodes that pages use there (the labels of the element's children); the children
of equal styles are merged again, repeated children of one label into one node,
and text runs are the leaves, with their texts as features. For a node that m of
the host's pages show:

* a style node's pages give the presentation importance, the entropy of the
  styles to the base m: 0 where all pages look alike;
* a leaf's content importance is 1 minus the entropy of a feature over its pages,
  log(c) / log(m) for a text that c pages show, averaged over what the pages show:
  0 where every page says the same;
* an element's composite importance weighs its own presentation by 1 - g^l (l
  styles, g = ``STYLE_WEIGHT``) and the mean composite importance of its
  children by g^l. Elements that are furniture by tag, role, class or id count 0.

A node is noise if its importance and that of all nodes below it is under
``THRESHOLD``. Pages lose their furniture, what lies outside their marked content
(if they have any), and the text runs of noise nodes. Fewer than ``LEAST_PAGES``
pages say nothing about a site: importance 1. Where the tree would leave nothing
of a page, all that is not furniture stays.

The tree is two aggregations of what the pages add to it (summed within a task
first) and one small join per level; no host is ever in one task. Only pages that
show a noise node are joined with it, by a digest of host and markup.

Defined results: null and empty markup give an empty text; pages without a host
(null or odd url) form no site; repeated pages come out as often as they are
given, and count as often in the tree; an empty table gives an empty result;
markup without tags is one block; columns other than ``page_id``, ``url`` and
``html`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.common import map_arrow, saved
from propensity.llm.page_blocks import tree

THRESHOLD = 0.2
STYLE_WEIGHT = 0.9
LEAST_PAGES = 5
#: Tree entries that a task sums up before it hands them on.
HELD_ENTRIES = 200_000

NODE, STYLE, WORDS = 0, 1, 2
ENTRIES = "key binary, parent binary, depth int, kind int, item binary, style binary, n long"
SEEN = "page binary, key binary"
RESULT = "page_id long, url string, text string, n_chars long"


def prepared(pages: DataFrame) -> DataFrame:
    """page_id, url, html, site (host, or the page itself) and page (digest of host and markup)."""
    page = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")),
                                    r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        page.alias("html"), host.alias("host"))
    rows = rows.withColumn("page", F.unhex(F.md5(F.concat(F.col("host"), F.lit("\0"), F.col("html")))))
    return rows.withColumn("site", F.when(F.col("host") == "", F.concat(F.lit(b"\0"), F.col("page")))
                           .otherwise(F.col("host").cast("binary"))).drop("host")


def entries(rows: DataFrame) -> DataFrame:
    """What the pages add to the trees of their sites, with the number of pages, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}
        for batch in batches:
            for part in TB.slices(batch, "html"):
                for site, html in zip(part.column("site").to_pylist(), part.column("html").to_pylist()):
                    for entry in tree(html, site)[0]:
                        held[entry] = held.get(entry, 0) + 1
                    if len(held) >= HELD_ENTRIES:
                        yield _entries(held)
                        held = {}
        yield _entries(held)

    return map_arrow(rows.select("site", "html"), run, ENTRIES).groupBy("key", "depth", "kind", "item") \
        .agg(F.max("parent").alias("parent"), F.max("style").alias("style"), F.sum("n").alias("n"))


def _entries(held: dict) -> pa.RecordBatch:
    columns = list(zip(*held)) if held else [[]] * 6
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(held.values(), pa.int64())],
                                      names=[c.split()[0] for c in ENTRIES.split(", ")])


def style_tree(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The nodes of all sites' trees: key, parent (a style key), depth, pages, importance, noise."""
    return _importance(saved(entries(prepared(pages)), "style-tree"), threshold)


def _importance(counts: DataFrame, threshold: float) -> DataFrame:
    n, log = F.col("n"), F.ln(F.col("n"))
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    nodes = counts.groupBy("key", "depth").agg(
        F.max(F.when(F.col("kind") == NODE, F.col("parent"))).alias("parent"), F.coalesce(of(NODE, n), F.lit(0)).alias("pages"),
        of(STYLE, n).alias("styled"), of(STYLE, n * log).alias("styled_log"), of(STYLE, F.lit(1)).alias("styles"),
        of(WORDS, n).alias("said"), of(WORDS, n * log).alias("said_log"))
    base = F.ln(F.col("pages"))
    few = F.col("pages") < LEAST_PAGES
    content = F.when(F.col("said").isNotNull(), F.when(few, 1.0).otherwise(1 - F.col("said_log") / F.col("said") / base))
    # the entropy of the styles to the base of the pages
    look = F.when(F.col("styled").isNotNull(), F.when(few, 1.0).otherwise(
        (F.ln(F.col("styled")) - F.col("styled_log") / F.col("styled")) / base))
    nodes = saved(nodes.select("key", "depth", "parent", "pages", "styles", content.alias("content"), look.alias("look")), "style-nodes")
    styles = counts.where(F.col("kind") == STYLE).select("key", "depth", "style", "n")
    deepest = nodes.agg(F.max("depth")).first()[0]
    out = below = None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        share = F.lit(None).cast("double")
        if below is not None:
            children = below.groupBy(F.col("parent").alias("style")).agg(F.avg("importance").alias("mean"), F.max("best").alias("best"))
            inner = styles.where(F.col("depth") == depth).join(children, "style").groupBy("key").agg(
                (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("inner"), F.max("best").alias("below"))
            level = level.join(inner, "key", "left")
            g = F.pow(F.lit(STYLE_WEIGHT), F.col("styles"))
            share = F.when(F.col("inner").isNotNull(), (1 - g) * F.col("look") + g * F.col("inner"))
        else:
            level = level.withColumn("below", F.lit(None).cast("double"))
        # text runs on an inner node (beyond the deepest level) count like a child
        importance = F.coalesce((share + F.col("content")) / 2, share, F.col("content"), F.lit(0.0))
        best = F.greatest(importance, F.coalesce(F.col("content"), F.lit(0.0)), F.coalesce(F.col("below"), F.lit(0.0)))
        level = level.select("key", "parent", "depth", "pages", importance.alias("importance"), best.alias("best"))
        below = level if depth == 0 else saved(level, "style-level")
        out = below if out is None else out.unionByName(below)
    if out is None:
        out = nodes.select("key", "parent", "depth", "pages", F.col("content").alias("importance"), F.col("look").alias("best"))
    return out.select("key", "parent", "depth", "pages", "importance", (F.col("best") < threshold).alias("noise"))


def noise_by_page(rows: DataFrame, noise: DataFrame) -> DataFrame:
    """page, drop: the noise nodes that a page's text runs lie on; pages without one are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in TB.slices(batch, "html"):
                at, keys = [], []
                for i, (site, html) in enumerate(zip(part.column("site").to_pylist(), part.column("html").to_pylist())):
                    for key in {leaf.key for leaf in tree(html, site)[1] if not leaf.furniture}:
                        at.append(i)
                        keys.append(key)
                yield pa.RecordBatch.from_arrays([part.column("page").take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())],
                                                 names=["page", "key"])

    seen = map_arrow(rows.select("page", "site", "html"), run, SEEN)
    return seen.join(noise, "key", "left_semi").groupBy("page").agg(F.collect_set("key").alias("drop"))


def main_text(html: str | None, site: bytes, drop: set) -> str:
    kept = [leaf for leaf in tree(html, site)[1] if not leaf.furniture]
    return "\n".join(leaf.text for leaf in [x for x in kept if x.key not in drop] or kept)


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = prepared(pages)
    noise = style_tree(pages, threshold).where("noise").select("key")
    drop = saved(noise_by_page(rows, noise), "page-noise")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in TB.slices(batch, "html"):
                texts = [main_text(h, s, set(d or ())) for h, s, d in
                         zip(part.column("html").to_pylist(), part.column("site").to_pylist(), part.column("drop").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[c.split()[0] for c in RESULT.split(", ")])

    return map_arrow(rows.join(drop, "page", "left").select("page_id", "url", "html", "site", "drop"), run, RESULT)
