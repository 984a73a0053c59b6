"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

The terms of a text are its lower-cased words, weighted by how often they
occur. For each of ``SAMPLES`` samples every term draws r and c from
Gamma(2, 1) and beta from (0, 1), all from a hash of the term and the sample's
number, so they are the same in every text (the gamma draws by quantile tables):

    t = floor(ln(weight) / r + beta)        ln a = ln c - r (t - beta + 1)

The term with the least a, with its t, is the sample. Two texts agree in a
sample with probability sum(min weight) / sum(max weight), their generalised
Jaccard similarity; the fingerprint holds 16 bits of every sample.

Documents are dealt by ranges of doc_id, so that the next document is in the
same partition; the terms of a text never leave it.

Defined results: a null text is empty; a text without words has the fingerprint
of all f, like any other such text; rows of equal doc_id are in the order of
their texts; rows without doc_id come first; a single document is its own next
one; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.llm.common import doc_text, saved

SAMPLES = 64
#: Documents of a range and of a partition, about; quantiles that bound the ranges.
RANGE_ROWS = 500
PART_ROWS = 1_000
COARSE = 64
#: Draws are quantiles of so many cells; the least 1 / TAIL of c has as many cells of its own.
CELLS = 4096
TAIL = 64

_SEPARATORS = "[ \\t\\n\\x0B\\f\\r]+"


# --- samples --------------------------------------------------------------------------------------------------

def _quantile(u: Column) -> Column:
    """Inverse of the Gamma(2, 1) distribution, 1 - (1 + x) exp(-x), by Newton steps from its inflection."""
    step = lambda x, _: x - (1 - (1 + x) * F.exp(-x) - u) / (x * F.exp(-x))
    return F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.lit(1.0), step)


def gamma_table(spark: SparkSession) -> Column:
    """Quantiles as one array, a scalar subquery: r by 12 bits, ln c by 12 bits, the least 1/64 of ln c by 12 further bits."""
    cells = F.sequence(F.lit(0), F.lit(CELLS - 1))
    of = lambda share, fn: F.transform(cells, lambda i: fn(_quantile((i + 0.5) * (share / CELLS))))
    return spark.range(1).select(F.concat(of(1.0, lambda x: x), of(1.0, F.ln), of(1.0 / TAIL, F.ln)).alias("q")).scalar()


def sample(term: Column, log_weight: Column, number: int, table: Column) -> Column:
    """ln a (upper bits) and 18 bits that tell the term and its t, as one comparable integer."""
    x = F.xxhash64(term, F.lit(number))
    bits = lambda shift, width: F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << width) - 1))
    r = F.get(table, bits(0, 12).cast("int"))
    coarse = bits(12, 12).cast("int")
    log_c = F.get(table, F.when(coarse < CELLS // TAIL, bits(24, 12).cast("int") + 2 * CELLS).otherwise(coarse + CELLS))
    beta = (bits(36, 16).cast("double") + 0.5) * 0.5 ** 16
    t = F.floor(log_weight / r + beta)
    log_a = log_c - r * (t - beta + 1)                        # between -80 and 10
    tag = F.shiftrightunsigned(x, 46).bitwiseXOR(t * F.lit(7919)).bitwiseAND(F.lit((1 << 18) - 1))
    return F.shiftleft(((log_a + 90) * float(1 << 38)).cast("long"), 18).bitwiseOR(tag)


def signatures(texts: DataFrame, keys: list[str], n_samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``samples`` (16 bits each) of every row whose ``body`` has a word.

    ``texts`` is partitioned by some of its ``keys`` already: neither grouping shuffles then.
    """
    words = texts.select(*keys, F.explode(F.split(F.lower("body"), _SEPARATORS)).alias("word")).where("word != ''")
    terms = words.select(*keys, F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    terms = terms.select(*keys, "term", F.ln(F.col("n").cast("double")).alias("w"),
                         gamma_table(texts.sparkSession).alias("q"))
    best = terms.groupBy(*keys).agg(*[F.min(sample(F.col("term"), F.col("w"), k, F.col("q"))).alias(f"s{k}")
                                      for k in range(n_samples)])
    return best.select(*keys, F.array(*[F.col(f"s{k}").bitwiseAND(F.lit(0xFFFF)).cast("int")
                                        for k in range(n_samples)]).alias("samples"))


def as_text(samples: Column) -> Column:
    return F.array_join(F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s)), 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of samples in which two signatures agree."""
    agree = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return agree.cast("double") / F.size(a)


# --- the next document ----------------------------------------------------------------------------------------

def dealt(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id and text with ``range``: ascending ranges of doc_id, each of about ``range_rows`` documents.

    ``COARSE`` quantiles bound the ranges; in between they are of equal width.
    """
    given = doc_text(docs)
    shares = [k / COARSE for k in range(1, COARSE)]
    stats = docs.select(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        F.percentile_approx("doc_id", shares, F.lit(2000)).alias("cuts")).first()
    if stats["lo"] is None:
        return given.withColumn("coarse", F.lit(-1)).withColumn("range", F.lit(-1).cast("long"))
    cuts = sorted(set(stats["cuts"]) - {stats["lo"]})
    edges = [float(v) for v in (stats["lo"], *cuts, stats["hi"] + 1)]
    finer = max(1, -(-stats["n"] // (range_rows * (len(edges) - 1))))
    at = lambda values, k: F.get(F.array(*map(F.lit, values)), k)
    coarse = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c <= F.col("doc_id")))
    given = given.withColumn("coarse", F.when(F.col("doc_id").isNull(), -1).otherwise(coarse))
    lo, width = at(edges[:-1], F.col("coarse")), at([max(b - a, 1.0) for a, b in zip(edges, edges[1:])], F.col("coarse"))
    sub = F.floor((F.col("doc_id").cast("double") - lo) / width * finer)
    number = F.col("coarse").cast("long") * finer + F.greatest(F.lit(0), F.least(sub, F.lit(finer - 1)))
    return given.withColumn("range", F.coalesce(number, F.lit(-1).cast("long")))


def _following_ranges(given: DataFrame) -> DataFrame:
    """range and ``after``, the next range that has a document; the first one follows the last."""
    ranges = given.groupBy("coarse", "range").agg(F.lit(1))
    inside = Window.partitionBy("coarse").orderBy("range")
    ranges = ranges.select("coarse", "range", F.lead("range").over(inside).alias("after"))
    firsts = ranges.groupBy("coarse").agg(F.min("range").alias("first"))          # COARSE + 1 rows at most
    order = Window.orderBy("coarse")
    firsts = firsts.select("coarse", F.coalesce(F.lead("first").over(order), F.min("first").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("first"))
    return ranges.join(firsts, "coarse").select("range", F.coalesce("after", "first").alias("after"))


def fingerprints(docs: DataFrame, n_samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness; one row per row of ``docs``.

    The edited text: the last floor(n/2) code points replaced by the first as
    many (or all) of the next document.
    """
    given = dealt(docs)
    n_parts = max(1, -(-given.count() // PART_ROWS))
    inside = Window.partitionBy("range").orderBy("doc_id", "text")
    rows = given.drop("coarse").repartition(n_parts, "range").withColumn("place", F.row_number().over(inside)) \
        .withColumn("next", F.lead("text").over(inside))
    heads = rows.where("place = 1").select(F.col("range").alias("after"), F.col("text").alias("head"))
    follow = _following_ranges(given)
    rows = rows.join(follow.join(heads, "after").select("range", "head"), "range")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                      F.substring(F.coalesce("next", "head"), F.lit(1), half))
    rows = rows.select("range", "place", "doc_id", "text", edited.alias("edited"))

    both = rows.select("range", "place", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))).alias("t")).select("range", "place", "t.*")
    found = signatures(both, ["range", "place", "side"], n_samples).groupBy("range", "place").agg(
        *[F.first(F.when(F.col("side") == s, F.col("samples")), ignorenulls=True).alias(name)
          for s, name in enumerate(("own", "changed"))])
    facts = rows.select("range", "place", "doc_id", F.length("text").cast("long").alias("n_chars"),
                        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    none = F.array(*[F.lit(0xFFFF)] * n_samples)
    got = facts.join(found, ["range", "place"], "left").withColumns({
        "own": F.coalesce("own", none), "changed": F.coalesce("changed", none)})
    got = saved(got, "signatures")

    heads = got.where("place = 1").select(F.col("range").alias("after"), F.col("own").alias("head"))
    got = got.join(follow.join(heads, "after").select("range", "head"), "range")
    after = F.coalesce(F.lead("own").over(Window.partitionBy("range").orderBy("place")), F.col("head"))
    return got.withColumn("following", after).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))
