"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base patterns give base spans, which always stay. High-recall generators
propose further, overlapping spans; boosted trees over format and context
features score each, and those above a calibrated threshold are added unless
they overlap a base span or a better candidate. The trees learn from the data
itself: a candidate that equals a base span is an example, one that overlaps a
base span or breaks its kind's rules is a counter-example. A candidate inside a
base span of its own kind is neither. Base phones always have a country's
prefix, so each is also an example of the formats without one and, as a part of
a longer number, a counter-example. Spans that keep every rule and still are no
personal data (an invoice number, a size, a score written like a phone number)
come from contrast texts: formats, numbers and the context words listed below,
combined in Spark and read by the same generators and features. Every fourth
feature vector is held out, and each kind gets the least threshold at which the
trees that are applied reach MIN_PRECISION on these. Feature vectors
are counted in Spark, so the fit sees a bounded table of distinct vectors, and
the fitted trees are applied as SQL expressions.

Defined results: a null or empty text has no spans (the digest is that of the
empty string); repeated rows give equal rows; without examples or
counter-examples nothing is added; columns other than ``doc_id`` and ``text``
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.llm.common import saved
from propensity.llm.hist_gbt import FlatTrees, fit

KINDS = ("email", "ip", "card", "phone")
#: At most so many distinct feature vectors are learnt from, the most frequent ones.
MAX_VECTORS = 20_000
MIN_PRECISION = 0.98
CONTEXT_CHARS = 24

#: What spans look like. A run that a pattern could begin in its middle is anchored to its start or to
#: the end of the match before, which changes no match and keeps the search linear in long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: (kind, base?, pattern, pattern that a text must hold somewhere)
GENERATORS = (
    ("email", True, EMAIL, "@"),
    ("ip", True, IP, r"[0-9]\.[0-9]"),
    ("card", True, CARD, r"[0-9](?:[ -]?[0-9]){13}"),
    ("phone", True, PHONE, r"\+[0-9]"),
    ("email", False, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++"
                     r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++", r"[\[(]at[\])]"),
    ("email", False, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", False, r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", r"[0-9]\.[0-9]"),
    ("ip", False, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", r"[0-9]\.[0-9]"),
    ("card", False, r"(?<![0-9])[0-9]{14,19}(?![0-9])", r"[0-9]{14}"),
    ("card", False, r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])", r"[0-9]{4}[ -][0-9]{4}"),
    ("card", False, r"(?<![0-9])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])", r"[0-9]{4}[ -][0-9]{6}"),
    ("phone", False, r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])", r"\+[0-9]"),
    ("phone", False, r"\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9])", r"\+[0-9]"),
    ("phone", False, r"(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])", r"\([0-9]{3}\)"),
    ("phone", False, r"(?<![0-9])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"),
)
#: The generators of phones without a country's prefix.
NATIONAL = tuple(k for k, g in enumerate(GENERATORS) if g[0] == "phone" and not g[2].startswith(r"\+"))
#: (n_chars, n_marks, brackets) of their ten digits: (269) 555-3296, (269)555-3296, 269-555-3296.
NATIONAL_FORMATS = ((14, 4, 1), (13, 3, 1), (12, 2, 0))
COUNTRY = r"\+[0-9]{1,3}[ .-]?$"
KEYWORDS = {"email": "mail", "ip": "ip|host|server|address", "card": "card|visa|credit|account",
            "phone": "tel|phone|call|mobile|fax"}

#: Words before a number, and units after it, that speak against personal data.
AGAINST = ("invoice|order|score|track|shipment|parcel|size|dimension|part|serial|model|version|item|ref|isbn|issn|sku|lot|batch|"
           "ticket|case|claim|policy|code|article|section|page|chapter|grid|coordinate|range|ratio|result|goal|total|sum|amount|"
           "price|cost|quantity|qty|count|population|distance|weight|length|width|height|speed|record|row|sample|build|release|"
           "patch|product|catalog|room|flight|train|bus|license plate|vin|arriv|sold|open|meet")
UNITS = r"^ ?(?:mm|cm|km|kg|lb|ml|px|dpi|points?|pieces?|units?|items?|copies|usd|eur|dollars?|euros?|[%$€£°])"
POST_CHARS = 8
#: Contrast texts: what stands before and after a number, and whether that makes it personal.
PERSONAL_CONTEXTS = (("Please call ", " today."), ("My phone is ", "."), ("Tel. ", "\n"), ("Mobile: ", ", thanks"),
                     ("Fax ", " or mail"), ("Reach me at ", " any time."), ("Anna Smith, ", "."), ("", ""), ("text ", " now"),
                     ("and then ", " they said"), ("office (", ")"), ("contact - ", ";"),
                     ("To order call ", "."), ("for prices phone ", " or write"))
OTHER_CONTEXTS = (("Invoice number ", "."), ("order ", " shipped"), ("the score ", " today"), ("Tracking ", "."),
                  ("sizes ", " mm"), ("Part ", " in stock"), ("serial ", ","), ("total of ", " units"), ("ISBN ", "."),
                  ("Item code ", ""), ("batch: ", "; ok"), ("weight ", " kg"), ("a row of ", " points"), ("for ", " dollars"),
                  ("product ", " new"), ("ticket ", "."), ("it was ", " km"), ("", " pieces"), ("version ", "."))
#: Formats of ten digits a, b, c in groups of 3, 3 and 4.
CONTRAST_FORMATS = (("(", ") ", "-"), ("(", ")", "-"), ("", "-", "-"), ("", ".", "."), ("", " ", " "))
CONTRAST_NUMBERS = 24
#: Addresses without the sign, and what only looks like one.
PERSONAL_AT = ("anna.smith [at] example [dot] com", "joe(at)mail.example.org", "x_1 [at] host.net", "info (at) firm (dot) de",
               "k99 (at) uni-1.example.edu", "first.last[at]sub.example.info", "sales [at] shop [dot] example [dot] eu")
OTHER_AT = ("arrived (at) 10.30", "sold (at) 5.00", "meeting [at] 9.15", "open (at) 8. 30", "priced [at] 1.250", "shot (at) 24.7",
            "measured (at) 37.5", "rows [at] 3.14.15", "closed (at) 22.00")

FEATURES = ("kind", "n_chars", "n_digits", "n_marks", "valid", "plus", "brackets", "before", "after", "keyword",
            "against", "zeros", "mark", "letters")


# --- spans ----------------------------------------------------------------------------------------------------

def _found(number: int, pattern: str, needs: str) -> Column:
    """All matches of one generator: what stands between matches tells their places."""
    none = F.array().cast("array<struct<gen:int,no:int,gap:int,hit:string,pre:string,post:string>>")
    regex, text = F.lit(pattern), F.col("text")
    hits = F.regexp_extract_all(text, regex, F.lit(0))
    gaps = F.split(text, pattern, -1)
    each = F.transform(hits, lambda h, i: F.struct(
        F.lit(number).alias("gen"), i.alias("no"), F.length(F.get(gaps, i)).alias("gap"), h.alias("hit"),
        F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)).alias("pre"), F.left(F.get(gaps, i + 1), F.lit(POST_CHARS)).alias("post")))
    return F.when(text.rlike(needs), each).otherwise(none)


def matches(docs: DataFrame) -> DataFrame:
    """One row per match of any generator, and one without match (gen null) for every document."""
    row = F.monotonically_increasing_id()
    all_of = F.concat(F.array(F.lit(None).cast("struct<gen:int,no:int,gap:int,hit:string,pre:string,post:string>")),
                      *[_found(k, p, needs) for k, (_, _, p, needs) in enumerate(GENERATORS)])
    hits = F.when(F.col("text").rlike(r"[0-9@]|[\[(]at[\])]"), all_of)
    given = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = given.withColumn("row", row).select("row", "doc_id", F.explode_outer(hits).alias("m"))
    return out.select("row", "doc_id", "m.*").repartition("row")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: Column, hit: Column) -> Column:
    """The rules of the base spans: parts of an address, digits of a number, its check digit."""
    n = F.length(_digits(hit))
    part = F.forall(F.split(hit, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3)
    small = F.forall(F.split(hit, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int"),
                                                               F.lit(999)) <= 255)
    return (F.when(kind == "ip", part & small)
            .when(kind == "card", n.between(14, 19) & F.coalesce(F.call_function("luhn_check", _digits(hit)), F.lit(False)))
            .when(kind == "phone", n.between(10, 15)).otherwise(F.lit(True)))


_OTHER = 4


def _part_of_more(pre: Column, post: Column) -> Column:
    """A number that goes on before or after: a date, an order or part number."""
    return pre.rlike(r"([\p{L}0-9_#/=-]|[0-9]\.)$") | post.rlike(r"^[\p{L}0-9_#/=-]")


def _class(char: Column) -> Column:
    """0 nothing or white space, 1 sentence mark, 2 letter, 3 digit, _OTHER."""
    return (F.when((char == "") | char.rlike(r"^\s"), 0).when(char.rlike(r"^[.,;:!?]"), 1).when(char.rlike(r"^\p{L}"), 2)
            .when(char.rlike("^[0-9]"), 3).otherwise(_OTHER))


def _mark(hit: Column) -> Column:
    """What stands before the last group of characters: 0 nothing, 1 a space, 2 a hyphen, 3 a dot, _OTHER."""
    mark = F.regexp_extract(hit, "([^A-Za-z0-9])[A-Za-z0-9]*$", 1)
    return F.when(mark == "", 0).when(mark == " ", 1).when(mark == "-", 2).when(mark == ".", 3).otherwise(_OTHER)


def candidates(docs: DataFrame) -> DataFrame:
    """Spans with features: ``base`` 1 for base spans; rows without span stand for their document."""
    order = Window.partitionBy("row", "gen").orderBy("no")
    before = F.sum(F.col("gap") + F.length("hit")).over(order)
    kind = F.element_at(F.array(*[F.lit(g[0]) for g in GENERATORS]), F.col("gen") + 1)
    is_base = F.element_at(F.array(*[F.lit(g[1]) for g in GENERATORS]), F.col("gen") + 1)
    spans = (matches(docs).withColumn("end", before).withColumn("start", F.col("end") - F.length("hit"))
             .withColumn("kind", kind).withColumn("is_base", is_base)
             .withColumn("valid", F.when(F.col("gen").isNotNull(), _valid(F.col("kind"), F.col("hit")))))
    spans = spans.where("gen is null or valid or not is_base")
    # a number behind its country's prefix is a candidate with that prefix only
    national = F.coalesce(F.col("gen").isin(*NATIONAL), F.lit(False))
    spans = spans.where(~(national & F.coalesce(F.col("pre").rlike(COUNTRY), F.lit(False))))
    spans = spans.withColumn("valid", F.when(national, F.col("valid") & ~_part_of_more(F.col("pre"), F.col("post")))
                             .otherwise(F.col("valid")))
    words = F.lit(False)
    for name, pattern in KEYWORDS.items():
        words = F.when(F.col("kind") == name, F.lower("pre").rlike(pattern)).otherwise(words)
    features = [F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("kind_no"),
                F.least(F.length("hit"), F.lit(64)).alias("n_chars"),
                F.least(F.length(_digits(F.col("hit"))), F.lit(32)).alias("n_digits"),
                F.least(F.length(F.regexp_replace("hit", "[A-Za-z0-9]", "")), F.lit(16)).alias("n_marks"),
                F.col("valid").cast("int").alias("valid"), F.startswith("hit", F.lit("+")).cast("int").alias("plus"),
                F.contains("hit", F.lit("(")).cast("int").alias("brackets"),
                _class(F.right("pre", F.lit(1))).alias("before"), _class(F.col("post")).alias("after"),
                words.cast("int").alias("keyword"),
                (F.lower("pre").rlike(rf"(?<!\p{{L}})(?:{AGAINST})(?:s|es|d|ed|ing|al|ment)?(?!\p{{L}})") | F.lower("post").rlike(UNITS)).cast("int").alias("against"),
                F.length(F.regexp_extract(_digits(F.col("hit")), "(0*)$", 1)).alias("zeros"),
                _mark(F.col("hit")).alias("mark"), F.least(F.length(F.regexp_extract("hit", "([A-Za-z]*)$", 1)), F.lit(8)).alias("letters")]
    spans = spans.select("row", "doc_id", "kind", "start", "end", F.col("is_base").cast("int").alias("base"), *features)
    # a candidate that several generators propose, or that is a base span, is one row
    same = ["row", "doc_id", "kind", "start", "end"]
    return spans.groupBy(*same).agg(F.max("base").alias("base"),
                                    *[F.max(f).alias(f) for f in ("kind_no", *FEATURES[1:])])


def related(spans: DataFrame) -> DataFrame:
    """``spans`` with ``hits_base``: the span overlaps a base span that begins before or after it, or is one.

    ``nested``: it lies within a base span of its own kind.
    """
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    base_end, base_start = F.when(F.col("base") == 1, F.col("end")), F.when(F.col("base") == 1, F.col("start"))
    seen = F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, 0))
    coming = F.min(base_start).over(order.rowsBetween(0, Window.unboundedFollowing))
    hits = F.coalesce(seen > F.col("start"), F.lit(False)) | F.coalesce(coming < F.col("end"), F.lit(False))
    own = Window.partitionBy("row", "kind").orderBy("start", F.desc("end"))
    around = F.max(base_end).over(own.rowsBetween(Window.unboundedPreceding, 0))
    nested = (F.col("base") == 0) & F.coalesce(around >= F.col("end"), F.lit(False))
    return (spans.withColumn("hits_base", F.when(F.col("start").isNotNull(), hits))
            .withColumn("nested", F.when(F.col("start").isNotNull(), nested)))


# --- the model ------------------------------------------------------------------------------------------------

def _national(spans: DataFrame) -> list[dict]:
    """Base phones without their prefix, as examples, and as a part of a longer number, as counter-examples."""
    phones = spans.where("base = 1 and kind = 'phone' and plus = 1 and n_digits > 10")
    out = []
    context = ["before", "after", "keyword", "against"]
    for r in phones.groupBy(*context).agg(F.count("*").alias("n")).orderBy(*context).collect():
        for n_chars, n_marks, brackets in NATIONAL_FORMATS:
            same = {"kind_no": KINDS.index("phone") + 1, "n_chars": n_chars, "n_digits": 10, "n_marks": n_marks, "plus": 0,
                    "brackets": brackets, "keyword": r["keyword"], "against": 0, "zeros": 0, "mark": 2, "letters": 0, "n": r["n"]}
            if not r["against"]:
                out.append(same | {"before": r["before"], "after": r["after"], "valid": 1, "ones": r["n"]})
            out += [same | {"before": a, "after": b, "valid": 0, "ones": 0}
                    for a, b in ((_OTHER, r["after"]), (r["before"], _OTHER), (_OTHER, _OTHER))]
    return out


def contrast(spark: SparkSession) -> DataFrame:
    """doc_id, text, personal: numbers of one format in contexts that make them personal or not, and addresses.

    Bounded by the lists above; the digits are hashes of their place in them.
    """
    def listed(rows, name):
        return F.explode(F.array(*[F.struct(*[F.lit(v).alias(f"v{i}") for i, v in enumerate(r)]) for r in rows])).alias(name)

    where = [(*c, 1) for c in PERSONAL_CONTEXTS] + [(*c, 0) for c in OTHER_CONTEXTS]
    grid = (spark.range(CONTRAST_NUMBERS).withColumnRenamed("id", "no").select("no", listed(where, "w"))
            .select("no", "w", listed(CONTRAST_FORMATS, "f")))
    number = F.lpad(F.pmod(F.xxhash64("no", "w.v0", "w.v1", "f"), F.lit(10**10)).cast("string"), 10, "0")
    # every third number beside a word against it is a round one, as sizes and scores often are
    even = F.concat(F.substring(number, 1, 1), F.lit("00"), F.substring(number, 4, 1), F.lit("00"), F.substring(number, 7, 1),
                    F.lit("000"))
    number = F.when((F.col("w.v2") == 0) & (F.col("no") % 3 == 0), even).otherwise(number)
    text = F.concat("w.v0", "f.v0", F.substring(number, 1, 3), "f.v1", F.substring(number, 4, 3), "f.v2",
                    F.substring(number, 7, 4), "w.v1")
    at = spark.range(1).select(listed([(t, 1) for t in PERSONAL_AT] + [(t, 0) for t in OTHER_AT], "a"))
    at = at.select(listed([(c,) for c in ("Write ", "It ", "mail: ", "and ")], "c"), "a")
    texts = grid.select(text.alias("text"), F.col("w.v2").alias("personal")).unionByName(
        at.select(F.concat("c.v0", "a.v0", F.lit(" .")).alias("text"), F.col("a.v1").alias("personal")))
    return texts.select(F.col("personal").alias("doc_id"), "text", "personal")


def _examples(spans: DataFrame, label: Column) -> DataFrame:
    """Distinct feature vectors with how often they occur (n) and how often as an example (ones)."""
    names = ["kind_no", *FEATURES[1:]]
    known = spans.where("start is not null").select(*names, label.alias("label")).where("label is not null")
    return known.groupBy(*names).agg(F.count("*").alias("n"), F.sum("label").alias("ones"))


def train(spans: DataFrame, max_vectors: int = MAX_VECTORS) -> tuple[FlatTrees, dict[str, dict]] | None:
    """(trees, calibration by kind), or None where there is nothing to learn from.

    A candidate that overlaps no base span and breaks no rule has no label: it
    is what the trees are asked about. One within a base span of its own kind
    has none either: the same format alone may be personal. A kind's calibration
    holds its threshold, the least at which the share of examples among vectors
    held out from the fit reaches MIN_PRECISION, and the precision and recall
    reached there (null where nothing of the kind was held out).
    """
    names = ["kind_no", *FEATURES[1:]]
    label = (F.when(F.col("base") == 1, 1).when(F.col("valid") == 0, 0).when(F.col("nested"), F.lit(None))
             .when(F.col("hits_base"), 0))
    rows = _examples(spans, label).orderBy(F.desc("n"), *names).limit(max_vectors).collect()
    rows += _national(spans)
    if not any(r["ones"] for r in rows):
        return None
    shown = related(candidates(contrast(spans.sparkSession))).where("base = 0 and not hits_base and valid = 1")
    rows += _examples(shown, F.col("doc_id")).orderBy(*names).collect()
    x = np.array([[r[f] for f in names] for r in rows], dtype=float)
    n, ones = np.array([r["n"] for r in rows], float), np.array([r["ones"] for r in rows], float)
    both = np.concatenate([x, x])
    y, w = np.repeat([1.0, 0.0], len(x)), np.concatenate([ones, n - ones])
    w = np.log1p(w)         # a frequent vector counts more, but not in proportion
    part = np.tile(np.arange(len(x)) % 4 == 3, 2)
    model = fit(both[~part], y[~part], w[~part], n_trees=48, depth=4, rate=0.3, reg=0.5, min_hessian=0.05)
    return model, {kind: _calibrated(model, both[at], y[at], w[at]) for no, kind in enumerate(KINDS, 1)
                   for at in [part & (w > 0) & (both[:, 0] == no)]}


def _calibrated(model: FlatTrees, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict:
    """Threshold, precision and recall over vectors that ``model`` has not seen."""
    score = model.score(x)
    out = {"threshold": 0.5, "precision": None, "recall": None}
    for t in np.unique(np.concatenate([[0.5], np.floor(score[score >= 0.5] * 1e4) / 1e4])):
        hit = score >= t
        right = float((w * y)[hit].sum())
        if not hit.any():
            break
        out = {"threshold": float(t), "precision": right / float(w[hit].sum()), "recall": right / max(float((w * y).sum()), 1e-12)}
        if out["precision"] >= MIN_PRECISION:
            break
    return out


def as_sql(model: FlatTrees) -> Column:
    """Log odds of a row, as one expression over the feature columns."""
    names = ["kind_no", *FEATURES[1:]]

    def branch(k: int) -> Column:
        if model.left[k] == k:
            return F.lit(float(model.value[k]))
        left, right = branch(int(model.left[k])), branch(int(model.right[k]))
        return F.when(F.col(names[int(model.feature[k])]) <= float(model.threshold[k]), left).otherwise(right)

    total = F.lit(float(model.base))
    for root in model.roots:
        total = total + branch(int(root))
    return total


def selected(spans: DataFrame, model: tuple[FlatTrees, dict[str, dict]] | None) -> DataFrame:
    """Base spans, and the best candidate of every run of overlapping ones above its kind's threshold."""
    if model is None:
        return spans.where("start is null or base = 1")
    trees, kinds = model
    least = F.lit(float("inf"))
    for kind, found in kinds.items():
        t = found["threshold"]
        least = F.when(F.col("kind") == kind, F.lit(float(np.log(t / (1 - t))) if t < 1 else float("inf"))).otherwise(least)
    scored = spans.withColumn("odds", F.when(F.col("start").isNotNull(), as_sql(trees)))
    asked = (F.col("base") == 0) & ~F.col("hits_base") & (F.col("valid") == 1) & (F.col("odds") >= least)
    scored = scored.where(F.col("start").isNull() | (F.col("base") == 1) | asked)
    new = scored.withColumn("new", F.coalesce((F.col("base") == 0).cast("int"), F.lit(2)))
    order = Window.partitionBy("row", "new").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = new.withColumn("run", F.sum(F.when(F.col("start") < reach, 0).otherwise(1)).over(order))
    best = Window.partitionBy("row", "new", "run").orderBy(F.desc("odds"), F.desc(F.col("end") - F.col("start")), "start",
                                                           "kind_no")
    return new.withColumn("place", F.row_number().over(best)).where("new != 1 or place = 1")


def all_spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, kind, start, end, base of every span; a row without span for every document."""
    spans = saved(related(candidates(docs)), "candidates")
    return selected(spans, train(spans)).select("row", "doc_id", "kind", "kind_no", "start", "end", "base")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email .. n_phone and base_sha256 of the base spans, spans (all), one row per row of ``docs``."""
    listed = F.struct("start", F.col("kind_no").alias("no"), "end",
                      F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("as"))
    base = F.when((F.col("base") == 1) & F.col("start").isNotNull(), listed)
    text = lambda c: F.concat_ws(",", F.transform(F.array_sort(c), lambda s: s["as"]))
    out = all_spans(docs).groupBy("row", "doc_id").agg(
        *[F.sum(((F.col("kind") == k) & (F.col("base") == 1)).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.collect_list(base).alias("b"), F.collect_list(F.when(F.col("start").isNotNull(), listed)).alias("a"))
    counts = [F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS]
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *counts, F.sha2(text(F.col("b")), 256).alias("base_sha256"), text(F.col("a")).alias("spans"))


def _merged(spans: Column) -> Column:
    """Sorted spans (start, kind_no, end) with overlapping ones joined; of a run the first's kind stays."""
    last = lambda acc: F.try_element_at(acc, F.lit(-1))

    def add(acc: Column, s: Column) -> Column:
        longer = F.struct(last(acc)["start"].alias("start"), last(acc)["kind_no"].alias("kind_no"),
                          F.greatest(last(acc)["end"], s["end"]).alias("end"))
        over = (F.size(acc) > 0) & (s["start"] < last(acc)["end"])
        return F.when(over, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(
            F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.slice(spans, 1, 0), add)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, of the first's kind.

    ``n_chars``, if present, is the length of the new text.
    """
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    given = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    body = F.coalesce(F.col(names["text"]), F.lit(""))
    # equal id and text have equal spans; 128 bits keep different ones apart, and copies with other ids apart, too
    key = F.concat_ws(":", F.coalesce(F.col(names["doc_id"]).cast("string"), F.lit("")), body)
    given = given.withColumn("_key", F.md5(key.cast("binary")))
    texts = given.select(F.col("_key").alias("doc_id"), body.alias("text"))
    spans = all_spans(texts).where("start is not null").select("doc_id", "kind_no", F.col("start").cast("int").alias("start"),
                                                               F.col("end").cast("int").alias("end"))
    lists = spans.groupBy(F.col("doc_id").alias("_key")).agg(
        _merged(F.array_sort(F.collect_set(F.struct("start", "kind_no", "end")))).alias("_spans"))
    # the texts pass a table of the (far smaller) lists of their partition and are not sorted
    joined = given.join(lists.hint("shuffle_hash"), "_key", "left")
    cut = lambda a, b: F.substring(body, a + 1, b - a)
    kind = lambda no: F.element_at(F.array(*[F.lit(k.upper()) for k in KINDS]), no.cast("int"))
    parts = F.transform(F.col("_spans"), lambda s, i: F.concat(
        cut(F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_spans"), i - 1)["end"]), s["start"]),
        F.lit("["), kind(s["kind_no"]), F.lit("]")))
    tail = cut(F.get(F.col("_spans"), F.size("_spans") - 1)["end"], F.length(body))
    text = F.when(F.col("_spans").isNull(), F.col(names["text"])).otherwise(F.concat(F.array_join(parts, ""), tail))
    out = joined.withColumn(names["text"], text)
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length(names["text"]).cast("long"))
    return out.select(*[F.col(a).alias(c) for c, a in names.items()])
