"""Input views derived from the given tables (FIXTURES.md section 2).

V  visits      events grouped by (user_id, day), joined to customer
D  documents   labels joined to documents, with text statistics
O  orders      orders with month / quarter / period
L  lineitem    lineitem as is (the large profiling table)
E  embeddings  vec_id, embedding array<float>[64], label

Every builder is a lazy DataFrame over the parquet scan, so Catalyst pushes
column pruning into the scans. The SQL mirrors live in ``plans.sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.sources.io import bind_columns, read_table

# Fixed values shared with the oracle SQL.
TEST_START_DAY = "2024-01-22"          # V: visits on/after this day are the test period
OTHER_VISITOR_MODULUS = 17             # V: user_id % 17 = 0 -> visitor 'Other'
TEST_MONTHS = (11, 12)                 # O: test = November and December
# Month level list in declared order (full "June", as in the reference data).
MONTH_LEVELS = ["Jan", "Feb", "Mar", "Apr", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

V_NUMERIC = ["adm", "adm_value", "inf", "inf_value", "prd", "prd_value", "err_rate"]
V_CATEGORICAL = ["visitor", "nation", "segment", "weekend"]
V_COUNTS = ["adm", "inf", "prd"]
L_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
L_CATEGORICAL = ["l_returnflag", "l_linestatus"]
D_NUMERIC = ["n_chars", "n_words", "distinct_share", "digit_share", "n_lines"]

_WORD = r"([^ \t\r\n]+)"


def visits(spark: SparkSession, base: str) -> DataFrame:
    """Fixture V: one row per (user, day); purchases feed only the label."""
    ev = read_table(spark, base, "events", ["user_id", "ts", "event_type", "value"])
    et, v = F.col("event_type"), F.col("value")

    def n_of(kind):
        return F.count_if(et == kind)

    def value_of(kind):
        return F.sum(F.when(et == kind, v).otherwise(F.lit(0.0)))

    g = (ev.withColumn("day", F.to_date("ts"))
         .groupBy("user_id", "day")
         .agg(n_of("signup").alias("adm"), value_of("signup").alias("adm_value"),
              n_of("click").alias("inf"), value_of("click").alias("inf_value"),
              n_of("view").alias("prd"), value_of("view").alias("prd_value"),
              n_of("error").alias("n_err"), F.count_if(et != "purchase").alias("n_nonp"),
              F.max((et == "purchase").cast("int")).alias("label")))
    # A user has at most one row per day here, so this window is bounded by days.
    first_day = F.min("day").over(Window.partitionBy("user_id"))
    g = g.select(
        "*",
        F.when(F.col("user_id") % OTHER_VISITOR_MODULUS == 0, F.lit("Other"))
         .when(F.col("day") == first_day, F.lit("New_Visitor"))
         .otherwise(F.lit("Returning_Visitor")).alias("visitor"))
    cust = read_table(spark, base, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    j = g.join(cust, g.user_id == cust.c_custkey, "left")
    return j.select(
        F.concat_ws("_", F.col("user_id").cast("string"), F.col("day").cast("string")).alias("visit_id"),
        "user_id", "day",
        F.when(F.col("day") >= F.lit(TEST_START_DAY).cast("date"), "test").otherwise("train").alias("period"),
        "adm", "adm_value", "inf", "inf_value", "prd", "prd_value",
        F.when(F.col("n_nonp") == 0, F.lit(0.0))
         .otherwise(F.col("n_err") / F.col("n_nonp")).alias("err_rate"),
        "visitor",
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.dayofweek("day").isin(1, 7).cast("int").alias("weekend"),
        F.col("label").cast("int").alias("label"))


def documents(spark: SparkSession, base: str) -> DataFrame:
    """Fixture D: labelled documents with whole-text statistics."""
    lab = read_table(spark, base, "labels", ["doc_id", "quality", "toxic"])
    doc = read_table(spark, base, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    j = bind_columns(lab, doc, "doc_id")
    words = F.regexp_extract_all("text", F.lit(_WORD), 1)
    nw = F.size(words)
    nc = F.length("text")
    return j.select(
        "doc_id", "quality", "toxic", "lang", "source", "n_chars",
        nw.cast("long").alias("n_words"),
        F.when(nw == 0, F.lit(0.0)).otherwise(F.size(F.array_distinct(words)) / nw).alias("distinct_share"),
        F.when(nc == 0, F.lit(0.0))
         .otherwise(F.length(F.regexp_replace("text", "[^0-9]", "")) / nc).alias("digit_share"),
        (nc - F.length(F.regexp_replace("text", "\n", "")) + 1).cast("long").alias("n_lines"))


def orders(spark: SparkSession, base: str) -> DataFrame:
    """Fixture O: orders with month number / name and the test period flag."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                           "o_orderpriority", "o_totalprice", "o_orderdate"])
    m = F.month("o_orderdate")
    return o.select(
        "*", m.alias("month"),
        F.element_at(F.array(*[F.lit(x) for x in MONTH_LEVELS]), m).alias("month_name"),
        F.when(m.isin(*TEST_MONTHS), "test").otherwise("train").alias("period"))


def lineitem(spark: SparkSession, base: str) -> DataFrame:
    """Fixture L: the lineitem table as given."""
    return read_table(spark, base, "lineitem")


def embeddings(spark: SparkSession, base: str) -> DataFrame:
    """Fixture E: embedding vectors with a 10-class label."""
    return read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"])
