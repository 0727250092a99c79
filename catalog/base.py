"""Registry of queries and the shared input views (Spark side and SQL side)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(label: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if label in QUERIES:
            raise ValueError(f"query registered twice: {label}")
        QUERIES[label] = fn
        if sql is not None:
            ORACLES[label] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, label: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{label}.parquet")


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Round every double column."""
    doubles = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c).cast("double"), per_column.get(c, digits)) for c in doubles}) if doubles else df


# -- views: Spark --------------------------------------------------------------------------------

def dirty_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    dirty = e.select(
        "event_id", "user_id",
        F.when(F.col("event_id") % 13 == 0, " N/A ").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 == 0, -999.0).when(F.col("event_id") % 11 == 0, None).otherwise(F.col("value")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"))
    return dirty.unionAll(dirty.where("event_id % 50 = 0"))


def scored_bin(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    p = F.col("l_quantity") / 51
    return li.select("l_orderkey", "l_linenumber", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     p.alias("p"), (p >= 0.5).cast("int").alias("pred"))


def scored_reg(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500.0).alias("yhat"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def scored_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Order priority as class 0..4 and five probabilities from the bytes of the key's md5."""
    o = table(spark, sf, "orders")
    h = F.md5(F.col("o_orderkey").cast("string"))
    raw = F.transform(F.sequence(F.lit(1), F.lit(9), F.lit(2)), lambda i: F.conv(F.substr(h, i, F.lit(2)), 16, 10).cast("double") + 1)
    weighed = o.select("o_orderkey", (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("y"), raw.alias("w"))
    total = F.aggregate("w", F.lit(0.0), lambda acc, v: acc + v)
    base = weighed.select("o_orderkey", "y", F.transform("w", lambda v: v / total).alias("probs"))
    return base.withColumn("pred", F.array_position("probs", F.array_max("probs")).cast("int") - 1)


DRIFT_CUT = "1998-06-01"


def drift_ref(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.where(F.col("l_shipdate") < F.lit(DRIFT_CUT).cast("timestamp_ntz"))


def drift_new(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").where(F.col("l_shipdate") >= F.lit(DRIFT_CUT).cast("timestamp_ntz"))
    return li.withColumns({
        "l_quantity": F.when(F.col("l_linenumber") == 1, F.col("l_quantity") * 1.2).otherwise(F.col("l_quantity")),
        "l_returnflag": F.when(F.col("l_orderkey") % 97 == 0, "X").otherwise(F.col("l_returnflag"))})


def monitor_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the day, a score, a label, and inflated values on days 15 to 20."""
    e = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    return e.select(
        "event_id", "ts", "day", "user_id", "event_type",
        F.when(F.col("day").between(15, 20), F.col("value") * 1.5).otherwise(F.col("value")).alias("value"),
        (F.col("event_type") == "purchase").cast("int").alias("y"), (F.col("value") / 500).alias("p"))


def train_table(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their part; label y is a returned item."""
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
        "p_name", "p_brand", "p_type", "p_size", "p_retailprice", (F.col("l_returnflag") == "R").cast("int").alias("y"))


def trials(spark: SparkSession, sf: str) -> DataFrame:
    """Search trials derived from suppliers: parameters and a score from hashed keys."""
    s = table(spark, sf, "supplier")
    digit = lambda i: F.conv(F.substring(F.md5(F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))), i, 2), 16, 10).cast("int")
    return s.select(F.col("s_suppkey").alias("trial"), (3 + digit(1) % 8).alias("max_depth"),
                    (0.01 + digit(3) / 1000.0).alias("learning_rate"), (0.5 + digit(5) / 512.0).alias("subsample"),
                    (0.6 + digit(7) / 1024.0 + (3 + digit(1) % 8) / 100.0).alias("score"))


# -- views: SQL ----------------------------------------------------------------------------------

SQL_DIRTY = """
base AS (
  SELECT event_id, user_id,
         CASE WHEN event_id % 13 = 0 THEN ' N/A ' ELSE event_type END AS event_type,
         CASE WHEN event_id % 7 = 0 THEN -999.0 WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time
  FROM events),
dirty AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE event_id % 50 = 0)
"""
SQL_CLEAN = SQL_DIRTY + """,
cleaned AS (
  SELECT event_id, user_id,
         CASE WHEN trim(event_type) IN ('N/A','n/a','NA','none','None','') THEN NULL ELSE trim(event_type) END AS event_type,
         CASE WHEN value IN (-999, -9999) THEN NULL ELSE value END AS value, event_time
  FROM (SELECT DISTINCT * FROM dirty))
"""
SQL_BIN = """
sb AS (SELECT l_orderkey, l_linenumber, l_discount, CAST(l_returnflag = 'R' AS INT) AS y, l_quantity / 51 AS p,
              CAST(l_quantity / 51 >= 0.5 AS INT) AS pred FROM lineitem)
"""
SQL_REG = "sr AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS y, l_quantity * 1500.0 AS yhat FROM lineitem)"
_RAW = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), {}, 2)) AS INT) + 1.0"
SQL_MULTI = f"""
raw AS (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS y,
               [{', '.join(_RAW.format(2 * i + 1) for i in range(5))}]::DOUBLE[] AS w FROM orders),
sm AS (SELECT o_orderkey, y, list_transform(w, lambda v: v / (w[1] + w[2] + w[3] + w[4] + w[5])) AS probs,
              list_position(w, list_max(w)) - 1 AS pred FROM raw)
"""
SQL_DRIFT = f"""
dr AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{DRIFT_CUT}'),
dn AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CASE WHEN l_linenumber = 1 THEN l_quantity * 1.2 ELSE l_quantity END AS l_quantity,
              l_extendedprice, l_discount, l_tax,
              CASE WHEN l_orderkey % 97 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus, l_shipdate
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_CUT}')
"""
SQL_MONITOR = """
me AS (SELECT event_id, ts, day, user_id, event_type, CASE WHEN day BETWEEN 15 AND 20 THEN value * 1.5 ELSE value END AS value,
              CAST(event_type = 'purchase' AS INT) AS y, value / 500 AS p
       FROM (SELECT *, CAST(dayofmonth(ts) AS INT) AS day FROM events))
"""
SQL_TRAIN = """
tt AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
              p_name, p_brand, p_type, p_size, p_retailprice, CAST(l_returnflag = 'R' AS INT) AS y
       FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
_DIGIT = "CAST(('0x' || substr(md5('t' || CAST(s_suppkey AS VARCHAR)), {}, 2)) AS INT)"
SQL_TRIALS = f"""
tr AS (SELECT s_suppkey AS trial, 3 + {_DIGIT.format(1)} % 8 AS max_depth, 0.01 + {_DIGIT.format(3)} / 1000.0::DOUBLE AS learning_rate,
              0.5 + {_DIGIT.format(5)} / 512.0::DOUBLE AS subsample,
              0.6 + {_DIGIT.format(7)} / 1024.0::DOUBLE + (3 + {_DIGIT.format(1)} % 8) / 100.0::DOUBLE AS score FROM supplier)
"""


def ks_sf(d: str, n: str, m: str) -> str:
    """Two-sample tail as SQL: the series beyond 10,000 values a side, else one minus the share of lattice paths that stay inside the band.

    The list holds the shares at the points of one diagonal i + j = s inside the band, from its first i on.
    """
    lam = f"(({d}) * sqrt(CAST({n} AS DOUBLE) * {m} / ({n} + {m})))"
    series = (f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101), "
              f"lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * pow({lam}, 2)))))) END")
    nn, mm = f"CAST({n} AS BIGINT)", f"CAST({m} AS BIGINT)"
    h = f"CAST(round(({d}) * {nn} * {mm}) AS BIGINT)"
    low = lambda s: f"greatest(0, {s} - {mm}, CAST(floor(({s} * {nn} - {h}) / CAST({nn} + {mm} AS DOUBLE)) AS BIGINT) + 1)"
    high = lambda s: f"least({nn}, {s}, CAST(ceil(({s} * {nn} + {h}) / CAST({nn} + {mm} AS DOUBLE)) AS BIGINT) - 1)"
    s = "CAST(step[1] AS BIGINT)"
    at = lambda i: f"coalesce(held[{i} - {low(f'({s} - 1)')} + 1], 0.0)"
    one = (f"list_transform(range({low(s)}, {high(s)} + 1), lambda i: (i * (CASE WHEN i - 1 < {low(f'({s} - 1)')} THEN 0.0 ELSE {at('(i - 1)')} END)"
           f" + ({s} - i) * {at('i')}) / {s})")
    paths = (f"list_reduce(list_transform(range(1, {nn} + {mm} + 1), lambda s0: [CAST(s0 AS DOUBLE)]), lambda held, step: {one}, [CAST(1.0 AS DOUBLE)])")
    return f"CASE WHEN greatest({n}, {m}) > 10000 THEN {series} WHEN {h} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - coalesce({paths}[1], 0.0)) END"


def chi2_sf(stat: str, df: str) -> str:
    """Chi-squared tail as SQL: one minus the series of the lower incomplete gamma function."""
    return (f"CASE WHEN ({stat}) <= 0 THEN 1.0 WHEN ({stat}) > 1400 AND ({stat}) > 4 * ({df}) THEN 0.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 2000), "
            f"lambda i: exp((({df}) / 2.0 + i) * ln(({stat}) / 2.0) - ({stat}) / 2.0 - lgamma(({df}) / 2.0 + i + 1))))) END")
