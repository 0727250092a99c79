"""A, B and C: sources and sinks, cleaning, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    SQL_BIN, SQL_CLEAN, SQL_DIRTY, SQL_REG, SQL_TRAIN, dirty_events, query, r, rounded, scored_bin, scored_reg, table, train_table,
)
from veldtab.operators import cleaning as C
from veldtab.operators import profiling as P
from veldtab.sources import readers, sinks
from veldtab.sources.storage import fresh_path


# -- A: sources and sinks ------------------------------------------------------------------------

@query("a1_read_by_extension", """
SELECT kind, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, round(sum(o_totalprice), 2) AS price_sum
FROM orders, (VALUES ('csv'), ('jsonl'), ('parquet')) k(kind) GROUP BY kind""")
def _(spark, sf):
    """Orders written in three splittable formats and read back by extension."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    base = fresh_path(spark, "formats")
    sinks.write_report(orders, f"{base}/o.csv", "csv")
    sinks.write_report(orders, f"{base}/o.jsonl", "json")
    sinks.write_report(orders, f"{base}/o.parquet", "parquet")
    schema = orders.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    parts = []
    for kind in ("csv", "jsonl", "parquet"):
        frame = readers.read_table(spark, f"{base}/o.{kind}", schema=None if kind == "parquet" else schema)
        parts.append(frame.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"),
                               r(F.sum("o_totalprice"), 2).alias("price_sum")).withColumn("kind", F.lit(kind)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("a2_concat_files", """
SELECT kind, count(*) AS n, count(price) AS n_price, count(segment) AS n_segment FROM (
  SELECT 'orders' AS kind, o_orderkey AS k, o_totalprice AS price, NULL AS segment FROM orders
  UNION ALL SELECT 'customer', c_custkey, NULL, c_mktsegment FROM customer) GROUP BY kind""")
def _(spark, sf):
    """Files with different columns under one glob, united by name."""
    base = fresh_path(spark, "concat")
    orders = table(spark, sf, "orders").select(F.lit("orders").alias("kind"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    customer = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    sinks.write_report(orders, f"{base}/part_a.csv", "csv")
    sinks.write_report(customer, f"{base}/part_b.csv", "csv")
    both = readers.read_table(spark, f"{base}/part_*.csv", provenance=True)
    return both.groupBy("kind").agg(F.count("*").alias("n"), F.count("price").alias("n_price"), F.count("segment").alias("n_segment"))


@query("a3_csv_inference", """
SELECT column_name, kind FROM (VALUES ('o_orderkey', 'int'), ('o_totalprice', 'double'), ('o_orderpriority', 'string')) t(column_name, kind),
  (SELECT count(*) AS n FROM orders) c WHERE c.n > 0""")
def _(spark, sf):
    """Types of a CSV file inferred from a sample of its rows."""
    base = fresh_path(spark, "infer")
    sinks.write_report(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), f"{base}/o.csv", "csv")
    frame = readers.read_table(spark, f"{base}/o.csv", sampling_ratio=0.2)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("kind")) for c, t in frame.dtypes])
    return frame.agg(F.count("*").alias("_n")).where("_n > 0").select(F.explode(pairs).alias("s")).select("s.*")


@query("a5_materialize", """
SELECT CAST(extract(year FROM o_orderdate) AS INT) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def _(spark, sf):
    """Cleaned orders cached under a key made of the source files and the transform list."""
    key = readers.source_fingerprint(spark, f"{sf}/orders.parquet", "clean")
    folder = fresh_path(spark, "cache")
    first = readers.materialize(C.clean(table(spark, sf, "orders"), dates=False), folder, key)
    again = readers.materialize(first.limit(0), folder, key)
    return again.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).alias("total"))


@query("a6_report_roundtrip", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1""")
def _(spark, sf):
    path = fresh_path(spark, "report")
    report = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), r(F.avg("o_totalprice"), 4).alias("mean"))
    sinks.write_report(report, f"{path}.csv", "csv", small=True)
    return readers.read_table(spark, f"{path}.csv", schema="o_orderpriority string, n bigint, mean double")


_REGISTRY_SQL = f"""
WITH {SQL_BIN}, {SQL_REG},
m AS (SELECT avg(CAST(y = pred AS DOUBLE)) AS acc FROM sb),
g AS (SELECT 1 - avg(pow(y - yhat, 2)) / var_pop(y) AS r2 FROM sr)
SELECT '20260101_000000_a' AS run_id, 'classification' AS task, round(acc, 6) AS main_metric, 0.5::DOUBLE AS best_threshold, 'needs_review' AS status FROM m
UNION ALL SELECT '20260102_000000_b', 'regression', round(r2, 6), 0.0::DOUBLE, CASE WHEN r2 >= 0.7 THEN 'production_ready' ELSE 'needs_review' END FROM g
"""


@query("a7_registry", _REGISTRY_SQL)
def _(spark, sf):
    from veldtab.operators.metrics import label_metrics, metric_rows, regression_metrics
    path = fresh_path(spark, "registry")
    for metrics, run, ts, task in (
            (metric_rows(label_metrics(scored_bin(spark, sf)).select("accuracy")), "a", "20260101_000000", "classification"),
            (metric_rows(regression_metrics(scored_reg(spark, sf)).select("r2")), "b", "20260102_000000", "regression")):
        record = sinks.registry_record(metrics, run_id=run, timestamp=ts, artifact=f"{path}/model_{run}", task=task,
                                       best_n_estimators=50, best_threshold=0.5 if task == "classification" else 0.0,
                                       best_params={"max_depth": 3}, threshold_policy={"mode": "f1"})
        runs = sinks.append_registry(record, path)
    main = F.coalesce(F.try_element_at("eval_metrics", F.lit("accuracy")), F.try_element_at("eval_metrics", F.lit("r2")))
    return runs.select("run_id", "task", main.alias("main_metric"), "best_threshold", "status")


@query("a8_run_report", f"""
WITH {SQL_BIN} SELECT '20260101_000000_a' AS run_id, round(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy, CAST(4 AS INT) AS n_cells FROM sb""")
def _(spark, sf):
    from veldtab.operators.metrics import confusion, label_metrics, metric_rows
    scored = scored_bin(spark, sf)
    record = sinks.registry_record(metric_rows(label_metrics(scored).select("accuracy")), run_id="a", timestamp="20260101_000000",
                                   artifact="m", task="classification", best_n_estimators=1, best_threshold=0.5)
    doc = sinks.run_report(record, {"confusion": confusion(scored)})
    path = fresh_path(spark, "run_report")
    doc.coalesce(1).write.text(path)
    back = spark.read.text(path)
    return back.select(F.get_json_object("value", "$.run_id").alias("run_id"),
                       F.get_json_object("value", "$.eval_metrics.accuracy").cast("double").alias("accuracy"),
                       F.json_array_length(F.get_json_object("value", "$.confusion")).alias("n_cells"))


# -- B: cleaning ---------------------------------------------------------------------------------

@query("b1_drop_empty_rows", f"""
WITH {SQL_DIRTY}, nulls AS (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS a, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS b FROM dirty)
SELECT count(*) AS n, count(a) AS n_a, count(b) AS n_b FROM nulls WHERE NOT (a IS NULL AND b IS NULL)""")
def _(spark, sf):
    d = dirty_events(spark, sf).select(F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("a"),
                                       F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("b"))
    return C.drop_empty_rows(d).agg(F.count("*").alias("n"), F.count("a").alias("n_a"), F.count("b").alias("n_b"))


@query("b2_drop_duplicates", f"WITH {SQL_DIRTY} SELECT DISTINCT * FROM dirty")
def _(spark, sf):
    return C.drop_duplicate_rows(dirty_events(spark, sf))


@query("b3_b4_sentinels", f"WITH {SQL_CLEAN} SELECT event_id, event_type, value FROM cleaned")
def _(spark, sf):
    d = C.drop_duplicate_rows(dirty_events(spark, sf))
    return C.clean_strings(C.numeric_sentinels_to_null(d)).select("event_id", "event_type", "value")


_ANGLE = "2 * pi() * {} / {}"
_CALENDAR_SQL = f"""
WITH {SQL_CLEAN}, t AS (SELECT event_id, strptime(event_time, '%Y-%m-%d %H:%M:%S') AS ts FROM cleaned)
SELECT event_id, CAST(year(ts) AS INT) AS event_time_year, CAST(month(ts) AS INT) AS event_time_month,
       CAST(isodow(ts) - 1 AS INT) AS event_time_dayofweek, CAST(hour(ts) AS INT) AS event_time_hour,
       round(sin({_ANGLE.format('month(ts)', 12)}), 6) AS event_time_month_sin, round(cos({_ANGLE.format('month(ts)', 12)}), 6) AS event_time_month_cos,
       round(sin({_ANGLE.format('(isodow(ts) - 1)', 7)}), 6) AS event_time_dayofweek_sin, round(cos({_ANGLE.format('(isodow(ts) - 1)', 7)}), 6) AS event_time_dayofweek_cos,
       round(sin({_ANGLE.format('hour(ts)', 24)}), 6) AS event_time_hour_sin, round(cos({_ANGLE.format('hour(ts)', 24)}), 6) AS event_time_hour_cos
FROM t"""


@query("b5_b6_calendar_features", _CALENDAR_SQL)
def _(spark, sf):
    return rounded(C.clean(dirty_events(spark, sf)).drop("user_id", "event_type", "value"))


@query("b7_b8_b9_pretransform", "SELECT l_orderkey, l_linenumber, round(CAST(ln(1 + l_extendedprice) AS FLOAT)::DOUBLE, 6) AS l_extendedprice, round(CAST(l_discount AS FLOAT)::DOUBLE, 6) AS l_discount FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    out = C.pretransform(li, log1p=["l_extendedprice", "not_there"], drop=["l_tax", "not_there"])
    return rounded(C.downcast_doubles(out))


@query("b10_log_target", """
SELECT CAST(min(l_extendedprice) > 0 AS INT) AS logged, round(avg(ln(1 + l_extendedprice)), 6) AS mean_log, round(avg(l_extendedprice), 2) AS mean_back FROM lineitem""")
def _(spark, sf):
    out, logged = C.log_target(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice")
    back = C.undo_log(out.withColumn("back", F.col("l_extendedprice")), ["back"], logged)
    return back.agg(F.lit(int(logged)).alias("logged"), r(F.avg("l_extendedprice")).alias("mean_log"), r(F.avg("back"), 2).alias("mean_back"))


@query("b11_label_encoding", """
WITH l AS (SELECT o_orderpriority AS label, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INT) AS code FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT l.code, l.label AS decoded, count(*) AS n FROM orders JOIN l ON o_orderpriority = l.label GROUP BY 1, 2""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    labels = C.fit_labels(o, "o_orderpriority")
    coded = C.decode_labels(C.encode_labels(o, "o_orderpriority", labels, "code"), "code", labels, "decoded")
    return coded.groupBy("code", "decoded").agg(F.count("*").alias("n"))


@query("b12_infinities", "SELECT count(*) AS n, count(CASE WHEN l_discount <> 0 THEN 1 END) AS n_finite, round(sum(CASE WHEN l_discount <> 0 THEN l_quantity / l_discount END), 2) AS total FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    ratio = F.when(F.col("l_discount") != 0, F.col("l_quantity") / F.nullif("l_discount", F.lit(0.0))).otherwise(F.lit(float("inf")))
    out = C.infinities_to_null(li.select(ratio.alias("q")), ["q"])
    return out.agg(F.count("*").alias("n"), F.count("q").alias("n_finite"), r(F.sum("q"), 2).alias("total"))


@query("b13_drop_null_columns", "SELECT 'event_id,user_id,event_type,value,event_time' AS kept, count(*) AS n FROM events")
def _(spark, sf):
    d = C.drop_duplicate_rows(dirty_events(spark, sf)).withColumn("empty", F.lit(None).cast("double"))
    out = C.drop_null_columns(d)
    return out.agg(F.lit(",".join(out.columns)).alias("kept"), F.count("*").alias("n"))


# -- C: profiling --------------------------------------------------------------------------------

_MISSING_SQL = f"""
WITH {SQL_CLEAN}
SELECT 'value' AS "column", count(*) - count(value) AS missing_count, round(1 - count(value) / count(*)::DOUBLE, 6) AS missing_pct, false AS is_target, 'double' AS dtype FROM cleaned
UNION ALL SELECT 'event_type', count(*) - count(event_type), round(1 - count(event_type) / count(*)::DOUBLE, 6), true, 'string' FROM cleaned"""


@query("c1_missing_report", _MISSING_SQL)
def _(spark, sf):
    return rounded(P.missing_by_column(C.clean(dirty_events(spark, sf), dates=False), "event_type"))


@query("c1_missing_totals", f"""
WITH {SQL_CLEAN}, n AS (SELECT CAST(value IS NULL AS INT) + CAST(event_type IS NULL AS INT) AS m FROM cleaned)
SELECT CAST(sum(m) AS BIGINT) AS total_missing, round(sum(m) / (count(*) * 5)::DOUBLE, 6) AS missing_cells_pct,
       count(*) FILTER (m > 0) AS rows_with_missing, round(count(*) FILTER (m > 0) / count(*)::DOUBLE, 6) AS rows_with_missing_pct FROM n""")
def _(spark, sf):
    return rounded(P.missing_totals(C.clean(dirty_events(spark, sf), dates=False)))


@query("c2_expectations", """
SELECT 'quantity range' AS rule, 'l_quantity' AS "column", count(*) FILTER (NOT l_quantity BETWEEN 1 AND 40) AS n_failed, count(*) FILTER (NOT l_quantity BETWEEN 1 AND 40) = 0 AS success FROM lineitem
UNION ALL SELECT 'price positive', 'l_extendedprice', count(*) FILTER (NOT l_extendedprice > 0), count(*) FILTER (NOT l_extendedprice > 0) = 0 FROM lineitem""")
def _(spark, sf):
    rules = [P.Rule("quantity range", F.col("l_quantity").between(1, 40), "l_quantity"),
             P.Rule("price positive", F.col("l_extendedprice") > 0, "l_extendedprice")]
    return P.expect(table(spark, sf, "lineitem"), rules)


def _sig(x: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 0.0 ELSE round_even({x} * pow(10, 3 - floor(log10(abs({x})))), 0) / pow(10, 3 - floor(log10(abs({x})))) END)"


def _contract_row(c: str, nullable: str = "true") -> str:
    return (f"SELECT '{c}' AS \"column\", 'double' AS dtype, {nullable} AS nullable, {_sig('lo')} AS lo, {_sig('hi')} AS hi FROM "
            f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.001) AS lo, quantile_cont(CAST({c} AS DOUBLE), 0.999) AS hi FROM lineitem)")


_CONTRACT_SQL = " UNION ALL ".join([_contract_row("l_quantity"), _contract_row("l_extendedprice"), _contract_row("l_discount", "false"),
                                    "SELECT 'l_returnflag', 'string', true, NULL, NULL"])


@query("c3_contract", f"SELECT \"column\", dtype, nullable, round(lo, 6) AS lo, round(hi, 6) AS hi FROM ({_CONTRACT_SQL})")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    return rounded(P.infer_contract(li, "l_discount"))


@query("c4_contract_check", f"""
WITH c AS ({_CONTRACT_SQL})
SELECT 'l_discount' AS "column", 'not_nullable' AS "check", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'l_quantity', 'in_range', count(*) FILTER (NOT l_quantity BETWEEN lo AND hi) FROM lineitem, c WHERE c."column" = 'l_quantity'
UNION ALL SELECT 'l_extendedprice', 'in_range', count(*) FILTER (NOT l_extendedprice BETWEEN lo AND hi) FROM lineitem, c WHERE c."column" = 'l_extendedprice'
UNION ALL SELECT 'l_discount', 'in_range', count(*) FILTER (NOT l_discount BETWEEN lo AND hi) FROM lineitem, c WHERE c."column" = 'l_discount'""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    return P.check_contract(li, P.infer_contract(li, "l_discount"))


@query("c5_target_skewness", """
SELECT count(*) AS n_rows, round(skewness(o_totalprice), 5) AS skewness, abs(skewness(o_totalprice)) > 2 AS suggest_log FROM orders""")
def _(spark, sf):
    return rounded(P.target_skewness(table(spark, sf, "orders"), "o_totalprice"), skewness=5)


def _role(c: str, kind: str) -> str:
    if kind == "text":
        return f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) > 50 THEN 'target_encoded' ELSE 'one_hot' END AS role FROM tt"
    if kind == "int":
        return f"SELECT '{c}', CASE WHEN count(DISTINCT {c}) <= 20 THEN 'one_hot' ELSE 'numeric' END FROM tt"
    return f"SELECT '{c}', 'numeric'"


@query("c6_roles", f"WITH {SQL_TRAIN} " + " UNION ALL ".join(
    [_role(c, "text") for c in ("l_linestatus", "p_name", "p_brand", "p_type")] + [_role(c, "int") for c in ("p_size", "l_linenumber")]
    + [_role(c, "double") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice")]))
def _(spark, sf):
    return P.role_table(train_table(spark, sf), exclude=["y", "l_orderkey"])


_METRIC_SQL = """
WITH n AS ({counts}), s AS (SELECT count(*) AS k, min(n) AS lo, max(n) AS hi, sum(n)::DOUBLE AS t FROM n),
m AS (SELECT CASE WHEN k = 2 AND lo / t >= 0.15 THEN 'roc_auc' WHEN k = 2 THEN 'auprc'
             WHEN greatest(abs(hi / t - 1.0 / k), abs(lo / t - 1.0 / k)) < 0.5 / k THEN 'f1_macro' ELSE 'f1_weighted' END AS metric, hi / lo::DOUBLE AS w FROM s)
SELECT '{label}' AS target, metric, 'maximize' AS direction, metric IN ('roc_auc', 'auprc') AS needs_probability,
       CASE WHEN metric = 'auprc' THEN round(w, 6) END AS class_weight FROM m"""


@query("c7_choose_metric", " UNION ALL ".join("SELECT * FROM (" + _METRIC_SQL.format(counts=c, label=n) + ")" for n, c in (
    ("flag", "SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag = 'R'"),
    ("rare", "SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey % 50 = 0"),
    ("status", "SELECT count(*) AS n FROM orders GROUP BY o_orderstatus"))))
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    one = lambda df, label: P.choose_metric(df, "t").withColumn("target", F.lit(label))
    out = (one(li.select((F.col("l_returnflag") == "R").cast("int").alias("t")), "flag")
           .unionByName(one(li.select((F.col("l_orderkey") % 50 == 0).cast("int").alias("t")), "rare"))
           .unionByName(one(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("t")), "status")))
    return rounded(out)
