"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked until their marginals meet the targets: each round scales the
cells of every source, then of every language, then of every topic. Documents are summed to cells first, on the map side; only
the table of cells is written between steps. Weight over tokens of a cell, brought to a
token budget with probabilities capped at 1, is the probability with which its documents are kept.

Targets are given per dimension as rows (value, share), or follow from the corpus: tokens to the power ``TEMPER``. A
value without a target keeps none of its tokens; a target without tokens is left out and the others are scaled up.

Null source or language is a value of its own (``NONE``); null and empty texts have no tokens, get the probability of their
cell, and cells without tokens have weight 0 and probability 0. Repeated rows share their fate; null ids are drawn by
their text. Empty tables give empty results. Extra columns are dropped by ``mix`` and kept by ``sample_mix``.
All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import packed, table, unpacked
from veldtab.sources.storage import write_through

NONE = "(none)"
DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.7, "lang": 0.5, "topic": 0.5}
#: First matching rule names the topic.
TOPICS = (("legal", r"(?i)licen[cs]e|copyright|all rights"), ("contact", r"@[a-z]|\+\d"), ("figures", r"\d{4}"))
OTHER_TOPIC = "prose"
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 15
TOLERANCE = 1e-8
BUDGET_SHARE = 0.5
#: Cells up to which the table of cells is broadcast; a larger one is joined.
BROADCAST_CELLS = 200_000


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from the md5 of the id as text, or of the text where the id is null."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, topic: Column | None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE))
    return packed(docs, value(source_col).alias("source"), value(lang_col).alias("lang"), (topic_of(text) if topic is None else topic).alias("topic"),
                  F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"), uniform(F.col(id_col), text).alias("u"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share): shares of the dimension's values, by their tokens to a power."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    return sums.select("value", F.pow("tokens", F.lit(power)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Add ``weight``, the raked tokens per token of the cell, to cells (source, lang, topic, tokens); all weights times tokens sum to all tokens.

    Every step is one small aggregation, one join and one written table of cells. Raking ends when no marginal is off its goal by more than
    ``tolerance`` of it, or after ``rounds`` (targets that no weights can meet, because cells are missing, have no end).
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    state = cells.withColumn("mass", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        given = targets[d] if targets and d in targets else tempered(cells, d, TEMPER[d])
        there = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
        goal = there.join(given.where("share > 0"), "value").select(F.col("value").alias(d), F.col("share").cast("double").alias("share"))
        scale = total / (goal.agg(F.sum("share")).first()[0] or 1.0)
        state = write_through(state.join(goal, d, "left").withColumn(f"goal_{d}", F.coalesce(F.col("share") * scale, F.lit(0.0))).drop("share"), "mix-cells")
    for _ in range(rounds):
        worst = 0.0
        for d in DIMENSIONS:
            sums = state.groupBy(d).agg(F.sum("mass").alias("now"))
            factor = F.coalesce(F.col(f"goal_{d}") / F.nullif(F.col("now"), F.lit(0.0)), F.lit(0.0))
            off = F.when(F.col("now") > 0, F.abs(factor - 1)).otherwise(0.0)
            state = write_through(state.drop("off").join(sums, d).withColumns({"mass": F.col("mass") * factor, "off": off}).drop("now"), "mix-cells")
            worst = max(worst, state.agg(F.max("off")).first()[0] or 0.0)
        if worst <= tolerance:
            break
    weight = F.when(F.col("tokens") > 0, F.col("mass") / F.col("tokens")).otherwise(0.0)
    return state.select(*cells.columns, weight.alias("weight"))


def calibrate(raked: DataFrame, budget: float) -> float:
    """The factor with which min(1, factor * weight) keeps ``budget`` tokens in expectation; infinite where all weighted cells fit."""
    factor = 0.0
    while True:
        full = (F.col("weight") * factor >= 1) & (F.col("weight") > 0)
        row = raked.agg(F.sum(F.when(full, F.col("tokens"))).alias("full"), F.sum(F.when(~full, F.col("tokens") * F.col("weight"))).alias("rest")).first()
        rest = row["rest"] or 0.0
        if not rest:
            return float("inf") if budget > 0 else 0.0
        new = max(factor, (budget - (row["full"] or 0)) / rest)
        if new <= factor * (1 + 1e-15):
            return factor
        factor = new


def _mixed(docs: DataFrame, targets: dict[str, DataFrame] | None, budget_share: float, id_col: str, text_col: str, source_col: str, lang_col: str,
           topic: Column | None) -> DataFrame:
    placed = _placed(docs, id_col, text_col, source_col, lang_col, topic)
    cells = write_through(placed.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    raked = rake(cells, targets)
    factor = calibrate(raked, budget_share * (cells.agg(F.sum("tokens")).first()[0] or 0))
    chance = F.when(F.col("weight") <= 0, 0.0).otherwise(F.lit(1.0) if factor == float("inf") else F.least(F.lit(1.0), F.col("weight") * factor))
    chances = raked.select(*DIMENSIONS, "weight", chance.alias("probability"))
    if raked.count() <= BROADCAST_CELLS:
        chances = F.broadcast(chances)
    return placed.join(chances, list(DIMENSIONS)).withColumn("sampled", F.col("u") < F.col("probability"))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget_share: float = BUDGET_SHARE, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """(doc_id, topic, n_tokens, weight, probability, sampled) of every row."""
    return _mixed(docs, targets, budget_share, id_col, text_col, source_col, lang_col, topic).select(
        F.col(f"__row.`{id_col}`").alias("doc_id"), "topic", "n_tokens", "weight", "probability", "sampled")


def sample_mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget_share: float = BUDGET_SHARE, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """The sampled rows with their own columns."""
    return unpacked(_mixed(docs, targets, budget_share, id_col, text_col, source_col, lang_col, topic).where("sampled"))


def op2_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.withColumns({"weight": F.round("weight", 6), "probability": F.round("probability", 6)})


def _op2_sql(rounds: int = ROUNDS) -> str:
    """The same raking as a chain of common table expressions."""
    case = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    parts = [f"""
doc AS MATERIALIZED (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, CASE {case} ELSE '{OTHER_TOPIC}' END AS topic,
  CAST(len(regexp_extract_all(t, '{WORD}')) AS BIGINT) AS n_tokens,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), t)), 1, 12)) AS BIGINT) / 281474976710656.0 AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cell AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM doc GROUP BY ALL),
tot AS (SELECT sum(tokens) AS total FROM cell),
w0 AS MATERIALIZED (SELECT *, tokens AS w FROM cell)"""]
    for d in DIMENSIONS:
        parts.append(f"g_{d} AS MATERIALIZED (SELECT {d}, pow(sum(tokens), {TEMPER[d]}) / sum(pow(sum(tokens), {TEMPER[d]})) OVER () * (SELECT total FROM tot) AS goal "
                     f"FROM cell GROUP BY {d} HAVING sum(tokens) > 0)")
    k = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            parts.append(f"w{k + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, c.w * goal / sum(c.w) OVER (PARTITION BY c.{d}) AS w FROM w{k} c JOIN g_{d} g ON c.{d} = g.{d})")
            k += 1
    parts.append(f"""raked AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS weight FROM w{k}),
steps AS (SELECT weight, coalesce(sum(tokens) OVER (ORDER BY weight DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
  sum(tokens * weight) OVER (ORDER BY weight DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mass FROM raked),
pick AS (SELECT min(CASE WHEN rest <= 0 THEN NULL ELSE ({BUDGET_SHARE} * total - upto) / rest END) FILTER (WHERE ok) AS factor
  FROM (SELECT upto, total - mass AS rest, total,
          lag_weight * ({BUDGET_SHARE} * total - upto) >= total - mass AND weight * ({BUDGET_SHARE} * total - upto) < total - mass AS ok
        FROM (SELECT 0.0 AS upto, 0.0 AS mass, max(weight) AS weight, 1e300 AS lag_weight FROM raked
              UNION ALL SELECT upto, mass, coalesce(lead(weight) OVER (ORDER BY weight DESC), 0), weight FROM (SELECT DISTINCT * FROM steps)), tot))
SELECT doc_id, topic, n_tokens, round(weight, 6) AS weight, round(p, 6) AS probability, u < p AS sampled
FROM (SELECT doc_id, doc.topic, n_tokens, u, weight, CASE WHEN weight <= 0 THEN 0 ELSE least(1.0, weight * (SELECT factor FROM pick)) END AS p
      FROM doc JOIN raked ON doc.source = raked.source AND doc.lang = raked.lang AND doc.topic = raked.topic)""")
    return "WITH " + ",\n".join(parts)


OP2_SQL = _op2_sql()
