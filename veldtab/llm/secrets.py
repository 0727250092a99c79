"""Secret scan: three fixed patterns, and strings that look random to character Markov models.

Patterns give labelled samples: their values are random strings, identifiers outside them are ordinary ones. From both, two
models of character pairs are counted on a bounded sample of texts (``fit_rows`` expected, chosen by a hash; equal texts count once).
Ordinary words count in capitals as well. Outside the patterns' spans, every run of ``LEAST`` or more token characters is cut at its
separators, and each part gets the log-likelihood ratio of the models, no pair of characters counting more than ``CLIP`` nats. Neighbouring
parts are joined as long as their sum stays above zero and within ``DROP`` of its highest value; the stretch up to that value is a
span of kind ``markov`` where the value reaches ``threshold`` nats, and more in long runs, which offer more places to look at, and the stretch has ``LEAST_STRETCH`` characters. So words
beside a random string do not thin it out. The random model is mixed half and half with even odds, so that alphabets without a
sample are found as well.

All of it is DataFrame expressions: positions come from the lengths of the pieces between matches, the models are one
array literal with an entry for each pair of the fixed alphabet.

Null texts are empty: no spans. Overlapping spans of the patterns are all reported; ``markov`` ones overlap no other. Repeated rows are scanned one by one; empty tables give empty results, and with nothing to
fit on no run is called random. Extra columns are dropped by ``find_secrets`` and kept by ``redact_secrets``, which
replaces spans and leaves null texts null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import packed, table, unpacked

#: Fixed patterns: kind -> (pattern, least characters of the whole match, least of group 2).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: The same matches where failing ones need not be consumed.
ACCESS_LONG, HEX_LONG = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
LEAST, LEAST_STRETCH = 16, 12
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
SEPARATORS = "/_=-"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]{3,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
FIT_ROWS = 8_000
THRESHOLD, CLIP, DROP = 11.0, 3.0, 3.0
KINDS = ("assign", "access", "hex", "markov")
PLACEHOLDER = "<redacted>"
_SPANS = "array<struct<start:int,kind:int,end:int>>"
_EMPTY = "array<string>"


def _matches(name: str, pattern: str, group: int | None = None, text_col: str = "text") -> dict[str, Column]:
    """Columns with the pieces between matches, the matches and (on request) a group of theirs; empty arrays where nothing matches."""
    text = F.col(text_col)
    hit, none = text.rlike(pattern), F.array().cast(_EMPTY)
    out = {f"{name}_found": F.when(hit, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none),
           f"{name}_between": F.when(hit, F.split(text, pattern, -1)).otherwise(none)}
    if group is not None:
        out[f"{name}_value"] = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), group)).otherwise(none)
    return out


def _spans(name: str, kind: int, keep: str) -> Column:
    """Spans, in code points, of the matches that meet ``keep`` (over m, the match, and v, its group)."""
    before, match, value = f"x.{name}_between", f"x.{name}_found", f"x.{name}_value"
    kept = keep.replace("m.", match).replace("v.", value)
    lists = ", ".join(f"{name}_{part}" for part in ("between", "found", *(["value"] if "v." in keep else [])))
    return F.expr(f"""
      aggregate(arrays_zip({lists}), struct(0 AS at, CAST(array() AS {_SPANS}) AS spans),
        (acc, x) -> struct(
          acc.at + char_length({before}) + coalesce(char_length({match}), 0) AS at,
          CASE WHEN {kept} THEN array_append(acc.spans, named_struct(
                 'start', acc.at + char_length({before}), 'kind', {kind}, 'end', acc.at + char_length({before}) + char_length({match})))
               ELSE acc.spans END AS spans),
        acc -> acc.spans)""")


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``base``, the spans of the three patterns in order, to rows with ``text`` (not null)."""
    keep = df.columns
    cut = df.withColumns(_matches("assign", ASSIGN, 2) | _matches("access", ACCESS_LONG) | _matches("hex", HEX_LONG))
    spans = F.concat(_spans("assign", 0, f"char_length(v.) >= {LEAST_ASSIGN}"), _spans("access", 1, "m. IS NOT NULL"), _spans("hex", 2, "m. IS NOT NULL"))
    return cut.select(*keep, F.array_sort(spans).alias("base"))


def _pair_counts(tokens: DataFrame) -> dict[tuple[str, str], int]:
    """Counts of neighbouring characters in the tokens; at most one entry per pair of the alphabet."""
    pairs = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).select(
        F.explode(F.expr("transform(sequence(1, char_length(token) - 1), i -> substr(token, i, 2))")).alias("pair"), "n")
    return {(r["pair"][0], r["pair"][1]): r["n"] for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}


def _with_capitals(counts: dict[tuple[str, str], int]) -> dict[tuple[str, str], int]:
    """The counts of words, also as they would be in capitals and with a first capital."""
    out = dict(counts)
    for (a, b), n in counts.items():
        if a.islower() and b.islower():
            for pair in ((a.upper(), b.upper()), (a.upper(), b)):
                out[pair] = out.get(pair, 0) + n
    return out


def _log_rates(counts: dict[tuple[str, str], int], even: float) -> list[float]:
    """Log-probability of each second character after each first one, mixed with even odds; rows of the flattened table are first characters."""
    size, out = len(ALPHABET), []
    for first in ALPHABET:
        row = [counts.get((first, second), 0) for second in ALPHABET]
        total = sum(row)
        out += [math.log((1 - even) * (n + 0.5) / (total + 0.5 * size) + even / size) for n in row]
    return out


def fit_ratio(docs: DataFrame, text_col: str = "text", fit_rows: int = FIT_ROWS) -> list[float] | None:
    """Log-likelihood ratios, random over ordinary, of the pairs of the alphabet; None with nothing to fit on."""
    share = min(1.0, fit_rows / max(1, docs.count()))
    some = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)).distinct()
    values = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), 2), lambda v: F.char_length(v) >= LEAST_ASSIGN),
        F.regexp_extract_all("text", F.lit(ACCESS_LONG), 0), F.regexp_extract_all("text", F.lit(HEX_LONG), 0))
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS_LONG, HEX_LONG):
        rest = F.regexp_replace(rest, pattern, " ")
    random = _pair_counts(some.select(F.explode(values).alias("token")))
    ordinary = _pair_counts(some.select(F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), 0)).alias("token")))
    if not ordinary:
        return None
    return [max(-CLIP, min(CLIP, a - b)) for a, b in zip(_log_rates(random, 0.5), _log_rates(_with_capitals(ordinary), 0.1))]


def _masked() -> Column:
    """``text`` with blanks, as many as code points, in place of the spans in ``base``."""
    return F.expr(f"""
      CASE WHEN size(base) = 0 THEN text ELSE aggregate(base, struct(0 AS at, '' AS out),
        (acc, s) -> struct(greatest(acc.at, s.end) AS at,
          concat(acc.out, CASE WHEN s.start > acc.at THEN substr(text, acc.at + 1, s.start - acc.at) ELSE '' END,
                 repeat(' ', greatest(0, s.end - greatest(acc.at, s.start)))) AS out),
        acc -> concat(acc.out, substr(text, acc.at + 1))) END""")


def _stretches(threshold: float) -> Column:
    """For each of ``run_found`` the (start, end) within it of the stretches of parts that look random."""
    score = f"""aggregate(transform(split(p, ''), c -> instr('{ALPHABET}', c) - 1), struct(-1 AS last, 0D AS sum),
                  (acc, i) -> struct(i AS last, acc.sum + CASE WHEN acc.last < 0 THEN 0D ELSE element_at(__weights, acc.last * {len(ALPHABET)} + i + 1) END AS sum),
                  acc -> acc.sum)"""
    parts = f"transform(split(run, '[{SEPARATORS}]'), p -> struct(char_length(p) AS n, CASE WHEN p = '' THEN 0D ELSE {score} END AS score))"
    ends = f"acc.sum + p.score <= 0 OR acc.sum + p.score < acc.best - {DROP}"
    good = f"acc.best >= {threshold} + ln(greatest(char_length(run), 16) / 16D) AND acc.end - acc.start >= {LEAST_STRETCH}"
    out = f"CASE WHEN {good} THEN array_append(acc.out, struct(acc.start AS start, acc.end AS end)) ELSE acc.out END"
    return F.expr(f"""
      transform(run_found, run -> aggregate({parts},
        struct(0 AS at, 0D AS sum, 0D AS best, 0 AS start, 0 AS end, CAST(array() AS array<struct<start:int,end:int>>) AS out),
        (acc, p) -> struct(
          acc.at + p.n + 1 AS at,
          CASE WHEN {ends} THEN greatest(p.score, 0D) ELSE acc.sum + p.score END AS sum,
          CASE WHEN {ends} THEN greatest(p.score, 0D) ELSE greatest(acc.best, acc.sum + p.score) END AS best,
          CASE WHEN NOT ({ends}) THEN acc.start WHEN p.score > 0 THEN acc.at ELSE acc.at + p.n + 1 END AS start,
          CASE WHEN {ends} THEN acc.at + p.n + IF(p.score > 0, 0, 1) WHEN acc.sum + p.score > acc.best THEN acc.at + p.n ELSE acc.end END AS end,
          CASE WHEN {ends} THEN {out} ELSE acc.out END AS out),
        acc -> {out}))""")


def with_spans(df: DataFrame, ratios: list[float] | None, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``spans``, all spans in order, to rows with ``text`` and ``base``."""
    if ratios is None:
        return df.withColumn("spans", F.col("base"))
    keep, size = df.columns, len(ALPHABET)
    # separators, and marks that are none, say nothing
    marks = [not c.isalnum() for c in ALPHABET]
    weights = F.split(F.lit(",".join("0" if marks[i // size] or marks[i % size] else f"{r:.6f}" for i, r in enumerate(ratios))), ",").cast("array<double>")
    cut = df.withColumn("__masked", _masked())
    cut = cut.withColumns(_matches("run", RUN, text_col="__masked")).withColumn("__weights", weights)
    cut = cut.withColumn("run_random", _stretches(threshold))
    found = F.expr(f"""
      aggregate(arrays_zip(run_between, run_found, run_random), struct(0 AS at, CAST(array() AS {_SPANS}) AS spans),
        (acc, x) -> struct(
          acc.at + char_length(x.run_between) + coalesce(char_length(x.run_found), 0) AS at,
          CASE WHEN size(x.run_random) > 0 THEN concat(acc.spans, transform(x.run_random, r -> named_struct(
                 'start', acc.at + char_length(x.run_between) + r.start, 'kind', 3, 'end', acc.at + char_length(x.run_between) + r.end)))
               ELSE acc.spans END AS spans),
        acc -> acc.spans)""")
    return cut.select(*keep, F.array_sort(F.concat("base", found)).alias("spans"))


def scan(docs: DataFrame, text_col: str = "text", fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The packed rows with ``text``, ``base`` and ``spans`` (start, kind as a place in KINDS, end)."""
    ratios = fit_ratio(docs, text_col, fit_rows)
    return with_spans(base_spans(packed(docs, F.coalesce(F.col(text_col), F.lit("")).alias("text"))), ratios, threshold)


def written(spans: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(element_at(array({kinds}), s.kind + 1), ':', s.start, ':', s.end)), ',')")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base, spans) per row."""
    return scan(docs, text_col, fit_rows, threshold).select(F.col(f"__row.`{id_col}`").alias("doc_id"), "base", "spans")


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with every span replaced by a placeholder; ``length_col``, where there is one, follows the new text."""
    found = scan(docs, text_col, fit_rows, threshold)
    clean = F.expr(f"""
      aggregate(spans, struct(0 AS at, '' AS out),
        (acc, s) -> struct(greatest(acc.at, s.end) AS at,
          CASE WHEN s.start >= acc.at AND (s.start > acc.at OR acc.at = 0) THEN concat(acc.out, substr(text, acc.at + 1, s.start - acc.at), '{PLACEHOLDER}') ELSE acc.out END AS out),
        acc -> concat(acc.out, substr(text, acc.at + 1)))""")
    found = found.withColumn("clean", F.when(F.size("spans") > 0, clean).otherwise(F.col(f"__row.`{text_col}`")))
    row = F.col("__row").withField(f"`{text_col}`", F.col("clean"))
    if length_col in docs.columns:
        row = row.withField(f"`{length_col}`", F.when(F.size("spans") > 0, F.char_length("clean").cast(docs.schema[length_col].dataType)).otherwise(F.col(f"__row.`{length_col}`")))
    return unpacked(found.select(row.alias("__row")))


def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))
