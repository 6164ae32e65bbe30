"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling.

Documents fall into cells of (source, language, topic). The cells' token
weights start as the tokens they hold and are raked to the target marginals,
one dimension after the other, until no marginal is off by more than ``TOLERANCE``
of the whole (targets that contradict each other end when a round no longer changes the residual).

A cell's rate is its fitted weight over its tokens. The sample is to hold ``share`` of all
tokens (by default SHARE): a document's probability is ``min(1, c * rate)``, with c
solved on the cells so that the expected tokens meet that number. A cell whose rate
is far above the others, such as one small document of a new source, is then taken whole
and no longer sets the size of the sample; ``report`` tells for every value its target, what raking
reached and what the sample is expected to hold, so the price of full cells is seen.

Targets are shares per value of a dimension, given or, by default, the
observed shares raised to the power ``FLATTEN`` and scaled to 1, which lifts small sources and
languages. A value without a given target has target 0. The topic is told from the
text: ``markup`` (any of ``|<>{}#``), else ``figures`` (any digit), else
``prose``; callers may pass another expression. Tokens are words.

One pass reduces documents to one small row each (kept in the shared folder)
and these to cells; fitting works on cells only. A round adds weights per value of a
dimension (partial sums, so a value that a third of the cells share is no hot
key) and joins the factors back. Cells are joined back to the small rows, by broadcast if their
measured number allows. Sampling compares a hash of the id with the
probability, so it can be repeated, and repeated ids are kept or left together.

Null source or language: a value of its own, ``(none)``. Null text: no tokens;
documents without tokens follow their cell. A cell without tokens has
probability 0. Very long texts: counted whole, their row is small. Ties: rows of equal draw
are kept or left together. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import broadcast_small, stored, words

FLATTEN = {"source": 0.7, "lang": 0.7, "topic": 1.0}
TOLERANCE = 1e-14
SHARE = 0.5
PLACES = 6
BROADCAST_CELLS = 100_000
DIMENSIONS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.when(text.rlike(r"[|<>{}#]"), "markup").when(text.rlike("[0-9]"), "figures").otherwise("prose")


def uniform(id_: Column) -> Column:
    """A number from 0 to 1, told by the id."""
    key = F.concat(F.lit("mix/"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / float(1 << 48)


def target_shares(cells: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``cells`` plus t_source, t_lang, t_topic: each cell's targets."""
    for d in DIMENSIONS:
        if d in targets:
            total = float(sum(targets[d].values())) or 1.0
            given = cells.sparkSession.createDataFrame(
                [(k, v / total) for k, v in targets[d].items()], f"{d} string, t_{d} double")
            cells = cells.join(F.broadcast(given), d, "left").fillna(0.0, [f"t_{d}"])
            continue
        own = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), FLATTEN[d]).alias("__v"))
        total = own.agg(F.sum("__v")).scalar()
        cells = cells.join(own.select(d, F.try_divide("__v", total).alias(f"t_{d}")), d)
    return cells


def _off(cells: DataFrame) -> float:
    """Largest absolute difference between a value's share of the weight and its target."""
    total = cells.agg(F.sum("weight")).scalar()
    off = [cells.groupBy(d).agg(F.abs(F.try_divide(F.sum("weight"), total) - F.max(f"t_{d}")).alias("o")).select("o")
           for d in DIMENSIONS]
    return off[0].unionByName(off[1]).unionByName(off[2]).agg(F.max("o")).first()[0] or 0.0


def rake(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (with tokens and targets) plus ``weight``; stored once a round."""
    out, before = cells.withColumn("weight", F.col("tokens").cast("double")), float("inf")
    while True:
        for d in DIMENSIONS:
            held = out.groupBy(d).agg(F.try_divide(F.max(f"t_{d}"), F.sum("weight")).alias("__f"))
            out = out.join(held, d).withColumn("weight", F.coalesce(F.col("weight") * F.col("__f"), F.lit(0.0))).drop("__f")
        out = stored(out, "mix-round")
        off = _off(out)
        if off <= tolerance or off >= before * (1 - 1e-3):
            return out
        before = off


def level(fitted: DataFrame, share: float) -> float:
    """c such that the cells' tokens times ``min(1, c * rate)`` add up to ``share`` of all tokens.

    Full cells only become more as c grows, so each step solves for the rest and ends when no further cell is full.
    """
    goal = share * float(fitted.agg(F.sum("tokens")).first()[0] or 0)
    c = 0.0
    while True:
        full = F.col("__rate") * c >= 1
        taken, rest = fitted.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).cast("double"),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("__rate")))).first()
        if not rest or goal <= taken:
            return c if c else 0.0
        now = (goal - taken) / rest
        if now <= c * (1 + 1e-15):
            return c
        c = now


def mixing(df: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, topic: Column | None = None,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
           draw: Column | None = None, share: float = SHARE) -> DataFrame:
    """Per row of ``df``: doc_id, source, lang, topic, n_tokens, probability, sampled. ``draw`` is hashed in place of the id."""
    return plan(df, targets, topic, id_col, text_col, source_col, lang_col, draw, share)[0]


def report(cells: DataFrame) -> DataFrame:
    """Per dimension and value of the planned cells: its target share, the raked share and the sample's expected share."""
    total = cells.agg(F.sum("weight").alias("w"), F.sum(F.col("tokens") * F.col("probability")).alias("e"))
    w, e = total.select("w").scalar(), total.select("e").scalar()
    out = None
    for d in DIMENSIONS:
        part = cells.groupBy(F.col(d).alias("value")).agg(
            F.max(f"t_{d}").alias("target"), F.try_divide(F.sum("weight"), w).alias("raked"),
            F.try_divide(F.sum(F.col("tokens") * F.col("probability")), e).alias("expected"))
        part = part.select(F.lit(d).alias("dimension"), "value", "target", "raked", "expected")
        out = part if out is None else out.unionByName(part)
    return out


def plan(df: DataFrame, targets: Mapping[str, Mapping[str, float]] | None, topic: Column | None, id_col: str, text_col: str,
         source_col: str, lang_col: str, draw: Column | None, share: float) -> tuple[DataFrame, DataFrame]:
    """The sample as ``mixing`` returns it, and the cells with tokens, targets, weight and probability."""
    topic = topic_of(F.col(text_col)) if topic is None else topic
    rows = stored(df.select(
        F.col(id_col).alias("doc_id"), uniform(F.col(id_col) if draw is None else draw).alias("__u"),
        F.coalesce(F.col(source_col), F.lit("(none)")).alias("source"),
        F.coalesce(F.col(lang_col), F.lit("(none)")).alias("lang"), topic.alias("topic"),
        F.size(words(F.col(text_col))).cast("long").alias("n_tokens")), "mix-rows")
    cells = stored(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    fitted = stored(rake(target_shares(cells, targets or {})).withColumn(
        "__rate", F.coalesce(F.try_divide("weight", "tokens"), F.lit(0.0))), "mix-fitted")
    fitted = fitted.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("__rate") * level(fitted, share)), PLACES))
    out = rows.join(broadcast_small(fitted.select(*DIMENSIONS, "probability"), BROADCAST_CELLS), list(DIMENSIONS))
    return out.select("doc_id", *DIMENSIONS, "n_tokens", "probability",
                      (F.col("__u") < F.col("probability")).alias("sampled")), fitted


def oracle(documents: str = "documents", columns: str = "doc_id, source, lang, topic, n_tokens, probability, sampled",
           rounds: int = 40) -> str:
    """DuckDB SQL for ``mixing`` with its default targets and share, for tables that ``rounds`` rounds rake to the end."""
    steps, at = [], "w0"
    for d in DIMENSIONS:
        steps.append(f"m_{d} AS (SELECT {d}, power(CAST(sum(tokens) AS DOUBLE), {FLATTEN[d]}) AS v FROM cells GROUP BY 1)")
        steps.append(f"t_{d} AS (SELECT {d}, v / (SELECT sum(v) FROM m_{d}) AS t FROM m_{d})")
    steps.append("w0 AS (SELECT source, lang, topic, tokens, CAST(tokens AS DOUBLE) AS weight, t_source.t AS t_source, "
                 "t_lang.t AS t_lang, t_topic.t AS t_topic FROM cells JOIN t_source USING (source) "
                 "JOIN t_lang USING (lang) JOIN t_topic USING (topic))")
    for k in range(rounds * len(DIMENSIONS)):
        d = DIMENSIONS[k % len(DIMENSIONS)]
        steps.append(f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (coalesce(weight * t_{d} / nullif(sum(weight) OVER "
                     f"(PARTITION BY {d}), 0), 0) AS weight) FROM {at})")
        at = f"w{k + 1}"
    newline = ",\n"
    return f"""
WITH rows_ AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN regexp_matches(coalesce(text, ''), '[|<>{{}}#]') THEN 'markup'
              WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures' ELSE 'prose' END AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM {documents}),
cells AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM rows_ GROUP BY ALL),
{newline.join(steps)},
rates AS (SELECT source, lang, topic, tokens, coalesce(weight / nullif(tokens, 0), 0) AS rate FROM {at}),
-- with the cells of a rate above this one's taken whole, c is what the others need; the cut is where c fills none of them
above AS (
  SELECT rate, coalesce(sum(full_) OVER w, 0) AS taken, (SELECT sum(tokens * rate) FROM rates) - coalesce(sum(part) OVER w, 0) AS rest
  FROM (SELECT rate, sum(tokens) AS full_, sum(tokens * rate) AS part FROM rates WHERE rate > 0 GROUP BY rate)
  WINDOW w AS (ORDER BY rate DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT coalesce(arg_max(c, rate) FILTER (c * rate <= 1), max(c)) AS c
  FROM (SELECT rate, ({SHARE} * (SELECT sum(tokens) FROM rates) - taken) / rest AS c FROM above)),
fitted AS (SELECT source, lang, topic, round(least(1.0, rate * coalesce((SELECT c FROM level), 0)), {PLACES}) AS probability FROM rates),
mixed AS (
  SELECT doc_id, source, lang, topic, n_tokens, probability,
         CAST(CAST('0x' || substr(md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE)
         / {float(1 << 48)!r} < probability AS sampled
  FROM rows_ JOIN fitted USING (source, lang, topic))
SELECT {columns} FROM mixed"""
