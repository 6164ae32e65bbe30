"""Preference formatting: one shared prompt and two masked completions per pair of conversations.

The prompt is the longest common prefix of turns (role and text equal) of the
chosen and the rejected conversation, rendered once; what follows in either is
rendered as its completion. A completion's mask lists the code-point ranges
(start, end exclusive, counted in the completion) of the assistant's texts: only these are
to be learned; role marks, end marks and other speakers' turns are not.

``branch_pairs`` makes pairs from a table of conversations, in the order of their ids: the
first with the second, the third with the fourth, each being chosen once and giving the other its
rejected branch; one left over takes the first one's branch. A conversation counts up to its last assistant turn
(whole if it has none). It branches at a depth told by a hash of its id: rejected begins with its
turns before the depth and goes on with the other's turns from there, or with the other's last
turn if that is shorter. The two may well agree beyond the depth; the formatter finds out.

Turns are put together per conversation, the unit that is rendered, ordered by
turn, then role and text where a turn number is repeated. Null role: ``user``.
Null text: empty. Null conversation id: no pair. Equal conversations, or one alone:
both completions and masks are empty. Very long texts: rendered whole, a pair is one row. Empty
table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import stored
from haulstat.operators.order import ordered_rank

# The rendering of a turn.
OPEN, CLOSE, END = "<|", "|>\n", "\n<|end|>\n"


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def mask(turns: Column) -> Column:
    """Ranges of the assistant's texts in the rendered turns."""
    empty = F.expr("cast(array() AS array<struct<start: int, stop: int>>)")

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.lit(len(OPEN) + len(CLOSE)) + F.length(t["role"])
        stop = start + F.length(t["text"])
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(F.struct(
            start.alias("start"), stop.alias("stop"))))).otherwise(state["spans"])
        return F.struct((stop + len(END)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)["spans"]


def preference_format(pairs: DataFrame, id_col: str = "pair_id", chosen_col: str = "chosen",
                      rejected_col: str = "rejected") -> DataFrame:
    """Per pair of turn arrays (role, text): prompt, n_prompt_turns, chosen, rejected and their masks.

    A null array counts as an empty conversation.
    """
    none = F.expr("cast(array() AS array<struct<role: string, text: string>>)")
    rows = pairs.select(F.col(id_col).alias("pair_id"), F.coalesce(chosen_col, none).alias("__c"),
                        F.coalesce(rejected_col, none).alias("__r"))
    shorter = F.least(F.size("__c"), F.size("__r"))
    same = F.zip_with(F.slice("__c", F.lit(1), shorter), F.slice("__r", F.lit(1), shorter), lambda a, b: a.eqNullSafe(b))
    rows = rows.withColumn("__same", same)  # a column, so that the search reads it once per row
    first_other = F.array_position("__same", F.lit(False))
    rows = rows.withColumn("__n", F.when(first_other > 0, first_other - 1).otherwise(shorter).cast("int")).drop("__same")
    after = {c: F.slice(c, F.col("__n") + 1, F.size(c)) for c in ("__c", "__r")}
    return rows.select(
        "pair_id", rendered(F.slice("__c", F.lit(1), F.col("__n"))).alias("prompt"), F.col("__n").alias("n_prompt_turns"),
        rendered(after["__c"]).alias("chosen"), mask(after["__c"]).alias("chosen_mask"),
        rendered(after["__r"]).alias("rejected"), mask(after["__r"]).alias("rejected_mask"))


def neighbours(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``pair_id`` and ``other`` of every conversation: two and two in the order of ids; one left over has the first."""
    ids = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("pair_id")).distinct()
    at = ordered_rank(stored(ids, "conversations"), ["pair_id"])
    two = at.groupBy(F.floor((F.col("rank") - 1) / 2).alias("g")).agg(F.min("pair_id").alias("a"), F.max("pair_id").alias("b"))
    first = ids.agg(F.min("pair_id")).scalar()
    both = two.select(F.explode(F.array(F.struct(F.col("a").alias("pair_id"), F.col("b").alias("other")),
                                        F.struct(F.col("b").alias("pair_id"), F.col("a").alias("other")))).alias("x"),
                      (F.col("a") == F.col("b")).alias("alone"))
    return both.select("x.pair_id", F.when(F.col("alone"), first).otherwise(F.col("x.other")).alias("other")).distinct()


def depth_of(id_: Column, n: Column) -> Column:
    """Turns before the branch, 0 to n - 1, told by the id."""
    return F.pmod(F.conv(F.substring(F.md5(id_.cast("string")), 1, 8), 16, 10).cast("long"), n.cast("long")).cast("int")


def branch_pairs(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """pair_id, chosen, rejected of every conversation."""
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("pair_id"), F.struct(
            F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("user")).alias("role"),
            F.coalesce(text_col, F.lit("")).alias("text")).alias("t"))
    conv = rows.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    conv = conv.select("pair_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("t"))
    back = F.array_position(F.transform(F.reverse("t"), lambda x: x["role"]), "assistant")  # 0: none
    last = F.when(back > 0, F.size("t") - back + 1).otherwise(F.size("t")).cast("int")
    conv = conv.withColumn("t", F.slice("t", F.lit(1), last))
    mine = conv.join(neighbours(turns, conv_col), "pair_id")
    theirs = conv.select(F.col("pair_id").alias("other"), F.col("t").alias("__o"))
    depth = depth_of(F.col("pair_id"), F.size("t"))
    both = mine.join(theirs, "other").withColumn("__d", depth)
    branch = F.when(F.size("__o") > F.col("__d"), F.slice("__o", F.col("__d") + 1, F.size("__o"))).otherwise(F.slice("__o", -1, 1))
    return both.select("pair_id", F.col("t").alias("chosen"),
                       F.concat(F.slice("t", F.lit(1), F.col("__d")), branch).alias("rejected"))


def preferences(turns: DataFrame) -> DataFrame:
    """Formatted pairs, the masks as ``start:stop`` lists."""
    def joined(c: str) -> Column:
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["stop"])), ",").alias(c)

    return preference_format(branch_pairs(turns)).select(
        "pair_id", "prompt", "n_prompt_turns", "chosen", joined("chosen_mask"), "rejected", joined("rejected_mask"))


def oracle(conversations: str = "conversations") -> str:
    """DuckDB SQL for ``preferences``: pairs from row numbers, the prefix by comparing turn after turn."""
    fixed = len(OPEN) + len(CLOSE)
    nl = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"
    return f"""
WITH t AS (
  SELECT conv_id AS pair_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, 'user'), coalesce(text, '')) AS k
  FROM {conversations} WHERE conv_id IS NOT NULL),
ends AS (SELECT pair_id, coalesce(max(k) FILTER (WHERE role = 'assistant'), max(k)) AS last FROM t GROUP BY 1),
cut AS (SELECT t.*, last FROM t JOIN ends USING (pair_id) WHERE k <= last),
ranked AS (SELECT pair_id, last, row_number() OVER (ORDER BY pair_id) AS r, count(*) OVER () AS n,
                  CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 8) AS BIGINT) % last AS d FROM ends),
pairs AS (
  SELECT m.pair_id, m.last, m.d, o.pair_id AS other, o.last AS other_last
  FROM ranked m JOIN ranked o ON o.r = CASE WHEN m.r % 2 = 0 THEN m.r - 1 WHEN m.r < m.n THEN m.r + 1 ELSE 1 END),
sides AS (
  SELECT p.pair_id, 'c' AS side, c.k, c.role, c.text FROM pairs p JOIN cut c ON c.pair_id = p.pair_id
  UNION ALL
  SELECT p.pair_id, 'r', c.k, c.role, c.text FROM pairs p JOIN cut c ON c.pair_id = p.pair_id AND c.k <= p.d
  UNION ALL
  SELECT p.pair_id, 'r', CASE WHEN p.other_last > p.d THEN c.k ELSE p.d + 1 END, c.role, c.text
  FROM pairs p JOIN cut c ON c.pair_id = p.other AND c.k > least(p.d, p.other_last - 1)),
sizes AS (SELECT pair_id, max(k) FILTER (WHERE side = 'c') AS nc, max(k) FILTER (WHERE side = 'r') AS nr FROM sides GROUP BY 1),
differ AS (SELECT c.pair_id, min(c.k) AS k FROM sides c JOIN sides r ON r.pair_id = c.pair_id AND r.k = c.k
           WHERE c.side = 'c' AND r.side = 'r' AND (c.role <> r.role OR c.text <> r.text) GROUP BY 1),
common AS (SELECT pair_id, coalesce(k - 1, least(nc, nr)) AS n FROM sizes LEFT JOIN differ USING (pair_id)),
shown AS (SELECT s.*, n, {nl(OPEN)} || role || {nl(CLOSE)} || text || {nl(END)} AS shown FROM sides s JOIN common USING (pair_id)),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN k > n THEN length(shown) END) OVER w, 0) + {fixed} + length(role) AS begins
  FROM shown WINDOW w AS (PARTITION BY pair_id, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
told AS (
  SELECT pair_id, side, any_value(n) AS n, coalesce(string_agg(CASE WHEN k <= n THEN shown END, '' ORDER BY k), '') AS prompt,
         coalesce(string_agg(CASE WHEN k > n THEN shown END, '' ORDER BY k), '') AS rest,
         coalesce(string_agg(CASE WHEN k > n AND role = 'assistant' THEN CAST(begins AS BIGINT) || ':' || CAST(begins + length(text) AS BIGINT) END,
                  ',' ORDER BY k), '') AS mask
  FROM placed GROUP BY 1, 2)
SELECT c.pair_id, c.prompt, CAST(c.n AS INTEGER) AS n_prompt_turns, c.rest AS chosen, c.mask AS chosen_mask,
       r.rest AS rejected, r.mask AS rejected_mask
FROM told c JOIN told r ON r.pair_id = c.pair_id AND c.side = 'c' AND r.side = 'r'"""
