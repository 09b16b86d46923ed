"""Chat formatting: conversations logged again and again as they grow are reduced to their last state.

Each turn gets a hash of the conversation up to there. A conversation whose hash is that of another
one's beginning is a snapshot of it and goes; of equal ones the smallest id stays. What is left is
rendered. All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"  # fixed values: the common chat mark-up


def _marked(name: str) -> list[Column]:
    """A column so that null and empty differ."""
    return [F.col(name).isNull(), F.col(name)]


def prefixed_turns(turns: DataFrame) -> DataFrame:
    """Distinct turns with ``_pos`` (1 on), ``_h1`` and ``_h2`` (hash up to here) and ``_last``.

    The hash is the exclusive or of the hashes of (place, role, text) so far; the place makes it
    depend on the order. Two seeds give 128 bits.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumns({
        "_pos": F.row_number().over(order),
        "_last": F.lead(F.lit(False), 1, True).over(order),
    })
    hashed = placed.withColumns({
        f"_t{k}": F.xxhash64(F.lit(k), "_pos", *_marked("role"), *_marked("text"))
        for k in (1, 2)
    })
    return hashed.withColumns({
        f"_h{k}": F.bit_xor(f"_t{k}").over(upto) for k in (1, 2)
    }).drop("_t1", "_t2")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``n_turns`` of the conversations that begin no other one."""
    hashed = prefixed_turns(turns)
    whole = hashed.filter("_last").groupBy("_h1", "_h2").agg(
        F.min(F.struct("conv_id", F.col("_pos").alias("n_turns"))).alias("_c"))
    begun = hashed.filter("not _last").select("_h1", "_h2").distinct()
    return whole.join(begun, ["_h1", "_h2"], "left_anti").select("_c.*")


def chat_format(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation: ``conv_id``, ``n_turns``, ``rendered``.

    Needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not used. A turn that is
    logged twice, alike in all four, counts once; turns with one number and different words all
    stay, ordered by role and text, nulls first. Rows with a null id form one conversation. A null
    role is rendered as ``user``, a null text as empty, though either differs from that value when
    conversations are compared. No rows in, no rows out.
    """
    kept = maximal_conversations(turns)
    piece = F.concat(
        F.lit(START), F.coalesce("role", F.lit("user")), F.lit("\n"),
        F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    rendered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct(*[f(c) for c in ("turn", "role", "text")
                   for f in (lambda c: F.col(c).isNotNull().alias(f"_has_{c}"),
                             lambda c: F.col(c))], piece.alias("_p")))).alias("_t"))
    joined = kept.withColumnRenamed("conv_id", "_id").join(
        rendered, F.col("_id").eqNullSafe(F.col("conv_id")))
    return joined.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_t", lambda t: t["_p"]), "").alias("rendered"))


# The same by comparing whole beginnings as strings.
ORACLE_SQL = f"""WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (
  SELECT conv_id, turn,
    string_agg('{START}' || role || chr(10) || text || '{END}' || chr(10), ''
      ORDER BY turn, role, text) OVER (PARTITION BY conv_id ORDER BY turn, role, text
      ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM t),
whole AS (
  SELECT min(conv_id) AS conv_id, upto, n FROM p WHERE pos = n GROUP BY upto, n)
SELECT conv_id, n AS n_turns, upto AS rendered FROM whole w
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.upto = w.upto)"""
