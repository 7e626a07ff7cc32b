"""Preference pairs for chat training. DataFrame operations only.

The turns that a chosen and a rejected conversation share at their start become the prompt, rendered once; what follows
in each becomes a completion in which only the assistant's turns are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read_table

#: a turn as it is rendered, and the role that is trained on: fixed values
OPEN, ROLE_END, CLOSE = "<|", "|>\n", "\n"
TRAINED = "assistant"


def rendered(turn: Column) -> Column:
    """Text of one turn; a null role or text counts as empty."""
    part = lambda c: F.coalesce(turn[c], F.lit(""))
    return F.concat(F.lit(OPEN), part("role"), F.lit(ROLE_END), part("text"), F.lit(CLOSE))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """``pair, prompt, n_prompt, chosen, chosen_mask, rejected, rejected_mask`` of ``pair, side, turn, role, text``.

    ``side`` is 'chosen' or 'rejected'. Turns are compared by number: the prompt ends before the first turn that differs
    in role or text or that one side lacks. ``chosen`` and ``rejected`` are arrays of rendered turns, the masks arrays
    of whether each is trained on. Of repeated rows of a turn the smallest (role, text), null first, counts. A null turn
    number is no turn; a null pair is a pair of its own. A pair that has one side only is left out; of equal
    conversations the prompt is all and both completions are empty. A pair is one row, as it is one example.
    """
    side = lambda s: F.min(F.when(F.col("side") == s, F.struct("role", "text"))).alias(s)
    # a turn of a pair in one row, combined before the shuffle: repeated rows never meet in one place
    both = turns.where(F.col("turn").isNotNull()).groupBy("pair", "turn").agg(side("chosen"), side("rejected"))
    # a differing turn is marked, and the smallest mark is the prompt's end
    split = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "chosen", "rejected")))
    pairs = both.groupBy("pair").agg(
        ordered.alias("t"),
        F.min(F.when(split, F.col("turn"))).alias("cut"),
        F.count("chosen").alias("n_chosen"),
        F.count("rejected").alias("n_rejected"),
    )
    pairs = pairs.where("n_chosen > 0 AND n_rejected > 0")
    common = F.filter("t", lambda x: F.col("cut").isNull() | (x["turn"] < F.col("cut")))

    def rest(s: str) -> Column:
        return F.filter("t", lambda x: F.col("cut").isNotNull() & (x["turn"] >= F.col("cut")) & x[s].isNotNull())

    def texts(s: str) -> Column:
        return F.transform(rest(s), lambda x: rendered(x[s]))

    def mask(s: str) -> Column:
        return F.transform(rest(s), lambda x: F.coalesce(x[s]["role"] == TRAINED, F.lit(False)))

    return pairs.select(
        "pair",
        F.array_join(F.transform(common, lambda x: rendered(x["chosen"])), "").alias("prompt"),
        F.size(common).cast("long").alias("n_prompt"),
        texts("chosen").alias("chosen"),
        mask("chosen").alias("chosen_mask"),
        texts("rejected").alias("rejected"),
        mask("rejected").alias("rejected_mask"),
    )


def with_other_answers(turns: DataFrame, span: int = 20) -> DataFrame:
    """``pair, side, turn, role, text``: each conversation as chosen, and with another's last answer as rejected.

    Of ``conv_id, turn, role, text``. The last assistant's turn of a conversation takes the text of that of the next
    conversation among the ``span`` ids from a multiple of ``span`` on, the last one that of the first; alone there, an
    empty text. A conversation without an assistant's turn is rejected as it is. Of repeated rows of a turn the smallest
    (role, text), null first, counts. A null turn number is no turn; rows with a null id are one conversation.
    """
    rows = turns.where(F.col("turn").isNotNull()).groupBy("conv_id", "turn")
    rows = rows.agg(F.min(F.struct("role", "text")).alias("x")).select("conv_id", "turn", "x.*")
    answers = rows.where(F.col("role") == TRAINED).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("x"))
    # one row for a conversation: at most span rows in a window
    near = Window.partitionBy(F.col("conv_id") - F.pmod("conv_id", F.lit(span))).orderBy("conv_id")
    alone = F.count("*").over(near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == 1
    other = F.coalesce(F.lead("x").over(near), F.first("x").over(near))["text"]
    answers = answers.select(
        F.col("conv_id").alias("of"), F.col("x.turn").alias("last"), F.when(~alone, other).otherwise("").alias("other")
    )
    both = rows.join(answers, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    swapped = F.when(F.col("turn") == F.col("last"), F.col("other")).otherwise(F.col("text"))
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text")), F.struct(F.lit("rejected").alias("side"), swapped.alias("text"))
    )
    return both.select(F.col("conv_id").alias("pair"), "turn", "role", F.inline(sides))


def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, chosen as it is and rejected with the last answer of another."""
    turns = with_other_answers(read_table(spark, sf_dir, "conversations"))
    join = lambda m: F.array_join(F.transform(m, lambda x: x.cast("int").cast("string")), "")
    return preference_pairs(turns).select(
        "pair",
        "prompt",
        "n_prompt",
        F.array_join("chosen", "").alias("chosen"),
        join("chosen_mask").alias("chosen_mask"),
        F.array_join("rejected", "").alias("rejected"),
        join("rejected_mask").alias("rejected_mask"),
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, min({'a': role IS NOT NULL, 'r': role, 'b': text IS NOT NULL, 't': text}) AS x
  FROM conversations WHERE turn IS NOT NULL GROUP BY ALL),
l AS (
  SELECT conv_id, max(turn) AS last, arg_max(x, turn) AS x FROM t WHERE x.r = 'assistant' GROUP BY ALL),
o AS (
  SELECT conv_id, last, CASE WHEN count(*) OVER (PARTITION BY conv_id - (conv_id % 20 + 20) % 20) = 1 THEN ''
    ELSE coalesce(lead(x) OVER w, first(x) OVER w).t END AS other
  FROM l WINDOW w AS (PARTITION BY conv_id - (conv_id % 20 + 20) % 20 ORDER BY conv_id)),
b AS (
  SELECT t.conv_id AS pair, t.turn, t.x AS c,
         CASE WHEN t.turn = o.last THEN {'a': t.x.a, 'r': t.x.r, 'b': o.other IS NOT NULL, 't': o.other}
         ELSE t.x END AS r
  FROM t LEFT JOIN o ON t.conv_id IS NOT DISTINCT FROM o.conv_id),
k AS (
  SELECT pair, min(turn) FILTER (c IS DISTINCT FROM r) AS cut FROM b GROUP BY ALL),
s AS (
  SELECT b.pair, turn, turn < coalesce(cut, turn + 1) AS shared, c, r,
         '<|' || coalesce(c.r, '') || '|>' || chr(10) || coalesce(c.t, '') || chr(10) AS ct,
         '<|' || coalesce(r.r, '') || '|>' || chr(10) || coalesce(r.t, '') || chr(10) AS rt
  FROM b JOIN k ON b.pair IS NOT DISTINCT FROM k.pair)
SELECT pair,
       coalesce(string_agg(ct, '' ORDER BY turn) FILTER (shared), '') AS prompt,
       count(*) FILTER (shared) AS n_prompt,
       coalesce(string_agg(ct, '' ORDER BY turn) FILTER (NOT shared AND c IS NOT NULL), '') AS chosen,
       coalesce(string_agg(CASE WHEN c.r = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY turn)
                FILTER (NOT shared AND c IS NOT NULL), '') AS chosen_mask,
       coalesce(string_agg(rt, '' ORDER BY turn) FILTER (NOT shared AND r IS NOT NULL), '') AS rejected,
       coalesce(string_agg(CASE WHEN r.r = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY turn)
                FILTER (NOT shared AND r IS NOT NULL), '') AS rejected_mask
FROM s GROUP BY pair"""
