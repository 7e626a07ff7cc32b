"""Quality rules with risk-controlled thresholds.

Each signal of a document is compared with a cutoff. Cutoffs are chosen for every stratum from labelled documents: among
a fixed list, from the loosest on, the strictest one for which an exact binomial test shows that at most the allowed
share of good documents is rejected. Going from loose to strict and stopping at the first failure tests in a fixed
order, so cutoffs need no correction among themselves; the strata and signals share the error by Bonferroni. Signals
share the allowed risk too, so that a stratum's false rejections stay below ``risk`` for all signals together, with
probability ``1 - error`` for all strata at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import own_columns, read_table, small_batches, stored, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
LOUD = bytes(range(65, 91)) + b"!"
#: words of a window that counts as repeated
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: share of good documents of a stratum that may be rejected, and the chance that any stratum has more
RISK = 0.05
ERROR = 0.05
#: cutoffs from loose to strict: a document is rejected if its signal is above; fixed before any label is seen
GRID = tuple(round(0.8**k, 4) for k in range(1, 22))
SIGNALS = ("symbol_share", "loud_share", "dup_line_share", "repeat_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_loud", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found at least twice in the list, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # ranks of ever longer windows: a window is the pair of a shorter one and the next word, never a hash
    rank = ids
    for k in range(1, window):
        pair = rank[:-1] * len(number) + ids[k:]
        _, rank, times = np.unique(pair, return_inverse=True, return_counts=True)
        if times.max() < 2:
            return 0
    step = np.zeros(len(words) + 1, np.int64)
    found = np.flatnonzero(times[rank] > 1)
    step[found] += 1
    step[found + window] -= 1
    return int((np.cumsum(step) > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, SPACES).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(text) - len(text.translate(None, LOUD)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def with_counts(docs: DataFrame, text: str = "text", into: str = "_q") -> DataFrame:
    """Add a struct of ``COUNTS``; a null text counts as empty."""

    @F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
    def count(texts: pd.Series) -> pd.DataFrame:
        rows = [counts_of(t) for t in utf8(pa.array(texts, pa.string(), from_pandas=True))]
        return pd.DataFrame(rows, columns=list(COUNTS), dtype="int64")

    # a filter on the counts must not be moved below them: it would count every text once more
    count = count.asNondeterministic()
    return small_batches(docs).withColumn(into, count(F.col(text).cast("string")))


def signal(name: str, q: str = "_q") -> Column:
    """A share between 0 and 1; 0 for a text without words."""
    over, of = {
        "symbol_share": ("n_symbols", "word_chars"),
        "loud_share": ("n_loud", "word_chars"),
        "dup_line_share": ("n_dup_lines", "n_lines"),
        "repeat_share": ("n_repeat_words", "n_words"),
    }[name]
    return F.coalesce(F.try_divide(F.col(f"{q}.{over}"), F.col(f"{q}.{of}")), F.lit(0.0))


def base_failed(q: str = "_q") -> Column:
    words, repeated = F.col(f"{q}.n_words"), F.col(f"{q}.n_repeat_words")
    return (words < MIN_WORDS) | (repeated * 100 > words * MAX_REPEAT_PERCENT)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for n draws of chance p, exact in floating point; 1 where k is not below the mean."""
    if n <= 0 or k >= n * p:
        return 1.0
    i = np.arange(1, k + 1, dtype=np.float64)
    logs = np.concatenate(([0.0], np.cumsum(np.log(n - i + 1) - np.log(i) + np.log(p) - np.log1p(-p))))
    logs += n * np.log1p(-p)
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def cutoffs(
    counted: DataFrame, labels: DataFrame, key: str, stratum: str, risk: float = RISK, error: float = ERROR, q: str = "_q"
) -> DataFrame:
    """``_stratum, signal, cutoff``: the strictest proven cutoff of each; no row where none is proven.

    ``labels`` has ``key, quality``; of several labels of a key the largest counts, null labels and keys count for
    nothing. Good documents that fail the base rules are no evidence: the rules here do not judge them.
    """
    good = labels.groupBy(key).agg(F.max("quality").alias("_good")).where("_good = 1").select(key)
    holdout = counted.where(~base_failed(q)).select(
        key, F.coalesce(F.col(stratum), F.lit("")).alias("_stratum"), *[signal(s, q).alias(s) for s in SIGNALS]
    )
    rejected = [
        F.sum(F.when(F.col(s) > c, 1).otherwise(0)).alias(f"{s}_{i}") for s in SIGNALS for i, c in enumerate(GRID)
    ]
    totals = stored(holdout.join(good, key).groupBy("_stratum").agg(F.count("*").alias("n"), *rejected), "holdout")
    tests = max(1, totals.count() * len(SIGNALS))  # one row for each stratum
    cells = totals.select(
        "_stratum",
        "n",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("signal"), F.lit(c).alias("cutoff"), F.col(f"{s}_{i}").alias("k"))
                    for s in SIGNALS
                    for i, c in enumerate(GRID)
                ]
            )
        ).alias("c"),
    ).select("_stratum", "n", "c.*")

    @F.pandas_udf("double")
    def tail(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), risk / len(SIGNALS)) for a, b in zip(k, n)])

    passed = cells.where(tail("k", "n") <= error / tests)
    # counts only grow along the list, so all cutoffs looser than a proven one are proven
    return passed.groupBy("_stratum", "signal").agg(F.min("cutoff").alias("cutoff"))


def judge(counted: DataFrame, chosen: DataFrame, stratum: str, q: str = "_q") -> DataFrame:
    """Add ``base_failed`` and ``kept``."""
    wide = chosen.groupBy("_stratum").agg(
        *[F.min(F.when(F.col("signal") == s, F.col("cutoff"))).alias(f"_{s}") for s in SIGNALS]
    )
    out = counted.withColumn("_stratum", F.coalesce(F.col(stratum), F.lit(""))).join(wide, "_stratum", "left")
    bad = F.lit(False)
    for s in SIGNALS:
        bad = bad | F.coalesce(signal(s, q) > F.col(f"_{s}"), F.lit(False))
    out = out.withColumn("base_failed", base_failed(q)).withColumn("kept", ~F.col("base_failed") & ~bad)
    return out.drop("_stratum", *[f"_{s}" for s in SIGNALS])


def quality_rules(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
    risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """``key``, ``COUNTS``, ``base_failed`` and ``kept`` of every row.

    A null text is empty and fails the base rules; null strata form one; rows with a null key are judged like others;
    repeated rows keep their number. Without labels no cutoff is proven and the base rules alone decide.
    """
    counted = stored(with_counts(docs.select(F.col(key), F.col(text), F.col(stratum)), text).drop(text), "quality")
    out = judge(counted, stored(cutoffs(counted, labels, key, stratum, risk, error), "cutoffs"), stratum)
    return out.select(key, "_q.*", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang"):
    """The rows of ``docs``, all columns, that the rules keep."""
    rows = docs.select(
        F.col(key).alias("key"), F.col(stratum).alias("stratum"), F.col(text).alias("text"), F.struct(*docs.columns).alias("own")
    )
    # counted once and stored with their rows: labels meet keys and counts, and no text is shuffled at any size
    counted = stored(with_counts(rows).drop("text"), "counted")
    labels = labels.select(F.col(key).alias("key"), "quality")
    chosen = stored(cutoffs(counted.select("key", "stratum", "_q"), labels, "key", "stratum"), "cutoffs")
    return own_columns(judge(counted, chosen, "stratum").where("kept"), docs)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    out = quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
