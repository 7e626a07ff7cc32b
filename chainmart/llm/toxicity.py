"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A window of words is compressed twice; what the toxic dictionary saves against the ordinary one is the window's
distance. A document's share of windows beyond a threshold is turned into a probability by a monotone fit. Dictionaries
are trained on some labelled rows, threshold and fit are calibrated on others.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import LOWER, Remembered, kept_by_worker, own_columns, read_table, small_batches, utf8

#: remainder of the key's checksum modulo 4: never learnt from; calibrated on; the rest trains
HELD_OUT, CALIBRATE = 2, 3
#: labelled rows of each label for training and for calibration, at most, and their bytes
MAX_ROWS = 4000
MAX_BYTES = 16_384
#: words of a window
WIDTH = 1
#: bytes of a piece of a word with its blanks: inflected and compounded words share the pieces of their stem
PIECE = 8
#: every toxic row trains whole; its words, from a log-likelihood ratio of their best piece on, train so many times more
WEIGHTS = ((10.0, 10), (15.0, 300), (20.0, 300))
#: bytes of these repetitions; beyond, all are repeated less, but at least once
WEIGHTED_BYTES = 12 << 20
TOXIC_DICT, ORDINARY_DICT = 8192, 65536
LEVEL = 19
#: compressed before every window: short windows would else be stored as they are
LEAD = b"0" * 32
#: compressed behind every window: zstandard looks for no match in the last bytes, which is all of a short word
TAIL = b"0" * 16
THRESHOLDS = range(1, 8)
PREDICT_AT = 0.3
#: distances of distinct windows kept by a worker, for its next tasks too: so many, and as many from before them
CACHE = 300_000


def remainder(key: Column) -> Column:
    """Checksum of the key as text, modulo 4; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)).cast("int")


def windows(text: bytes, width: int = WIDTH) -> list[bytes]:
    words = text.translate(LOWER).split()
    return words if width == 1 else [b" ".join(words[i : i + width]) for i in range(0, len(words), width)]


def pieces(window: bytes) -> set[bytes]:
    at = b" " + window + b" "
    return {at[i : i + PIECE] for i in range(max(1, len(at) - PIECE + 1))}


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; raw content where there is too little to train on."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" " * 8


class Distance(Remembered):
    """window -> bytes that the toxic dictionary saves against the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes, level: int = LEVEL, most: int | None = None):
        super().__init__(CACHE if most is None else most)
        options = dict(level=level, write_content_size=False, write_checksum=False, write_dict_id=False)

        def make(content: bytes):
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=level)  # digested once, not for every window
            return zstandard.ZstdCompressor(dict_data=dictionary, **options).compress

        self.toxic, self.ordinary = make(toxic), make(ordinary)

    def make(self, window: bytes) -> int:
        at = LEAD + b" " + window + b" " + TAIL
        return len(self.ordinary(at)) - len(self.toxic(at))


def distances(text: bytes, of: Distance, width: int = WIDTH) -> np.ndarray:
    w = windows(text, width)
    return np.fromiter(map(of.__getitem__, w), np.int32, len(w))


def _share(d: np.ndarray, threshold: int) -> float:
    return float((d >= threshold).mean()) if len(d) else 0.0


def _rank_quality(score: np.ndarray, y: np.ndarray) -> float:
    """Chance that a toxic row is above an ordinary one, ties by half."""
    _, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    p = int(y.sum())
    return (rank[y == 1].sum() - p * (p + 1) / 2) / max(1, p * (len(y) - p))


def _monotone(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Steps of the least-squares non-decreasing fit; each step is shrunk towards the share of all rows."""
    base, blocks = float(y.mean()), []
    values, at = np.unique(x, return_inverse=True)
    for v, s, n in zip(values, np.bincount(at, y), np.bincount(at)):
        blocks.append([float(v), float(s), float(n)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, s2, n2 = blocks.pop()
            blocks[-1][1] += s2
            blocks[-1][2] += n2
    fit = np.maximum.accumulate([(s + base) / (n + 1) for _, s, n in blocks])
    return [b[0] for b in blocks], fit.tolist()


def fit(train: list[tuple[bytes, int]], calibrate: list[tuple[bytes, int]], width: int = WIDTH) -> dict:
    """Dictionaries, threshold and steps. Without both labels the model gives every text the same score."""
    n = Counter(y for _, y in train)
    cut = [(windows(t, width), y) for t, y in train]
    in_row = lambda w: set().union(*map(pieces, set(w)))
    toxic_pieces = Counter(x for w, y in cut if y for x in in_row(w))
    ordinary_pieces = Counter(x for w, y in cut if not y for x in in_row(w) if x in toxic_pieces)
    total = n[0] + n[1]

    def ratio(x: bytes) -> float:
        a, b = toxic_pieces[x], ordinary_pieces[x]
        if not n[0] or not n[1] or a * n[0] <= b * n[1]:
            return 0.0
        e1, e0 = (a + b) * n[1] / total, (a + b) * n[0] / total
        return 2 * (a * math.log(a / e1) + (b * math.log(b / e0) if b else 0.0))

    best_piece = {w: max(map(ratio, pieces(w))) for w in {w for row, y in cut if y for w in row}}
    join = lambda w: b" " + b" ".join(w) + b" "
    weighted = []
    for row in [w for w, y in cut if y]:
        marked = [(join([w for w in row if best_piece[w] >= least]), times) for least, times in WEIGHTS]
        weighted.append((join(row), [(s, times) for s, times in marked if len(s) > 2]))
    less = min(1.0, WEIGHTED_BYTES / max(1, sum(len(s) * times for _, more in weighted for s, times in more)))
    # a row's repetitions stand next to it: the trainer fills the dictionary part by part
    toxic = []
    for whole, more in weighted:
        toxic += [whole] + [s for s, times in more for _ in range(max(1, round(times * less)))]
    model = {
        "toxic": _dictionary(TOXIC_DICT, toxic),
        "ordinary": _dictionary(ORDINARY_DICT, [join(w) for w, y in cut if not y]),
        "width": width,
    }
    # the driver has this besides the rows: it keeps less than a worker, and nothing more of what it trained on
    del cut, toxic_pieces, ordinary_pieces, best_piece, weighted, toxic
    of = Distance(model["toxic"], model["ordinary"], most=CACHE // 4)
    y = np.array([y for _, y in calibrate], np.int64)
    found = [distances(t, of, width) for t, _ in calibrate]
    shares = {t: np.array([_share(d, t) for d in found]) for t in THRESHOLDS}
    if not len(y) or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.0
        return model | {"threshold": THRESHOLDS[-1], "steps": [0.0], "scores": [base]}
    best = max(THRESHOLDS, key=lambda t: (_rank_quality(shares[t], y), t))
    steps, scores = _monotone(shares[best], y)
    return model | {"threshold": best, "steps": steps, "scores": scores}


def fit_on(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES,
) -> dict:
    """The model of a bounded sample of labelled rows: ``max_rows`` for each label and use, none over ``max_bytes``.

    Null keys, labels and texts are passed over; of several labels of a key the largest counts.
    """
    docs = docs.select(F.col(key), F.col(text))
    known = labels.where("toxic IN (0, 1)").groupBy(key).agg(F.max("toxic").alias("_y"))
    parts = {}
    for use, rest in (("train", [0, 1]), ("calibrate", [CALIBRATE])):
        rows = []
        for y in (0, 1):
            # choose keys on the narrow tables, then fetch the texts of the chosen rows alone
            ok = F.octet_length(text).between(1, max_bytes) & remainder(F.col(key)).isin(rest)
            narrow = docs.where(ok).select(key, F.crc32(F.col(text).cast("binary")).alias("_c"))
            some = narrow.join(known.where(F.col("_y") == y), key)
            some = some.orderBy(F.xxhash64(key), key, "_c").limit(max_rows).select(key).distinct()
            got = docs.where(ok).join(F.broadcast(some), key).select(text).orderBy(F.xxhash64(text), text)
            rows += [(r[0].encode(), y) for r in got.limit(max_rows).collect()]
        parts[use] = rows
    # ordinary and toxic rows were drawn apart: weigh the scores by the labels' shares
    share = known.where(remainder(F.col(key)) == CALIBRATE).agg(F.avg("_y")).first()[0]
    model = fit(parts["train"], parts["calibrate"])
    drawn = np.mean([y for _, y in parts["calibrate"]]) if parts["calibrate"] else None
    if share and drawn and 0 < share < 1 and 0 < drawn < 1:
        odds = share / (1 - share) * (1 - drawn) / drawn
        model["scores"] = [p * odds / (p * odds + 1 - p) for p in model["scores"]]
    return model


def score(docs: DataFrame, model: dict, text: str = "text", into: str = "score") -> DataFrame:
    """Add the score of every row, 0 to 1; a null text is empty, and an empty text has no window beyond the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries and a few steps

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        name = f"distance-{zlib.crc32(m['toxic'])}-{zlib.crc32(m['ordinary'])}-{len(m['toxic'])}-{len(m['ordinary'])}"
        of = kept_by_worker(name, lambda: Distance(m["toxic"], m["ordinary"]))
        steps, values = np.array(m["steps"]), np.array(m["scores"])
        for texts in batches:
            found = utf8(pa.array(texts, pa.string(), from_pandas=True))
            s = np.array([_share(distances(t, of, m["width"]), m["threshold"]) for t in found])
            yield pd.Series(values[np.maximum(0, np.searchsorted(steps, s, "right") - 1)] if len(s) else s)

    return small_batches(docs).withColumn(into, scores(F.col(text).cast("string")))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted to be toxic."""
    model = fit_on(docs, labels, key, text)
    rows = docs.select(F.struct(*docs.columns).alias("own"), F.col(text).alias("text"))
    return own_columns(score(rows, model).where(F.col("score") < PREDICT_AT), docs)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit_on(docs, read_table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id",
        (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
