"""Benchmark decontamination with an FM-index for each shard of the training texts.

A task takes its documents shard by shard. Words that no benchmark item has cannot be part of a phrase, so they only
end runs of words that have; runs shorter than the shortest phrase are left out of the index. Over the rest a suffix
order is built, its Burrows-Wheeler transform is kept as a wavelet tree, all phrases are searched backwards side by
side, and their occurrences are located through sampled suffix positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import numbered_rows, own_columns, read_table, small_batches, stored, utf8

#: words of a window of an item
WINDOW = 10
#: bytes of text of a shard; a longer text is a shard of its own
SHARD_BYTES = 8 << 20
#: every so many positions a suffix keeps its place
SAMPLE = 16
#: bytes of benchmark text sent to the tasks at once; a larger benchmark is searched in several passes
MAX_SENT = 64 << 20

#: ASCII letters in lower case, digits and all bytes beyond ASCII; the rest parts words
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Phrases:
    """Distinct windows of a benchmark as rows of word numbers, padded at the front, and the items that have them."""

    number: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[tuple]

    @classmethod
    def of(cls, items: list[tuple[object, bytes]], window: int = WINDOW) -> "Phrases":
        number: dict[bytes, int] = {}
        found: dict[tuple, dict] = {}
        for item, text in items:
            w = [number.setdefault(x, len(number) + 1) for x in words_of(text)]
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[i : i + window]), {})[item] = None
        rows = np.zeros((len(found), window), np.int64)
        for r, w in zip(rows, found):
            r[window - len(w) :] = w
        return cls(number, rows, (rows > 0).sum(1), [tuple(x) for x in found.values()])


class WaveletTree:
    """Ranks and symbols of a sequence, level by level from the highest bit."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.n, self.levels = len(symbols), []
        s = symbols
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (s >> shift & 1).astype(bool)
            packed = np.packbits(np.concatenate((bit, np.zeros(64 + -len(bit) % 64, bool))), bitorder="little")
            packed = packed.view("<u8")
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            self.levels.append((shift, packed, ones, self.n - int(bit.sum())))
            s = np.concatenate((s[~bit], s[bit]))

    @staticmethod
    def _ones(packed: np.ndarray, ones: np.ndarray, i: np.ndarray) -> np.ndarray:
        word, below = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return ones[word] + np.bitwise_count(packed[word] & below)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position ``i``."""
        start = np.zeros_like(i)
        for shift, packed, ones, zeros in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            a, b = self._ones(packed, ones, start), self._ones(packed, ones, i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return i - start

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and how often it stands before."""
        start, symbol = np.zeros_like(i), np.zeros_like(i)
        for shift, packed, ones, zeros in self.levels:
            one = (packed[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            symbol |= one.astype(np.int64) << shift
            a, b = self._ones(packed, ones, start), self._ones(packed, ones, i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return symbol, i - start


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. Each 0 is a separator of its own, smaller than the ones after it."""
    n, parts = len(s), int((s == 0).sum())
    key = np.where(s == 0, np.cumsum(s == 0) - 1, s + parts)
    h = 1
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate(([False], sorted_key[1:] != sorted_key[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[:-h] += rank[h:] + 1
        h *= 2


class FMIndex:
    """Over a sequence of positive symbols and separators 0, which ends with a separator."""

    def __init__(self, s: np.ndarray, top: int, sample: int = SAMPLE):
        order = suffix_order(s)
        before = s[order - 1]
        self.n, self.tree = len(s), WaveletTree(before, top)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=top + 1))))
        # suffixes at the start of a run have no symbol to walk back to
        self.kept = (order % sample == 0) | (before == 0)
        self.row = np.cumsum(self.kept) - 1
        self.place = order[self.kept]

    def search(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase, empty if none does."""
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        live = np.arange(len(rows))
        for back in range(1, rows.shape[1] + 1):
            live = live[(lengths[live] >= back) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = rows[live, -back]
            lo[live], hi[live] = (self.first[c] + self.tree.rank(c, x[live]) for x in (lo, hi))
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at ranks ``at``."""
        out, steps, open_ = np.empty(len(at), np.int64), 0, np.arange(len(at))
        while len(open_):
            done = self.kept[at]
            out[open_[done]] = self.place[self.row[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            c, before = self.tree.symbol_and_rank(at)
            at = self.first[c] + before
            steps += 1
        return out


def search_shard(texts: list[bytes], phrases: Phrases):
    """For each text: words, merged spans ``(start, end)`` of words to remove, items found."""
    get = phrases.number.get
    found = [[get(w, 0) for w in words_of(t)] for t in texts]
    counts = np.array([len(f) for f in found], np.int64)
    out = [(int(n), [], []) for n in counts]
    if not len(phrases.rows):
        return out
    # a 0 behind each text keeps runs apart
    flat = np.fromiter((x for f in found for x in (*f, 0)), np.int64, int(counts.sum()) + len(texts))
    starts = np.cumsum(counts + 1) - (counts + 1)
    known = np.concatenate(([0], (flat > 0).view(np.int8), [0]))
    begin, end = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
    long = end - begin >= phrases.lengths.min()
    begin, size = begin[long], (end - begin)[long] + 1  # with the 0 behind
    if not len(begin):
        return out
    origin = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    index = FMIndex(flat[origin], len(phrases.number))
    lo, hi = index.search(phrases.rows, phrases.lengths)
    times = np.maximum(0, hi - lo)
    which = np.repeat(np.arange(len(times)), times)
    at = origin[index.locate(np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(int(times.sum())))]
    cover = np.zeros(len(flat) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    inside = np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).view(np.int8), [0]))
    text_of = np.searchsorted(starts, at, "right") - 1
    for d, w in np.unique(np.stack((text_of, which)), axis=1).T.tolist():
        out[d][2].extend(phrases.items[w])
    edges = zip(np.flatnonzero(np.diff(inside) == 1).tolist(), np.flatnonzero(np.diff(inside) == -1).tolist())
    for a, b in edges:
        d = int(np.searchsorted(starts, a, "right")) - 1
        out[d][1].append((a - int(starts[d]), b - int(starts[d])))
    return [(n, spans, list(dict.fromkeys(items))) for n, spans, items in out]


def _pass(docs: DataFrame, key: str, text: str, items: list, item_type: T.DataType, window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField(
                "spans",
                T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
            ),
            T.StructField("items", T.ArrayType(item_type)),
        ]
    )
    item_arrow = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}.get(item_type, pa.string())

    def shards(batches):
        keys, texts, size = [], [], 0
        for batch in batches:
            begun = 0
            for i, t in enumerate(utf8(batch.column(1)), 1):
                texts.append(t)
                size += len(t)
                if size >= SHARD_BYTES or i == batch.num_rows:
                    keys.append(batch.column(0).slice(begun, i - begun))
                    begun = i
                if size >= SHARD_BYTES:
                    yield pa.concat_arrays(keys), texts
                    keys, texts, size = [], [], 0
        if texts:
            yield pa.concat_arrays(keys), texts

    def run(batches):
        phrases = Phrases.of(sent.value, window)
        for keys, texts in shards(batches):
            rows = search_shard(texts, phrases)
            spans = [[{"start": a, "end": b} for a, b in s] for _, s, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([sum(b - a for a, b in s) for _, s, _ in rows], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([x for _, _, x in rows], pa.list_(item_arrow)),
                ],
                [key, "n_words", "n_hit", "spans", "items"],
            )

    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    window: int = WINDOW, max_sent: int = MAX_SENT,
) -> DataFrame:
    """``key, n_words, n_hit, spans, items`` of every row of ``docs``.

    ``spans`` are merged ranges of words inside occurrences, ``items`` the items that occur. Null texts have no words;
    null items and items without words match nothing; repeated rows keep their number, null keys stay. Occurrences are
    never capped. A benchmark over ``max_sent`` bytes goes to the tasks in parts, one pass over ``docs`` for each, and
    the parts' findings are merged.
    """
    wanted = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(item, text).distinct()
    size = wanted.agg(F.sum(F.octet_length(text) + 64)).first()[0] or 0
    parts = -(-size // (max_sent // 2)) or 1  # parts are dealt by hash: half the bound leaves room
    if wanted.schema[item].dataType not in (T.LongType(), T.IntegerType()):
        wanted = wanted.withColumn(item, F.col(item).cast("string"))
    kind = wanted.schema[item].dataType
    found = []
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if parts > 1:
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    for k in range(parts):
        part = wanted if parts == 1 else wanted.where(F.pmod(F.xxhash64(item, text), F.lit(parts)) == k)
        items = [(r[0], r[1].encode()) for r in part.collect()]
        found.append(_pass(rows, "key" if parts == 1 else "row", "text", items, kind, window))
    out = found[0] if parts == 1 else _merged(found, rows.select("row", "key"))
    return out.withColumnRenamed("key", key)


def _merged(found: list[DataFrame], keys: DataFrame) -> DataFrame:
    """Findings of several parts of a benchmark, one row for each row of ``keys``."""
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    zero = F.expr("cast(array() AS array<struct<start:bigint,end:bigint>>)")

    def add(done, s):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"])
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
            F.concat(done, F.array(s))
        )

    merged = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.aggregate(F.array_sort(F.flatten(F.collect_list("spans"))), zero, add).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return keys.join(merged, "row").select("key", "n_words", hit.alias("n_hit"), "spans", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of the benchmark occurs."""
    # written once: another scan may be cut otherwise, and would number the rows otherwise
    rows = stored(numbered_rows(docs), "numbered")
    found = contamination(rows.select("row", F.col("own")[text].alias("text")), benchmark, "row", "text")
    bad = stored(found.where("n_hit > 0").select("row"), "contaminated")
    return own_columns(rows.join(bad, "row", "left_anti"), docs)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside benchmark passages, and the items found, of every document."""
    out = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
