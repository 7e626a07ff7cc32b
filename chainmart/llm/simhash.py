"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified bit distance, connected components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import LOWER, read_table, small_batches, stored, utf8

BITS = 64
SEED = 42
#: fingerprints that share a key and are compared in one task; larger groups are dealt out in tiles
TILE = 20_000
#: blocks of a key. Of ``distance + MATCHED`` blocks two near fingerprints agree on so many at least: at a distance of 4
#: each has 15 keys of 21 bits, so that 10**10 fingerprints make groups of some 5,000
MATCHED = 2


def simhash(text: bytes, shingle: int = 4) -> int:
    """Bit j is set if it is set in over half the hashes of the text's word shingles; 0 without words."""
    words = text.translate(LOWER).split()
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        part = [hashed(line[a:b], SEED) for a, b in zip(starts[at : at + 65536], ends[at : at + 65536])]
        octets = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``key, fp``: the fingerprint of every row as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([simhash(t, shingle) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["key", "fp"])

    schema = docs.select(F.col(key).alias("key"), F.lit(0).cast("long").alias("fp")).schema
    return small_batches(docs).select(F.col(key), F.col(text)).mapInArrow(run, schema)


def block_keys(n_blocks: int, matched: int):
    """Long keys of a fingerprint ``fp``: one for each choice of ``matched`` of the blocks, which it fixes."""
    cut = [BITS * i // n_blocks for i in range(n_blocks + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(n_blocks), matched)):
        key = F.lit(k).cast("long")
        for i in chosen:
            width = cut[i + 1] - cut[i]
            part = F.shiftrightunsigned("fp", cut[i]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def stars(fps: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[int]]:
    """Components of a group of distinct fingerprints: the members of each beside its root, the smallest.

    A breadth-first search that compares only with what has not been reached: the members of a dense group are
    reached in a few steps, so their pairs are never listed.
    """
    left = np.sort(fps)
    members, roots = [], []
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        found = []
        while len(front) and len(left):
            reached = []
            for at in range(0, len(front), max(1, (1 << 22) // len(left))):
                part = front[at : at + max(1, (1 << 22) // len(left))]
                near = (np.bitwise_count(part[:, None] ^ left) <= distance).any(0)
                if near.any():
                    reached.append(left[near])
                    left = left[~near]
                    if not len(left):
                        break
            front = np.concatenate(reached) if reached else left[:0]
            found += reached
        if found:
            members.append(np.concatenate(found))
            roots.append(root)
    return members, roots


def _edges(distance: int):
    """Over rows sorted by (key, a, b): edges of the spanning stars of each group."""

    def link(fps, runs, out):
        for s, e in runs:
            members, roots = stars(fps[s:e], distance)
            for m, r in zip(members, roots):
                out.append((m, np.full(len(m), r, np.uint64)))

    def run(batches):
        held = []  # columns of the last group so far
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            last = new[-1] if len(new) else 0
            held = [c[last:] for c in cols]
            yield from flush(cols[3][:last], np.concatenate(([0], new)) if last else new)
        if held and len(held[3]):
            yield from flush(held[3], np.array([0, len(held[3])]))

    def flush(fps, bounds):
        if len(bounds) < 2:
            return
        size = np.diff(bounds)
        many = np.flatnonzero(size > 1)
        out = []
        link(fps.view(np.uint64), zip(bounds[many].tolist(), bounds[many + 1].tolist()), out)
        if out:
            u, v = (np.concatenate(x).view(np.int64) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def near_links(fps: DataFrame, distance: int, tile: int = TILE) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints that join whatever is linked by at most ``distance`` bits.

    Fingerprints that agree on enough blocks meet in a group; each group returns a spanning forest of its links, not
    its pairs. A group over ``tile`` is cut in tiles, and each two tiles meet in a task of their own.
    """
    keyed = fps.select(F.explode(block_keys(distance + MATCHED, MATCHED)).alias("key"), "fp")
    # groups that are too large for a task; of n fingerprints there are at most (keys a fingerprint) * n / tile
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile)
    one = F.lit(0)
    cold = keyed.join(hot, "key", "left_anti").select("key", one.alias("a"), one.alias("b"), "fp")
    dealt = (
        keyed.join(hot, "key")
        .withColumn("k", F.ceil(F.col("n") / tile).cast("int") + 1)
        .withColumn("t", F.pmod(F.xxhash64("fp"), "k").cast("int"))
        .withColumn("s", F.explode(F.sequence(one, F.col("k") - 1)))
        .select("key", F.least("t", "s").alias("a"), F.greatest("t", "s").alias("b"), "fp")
    )
    grouped = cold.unionByName(dealt).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return grouped.mapInArrow(_edges(distance), "u long, v long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node on an edge, the root the smallest node of its component.

    Alternating stars: a large star ties the larger neighbours of a node to its smallest, a small star the smaller
    ones. Each step joins neighbours with their minimum, which is combined before the shuffle and joined as a table
    of one row a node, so a node with very many neighbours can be split. Rounds end when the edges stay as they are.
    """

    def print_of(e):
        row = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        return tuple(row)

    def star(pairs):  # pairs: u, v with v a neighbour of u
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    # u > v throughout
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    e = stored(e, "edges")
    seen = print_of(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # large star: of each node x, the neighbours above x go to the smallest of x and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = star(both).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = stored(e.join(low, "v").select("u", F.col("m").alias("v")).distinct(), "large-star")
        # small star: of each node x, itself and its smaller neighbours go to the smallest of these
        low = star(large)
        joined = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(joined.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = print_of(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"not at rest after {max_rounds} rounds")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, tile: int = TILE
) -> DataFrame:
    """``key, fp, component_id`` of every row: the smallest key that links of near fingerprints reach.

    Texts are lower-cased (A-Z) and cut at ASCII white space. A null or empty text has fingerprint 0 and is linked
    like any other. Rows with a null key are kept; their component is the smallest key reached, null if there is
    none. Repeated rows keep their number. Other columns are ignored.
    """
    fps = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("key").alias("least")), "classes")
    roots = components(near_links(classes.select("fp"), distance, tile))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    out = fps.join(rooted.join(ids, "root").select("fp", "component_id"), "fp")
    return out.select(F.col("key").alias(key), "fp", "component_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
