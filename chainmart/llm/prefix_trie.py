"""Prefix trie of conversations by truncation peeling.

Every conversation is a path of chained hashes, one for each of its turns. Nodes are peeled from the deepest level up:
the level's surviving nodes meet the conversations that join there, rows of one path are merged, and then the last turn
is stripped, which makes each node a row of its parent. Counts are combined before each shuffle, so a node that very
many conversations share leaves a task as one row. A conversation joins at the depth from which others share its turns:
the turns that it has alone need no regrouping, their nodes follow from the conversation itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chainmart.session import shared_dir

from .common import read_table, small_batches, stored

#: bytes of a path's hash; the root's is zeros
HASH = 16
#: the hash of no conversations
EMPTY = hashlib.sha256(b"").hexdigest()
#: conversations of a block take the first turns of the block's first one
BLOCK, HEADS = 20, 4
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, nth, role, text``: turns counted from 1 by turn (nulls first), then role and text; nulls are empty."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role").alias("role"), empty("text").alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("nth", F.row_number().over(order)).select("conv_id", "nth", "role", "text")


def with_shared_heads(turns: DataFrame) -> DataFrame:
    """``conv_id, nth, role, text`` of rebuilt conversations; ``nth`` is 0, without a role, in a row of each of them.

    The first h turns come from the block's first conversation, the others are its own after its first h.
    """
    own = numbered(turns)
    convs = own.select("conv_id").distinct()
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base")
    heads = own.where((F.col("conv_id") % BLOCK == 0) & (F.col("nth") < HEADS))
    heads = heads.select(F.col("conv_id").alias("base"), "nth", "role", "text")
    taken = convs.select("conv_id", h, base).join(heads, "base").where("nth <= h").select("conv_id", "nth", "role", "text")
    rest = own.where(F.col("nth") > h).withColumn("nth", F.col("nth") + HEADS)
    none = convs.select("conv_id", F.lit(0).alias("nth"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return none.unionByName(taken).unionByName(rest)


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, words, ends``: a row for every conversation and depth.

    ``node`` is the hash of the turns so far, ``words`` counts the last text's, ``ends`` marks the conversation's last.
    The hash goes on from turn to turn: a conversation is streamed through one task, which holds one turn of it.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        last = None  # held back until it is known whether its conversation goes on
        for b in batches:
            out = []
            for conv, nth, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if last is not None:
                    out.append((*last, conv != last[0]))
                if nth == 0:
                    last = (conv, 0, bytes(HASH), None, 0)
                else:
                    role, text = role.encode(), text.encode()
                    turn = b"%d:%b%b" % (len(role), role, text)
                    node = hashlib.blake2b(last[2] + turn, digest_size=HASH).digest()
                    last = (conv, last[1] + 1, node, last[2], len(text.split()))
            if out:
                yield batch(out)
        if last is not None:
            yield batch([(*last, True)])

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "depth", "node", "parent", "words", "ends"])

    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "nth")
    schema = "conv_id long, depth long, node binary, parent binary, words long, ends boolean"
    return small_batches(rows).select("conv_id", "nth", "role", "text").mapInArrow(run, schema)


def digests(ended: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of ``node, conv_id``: ids in order are hashed one after the other, never gathered."""

    def run(batches):
        node, hashed = None, None
        for b in batches:
            out = []
            for n, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if n != node:
                    if node is not None:
                        out.append((node, hashed.hexdigest()))
                    node, hashed = n, hashlib.sha256(str(conv).encode())
                else:
                    hashed.update(b",%d" % conv)
            if out:
                yield batch(out)
        if node is not None:
            yield batch([(node, hashed.hexdigest())])

    def batch(rows):
        nodes, found = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found)], ["node", "ends_sha256"])

    rows = small_batches(ended).select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    return rows.mapInArrow(run, "node binary, ends_sha256 string")


def _merged(rows: DataFrame) -> DataFrame:
    """Rows of one path as one."""
    total = lambda c: F.sum(c).alias(c)
    return rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"), total("n_leaves"), total("saved_tokens")
    )


def trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie over ``conv_id, nth, role, text``, where each conversation has a row of ``nth`` 0.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (for each node below, itself included, all members but one times the words of its
    last text), ``ends_sha256`` (of the ids of members that end there). Equal conversations end in one node; without
    conversations there are no nodes.
    """
    spark = conversations.sparkSession
    every = stored(paths(conversations), "trie-paths")
    known = every.where("depth > 0").groupBy("node").agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("words").alias("words"),
    )
    known = stored(known, "trie-nodes")
    # turns that a conversation has alone begin at one depth and last to its end
    alone = known.where("n = 1").groupBy("conv_id").agg(F.min("depth").alias("from"), F.min_by("parent", "depth").alias("above"))
    ends = every.where("ends").select("conv_id", "depth", "node").join(alone, "conv_id", "left")
    joined = ends.select(
        "conv_id",
        F.coalesce(F.col("from") - 1, F.col("depth")).alias("depth"),
        F.coalesce("above", "node").alias("node"),
        F.col("from").isNull().alias("here"),
        F.when(F.col("from").isNotNull(), F.col("depth")).alias("until"),
    )
    joined = stored(joined, "trie-joins")
    one = F.when(F.col("here"), 0).otherwise(1).cast("long")
    entering = joined.select(
        "node", "depth", "conv_id", F.lit(1).cast("long").alias("n_convs"), one.alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
    )
    total = lambda c: F.sum(c).alias(c)
    entering = entering.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"), total("n_leaves"), total("saved_tokens")
    )
    entering = stored(entering, "trie-entering")
    folder = shared_dir(spark, "trie-levels")
    deepest = entering.agg(F.max("depth")).first()[0]
    surviving = None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        rows = entering.where(F.col("depth") == depth).drop("depth")
        if surviving is not None:
            rows = rows.unionByName(surviving)
        # the last turn of each path: its words, and the path without it
        turn = known.where(F.col("depth") == depth).select("node", "parent", "words")
        level = _merged(rows).join(turn, "node", "left" if depth == 0 else "inner")
        level = level.select(
            "node",
            "parent",
            "conv_id",
            "n_convs",
            "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))).alias("saved_tokens"),
        )
        level.write.parquet(f"{folder}/depth={depth}")
        level = spark.read.schema(level.schema).parquet(f"{folder}/depth={depth}")
        surviving = level.select(
            F.col("parent").alias("node"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens"
        )
    if surviving is None:
        return spark.createDataFrame([], f"{NODE}, ends_sha256 string")
    shared = spark.read.parquet(folder).withColumn("depth", F.col("depth").cast("long"))
    ids = shared.select("node", F.col("conv_id").alias("parent_conv_id"))
    ended = digests(joined.where("here").select("node", "conv_id"))
    out = shared.join(ids.withColumnRenamed("node", "parent"), "parent", "left").join(ended, "node", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    out = out.select(*columns, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    # nodes of turns that a conversation has alone; the topmost hangs on a node that others share
    own = joined.where(~F.col("here")).join(ids, "node")
    own = own.withColumn("at", F.explode(F.sequence(F.col("depth") + 1, F.col("until"))))
    last = F.col("at") == F.col("until")
    own = own.select(
        "conv_id",
        F.col("at").alias("depth"),
        F.when(F.col("at") == F.col("depth") + 1, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY).alias("ends_sha256"),
    )
    return out.unionByName(own)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie over all rebuilt conversations."""
    return trie(with_shared_heads(read_table(spark, sf_dir, "conversations")))


#: checksums by table lookup over the digits; the 256 table entries follow from the polynomial
ORACLE = """
WITH poly AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
convs AS (
  SELECT conv_id AS c, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
           lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), poly),
own AS (
  SELECT conv_id AS c, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x, row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
built AS (
  SELECT k.c, 0 AS part, n, x FROM convs k JOIN own o ON o.c = k.c - k.c % 20 AND n <= h
  UNION ALL SELECT k.c, 1, n, x FROM convs k JOIN own o ON o.c = k.c AND n > h),
deep AS (
  SELECT c, row_number() OVER w AS d, list(x) OVER (w ROWS UNBOUNDED PRECEDING) AS p, x,
         count(*) OVER (PARTITION BY c) AS len
  FROM built WINDOW w AS (PARTITION BY c ORDER BY part, n)),
member AS (
  SELECT c, d, to_json(p)::VARCHAR AS p, to_json(p[:-2])::VARCHAR AS up, d = len AS ends,
         len(regexp_extract_all(x.t, '[^\\x20\\x09-\\x0D]+')) AS words FROM deep
  UNION ALL
  SELECT c, 0, '[]', NULL, c NOT IN (SELECT c FROM built), 0 FROM convs),
node AS (
  SELECT p, any_value(d) AS d, any_value(up) AS up, min(c) AS c, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY p),
kids AS (SELECT up AS p, count(*) AS n FROM node GROUP BY up),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (p)),
below AS (
  SELECT m.p, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved
  FROM full_node f JOIN member m ON m.c = f.c AND m.d <= f.d GROUP BY m.p)
SELECT f.c AS conv_id, f.d AS depth, u.c AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
       b.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN below b USING (p) LEFT JOIN node u ON u.p = f.up"""
