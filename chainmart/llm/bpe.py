"""BPE over a distinct-word table: each word is encoded once, its ids are joined back by position.

A task cuts its texts into words and keeps, for a block of documents, the list of its distinct words and the position
of each word in that list. Only the lists are shuffled by word, one row for a word and block, so a word that is in every
text costs one row a block; sorted, they are the table of distinct words, each encoded once. Positions stay where they are stored: the ids of a block's words come to them.
Decoding joins ids with the id-to-piece table, which every task has.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import load_tokenizer, read_table, small_batches, stored_in_buckets, tokenizer_json, utf8

WORD_BPE = "word_bpe_49k.json"
#: text and distinct words of a block of documents; a longer text is a block of its own
BLOCK_BYTES = 32 << 20
BLOCK_WORDS = 400_000
#: chunks whose words a task remembers; all are forgotten beyond it, and cut again when they come again
CACHED_CHUNKS = 100_000
#: words that a task puts back at once
OUT_WORDS = 1 << 20
#: ids of a vocabulary whose pieces may be broadcast
MAX_PIECES = 2_000_000

#: how a tokenizer file has to cut words, as ``_Words`` does: fixed values of the format
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}

_ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def refuse_others(content: str) -> None:
    """An error for a tokenizer whose texts cannot be cut into words at white space by ``RULES``."""
    spec = json.loads(content)
    for name, rule in RULES.items():
        if spec.get(name) != rule:
            raise ValueError(f"this tokenizer's {name} is not {rule}")
    for t in spec.get("added_tokens") or []:
        if t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]:
            raise ValueError(f"added token {t['content']!r} depends on the white space around it")


class _Words(dict):
    """Chunk between white space -> positions of its words in ``seen``, as little-endian int32."""

    def __init__(self, tokenizer):
        super().__init__()
        self.normal, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.seen: dict[str, int] = {}

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.added and self.added.search(text):
            words = [" " + text]  # no word has a space: marks a chunk that the tokenizer cuts itself
        elif text.isascii() and text.isprintable():
            words = [w.decode() for w in _ASCII_WORDS.findall(chunk.lower())]
        else:
            words = [w for w, _ in self.cut(self.normal(text))]
        at = [self.seen.setdefault(w, len(self.seen)) for w in words]
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        self[chunk] = found = np.array(at, "<i4").tobytes()
        return found


def _packed(index: bytes) -> bytes:
    """Compressed by byte planes: the high bytes of most positions are zero."""
    planes = np.frombuffer(index, np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def split_blocks(docs: DataFrame, key: str, text: str, content, block_bytes: int, block_words: int) -> DataFrame:
    """``block, keys, counts, words, index``: a row for each block of documents."""
    kind = docs.select(key).schema[0].dataType

    def run(batches):
        tokenizer = load_tokenizer(content.value)
        task, n = TaskContext.get().partitionId(), 0
        words, keys, counts, index, size = _Words(tokenizer), [], [], [], 0

        def block():
            own = pa.concat_arrays(keys)
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([task << 32 | n], pa.int64()),
                    "keys": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                    "counts": pa.array([counts], pa.list_(pa.int32())),
                    "words": pa.array([list(words.seen)], pa.list_(pa.string())),
                    "index": pa.array([_packed(b"".join(index))], pa.binary()),
                }
            )

        for b in batches:
            begun = 0
            for i, t in enumerate(utf8(b.column(1))):
                at = b"".join(map(words.__getitem__, t.split()))
                index.append(at)
                counts.append(len(at) // 4)
                size += len(t)
                if size >= block_bytes or len(words.seen) >= block_words:
                    keys.append(b.column(0).slice(begun, i + 1 - begun))
                    begun = i + 1
                    yield block()
                    n += 1
                    words, keys, counts, index, size = _Words(tokenizer), [], [], [], 0
                    pa.default_memory_pool().release_unused()
            if begun < b.num_rows:
                keys.append(b.column(0).slice(begun))
        if counts:
            yield block()

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("index", T.BinaryType()),
        ]
    )
    return small_batches(docs).select(F.col(key), F.col(text)).mapInArrow(run, schema)


def pieces_of(path: str) -> list[bytes | None]:
    """The piece of each id of a vocabulary, by id; its size is bounded, since tasks get all of it."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    size = max(vocab.values(), default=-1) + 1
    if size > MAX_PIECES:
        raise ValueError(f"ids up to {size}; pieces of at most {MAX_PIECES} are broadcast")
    pieces = [None] * size
    for piece, i in vocab.items():
        pieces[i] = piece.encode()
    return pieces


class _Decoder:
    """The map-side join of ids with their pieces."""

    def __init__(self, pieces: list[bytes | None]):
        self.pieces = pa.array(pieces, pa.binary())
        self.known = self.pieces.is_valid().to_numpy(zero_copy_only=False)

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The pieces of ``ids[offsets[i]:offsets[i + 1]]`` for each i, joined by a space."""
        known = (ids >= 0) & (ids < len(self.known))
        known[known] = self.known[ids[known]]
        if not known.all():
            offsets = np.concatenate(([0], np.cumsum(known)))[offsets]
            ids = ids[known]
        rows = pa.ListArray.from_arrays(offsets.astype(np.int32), self.pieces.take(pa.array(ids)))
        return pc.binary_join(rows, pa.scalar(b" ", pa.binary())).cast(pa.string())


def decode(df: DataFrame, path: str, key: str, ids: str = "ids") -> DataFrame:
    """``key, decoded``: the pieces of each row's ids, joined by a space; ids without a piece are passed over.

    One row for each of ``df``, whatever its key; no ids, or null, decode to an empty string. The id-to-piece table goes
    to the tasks (``pieces_of`` bounds it) and is joined there, so ``df`` is not shuffled.
    """
    pieces = df.sparkSession.sparkContext.broadcast(pieces_of(path))
    kind = df.select(key).schema[0].dataType

    def run(batches):
        joined = _Decoder(pieces.value)
        for b in batches:
            lists = b.column(1).fill_null([])
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), joined(flat, offsets - offsets[0])], ["key", "decoded"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("decoded", T.StringType())])
    rows = small_batches(df).select(F.col(key), F.col(ids).cast("array<int>"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def encoded(words: DataFrame, content, width: str) -> DataFrame:
    """``of, pos, ids`` of ``block, pos, word``: the ids of the word in each place, as numbers of type ``width``.

    Equal words meet and stand together, so that the first of them is encoded and the others take its ids. No block has
    a word twice: the commonest word has one row a block, as thousands of others do.
    """

    def run(batches):
        tokenizer = load_tokenizer(content.value)
        model, last, found = tokenizer.model.tokenize, None, b""
        for b in batches:
            ids = []
            for word in b.column(2).to_pylist():
                if word != last:
                    last = word
                    if word[0] == " ":
                        found = tokenizer.encode(word[1:], add_special_tokens=False).ids
                    else:
                        found = [t.id for t in model(word)]
                    found = np.array(found, width).tobytes()
                ids.append(found)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], ["of", "pos", "ids"])

    together = words.select("block", "pos", "word").repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(run, "of long, pos int, ids binary")


def _restore(pieces, width: str):
    """Documents of one block, from the ids of its words and the positions of the words in its documents."""

    def run(words: pa.Table, block: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        at_word = words.column("pos").to_numpy()
        ids = words.column("ids")
        flat = np.frombuffer(b"".join(ids.to_pylist()), width).astype(np.int32)
        ends = np.cumsum(pc.binary_length(ids).to_numpy(), dtype=np.int64) // np.dtype(width).itemsize
        starts, lens = np.zeros(len(at_word), np.int64), np.zeros(len(at_word), np.int64)
        lens[at_word] = np.diff(ends, prepend=0)
        starts[at_word] = ends - lens[at_word]
        keys = block.column("keys").combine_chunks().flatten()
        counts = block.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        where = _unpacked(block.column("index")[0].as_py())
        joined = _Decoder(pieces.value)
        firsts = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        out, begun = [], 0
        while begun < len(counts):
            # whole documents up to so many words at once
            end = max(begun + 1, int(np.searchsorted(firsts, firsts[begun] + OUT_WORDS, "right")) - 1)
            w = where[firsts[begun] : firsts[end]]
            own = lens[w]
            before = np.concatenate(([0], np.cumsum(own)))
            found = flat[np.repeat(starts[w] - before[:-1], own) + np.arange(before[-1])]
            offsets = before[firsts[begun : end + 1] - firsts[begun]]
            lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(found, pa.int32()))
            rows = [keys.slice(begun, end - begun), lists, joined(found, offsets)]
            out.append(pa.RecordBatch.from_arrays(rows, ["key", "ids", "decoded"]))
            begun = end
        return pa.Table.from_batches(out)

    return run


def encode_decode(
    docs: DataFrame,
    path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``key, ids, decoded`` of every document, as the tokenizer at ``path`` encodes and decodes it.

    For tokenizers that cut words as ``RULES`` says and have no decoder; others are refused. A null text is empty; empty
    texts have no ids and decode to an empty string. Rows with null or repeated keys keep their number. Texts of any
    length are taken whole. Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path(WORD_BPE)
    content = tokenizer_json(path)
    refuse_others(content)
    by_id = pieces_of(path)
    content, pieces = spark.sparkContext.broadcast(content), spark.sparkContext.broadcast(by_id)
    width = "<u2" if len(by_id) <= 1 << 16 else "<u4"
    # in buckets, so that the positions, which are most of it, are not shuffled once more to meet their words
    blocks = stored_in_buckets(split_blocks(docs, key, text, content, block_bytes, block_words), "bpe-blocks", "block")
    words = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    found = encoded(words, content, width)
    kind = docs.select(key).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField("key", kind),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    parts = blocks.select("block", "keys", "counts", "index").groupBy("block")
    rows = found.groupBy("of").cogroup(parts).applyInArrow(_restore(pieces, width), schema)
    return rows.withColumnRenamed("key", key)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoded text."""
    out = encode_decode(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
