"""Token ids as binary blocks of a static range asymmetric numeral system (rANS).

One table of frequencies, counted over all ids, serves every block. A block holds whole documents in key order. Its ids
are dealt to ``LANES`` interleaved states that are coded side by side; every ``CHECKPOINT`` steps the states and the
place in the stream are kept, so that decoding can start there. Blocks are independent and carry checksums of their
bytes and of their ids.

Layout of a block, little-endian: ``MAGIC``, u32 bits of the table, u32 lanes, u64 ids, u64 words, u32 checkpoints, u32
documents, u32 crc32 of the table, u32 crc32 of the ids, u32 crc32 of the body; then the body: u64 states of all lanes
and u64 word offset for each checkpoint, u64 ids of each document, u32 words of the stream.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import Remembered, kept_by_worker, load_tokenizer, read_table, small_batches, stored, tokenizer_json

BYTE_BPE = "byte_bpe_50k.json"
MAGIC = b"RANSIDS1"
HEADER = "<8sIIQQIIIII"
LANES = 256
#: steps between checkpoints; a step codes one id of each lane
CHECKPOINT = 256
#: ids of a block; a block ends with a whole document
BLOCK_IDS = 1 << 18
#: frequencies of a table add up to 2 to this power
TABLE_BITS = 20
END_ID = 0
#: segments of texts whose ids a worker keeps (and as many from before them), and the longest of them
SEGMENTS, SEGMENT_CHARS = 300_000, 64
#: bytes of texts that are cut at once, and segments that the tokenizer gets as one text
TEXT_BYTES, JOINED = 32 << 20, 1000
#: ids of the blocks that are coded side by side
SIDE_BY_SIDE = 1 << 22
#: letters that every version of Unicode has as such, behind a space or not, and marks that end a word
_WORD = "[ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
_LETTERS = re.compile(_WORD)
_MARKS = frozenset(".,;:!?")
_OTHER, _LETTER, _MARK, _SPACE, _LINE, _BLANK, _HIGH = range(7)


def _kinds() -> np.ndarray:
    """The kind of every byte; ``_HIGH`` is one of a character beyond ASCII."""
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[[i for i in range(128) if chr(i).isalpha()]] = _LETTER
    kinds[[ord(m) for m in _MARKS]] = _MARK
    kinds[[i for i in range(128) if chr(i).isspace()]] = _BLANK
    kinds[[ord(" "), ord("\n")]] = _SPACE, _LINE
    kinds[128:] = _HIGH
    return kinds


def _borders() -> np.ndarray:
    """Whether texts are cut between bytes of kinds ``k`` and ``l``, at ``8 * k + l``: 0 no, 1 yes, 2 as ``cuts`` looks."""
    borders = np.zeros((8, 8), np.uint8)
    borders[[_OTHER, _LETTER, _MARK], _SPACE] = 1
    borders[[_LETTER, _MARK], _LINE] = 1
    borders[_LETTER, _MARK] = 1
    borders[_HIGH, [_SPACE, _MARK]] = 2
    borders[_LINE, _LETTER] = 2
    return borders.ravel()


_KIND, _BORDER = _kinds(), _borders()
#: white space beyond ASCII, and what is no letter from U+00C0 to U+023F, as numbers of their bytes
_WIDE_BLANKS = [int.from_bytes(chr(i).encode()) for i in range(128, 1 << 16) if chr(i).isspace()]
_NO_LETTERS = [0xC397, 0xC3B7]
#: ids of a vocabulary whose counts are gathered on the driver
MAX_VOCABULARY = 1 << 19
_LOW = np.uint64(1 << 31)


def quantised(counts: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Frequencies of sum ``2**bits``, at least 1 for every id that occurs."""
    total, used = int(counts.sum()), np.flatnonzero(counts)
    if not total:
        return np.zeros(len(counts), np.int64)
    room = (1 << bits) - len(used)
    if room < 0:
        raise ValueError(f"{len(used)} ids do not fit in {bits} bits")
    share = counts * (room / total)
    out = np.where(counts > 0, 1, 0) + np.floor(share).astype(np.int64)
    left = (1 << bits) - int(out.sum())
    # what rounding left over goes to the ids with the largest remainders, smallest id first
    order = used[np.argsort(-(share - np.floor(share))[used], kind="stable")]
    out[order[:left]] += 1
    rest = (1 << bits) - int(out.sum())
    out[used[np.argmax(counts[used])]] += rest
    return out


class Table:
    """Frequencies, their running sums and the id of every slot."""

    def __init__(self, freq: np.ndarray, bits: int = TABLE_BITS):
        self.bits, self.freq = bits, freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.id = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.crc = zlib.crc32(np.trim_zeros(freq, "b").astype("<u8").tobytes())


def encode_block(ids: np.ndarray, lengths: np.ndarray, table: Table, lanes: int = LANES) -> bytes:
    return encode_blocks([(ids, lengths)], table, lanes)[0]


def encode_blocks(blocks: list[tuple[np.ndarray, np.ndarray]], table: Table, lanes: int = LANES) -> list[bytes]:
    """The block of each ``(ids, lengths)``. A step of all blocks is coded at once; they are as if coded one by one."""
    k, top = np.uint64(table.bits), np.uint64(63 - table.bits)
    # the longest first, so that those with a step t are the first ones
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i][0]))
    steps = np.array([-(-len(blocks[i][0]) // lanes) for i in order], np.int64)
    longest = int(steps.max(initial=0))
    # an id that fills the table leaves a state as it is: it stands for what a last step lacks
    freq, start = np.append(table.freq, np.uint64(1 << table.bits)), np.append(table.start, np.uint64(0))
    dealt = np.full((longest, len(order), lanes), len(table.freq), np.uint32)
    for j, i in enumerate(order):
        ids = blocks[i][0]
        whole = len(ids) // lanes
        dealt[:whole, j] = ids[: whole * lanes].reshape(whole, lanes)
        dealt[whole : whole + 1, j, : len(ids) - whole * lanes] = ids[whole * lanes :]
    x = np.full((len(order), lanes), _LOW, np.uint64)
    chunks, written = [], np.zeros((longest, len(order)), np.int64)
    marks, marked = [[] for _ in order], [[] for _ in order]
    words = np.zeros(len(order), np.int64)
    active = np.searchsorted(-steps, -np.arange(longest), "left")
    for t in range(longest - 1, -1, -1):
        m = int(active[t])
        y, ids = x[:m], dealt[t, :m]
        ft = freq[ids]
        # ft is at most 2**bits: a table of one id alone would shift out of range, and then nothing is written
        over = (y >> top) >= ft
        written[t, :m] = over.sum(axis=1)
        words += written[t]
        chunks.append(y[over].astype("<u4"))
        y >>= over.astype(np.uint64) << np.uint64(5)
        q = y // ft
        x[:m] = (q << k) + start[ids] + (y - q * ft)
        if t % CHECKPOINT == 0:
            for j in range(m):
                marks[j].append(x[j].astype("<u8").tobytes())
                marked[j].append(int(words[j]))
    # decoding reads the chunks from the last written on
    stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    own = np.repeat(np.tile(np.arange(len(order)), longest), written.ravel())
    out = [b""] * len(order)
    for j, i in enumerate(order):
        ids, lengths = blocks[i]
        body = b"".join(s + struct.pack("<Q", int(words[j]) - w) for s, w in zip(reversed(marks[j]), reversed(marked[j])))
        body += lengths.astype("<u8").tobytes() + stream[own == j].tobytes()
        head = (table.bits, lanes, len(ids), int(words[j]), len(marks[j]), len(lengths), table.crc)
        crcs = zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)
        out[i] = struct.pack(HEADER, MAGIC, *head, *crcs) + body
    return out


def decode_block(data: bytes, table: Table, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids from checkpoint ``first`` up to ``last`` (all without), and the lengths of the block's documents."""
    return decode_blocks([data], table, first, last)[0]


def decode_blocks(
    blocks: list[bytes], table: Table, first: int = 0, last: int | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """``decode_block`` of each; a step of all blocks of as many lanes is decoded at once."""
    heads = [struct.unpack_from(HEADER, data) for data in blocks]
    out = [None] * len(blocks)
    for lanes in {h[2] for h in heads}:
        chosen = [i for i, h in enumerate(heads) if h[2] == lanes]
        found = _decoded([blocks[i] for i in chosen], [heads[i] for i in chosen], lanes, table, first, last)
        for i, f in zip(chosen, found):
            out[i] = f
    return out


def _decoded(blocks: list[bytes], heads: list[tuple], lanes: int, table: Table, first: int, last: int | None) -> list:
    size, rows = 8 * lanes + 8, []
    for data, head in zip(blocks, heads):
        magic, bits, _, n, words, marks, docs, table_crc, ids_crc, body_crc = head
        body = memoryview(data)[struct.calcsize(HEADER) :]
        if magic != MAGIC or zlib.crc32(body) != body_crc:
            raise ValueError("damaged block")
        if table_crc != table.crc or bits != table.bits:
            raise ValueError("block of another table")
        lengths = np.frombuffer(body, "<u8", docs, marks * size).astype(np.int64)
        stream = np.frombuffer(body, "<u4", words, marks * size + 8 * docs)
        steps = -(-n // lanes)
        begin, end = first * CHECKPOINT, steps if last is None else min(steps, last * CHECKPOINT)
        count = max(0, min(n, end * lanes) - begin * lanes)
        x = np.frombuffer(body, "<u8", lanes + 1, first * size) if count else np.zeros(lanes + 1, "<u8")
        rows.append((count, lengths, stream, x, ids_crc))
    order = sorted(range(len(rows)), key=lambda i: -rows[i][0])
    counts = np.array([rows[i][0] for i in order], np.int64)
    longest = -(-int(counts.max(initial=0)) // lanes)
    x = np.array([rows[i][3][:lanes] for i in order], np.uint64)
    stream = np.concatenate([rows[i][2] for i in order]).astype(np.uint64)
    sizes = np.array([len(rows[i][2]) for i in order], np.int64)
    at = np.array([rows[i][3][lanes] for i in order], np.int64) + np.cumsum(sizes) - sizes
    k, mask, lane = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.arange(lanes)
    active = np.searchsorted(-counts, -np.arange(longest) * lanes, "left")
    full = np.searchsorted(-counts, -(np.arange(longest) + 1) * lanes, "right")
    dealt = np.empty((longest, len(order), lanes), np.uint32)
    for t in range(longest):
        m = int(active[t])
        slot = x[:m] & mask
        ids = table.id[slot]
        dealt[t, :m] = ids
        y = table.freq[ids] * (x[:m] >> k) + slot - table.start[ids]
        low = y < _LOW
        if full[t] < m:  # lanes that a block's last step lacks read nothing
            low[full[t] :] &= lane < (counts[full[t] : m] - t * lanes)[:, None]
        read = low.sum(axis=1)
        where = np.flatnonzero(low)
        words = stream[np.repeat(at[:m] - np.cumsum(read) + read, read) + np.arange(len(where))]
        flat = y.ravel()
        flat[where] = (flat[where] << np.uint64(32)) | words
        at[:m] += read
        x[:m] = y
    out = [None] * len(order)
    for j, i in enumerate(order):
        count, lengths, _, _, ids_crc = rows[i]
        ids = dealt[:, j].reshape(-1)[:count]
        if first == 0 and last is None and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("ids differ from those written")
        out[i] = ids, lengths
    return out


def _side_by_side(rows, size):
    """Lists of ``rows`` to code at once: as many as their largest ``size`` lets into ``SIDE_BY_SIDE``, one at least."""
    held, most = [], 0
    for row in rows:
        n = size(row)
        if held and max(most, n) * (len(held) + 1) > SIDE_BY_SIDE:
            yield held
            held, most = [], 0
        held.append(row)
        most = max(most, n)
    if held:
        yield held


def _byte_characters() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte: its own where that is visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


def cuts(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 texts that follow each other, whether its text is cut before it.

    A byte-level BPE with the usual pattern never joins a character to a blank behind it, so before each space or line
    end that follows something else than white space a new token begins, whatever comes before or after. Nor does it
    join letters to a mark behind them, or a line end that is the only white space to a letter behind it.
    """
    kind = _KIND[data]
    cut = np.zeros(len(data), np.uint8)
    cut[1:] = _BORDER[kind[:-1] * np.uint8(8) + kind[1:]]
    at = np.flatnonzero(cut == 2)
    two = data[at - 2].astype(np.int64) << 8 | data[at - 1]
    three = data[at - 3].astype(np.int64) << 16 | two
    blank = np.isin(two, _WIDE_BLANKS) | np.isin(three, _WIDE_BLANKS)
    letter = (two >> 8 >= 0xC3) & (two >> 8 <= 0xC8) & ~np.isin(two, _NO_LETTERS)
    behind = kind[at - 2]
    lone = (at >= 2) & ((behind == _LETTER) | (behind == _MARK))
    cut[at] = np.select([kind[at] == _SPACE, kind[at] == _MARK], [~blank, letter], lone)
    return cut.view(bool)


class Segments(Remembered):
    """Segment of a text -> its ids as bytes. Texts are cut as ``cuts`` says, where no token reaches across.

    The segments of many texts are looked up at once, equal ones once. Those that are new go to the model itself if they
    are letters, which are one word for it; others to the tokenizer together as one text, whose ids are parted by the
    bytes that they stand for.
    """

    def __init__(self, tokenizer, kind: str):
        super().__init__(SEGMENTS)
        self.tokenizer, self.kind = tokenizer, kind
        added = tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        self.model, self.written = tokenizer.model.tokenize, _byte_characters()
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        #: bytes that an id stands for: a vocabulary of bytes writes each as a character
        self.bytes_of = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def make(self, segment: str) -> bytes:
        if segment[-1] in _MARKS and _LETTERS.fullmatch(segment, 0, len(segment) - 1):
            return self[segment[:-1]] + self[segment[-1]]
        if _LETTERS.fullmatch(segment):
            return self._words([segment])[0]
        return self._encoded(segment)

    def __missing__(self, segment: str) -> bytes:
        if not segment:
            return b""
        if len(segment) > SEGMENT_CHARS or any(t in segment for t in self.added):
            return self._encoded(segment)
        return super().__missing__(segment)

    def _words(self, segments: list[str]) -> list[bytes]:
        """Ids of segments of letters: each is one word for the model, which knows bytes as characters."""
        ids, ends, space = [], [0], self.written[ord(" ")]
        for s in segments:
            word = s.replace(" ", space) if s.isascii() else s.encode().decode("latin-1").translate(self.written)
            ids += [t.id for t in self.model(word)]
            ends.append(len(ids))
        ids = np.array(ids, self.kind)
        data, ends = ids.tobytes(), [n * ids.itemsize for n in ends]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _joined(self, segments: list[str]) -> list[bytes]:
        """Ids of segments that begin with a space and do not end with a blank: the tokenizer gets them as one text."""
        wanted = np.cumsum([len(s.encode()) for s in segments])
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(segments)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum(self.bytes_of[ids])
        at = np.searchsorted(ends, wanted)
        # not so if the vocabulary lacks bytes that occur
        if not len(ends) or ends[-1] != wanted[-1] or (ends[at] != wanted).any():
            return [self._encoded(s) for s in segments]
        data, to = ids.astype(self.kind).tobytes(), ((at + 1) * np.dtype(self.kind).itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *to], to)]

    def _keep(self, segments: list[str], ids: list[bytes]) -> None:
        at = 0
        while at < len(segments):
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            end = at + self.most - len(self)
            self.update(zip(segments[at:end], ids[at:end]))
            at = end

    def of(self, column: pa.Array) -> list[bytes]:
        """The ids of each segment of a string column; no segment is there twice."""
        segments = column.to_pylist()
        found = list(map(self.get, segments))
        lost = [i for i, ids in enumerate(found) if ids is None]
        if not lost:
            return found
        letters = pc.match_substring_regex(column, f"^{_WORD}\\z").to_pylist()
        again, words, joined, before = [], [], [], self.before.get
        for i in lost:
            s = segments[i]
            ids = before(s)
            if ids is not None:
                found[i] = ids
                again.append(i)
            elif not s or len(s) > SEGMENT_CHARS:
                found[i] = self[s]
            elif letters[i]:
                words.append(i)
            elif s[0] == " " and not s[-1].isspace():
                joined.append(i)
            else:
                found[i] = self[s]
        self._keep([segments[i] for i in again], [found[i] for i in again])
        for places, make in (words, self._words), (joined, self._joined):
            for begun in range(0, len(places), JOINED):
                part = places[begun : begun + JOINED]
                new = [segments[i] for i in part]
                text = "".join(new)
                if any(t in text for t in self.added):
                    made = [self[s] for s in new]
                else:
                    made = make(new)
                    self._keep(new, made)
                for i, ids in zip(part, made):
                    found[i] = ids
        return found

    def parted(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The segments of a binary column without nulls, and the place of each text's first one, and their number."""
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        cut = cuts(data)
        cut[ends[:-1][ends[:-1] < len(data)]] = False
        for t in self.added:
            for i in np.flatnonzero(pc.match_substring(texts, t).to_numpy(zero_copy_only=False)):
                cut[ends[i] : ends[i + 1]] = False
        inner = np.flatnonzero(cut).astype(np.int32)
        # a text's first segment begins where the text does, and an empty text has an empty one
        before = np.searchsorted(inner, ends)
        borders = np.append(np.insert(inner, before[:-1], ends[:-1]), ends[-1:])
        segments = pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(data)])
        return segments, before + np.arange(len(before))

    def columns(self, texts: list[pa.Array], last: bytes = b""):
        """The ids of each text of binary columns without nulls, and ``last`` behind them: a column for each."""
        parted = [self.parted(c) for c in texts if len(c)]
        coded = pa.chunked_array([segments for segments, _ in parted], pa.binary()).dictionary_encode().chunks
        firsts = [f for _, f in parted]
        del parted
        known = pa.array([*(self.of(coded[0].dictionary.cast(pa.string())) if coded else []), last], pa.binary())
        coded, firsts = iter(coded), iter(firsts)
        for c in texts:
            if not len(c):
                yield pa.array([], pa.binary())
                continue
            first = next(firsts)
            ids = known.take(pa.array(np.insert(next(coded).indices.to_numpy(), first[1:], len(known) - 1)))
            _, offsets, data = ids.buffers()
            offsets = np.frombuffer(offsets, np.int32)[ids.offset :][first + np.arange(len(first))]
            yield pa.Array.from_buffers(pa.binary(), len(c), [None, pa.py_buffer(offsets), data])

    def text(self, text: str) -> bytes:
        return next(self.columns([pa.array([text.encode()], pa.binary())]))[0].as_py()


def cut_at_spaces(content: str) -> bool:
    """Whether a tokenizer file is a byte-level BPE as ``Segments`` needs it; others encode whole texts."""
    t = json.loads(content)
    model, pre = t["model"], t.get("pre_tokenizer") or {}
    return (
        t.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and (t.get("post_processor") or {"type": "ByteLevel"})["type"] == "ByteLevel"
        and model.get("type") == "BPE"
        and not model.get("dropout")
    )


def _in_bytes(batches):
    """Lists of keys and of texts (binary, a null is empty) of batches, up to ``TEXT_BYTES`` or those of one batch."""
    keys, texts, size = [], [], 0
    for b in batches:
        t = b.column(1).cast(pa.binary()).fill_null(b"")
        if texts and size + t.nbytes > TEXT_BYTES:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(b.column(0))
        texts.append(t)
        size += t.nbytes
    if texts:
        yield keys, texts


def tokenised(docs: DataFrame, path: str, key: str, text: str, end_id: int | None = END_ID) -> DataFrame:
    """``key, ids``: little-endian ids of every row, of two bytes each if the vocabulary allows, else four."""
    content = docs.sparkSession.sparkContext.broadcast(tokenizer_json(path))
    end = [] if end_id is None else [end_id]

    def run(batches):
        tokenizer = load_tokenizer(content.value)
        kind = "<u2" if tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4"
        last = np.array(end, kind).tobytes()
        segments = kept_by_worker(f"segments-{kind}-{id(tokenizer)}", lambda: Segments(tokenizer, kind))
        cut = cut_at_spaces(content.value)
        for keys, texts in _in_bytes(batches):
            if cut:
                found = segments.columns(texts, last)
            else:
                found = (pa.array([segments._encoded(t.decode()) + last for t in c.to_pylist()], pa.binary()) for c in texts)
            for k, ids in zip(keys, found):
                yield pa.RecordBatch.from_arrays([k, ids], ["key", "ids"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType())])
    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def _table_of(tokens: DataFrame, kind: str, size: int, bits: int) -> np.ndarray:
    """The shared frequencies: every task counts its ids, one row for an id and task is shuffled."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["id", "n"])

    if size > MAX_VOCABULARY:
        raise ValueError(f"{size} ids; counts of at most {MAX_VOCABULARY} are gathered")
    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    for r in rows:
        counts[r[0]] = r[1]
    return quantised(counts, bits)


def write_token_files(
    docs: DataFrame, folder: str, path: str | None = None, key: str = "doc_id", text: str = "text",
    end_id: int | None = END_ID, block_ids: int = BLOCK_IDS, bits: int = TABLE_BITS,
) -> None:
    """Write ``folder/blocks`` (``part, block, n_ids, keys, payload``) and ``folder/table`` (``id, frequency``).

    Blocks lie in ascending key order, nulls first; rows of one key are ordered by their ids. A row of a block's table
    is one block, so that Spark commits all blocks of a task or none. A null text has the end id alone.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    path = path or public_tokenizers.path(BYTE_BPE)
    size = Tokenizer.from_file(path).get_vocab_size(True)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    tokens = stored(tokenised(docs, path, key, text, end_id), "token-ids")
    freq = _table_of(tokens, kind, size, bits)
    spark.createDataFrame(
        [(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id long, frequency long"
    ).coalesce(1).write.parquet(f"{folder}/table")
    sent = spark.sparkContext.broadcast((freq, bits))
    key_type = tokens.select("key").limit(0).toArrow().schema.field(0).type

    def pack(batches):
        table, part, n = Table(*sent.value), TaskContext.get().partitionId(), 0

        def blocks():
            keys, ids, size = [], [], 0
            for b in batches:
                for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    keys.append(k)
                    ids.append(np.frombuffer(x, kind))
                    size += len(ids[-1])
                    if size >= block_ids:
                        yield keys, np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
                        keys, ids, size = [], [], 0
            if keys:
                yield keys, np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

        for held in _side_by_side(blocks(), lambda block: len(block[1])):
            for (keys, ids, _), payload in zip(held, encode_blocks([block[1:] for block in held], table)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int64()),
                        pa.array([n], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([keys], pa.list_(key_type)),
                        pa.array([payload], pa.binary()),
                    ],
                    ["part", "block", "n_ids", "keys", "payload"],
                )
                n += 1

    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("block", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("keys", T.ArrayType(docs.schema[key].dataType)),
            T.StructField("payload", T.BinaryType()),
        ]
    )
    # rows of a key that is very frequent are parted by their ids
    order = [F.col("key").asc_nulls_first(), F.crc32("ids"), F.col("ids")]
    ordered = tokens.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(pack, schema).write.parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` (little-endian u32) of every document; damaged blocks raise an error."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    freq = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/table").collect()}  # bounded by the vocabulary
    known = np.zeros(max(freq, default=0) + 1, np.int64)
    known[list(freq)] = list(freq.values())
    sent = spark.sparkContext.broadcast(known)
    kind = blocks.schema["keys"].dataType.elementType
    sizes = blocks.select("part", "block", "n_ids")
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each task that wrote
    up_to = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_in", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(totals, "part")
    starts = starts.select("part", "block", (F.col("_in") + F.col("_before")).alias("start"))
    key_type = blocks.select("keys").limit(0).toArrow().schema.field(0).type.value_type

    def unpack(batches):
        bits = int(sent.value.sum()).bit_length() - 1
        table = Table(sent.value, bits)
        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(3))))
        for held in _side_by_side(rows, lambda row: struct.unpack_from(HEADER, row[2])[3]):
            for (start, keys, _), (ids, lengths) in zip(held, decode_blocks([row[2] for row in held], table)):
                ends = np.cumsum(lengths)
                parts = [ids[e - n : e].astype("<u4").tobytes() for n, e in zip(lengths.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, key_type),
                        pa.array(start + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    ["key", "start", "n_tokens", "ids"],
                )

    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return blocks.join(starts, ["part", "block"]).select("start", "keys", "payload").mapInArrow(unpack, schema)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    from chainmart.session import shared_dir

    folder = shared_dir(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), folder)
    out = read_token_files(spark, folder)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
