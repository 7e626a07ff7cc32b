"""Segments of many texts looked up at once, blocks coded side by side."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import AddedToken, Tokenizer

from chainmart.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", " ", " ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "　", "a", "Ab", "é", "×", "ɏ", "ȿ", "ÿ", "é",
          "日本", "12", "'s", "'", ".", ",", "...", "!?", "$$$", "<|endoftext|>", "<|endoftext", "w" * 70, "\x00", "🙂"]


def ids_of(segments, *columns, last=b""):
    found = list(segments.columns(list(columns), last))
    assert [len(c) for c in found] == [len(c) for c in columns]
    return [np.frombuffer(x, "<u4").tolist() for c in found for x in c.to_pylist()]


@pytest.mark.parametrize("most", [3, 50, 300_000])
def test_texts_at_once(monkeypatch, most):
    monkeypatch.setattr(token_files, "SEGMENTS", most)
    monkeypatch.setattr(token_files, "JOINED", 7)
    t = Tokenizer.from_file(PATH)
    s = token_files.Segments(t, "<u4")
    rng = np.random.default_rng(3)
    for _ in range(20):
        texts = ["".join(rng.choice(PIECES, rng.integers(0, 12))) for _ in range(400)]
        column = pa.array([x.encode() for x in texts], pa.binary())
        want = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert ids_of(s, column) == want
        parts = column.slice(150, 99), column.slice(0, 0), column.slice(249)
        assert ids_of(s, *parts, last=np.array([7], "<u4").tobytes()) == [x + [7] for x in want[150:]]
        assert len(s) <= most and len(s.before) <= most
    assert ids_of(s) == ids_of(s, column.slice(0, 0)) == []
    assert ids_of(s, pa.array([b"", b""]), pa.array([b""])) == [[], [], []]


def test_added_tokens_of_letters_or_blanks():
    t = Tokenizer.from_file(PATH)
    t.add_tokens(["hello", "b c", AddedToken("<x>", lstrip=True, rstrip=True)])
    s = token_files.Segments(t, "<u4")
    texts = ["hello", "a hello b", "othello", "b c", " b", " c", " b c d", "a <x> b", "a <x>", " <", "x> b"] * 3
    for some in (texts, texts[::-1], [" b", " c1", " b1", " c"]):
        got = ids_of(s, pa.array([x.encode() for x in some], pa.binary()))
        assert got == [t.encode(x, add_special_tokens=False).ids for x in some]


def test_words_are_looked_up_once_for_many_texts():
    """Lookups and calls follow the different words, not the texts that have them."""
    looked = []

    class Counted(token_files.Segments):
        def __missing__(self, segment):
            looked.append(segment)
            return super().__missing__(segment)

        def get(self, segment):
            looked.append(segment)
            return super().get(segment)

    t = Tokenizer.from_file(PATH)
    s = Counted(t, "<u4")
    text = "Some words, some words again.\nSome é7 words 12 and é7 too"
    got = ids_of(s, *[pa.array([text.encode()] * 1000, pa.binary())] * 5)
    assert got == [t.encode(text, add_special_tokens=False).ids] * 5000
    assert len(looked) < 40


def test_blocks_side_by_side():
    """As written one by one, whatever lies beside them, and read back."""
    rng = np.random.default_rng(4)
    for top, lanes in ((1, 256), (3, 16), (50_000, 256)):
        sizes = [0, 1, 255, 256, 257, 70_000, 65_536, 3, 131_073, 70_000]
        blocks = []
        for n in sizes:
            ids = np.minimum(rng.zipf(1.2, n), top - 1).astype(np.uint16)
            blocks.append((ids, np.array([n // 3, 0, n - n // 3], np.int64)))
        table = token_files.Table(token_files.quantised(np.bincount(np.concatenate([b[0] for b in blocks]), minlength=top)))
        together = token_files.encode_blocks(blocks, table, lanes)
        assert together == [token_files.encode_block(*b, table, lanes) for b in blocks]
        for (ids, lengths), (got, own) in zip(blocks, token_files.decode_blocks(together, table)):
            assert (got == ids).all() and (own == lengths).all()
        step = token_files.CHECKPOINT * lanes
        for (ids, _), (got, _) in zip(blocks, token_files.decode_blocks(together, table, 1, 2)):
            assert (got == ids[step : 2 * step]).all() and len(got) == len(ids[step : 2 * step])
        mixed = [together[8], token_files.encode_block(*blocks[5], table, lanes // 2), together[5]]
        for (ids, _), k in zip(token_files.decode_blocks(mixed, table), (8, 5, 5)):
            assert (ids == blocks[k][0]).all()
        broken = [together[5], together[8][:-1] + bytes([together[8][-1] ^ 1])]
        with pytest.raises(ValueError, match="damaged"):
            token_files.decode_blocks(broken, table)
    assert token_files.encode_blocks([], table) == [] and token_files.decode_blocks([], table) == []


def test_blocks_together_are_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "SIDE_BY_SIDE", 100)
    groups = list(token_files._side_by_side([10] * 12 + [70, 30, 500, 1, 1], int))
    assert groups == [[10] * 10, [10] * 2, [70], [30], [500], [1, 1]]
    assert list(token_files._side_by_side([], int)) == []


def test_batches_together_keep_keys_and_nulls(monkeypatch):
    def batch(keys, texts):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string())], ["k", "t"])

    def got(*batches):
        lists = token_files._in_bytes(iter(batches))
        return [([x for k in keys for x in k.to_pylist()], [x for t in texts for x in t.to_pylist()]) for keys, texts in lists]

    some = batch([1, None], ["a", None]), batch([], []), batch([3], ["bc"])
    assert got(*some) == [([1, None, 3], [b"a", b"", b"bc"])]
    monkeypatch.setattr(token_files, "TEXT_BYTES", 1)
    assert got(*some) == [([1, None], [b"a", b""]), ([], []), ([3], [b"bc"])]
    assert list(token_files._in_bytes(iter([]))) == []
