"""Texts cut at spaces against the library, and the registered queries on tokens against their contracts."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chainmart.llm import bpe, token_files

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "　", "a", "Ab", "é",
          "é", "日本", "1", "²", "'s", "'S", "'ll", "don't", ".", "...", "!?", "_", "👩‍👧", "<|endoftext|>", "<|endoftext", "\x00"]


def test_segments_of_any_text():
    t = Tokenizer.from_file(PATH)
    s = token_files.Segments(t, "<u4")
    rng = np.random.default_rng(6)
    for _ in range(20_000):
        text = "".join(rng.choice(PIECES, rng.integers(0, 9)))
        assert np.frombuffer(s.text(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_only_tokenizers_that_can_be_cut():
    content = open(PATH, encoding="utf-8").read()
    assert token_files.cut_at_spaces(content)
    assert not token_files.cut_at_spaces(content.replace('"add_prefix_space":false', '"add_prefix_space":true').replace(
        '"add_prefix_space": false', '"add_prefix_space": true'))
    assert not token_files.cut_at_spaces(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def documents(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_registered_op4(spark):
    t, start, want = Tokenizer.from_file(PATH), 0, Counter()
    for key, text in sorted(documents(spark)):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want[key, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert Counter(map(tuple, token_files.op4_token_files(spark, SF).collect())) == want


def test_registered_op1(spark):
    t, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for key, text in documents(spark):
        ids = t.encode(text, add_special_tokens=False).ids
        want[key, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, bpe.op1_bpe(spark, SF).collect())) == want


def test_bpe_in_many_blocks(spark):
    """Blocks that end at a few bytes or words, and one document longer than any block."""
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = [(n, "".join(PIECES[(n * k * k + k) % len(PIECES)] for k in range(n % 40))) for n in range(300)]
    texts += [(None, None), (7, "a word " * 50_000 + "日本"), (8, "")]
    want = Counter()
    for key, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[key, tuple(ids), t.decode(ids, skip_special_tokens=False)] += 1
    df = spark.createDataFrame(texts, "own long, body string")
    for most in ({}, {"block_bytes": 100}, {"block_words": 20}):
        out = bpe.encode_decode(df, path, "own", "body", **most)
        assert out.columns == ["own", "ids", "decoded"]
        assert Counter((k, tuple(i), d) for k, i, d in out.collect()) == want


def test_bpe_decode(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = [(1, [320, 49407, 5]), (1, []), (None, None), (2, [10**6, -1, 320, None, 49406])]
    got = bpe.decode(spark.createDataFrame(rows, "k long, i array<int>"), path, "k", "i").collect()
    whole = lambda ids: t.decode(ids, skip_special_tokens=False)
    assert [tuple(r) for r in got] == [(1, whole([320, 49407, 5])), (1, ""), (None, ""), (2, whole([320, 49406]))]


def test_bpe_refuses_other_cuts(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="normalizer"):
        bpe.encode_decode(df, PATH)
