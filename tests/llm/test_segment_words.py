"""Words of letters go to the model itself, marks behind them apart."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chainmart.llm import token_files


def test_words_and_marks_are_encoded_apart(monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENTS", 50)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    s = token_files.Segments(t, "<u4")
    whole, encode = [], s._encoded
    s._encoded = lambda text: (whole.append(text), encode(text))[1]
    rng = np.random.default_rng(8)
    letters, ends = list("abeghinrstTW") + ["é", "ß", "ü", "ƒ", "ɏ", "ɐ", "×", "÷", "º", "µ", "'s", "'ll", "7"], ["", "", ".", ",", "!", "?!", "'", "\n"]
    for _ in range(3000):
        words = ["".join(rng.choice(letters, rng.integers(0, 9))) + rng.choice(ends) for _ in range(rng.integers(0, 9))]
        text = " ".join(words)
        assert np.frombuffer(s.text(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
    assert not any(w.removeprefix(" ").isascii() and w.removeprefix(" ").isalpha() for w in whole)
    before = len(whole)
    s.text("unheard, words. indeed!")
    assert set(whole[before:]) <= {",", ".", "!"}
