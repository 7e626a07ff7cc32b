"""What a worker remembers: common keys outlive those that come once, and results do not depend on it."""

from chainmart.llm import toxicity
from chainmart.llm.common import Remembered


class Counted(Remembered):
    def __init__(self, most):
        super().__init__(most)
        self.made = []

    def make(self, key):
        self.made.append(key)
        return key


def test_a_common_key_is_made_once():
    seen = Counted(10)
    for i in range(1000):
        assert seen["common"] == "common" and seen[i] == i
        assert len(seen) <= 10 and len(seen.before) <= 10
    assert seen.made.count("common") == 1


def test_distances_do_not_depend_on_what_is_kept(monkeypatch):
    words = [b"w%d" % (i * i % 97) for i in range(500)]
    model = [b"hateful words here " * 20, b"plain words there " * 20]
    whole = toxicity.Distance(*model)
    monkeypatch.setattr(toxicity, "CACHE", 5)
    small = toxicity.Distance(*model)
    made, make = [], small.make
    small.make = lambda w: (made.append(w), make(w))[1]
    for w in words:
        assert small[b"common"] == whole[b"common"] and small[w] == whole[w]
    assert made.count(b"common") == 1
