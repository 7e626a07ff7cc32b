"""URL filter: glob rules simulated together as a bit-parallel wildcard automaton.

Rules become globs over the canonical URL ``host + path``. Each glob's positions are bits of one multiword mask
(Shift-And): a step shifts all states of all globs at once, keeps those whose next literal fits the character, and
lets a wildcard's state loop. URLs are simulated side by side in numpy, one character position at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read_table

#: (verdict, host, path prefix): fixed values of the contract
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: globs whose URLs are blocked where no rule fits
BLOCK_GLOBS = ("**spam-farm**", "**cheap-pills**", "**casino**", "**adult-**", "**malware**", "**/ads/**")
#: positions of all globs together; beyond, split the list and filter in several passes
MAX_STATES = 1_000_000
SLICE_BYTES = 64 << 20


@dataclass
class Automaton:
    """Masks of a list of globs: ``*`` a run without ``/``, ``**`` any run, ``?`` one character but ``/``."""

    classes: np.ndarray  # code point -> character class
    step: np.ndarray  # (class, word): states entered by a character of the class
    loop: np.ndarray  # (class, word): wildcard states kept by it
    start: np.ndarray
    final: list[int]  # the final state of each glob

    @classmethod
    def build(cls, globs: list[str]) -> "Automaton":
        letters = sorted({c for g in globs for c in g if c not in "*?"} | {"/"})
        classes = np.zeros(0x110000, np.uint16)
        for k, c in enumerate(letters, 1):
            classes[ord(c)] = k
        slash, first, final, moves, loops = classes[ord("/")], [], [], [], []
        n = 0
        for g in globs:
            first.append(n)
            i = 0
            while i <= len(g):
                if g.startswith("*", i):
                    wide = g.startswith("**", i)
                    loops.append((n, wide))
                    i += 1 + wide
                    continue
                if i < len(g):
                    n += 1
                    moves.append((n, None if g[i] == "?" else classes[ord(g[i])]))
                i += 1
            final.append(n)
            n += 1
        if n > MAX_STATES:
            raise ValueError(f"{n} states; filter by parts of the list instead")
        words = n // 64 + 1
        step = np.zeros((len(letters) + 1, words), np.uint64)
        loop = np.zeros_like(step)
        start = np.zeros(words, np.uint64)
        bit = lambda s: np.uint64(1 << (s & 63))
        not_slash = np.arange(len(step)) != slash
        for s, c in moves:
            step[not_slash if c is None else c, s >> 6] |= bit(s)
        for s, wide in loops:
            loop[slice(None) if wide else not_slash, s >> 6] |= bit(s)
        for s in first:
            start[s >> 6] |= bit(s)
        return cls(classes, step, loop, start, final)

    def run(self, urls: list[str]) -> np.ndarray:
        """(url, glob): whether the whole URL matches."""
        out = np.zeros((len(urls), len(self.final)), bool)
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        room = max(1, SLICE_BYTES // (32 * len(self.start)))
        for at in range(0, len(order), room):
            part = order[at : at + room]
            out[part] = self._slice([urls[i] for i in part], lengths[part])
        return out

    def _slice(self, urls: list[str], lengths: np.ndarray) -> np.ndarray:
        flat = self.classes[np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32)]
        offset = np.cumsum(lengths) - lengths
        state = np.tile(self.start, (len(urls), 1))
        live = len(urls)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(lengths[0]) if live else 0):
            while lengths[live - 1] <= t:
                live -= 1
            c, now = flat[offset[:live] + t], state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[c]) | (now & self.loop[c])
        final = np.array(self.final)
        return (state[:, final >> 6] >> (final & 63).astype(np.uint64)) & one == 1


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``); both empty without ``://``."""
    found = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(found(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), found(2)


def filter_urls(
    df: DataFrame, url: str = "url", key: str = "page_id", rules=RULES, block_globs=BLOCK_GLOBS
) -> DataFrame:
    """Return ``key, host, path, rule, verdict`` for every row.

    The longest fitting rule decides (of equally long ones the first in the list). Where none fits, the URL is blocked
    if a glob of ``block_globs`` matches it, else allowed. A null URL, or one without ``://``, has an empty host and
    path and is allowed. Rows are neither merged nor dropped: repeated and null keys stay. Other columns are ignored.
    """
    if any(c in h + p for _, h, p in rules for c in "*?"):
        raise ValueError("hosts and paths of rules are literal")
    rules = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    names = np.array([h + p for _, h, p in rules] + [None], object)
    globs = [g for _, h, p in rules for g in (f"{h}{p}**", f"*.{h}{p}**")] + list(block_globs)
    verdicts = np.array([v for v, _, _ in rules] + [""], object)
    machine = Automaton.build(globs)

    @F.pandas_udf("rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        hit = machine.run(urls.tolist())
        n = len(rules)
        fits = np.ones((len(hit), n + 1), bool)
        fits[:, :n] = hit[:, 0 : 2 * n : 2] | hit[:, 1 : 2 * n : 2]
        which = fits.argmax(1)
        own = np.where(hit[:, 2 * n :].any(1), "block", "allow")
        return pd.DataFrame({"rule": names[which], "verdict": np.where(which < n, verdicts[which], own)})

    host, path = canonical(F.col(url))
    out = df.select(F.col(key), host.alias("host"), path.alias("path"))
    out = out.withColumn("_j", judge(F.concat("host", "path")))
    return out.select(key, "host", "path", "_j.rule", "_j.verdict")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the fixed rules, else by the default globs."""
    return filter_urls(read_table(spark, sf_dir, "pages"))


def _oracle() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    own = " OR ".join(f"contains(host || path, '{g.replace('*', '')}')" for g in BLOCK_GLOBS)
    return f"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules(v, h, p) AS (VALUES {rules}),
best AS (
  SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN {own} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (n)"""


ORACLE = _oracle()
