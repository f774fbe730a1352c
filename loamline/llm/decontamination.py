"""Benchmark decontamination by a generalised suffix automaton.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case. All
items go into one automaton over words. The words of a text are streamed through
it, which tracks the longest suffix that some item contains. Where that reaches
13 words, or ends in the whole of an item that is shorter, those words are hit.

The automaton is built on the driver and broadcast. It takes ``BLOCK_WORDS``
words of items at most; more items are dealt to several automata, which are
applied one after the other, and their hits are united.

Null texts have no words; items without words match nothing. Items with a null
id count for hits but not in ``n_items``. Repeated items and rows change nothing
but the number of rows. Texts of any length are streamed in whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, table, whole_rows, with_text

WINDOW, COVERAGE = 13, 20
#: Words of items in one automaton: bounds what is sent to the driver and broadcast.
BLOCK_WORDS = 400_000
MATCH_BYTES = 4_000_000

_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class Automaton:
    """Suffix automaton of all items; each state knows the items that hold its strings."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        held: dict[int, set[str]] = {}
        whole: dict[int, set[int]] = {}
        for name, words in items:
            last = 0
            for w in words:
                last = self._add(last, w)
        for name, words in items:
            state = 0
            for w in words:
                state = self.next[state][w]
                # Only strings of a window or more are asked for their items.
                if self.length[state] >= window:
                    held.setdefault(state, set())
                    if name is not None:
                        held[state].add(name)
            if 0 < len(words) < window:
                whole.setdefault(state, set()).add(len(words))
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if s in held and self.length[self.link[s]] >= window:
                held.setdefault(self.link[s], set()).update(held[s])
        # What a match that ends in a state can contain: the state of its last `window` words, and short items.
        self.long: list[int] = [0] * len(self.length)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[s]
            self.long[s] = s if self.length[up] < window <= self.length[s] else self.long[up]
            self.short[s] = (*((n, s) for n in sorted(whole.get(s, ()))), *self.short[up])
        self.items = {s: frozenset(x) for s, x in held.items()}
        # A short item's state also holds longer strings' items; only whole items count there.
        self.whole_items: dict[tuple[int, int], frozenset[str]] = {}
        for name, words in items:
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][w]
                key = (len(words), state)
                self.whole_items[key] = self.whole_items.get(key, frozenset()) | ({name} if name is not None else frozenset())

    def _add(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            clone = self._state(length[last] + 1, dict(nxt[q]), link[q])
            link[q] = clone
            while last >= 0 and nxt[last].get(w) == q:
                nxt[last][w] = clone
                last = link[last]
            return clone
        new, p = self._state(length[last] + 1, {}, 0), last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = self._state(length[p] + 1, dict(nxt[q]), link[q])
                link[q] = link[new] = clone
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
        return new

    def _state(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words, sorted and apart, and the items with windows in them."""
        nxt, link, length, long, short, window = self.next, self.link, self.length, self.long, self.short, self.window
        root, state, n = nxt[0], 0, 0
        spans: list[list[int]] = []
        found: set[str] = set()
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            if to is None:
                if w not in root:
                    state = n = 0
                    continue
                while to is None:
                    state = link[state]
                    to = nxt[state].get(w)
                n = length[state]
            state = to
            n += 1
            start = -1
            if n >= window:
                s = state
                while length[link[s]] >= n:
                    s = link[s]
                found |= self.items[long[s]]
                start = i + 1 - window
            for m, s in short[state]:
                if m <= n:
                    found |= self.whole_items[(m, s)]
                    start = min(start, i + 1 - m) if start >= 0 else i + 1 - m
            if start >= 0:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return [(a, b) for a, b in spans], found


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def automata(spark: SparkSession, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator:
    """Broadcast automata, each of about block_words words of items."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (block_words * 2)))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield spark.sparkContext.broadcast(Automaton([(r[0], w) for r in rows if (w := words_of(r[1]))], window))


OUT = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}


def matched(docs: DataFrame, benchmark: DataFrame, clean: bool = False, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with, instead of the text, n_words, n_hit, n_items, items_sha256, contaminated; and, if clean, clean_text without hit spans.

    Of several automata a worker holds one at a time: each is read from the broadcast's file, goes over a batch of
    texts, and gives way to the next.
    """
    found = list(automata(docs.sparkSession, benchmark, block_words=block_words))

    def make():
        own = found[0].value if len(found) == 1 else None

        def of(texts: list) -> list:
            out, every = [], [words_of(text) for text in texts]
            hits: list[tuple[list, set]] = [([], set())] * len(every)
            for block in found:
                a = own or block.load_from_path(block._path)
                for k, words in enumerate(every):
                    s, i = a.match(words)
                    if s:
                        hits[k] = (united(hits[k][0] + s), hits[k][1] | i)
                del a
            for text, words, (spans, items) in zip(texts, every, hits, strict=True):
                hit = sum(b - a for a, b in spans)
                row = (len(words), hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0 and coverage * hit >= len(words))
                out.append((*row, without(text, spans)) if clean else row)
            return list(zip(*out, strict=True))

        return of

    return map_texts(docs, make, OUT | ({"clean_text": "string"} if clean else {}), MATCH_BYTES if len(found) == 1 else 16 * MATCH_BYTES)


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans:
        return text
    at = [m.span() for m in _WORD.finditer(text)]
    keep, last = [], 0
    for a, b in spans:
        keep.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join(keep) + text[last:]


def decontaminated(docs: DataFrame, benchmark: DataFrame, most: float = 0.5) -> DataFrame:
    """docs without hit spans. A document of which the share ``most`` of its words is hit goes as a whole."""
    out = matched(whole_rows(docs), benchmark, clean=True).where(~((F.col("n_hit") > 0) & (F.col("n_hit") >= F.lit(most) * F.col("n_words"))))
    return with_text(out, docs.schema, "clean_text")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return matched(docs, table(spark, sf_dir, "benchmark"))
