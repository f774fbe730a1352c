"""SentencePiece encoding and decoding by suffix-array matching.

A batch of texts is normalised (a space becomes the mark U+2581, one is put in
front) and cut into units, runs of marks with what follows up to the next mark;
no piece reaches over such a cut. The distinct units of the batch that aren't
known yet are concatenated and indexed by a suffix array, whose suffixes end
with their unit and are compared as far as the longest piece. Every piece is
looked up by binary search; its range of suffixes gives the edges (position,
length, piece), which are sorted by position. Then each unit is relaxed: of all
neighbouring symbols that an edge spans together, the edge of the best score is
taken, the leftmost of equals, until none is left. That is the order in which a
BPE vocabulary is defined, and gives the ids of the public library; the shortest
path over summed scores would be right for unigram vocabularies only. Symbols
that are no piece become bytes.

Memory is bounded by the batch and by the number of units remembered. Null texts
give null ids, empty ones none. Any text is restored exactly by decoding, other
than that a text which holds U+2581 itself comes back with spaces there, as with
the library. Repeats and other columns don't matter.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BATCH_BYTES, REMEMBERED, INDEX_CHARS = 3_000_000, 500_000, 200_000
#: Units of more symbols are relaxed by a heap, the others all at once.
LONG_UNIT = 256
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        out = shift = 0
        while True:
            x = b[i]
            i += 1
            out |= (x & 127) << shift
            shift += 7
            if x < 128:
                return out

    while i < len(b):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            n = number() if tag & 7 == 2 else 4 if tag & 7 == 5 else 8
            yield tag >> 3, b[i : i + n]
            i += n


@dataclass
class Vocabulary:
    names: list[str]
    scores: list[float]
    kinds: list[int]  # 1 normal, 2 unknown, 3 control, 6 byte
    dummy_prefix: bool = True

    @staticmethod
    def read(data: bytes) -> Vocabulary:
        out, norm, bpe = Vocabulary([], [], []), {}, 1
        for f, v in _fields(data):
            if f == 1:
                p = dict(_fields(v))
                out.names.append(p[1].decode())
                out.scores.append(struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0])
                out.kinds.append(p.get(3, 1))
            elif f == 2:
                bpe = dict(_fields(v)).get(3, 1)
            elif f == 3:
                norm = dict(_fields(v))
        if bpe != 2 or norm.get(2) or norm.get(4, 1) or 6 not in out.kinds:
            raise ValueError("a BPE vocabulary with byte pieces, no character map and all spaces kept is needed")
        out.dummy_prefix = bool(norm.get(3, 1))
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        normal = [(s, i) for i, (s, k) in enumerate(zip(v.names, v.kinds, strict=True)) if k == 1]
        self.single = {s: i for s, i in normal if len(s) == 1}
        self.bytes = {int(s[3:5], 16): i for i, (s, k) in enumerate(zip(v.names, v.kinds, strict=True)) if k == 6}
        self.alphabet = {c: n + 1 for n, c in enumerate(sorted({c for s, _ in normal for c in s}))}
        self.long = [(s, i) for s, i in normal if len(s) > 1]
        self.most = max(len(s) for s, _ in self.long)
        # Pieces of equal score merge in the order of their places, so ranks of scores are shared.
        order = sorted({v.scores[i] for _, i in self.long}, reverse=True)
        rank = {x: r for r, x in enumerate(order)}
        self.rank = np.full(len(v.names), 1 << 30, np.int64)
        for _, i in self.long:
            self.rank[i] = rank[v.scores[i]]
        self.table = np.zeros(0x110000, np.int32)
        for c, n in self.alphabet.items():
            self.table[ord(c)] = n
        self.single_of = np.full(len(self.alphabet) + 1, -1, np.int64)
        for s, i in self.single.items():
            self.single_of[self.alphabet[s]] = i
        keys = self._rows(np.array([self.table[ord(c)] for s, _ in self.long for c in s.ljust(self.most, "\0")], np.int32).reshape(-1, self.most))
        self.piece_order = np.argsort(keys, kind="stable")
        self.piece_keys = keys[self.piece_order]
        self.piece_ids = np.array([i for _, i in self.long], np.int64)[self.piece_order]
        self.piece_sizes = np.array([len(s) for s, _ in self.long], np.int64)[self.piece_order]
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _rows(codes: np.ndarray) -> np.ndarray:
        """Rows of codes as byte strings of the same order. Two digits to base 255 hold a code, 0 stands for nothing."""
        out = np.zeros((*codes.shape, 2), np.uint8)
        out[..., 0] = np.where(codes > 0, 1 + codes // 255, 0)
        out[..., 1] = np.where(codes > 0, 1 + codes % 255, 0)
        return np.ascontiguousarray(out.reshape(len(codes), -1)).view(f"S{2 * codes.shape[1]}").ravel()

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """codes: symbols of concatenated units, 0 at ends and where no piece can be. Sorted keys position * 64 + length, and piece ids."""
        n, most = len(codes), self.most
        window = np.zeros((n, most), np.int32)
        live = np.ones(n, bool)
        for k in range(min(most, n)):
            window[: n - k, k] = codes[k:] if k == 0 else np.where(live[: n - k], codes[k:], 0)
            live[: n - k] &= codes[k:] > 0
            live[n - k :] = False
        suffixes = self._rows(window)
        array = np.argsort(suffixes, kind="stable")
        ordered = suffixes[array]
        low = np.searchsorted(ordered, self.piece_keys, "left")
        # The range ends before the first suffix that is greater than the piece followed by anything.
        width = 2 * most
        upper = self.piece_keys.view(np.uint8).reshape(-1, width).copy()
        upper[np.arange(width)[None, :] >= 2 * self.piece_sizes[:, None]] = 255
        high = np.searchsorted(ordered, np.ascontiguousarray(upper).view(f"S{width}").ravel(), "right")
        count = high - low
        which = np.repeat(np.arange(len(count)), count)
        at = array[np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
        keys = at * 64 + self.piece_sizes[which]
        order = np.argsort(keys, kind="stable")
        return keys[order], self.piece_ids[which][order]

    def relax(self, codes: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ids of the symbols that are left; id -1: no piece. unit: the unit of each position, ascending; -1 at ends."""
        keys, ids = self.edges(codes)
        start = np.nonzero(unit >= 0)[0]
        sid = self.single_of[codes[start]]
        size = np.ones(len(start), np.int64)
        owner = unit[start]

        def merged(i: np.ndarray, start: np.ndarray, size: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Piece and rank of symbol i with the next one."""
            j = i + 1
            inside = j < len(start)
            j = np.where(inside, j, i)
            inside &= owner[j] == owner[i]
            key = start[i] * 64 + np.minimum(size[i] + size[j], 63)
            at = np.searchsorted(keys, key) if len(keys) else np.zeros(len(i), np.int64)
            at = np.minimum(at, max(0, len(keys) - 1))
            good = inside & (keys[at] == key) & (size[i] + size[j] <= self.most) if len(keys) else np.zeros(len(i), bool)
            piece = np.where(good, ids[at] if len(keys) else 0, -1)
            return piece, np.where(good, self.rank[piece], 1 << 30)

        piece, rank = merged(np.arange(len(start)), start, size, owner)
        done_start, done_id = [], []
        length = np.bincount(owner) if len(owner) else np.zeros(0, np.int64)
        if len(length) and length.max() > LONG_UNIT:
            far = length[owner] > LONG_UNIT
            for u in np.nonzero(length > LONG_UNIT)[0].tolist():
                a, z = np.searchsorted(owner, [u, u + 1])
                s, i = self._by_heap(keys, ids, start[a:z], sid[a:z], piece[a:z], rank[a:z])
                done_start.append(s)
                done_id.append(i)
            start, sid, size, owner, piece, rank = (x[~far] for x in (start, sid, size, owner, piece, rank))
        while len(start):
            first = np.nonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))[0]
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(start)))
            active = np.repeat(least < 1 << 30, length)
            if not active.all():
                done_start.append(start[~active])
                done_id.append(sid[~active])
                start, sid, size, owner, piece, rank = (x[active] for x in (start, sid, size, owner, piece, rank))
                if not len(start):
                    break
                first = np.nonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))[0]
                least = np.minimum.reduceat(rank, first)
                length = np.diff(np.append(first, len(start)))
            hit = np.nonzero(rank == np.repeat(least, length))[0]
            # The leftmost of each unit.
            hit = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])]
            sid[hit] = piece[hit]
            size[hit] += size[hit + 1]
            keep = np.ones(len(start), bool)
            keep[hit + 1] = False
            new = np.cumsum(keep) - 1
            start, sid, size, owner, piece, rank = (x[keep] for x in (start, sid, size, owner, piece, rank))
            changed = np.concatenate([new[hit], (before := new[hit] - 1)[before >= 0]])
            piece[changed], rank[changed] = merged(changed, start, size, owner)
        if not done_start:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        s, i = np.concatenate(done_start), np.concatenate(done_id)
        order = np.argsort(s, kind="stable")
        return s[order], i[order]

    def _by_heap(self, keys: np.ndarray, ids: np.ndarray, start: np.ndarray, sid: np.ndarray, piece: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``relax`` for one long unit: a heap of pairs by rank and place, and linked neighbours, so time is near to linear."""
        n, edge, ranks, most = len(start), memoryview(keys), self.rank, self.most
        good = np.nonzero(piece >= 0)[0]
        heap = list(zip(rank[good].tolist(), good.tolist(), [2] * len(good), piece[good].tolist(), strict=True))
        heapq.heapify(heap)
        at, own, size = start.tolist(), sid.tolist(), [1] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = bytearray(n)

        def push(i: int) -> None:
            j = after[i]
            if j < n and (total := size[i] + size[j]) <= most:
                key = at[i] * 64 + total
                k = bisect.bisect_left(edge, key)
                if k < len(edge) and edge[k] == key:
                    p = int(ids[k])
                    heapq.heappush(heap, (int(ranks[p]), i, total, p))

        while heap:
            _, i, total, p = heapq.heappop(heap)
            if gone[i] or (j := after[i]) >= n or size[i] + size[j] != total:
                continue
            own[i], size[i], after[i] = p, total, after[j]
            gone[j] = 1
            if after[i] < n:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        left = np.frombuffer(gone, np.uint8) == 0
        return start[left], np.array(own, np.int64)[left]

    def learn(self, units: list[str]) -> None:
        """Remembers the ids of units that aren't known yet."""
        some: list[str] = []
        size = 0
        for u in units:
            some.append(u)
            size += len(u) + 1
            if size >= INDEX_CHARS:
                self._learn(some)
                some, size = [], 0
        if some:
            self._learn(some)

    def _learn(self, units: list[str]) -> None:
        points = np.frombuffer("\0".join([*units, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(sizes + 1) - 1
        unit = np.repeat(np.arange(len(units)), sizes + 1)
        unit[ends] = -1
        codes = self.table[points]
        codes[ends] = 0
        starts, ids = self.relax(codes, unit)
        bounds = np.searchsorted(starts, np.concatenate([[0], ends + 1]))
        odd = np.zeros(len(units), bool)
        odd[unit[starts[ids < 0]]] = True
        flat, at = ids.astype("<i4").tobytes(), (4 * bounds).tolist()
        self.known.update(zip(units, (flat[a:b] for a, b in zip(at, at[1:], strict=False)), strict=True))
        for k in np.nonzero(odd)[0].tolist():
            out: list[int] = []
            for s, i in zip(starts[bounds[k] : bounds[k + 1]].tolist(), ids[bounds[k] : bounds[k + 1]].tolist(), strict=True):
                out += [i] if i >= 0 else [self.bytes[x] for x in chr(points[s]).encode("utf-8", "surrogatepass")]
            self.known[units[k]] = np.array(out, "<i4").tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [_UNIT.findall((MARK if self.vocabulary.dummy_prefix else "") + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {u for units in cut for u in units if u not in self.known}
        if len(self.known) > REMEMBERED:
            self.known.clear()
            new = {u for units in cut for u in units}
        self.learn(list(new))
        of = self.known.__getitem__
        return [None if t is None else np.frombuffer(b"".join(map(of, units)), "<i4") for t, units in zip(texts, cut, strict=True)]

    def decode(self, ids: np.ndarray | None) -> str | None:
        if ids is None:
            return None
        if not hasattr(self, "_as_bytes"):
            v = self.vocabulary
            self._as_bytes = [bytes([int(s[3:5], 16)]) if k == 6 else s.replace(MARK, " ").encode() if k == 1 else b"" for s, k in zip(v.names, v.kinds, strict=True)]
        out = b"".join(map(self._as_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return out[1:] if self.vocabulary.dummy_prefix and out.startswith(" ") else out


def pieces_of(docs: DataFrame, vocabulary: str = VOCABULARY, ids: bool = False) -> DataFrame:
    """docs with, instead of the text, n_pieces, n_bytes (pieces that are bytes), ids_sha256 (little-endian 32-bit ids), round_trip; and ids if asked for.

    ``vocabulary`` is a file on the driver; its half a megabyte is broadcast.
    """
    with open(vocabulary, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    def make():
        encoder = Encoder(Vocabulary.read(data.value))
        low, high = min(encoder.bytes.values()), max(encoder.bytes.values())

        def of(texts: list) -> list:
            rows = []
            for text, found in zip(texts, encoder.encode(texts), strict=True):
                if found is None:
                    row = (None, None, None, None)
                else:
                    row = (len(found), int(((found >= low) & (found <= high)).sum()), hashlib.sha256(found.tobytes()).hexdigest(), encoder.decode(found) == text.replace(MARK, " "))
                rows.append((*row, None if found is None else found.tolist()) if ids else row)
            return list(zip(*rows, strict=True))

        return of

    out = {"n_pieces": "long", "n_bytes": "long", "ids_sha256": "string", "round_trip": "boolean"} | ({"ids": "array<long>"} if ids else {})
    return map_texts(docs, make, out, BATCH_BYTES)


def decoded(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The column ``ids`` decoded to ``text``."""
    from pyspark.sql.functions import pandas_udf

    with open(vocabulary, "rb") as f:
        data = encoded.sparkSession.sparkContext.broadcast(f.read())

    def decode(batches):
        encoder = Encoder(Vocabulary.read(data.value))
        for ids in batches:
            yield ids.map(lambda x: None if x is None else encoder.decode(np.asarray(x)))

    import pandas as pd

    decode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return encoded.withColumn("text", pandas_udf(decode, "string")(F.col("ids")))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_of(table(spark, sf_dir, "documents").select("doc_id", "text"))
