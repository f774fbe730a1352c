"""Repeated passages, byte by byte, by suffix arrays.

Every byte that lies in a string of 50 bytes which also starts in a document
with a smaller id is removed. Positions in which two texts can share such a
string are found by minimisers: each window of 50 bytes has an anchor, its
K-byte string of the least hash, and equal windows have equal anchors. A
segment is a run of windows with one anchor; it is what its windows cover.

1. Every task hashes its segments, leaves out those that a smaller document of
   the same task has whole, and deals the rest by the anchor's hash.
2. In each part, a segment that a smaller document has whole goes. Of the others
   one of each kind is left; it is done with if no other segment has its anchor.
3. The bytes of what is left are fetched and dealt by the anchor again; where an
   anchor has many segments, by the anchor and the half of its surroundings that
   each window holds, which splits what frequent strings bring together. Each part
   is concatenated, its suffix array and Burrows-Wheeler transform are built,
   and common prefixes are derived by increasing length: a boundary between
   suffixes at length n gives, by stepping back one byte, the boundaries at
   n + 1. The search stops at 50; suffixes without a boundary between them share
   50 bytes, and all but those of the smallest document are removed.
4. The runs of each document are united and cut out.

Texts that are wholly equal to one of a smaller id are gone from the start. A
null id is greater than all others; null texts are empty. Documents of equal id
don't remove one another's bytes. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import heavy_lookup, pieces, released, sifted, stored, table, trimmed

LENGTH, ANCHOR, PIECE, CHUNK = 50, 24, 1_000_000, 1_000_000
#: An anchor with more open segments than this is dealt by what stands beside it.
HOT = 256
#: Bytes of text for each part that anchors are dealt to.
PART_BYTES = 24_000_000
LAST = 2**63 - 1
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, PIECE * 5 // 4)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, p, np.uint64)])) for p in (_P, _INVERSE)]
    return _powers


def segments(raw: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Text number, start, size, anchor's hash and content's hash of every segment."""
    width = length - anchor + 1
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    buf = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum(lengths) - lengths
    empty = np.empty(0, np.int64)
    if len(buf) < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    up, down = powers(len(buf) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)])])
    grams = mix((sums[anchor:] - sums[:-anchor]) * down[: len(buf) - anchor + 1])
    # Least hash of each window, by doubling.
    least, reach = grams, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(grams) - width + 1], least[width - reach : width - reach + len(grams) - width + 1])
    owner = np.repeat(np.arange(len(raw)), lengths)
    start = np.arange(len(least))
    inside = owner[start] == owner[start + length - 1]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (owner[1 : len(least)] != owner[: len(least) - 1])
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | new[1:]
    a, z = np.nonzero(new)[0], np.nonzero(stop)[0] + length
    content = mix((sums[z] - sums[a]) * down[a] + (z - a).astype(np.uint64))
    d = owner[a]
    return d, a - offsets[d], z - a, least[a], content


#: h is the anchor's hash but for the bits that choose its part. Anchors whose 32 bits are equal only meet once more
#: than needed: contents are told apart by s.
ENTRY = np.dtype([("h", "<u4"), ("s", "<u8"), ("doc", "<i8"), ("key", "<i4"), ("at", "<i4"), ("size", "<i4")])


def packed(e: np.ndarray) -> bytes:
    """Column by column: equal high bytes of neighbours then compress well."""
    return b"".join(np.ascontiguousarray(e[c]).tobytes() for c in ENTRY.names)


def unpacked(b: bytes) -> np.ndarray:
    n, at = len(b) // ENTRY.itemsize, 0
    e = np.empty(n, ENTRY)
    for c in ENTRY.names:
        size = n * ENTRY[c].itemsize
        e[c] = np.frombuffer(b[at : at + size], ENTRY[c])
        at += size
    return e


def smallest(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """e in order of anchor, content and document; and the smallest document of each entry's content."""
    e = e[np.lexsort((e["doc"], e["s"], e["h"]))]
    first = np.ones(len(e), bool)
    first[1:] = (e["h"][1:] != e["h"][:-1]) | (e["s"][1:] != e["s"][:-1])
    at = np.nonzero(first)[0]
    return e, np.repeat(e["doc"][at], np.diff(np.append(at, len(e))))


RUNS = "kind int, doc long, key int, at int, size int, h long"


def run_rows(kind: int, e: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(e), kind, np.int32)), pa.array(e["doc"]), pa.array(e["key"]), pa.array(e["at"]), pa.array(e["size"]), pa.array(e["h"].astype(np.int64) if kind else np.zeros(len(e), np.int64))], names=["kind", "doc", "key", "at", "size", "h"])


def gone_and_open(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of RUNS: kind 0, bytes to remove; 1, segments whose bytes must be compared; 2, those of anchors that have many. docs: doc, key, text."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            e, least = smallest(np.concatenate(held))
            whole = e["doc"] > least
            done = e[whole]
            rows = [(int(p), packed(e2), 1) for p, e2 in by_part(e[~whole], parts)] + [(int(p), packed(e2), 0) for p, e2 in by_part(done, parts)]
            for k in range(0, len(rows), 64):
                p, b, kind = zip(*rows[k : k + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(kind, pa.int32()), pa.array(b, pa.binary())], names=["part", "kind", "entries"])

        for b in pieces(batches, PIECE):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(2).to_pylist()]
            d, at, n, h, s = segments(raw)
            e = np.empty(len(d), ENTRY)
            ids, keys = (np.array(b.column(c).to_pylist(), np.int64) for c in (0, 1))
            e["h"], e["s"], e["doc"], e["key"], e["at"], e["size"] = h & np.uint64(0xFFFFFFFF), s, ids[d], keys[d], at, n
            held.append(e)
            size += len(e)
            if size > 1_000_000:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()
        held.clear()
        trimmed()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for part, kind, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                e = unpacked(data)
                if kind == 0:
                    yield run_rows(0, e)
                else:
                    of.setdefault(part, []).append(e)
        for part in list(of):
            e, least = smallest(np.concatenate(of.pop(part)))
            gone = e["doc"] > least
            if gone.any():
                yield from (run_rows(0, x) for x in cut(e[gone]))
            e = e[~gone]
            # Of what is left, anchors with one content only are done with.
            h, s = e["h"], e["s"]
            new_h, new_s = np.ones(len(e), bool), np.ones(len(e), bool)
            new_h[1:] = h[1:] != h[:-1]
            new_s[1:] = new_h[1:] | (s[1:] != s[:-1])
            group = np.cumsum(new_h) - 1
            kinds = np.bincount(group, new_s)[group] if len(e) else group
            for kind, some in ((1, (kinds > 1) & (kinds <= HOT)), (2, kinds > HOT)):
                if some.any():
                    yield from (run_rows(kind, x) for x in cut(e[some]))
        trimmed()

    dealt = docs.select("doc", "key", "text").mapInArrow(deal, "part int, kind int, entries binary")
    return dealt.repartition(parts, "part").mapInArrow(settle, RUNS)


def cut(e: np.ndarray, n: int = 200_000) -> Iterator[np.ndarray]:
    for k in range(0, len(e), n):
        yield e[k : k + n]


def by_part(e: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    p = (mix(e["h"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((e["at"], e["key"], e["doc"], p))
    e, p = e[order], p[order]
    at = np.searchsorted(p, np.arange(parts + 1))
    for i in range(parts):
        if at[i] < at[i + 1]:
            yield i, e[at[i] : at[i + 1]]


# --- suffix arrays ---------------------------------------------------------


#: No UTF-8 text has this byte. A string that holds it is not looked for, so ends need not differ.
END = 0xFF


def suffix_array(buf: np.ndarray, least: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The places of buf in order of their first ``least`` bytes or more, and how many bytes each shares with the one before it: 0 to 7, or 8 for more.

    Begins with eight bytes, packed into one number, and doubles. Nothing is told from what comes after ``least``.
    """
    n, step = len(buf), 8
    packed_ = np.frombuffer(buf.tobytes() + bytes([END]) * 8, np.uint8).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | packed_[k : k + n]
    order = np.argsort(key)
    in_order = key[order]
    differ = in_order[1:] ^ in_order[:-1]
    same = np.full(n, 8, np.int8)
    same[:1] = 0
    for k in range(8):
        same[1:] -= differ >= np.uint64(1 << 8 * k)
    new = np.concatenate([[False], differ != 0])
    while True:
        number = np.cumsum(new, dtype=np.int64)
        if step >= least or n == 0 or number[-1] == n - 1:
            return order, same
        rank = np.empty(n, np.int64)
        rank[order] = number
        key = rank * (n + 1)
        key[: max(n - step, 0)] += rank[step:] + 1
        order = np.argsort(key)
        in_order = key[order]
        new = np.concatenate([[False], in_order[1:] != in_order[:-1]])
        step *= 2


def shared_prefixes(order: np.ndarray, same: np.ndarray, least: int) -> np.ndarray:
    """For each suffix in order: does it share ``least`` symbols with the one before it? Given are lengths to 7."""
    n = len(order)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    boundary = np.where(same < 8, same, least).astype(np.int16)
    np.minimum(boundary, least, out=boundary)
    open_ = np.nonzero(boundary == least)[0]
    # The transform in reverse: where each suffix's next one stands.
    following = lambda at: place[np.minimum(order[at] + 1, n - 1)]
    here, before = following(open_), following(open_ - 1)
    for size in range(7, least - 1):
        if not len(open_):
            break
        seen = np.cumsum(boundary == size, dtype=np.int32)
        # Stepping back one symbol: a boundary between the next suffixes is one here, a symbol later.
        hit = seen[here] > seen[before]
        boundary[open_[hit]] = size + 1
        stay = ~hit
        open_, here, before = open_[stay], here[stay], before[stay]
    return boundary == least


def repeated(parts: list[bytes], doc: np.ndarray, least: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part, start and end of the runs covered by strings of ``least`` bytes that a part of a smaller document has."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    end = bytes([END])
    buf = np.frombuffer(end.join([*parts, b""]), np.uint8)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    order, same = suffix_array(buf, least)
    first = ~shared_prefixes(order, same, least)
    at = np.nonzero(first)[0]
    mine = owner[order]
    small = np.repeat(np.minimum.reduceat(doc[mine], at), np.diff(np.append(at, len(order))))
    gone = order[(doc[mine] > small) & (ends[mine] - order >= least)]
    # An end is never covered, so runs of two parts don't touch.
    cover = np.bincount(gone, minlength=len(buf) + 1) - np.bincount(gone + least, minlength=len(buf) + 1)
    covered = np.concatenate([[False], np.cumsum(cover)[: len(buf)] > 0, [False]])
    a, z = np.nonzero(covered[1:] & ~covered[:-1])[0], np.nonzero(covered[:-1] & ~covered[1:])[0]
    begin = (ends - sizes)[owner[a]]
    return owner[a], a - begin, z - begin


def beside(raw: bytes, h: int, length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[tuple[int, int, bytes]]:
    """A segment as smaller ones, each with a key of its own: key, start, bytes.

    A window has half of what is not its anchor on the anchor's left or on its
    right. Its key is the anchor with that half; equal windows have equal keys.
    """
    up, down = powers(len(raw) + 1)
    buf = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(buf * up[: len(raw)])])
    grams = mix((sums[anchor:] - sums[:-anchor]) * down[: len(raw) - anchor + 1])
    at = np.nonzero(grams & np.uint64(0xFFFFFFFF) == np.uint64(h))[0]
    starts, half = np.arange(len(raw) - length + 1), (length - anchor) // 2
    place = at[np.searchsorted(at, starts)]
    left = place - starts >= half
    first = np.ones(len(starts), bool)
    first[1:] = (place[1:] != place[:-1]) | (left[1:] != left[:-1])
    begin = np.nonzero(first)[0]
    for a, z in zip(begin.tolist(), [*begin[1:].tolist(), len(starts)], strict=True):
        p = int(place[a])
        context = b"L" + raw[p - half : p + anchor] if left[a] else b"R" + raw[p : p + anchor + half]
        yield int.from_bytes(hashlib.blake2b(context, digest_size=8).digest(), "little", signed=True), a, raw[a : z - 1 + length]


def compared(docs: DataFrame, open_: DataFrame, parts: int) -> DataFrame:
    """Rows of RUNS to remove, from the bytes of open segments."""
    lists = open_.groupBy("doc", "key").agg(F.collect_list(F.struct("h", "at", "size", "kind")).alias("found"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, PIECE):
            rows = []
            for doc, key, found, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                for f in found:
                    part = raw[f["at"] : f["at"] + f["size"]]
                    if f["kind"] == 1:
                        rows.append((doc, key, f["h"], [f["at"]], part))
                        continue
                    # A text that repeats itself has the same piece again and again: one row for all its places.
                    places: dict[tuple[int, bytes], list[int]] = {}
                    for k, at, x in beside(part, f["h"]):
                        places.setdefault((k, x), []).append(f["at"] + at)
                    rows += [(doc, key, k, ats, x) for (k, x), ats in places.items()]
            for k in range(0, len(rows), 100_000):
                cols = list(zip(*rows[k : k + 100_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary()), strict=True)], names=["doc", "key", "h", "at", "bytes"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of h; a chunk holds whole anchors."""
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            # Equal segments of one anchor are one part, that of the smallest document, which comes first. In the others
            # every string starts in that document too.
            parts: dict[tuple[int, bytes], int] = {}
            part = np.array([parts.setdefault((r[2], r[4]), len(parts)) for r in held], np.int64)
            doc, key, places, size = (np.array([f(r) for r in held], np.int64) for f in (lambda r: r[0], lambda r: r[1], lambda r: len(r[3]), lambda r: len(r[4])))
            at, begin = np.array([x for r in held for x in r[3]], np.int64), np.cumsum(places) - places
            first = np.full(len(parts), LAST, np.int64)
            np.minimum.at(first, part, doc)
            copy = doc > first[part]
            p, a, z = repeated([b for _, b in parts], first)
            of = np.nonzero(~copy)[0]
            of = of[np.argsort(part[of], kind="stable")]
            lo, hi = np.searchsorted(part[of], p, "left"), np.searchsorted(part[of], p, "right")
            n = hi - lo
            row = of[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            a, z = np.repeat(a, n), np.repeat(z, n)
            whole = np.nonzero(copy)[0]
            row, a, z = np.concatenate([row, whole]), np.concatenate([a, np.zeros(len(whole), np.int64)]), np.concatenate([z, size[whole]])
            n = places[row]
            of = np.repeat(begin[row], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, a, z, at = np.repeat(row, n), np.repeat(a, n), np.repeat(z, n), at[of]
            cols = (np.zeros(len(row), np.int32), doc[row], key[row], at + a, z - a, np.zeros(len(row), np.int64))
            for k in range(0, len(row), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 200_000], t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["kind", "doc", "key", "at", "size", "h"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size > CHUNK and row[2] != held[-1][2]:
                    yield from out()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield from out()
        held.clear()
        trimmed()

    some = sifted(docs, open_.select("doc", "key").distinct(), ["doc", "key"])
    pieces_ = some.join(lists, ["doc", "key"]).select("doc", "key", "found", "text").mapInArrow(fetch, "doc long, key int, h long, at array<int>, bytes binary")
    return pieces_.repartition(parts, "h").sortWithinPartitions("h", "doc", "at").mapInArrow(search, RUNS)


def without_repeats(docs: DataFrame, clean: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; and, if clean, kept (binary)."""
    spark = docs.sparkSession
    node = F.sha1(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.unhex(node).alias("same"), F.conv(F.substring(node, 16, 7), 16, 10).cast("int").alias("key"), "text")
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    narrow = keyed.select("doc", "key", "same", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    copies, _ = stored(narrow.groupBy("same").agg(F.min("doc").alias("least"), F.count("*").alias("n")).where("n > 1"), "copies")
    runs, _ = stored(gone_and_open(keyed.select("doc", "key", "text"), parts), "runs")
    released(spark)
    more, _ = stored(compared(keyed.select("doc", "key", "text"), runs.where("kind > 0"), parts), "more-runs")
    released(spark)
    # A text that is equal to one of a smaller id is one run.
    whole = heavy_lookup(narrow.where(F.col("size") >= LENGTH), copies, "same", "n").where("doc > least").select("doc", "key", F.lit(0).alias("at"), "size")
    every = runs.where("kind = 0").unionByName(more).select("doc", "key", "at", "size").unionByName(whole).groupBy("doc", "key").agg(F.collect_list(F.struct("at", "size")).alias("runs"))
    work = keyed.select("doc_id", "doc", "key", "text").join(every, ["doc", "key"], "left").select("doc_id", "runs", "text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, PIECE):
            rows = []
            for doc_id, found, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw, keep, last, n = (text or "").encode("utf-8", "surrogatepass"), [], 0, 0
                for at, end in sorted((f["at"], f["at"] + f["size"]) for f in found or ()):
                    if n == 0 or at > last:
                        keep.append(raw[last:at])
                        n += 1
                    last = max(last, end)
                keep.append(raw[last:])
                left = b"".join(keep)
                rows.append((doc_id, len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest(), left if clean else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = work.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done if clean else done.drop("kept")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
