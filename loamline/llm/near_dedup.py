"""Near-duplicate classes by ProbMinHash.

Shingles are runs of five words (``[^\\x20\\x09-\\x0D]+``; a text of one to four words
is one shingle). Equal texts are one node, found by their hash. A text's
shingles weigh 1 + ln(times). Each sends Poisson arrivals at the rate of its
weight to random registers of the signature and stops once it is later than
every register; a register keeps the shingle that came first, so registers of
two texts agree with the probability Jaccard of the weighted sets. Bands of five
registers give buckets. As links are defined on sets without weights, a text with
repeated shingles has the bands of weight 1 beside the weighted ones; without
repeats the two are the same. Nodes in a bucket are candidates, and a candidate pair
is a link if the Jaccard similarity of the two shingle sets is at least 0.8,
computed exactly. Classes are the connected components of the links.

Buckets of up to ``SMALL`` nodes, in later rounds ``LATER``, are compared in all pairs.
Larger ones with the same most central node (at first, whose bands are the most
common) are a group. Its consensus C is the set of shingles that most of a few
members have; its centre c is the member nearest to C. Every node x is compared
with C, and by what it has beside C and lacks of it with c. Of the other pairs

* those that both link with c are in one class and need no comparison;
* with i = ``|x & C|``, x needs ``0.8 |x| - i`` common shingles outside C with any text
  similar to it, and ``8/9 |x| - i`` with one that is not smaller. If that is positive,
  x and y share one of the first ``|x - C| - need + 1`` shingles of x - C, in any fixed
  order: by hashes, those that many have last. Each is a new bucket;
* else all of x - C are new buckets. A pair that shares none of them has at most
  ``|C| - |C - x| - |C - y| + |C - x - y|`` shingles in common, which gives a number of
  shingles of C that both must lack: the first of C - x are new buckets likewise. Where
  that number is none, the pair meets in a bucket of its size class.

New buckets in which every node links with c are done with, and where few do not,
these are compared with all; the others are small or groups in turn. What many unlike texts have in common, such as a frequent line or
passage, is in C, so it makes no further bucket; copies with many changes find no
partner by what they changed. Hence no pair of a bucket is lost, and the work follows
the members of buckets, not their pairs; what is left after ``LEVELS`` rounds is compared
in all pairs. The links compared are those needed to connect classes, not all.

A missed link needs a pair at 0.8 that shares no band: about 7 in 100,000 by the
bands of weight 1 alone, whatever is repeated.
Null texts, and texts without words other than equal ones, are in no class but
their own. A class is named by its smallest id (null if it has none). Repeated
rows are in one class, each with a row of the result. Extra columns are left out by
``classes`` and kept by ``one_of_each``, whatever their names. Of an empty table the
result is empty. Long texts are read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, heavy_lookup, map_texts, sifted, stored, table

SHINGLE, BANDS, ROWS, THRESHOLD, SMALL, PIECE = 5, 25, 5, 0.8, 16, 1_000_000
#: Buckets of later rounds, in which few texts are left, that are compared in all pairs.
LATER = 64
#: If so many nodes of a larger one do not link with the centre, they are compared with all.
FEW = 32
#: About so many members of a group vote on its consensus; any set would give the same classes.
VOTES = 9
#: After so many rounds of centres, what is left of a bucket is compared in all pairs.
LEVELS = 12
LAST, BATCH_ROWS = 2**63 - 1, 1000
REGISTERS = BANDS * ROWS
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
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


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct shingles, ordered by the first two."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    offsets = np.cumsum(lengths + 1) - lengths  # each text follows a space
    buf = np.frombuffer(b" " + b" ".join([*raw, b""]), np.uint8)
    space = _SPACE[buf]
    starts, ends = np.nonzero(space[:-1] & ~space[1:])[0] + 1, np.nonzero(~space[:-1] & space[1:])[0] + 1
    up, down = powers(len(buf))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)])])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(owner, minlength=len(raw))
    # A window begins at each word that has four more in its text, and at the first of a shorter text.
    place = np.arange(len(words)) - (np.cumsum(counts) - counts)[owner]
    left = counts[owner] - place
    begin = np.nonzero((left >= size) | (place == 0))[0]
    span = np.minimum(size, counts[owner[begin]])
    h = np.zeros(len(begin), np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        h = mix(h * _P + np.where(k < span, padded[begin + k], np.uint64(k)))
    d = owner[begin]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.nonzero(first)[0]
    return d[at], h[at], np.diff(np.append(at, len(h)))


def signatures(d: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """For each of n texts, the shingle that came first to each register; 0 for texts without shingles."""
    when, who = np.full(n * registers, np.inf), np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    t, j = np.zeros(len(h)), 0
    while len(h):
        j += 1
        x = mix(h + np.uint64(j * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        t = t - np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        early = t < latest[d]
        if not early.all():
            d, h, weight, t, x = d[early], h[early], weight[early], t[early], x[early]
        if not len(h):
            break
        slot = d * registers + (mix(x) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(when, slot, t)
        won = when[slot] == t
        who[slot[won]] = h[won]
        latest = when.reshape(n, registers).max(1)
        live = t < latest[d]
        if not live.all():
            d, h, weight, t = d[live], h[live], weight[live], t[live]
    return who.reshape(n, registers)


def bands_of(texts: list[str | None]) -> tuple[list[list[int] | None], list[int]]:
    """Band values, null without words, and the number of shingles of each text.

    Values of weight 1 follow the weighted ones; those equal to them are null, or left out if all are.
    """
    d, h, count = shingles(texts)
    size = np.bincount(d, minlength=len(texts))
    rows = band_values(signatures(d, h, 1 + np.log(count), len(texts)))
    out = [row if n else None for row, n in zip(rows.view(np.int64).tolist(), size, strict=True)]
    again = np.unique(d[count > 1])
    if len(again):
        mine = np.isin(d, again)
        plain = band_values(signatures(np.searchsorted(again, d[mine]), h[mine], np.ones(int(mine.sum())), len(again)))
        for i, row, same in zip(again.tolist(), plain.view(np.int64).tolist(), (plain == rows[again]).tolist(), strict=True):
            if not all(same):
                out[i] += [None if s else v for v, s in zip(row, same, strict=True)]
    return out, size.tolist()


def band_values(sig: np.ndarray) -> np.ndarray:
    x = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), 1))
    parts = sig.reshape(len(sig), BANDS, ROWS)
    for k in range(ROWS):
        x = mix(x * _P + parts[:, :, k])
    return x


def node() -> F.Column:
    return F.unhex(F.sha1(F.col("text").cast("binary")))


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes, for the given nodes (node, first_id), read from one row of each."""
    rows = docs.where("text is not null").select(node().alias("node"), F.col("doc_id").alias("first_id"), "text")
    rows = sifted(rows, nodes, "node")
    one = rows.join(nodes, (rows["node"] == nodes["node"]) & rows["first_id"].eqNullSafe(nodes["first_id"]), "left_semi").select("node", "text")

    def make():
        def of(texts: list) -> list:
            d, h, _ = shingles(texts)
            cut = np.searchsorted(d, np.arange(len(texts) + 1))
            v = h.view(np.int64)
            return [[v[a:b] for a, b in zip(cut, cut[1:], strict=False)]]

        return of

    return map_texts(one, make, {"shingles": "array<long>"}, PIECE)


def links(docs: DataFrame, keys: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs (a, b) whose components are those of all pairs of one bucket at the threshold.

    keys: node, first_id, n, bands and size (its shingles) of each distinct text.
    """
    spark = docs.sparkSession
    member = keys.where("bands is not null").select("node", "first_id", F.col("size").alias("k"), F.explode("bands").alias("key")).where("key is not null")
    sizes = member.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared, shared_path = stored(member.join(sizes, "key"), "buckets")
    # How common a node's bands are: high in the middle of a group.
    popular, popular_path = stored(shared.groupBy("node").agg(F.sum("size").alias("common"), F.first("first_id").alias("first_id")), "popular")
    sets, sets_path = stored(shingle_sets(docs, popular.select("node", "first_id")), "shingles", BATCH_ROWS)
    paths, found, level = [popular_path, sets_path], [], 0
    first = shared.join(popular.select("node", "common"), "node").select("key", "node", "k", F.col("common").cast("double").alias("central"), "size", F.col("size").alias("unlinked"), F.lit(False).alias("linked"), (F.col("k") / threshold).alias("cap"))
    open_, path = stored(first, "open")
    dropped(spark, shared_path)
    while open_.limit(1).count():
        paths.append(path)
        small = F.col("size") <= LATER if level else F.col("size") <= SMALL
        pairs = all_pairs(open_ if level == LEVELS else open_.where(small), threshold)
        if 0 < level < LEVELS:
            few = ~small & (F.col("unlinked") <= FEW)
            pairs, small = pairs.unionByName(with_few(open_.where(few), threshold)).distinct(), small | few
        new, path = stored(compared(pairs, sets).where(is_link(threshold)).select("a", "b"), "links")
        found.append(new)
        paths.append(path)
        if level == LEVELS or not open_.where(~small).limit(1).count():
            break
        apart, path = stored(differences(spark, open_.where(~small), sets, paths), "differences")
        paths.append(path)
        judged, path = stored(with_centre(apart, threshold), "centres")
        found.append(judged.where("linked and node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")))
        paths.append(path)
        level += 1
        often, path = stored(often_beside(judged, threshold), "often")
        paths.append(path)
        able, path = stored(unsettled(beside(judged, often, threshold)), "able")
        paths.append(path)
        sizes = able.groupBy("key").agg(F.count("*").alias("size"), F.count_if(~F.col("linked")).alias("unlinked")).where("size > 1")
        open_, path = stored(able.join(sizes, "key"), "open")
    every = shared.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0) if not found else found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    out, _ = stored(every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    dropped(spark, *paths)
    return out


def unsettled(members: DataFrame) -> DataFrame:
    """Without those that can have no partner: two that link with the same centre are in one class."""
    cap = F.max(F.when(~F.col("linked"), F.col("cap")))
    facts = members.groupBy("key").agg(F.count("*").alias("size"), cap.alias("most"), F.min("k").alias("least")).where("size > 1 and most >= least")
    return members.join(facts.drop("size"), "key").where("cap >= least and (not linked or k <= most)").drop("most", "least")


def able(x: str, y: str, threshold: float) -> str:
    """Can x and y be similar by their sizes? cap is the greatest size of a text similar to one."""
    return f"{x}.k <= {y}.cap and {y}.k <= {x}.cap and least({x}.k, {y}.k) >= {threshold} * greatest({x}.k, {y}.k) - 1e-9"


def all_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs of each bucket that can be similar by their sizes and are not known to be in one class."""
    nodes = members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "k", "linked", "cap"))).alias("nodes"))
    every = f"flatten(transform(nodes, (x, i) -> transform(filter(slice(nodes, i + 2, size(nodes)), y -> not (x.linked and y.linked) and {able('x', 'y', threshold)}), y -> struct(x.node as a, y.node as b))))"
    return nodes.select(F.explode(F.expr(every)).alias("p")).select("p.a", "p.b").distinct()


def with_few(members: DataFrame, threshold: float, most: int = 512) -> DataFrame:
    """Pairs of the few unlinked nodes of each bucket with all of its nodes; hot buckets are dealt by salts."""
    salts = F.ceil(F.col("size") / F.lit(most)).cast("int")
    some = members.where("not linked").groupBy("key").agg(F.collect_list(F.struct("node", "k", "cap")).alias("few"), F.first("size").alias("size"))
    some = some.select("key", "few", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    met = members.select("key", F.struct("node", "k", "cap").alias("y"), F.pmod(F.xxhash64("node"), salts).cast("int").alias("salt")).join(some, ["key", "salt"])
    pairs = met.select("y.node", F.explode(F.expr(f"transform(filter(few, x -> x.node != y.node and {able('x', 'y', threshold)}), x -> x.node)")).alias("other"))
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def differences(spark: SparkSession, large: DataFrame, sets: DataFrame, paths: list[str], most: int = 512) -> DataFrame:
    """Members of large buckets beside the consensus of their group: node, g, salt, k, own, missing and nc, the size of the consensus.

    Buckets with the same most central node are one group g, and its consensus is what most of a few of its members
    have. A hot group is dealt by salts to tasks of about ``most`` members, each with its own copy of the consensus.
    """
    salts = lambda: F.ceil(F.col("size") / F.lit(most)).cast("int")
    salt = lambda of: F.pmod(F.xxhash64("node"), of).cast("int").alias("salt")
    best = large.groupBy("key").agg(F.max_by("node", F.struct("central", "node")).alias("g"), F.first("size").alias("size"))
    best = best.select("key", "g", F.explode(F.sequence(F.lit(0), salts() - 1)).alias("salt"))
    met = large.select("*", salt(salts())).join(best, ["key", "salt"])
    star, path = stored(met.groupBy("node", "g").agg(F.max("size").alias("size"), F.first("k").alias("k")).select("node", "g", "k", "size", salt(salts())), "groups")
    paths.append(path)
    few = star.where((F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(F.col("size") / F.lit(VOTES))) == 0) | (F.col("node") == F.col("g"))).select("node", "g")
    votes = few.join(sets, "node").select("g", F.explode("shingles").alias("s")).groupBy("g", "s").agg(F.count("*").alias("votes"))
    common = votes.join(few.groupBy("g").agg(F.count("*").alias("voters")), "g").where("2 * votes > voters").groupBy("g").agg(F.sort_array(F.collect_list("s")).alias("common"))
    copies = star.select("g", "salt").distinct().join(common, "g", "left").select("g", "salt", F.coalesce("common", F.array().cast("array<long>")).alias("common"))
    both = star.join(sets, "node").join(copies, ["g", "salt"])
    return both.select("node", "g", "salt", "k", F.array_except("shingles", "common").alias("own"), F.array_except("common", "shingles").alias("missing"), F.size("common").alias("nc"))


def with_centre(apart: DataFrame, threshold: float) -> DataFrame:
    """``differences`` with the group's centre, whether a node links with it, and the least numbers of missing shingles (dmin) and of shingles (kmin) of nodes near the consensus."""
    near = F.col("k") - F.size("own") >= F.ceil(threshold * F.col("k") - 1e-9)
    away = F.size("own") + F.size("missing")
    best = apart.groupBy("g").agg(F.min_by(F.struct("node", "k", "own", "missing"), F.struct(away, "node")).alias("c"), F.min(F.when(near, F.size("missing"))).alias("dmin"), F.min(F.when(near, F.col("k"))).alias("kmin"), F.min("k").alias("least"))
    both = apart.join(apart.select("g", "salt").distinct().join(best, "g"), ["g", "salt"])
    shared = F.col("nc") - F.size(F.array_union("missing", "c.missing")) + F.size(F.array_intersect("own", "c.own"))
    linked = shared >= F.lit(threshold) * (F.col("k") + F.col("c.k") - shared) - 1e-9
    return both.select("node", "g", F.col("c.node").alias("centre"), "k", "nc", "own", "missing", "dmin", "kmin", "least", (-away / F.col("k")).alias("central"), linked.alias("linked"))


def beside(judged: DataFrame, often: DataFrame | None, threshold: float) -> DataFrame:
    """Buckets in which nodes of one group meet again: key, node, k, central, linked and cap.

    Own shingles are taken in order of their hashes, those that are found often last. If the first that two texts
    share is at some place, they have no more in common than what is in the consensus and what follows: this
    bounds the other's size by cap, and ends the list.
    """
    own = F.col("own")
    if often is not None:
        judged = heavy_lookup(judged, often, "g", "n")
        own = F.when(F.col("often").isNull(), own).otherwise(F.concat(F.array_except("own", "often"), F.array_intersect("often", "own")))
    part = (1 + threshold) / threshold
    i = F.col("k") - F.size("own")
    cap = lambda most: F.lit(part) * most - F.col("k") + 1e-6
    last = lambda least: F.floor(F.col("k") - (F.col("k") + least) / part + 1e-6).cast("int") + 1  # noqa: E731  so many places have a cap of at least that size
    near = cap(i) >= F.greatest(threshold * F.col("k"), F.col("kmin"))
    room = F.col("nc") - (F.col("k") + F.greatest(threshold * F.col("k"), F.col("kmin"))) / part
    both = F.ceil(F.size("missing") + F.col("dmin") - room - 1e-9).cast("int")  # so many missing shingles in common are needed
    within_cap = cap(F.col("nc") - F.size("missing") - F.col("dmin"))
    cls = F.floor(F.log("k") / -F.log(F.lit(threshold)) + 1e-9).cast("long")
    none = F.array().cast("array<long>")
    mine = judged.select(
        "node", "g", "k", "central", "linked", cap(i).alias("near_cap"), cap(F.col("k")).alias("first_cap"), within_cap.alias("within_cap"),
        F.slice(own, F.lit(1), F.greatest(F.least(F.size("own"), last(F.greatest(threshold * F.col("k"), F.col("least")))), F.lit(0))).alias("own"),
        F.when(near, F.slice("missing", F.lit(1), F.greatest(F.size("missing") - F.greatest(both - 1, F.lit(0)), F.lit(0)))).otherwise(none).alias("missing"),
        F.when(near & (both <= 0), F.array(cls, cls + 1)).otherwise(none).alias("within"),
    )
    at = lambda name, cap: mine.select("node", "k", "central", "linked", "g", "near_cap", "first_cap", "within_cap", F.posexplode(name)).select(F.xxhash64("g", F.lit(name), "col").alias("key"), "node", "k", "central", "linked", cap.alias("cap"), "g", F.col("col").alias("what"))
    found = at("own", F.col("first_cap") - F.lit(part) * F.col("pos"))
    if often is None:
        return found
    return found.unionByName(at("missing", F.col("near_cap"))).unionByName(at("within", F.col("within_cap"))).drop("g", "what")


def often_beside(judged: DataFrame, threshold: float) -> DataFrame:
    """For each group, the shingles beside its consensus that many have, the most frequent last; and the number n of members."""
    kinds = beside(judged, None, threshold).groupBy("key").agg(F.count("*").alias("size"), F.first("g").alias("g"), F.first("what").alias("what")).where(F.col("size") > SMALL)
    listed = kinds.groupBy("g").agg(F.expr("transform(sort_array(collect_list(struct(size, what))), x -> x.what)").alias("often"))
    return listed.join(judged.groupBy("g").agg(F.count("*").alias("n")), "g")


def is_link(threshold: float) -> F.Column:
    return F.col("both") >= F.lit(threshold) * (F.col("na") + F.col("nb") - F.col("both")) - 1e-9


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, by alternating large and small stars."""
    spark = edges.sparkSession

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def with_least(rows: DataFrame, least: DataFrame) -> tuple[DataFrame, str]:
        facts, path = stored(least, "least")
        return heavy_lookup(rows, facts, "u", "n"), path

    now, path = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "stars")
    before = mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large, least_path = with_least(both.where("v > u"), least)
        mid, mid_path = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct(), "stars")
        joined, least_path_2 = with_least(mid, mid.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        after, after_path = stored(small, "stars")
        dropped(spark, mid_path, path, least_path, least_path_2)
        now, path, mine = after, after_path, mark(after)
        if mine == before:
            break
        before = mine
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node (of the text), class_id, class_size and keeper (is it the text that stays?) of every row."""
    hashed = docs.select("doc_id", node().alias("node"), "text")
    rows, _ = stored(map_texts(hashed, lambda: bands_of, {"bands": "array<long>", "size": "int"}, PIECE), "bands", BATCH_ROWS)
    keys, keys_path = stored(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("size").alias("size")), "texts")
    labels = components(links(docs, keys, threshold))
    named, named_path = stored(keys.select("node", "first_id", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labels")
    groups, groups_path = stored(named.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"), F.count("*").alias("texts"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "node"))["node"].alias("keeper")), "groups")
    facts = heavy_lookup(named, groups, "label", "texts").select("node", "n", "class_id", "class_size", (F.col("keeper") == F.col("node")).alias("keeper"))
    facts, _ = stored(facts, "classes")
    dropped(docs.sparkSession, keys_path, named_path, groups_path)
    out = heavy_lookup(rows.select("doc_id", "node"), facts, "node", "n")
    return out.select("doc_id", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("keeper", F.lit(True)).alias("keeper"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row of each class: that of the smallest id; of several, that whose hash is the least. Null texts all stay."""
    least = F.coalesce("doc_id", F.lit(LAST))
    keep = classes(docs.select("doc_id", "text"), threshold).where("keeper and node is not null").groupBy("node").agg(F.min(least).alias("id"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*columns).alias("_row"), node().alias("node"), least.alias("id"))
    # By text and id: copies of one text go to many tasks, and only rows of the smallest id are left.
    left = whole.where("node is not null").join(keep, ["node", "id"], "left_semi")
    first = left.groupBy("node", "id").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return first.select("_row").unionByName(whole.where("node is null").select("_row")).select("_row.*")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "class_size")
