"""Learned decision lists for text quality.

Statistics of every text come from built-in functions. From a bounded sample of
labelled statistics a decision list is learned by sequential covering: a rule
grows by the threshold that gains most information on low-quality rows, is
pruned on held-out rows, and takes the rows it covers out of the sample, until
no rule is precise enough. The list becomes one ordered Spark ``CASE``.

Definitions: words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no
words and fails the base rules. Rows are judged each by itself, so repeated rows
and repeated ids keep their verdicts. Labels that are null are left out; of
several labels for a document the lowest counts. With no labels the list is
empty and the base rules decide. Other columns stay as they are in ``kept_rows``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, whole_rows

#: Labelled rows to learn from: those with the smallest hash of their id.
SAMPLE_ROWS = 4000
MIN_PRECISION, MIN_COVER, MAX_RULES, MAX_CONDITIONS, CUTS = 0.95, 8, 16, 3, 24
FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share", "digit_share")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the column ``stats``: the counts and the features drawn from them."""
    t = f"coalesce(`{text}`, '')"
    out = docs.withColumn("_words", F.expr(f"array_remove(split({t}, '[ \\\\t-\\\\r]+'), '')"))
    out = out.withColumn("_lines", F.expr(f"filter(split({t}, '\\n'), l -> l rlike '[^ \\\\t-\\\\r]')"))
    # Three-word windows, in order of their words' hashes, so that equal ones are neighbours.
    out = out.withColumn("_hashes", F.expr("transform(_words, w -> xxhash64(w))"))
    out = out.withColumn("_windows", F.expr("sort_array(arrays_zip(slice(_hashes, 1, greatest(size(_hashes) - 2, 0)), slice(_hashes, 2, greatest(size(_hashes) - 2, 0)), slice(_hashes, 3, greatest(size(_hashes) - 2, 0)), slice(sequence(0, size(_hashes)), 1, greatest(size(_hashes) - 2, 0))))"))
    same = lambda k: f"(w.`0` = get(_windows, {k}).`0` and w.`1` = get(_windows, {k}).`1` and w.`2` = get(_windows, {k}).`2`)"
    found = f"filter(_windows, (w, k) -> {same('k - 1')} or {same('k + 1')})"
    at = f"sort_array(transform({found}, w -> w.`3`))"
    # Words in the union of [i, i + 3): each window adds what reaches past the last.
    out = out.withColumn("_repeats", F.expr(f"aggregate({at}, struct(0L as n, 0 as reach), (a, i) -> struct(a.n + i + 3 - greatest(i, a.reach) as n, i + 3 as reach), a -> a.n)"))
    count = lambda keep: f"cast(char_length(regexp_replace({t}, '[^{keep}]+', '')) as bigint)"
    # A generator of one row: the optimizer doesn't copy what it makes into every later use.
    kept = [f"`{c}`" for c in docs.columns]
    out = out.selectExpr(*kept, f"""inline(array(struct(
        cast(size(_words) as bigint) as _n_words, cast(char_length(array_join(_words, '')) as bigint) as _word_chars, {count('#*$%&|<>')} as _n_symbols,
        cast(size(_lines) - size(array_distinct(_lines)) as bigint) as _n_dup_lines, _repeats as _n_repeat_words,
        cast(size(_lines) as bigint) as _n_lines, {count(chr(92) * 2 + 'p{Lu}')} as _n_upper, {count('!')} as _n_bangs, {count('0-9')} as _n_digits)))""")
    share = lambda a, b, name: f"if(_{b} = 0, 0d, _{a} / cast(_{b} as double)) as {name}"
    stats = [f"_{s} as {s}" for s in STATS] + [
        share("word_chars", "n_words", "word_length"), share("n_symbols", "word_chars", "symbol_share"), share("n_dup_lines", "n_lines", "dup_line_share"), share("n_repeat_words", "n_words", "repeat_share"),
        share("n_upper", "word_chars", "upper_share"), share("n_bangs", "n_words", "bang_share"), share("n_digits", "word_chars", "digit_share"), "(_n_words < 50 or 100 * _n_repeat_words > 50 * _n_words) as base_failed",
    ]
    return out.selectExpr(*kept, f"struct({', '.join(stats)}) as stats")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self, stats: str) -> F.Column:
        value = F.col(f"{stats}.{self.feature}")
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.cut) == self.above


@dataclass
class DecisionList:
    """Rules that reject, in order; what no rule rejects is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def verdict(self, stats: str = "stats") -> F.Column:
        out = None
        for rule in self.rules:
            every = rule[0].column(stats)
            for c in rule[1:]:
                every = every & c.column(stats)
            out = F.when(every, F.lit(False)) if out is None else out.when(every, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def keeps(self, row: dict) -> bool:
        return not any(all(c.holds(row) for c in rule) for rule in self.rules)


def learn(rows: list[tuple[dict, bool]]) -> DecisionList:
    """A list from (features, is low quality). Sets of rows are bits of an integer."""
    rows = sorted(rows, key=lambda r: ([r[0][f] for f in FEATURES], r[1]))
    everything, low = (1 << len(rows)) - 1, sum(1 << i for i, r in enumerate(rows) if r[1])
    tests: dict[Condition, int] = {}
    for f in FEATURES:
        values = sorted({r[0][f] for r in rows})
        # Cuts halfway to the next value, at quantiles of all values and of those of low rows.
        lows = sorted({r[0][f] for r in rows if r[1]})
        following = dict(zip(values, values[1:], strict=False))
        cuts = {(v[k] + following[v[k]]) / 2 for v in (values, lows) for k in range(0, len(v), max(1, len(v) // CUTS)) if v[k] in following}
        for cut in sorted(cuts):
            bits = sum(1 << i for i, r in enumerate(rows) if r[0][f] > cut)
            tests[Condition(f, True, cut)], tests[Condition(f, False, cut)] = bits, everything & ~bits
    prune_part = sum(1 << i for i in range(len(rows)) if i % 3 == 2)
    left, found = everything, DecisionList()

    def covered(rule: list[Condition], of: int) -> tuple[int, int]:
        for c in rule:
            of &= tests[c]
        return (of & low).bit_count(), (of & ~low).bit_count()

    while len(found.rules) < MAX_RULES:
        grow, prune = left & ~prune_part, left & prune_part
        rule: list[Condition] = []
        here = grow
        while len(rule) < MAX_CONDITIONS:
            p, n = (here & low).bit_count(), (here & ~low).bit_count()
            if not p or not n:
                break
            before, best = math.log2(p / (p + n)), (1e-9, None)
            for c, bits in tests.items():
                p1 = (here & bits & low).bit_count()
                if p1 >= MIN_COVER:
                    n1 = (here & bits & ~low).bit_count()
                    gain = p1 * (math.log2(p1 / (p1 + n1)) - before)
                    if gain > best[0]:
                        best = (gain, c)
            if best[1] is None:
                break
            rule.append(best[1])
            here &= tests[best[1]]
        if not rule:
            break
        worth = lambda r: (lambda p, n: (p - n) / (p + n) if p + n else -1)(*covered(r, prune))
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        p, n = covered(rule, left)
        pp, pn = covered(rule, prune)
        if p < MIN_COVER or p < MIN_PRECISION * (p + n) or (pp + pn and pp < MIN_PRECISION * (pp + pn) - 1):
            break
        found.rules.append(rule)
        taken = left
        for c in rule:
            taken &= tests[c]
        left &= ~taken
    return found


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DecisionList:
    """Learns from at most sample_rows labelled documents; the ids broadcast are no more than those."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 0).alias("low"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = with_stats(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).select("stats.*", "low").orderBy(F.xxhash64("n_words", "word_chars"), *FEATURES).limit(sample_rows).collect()
    return learn([({f: float(r[f]) for f in FEATURES}, bool(r["low"])) for r in rows])


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs as ``_row``, their stats and whether they are kept."""
    return with_stats(whole_rows(docs)).drop("text").withColumn("kept", ~F.col("stats.base_failed") & fit(docs, labels).verdict())


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are kept, with all columns of docs, whatever their names."""
    return judged(docs, labels).where("kept").select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "labels")).select("_row.doc_id", *(f"stats.{s}" for s in STATS), "stats.base_failed", "kept")
