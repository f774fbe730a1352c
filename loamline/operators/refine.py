"""Refinement: validation, chunks with overlap, ranked dedup, caps, quotas and splits."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from .gate import SYMBOL_PROMPT, any_of, first_failed

# Fixed values.
DECLARATION = "\\b(class|interface|trait|enum)\\s+([A-Za-z_][A-Za-z0-9_]*)"
TYPE_RANK = ["bugfix", "refactor", "write_from_spec", "explain_and_implement", "retrieval"]
STREAK = 12
CATEGORIES = {
    "attributes": ["#\\[[A-Za-z_\\\\][A-Za-z0-9_\\\\]*"],
    "di": ["\\bContainerInterface\\b", "public\\s+static\\s+function\\s+create\\s*\\(", "services\\.yml", "logger\\.factory"],
    "routing": ["routing\\.yml", "\\broute_name\\b", "\\b_controller\\b", "\\bpath:\\s*['\"/]"],
    "sdc": ["single\\s+directory\\s+component", "component\\.yml", "\\.component\\.yml", "\\bsdc\\b"],
}


def symbol_kind(output: Column | str = "output", source: Column | str = "source") -> Column:
    found = F.regexp_extract(t.c(output), DECLARATION, 1)
    return F.when(found != "", found).otherwise(t.kind_from_path(source))


def validation_reason(need_input: tuple[str, ...] = ()) -> Column:
    ins, out, source = t.strip("instruction"), F.col("output"), F.lower(F.coalesce("source", F.lit("")))
    prompt, slot, asked = ins.rlike(SYMBOL_PROMPT), F.regexp_extract(ins, SYMBOL_PROMPT, 2), F.regexp_extract(ins, SYMBOL_PROMPT, 1)
    kind = symbol_kind()
    class_asked = F.contains(F.lower(ins), F.lit("implementation of the class"))
    by_file = F.when(source.endswith("interface.php"), "interface").when(source.endswith("trait.php"), "trait").when(source.endswith("enum.php"), "enum").when(kind != "class", kind)
    cut = t.rstrip(out)
    fences = (F.length(cut) - F.length(F.replace(cut, F.lit("```"), F.lit("")))) / 3
    return F.coalesce(
        first_failed([(F.col("type").isin(*need_input) & (t.strip("input") == ""), "missing_context_input") if need_input else (F.lit(False), ""), (prompt & ~slot.rlike("^[A-Z][A-Za-z0-9_]*$"), "malformed_instruction_class_slot")]),
        F.when(prompt & (asked != kind), F.concat_ws("_", asked, kind, F.lit("mismatch"))),
        F.when(~prompt & ins.startswith("Show me the implementation of"), "invalid_symbol_kind_prompt"),
        F.when(class_asked & by_file.isNotNull(), F.concat_ws("_", F.lit("class"), by_file, F.lit("mismatch"))),
        first_failed([
            (t.wrapper_echo(out), "contains_prompt_wrapper_echo"), (t.numeric_streak(out) >= STREAK, "numeric_line_streak_artifact"), (t.numeric_fence(out), "numeric_code_block_artifact"),
            ((fences % 2 != 0) | cut.endswith("Input:") | cut.endswith("Output:") | cut.endswith("Instruction:"), "truncation_artifact"),
        ]),
    )


def with_hint(hint: Column) -> Column:
    base = t.strip(F.coalesce("input", F.lit("")))
    return F.when(base == "", hint).otherwise(F.concat(base, F.lit("\n"), hint))


def line_chunks(samples: DataFrame, most: int, overlap: int, suffix_mode: bool = False) -> DataFrame:
    """Windows of ``most`` lines that share ``overlap``; samples of fewer lines pass. Adds chunk_index, chunk_total, line_start, line_end."""
    step = most - max(0, min(overlap, most - 1))
    n = F.size("_lines")
    total = F.when(n <= most, 1).otherwise(F.ceil((n - most) / step).cast("int") + 1)
    cut = samples.withColumn("_lines", t.lines("output")).withColumn("_total", total).withColumn("_i", F.explode(F.sequence(F.lit(1), "_total")))
    start, whole = (F.col("_i") - 1) * step, F.col("_total") == 1
    end = F.least(start + most, n)
    body = F.array_join(F.slice("_lines", start + 1, F.lit(most)), "\n")
    body = F.when((end == n) & F.col("output").endswith("\n"), F.concat(body, F.lit("\n"))).otherwise(body)
    hint = F.format_string("Chunk: part %d/%d, lines %d-%d.", "_i", "_total", start + 1, end)
    named = F.format_string("%s [Part %d/%d, lines %d-%d]", t.strip("instruction"), F.col("_i"), F.col("_total"), start + 1, end) if suffix_mode else t.strip("instruction")
    none = F.lit(None).cast("int")
    new = {"instruction": F.when(whole, F.col("instruction")).otherwise(named), "input": F.when(whole, F.col("input")).otherwise(with_hint(hint)), "output": F.when(whole, F.col("output")).otherwise(body)}
    return cut.select(
        *(new.get(c, F.col(c)).alias(c) for c in samples.columns), F.when(whole, none).otherwise(F.col("_i")).alias("chunk_index"), F.when(whole, none).otherwise(F.col("_total")).alias("chunk_total"),
        F.when(whole, none).otherwise(start + 1).cast("int").alias("line_start"), F.when(whole, none).otherwise(end).cast("int").alias("line_end"),
    )


def char_chunks(samples: DataFrame, most: int, overlap: int) -> DataFrame:
    """Runs of lines of at most ``most`` characters, stepping back ``overlap`` lines. Only line lengths go to Python."""

    def ranges(sizes: pd.Series) -> pd.Series:
        out = []
        for of in sizes:
            found, start, n = [], 0, len(of)
            while start < n:
                size, end = int(of[start]), start + 1
                while end < n and size < most and size + 1 + int(of[end]) <= most:
                    size += 1 + int(of[end])
                    end += 1
                found.append({"a": start, "z": end})
                back = max(0, end - max(0, overlap))
                start = n if end >= n else back if back > start else end
            out.append(found)
        return pd.Series(out)

    ranges.__annotations__ = {"sizes": pd.Series, "return": pd.Series}
    long = F.length("output") > most
    cut = samples.withColumn("_lines", t.lines("output"))
    short = cut.where(~long | (F.size("_lines") == 0) | F.col("output").isNull())
    parts = cut.where(long & (F.size("_lines") > 0)).withColumn("_ranges", F.pandas_udf(ranges, "array<struct<a:int,z:int>>")(F.transform("_lines", F.length))).withColumn("_total", F.size("_ranges"))
    parts = parts.select("*", F.posexplode("_ranges").alias("_i", "_r"))
    body = F.array_join(F.slice("_lines", F.col("_r.a") + 1, F.col("_r.z") - F.col("_r.a")), "\n")
    body = F.when((F.col("_r.z") == F.size("_lines")) & F.col("output").endswith("\n"), F.concat(body, F.lit("\n"))).otherwise(body)
    hint = F.format_string("Character chunk: part %d/%d, lines %d-%d.", F.col("_i") + 1, "_total", F.col("_r.a") + 1, "_r.z")
    new = {"input": with_hint(hint), "output": body}
    none = F.lit(None).cast("int")
    one = parts.select(*(new.get(c, F.col(c)).alias(c) for c in samples.columns), (F.col("_i") + 1).alias("char_chunk_index"), F.col("_total").alias("char_chunk_total"), (F.col("_r.a") + 1).alias("char_chunk_start_line"), F.col("_r.z").alias("char_chunk_end_line"))
    return one.unionByName(short.select(*samples.columns, *(none.alias(c) for c in one.columns[-4:])))


def ranked_dedup(samples: DataFrame, prefer_augmented: bool = True) -> DataFrame:
    """samples with ``kept``: the best of each normalised output."""
    rank = F.lit(len(TYPE_RANK))
    for i, name in enumerate(TYPE_RANK):
        rank = F.when(F.col("sample_type") == name, i).otherwise(rank)
    order = [rank, "source", "instruction", "seq"] if prefer_augmented else ["seq"]
    return samples.withColumn("kept", F.row_number().over(Window.partitionBy(t.output_hash("output", True)).orderBy(*order)) == 1)


def matches(category: str, patterns: dict[str, list[str]] | None = None) -> Column:
    text = F.concat_ws(" ", "source", "instruction", "input", "output")
    return any_of([text.rlike(f"(?im){p}") for p in (patterns or CATEGORIES).get(category, [])])


def shuffled(seed: int, *keys: str) -> list[Column]:
    """A reproducible order by hash, in place of a seeded shuffle."""
    return [F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))), *(F.col(k) for k in keys)]


def share_limits(counts: dict[str, int], share: float) -> dict[str, int]:
    """How many of each bucket go, so that none is more than the share of all that is left."""
    left = dict(counts)
    while True:
        total, before = sum(left.values()), dict(left)
        for bucket, n in sorted(left.items(), key=lambda x: (-x[1], x[0])):
            allowed = max(1, int(share * (total - n) / (1.0 - share))) if total > n else 1
            if n > allowed:
                left[bucket], total = allowed, total - (n - allowed)
        if left == before:
            return {b: counts[b] - left[b] for b in counts}


def share_capped(samples: DataFrame, bucket: str, share: float, seed: int, score: Column | None = None) -> DataFrame:
    """samples with ``kept``. Of a bucket that is too large the rows of the lowest score go, in a seeded order."""
    spark = samples.sparkSession
    drops = [(b, n) for b, n in share_limits({r[bucket]: r["count"] for r in samples.groupBy(bucket).count().collect()}, share).items() if n] if 0 < share < 1 else []
    plan = F.broadcast(spark.createDataFrame(drops, f"{bucket} string, _drop long"))
    ranked = samples.join(plan, bucket, "left")
    order = Window.partitionBy(bucket).orderBy(score if score is not None else F.lit(0), *shuffled(seed, "seq"))
    return ranked.withColumn("kept", F.row_number().over(order) > F.coalesce("_drop", F.lit(0))).drop("_drop")


def has_prefix(prefixes: list[str], source: Column | str = "source") -> Column:
    """Does the source begin with one of the prefixes, whatever their case? Blank ones don't count."""
    low = F.lower(F.trim(t.c(source)))
    return any_of([low.startswith(p.strip().lower()) for p in prefixes if p.strip()])


def too_long(samples: DataFrame, most: int) -> DataFrame:
    """samples with rejection_reason max_output_chars where even a chunk's output is longer, else null."""
    return samples.withColumn("rejection_reason", F.when(F.length("output") > most, "max_output_chars"))


def test_rows(source: Column | str = "source") -> Column:
    low = F.lower(t.c(source))
    return F.contains(low, F.lit("/tests/")) | low.endswith("test.php")


def rebalanced(samples: DataFrame, ratio: float, seed: int) -> DataFrame:
    """samples with ``kept``: all others, and as many test rows as make up the ratio."""
    marked = samples.withColumn("_test", test_rows())
    n = {r["_test"]: r["count"] for r in marked.groupBy("_test").count().collect()}
    tests, others = n.get(True, 0), n.get(False, 0)
    most = 0 if ratio <= 0 else tests if ratio >= 1 or not tests or not others else int(ratio * others / (1 - ratio))
    order = Window.partitionBy("_test").orderBy(*shuffled(seed, "seq"))
    return marked.withColumn("kept", ~F.col("_test") | (F.row_number().over(order) <= most)).drop("_test")


def assign_groups(sizes: list[tuple[str, int]], targets: tuple[float, float]) -> list[tuple[str, str]]:
    """Each group whole to the split that comes nearest the targets, in the given order."""
    names, total = ("train", "valid", "test"), sum(n for _, n in sizes)
    want = dict(zip(names, (a := int(total * targets[0]), b := int(total * targets[1]), total - a - b), strict=True))
    have, out = dict.fromkeys(names, 0), []
    for group, n in sizes:
        cost = lambda s: (sum(abs(have[x] + n * (x == s) - want[x]) for x in names), have[s] - want[s], have[s] + n)  # noqa: E731, B023
        best = min(names, key=cost)
        have[best] += n
        out.append((group, best))
    return out


def grouped_split(samples: DataFrame, group: str = "source", targets: tuple[float, float] = (0.8, 0.1), seed: int = 42) -> DataFrame:
    """samples with ``split``; no group is in two. The driver sees one count for each group."""
    counts = samples.groupBy(group).count().orderBy(*shuffled(seed, group)).collect()
    plan = samples.sparkSession.createDataFrame(assign_groups([(r[group], r["count"]) for r in counts], targets), f"{group} string, split string")
    return samples.join(plan, group)


def positional_split(samples: DataFrame, targets: tuple[float, float] = (0.8, 0.1), seed: int = 42, key: str = "seq") -> DataFrame:
    """Shuffled, then cut by place: places come from counts of hash ranges and ranks within them, not from one sorted task."""
    buckets = 1024
    keyed = samples.withColumn("_k", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))).withColumn("_b", (F.conv(F.substring("_k", 1, 5), 16, 10).cast("long") / (16**5 // buckets)).cast("int"))
    counts = dict(keyed.groupBy("_b").count().collect())
    before, at = [], 0
    for b in range(buckets):
        before.append(at)
        at += counts.get(b, 0)
    place = F.element_at(F.array(*(F.lit(x).cast("long") for x in before)), F.col("_b") + 1) + F.row_number().over(Window.partitionBy("_b").orderBy("_k", key))
    train, valid = int(at * targets[0]), int(at * targets[1])
    return keyed.withColumn("_place", place).withColumn("split", F.when(F.col("_place") <= train, "train").when(F.col("_place") <= train + valid, "valid").otherwise("test")).drop("_k", "_b", "_place")


def quota_sample(samples: DataFrame, quotas: dict[str, int], ratio: float, seed: int, patterns: dict[str, list[str]] | None = None) -> DataFrame:
    """``int(n * ratio)`` rows: up to each category's quota of its matches, one category after the other, then any."""
    left_over = int(samples.count() * ratio)
    picked = samples.select("seq").limit(0)
    for category, quota in quotas.items():
        rows = samples.where(matches(category, patterns)).join(picked, "seq", "left_anti").orderBy(*shuffled(seed, "seq")).limit(min(quota, left_over)).select("seq").persist()
        left_over -= rows.count()
        picked = picked.unionByName(rows)
    rest = samples.join(picked, "seq", "left_anti").orderBy(*shuffled(seed, "seq")).limit(left_over).select("seq")
    return samples.join(picked.unionByName(rest), "seq", "left_semi")


def round_robin(samples: DataFrame, types: list[str], seed: int) -> DataFrame:
    """Types in turn, by place in the seeded order."""
    place = F.row_number().over(Window.orderBy(*shuffled(seed, "seq")))
    return samples.withColumn("augmentation_type", F.element_at(F.array(*map(F.lit, types)), F.pmod(place - 1, F.lit(len(types))) + 1))


def valid_patterns(config: dict[str, list[str]] | None) -> dict[str, list[str]]:
    """Patterns that compile; the defaults if none is given."""
    if not config:
        return CATEGORIES
    out: dict[str, list[str]] = {}
    for name, some in config.items():
        for p in some:
            try:
                re.compile(p)
            except re.error:
                continue
            out.setdefault(name, []).append(p)
    return out
