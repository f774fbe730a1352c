"""Text functions as Spark columns. ``\\s`` is Unicode white space; lines end as in ``str.splitlines``."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide results.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
NUMERIC_LINE = "^\\p{Nd}{1,5}[.):]?$"
WRAPPER = "(?im)^\\s*(instruction|input|output)\\s*:"
FENCE = "(?s)```(?:[A-Za-z0-9_+-]+)?\\n(.*?)```"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.regexp_replace(c(x), "(?U)^\\s+|\\s+$", "")


def rstrip(x: Column | str) -> Column:
    return F.regexp_replace(c(x), "(?U)\\s+$", "")


def collapsed(x: Column | str) -> Column:
    """White space runs as single spaces, stripped."""
    return F.trim(F.regexp_replace(c(x), "(?U)\\s+", " "))


def normalized(x: Column | str) -> Column:
    """Line feeds only, no white space at line ends, stripped, one line feed at the end."""
    unix = F.regexp_replace(c(x), "\\r\\n?", "\n")
    return F.concat(strip(F.regexp_replace(unix, "(?Um)[\\s&&[^\\n]]+$", "")), F.lit("\n"))


def without_license(x: Column | str) -> Column:
    return F.regexp_replace(c(x), "(?is)/\\*\\*.*?@license.*?GPL.*? \\*/", "")


def output_hash(x: Column | str, normalise: bool = False) -> Column:
    return F.sha2(collapsed(x) if normalise else c(x), 256)


def lines(x: Column | str) -> Column:
    """All lines; a line end at the end begins no further line, and an empty text has none."""
    parts = F.split(c(x), LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def is_numeric_line(x: Column) -> Column:
    return strip(x).rlike(NUMERIC_LINE)


def numeric_streak(x: Column | str, skip_blank: bool = False) -> Column:
    """The longest run of numeric lines. Blank lines end a run unless they are left out first."""
    every = F.split(c(x), "\n")
    if skip_blank:
        every = F.filter(every, lambda v: strip(v) != "")
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a: Column, v: Column) -> Column:
        run = F.when(is_numeric_line(v), a["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(a["most"], run).alias("most"))

    return F.aggregate(every, zero, step, lambda a: a["most"])


def repeated_line_ratio(x: Column | str, least: int = 20) -> Column:
    """Share of the most frequent of the stripped lines that aren't blank; 0 for fewer than ``least``."""
    every = F.array_sort(F.filter(F.transform(F.split(c(x), "\n"), strip), lambda v: v != ""))
    zero = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a: Column, v: Column) -> Column:
        run = F.when(a["last"].eqNullSafe(v), a["run"] + 1).otherwise(1)
        return F.struct(v.alias("last"), run.alias("run"), F.greatest(a["most"], run).alias("most"))

    most = F.aggregate(every, zero, step, lambda a: a["most"])
    return F.when(F.size(every) < least, F.lit(0.0)).otherwise(most / F.size(every))


def numeric_fence(x: Column | str) -> Column:
    """Is there a fenced block of six or more lines, four fifths of them numeric?"""

    def numeric(block: Column) -> Column:
        full = F.filter(F.split(block, "\n"), lambda v: strip(v) != "")
        return (F.size(full) >= 6) & (F.size(F.filter(full, is_numeric_line)) >= 0.8 * F.size(full))

    return F.exists(F.regexp_extract_all(c(x), F.lit(FENCE), F.lit(1)), numeric)


def wrapper_echo(x: Column | str) -> Column:
    return c(x).rlike(WRAPPER)


def letters(x: Column | str) -> Column:
    return F.regexp_count(c(x), F.lit("\\p{L}"))


def code_blocks(x: Column | str) -> Column:
    """Bodies of fenced blocks; without any, the whole text if it opens a script; else none."""
    found = F.transform(F.regexp_extract_all(c(x), F.lit(FENCE), F.lit(1)), strip)
    return F.when(F.size(found) > 0, found).when(F.contains(c(x), F.lit("<?php")), F.array(strip(x))).otherwise(F.array().cast("array<string>"))


def format_sanity(x: Column | str) -> Column:
    """1, less 0.6 for an echo, 0.4 for 40 numeric lines and 0.2 for a quarter of repeated lines; 0 at least."""
    off = F.when(wrapper_echo(x), 0.6).otherwise(0.0) + F.when(numeric_streak(x, True) >= 40, 0.4).otherwise(0.0) + F.when(repeated_line_ratio(x) >= 0.25, 0.2).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), 1.0 - off), 4)


def suffix(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(c(path), "/"), -1), "[^.](\\.[^.]+)$", 1))


def content_family(path: Column | str) -> Column:
    s = suffix(path)
    # Fixed values.
    return F.when(s.isin(".php", ".module", ".inc", ".install", ".profile", ".theme"), "php").when(s.isin(".md", ".txt", ".html"), "doc").when(s == ".yml", "yaml").when(s == ".twig", "twig").otherwise("other")


def file_hint(path: Column | str) -> Column:
    return F.element_at(F.split(c(path), "/"), -1)


def module_hint(path: Column | str) -> Column:
    parts = F.split(c(path), "/")
    return F.when(parts[0].isin("repos", "docs") & (F.size(parts) > 1), F.get(parts, 1)).otherwise(parts[0])


def symbol_name(x: Column | str) -> Column:
    """Runs of letters and digits, each with a capital first; a prefix if that doesn't begin with a letter."""
    runs = F.transform(F.regexp_extract_all(c(x), F.lit("[A-Za-z0-9]+"), F.lit(0)), lambda v: F.concat(F.upper(F.substring(v, 1, 1)), v.substr(F.lit(2), F.length(v))))
    name = F.array_join(runs, "")
    return F.when(name == "", "UnknownSymbol").when(name.rlike("^[A-Za-z]"), name).otherwise(F.concat(F.lit("Symbol"), name))


def kind_from_path(path: Column | str) -> Column:
    base = F.lower(file_hint(path))
    return F.when(base.endswith("interface.php"), "interface").when(base.endswith("trait.php"), "trait").when(base.endswith("enum.php"), "enum").otherwise("class")


def slug(x: Column | str) -> Column:
    out = F.regexp_replace(F.regexp_replace(c(x), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.when(out == "", "model").otherwise(out)


def source_bucket(path: Column | str) -> Column:
    """The first two parts of a path."""
    parts = F.filter(F.split(c(path), "/"), lambda v: v != "")
    return F.when(F.size(parts) == 0, "unknown").otherwise(F.array_join(F.slice(parts, 1, 2), "/"))


# --- fingerprints ------------------------------------------------------------


#: Code points that are numbered at once.
PIECE = 1 << 20


def _set_bits(pieces: list[str]):
    """Of each piece (five characters at least), how many of its shingles have each of the 64 bits set. Shingles are numbered, so that each distinct one is hashed once."""
    import numpy as np
    import pandas as pd

    whole, lengths = "".join(pieces), np.array([len(p) for p in pieces])
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    seen = np.zeros(int(points.max()) + 1, bool)
    seen[points] = True
    chars, n = (np.cumsum(seen) - 1)[points], int(seen.sum())
    ends, inside = np.cumsum(lengths), np.ones(len(points), bool)
    for j in range(1, 5):
        inside[ends - j] = False
    places = np.flatnonzero(inside)
    ids, size = chars[places], n
    for j in range(1, 5):
        if size * n >= 1 << 63:  # of many characters, so prefixes are numbered first
            ids, distinct = pd.factorize(ids)
            size = len(distinct)
        ids, size = ids * n + chars[places + j], size * n
    ids, distinct = pd.factorize(ids)
    example = np.empty(len(distinct), np.int64)
    example[ids] = places
    digests = b"".join([hashlib.sha256(whole[p : p + 5].encode("utf-8", "surrogatepass")).digest()[:8] for p in example.tolist()])
    # A byte for each bit, eight to a word: sums of up to 255 words don't carry over.
    words = np.unpackbits(np.frombuffer(digests, np.uint8)).view(np.uint64).reshape(-1, 8)
    windows = lengths - 4
    runs = -(-windows // 255)
    first_run = np.cumsum(runs) - runs
    starts = np.repeat(np.cumsum(windows) - windows - 255 * first_run, runs) + 255 * np.arange(runs.sum())
    sums = np.empty((len(starts), 8), np.uint64)
    for w in range(8):
        sums[:, w] = np.add.reduceat(np.ascontiguousarray(words[:, w])[ids], starts)
    return np.add.reduceat(sums.view(np.uint8).astype(np.int64), first_run, axis=0)


def simhash(x: Column | str) -> Column:
    """64-bit SimHash of five-character shingles, each by the first 8 bytes of its SHA-256."""
    import numpy as np
    import pandas as pd

    def of(texts: pd.Series) -> pd.Series:
        counts, windows = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
        null, owners, pieces, held = np.zeros(len(texts), bool), [], [], 0

        def settle():
            nonlocal owners, pieces, held
            if pieces:
                np.add.at(counts, owners, _set_bits(pieces))
            owners, pieces, held = [], [], 0

        for k, t in enumerate(texts):
            if t is None:
                null[k] = True
                continue
            t = " ".join(t.lower().split()).ljust(5)
            windows[k] = len(t) - 4
            for i in range(0, len(t) - 4, PIECE):
                pieces.append(t[i : i + PIECE + 4])
                owners.append(k)
                held += len(pieces[-1])
                if held >= PIECE:
                    settle()
        settle()
        prints = np.packbits(2 * counts >= windows[:, None], axis=1).view(">i8").ravel().astype(np.int64)
        return pd.Series(prints, dtype="Int64").mask(null)

    of.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(of, "long")(c(x))


def similarity(a: Column | str, b: Column | str) -> Column:
    return 1 - F.bit_count(c(a).bitwiseXOR(c(b))) / 64


# --- token arrays --------------------------------------------------------------


def find_array(whole: Column | str, part: Column | str) -> Column:
    """Zero-based place of the first occurrence of part, or -1."""
    w, p = c(whole), c(part)
    starts = F.when(F.size(w) >= F.size(p), F.sequence(F.lit(1), F.size(w) - F.size(p) + 1)).otherwise(F.array().cast("array<int>"))
    return F.when(F.size(p) == 0, -1).otherwise(F.coalesce(F.get(F.filter(starts, lambda i: F.slice(w, i, F.size(p)) == p), F.lit(0)) - 1, F.lit(-1)))


def completion_labels(ids: Column | str, marker: Column | str) -> Column:
    """ids after the marker; -100 before and in it, and everywhere without one."""
    at = find_array(ids, marker)
    return F.transform(c(ids), lambda x, i: F.when((at >= 0) & (i >= at + F.size(c(marker))), x).otherwise(-100))


def rounded_up(n: Column, multiple: int) -> Column:
    return (F.ceil(n / multiple) * multiple).cast("int")


def padded(ids: Column | str, size: Column, value: int) -> Column:
    return F.concat(F.slice(c(ids), F.lit(1), size), F.array_repeat(F.lit(value), F.greatest(size - F.size(c(ids)), F.lit(0))))
