"""Record-level parts of a crawl: paths of URLs, links, the frontier, fetch results."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def storage_path(url: Column | str) -> Column:
    """Host with underscores, then the path; ``index`` for none; ``.html`` unless it has a suffix that is kept."""
    u = F.col(url) if isinstance(url, str) else url
    host = F.replace(F.regexp_extract(u, "://([^/?#]*)", 1), F.lit("."), F.lit("_"))
    path = F.regexp_replace(F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1), "^/+|/+$", "")
    path = F.when(path == "", "index").otherwise(path)
    return F.concat(host, F.lit("/"), F.when(path.rlike("\\.(html|md|json|xml)$"), path).otherwise(F.concat(path, F.lit(".html"))))


def links(pages: DataFrame) -> DataFrame:
    """page url and every link in it, resolved, without fragments."""

    def resolve(base: pd.Series, href: pd.Series) -> pd.Series:
        def one(b: str, h: str) -> str | None:
            try:
                return urljoin(b, h)
            except ValueError:
                return None

        return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)])

    resolve.__annotations__ = {"base": pd.Series, "href": pd.Series, "return": pd.Series}
    found = pages.select("url", F.explode(F.regexp_extract_all("html", F.lit("<a\\s[^>]*href=\"([^\"]*)\""), F.lit(1))).alias("href"))
    return found.select("url", F.substring_index(F.pandas_udf(resolve, "string")("url", "href"), "#", 1).alias("link")).where("link is not null")


def reachable(start: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """Breadth first from start (url) over edges (url, link), up to ``most`` pages, which is the crawl's limit."""
    seen = start.select("url", F.lit(0).alias("depth")).distinct().persist()
    frontier, depth = seen, 0
    while frontier.limit(1).count() and seen.count() < most:
        depth += 1
        frontier = frontier.join(edges, "url").select(F.col("link").alias("url")).distinct().join(seen, "url", "left_anti").withColumn("depth", F.lit(depth)).persist()
        seen = seen.unionByName(frontier).persist()
    return seen.orderBy("depth", "url").limit(most)


def fetch_rollup(fetched: DataFrame) -> DataFrame:
    return fetched.agg(F.count("*").alias("n"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.count_if(F.col("success") & (F.col("pages") > 0)).alias("valid"))
