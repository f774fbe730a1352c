from loamline.llm import url_filters as u


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_against_brute_force(spark):
    rules = [*u.RULES, ("b.a", "/", "block"), ("a", "/x", "allow"), ("a", "/xy", "block"), ("b.a", "/xy", "allow"), ("b.a", "", "allow"), ("a", "/xy", "block")]
    urls = [None, "", "no", "http://", "http://ORG", "http://ORG/", "https://x.example.org/es/1", "https://example.org/es", "https://example.org/en/12?q#f", "http://borg/", "http://.org/", "http://a/x", "http://c.a/xyz", "http://b.a/xyz", "http://b.a?x", "http://d.b.a/xa#", "http://a//://b", "http://é.com/fr/é", "http://com/de/"] * 3
    urls += [f"http://h{i % 5}.b.a/x{'y' * (i % 3)}" for i in range(300)]
    pages = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(urls)], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in u.judge(pages, u.rule_table(spark, rules), keys_per_salt=40).collect()}
    assert got == {i: brute(x, rules) for i, x in enumerate(urls)}


def test_repeated_rows_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, "x://com/de/")], "page_id long, url string")
    rows = u.judge(pages, u.rule_table(spark, u.RULES)).collect()
    assert len(rows) == 3 and sorted(r["verdict"] for r in rows) == ["allow", "allow", "block"]
    none = spark.createDataFrame([], "rule_host string, rule_path string, rule_verdict string")
    assert u.judge(pages, none).where("verdict = 'allow' and rule is null").count() == 3
    assert u.judge(pages.limit(0), none).count() == 0
