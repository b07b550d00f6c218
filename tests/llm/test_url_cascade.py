import random
import re

from pyspark.sql import functions as F

from orderloom.llm import url_cascade as uc

from .frames import clashing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    _, rule, _ = max(fits)
    return host, path, rule, "block" if any(r == rule and v == "block" for _, r, v in fits) else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in uc.judged(clashing(pages).drop("host", "rule").withColumns(
        {"rule": F.lit(1), "host": F.lit("x"), "verdict": F.lit(2)}), table).collect()}
    valid = [r for r in rules if None not in r]
    assert [got[i] for i in range(len(urls))] == [plain(u, valid) for u in urls]
    return got


def test_random_rules_and_urls(spark):
    pick = random.Random(6)
    words = ["a", "b", "co", "org", "ex-1", "é", "B"]
    host = lambda n: ".".join(pick.choice(words) for _ in range(pick.randrange(1, n)))
    path = lambda: "".join(pick.choice(["/", "a", "b", "é", "%2F", "."]) for _ in range(pick.randrange(7)))
    rules = [(host(4).lower(), "/" + path(), pick.choice(["allow", "block"])) for _ in range(300)]
    rules += [("org", "", "block"), rules[0], (rules[1][0], rules[1][1], "block"), (None, "/", "block"), ("a", None, "block")]
    urls = [f"{pick.choice(['http', 'HTTPS', ''])}://{host(6)}/{path()}{pick.choice(['', '?a/b', '#c', '?x://y'])}" for _ in range(3000)]
    got = check(spark, urls, rules)
    assert {v[3] for v in got.values()} == {"allow", "block"}


def test_odd_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")]
    urls = [
        None, "", "example.org/es/", "://", "://example.org/es/", "http://EXAMPLE.org/es/x", "http://example.org",
        "http://example.org?/es/", "http://example.org/ES/", "http://notexample.org/es/", "http://.example.org/es/",
        "http://example.org./es/", "a://b://com/de/", "http://com/de/#x", "http://com/de\n/", "http://com/de/\n",
        "http://" + "a." * 20_000 + "com/de/" + "x" * 50_000, "http://com/de/", "http://com/de/", "http:///org/",
    ]
    check(spark, urls, rules)


def test_empty_tables_and_lists(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    assert {r.verdict for r in uc.judged(pages, rules.limit(0)).collect()} == {"allow"}
    assert uc.judged(pages.limit(0), rules).count() == 0
    assert sorted(r.verdict for r in uc.judged(pages, rules).collect()) == ["allow", "block"]


def test_cascade_is_exact_on_its_universe(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.where("hash(key) % 5 = 0")
    cascade = uc.Cascade(listed, keys, listed.count(), 5000)
    assert len(cascade.levels) > 2
    held = keys.where(cascade.holds(F.col("key")))
    assert held.exceptAll(listed).count() == listed.exceptAll(held).count() == 0


def test_main_path_has_no_join(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    plan = uc.judged(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan
