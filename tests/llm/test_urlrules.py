import random
import re

from tests.llm.helpers import SF, rows
from voxloom.llm import catalog, urlrules

RULES = "host string, path string, verdict string"


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_random_rules_and_urls(spark):
    r = random.Random(3)
    hosts = [".".join(r.choices(["a", "b", "c", "é"], k=r.randint(1, 4))) for _ in range(60)]
    made = {(r.choice(hosts), "/" + "".join(r.choices("xy/", k=r.randint(0, 4)))): r.choice(["allow", "block"]) for _ in range(150)}
    rules = [(h, p, v) for (h, p), v in made.items()]
    urls = [
        (k if k % 7 else None,
         r.choice(["http://", "", "s://", "HTTP://A."]) + (r.choice(hosts).upper() if k % 2 else r.choice(hosts))
         + r.choice(["", "/", "?q", "#", "/" + "".join(r.choices("xy/", k=r.randint(0, 6)))]))
        for k in range(2000)
    ]
    urls += [(1, None), (None, None), (5, "://"), (5, ""), (6, "h://" + "a." * 3000 + "b/x")] + [(9, "http://a.b/xx")] * 500
    df = spark.createDataFrame(urls, "page_id long, url string")
    got = urlrules.judge(df, spark.createDataFrame(rules, RULES))
    want = {}
    for i, u in urls:
        key = (i, u, *plain(u, rules))
        want[key] = want.get(key, 0) + 1
    assert rows(got) == want


def test_edges(spark):
    df = spark.createDataFrame([(1, "h://x.com/a", "old")], "page_id long, url string, HOST string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("COM", "/", "block"), (None, "/", "block")], RULES)
    got = urlrules.judge(df, rules)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert tuple(got.first())[2:] == ("x.com", "/a", "com/", "block")
    assert urlrules.judge(df.limit(0), rules).count() == 0
    assert urlrules.judge(df, rules.limit(0), default="block").first().verdict == "block"


def test_no_python_in_the_plan(spark):
    plan = catalog.op8_url_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
