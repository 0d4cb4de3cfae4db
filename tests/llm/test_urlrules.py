import random

from molarflow.llm import urlrules as U

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
         ("block", "b.example.org/x"), ("block", "c.org"), ("allow", "c.org/ok/")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for action, rule in RULES:
        h, _, p = rule.partition("/")
        p = rule[len(h):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0,), (len(rule), rule, action))
    return host, path, best[1] if best else None, best[2] if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://com", "http://a.com/", "https://Example.COM/en/1?x#y", "http://www.example.com/en/2",
        "http://x.net/fr/9", "http://net/es/", "http://net/ess/", "http://b.example.org/xyz", "http://a.b.example.org/x", "http://c.org",
        "http://d.c.org/ok/1", "http://d.c.org/ok", "http://notc.org/", "ftp://u@x.com:80/a//b/", "http://a..com/", "http://É.com/É/",
        "http://x.com#f/", "http://x.com?q=/en/", "http://" + "a." * 300 + "com/" + "d/" * 300, "http://a.com://b.net/fr/"]


def test_every_url_against_brute_force(spark):
    r = random.Random(0)
    parts = ["example", "www", "com", "net", "org", "c", "b", "en", "es", "fr", "ok", "x"]
    urls = URLS + ["http://" + ".".join(r.choices(parts, k=r.randint(1, 4))) + "/" + "/".join(r.choices(parts, k=r.randint(0, 3)))
                   + r.choice(["", "/", "?a", "#b"]) for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "h", "n") for i, u in enumerate(urls)], "page_id bigint, url string, host string, short string")
    got = {x.page_id: x for x in U.judge(pages, U.rule_table(spark, RULES)).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert tuple(got[i])[1:] == brute(u), u


def test_repeats_no_rules_empty_table_and_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, None)], "page_id bigint, url string")
    out = U.judge(pages, U.rule_table(spark, RULES))
    assert sorted(x.verdict for x in out.collect()) == ["allow"] * 3
    none = U.judge(pages, U.rule_table(spark, [])).collect()
    assert [(x.rule, x.verdict) for x in none] == [(None, "allow")] * 3
    assert U.judge(pages.where("false"), U.rule_table(spark, RULES)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Cartesian", "NestedLoop"))
