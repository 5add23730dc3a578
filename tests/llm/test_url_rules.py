"""URL rules against a plain search of all rules on all urls."""

import random
import re

import duckdb
from helixframe.llm import url_rules as ur
from helixframe.llm.queries import ORACLE, QUERIES


def found(rule, low):
    return re.search(ur.to_regex(rule).replace("\\z", "\\Z"), low)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host) :])[0]


def judged(url, rules=ur.PATTERNS, host_rules=ur.HOST_RULES):
    host, path = parts(url)
    fitting = [(n + p, k) for k, n, p in host_rules if (host == n or host.endswith("." + n)) and path.startswith(p)]
    if fitting:
        rule, verdict = max(fitting, key=lambda r: len(r[0]))
        return host, path, rule, verdict, []
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    hits = [r for r in rules if url is not None and found(r.pattern, low)]
    verdict = "block" if hits and all(r.verdict == "block" for r in hits) else "allow"
    return host, path, None, verdict, sorted({r.pattern for r in hits})


URLS = [
    None, "", "no scheme", "http://", "://", "https://Example.COM/en/a?x=1", "http://www.example.com/en/", "http://a.www.example.com/en/b#c", "http://example.com", "http://example.com/de/",
    "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/ES/1", "http://net/fr/", "http://netx/fr/", "http://x.org/a://b/c", "http://spam-farm.example.org/en/1", "http://my-spam-farm.example.org/",
    "http://a.spam-farm.example.org/", "http://www.cheap-pills.example.org/x", "http://x.org/casino/9", "http://x.org/Casino/9", "http://x.org/casinos/9", "http://archive.example.org/casino/1", "http://x.org/a.exe",
    "http://x.org/a.exe?b", "http://x.org/cgi-bin/q?a=1&print=1", "http://x.org/p?sessionid=4", "http://x.org/\u00e9/poker/", "http://x.org/line\nbreak/poker/", "http://x.org/" + "long/" * 20_000 + "poker/x", "HTTP://X.ORG/PORN/", "http://x.xxx", "http://x.xxx/", "http://x.org/a.exe\n",
]


def rows():
    rng = random.Random(1)
    pieces = ["casino", "poker", "porn", "spam-farm", "x", "com", "net", "www", "example", "es", "en", "click", "ads", "/", "/", ".", "-", "?", "&", "=", "#", "sessionid", "license.html", ".exe", "_", "%20"]
    made = URLS + ["http://" + "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(600)] + URLS[-5:] * 3
    return [(i, u, "clash", "clash", i, "h") for i, u in enumerate(made)] + [(None, URLS[9], None, None, None, None), (None, None, None, None, None, None)]


SCHEMA = "page_id long, url string, host string, token string, rule long, html string"


def test_query_equals_trying_every_rule(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op12_url_rules"](spark, str(tmp_path))
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((r[0], *judged(r[1])[:4], " ".join(judged(r[1])[4])) for r in rows()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(w[4] == "block" and w[3] is None for w in want) > 20
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(duck.execute(ORACLE["op12_url_rules"]).fetchall(), key=repr) == want


def test_other_rules_and_no_rows(spark):
    pages = spark.createDataFrame(rows(), SCHEMA)
    rules = [ur.Rule("block", "oke"), ur.Rule("block", "|http://x."), ur.Rule("block", "*"), ur.Rule("allow", "-casino"), ur.Rule("block", "spam-farm"), ur.Rule("block", "^es^"), ur.Rule("block", "[x].\\$")]
    for given, hosts in ((rules, ()), (rules[4:6], ur.HOST_RULES), ((), ur.HOST_RULES), ((), ())):
        got = ur.judge(pages, given, hosts).select("page_id", "host", "path", "rule", "verdict", "patterns").collect()
        assert sorted(map(repr, got)) == sorted(repr(type(got[0])(page_id=r[0], host=j[0], path=j[1], rule=j[2], verdict=j[3], patterns=j[4])) for r in rows() for j in [judged(r[1], given, hosts)])
    assert ur.judge(pages.limit(0)).count() == 0


def test_rules_are_filed_under_tokens_that_must_be_whole():
    assert ur.whole_tokens("||spam-farm.*^") == ["farm", "spam"]
    assert ur.whole_tokens("||*cheap-pills.") == ["pills"]
    assert ur.whole_tokens(".exe|") == ["exe"]
    assert ur.whole_tokens("casino") == [] and ur.whole_tokens("/casino") == [] and ur.whole_tokens("/casino^x") == ["casino"]
    assert ur.whole_tokens("|http://x") == ["http"] and ur.whole_tokens("a|b") == []
    rng = random.Random(2)
    for _ in range(3000):
        pattern = "".join(rng.choice(["a", "b1", "/", ".", "*", "^", "|", "||", "-"]) for _ in range(rng.randrange(1, 8)))
        url = "".join(rng.choice(["http://", "a", "b1", "/", ".", "-", "ab"]) for _ in range(rng.randrange(1, 10)))
        if found(pattern, url):
            assert set(ur.whole_tokens(pattern)) <= set(re.findall("[a-z0-9]+", url)), (pattern, url)
