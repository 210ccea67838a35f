import random
import re

import pytest

from factprep.llm import queries, url_rules
from factprep.llm.url_rules import Rule


def random_rules(rng, count):
    parts = ["ads", "track", "a1", "x", "Page", "com", "net"]
    rules = []
    for _ in range(count):
        body = "".join(rng.choice(parts) + rng.choice(["/", ".", "*", "^", "?", "=", ""]) for _ in range(rng.randint(1, 3)))
        rules.append(Rule(rng.choice(["", "", "||", "|http://"]) + body + rng.choice(["", "", "|"]), rng.choice(["block", "allow"])))
    return list({r.pattern: r for r in rules}.values())


def random_address(rng):
    parts = ["ads", "track", "a1", "x", "Page", "com", "net", "adsx", "1a1"]
    some = lambda seps: "".join(rng.choice(parts) + rng.choice(seps) for _ in range(rng.randint(1, 4)))
    return rng.choice(["http://", "HTTPS://", "", "a:b://"]) + some(".") + rng.choice(parts) + rng.choice(["/", "?", ""]) + some("/?=.&-")


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_what_trying_all_rules_finds(spark, monkeypatch, seed):
    rng = random.Random(seed)
    rules, addresses = random_rules(rng, 60), [random_address(rng) for _ in range(400)] + [None, "", "://", "x://Ünï.ORG/ß"]
    monkeypatch.setattr(url_rules, "BLOCK", 25)
    pages = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    rows = url_rules.judge(pages, rules).collect()
    compiled = {r: re.compile(url_rules.expression(r.pattern), re.DOTALL) for r in rules}
    tried = 0
    for r in rows:
        address = url_rules.normalised(addresses[r.page_id])
        fits = [rule for rule, e in compiled.items() if e.search(address)]
        best = max(fits, key=Rule.order, default=None)
        assert (r.pattern, r.verdict) == ((best.pattern, best.verdict) if best else (None, "allow")), addresses[r.page_id]
        tried += r.tried
    assert tried < 0.6 * len(rules) * len(rows)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        (None, "", "", None, "allow"),
        ("no scheme.net/x", "", "", None, "allow"),
        ("http://Foo.NET", "foo.net", "", None, "allow"),
        ("http://foo.net/", "foo.net", "/", "net/", "block"),
        ("http://foonet/", "foonet", "/", None, "allow"),
        ("http://net/EN", "net", "/EN", "net/", "block"),
        ("http://a.example.net/en/1#x", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://a.example.net/EN/1", "a.example.net", "/EN/1", "net/", "block"),
        ("http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
        ("x://EXAMPLE.com/de/?utm_source=1", "example.com", "/de/", "example.com/de/", "block"),
        ("x://a.org/fr/?utm_source=1", "a.org", "/fr/", "org/fr/", "allow"),
        ("x://a.org/es/?utm_source=1", "a.org", "/es/", None, "block"),
        ("http://a?x://b.net/", "a", "", None, "allow"),
        ("http://KÄ.org/fr/", "kÄ.org", "/fr/", "org/fr/", "allow"),
    ],
)
def test_rules_of_the_query(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "kept")], "page_id long, url string, verdict string")
    row = url_rules.judge(pages, queries.BASE_RULES + queries.PATTERN_RULES).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_odd_and_empty_tables(spark):
    nothing = spark.createDataFrame([], "page_id long, url string, host int")
    assert url_rules.judge(nothing, queries.BASE_RULES).collect() == []
    rows = spark.createDataFrame([(1, "http://a.net/" + "x" * 50_000)] * 3, "page_id long, url string")
    assert [r.verdict for r in url_rules.judge(rows, queries.BASE_RULES).collect()] == ["block"] * 3
    assert [r.verdict for r in url_rules.judge(rows, [], default="block").collect()] == ["block"] * 3
