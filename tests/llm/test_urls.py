"""URL rules against a plain version."""
import random

import pytest

from halfhourly.llm import urls


def by_hand(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[:min(ends, default=len(rest))]
    path = rest[len(host):]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if h is not None and p is not None and host
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None, key=lambda f: f[:2])
    if best:
        v = min(v for *_, r, v in fits if r == best[2])
        return host, path, best[2].lower() if best[2] else best[2], v
    return host, path, None, "allow"


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(3)
    tops, paths = ["com", "net", "co.uk", "é.org", "comx"], ["", "/", "/a", "/ab", "/a/b", "/a/b/c", "/é", "/a\U0010ffff"]
    out = [None, "", "no url", "://", "http://", "http:///a", "HTTP://WWW.Example.COM/En/", "x://a.com?://b.net/",
           "http://com", "http://com./a", "http://..com/a", "http://a.com/" + "ab/" * 5000]
    for _ in range(600):
        host = ".".join([*rng.choices(["a", "b", "www", "A", "é"], k=rng.randrange(0, 4)), rng.choice(tops)])
        out.append(rng.choice(["http", "", "x"]) + "://" + host + rng.choice(paths) + rng.choice(["", "?q=/a", "#/a/b", "z"]))
    return out + ["http://a.com/a/b"] * 400


RULES = [("com", "/", "allow"), ("com", "", "block"), ("a.com", "/a", "block"), ("a.com", "/a/b", "allow"),
         ("b.a.com", "/a/b/c", "block"), ("com", "/a/b", "block"), ("com", "/ab", "block"), ("net", "/a/", "block"),
         ("www.a.com", "/", "block"), ("org", "/é", "block"), ("é.org", "", "block"), ("a.com", "/a", "allow"),
         (None, "/", "block"), ("net", None, "block"), ("CO.UK", "/a", "block"), ("uk", "/a\U0010ffff", "block")]


@pytest.mark.parametrize("rules", [RULES, RULES[:1], [], [(h, p, "block") for h in ("com", "a.com", "b.com", "net")
                                                          for p in ("", "/", "/a", "/a/", "/a/b", "/a/b/", "/ab", "/b")]])
def test_against_brute_force(spark, pages, rules):
    table = spark.createDataFrame([(i if i != 20 else None, u, "x") for i, u in enumerate(pages)],
                                  "page_id long, url string, host string")
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(map(tuple, urls.judged_urls(table, known, ["page_id"]).collect()), key=repr)
    want = sorted([(i if i != 20 else None, *by_hand(u, rules)) for i, u in enumerate(pages)], key=repr)
    assert got == want


def test_no_pages_and_no_python(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    out = urls.judged_urls(pages, rules, ["page_id"])
    assert out.count() == 0 and "Python" not in out._jdf.queryExecution().executedPlan().toString()
