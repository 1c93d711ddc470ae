import random
import re

from helpers import rows_of

from parcelgrid.llm import url_filter as U


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "[":
            out += re.escape(glob[i + 1])
            i += 1
        elif glob[i : i + 2] == "**":
            out += ".*"
            i += 1
        else:
            out += {"*": "[^/]*", "?": "."}.get(c) or re.escape(c)
        i += 1
    return re.compile(out, re.S)


def test_automaton_against_regexes():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", "?", "*", "**"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    globs = [g for g in globs if "***" not in g] + ["", "*", "**", "a[*b", "x" * 150 + "*y"]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    texts += ["a*b", "x" * 150 + "zzy", "x" * 150 + "/y", "b" * 3000]
    found = U.Automaton(globs).run([t.encode() for t in texts])
    for row, text in zip(found, texts):
        assert [bool(x) for x in row] == [bool(as_regex(g).fullmatch(text)) for g in globs], text


def judged(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        r
        for r in U.RULES
        for h, _, p in [r.text.partition("/")]
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
    ]
    if fits:
        best = max(fits, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    blocked = any(as_regex(g).fullmatch(host + path) for g in U.BLOCKED)
    return host, path, None, "block" if blocked else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://NET/", "http://net", "http://a.net/x?net/", "http://xnet/",
    "https://example.net/en/1", "https://sub.EXAMPLE.net/en/", "https://example.net/en", "https://badexample.net/en/q",
    "http://example.com/de/ü#x", "http://example.com/DE/", "http://a.org/fr/", "http://org/fr/x", "http://org/frx",
    "http://good.com/x.net/y", "http://good.com?x=a.net/", "http://good.com#a.org/fr/", "x://y://net/",
    "https://ads-track.example.org/en/5", "https://a.ads-track.io/", "http://q.com/login/", "http://q.com/a/login/",
    "http://q.com/a.exe", "http://q.com/track.php?x", "http://ÄÖ.net/é", "http://a.org/" + "f" * 20000, "http://a\nb.net/\n",
]


def test_urls_against_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(1, URLS[10]), (None, URLS[9])]
    table = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS rule")
    want = sorted(((i, *judged(u)) for i, u in rows), key=repr)
    assert rows_of(U.judge(table)) == want
    assert U.judge(table.limit(0)).count() == 0


def test_page_bodies_are_not_read(spark):
    from helpers import SMALL

    plan = U.judge(spark.read.parquet(f"{SMALL}/pages.parquet"))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan
