from quire.llm.redirects import judge_urls, rules_table

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SCHEMA = "page_id long, url string, html string, rule string, host int"


def judge(spark, rows, redirects=None):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    red = spark.createDataFrame(redirects, "src string, dst string") if redirects else None
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict)
                   for r in judge_urls(df, rules_table(spark, RULES), red).collect()), key=repr)


def brute_own(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for h, p, v in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, v)
    return (host, path, *(best or (None, None)))


def test_rules(spark):
    urls = ["http://a.example.org/es/1", "HTTP://EXAMPLE.ORG/en/12?x", "https://example.org/en/2", "http://x.com/de/",
            "http://com/fr/x", "http://x.com/es", "http://notorg/", "http://my.org", "http://my.org?/", "nohost", None, "",
            "http://a.b://c/d", "://org/x", "http://xexample.org/es/", "http://É.org/\n/x#f", "http://www.org/" + "a" * 50_000,
            "http://" + "a." * 2000 + "org/p"]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(0, urls[0], "")]
    want = []
    for i, u, _ in rows:
        h, p, rule, v = brute_own(u)
        want.append((i, h, p, rule, v or "allow"))
    assert judge(spark, rows) == sorted(want, key=repr)


def test_aliases_take_decisions(spark):
    canon = "<html><link href='{}' rel=\"canonical\"><body>"
    moved = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "http://a.net/x", canon.format("http://s.com/de/1")),         # blocked through its canonical
        (2, "http://a.net/y#top", moved.format("x")),                     # relative redirect, second hop
        (3, "http://s.com/de/1", None),
        (4, "http://b.net/1", canon.format("http://t.com/de/2")),         # a block and an allow: allow wins
        (5, "http://b.net/2", canon.format("//b.net/1")),
        (6, "http://ok.org/", moved.format("http://B.NET/2")),
        (7, "http://t.com/de/2", None),                                   # its own rule stays
        (8, "http://c.net/", "<p>canonical"),
        (9, "http://d.net/p", None),
        (None, "http://a.net/x", None),
    ]
    got = {r[0]: r[4] for r in judge(spark, rows, [("http://d.net/p", "http://s.com/de/1"), (None, "http://x.net/")])}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block",
                   8: "allow", 9: "block", None: "block"}


def test_empty(spark):
    assert judge(spark, []) == []
    df = spark.createDataFrame([(1, "http://a.org/", "")], "page_id long, url string, html string")
    assert judge_urls(df, rules_table(spark, [])).first().verdict == "allow"
