import math

from pyspark.sql import functions as F

from shelfwise.llm import url_reputation as U

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for what, rule in RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(rule) > len(best[1])):
            best = (what, rule)
    return best or (None, None)


def reputation(outcomes):
    """Plain version: host -> (rate, upper), corpus rate."""
    hosts = {}
    for h, y in outcomes:
        n, g = hosts.get(h, (0, 0))
        hosts[h] = (n + (y is not None), g + (y or 0))
    rate = (sum(g for _, g in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)

    def level(units, prior):
        live = [(n, g, prior[u]) for u, (n, g) in units.items() if n]
        weight = sum((n - 1) * m * (1 - m) for n, _, m in live)
        spread = sum(n * (g / n - m) ** 2 for n, g, m in live)
        within = sum(m * (1 - m) for _, _, m in live)
        rho = (spread - within) / weight if weight > 0 else None
        s = 1 / rho - 1 if rho is not None and rho > 0 else U.MAX_STRENGTH
        return max(U.MIN_STRENGTH, min(U.MAX_STRENGTH, s))

    def up(units, key):
        out = {}
        for u, (n, g) in units.items():
            a, b = out.get(key(u), (0, 0))
            out[key(u)] = (a + n, b + g)
        return out
    dom, suf = lambda h: ".".join(h.split(".")[-2:]), lambda h: h.split(".")[-1]
    domains, suffixes = up(hosts, dom), up(hosts, suf)
    k = level(suffixes, dict.fromkeys(suffixes, rate))
    srate = {u: (g + k * rate) / (n + k) for u, (n, g) in suffixes.items()}
    k = level(domains, {d: srate[suf(d)] for d in domains})
    drate = {u: (g + k * srate[suf(u)]) / (n + k) for u, (n, g) in domains.items()}
    k = level(hosts, {h: drate[dom(h)] for h in hosts})
    out = {}
    for h, (n, g) in hosts.items():
        p, size = (g + k * drate[dom(h)]) / (n + k), n + k
        a = p * size
        out[h] = (p, min(1, p + U.BOUND_Z * math.sqrt(a * (size - a) / (size * size * (size + 1)))))
    return out, rate


def test_parse_rules_and_reputation_match_a_plain_version(spark):
    urls = []
    for i in range(400):
        host = ["a.x.com", "b.x.com", "WWW.Bad.org", "m.example.net", "example.com", "net", "k.example.org", "c.y.io"][i % 8]
        urls.append((i, f"https://{host}/{['en', 'de', 'fr', 'Fr'][i // 8 % 4]}/{i}{['', '?q=/de/', '#x', '/'][i // 32 % 4]}"))
    urls += [(900, None), (901, "no scheme/en/"), (902, "http://example.net"), (903, "http://"), (904, "x://HOST?a/b"), (905, "http://notnet/"),
             (906, "ftp://sub.net/"), (907, "http://a://b/c"), (None, "http://a.x.com/"), (5, urls[5][1]), (908, "")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("outcome", F.lit(1))
    labels = [(i, int(i % 8 != 2 or i % 5 == 0)) for i in range(0, 400, 2)] + [(7, None), (2, 1), (12345, 0), (None, 0)]
    lab = spark.createDataFrame(labels, "page_id long, outcome int").withColumn("host", F.lit("clash"))
    got = U.judge_urls(pages, lab, RULES).collect()
    best = {}
    for i, y in labels:
        if y is not None:
            best[i] = min(y, best.get(i, 1))
    rep, rate = reputation([(parse(u)[0], best.get(i) if i is not None else None) for i, u in urls])
    assert len(got) == len(urls)
    expect = []
    for i, u in urls:
        h, p = parse(u)
        what, rule = rule_of(h, p)
        expect.append((i, h, p, rule, what or ("block" if rep[h][1] < U.MIN_SHARE * rate else "allow"), round(rep[h][0], 6)))
    assert sorted(map(repr, expect)) == sorted(repr((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["host_rate"])) for r in got)
    assert {r["verdict"] for r in got if r["host"] == "www.bad.org" and r["rule"] is None} == {"block"}
    assert {r["verdict"] for r in got if r["host"] == "a.x.com"} == {"allow"}


def test_empty_and_unlabelled(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, outcome int")
    assert U.judge_urls(pages, none, RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r["verdict"] for r in U.judge_urls(one, none).collect()] == ["allow"]
