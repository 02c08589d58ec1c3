"""Rules, links and masses against a plain version, and the query against its SQL."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest
from compare import connect, differences

from tidewheel.llm.link_trust import FOLLOW, KINDS, OP11_SQL, ROUNDS, RULES, UNIT, judge, links_between, op11_link_trust, parsed

SCHEMA = "page_id long, url string, html string, host string, rule string, trust long"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_of(host, path):
    fits = [(len(r), r, v) for r, v in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits)[1:] if fits else (None, None)


def expected(pages, targets):
    places = [(i, *split(u), t) for (i, u, _), t in zip(pages, targets)]
    judged = [(i, h, p, *rule_of(h, p), t) for i, h, p, t in places]
    seeds, weight = defaultdict(lambda: [0, 0, 0]), defaultdict(int)
    for _, h, _, _, v, t in judged:
        if h:
            seeds[h][{"allow": 0, None: 1, "block": 2}[v]] += 1
            for other in set(t) - {h}:
                weight[h, other] += 1
    for pair in {(a, a.split(".", 1)[1]) for h in list(seeds) for a in [".".join(h.split(".")[k:]) for k in range(h.count(".") + 1)] if a.count(".") >= 2}:
        weight[pair] += 1
        weight[pair[::-1]] += 1
    out, into = defaultdict(int), defaultdict(int)
    for (a, b), w in weight.items():
        out[a] += w
        into[b] += w
    restart = {h: [math.floor(n * UNIT * (1 - FOLLOW)) for n in v] for h, v in seeds.items()}
    mass = restart
    for _ in range(ROUNDS):
        new = defaultdict(lambda: [0, 0, 0], {h: list(v) for h, v in restart.items()})
        for (a, b), w in weight.items():
            for k in (0, 1):
                new[b][k] += math.floor(mass.get(a, (0, 0, 0))[k] * FOLLOW * (w / out[a]))
            new[a][2] += math.floor(mass.get(b, (0, 0, 0))[2] * FOLLOW * (w / into[b]))
        mass = new
    rows = []
    for i, h, p, r, v, _ in judged:
        m = mass[h] if h else [None] * 3
        v = v or ("block" if h and m[2] * 100 >= sum(m) * 50 else "allow")
        rows.append((i, h, p, r, v, *m))
    return rows


def case():
    rng = random.Random(5)
    hosts = ["a.example.com", "example.com", "www.example.com", "news.org", "b.news.org", "spam.net", "x.spam.net", "farm.info", "far.farm.info", "co", "MiXeD.Org"]
    pages, targets = [], []
    for k in range(300):
        host = rng.choice(hosts)
        url = f"https://{host}/{rng.choice(['en', 'fr', 'es'])}/{k}?q=://no/#x"
        linked = rng.sample(hosts, rng.randint(0, 3)) if host != "farm.info" else ["spam.net"]
        quote = rng.choice(['"', "'", ""])
        html = "".join(f"<a HREF = {quote}{rng.choice(['http://', '//', 'HTTPS://'])}{t}/fr/1{quote}>x</a>" for t in linked) + '<a href="/own">y</a> href is //not.a.link'
        pages.append((k, url, html))
        targets.append([t.lower() for t in linked])
    pages += [(900, "http://bad.net/fr/1", "<a href=//linked.info>")] * 40 + [(906, "http://lone.info/", "<a href=//bad.net>"), (907, "http://linked.info/", "")] + [(901, None, "x"), (None, "no host", "<a href='//news.org/'>"), (903, "http://", ""), (904, "http://?x", None), (905, "ftp://com/", "")]
    targets += [["linked.info"]] * 40 + [["bad.net"], []] + [[], ["news.org"], [], [], []]
    return pages, targets


def test_masses_and_verdicts(spark):
    pages, targets = case()
    table = spark.createDataFrame([(*p, "h", "r", 1) for p in pages], SCHEMA)
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    rows = judge(table, rules).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected(pages, targets)))
    verdict = {(r.host, r.rule): r.verdict for r in rows}
    # who links to nothing but a blocked host is blocked, who is linked by it is not
    assert verdict["lone.info", None] == "block" and verdict["linked.info", None] == "allow"


def test_links(spark):
    html = """<a href="http://b.org/x">1</a><img SRC='//c.org'><form action=https://d.org?x><a href="/e.org"><a href="mailto:x@f.org"><a href=http://A.org/>"""
    rows = parsed(spark.createDataFrame([(1, "http://a.org/", html)] * 2, "page_id long, url string, html string"))
    assert sorted(rows.first().linked) == ["a.org", "b.org", "c.org", "d.org"]
    assert sorted((r.src, r.dst, r.weight) for r in links_between(rows).collect()) == [("a.org", f"{x}.org", 2) for x in "bcd"]


def test_empty_table(spark):
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    assert judge(spark.createDataFrame([], SCHEMA), rules).isEmpty()


@pytest.mark.parametrize("columns", [("page_id", "host", "path", "rule", "verdict", *KINDS)])
def test_against_sql(spark, sf_dir, columns):
    assert tuple(op11_link_trust(spark, sf_dir).columns) == columns
    assert differences(spark, connect(sf_dir), op11_link_trust, OP11_SQL, sf_dir) == []
