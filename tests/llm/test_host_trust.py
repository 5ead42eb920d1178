"""Url verdicts and host scores next to a plain version."""

import time
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import checking_sql, host_trust

LAWS = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
        ("net", "/es/", "block"), ("net", "/fr/", "block")]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    rest = rest[:end]
    at = rest.find("/") if "/" in rest else len(rest)
    return lower(rest[:at]), rest[at:]


def ruled(url):
    host, path = split(url)
    fits = [r for r in LAWS if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def plain_scores(rows):
    """Scores by a full sweep over all links, again and again."""
    pages, marks, links = Counter(), defaultdict(Counter), Counter()
    for _, url, targets in rows:
        host, _, _, verdict = ruled(url)
        if host:
            pages[host] += 1
            marks[verdict][host] += 1
            for target in {lower(t) for t in targets} - {host}:
                links[host, target] += 1
    scores = []
    for verdict, back in (("allow", False), ("block", True)):
        ways = {((b, a) if back else (a, b)): n for (a, b), n in links.items()}
        sums = Counter()
        for (a, _), n in ways.items():
            sums[a] += n
        seed = {h: n / pages[h] for h, n in marks[verdict].items()}
        score = dict(seed)
        for _ in range(200):
            new = defaultdict(float, seed)
            for (a, b), n in ways.items():
                new[b] += 0.85 * score.get(a, 0.0) * n / sums[a]
            score = new
        scores.append(score)
    return scores


def html(targets):
    forms = ['<a href="https://{}/x">', "<A class=x HREF = '//{}?q'>", "<a href=HTTP://{}#a>"]
    tags = [forms[i % 3].format(target) for i, target in enumerate(targets)]
    return f"<p>{' '.join(tags)} <a href='/own'>own</a> <b href='https://no.org'>"


ROWS = [
    (1, "https://good.com/a", ["linked.org", "Linked.ORG", "other.org"]),
    (2, "https://good.com/b", ["linked.org"]),
    (3, "http://spam.net/es/1", ["farm.org"]),
    (4, "http://spam.net/fr/2", []),
    (5, "http://spam.net/en/3", ["spam.net"]),
    (6, "https://farm.org/x", ["spam.net"]),
    (7, "https://linked.org/x", ["deep.org"]),
    (8, "https://deep.org/x", []),
    (9, "https://half.net/es/1", []),
    (10, "https://half.net/de/2", []),
    (11, "https://far.org/x", ["farm.org"]),
    (12, "https://A.EXAMPLE.com/en/x?y", []),
    (13, "https://www.example.com/en/x#y", []),
    (14, "https://sub.www.example.com/en/", []),
    (15, "https://notexample.com/en/x", []),
    (16, "https://com", ["good.com"]),
    (17, "no scheme/com/x", ["spam.net"]),
    (18, None, ["spam.net"]),
    (19, "://empty", []),
    (19, "://empty", []),
    (None, "https://keyless.net/es/?x", []),
    (21, "https://x.net/es", []),
    (22, "a://b.com/c://d.net/es/", []),
]


def frame_of(spark, rows):
    frame = spark.createDataFrame([(k, u, html(t)) for k, u, t in rows], "page_id long, url string, html string")
    return frame.select("*", *(F.lit("no").alias(c) for c in ("host", "path", "rule", "verdict", "trust", "ruled", "kind", "score", "target")))


def test_verdicts_and_scores_are_the_plain_ones(spark):
    found = host_trust.judge(frame_of(spark, ROWS)).collect()
    trust, distrust = plain_scores(ROWS)
    assert len(found) == len(ROWS)
    rest = Counter((k, *ruled(u)) for k, u, _ in ROWS)
    for row in found:
        own = next(r for r in rest if rest[r] and r[0] == row["page_id"] and r[1:4] == (row["host"], row["path"], row["rule"]))
        rest[own] -= 1
        t, d = trust.get(row["host"], 0.0), distrust.get(row["host"], 0.0)
        assert row["trust"] == pytest.approx(t, abs=0.02) and row["distrust"] == pytest.approx(d, abs=0.02)
        assert row["verdict"] == (own[4] or ("block" if d - t > 0.5 else "allow"))
    with duckdb.connect() as base:
        base.sql("create table pages (page_id bigint, url varchar, html varchar)")
        base.executemany("insert into pages values (?, ?, ?)", [(k, u, html(t)) for k, u, t in ROWS])
        checked = base.sql(checking_sql.HOST_TRUST).fetchall()
    assert Counter(checked) == Counter(tuple(r[:5]) for r in found)
    verdict = {r["page_id"]: r["verdict"] for r in found}
    assert verdict[5] == verdict[6] == "block" and verdict[10] == verdict[8] == verdict[7] == "allow"


def test_links_of_a_page(spark):
    page = ("https://own.org/x", '<a href="https://own.org/a"><!-- <a href="//hidden.org"> --><a\nhref=//one.org>'
            '<a href="//ONE.org/2"><a data-x=1 href = "http://two.org:80?q">text href="//no.org" <link href="//no.org"><a name="//no.org">')
    frame = spark.createDataFrame([page, ("https://own.org/y", None)], "url string, html string")
    assert {tuple(r) for r in host_trust.host_links(frame).collect()} == {("own.org", "one.org", 1), ("own.org", "two.org:80", 1)}


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<a href=" + " " * 50, "<!--", "<a href href "])
def test_long_pages_take_time_in_proportion(spark, piece):
    frame = spark.createDataFrame([("https://own.org/x", piece * (1_000_000 // len(piece)))], "url string, html string")
    began = time.time()
    assert host_trust.host_links(frame).count() == 0
    assert time.time() - began < 10


def test_empty_table(spark):
    assert host_trust.judge(frame_of(spark, ROWS).where("false")).count() == 0


def test_rounds_end_on_a_circle(spark):
    rows = [(i, f"https://h{i}.org/x", [f"h{(i + 1) % 4}.org"]) for i in range(4)] + [(9, "https://seed.com/x", ["h0.org"])]
    found = {r["host"]: r["trust"] for r in host_trust.judge(frame_of(spark, rows)).collect()}
    trust, _ = plain_scores(rows)
    assert all(found[h] == pytest.approx(trust.get(h, 0.0), abs=0.02) for h in found)
