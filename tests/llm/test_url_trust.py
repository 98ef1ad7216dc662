import re

import numpy as np

from registrum.llm import url_trust
from registrum.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def brute(pages):
    """Verdicts by dense matrices."""
    own = [(page, *split(url), html or "") for page, url, html in pages]
    hosts = sorted({h for _, h, _, _ in own if h} | {split("x:" + m)[0] for *_, t in own for m in re.findall(r'href="(?:https?:)?(//[^"]+)', t)} | {split(m)[0] for *_, t in own for m in re.findall(r'href="(https?://[^"]+)', t)})
    hosts = [h for h in hosts if h]
    at = {h: i for i, h in enumerate(hosts)}
    n = len(hosts)
    edges = np.zeros((n, n))
    counts = np.zeros((n, 3))
    for _, host, path, html in own:
        if not host:
            continue
        found = rule(host, path)
        counts[at[host], 0] += 1
        if found:
            counts[at[host], 1 + (found.verdict == "block")] += 1
        for link in {m for m in re.findall(r'href="((?:https?:)?//[^"]+)"', html)}:
            to = split(link if "://" in link else "x:" + link)[0]
            if to and to != host:
                edges[at[host], at[to]] += 1
    for h in hosts:
        parent = h.partition(".")[2]
        if "." in parent and parent in at and counts[at[h], 0] and counts[at[parent], 0]:
            edges[at[h], at[parent]] += 1
            edges[at[parent], at[h]] += 1

    def rank(matrix, column):
        seed = np.where(2 * counts[:, column] > counts[:, 0], counts[:, column] / np.maximum(counts[:, 0], 1), 0)
        if not seed.sum():
            return np.zeros(n)
        seed /= seed.sum()
        out = matrix.sum(1, keepdims=True)
        share = np.divide(matrix, out, out=np.zeros_like(matrix), where=out > 0)
        r = seed
        for _ in range(url_trust.ROUNDS):
            r = url_trust.DAMPING * r @ share + (1 - url_trust.DAMPING) * seed
        return r

    trust, distrust = rank(edges, 1), rank(edges.T, 2)
    out = []
    for page, host, path, _ in own:
        found = rule(host, path)
        spread = "block" if host and round(distrust[at[host]] - trust[at[host]], 12) > 0 else "allow"
        out.append((page, host, path, found.text if found else None, found.verdict if found else spread))
    return out


def run(spark, pages):
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, host string, rule int")
    return url_trust.judge(df.repartition(3), URL_RULES)


def test_matches_brute_force(spark):
    pages = [
        (1, "http://Good.example.NET/en/1", '<a href="https://friend.com/x">'),
        (2, "http://good.example.net/en/2", '<a href="//friend.com/x"> <a href="/here">'),
        (3, "http://bad.net/", None),
        (4, "http://linker.com/a?b#c", '<a href="http://bad.net/1"><a href="http://bad.net/2">'),
        (5, "http://friend.com", '<a href="http://third.com/">'),
        (6, "http://third.com/x", ""),
        (7, "http://www.linker.com/x", "plain"),
        (8, None, '<a href="http://bad.net/">'),
        (9, "no scheme", "x"),
        (None, "http://a.org/fr/x", "é" * 200_000),
        (10, "http://xnet/", ""), (11, "http://net", ""), (12, "http://İ.example.com/de/?q", ""),
        (3, "http://bad.net/", None), (3, "http://bad.net/", None),
    ]
    found = run(spark, pages).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(pages)))
    by_page = {r.page_id: r.verdict for r in found}
    assert by_page[4] == by_page[7] == "block"
    assert by_page[5] == by_page[6] == "allow"


def test_query_matches_brute_force(spark):
    from registrum.llm.queries import op2_link_trust

    folder = "/root/testdata/sf0.01"
    pages = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    df = op2_link_trust(spark, folder)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    found = df.select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(pages)))


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_trust.judge(df, URL_RULES).count() == 0


def test_far_and_thinly_linked_hosts(spark):
    pages = [(0, "http://bad.net/", "")]
    # A chain of 30 links, and levels of 100 hosts each that link to one host of the level before.
    hosts = ["bad.net", *[f"far{i}.com" for i in range(30)]]
    links = [*zip(hosts[1:], hosts)]
    for level in range(8):
        to = f"level{level - 1}x0.com" if level else "bad.net"
        links += [(f"level{level}x{i}.com", to) for i in range(100)]
    pages += [(i, f"http://{h}/", f'<a href="http://{to}/">') for i, (h, to) in enumerate(links, 1)]
    found = run(spark, pages).collect()
    assert {r.verdict for r in found} == {"block"}
    assert 0 < min(r.distrust for r in found) < 1e-13
