"""Verdicts that end their rounds early are those of settled ranks, and of a dense solution."""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))
from conftest import SF

from quillon.llm import queries, url_filter


def test_chain_ends_as_with_settled_ranks(spark):
    """Trust and distrust from either end of a chain of hosts: the verdict turns in its middle."""
    hosts = [f"h{k}.org" for k in range(30)]
    rows = [(k, f"http://{h}/", f'<a href="http://{hosts[k + 1]}/">x</a>' if k < 29 else "") for k, h in enumerate(hosts)]
    rows += [(100, "http://good.com/", '<a href="http://h0.org/">x</a>'), (101, "http://h29.org/a", '<a href="http://bad.net/">x</a>'), (102, "http://bad.net/es/1", ""), (103, "http://alone.org/", None), (104, None, "x"), (100, "http://good.com/", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    slow = sorted((r["page_id"], r["verdict"]) for r in url_filter.judge(pages).collect())
    fast = sorted((r["page_id"], r["verdict"]) for r in url_filter.digest(pages).collect())
    assert fast == slow and {v for _, v in fast} == {"allow", "block"}


def test_whole_table_against_a_dense_solution(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]

    def split(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    def rule(host, path):
        fit = [(len(h + p), v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1] if fit else None

    seeds = {"allow": Counter(), "block": Counter()}
    edges: Counter = Counter()
    own = {split(u)[0] for _, u, _ in pages} - {""}
    for _, url, html in pages:
        host, path = split(url)
        if rule(host, path):
            seeds[rule(host, path)][host] += 1
        for link in re.findall(r"""href\s*=\s*["']?([^"'#\s>]*)""", html or "", re.I) if host else []:
            to = split(link)[0] if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", link) else re.match(r"//([^/?#]*)", link)[1].lower() if link.startswith("//") else host
            if to in own and to != host:
                edges[host, to] += 1
    tree = set()
    for host in own:
        labels = host.split(".")
        if len(labels) > 2 and not re.fullmatch(r"[0-9.:]*", host):
            tree |= {(".".join(labels[k:]), ".".join(labels[k + 1 :])) for k in range(len(labels) - 2)}
    for a, b in tree:
        edges[a, b] += 1
        edges[b, a] += 1
    names = sorted(own | {x for e in edges for x in e})
    at = {h: k for k, h in enumerate(names)}
    ranks = []
    for kind, turn in (("allow", False), ("block", True)):
        move = np.zeros((len(names), len(names)))
        for (a, b), n in edges.items():
            a, b = (b, a) if turn else (a, b)
            move[at[b], at[a]] += n
        move /= np.maximum(move.sum(axis=0), 1e-300)
        start = np.array([seeds[kind][h] for h in names], float)
        x = np.linalg.solve(np.eye(len(names)) - 0.85 * move, 0.15 * start / max(1, start.sum()))
        ranks.append(x / x.sum() if x.sum() else x)
    expected = {}
    for page, url, _ in pages:
        host, path = split(url)
        worse = bool(host) and ranks[1][at[host]] > ranks[0][at[host]] * (1 + 1e-9)
        expected[page] = rule(host, path) or ("block" if worse else "allow")
    found = {r["page_id"]: r["verdict"] for r in queries.op5_url_filter(spark, SF).collect()}
    assert found == expected and set(found.values()) == {"allow", "block"}
