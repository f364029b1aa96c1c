"""URL filters with link-graph propagation, in DataFrame functions only.

Rules of host and path decide first, the longest that fits. Other pages get the verdict of
their host: trust flows by personalised PageRank from hosts with allowed pages along the
links, distrust flows from hosts with blocked pages against the links, and a host is blocked
where its share of all distrust exceeds its share of all trust by more than rounding (SLACK).
Edges are the links between hosts that have pages and those of the domain tree (kin), by which
hosts of one domain are judged together even where all their links are relative. The ranks are sums over walks
of every length from the seeds; rounds add the next length. For verdicts they end when none can
change any more: no host was newly reached, and what is still open of either mass, which is bounded by the
last round's share, is too little to turn which of a host's two shares is larger, or the
host's ranks do not grow any more by more than TOLERANCE of themselves (ties). Hosts far from every
seed, whose shares are small, so keep the rounds going until their verdicts are settled too.

A very long page is one row, of which its links go on, counted by host. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import ascii_lower, cut, drop_cuts

#: (host, path, verdict): fixed by the contract.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DAMPING = 0.85
#: What is open of a rank, as a part of it, that counts as nothing. There is no limit on rounds.
TOLERANCE = 1e-6
#: Rounds in one plan: more make fewer tables and checks, of longer plans.
ROUNDS_A_CUT = 8
#: Shares that differ by less than this part are a tie, which allows: sums of doubles depend on
#: the order of their rows.
SLACK = 1e-9
#: So many rules become one CASE expression; larger lists need a join on the host's suffixes.
MAX_RULES = 500


def host_of(url: str) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; '' without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]], field: int | None) -> Column:
    """The longest rule that fits (field None: host and path as text) or its verdict; else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == r[0]) | F.endswith(host, F.lit("." + r[0]))) & F.startswith(path, F.lit(r[1]))
        out = F.when(fits, F.lit(r[0] + r[1] if field is None else r[field])).otherwise(out)
    return out


def links(pages: DataFrame) -> DataFrame:
    """Host edges (src, dst, n): absolute links in the html and links without a host, which
    stay on their page's host. Links of the same two hosts are counted before the shuffle."""
    found = F.regexp_extract_all("html", F.lit("(?i)href\\s*=\\s*[\"']?([^\"'#\\s>]*)"), F.lit(1))
    targets = pages.select(host_of("url").alias("src"), F.explode(found).alias("link"))
    dst = F.when(F.col("link").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), host_of("link")).when(F.startswith("link", F.lit("//")), ascii_lower(F.regexp_extract("link", "^//([^/?#]*)", 1))).otherwise(F.col("src"))
    return targets.select("src", dst.alias("dst")).where("src != '' and dst != ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def kin(hosts: DataFrame) -> DataFrame:
    """Edges (src, dst, n) of the domain tree, both ways and of one link each: from every host to
    its parent domain and on to that one's, down to two labels; domains need no pages of their
    own. Who runs a domain answers for the hosts below it. Addresses of digits have no parents."""
    labels = F.split("host", "\\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda k: F.struct(F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("src"), F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("dst")))
    up = hosts.where(F.col("host").like("%.%.%") & ~F.col("host").rlike("^[0-9.:]*$")).select(F.explode(chain).alias("e")).select("e.*").distinct()
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1).cast("long"))


def host_scores(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, tolerance: float = TOLERANCE, threshold: float | None = None) -> DataFrame:
    """(host, trust, distrust) of every host of a page and every domain above one: shares that sum
    to one over all of them. With a threshold rounds end as soon as it is settled for every host whether
    distrust exceeds so many times its trust; without, when all ranks are. Links to hosts without a page
    carry nothing: such hosts have no verdict, and no page of theirs could pass anything on."""
    judged = pages.select("page_host", rule_of(F.col("page_host"), F.col("page_path"), rules, 2).alias("v"))
    seeds = judged.groupBy("page_host").agg(F.sum((F.col("v") == "allow").cast("long")).alias("good"), F.sum((F.col("v") == "block").cast("long")).alias("bad"))
    seeds = cut(seeds.select(F.col("page_host").alias("host"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad")), "hosts")
    total = seeds.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    tree = cut(kin(seeds.select("host")), "tree")
    domains = tree.select(F.col("src").alias("host")).distinct().join(seeds.select(F.col("host").alias("h0")), F.col("host") == F.col("h0"), "left_anti")
    seeds = cut(seeds.unionByName(domains.select("host", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"))), "nodes")
    start = seeds.select("host", (F.col("good") / F.lit(float(total["good"] or 1))).alias("t0"), (F.col("bad") / F.lit(float(total["bad"] or 1))).alias("d0"))

    known = seeds.select("host")
    edges = links(pages).where("src != dst").join(known.withColumnRenamed("host", "h1"), F.col("src") == F.col("h1"), "left_semi").join(known.withColumnRenamed("host", "h2"), F.col("dst") == F.col("h2"), "left_semi")
    edges = cut(edges.unionByName(tree).groupBy("src", "dst").agg(F.sum("n").alias("n")), "edges")
    out = edges.groupBy("src").agg(F.sum("n").alias("n_out")).withColumnRenamed("src", "s")
    into = edges.groupBy("dst").agg(F.sum("n").alias("n_in")).withColumnRenamed("dst", "d")
    weighted = edges.join(out, F.col("src") == F.col("s")).join(into, F.col("dst") == F.col("d"))
    # one list for both: trust goes from src to dst, distrust from dst to src
    forward = weighted.select(F.col("src").alias("from"), F.col("dst").alias("to"), (F.col("n") / F.col("n_out")).alias("t"), F.lit(0.0).alias("d"))
    backward = weighted.select(F.col("dst").alias("from"), F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("n") / F.col("n_in")).alias("d"))
    steps = cut(forward.unionByName(backward).groupBy("from", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")), "steps")

    if steps.isEmpty():
        return start.select("host", F.col("t0").alias("trust"), F.col("d0").alias("distrust"))
    # walks of no step; each round adds those of one step more (the *_in), so no rank ever falls
    base = start.select("host", ((1 - DAMPING) * F.col("t0")).alias("trust"), ((1 - DAMPING) * F.col("d0")).alias("distrust"))
    base = cut(base.select("*", F.lit(0.0).alias("trust_in"), F.lit(0.0).alias("distrust_in")), "start")
    now, last = base.withColumns({"trust_in": F.col("trust"), "distrust_in": F.col("distrust")}), None
    while True:
        for _ in range(ROUNDS_A_CUT):
            passed = {c: DAMPING * F.col(c) * F.col(c[0]) for c in ("trust", "distrust", "trust_in", "distrust_in")}
            moved = steps.join(now, F.col("from") == F.col("host")).select(F.col("to").alias("host"), *(v.alias(c) for c, v in passed.items()))
            now = base.unionByName(moved).groupBy("host").agg(*(F.sum(c).alias(c) for c in passed))
        now = cut(now, "ranks")
        if last is not None:
            drop_cuts(last)
        if _settled(now, tolerance, threshold):
            break
        last = now
    total = now.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    return now.select("host", (F.col("trust") / F.lit(total["t"] or 1.0)).alias("trust"), (F.col("distrust") / F.lit(total["d"] or 1.0)).alias("distrust"))


def _settled(ranks: DataFrame, tolerance: float, threshold: float | None) -> bool:
    """Whether no further round is needed. What can still come to a host is at most what all hosts got in
    the last round, passed on for ever; and where no host was reached for the first time, none will be."""
    names = ("trust", "distrust", "trust_in", "distrust_in")
    new = F.count_if(((F.col("trust_in") > 0) & (F.col("trust_in") == F.col("trust"))) | ((F.col("distrust_in") > 0) & (F.col("distrust_in") == F.col("distrust"))))
    sums = ranks.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names), new.alias("new")).first()
    if sums["new"]:
        return False
    ahead = DAMPING / (1 - DAMPING)
    grows = (F.col("trust_in") * ahead > tolerance * F.col("trust")) | (F.col("distrust_in") * ahead > tolerance * F.col("distrust"))
    if threshold is not None:
        t, d = F.col("trust"), F.col("distrust")
        open_t, open_d = sums["trust_in"] * ahead, sums["distrust_in"] * ahead
        total_t, total_d = sums["trust"] or 1.0, sums["distrust"] or 1.0
        least_d, most_d = d / (total_d + open_d), F.when(d > 0, (d + open_d) / total_d).otherwise(0.0)
        least_t, most_t = t / (total_t + open_t), F.when(t > 0, (t + open_t) / total_t).otherwise(0.0)
        bar = threshold * (1 + SLACK)
        sure = (least_d > bar * most_t) | (most_d <= bar * least_t)
        grows = grows & ~sure
    return ranks.where(grows).isEmpty()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, threshold: float = 1.0, ranks: bool = True) -> DataFrame:
    """pages without the html, with host, path, rule, verdict, trust and distrust. Without ranks the rounds end
    when verdicts are settled: trust and distrust are then as far as that took. A null url
    or one without `://` has neither host nor path, fits no rule and is allowed, as are hosts
    that neither trust nor distrust reaches. Repeated rows are judged alike."""
    own = [c for c in pages.columns if c not in ("html", "host", "path", "rule", "verdict", "trust", "distrust")]
    read = pages.select(*(F.col(f"`{c}`") for c in own), *(["html"] if "html" in pages.columns else [F.lit(None).cast("string").alias("html")]), host_of("url").alias("page_host"), path_of("url").alias("page_path"))
    scores = host_scores(read, rules, threshold=None if ranks else threshold)
    found = read.drop("html").join(scores, F.col("page_host") == F.col("host"), "left")
    host, path = F.col("page_host"), F.col("page_path")
    spread = F.when(F.col("page_host") == "", F.lit("allow")).when(F.coalesce("distrust", F.lit(0.0)) > F.lit(threshold * (1 + SLACK)) * F.coalesce("trust", F.lit(0.0)), F.lit("block")).otherwise("allow")
    return found.select(*(F.col(f"`{c}`") for c in own), host.alias("host"), path.alias("path"), rule_of(host, path, rules, None).alias("rule"), F.coalesce(rule_of(host, path, rules, 2), spread).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def digest(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url", "html"), ranks=False).select("page_id", "host", "path", "rule", "verdict")
