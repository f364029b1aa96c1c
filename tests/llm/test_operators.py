"""The ten operators against plain versions, on small tables that hold the hard cases."""

from __future__ import annotations

import base64
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute
from compare import duck_bag, spark_bag
from conftest import SF

import corpus_pipeline
from quillon.llm import decontaminate, language_id, line_dedup, mixing, quality, queries, simhash, suffix_dedup, toxicity, url_filter, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, score double, items string"


def texts() -> list[tuple[int, str | None]]:
    """Null, empty and long texts, copies, near copies, shared passages and repeated lines."""
    r = random.Random(5)
    words = ["".join(r.choices("abcdeéñß", k=r.randint(2, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choices(words, k=n))
    passage, line = say(160), say(25)
    out: list[str | None] = [None, "", " \t\n", "one", "One Two three", "#*$%& |<> 1 2 3 4 5 6 7 8 9 10"]
    base = say(200)
    out += [base, base, base.upper(), base + " end"]
    near = base.split(" ")
    for k in (3, 90, 150):
        near[k] = "changed"
        out.append(" ".join(near))
    out += [say(80) + " " + passage + " " + say(40) for _ in range(4)]
    out += ["\n".join([say(20), line, line.replace(" ", "  "), line + " more", say(12)]) for _ in range(3)]
    out += [say(3) + "\n" + " ".join([say(6)] * 9), say(30_000), passage * 3]
    out += [say(r.randint(1, 120)) for _ in range(25)]
    return list(enumerate(out, 1))


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With other columns, of names that the operators use themselves."""
    return spark.createDataFrame([(d, t, "xx", f"s{d % 4}" if d % 5 else None, len(t or ""), 7, 0.5, "x") for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """A null id and rows that repeat, in every column."""
    return spark.createDataFrame([(None, "a b c", None, None, None, None, None, None), (1, "a b c", "en", "s", 5, 1, 0.1, "x"), (1, "a b c", "en", "s", 5, 1, 0.1, "x"), (2, None, None, None, None, None, None, None)], DOCS)


def test_suffix_dedup(docs, rows):
    short = [r for r in rows if len(r[1] or "") < 20_000]
    found = suffix_dedup.digest(docs.where("length(coalesce(text, '')) < 20000"))
    got = sorted(tuple(r) for r in found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == sorted(brute.suffix_dedup(short))
    assert any(r[2] for r in got)


def test_suffix_dedup_tells_who_lost_bytes(docs):
    got = suffix_dedup.digest(docs.where("length(coalesce(text, '')) < 20000")).collect()
    assert all(r["has_removed"] == (r["n_removed"] > 0) for r in got) and any(r["has_removed"] for r in got)


@pytest.mark.parametrize("piece", [100, 1_000, 4_096])
def test_suffix_dedup_in_pieces(docs, rows, monkeypatch, piece):
    """The module goes to the tasks by value, so that they see the small piece."""
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    cloudpickle.register_pickle_by_value(suffix_dedup)
    try:
        got = sorted(tuple(r)[:5] for r in suffix_dedup.digest(docs).collect())
    finally:
        cloudpickle.unregister_pickle_by_value(suffix_dedup)
    assert got == sorted(brute.suffix_dedup(rows))


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    text = "".join(random.Random(8).choices("abcdefgh", k=20_000)).encode()
    data = suffix_dedup._bytes((text + text[:3_000]).decode())
    whole = [x.tolist() for x in map(np.concatenate, zip(*suffix_dedup.anchors(data)))]
    for piece in (1, 100, 1_000, 22_600):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        assert [x.tolist() for x in map(np.concatenate, zip(*suffix_dedup.anchors(data)))] == whole


def test_suffix_dedup_keeps_a_long_clean_text(spark):
    text = "".join(random.Random(9).choices("abcdefghijklmnop", k=2 * suffix_dedup.PIECE + 5_000))
    got = suffix_dedup.digest(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (got["n_removed"], got["n_spans"], got["kept_sha256"]) == (0, 0, hashlib.sha256(text.encode()).hexdigest())


def test_line_dedup(docs, rows):
    got = sorted((r["doc_id"], r["n_lines"], list(r["removed_lines"])) for r in line_dedup.digest(docs).collect())
    assert got == sorted(brute.line_dedup(rows))
    assert sum(len(r[2]) for r in got) > 8


def test_line_dedup_cuts_the_text(docs, rows):
    removed = {d: set(gone) for d, _, gone in brute.line_dedup(rows)}
    kept = {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in removed[d]) for d, t in rows}
    got = line_dedup.clean(docs)
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == kept


def test_simhash(docs, rows):
    got = sorted(tuple(r) for r in simhash.digest(docs).select("doc_id", "fingerprint", "component_id").collect())
    assert got == sorted(brute.simhash(rows))


def test_simhash_links_every_pair_within_the_distance(spark):
    r = random.Random(3)
    values = set()
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(40):
            values.add(x)
            for b in r.sample(range(64), r.randint(1, 5)):
                x ^= 1 << b
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    roots = {row["fp"]: row["c"] for row in simhash.components_of(nodes).collect()}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 4:
                assert roots.get(signed[i], signed[i]) == roots.get(signed[j], signed[j])


def test_language(spark):
    got = queries.op4_language_id(spark, SF)
    right = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").where("held_out and lang_pred != 'und' and length(text) > 50")
    share = right.selectExpr("avg(cast(lang = lang_pred as double)) as x").first()["x"]
    assert share > 0.97


def test_language_of_nothing(docs):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[7][0] == "xx" and 0 <= got[7][1] <= 1


def test_bundles_do_not_depend_on_neighbours():
    r = random.Random(4)
    texts = ["", "a", "ab", "ab.", "  ab c", "\0x\0", None, "12 #", "ΑΣ", "Σ", *("".join(r.choices("abc é.\0", k=r.randint(1, 40))) for _ in range(200))]
    alone = np.array([language_id.bundles([t])[0] for t in texts])
    assert (language_id.bundles(texts) == alone).all() and (language_id.bundles(texts[::-1])[::-1] == alone).all()
    assert [bool(v.any()) for v in alone[:10]] == [False, True, True, True, True, True, False, False, True, True]
    assert (alone[2] == alone[3]).all()  # a final sign is the boundary that is there anyway


@pytest.mark.parametrize("chars", [2, 3, 5, 17, 40])
def test_bundles_do_not_depend_on_pieces(monkeypatch, chars):
    r = random.Random(chars)
    texts = ["".join(r.choices("abΣé  .,1\0", k=r.randint(1, 150))) for _ in range(80)] + ["Σ" * 50, "." * 50, "aΣ. " * 30]
    whole = language_id.bundles(texts)
    monkeypatch.setattr(language_id, "_batches", lambda t, f=language_id._batches: f(t, chars=chars))
    assert (language_id.bundles(texts) == whole).all()


#: Names that the stages use themselves.
CLASHES = ["row", "score", "lang_pred", "removed", "d", "t", "th", "kept", "kept_id", "_d", "_t", "contaminated", "items", "n_words", "n_hit", "spans", "_hits", "_items", "c0", "lid", "first", "hit"]


@pytest.mark.parametrize("name", ["language", "lines", "near_copies", "benchmark"])
def test_stages_keep_foreign_columns(spark, rows, name):
    columns = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
    known = [(d, t, "xx", "s", len(t or ""), *(f"{c}-{d}" for c in CLASHES)) for d, t in rows if len(t or "") < 20_000]
    docs = spark.createDataFrame(known, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert out.columns == columns
    got = out.collect()
    assert got and all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in CLASHES)


def test_language_stage_keeps_short_texts_and_drops_long_noise(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 500").limit(200)
    r = random.Random(6)
    odd = ["a", "ok", "Q", "xj", "7 z", "", None, "12 + 3", "".join(chr(0x0E01 + r.randrange(46)) for _ in range(3_000)), "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=3_000))]
    rows = spark.createDataFrame([(10**9 + k, t, None) for k, t in enumerate(odd)], "doc_id bigint, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(rows)
    for parts in (1, 7):
        got = {x["doc_id"] for x in corpus_pipeline.known_language(spark, both.repartition(parts), SF).collect()}
        assert {x - 10**9 for x in got if x >= 10**9} == {0, 1, 2, 3, 4}
        assert len(got) == 205


PAGES = [
    (1, "http://WWW.Example.com/en/x?q#f", "p"), (2, "https://a.example.com/en/", "p"), (3, "http://example.com/fr", ""), (4, "http://b.net/es/1", None),
    (5, "http://b.net/de", "<a href='http://good.org/x'>"), (6, None, "p"), (7, "no scheme", "p"), (8, "x://net/fr/", "p"), (8, "x://net/fr/", "p"), (9, "http://good.org", ""),
    (10, "http://hub.org/", "<a href='http://c.net/fr/a'>"), (11, "http://c.net/fr/a", ""), (12, "http://mynet/es/", "p"), (13, "http://e.com?a://b/c", "q"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "h") for p in PAGES], "page_id bigint, url string, html string, host string")


def test_url_rules(pages):
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2][2:] == ("example.com/en/", "block")
    assert got[3][2:] == ("com/", "allow")
    assert got[4][2:] == ("net/es/", "block")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("net", "/fr/", "net/fr/", "block")
    assert got[12][2] is None
    assert got[13][:3] == ("e.com", "", None)
    # distrust flows against a link to a blocked host
    assert got[10][2:] == (None, "block") and got[9][3] == "allow"
    assert url_filter.judge(pages).count() == len(PAGES)


def test_url_chains_of_any_length(spark):
    """Hosts up to 41 links before a blocked one; and a ring whose allowed and blocked seeds'
    shares, from a dense solution, decide between its hosts."""
    n = 41
    chain = [(k, f"http://h{k}.chain/", f"<a href='http://h{k + 1}.chain/'>") for k in range(n)] + [(n, f"http://h{n}.chain/", "<a href='http://end.net/fr/'>"), (n + 1, "http://end.net/fr/", "")]
    ring = [(100 + k, f"http://r{k}.ring{'.com' if k == 0 else ''}/", f"<a href='http://r{(k + 1) % 17}.ring{'.com' if k == 16 else ''}/'>" + ("<a href='http://end.net/fr/'>" if k == 11 else "")) for k in range(17)]
    edges = {}
    host = lambda u: u.split("/")[2]
    for _, url, html in chain + ring:
        for link in html.split("'")[1::2]:
            edges[host(url), host(link)] = 1.0
    edges |= {("r0.ring.com", "ring.com"): 1.0, ("ring.com", "r0.ring.com"): 1.0}  # the domain above
    hosts = sorted({host(u) for _, u, _ in chain + ring} | {"ring.com"})
    at = {h: k for k, h in enumerate(hosts)}
    w = np.zeros((len(hosts), len(hosts)))
    for (a, b), x in edges.items():
        w[at[a], at[b]] = x
    share = lambda m: m / np.where(m.sum(1, keepdims=True) == 0, 1, m.sum(1, keepdims=True))
    seed = lambda h: np.eye(len(hosts))[at[h]]
    rank = lambda m, s: np.linalg.solve(np.eye(len(hosts)) - 0.85 * share(m).T, 0.15 * s)
    trust, distrust = rank(w, seed("r0.ring.com")), rank(w.T, seed("end.net"))
    trust, distrust = trust / trust.sum(), distrust / distrust.sum()
    pages = spark.createDataFrame(chain + ring, "page_id bigint, url string, html string")
    got = {r["host"]: r for r in url_filter.judge(pages).collect()}
    for h in sorted(set(hosts) - {"ring.com"}):
        assert got[h]["trust"] == pytest.approx(trust[at[h]], rel=1e-4) and got[h]["distrust"] == pytest.approx(distrust[at[h]], rel=1e-4)
    assert all(got[f"h{k}.chain"]["verdict"] == "block" for k in range(n + 1))
    assert {got[f"r{k}.ring"]["verdict"] for k in range(1, 17)} == {"allow", "block"}


def test_url_domains_share_their_verdict(spark):
    """Hosts without a rule and without a link go with the other hosts of their domain."""
    urls = ["http://a.bad.net/fr/", "http://b.bad.net/", "http://x.y.bad.net/", "http://good.com/", "http://c.other.org/", "http://10.0.0.1/", "http://9.0.0.1/"]
    pages = spark.createDataFrame([(k, u, "<a href=/own>") for k, u in enumerate(urls)], "page_id bigint, url string, html string")
    assert [r["verdict"] for r in sorted(url_filter.judge(pages).collect())] == ["block", "block", "block", "allow", "allow", "allow", "allow"]


def test_warc_round_trip(pages):
    got = sorted(warc.round_trip(pages).collect())
    payload = {p[0]: (p[2] or "").encode() for p in PAGES}
    least = {}
    for k, v in payload.items():
        least[v] = min(k, least.get(v, k))
    want = [(k, len(payload[k]), base64.b32encode(hashlib.sha1(payload[k]).digest()).decode(), "response" if least[payload[k]] == k else "revisit", None if least[payload[k]] == k else least[payload[k]]) for k, *_ in PAGES]
    assert [tuple(r) for r in got] == sorted(want)


def test_warc_refuses_broken_archives():
    archive = warc.Archive([b"some payload " * 9])
    archive.add(warc.record(1, "http://x", b"some payload", None, False))
    body = archive.body.getvalue()
    assert warc.parse(next(warc.frames(body)))["payload"] == b"some payload"
    for bad in (body[8:], body[:-3], b""):
        with pytest.raises(ValueError):
            list(warc.frames(bad))
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, None, b"x", None, False).replace(b"Content-Length: 1\r", b"Content-Length: 2\r"))


def test_mix(docs, rows):
    got = mixing.mix(docs).collect()
    sizes, taken = {}, {}
    source = {d: f"s{d % 4}" if d % 5 else None for d, _ in rows}
    size = {d: len(brute.WORD.findall(t or "")) for d, t in rows}
    for d in size:
        sizes[source[d]] = sizes.get(source[d], 0) + size[d]
    want = brute.targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(want[s])
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in want:
        assert taken[s] == pytest.approx(want[s], abs=1)
    assert sorted(map(tuple, mixing.mix(docs.repartition(3)).collect())) == sorted(map(tuple, got))


def test_mix_of_many_sources(spark):
    """As many sources as would be one expression of as many branches."""
    n = 20_000
    goals = spark.range(n).selectExpr("lpad(id, 6, '0') as source_key", "300D as target", "300D * id as low", "300L as words")
    got = mixing.schedule(goals)
    assert got.groupBy("source_key").count().where("count = 2").count() == n
    assert got.count() == 2 * n


def test_toxicity(spark):
    got = queries.op7_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got)
    assert len(got) > 40 and right / len(got) > 0.95


def test_decontamination(spark):
    sql = queries.oracle_sql()["op9_decontaminate"]
    assert spark_bag(queries.op9_decontaminate(spark, SF)) == duck_bag(SF, sql)


def test_decontamination_in_blocks(spark, monkeypatch):
    """A benchmark of several blocks gives what one automaton gives."""
    docs, bench = (spark.read.parquet(f"{SF.replace('0.01', '0.001')}/{x}.parquet") for x in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontaminate.digest(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", bench.selectExpr("sum(octet_length(text)) as n").first()["n"] // 3)
    assert sorted(map(tuple, decontaminate.digest(docs, bench).collect())) == whole
    assert any(r[-1] for r in whole)


def test_decontamination_offsets(spark):
    words = [f"w{i}" for i in range(13)]
    bench = spark.createDataFrame([(1, "A b-c"), (2, " ".join(words)), (3, None), (4, "!!")], "item_id bigint, text string")
    rows = [(1, "x A, B! c y"), (2, "é " + "; ".join(words).upper()), (3, None), (4, ""), (5, "ab c")]
    got = {r["doc_id"]: r for r in decontaminate.mark(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    text = dict(rows)
    cut = {d: [text[d][s["start"] : s["end"]] for s in r["spans"]] for d, r in got.items()}
    assert cut == {1: ["A, B! c"], 2: ["; ".join(words).upper()], 3: [], 4: [], 5: []}
    assert [got[d]["contaminated"] for d in range(1, 6)] == [True, True, False, False, False]


def test_quality(docs, rows):
    got = {r["doc_id"]: r for r in quality.digest(docs).collect()}
    for d, t in rows:
        n, chars, symbols, lines, repeats = want = brute.quality(t)
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert not (r["kept"] and r["base_failed"])


ALL = {
    "suffix": suffix_dedup.digest, "lines": line_dedup.digest, "lines_clean": line_dedup.clean, "simhash": simhash.digest, "simhash_clean": simhash.keep_one,
    "language": language_id.identify, "mix": mixing.mix, "quality": quality.digest,
}


@pytest.mark.parametrize("name", ALL)
def test_empty_and_odd_tables(empty, odd, name):
    assert ALL[name](empty).count() == 0
    n = ALL[name](odd).count()
    assert n == odd.count() if name != "simhash_clean" else n == 3


def test_empty_and_odd_tables_of_two(spark, empty, odd):
    labels = spark.createDataFrame([(None, None, None), (1, 1, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(None, "a b c"), (1, None), (1, "a b c")], "item_id bigint, text string")
    assert toxicity.rate(odd, labels).count() == decontaminate.digest(odd, bench).count() == 4
    assert toxicity.rate(odd, labels.limit(0)).count() == decontaminate.digest(odd, bench.limit(0)).count() == 4
    assert toxicity.rate(empty, labels).count() == decontaminate.digest(empty, bench).count() == 0


def test_empty_and_odd_pages(spark, pages):
    assert url_filter.judge(pages.limit(0)).count() == warc.round_trip(pages.limit(0)).count() == 0
    none = spark.createDataFrame([(None, None, None), (None, None, None), (3, "u", None)], "page_id bigint, url string, html string")
    assert url_filter.digest(none).count() == 3
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in warc.round_trip(none).collect()) == [("3", "response", None), ("None", "revisit", 3), ("None", "revisit", 3)]
