"""Periodic runs, URL filter cascades and the Merkle manifest against plain code."""

import hashlib
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from check import normal
from duesight.llm import common, manifest, periodic, queries, url_filter

BLANKS = "\t\n\x0b\x0c\r "


@pytest.fixture(scope="module")
def frame(root):
    rows = pd.read_parquet(f"{root}/documents.parquet").astype(object)
    return rows.where(rows.notna(), None).to_dict("records")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_runs(words, shortest=12):
    """Every lag in turn."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def texts_of(rng):
    def repeated(root, n):
        return (list(root) * (n // len(root) + 1))[:n]

    def draw(top, n):
        return rng.integers(0, top, n).tolist()

    yield draw(2, int(rng.integers(0, 200)))
    a, b = [0], [0, 1]
    while len(b) < 250:
        a, b = b, b + a
    yield b[: int(rng.integers(0, 250))]
    yield draw(9, 15) + repeated(draw(40, int(rng.integers(1, 120))), int(rng.integers(0, 350))) + draw(9, 15)
    root = draw(3, int(rng.integers(2, 7)))
    yield repeated(root, int(rng.integers(5, 130))) + repeated(root, int(rng.integers(5, 130))) + draw(3, 4)
    parts = [x for _ in range(4) for x in repeated(root, int(rng.integers(10, 80)))]
    yield parts + parts
    nested = draw(2, 25)
    for _ in range(3):
        i = int(rng.integers(0, len(nested)))
        nested += nested[i : i + 90] * int(rng.integers(1, 4))
    yield nested[:350]


@pytest.mark.parametrize("direct,shortest", [(24, 12), (16, 8), (8, 4)])
def test_runs_equal_those_of_every_lag(direct, shortest):
    rng = np.random.default_rng(direct)
    for _ in range(25):
        texts = list(texts_of(rng))
        for words, got in zip(texts, periodic.block_runs(texts, shortest, direct)):
            assert [tuple(r) for r in got.tolist()] == brute_runs(words, shortest)


def test_runs_of_odd_texts(spark):
    common.importable(spark)
    texts = [None, "", BLANKS, "é " * 30, "a b c " * 5 + "x", "one two three", "w " * 300_000, "a b c " * 5 + "x"]
    rows = [(i, t, "mine") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, periodic string")
    found, name = periodic.find(docs)
    got = {r.doc_id: r for r in found.collect()}
    assert name == "periodic_" and all(r.periodic == "mine" for r in got.values())
    runs = {i: [tuple(x) for x in r[name].runs] for i, r in got.items()}
    assert runs == {0: [], 1: [], 2: [], 3: [(0, 30, 1)], 4: [(0, 15, 3)], 5: [], 6: [(0, 300_000, 1)], 7: [(0, 15, 3)]}
    left = {r.doc_id: r.text for r in periodic.collapse(docs).collect()}
    assert left == {0: None, 1: "", 2: BLANKS, 3: "é", 4: "a b c x", 5: "one two three", 6: "w", 7: "a b c x"}
    assert periodic.collapse(docs.limit(0)).count() == 0 and periodic.collapse(docs).columns == docs.columns


def test_periodic_query(spark, root, frame):
    got = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, root).collect()}
    assert len(got) == len(frame)
    for row in frame:
        words = (row["text"] or "").encode().split()
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, gone = brute_runs(words), set()
        for s, e, q in runs:
            gone |= set(range(s + q, e))
        best = min(((s - e, s, q) for s, e, q in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        r = got[row["doc_id"]]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs))
        assert r.collapsed_sha256 == sha(b" ".join(w for i, w in enumerate(words) if i not in gone).decode())


ODD_URLS = [
    None, "", "no scheme.net/", "http://", "http://net", "http://net/", "http://A.NET/x?q#f", "ftp://x.example.net/en/1", "http://example.net?/en/",
    "http://.net/", "http://notexample.com/de/", "http://example.com/de", "https://a.example.com/de/x#", "http://a.org/fr/y://z.net/", "http://u@x.org:80/fr/",
    "http://É.net/", "http://x.org/fr/\n", "http://x.org/fr/" + "s" * 50_000, "http://net/", "net/",
]


def brute_rule(url, keys):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [k for k in keys if ("." + host).endswith("." + k.split("/")[0]) and path.startswith(k[len(k.split("/")[0]) :])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules(spark, root):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{root}/pages.parquet'")
    got = queries.QUERIES["op12_url_filter"](spark, root)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Join", "Exchange", "Python", "Arrow"))
    assert normal(got.toPandas()).equals(normal(con.execute(queries.ORACLES["op12_url_filter"]).fetch_df()))
    pages = spark.createDataFrame([(i, u, "keep", None) for i, u in enumerate(ODD_URLS)], "page_id long, url string, judged string, url__key0 string")
    block, allow = url_filter.rule_list(spark, "block"), url_filter.rule_list(spark, "allow")
    out, name = url_filter.judge(pages, block, allow)
    assert out.columns == [*pages.columns, name] and name != "judged"
    for r in out.collect():
        host, path, rule = brute_rule(ODD_URLS[r.page_id], [k for k, _ in url_filter.RULES])
        verdict = dict(url_filter.RULES).get(rule, "allow")
        assert tuple(r[name]) == (host, path, rule, verdict) and r.judged == "keep"
    assert url_filter.judge(pages.limit(0), block, allow)[0].count() == 0
    assert url_filter.allowed_only(pages, block.limit(0), allow).count() == len(ODD_URLS)
    both = url_filter.allowed_only(pages, block, block)
    assert both.columns == pages.columns and 0 < both.count() < len(ODD_URLS)


@pytest.mark.parametrize("params", [{}, {"first_error": 0.5, "later_error": 0.5}, {"most_bits": 64}, {"most_shapes": 1}])
def test_cascade_is_exact(spark, params):
    rng = np.random.default_rng(4)
    hosts = [f"{a}{b}.{c}.{d}" for a in ("", "www.") for b in range(25) for c in ("shop", "blog") for d in ("com", "net")]
    urls = [f"http://{h}/{'/'.join(rng.choice(['a', 'b', 'cc'], rng.integers(0, 4)))}" for h in hosts for _ in range(3)]
    keys = {f"{h.removeprefix('www.')}/{p}" for h in rng.choice(hosts, 30) for p in rng.choice(["", "a/", "a/b/", "c", "b/c"], 1)} | {"net/cc", "1.shop.com"}
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    listed = spark.createDataFrame([(k,) for k in [*keys, *keys, None, "/x"]], "key string")
    p = url_filter.UrlParams(**params)
    cascade = url_filter.build(pages, listed, p)
    if "first_error" in params:
        assert len(cascade.levels) > 3
    assert (cascade.listed is not None) == bool({"most_bits", "most_shapes"} & set(params))
    out, name = url_filter.judge(pages, listed, listed.limit(0), p)
    assert {(r.url, r[name].rule) for r in out.collect()} == {(u, brute_rule(u, keys)[2]) for u in urls}


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by plain loops."""

    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(nodes):
        paths, now, size = [[] for _ in nodes], list(nodes), 1
        while len(now) > 1:
            for i, path in enumerate(paths):
                own = i // size
                run, slot = now[own // 16 * 16 : own // 16 * 16 + 16], own % 16
                path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            now, size = [sha("".join(now[i : i + 16])) for i in range(0, len(now), 16)], size * 16
        return now[0], paths

    sources = {}
    for r in rows:
        values = [r[c] for c in manifest.FIELDS]
        other = list(values)
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
            other[-1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        sources.setdefault(r["source"], []).append((r["doc_id"], leaf(values), leaf(other)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in sources[s]]) for s in order}
    root, above = tree([trees[s][0] for s in order])
    out = []
    for s, upper in zip(order, above):
        for (doc_id, own, other), lower in zip(sources[s], trees[s][1]):
            node = other
            for left, right in lower + upper:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in lower + upper))
            out.append((doc_id, own, trees[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_manifest(spark, root, frame):
    got = queries.QUERIES["op13_merkle_manifest"](spark, root)
    assert rows_of(got) == brute_manifest(frame)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet'")
    assert normal(got.toPandas()).equals(normal(con.execute(queries.ORACLES["op13_merkle_manifest"]).fetch_df()))


@pytest.mark.parametrize("kind", ["odd", "one source", "one row", "many sources"])
def test_manifest_of_odd_tables(spark, tmp_path, kind):
    rows = {
        "odd": [(None, None, None, None, None)] * 3
        + [(i, None if i % 3 else "É", None, i, "Ab" * i) for i in range(40)]
        + [(7, "z", "x", 1, None)] * 20
        + [(5, "lone", "", None, "")]
        + [(i, "B", "x", 1, "Text") for i in range(273)],
        "one source": [(i, "s", "x", 1, "T" * i) for i in range(17)],
        "one row": [(5, "s", "x", 1, "T")],
        "many sources": [(i, f"s{i // 2}", "x", 1, "T") for i in range(700)],
    }[kind]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, path string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    assert rows_of(got) == brute_manifest([dict(zip(manifest.FIELDS, r)) for r in rows])


def test_manifest_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).count() == 0
