"""URL filters and embedding near-duplicates against brute force, odd cases included."""
import random

import numpy as np
import pytest

from judgeline.llm import embedding_dedup, queries, url_filter
from judgeline.llm.common import components


def judged(url, unwanted):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, after = rest[:cut], rest[cut:]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    path = after[:min([after.find(c) for c in "?#" if c in after], default=len(after))]
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    bad = any(host == u or host.endswith("." + u) for u in unwanted)
    return host, path, None, "block" if bad else "allow"


URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "HTTPS://Www.Example.COM/en/x?y#z",
        "http://a.example.com/en/1", "http://example.com/en", "http://x.net/es/", "http://net/fr/a", "http://xnet/fr/a",
        "http://a.net?x=/fr/", "ftp://spam-farm.example.org/en/2", "http://b.adult-x.example.net/en/", "http://a..b/en/",
        "http://é.com/ü/", "a://b://c/d", "http://example.com/en/" + "x" * 5000]


@pytest.mark.parametrize("max_mb", [8, 0.000001])      # cascades; lists too large for them
def test_urls(spark, max_mb):
    pages = spark.createDataFrame([(i, u, "h", "r", "k") for i, u in enumerate(URLS + URLS[:8])] + [(None, URLS[6], None, None, None)],
                                  "page_id long, url string, host string, rule string, keys string")
    unwanted = [f"{n}.{z}" for n in url_filter.UNWANTED for z in url_filter.ZONES]
    got = url_filter.judge_urls(pages, url_filter.fixed_rules(spark), url_filter.fixed_unwanted(spark), max_mb=max_mb).collect()
    assert len(got) == pages.count()
    for r in got:
        url = URLS[6] if r.page_id is None else (URLS + URLS[:8])[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == judged(url, unwanted)
    assert url_filter.judge_urls(pages.where("false"), url_filter.fixed_rules(spark),
                                 url_filter.fixed_unwanted(spark)).count() == 0


def test_cascade(spark):
    """Exact for every key of the universe, with levels that do let keys pass wrongly."""
    universe = spark.range(30_000).selectExpr("concat('k', id) as key")
    listed = universe.where("hash(key) % 10 = 0").union(spark.sql("select 'unknown' as key"))
    cascade = url_filter.Cascade(listed, universe)
    assert len(cascade.levels) >= 3
    wrong = universe.withColumn("has", cascade.has(universe["key"])).where("has <> (hash(key) % 10 = 0)")
    assert wrong.count() == 0


def test_first_level_follows_the_universe(spark):
    """A larger universe makes level 0 finer, and not the later levels larger."""
    sizes, listed = [], [f"k{7 * i}" for i in range(20)]
    for n in (20_000, 320_000):
        universe = spark.range(n).selectExpr("concat('k', id) as key")
        cascade = url_filter.Cascade(universe.where(universe["key"].isin(listed)), universe)
        sizes.append([bits for _, bits, _ in cascade.levels[1:]])
        assert sorted(r.key for r in universe.where(cascade.has(universe["key"])).collect()) == sorted(listed)
    assert all(bits <= 512 for s in sizes for bits in s)


def test_hosts_of_many_labels(spark):
    """A host of 20,000 labels is judged like another."""
    long = "http://" + "a." * 20_000
    pages = spark.createDataFrame([(k, long + end) for k, end in enumerate(("x.net/es/", "spam-farm.example.org/", "x.org", "com/"))],
                                  "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in
           url_filter.judge_urls(pages, url_filter.fixed_rules(spark), url_filter.fixed_unwanted(spark)).collect()}
    assert got == {0: ("net/es/", "block"), 1: (None, "block"), 2: (None, "allow"), 3: ("com/", "allow")}


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/")], "page_id long, url string")
    got = url_filter.judge_urls(pages, url_filter.fixed_rules(spark).where("false"), url_filter.fixed_unwanted(spark).where("false")).first()
    assert (got.rule, got.verdict) == (None, "allow")


def components_of(vectors, threshold=0.98):
    ids = sorted(vectors)
    links = {i: set() for i in ids}
    for i in ids:
        for j in ids:
            (a, x), (b, y) = vectors[i], vectors[j]
            if i < j and a == b and a is not None and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i].add(j), links[j].add(i)
    root = {}
    for i in ids:
        if i not in root:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in root:
                    root[k] = i
                    todo += links[k]
    return links, root


@pytest.mark.parametrize("cell_rows, block_rows", [(16_384, 1024), (32, 16)])
def test_embeddings(spark, cell_rows, block_rows):
    rng = np.random.default_rng(9)
    own = []
    for label in (0, 1, None):
        for _ in range(25):
            centre = rng.standard_normal(24)
            for _ in range(rng.integers(1, 6)):
                own.append((label, (centre + rng.standard_normal(24) * rng.choice([0.05, 0.18])).astype("f4").tolist()))
    centre = rng.standard_normal(24)
    own += [(1, (centre + rng.standard_normal(24) * 0.05).astype("f4").tolist()) for _ in range(60)]
    rng.shuffle(own := [(i, a, x) for i, (a, x) in enumerate(own)])
    odd = [(9001, 0, None), (9002, 0, [0.0] * 24), (9003, 0, [float("nan")] * 24), (9004, 0, [None] * 24),
           (9005, 0, [float("inf")] * 24), (9006, 0, []), (9007, 0, [1.0, 2.0]), (9008, 0, [2.0, 4.0])]
    rows = [(i, x, a, 1, "r") for i, a, x in own + odd] + [(i, x, a, 1, "r") for i, a, x in own[:3]] + [(None, own[0][2], 0, 1, "r")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, links long, root string").repartition(3)
    links, root = components_of({i: (a, x) for i, a, x in own + odd[-2:]})
    got = embedding_dedup.near_duplicates(frame, cell_rows=cell_rows, block_rows=block_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            want = root.get(r.vec_id, r.vec_id)
            assert (r.n_links, r.component_id, r.kept) == (len(links.get(r.vec_id, ())), want, want == r.vec_id)
    assert embedding_dedup.near_duplicates(frame.where("false")).count() == 0


def test_calibration():
    """A pair at the threshold reaches the count; unrelated pairs rarely do."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = rng.standard_normal((3000, 64))
    d -= (d * x).sum(1, keepdims=True) * x
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    y = 0.9801 * x + np.sqrt(1 - 0.9801**2) * d
    i, j = embedding_dedup.links(x, y)
    assert set(zip(range(3000), range(3000))) <= set(zip(i.tolist(), j.tolist()))
    planes, tables = embedding_dedup.plan(7_500_000)
    assert (1 - (1 - np.arccos(0.98) / np.pi) ** planes) ** tables <= 1e-9


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    edges = chain + [(7, k) for k in range(8, 300, 7)] + [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(90)]
    root = {v: v for e in edges for v in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: r for v, r in root.items() if any(v in e and e[0] != e[1] for e in edges)}


def test_queries_are_registered():
    named = queries.all_queries()
    assert [sum(n.startswith(f"op{k}_") for n in named) for k in range(1, 11)] == [1] * 10
    assert set(queries.all_oracles()) <= set(named)
