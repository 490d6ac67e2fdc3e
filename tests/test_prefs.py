"""Preferences without document pairs, held to pairs made one by one."""
import random
from collections import Counter

import pytest

from judgeline.config import EvalConfig
from judgeline.operators import prefs as P

PREFS = "qid string, jg string, jsg string, docno string, rel_level float"
RUNS = "run_id string, qid string, docno string, sim float"


def levels_from(rng, docs, free):
    """A hidden order of the documents, shown in parts: no preference turns round."""
    hidden = {d: rng.randrange(1, 9 if not free else 1000) for d in docs}
    return hidden


def random_prefs(seed, topics=6, free=False, faulty=False):
    rng = random.Random(seed)
    rows = []
    for t in range(topics):
        docs = [f"d{i:02}" for i in range(rng.randrange(2, 14))]
        for g in range(rng.randrange(1, 4)):
            hidden = levels_from(rng, docs, free)
            for s in range(rng.choice((1, 1, 2, 3))):
                for d in docs:
                    if rng.random() < 0.6:
                        level = hidden[d] if not faulty or rng.random() < 0.8 else rng.randrange(5)
                        rows.append((f"t{t}", f"g{g}", f"s{s}", d, float(level)))
                        if faulty and rng.random() < 0.05:
                            rows.append((f"t{t}", f"g{g}", f"s{s}", d, float(rng.randrange(5))))
    return rows


def random_runs(seed, topics=6):
    rng = random.Random(seed)
    rows = []
    for run in ("a", "b"):
        for t in range(topics):
            docs = [f"d{i:02}" for i in range(16)]
            rng.shuffle(docs)
            rows += [(run, f"t{t}", d, float(-k)) for k, d in enumerate(docs[:rng.randrange(1, 14)])]
    return rows


def closed(rows):
    """(qid, jg) -> pairs, direct and reached."""
    pairs = {}
    for q, g, s, d, x in rows:
        own = pairs.setdefault((q, g), set())
        own |= {(d, e) for q2, g2, s2, e, y in rows if (q2, g2, s2) == (q, g, s) and x > y}
    for own in pairs.values():
        while True:
            more = {(a, d) for a, b in own for c, d in own if b == c} - own
            if not more:
                break
            own |= more
    return pairs


def positions(rows, runs):
    judged = {}
    for q, _, _, d, _ in rows:
        judged.setdefault(q, set()).add(d)
    out = {}
    for run in sorted({r[0] for r in runs}):
        for q, docs in judged.items():
            order = [d for _, _, d, _ in sorted((r for r in runs if r[:2] == (run, q)), key=lambda r: (-r[3], r[2]))]
            if order:
                got = [d for d in order if d in docs]
                out[run, q] = ({d: i for i, d in enumerate(got + sorted(docs - set(got)))}, len(got))
    return out


@pytest.mark.parametrize("seed, free", [(1, False), (2, True)])
def test_relation_and_counts(spark, seed, free):
    rows, runs = random_prefs(seed, free=free), random_runs(seed)
    prefs = spark.createDataFrame(rows, PREFS)
    classes = P.doc_classes(prefs)
    relation = P.class_relation(classes)
    want = closed(rows)
    got = {}
    for r in P.closure_pairs(classes, relation).collect():
        got.setdefault((r.qid, r.jg), set()).add((r.hi, r.lo))
    assert got == {k: v for k, v in want.items() if v}
    shape = P.group_shape(prefs)
    pos = P.judged_positions(spark.createDataFrame(runs, RUNS), prefs, EvalConfig())
    for scan in (False, True):
        counts, *_ = P.all_group_counts(P.doc_levels(prefs, shape), pos, P.class_docs(
            classes.join(shape.where("n_jsg > 1"), ["qid", "jg"], "left_semi"), pos), relation, scan=scan)
        found = {(r.run_id, r.qid, r.jg): (r.ful_ret, r.poss_ret, r.ful_imp, r.poss_imp, r.notoccur) for r in counts.collect()}
        expect = {}
        for (run, q), (at, njr) in positions(rows, runs).items():
            for (q2, g), own in want.items():
                if q2 == q:
                    c = Counter()
                    for hi, lo in own:
                        a, b = at[hi], at[lo]
                        kind = "ret" if max(a, b) < njr else "imp" if min(a, b) < njr else "none"
                        c[kind] += 1
                        c["ful_" + kind] += a < b
                    expect[run, q, g] = (c["ful_ret"], c["ret"], c["ful_imp"], c["imp"], c["none"])
        assert found == expect


def test_pair_scores(spark):
    rows, runs = random_prefs(5, topics=8), random_runs(5, topics=8)
    prefs = spark.createDataFrame(rows, PREFS)
    got = {(r.run_id, r.qid, r.measure): r.value for r in P.evaluate_prefs(
        spark.createDataFrame(runs, RUNS), prefs, ["prefs_pair", "prefs_pair_ret", "prefs_pair_imp"]).per_topic.collect()}
    want = closed(rows)
    for (run, q), (at, njr) in positions(rows, runs).items():
        sums, n = Counter(), Counter()
        docs = sorted(at, key=at.get)
        for i, d in enumerate(docs):
            for e in docs[i + 1:]:
                up = sum((d, e) in own for (q2, _), own in want.items() if q2 == q)
                down = sum((e, d) in own for (q2, _), own in want.items() if q2 == q)
                if up + down:
                    kind = "rr" if at[e] < njr else "ri" if at[d] < njr else "uu"
                    sums[kind] += up / (up + down)
                    n[kind] += 1
        ratio = lambda a, b: a / b if b else 0
        assert got[run, q, "prefs_pair_ret"] == pytest.approx(ratio(sums["rr"], n["rr"]))
        assert got[run, q, "prefs_pair_imp"] == pytest.approx(ratio(sums["rr"] + sums["ri"], n["rr"] + n["ri"]))
        assert got[run, q, "prefs_pair"] == pytest.approx(ratio(sums["rr"] + sums["ri"], sum(n.values())))


@pytest.mark.parametrize("seed", [3, 4])
def test_inconsistencies_against_pairs(spark, seed):
    rows = random_prefs(seed, faulty=True)
    direct = {}
    for q, g, s, d, x in rows:
        direct.setdefault((q, g), set()).update((d, e) for q2, g2, s2, e, y in rows if (q2, g2, s2) == (q, g, s) and x > y)
    both = {(q, g, d, "preferred_both_ways") for (q, g), own in direct.items() for d, e in own if (e, d) in own}
    levels = {}
    for q, g, s, d, x in rows:
        levels.setdefault((q, g, d), {}).setdefault(s, set()).add(x)
    two = {(*k, "levels_in_subgroup") for k, v in levels.items() if any(len(x) > 1 for x in v.values())}
    every = {k: set().union(*v.values()) for k, v in levels.items()}
    zero = {(*k, "zero_and_nonzero") for k, v in every.items() if 0 in v and max(v) > 0}
    got = [tuple(r) for r in P.inconsistencies(spark.createDataFrame(rows, PREFS)).collect()]
    assert len(got) == len(set(got)) and set(got) == two | zero | both
    assert both and two and zero
    with pytest.raises(ValueError, match="inconsistent"):
        P.raise_if_inconsistent(spark.createDataFrame(rows, PREFS))
    P.raise_if_inconsistent(spark.createDataFrame(random_prefs(seed), PREFS))


def test_only_evaluated_topics_must_be_consistent(spark):
    runs = spark.createDataFrame([("r", "1", "d1", 2.0), ("r", "1", "d2", 1.0)], RUNS)
    good = [("1", "a", "s", "d1", 2.0), ("1", "a", "s", "d2", 1.0)]
    turned = [("2", "a", "s", "d1", 2.0), ("2", "a", "s", "d2", 1.0), ("2", "a", "t", "d1", 1.0), ("2", "a", "t", "d2", 2.0)]
    ev = P.evaluate_prefs(runs, spark.createDataFrame(good + turned, PREFS), ["prefs_simp"])
    assert [r.value for r in ev.per_topic.collect()] == [1.0]
    with pytest.raises(ValueError, match="preferred_both_ways"):
        P.evaluate_prefs(runs.union(spark.createDataFrame([("r", "2", "d1", 1.0)], RUNS)),
                         spark.createDataFrame(good + turned, PREFS), ["prefs_simp"])


def test_cycles_over_subgroups_raise(spark):
    ring = [("1", "a", s, d, x) for s, hi, lo in (("s", "d1", "d2"), ("t", "d2", "d3"), ("u", "d3", "d1"))
            for d, x in ((hi, 2.0), (lo, 1.0))]
    with pytest.raises(ValueError, match="cycle in topic 1 group a"):
        P.class_relation(P.doc_classes(spark.createDataFrame(ring, PREFS)))
    chain = [("1", "a", f"s{i:02}", f"d{i + k:02}", 2.0 - k) for i in range(12) for k in (0, 1)]
    classes = P.doc_classes(spark.createDataFrame(chain, PREFS))
    assert P.closure_pairs(classes, P.class_relation(classes)).count() == 12 * 13 // 2


@pytest.mark.parametrize("scan", [False, True])
def test_inversions(spark, scan):
    rng = random.Random(8)
    rows = []
    for g, levels in (("all", 10_000), ("few", 3), ("one", 1)):
        order = list(range(150))
        rng.shuffle(order)
        rows += [(g, float(rng.randrange(levels)), p) for p in order]
    frame = spark.createDataFrame(rows, "g string, lvl float, pos int")
    got = P.inversions(frame, ["g"], "lvl", "pos", scan)
    found = {r.g: r.n for r in got.groupBy("g").agg({"above": "sum"}).withColumnRenamed("sum(above)", "n").collect()}
    for g in ("all", "few", "one"):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: r[2])
        want = sum(a[1] > b[1] for i, a in enumerate(own) for b in own[i + 1:])
        assert found.get(g, 0) == want


def test_no_pairs_by_default(spark, monkeypatch):
    """Neither single-subgroup nor other groups make document pairs."""
    def fail(*_):
        raise AssertionError("document pairs")
    for name in ("direct_pairs", "closure", "closure_pairs", "pair_positions", "pair_counts"):
        monkeypatch.setattr(P, name, fail)
    runs = spark.createDataFrame(random_runs(1), RUNS)
    prefs = spark.createDataFrame(random_prefs(1), PREFS)
    assert P.evaluate_prefs(runs, prefs, "all_prefs").per_topic.count() > 0
