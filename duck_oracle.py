"""DuckDB SQL oracles for the registered queries (see __spark_entry__.py).

Written independently of the Spark code, directly from the measure
definitions, over the pre-registered test tables.  Doubles are rounded to 6
decimals, cutoff fractions are DOUBLE, ranking is by float score descending
then docno descending.
"""
from __future__ import annotations

# ---------------------------------------------------------------- fixtures
FIX_B = """
b AS (
  SELECT CAST(c.c_nationkey AS VARCHAR) || '-' || substr(o.o_orderpriority, 1, 1) AS qid,
         'P' || lpad(CAST(l.l_partkey AS VARCHAR), 8, '0') AS docno,
         l.l_partkey, l.l_quantity, l.l_returnflag, l.l_shipdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
g AS (SELECT qid, docno, l_partkey, sum(l_quantity) AS q FROM b
      WHERE l_shipdate < TIMESTAMP '1997-01-01' GROUP BY qid, docno, l_partkey),
runs AS (SELECT 'sumqty' AS run_id, qid, docno, CAST(q AS FLOAT) AS sim FROM g
         UNION ALL
         SELECT 'hash97' AS run_id, qid, docno, CAST((l_partkey * 31) % 97 AS FLOAT) AS sim FROM g),
qrels AS (SELECT qid, docno,
                 CAST(CASE WHEN q >= 60 THEN 2 WHEN q >= 25 THEN 1 WHEN q >= 8 THEN 0 ELSE -1 END AS INTEGER) AS rel
          FROM (SELECT qid, docno, sum(l_quantity) AS q FROM b
                WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY qid, docno))
"""


def judged_cte(level=1, max_docs=None, judged_only=False, topic=None, runs="runs") -> str:
    """CTEs st (topic stats) and jr (judged rows with rank, cr, cn, cu)."""
    cut = f"AND rk.orig_rank <= {int(max_docs)}" if max_docs else ""
    keep = "code >= 0" if judged_only else "TRUE"
    tq = f"WHERE qid = '{topic}'" if topic else ""
    return f"""
qsel AS (SELECT * FROM qrels {tq}),
st AS (SELECT qid, sum(CASE WHEN rel >= {level} THEN 1 ELSE 0 END) AS R,
              sum(CASE WHEN rel >= 0 AND rel < {level} THEN 1 ELSE 0 END) AS Nn
       FROM qsel GROUP BY qid),
rk AS (SELECT run_id, qid, docno, sim,
              row_number() OVER (PARTITION BY run_id, qid ORDER BY sim DESC, docno DESC) AS orig_rank
       FROM {runs} {tq}),
j0 AS (SELECT rk.run_id, rk.qid, rk.docno, rk.orig_rank,
              CASE WHEN q.rel IS NULL THEN -1 WHEN q.rel < 0 THEN -2 ELSE q.rel END AS code
       FROM rk LEFT JOIN qsel q ON rk.qid = q.qid AND rk.docno = q.docno
       WHERE rk.qid IN (SELECT qid FROM st) {cut}),
j1 AS (SELECT * FROM j0 WHERE {keep}),
jr AS (SELECT j1.run_id, j1.qid, j1.docno, j1.code, st.R, st.Nn,
              row_number() OVER w AS rank,
              sum(CASE WHEN code >= {level} THEN 1 ELSE 0 END) OVER w AS cr,
              sum(CASE WHEN code >= 0 AND code < {level} THEN 1 ELSE 0 END) OVER w AS cn,
              sum(CASE WHEN code = -2 THEN 1 ELSE 0 END) OVER w AS cu
       FROM j1 JOIN st ON j1.qid = st.qid
       WINDOW w AS (PARTITION BY j1.run_id, j1.qid ORDER BY j1.orig_rank
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


def _d(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _div(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) <> 0 THEN CAST(({n}) AS DOUBLE) / ({d}) ELSE 0.0 END)"


CUTS = [5, 10, 15, 20, 30, 100, 200, 500, 1000]
POINTS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
MULTS = [0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0]


def _long(items: list[tuple[str, str]], src: str = "jr", level: int = 1) -> str:
    """Per-topic long output from (name, aggregate SQL over the topic's rows)."""
    sels = [f"SELECT run_id, qid, '{n}' AS measure, round(CAST(({e}) AS DOUBLE), 6) AS value "
            f"FROM {src} GROUP BY run_id, qid, R, Nn" for n, e in items]
    return "\nUNION ALL\n".join(sels)


def _rel(level=1):
    return f"code >= {level}"


def _hits(k, level=1):
    return f"sum(CASE WHEN {_rel(level)} AND rank <= {k} THEN 1 ELSE 0 END)"


def _kcut(p):
    return f"CAST(floor({_d(p)} * R + {_d(0.9)}) AS BIGINT)"


def _iprec(p, level=1):
    k = _kcut(p)
    nrr = f"sum(CASE WHEN {_rel(level)} THEN 1 ELSE 0 END)"
    return (f"CASE WHEN {k} > {nrr} THEN 0.0 ELSE "
            f"coalesce(max(CASE WHEN cr >= {k} THEN CAST(cr AS DOUBLE) / rank END), 0.0) END")


def m_items(name: str, level=1, num_docs=0) -> list[tuple[str, str]]:
    rel = _rel(level)
    nrr = f"sum(CASE WHEN {rel} THEN 1 ELSE 0 END)"
    ret = "count(*)"
    ap = f"sum(CASE WHEN {rel} THEN CAST(cr AS DOUBLE) / rank ELSE 0 END)"
    if name == "num_ret":
        return [("num_ret", ret)]
    if name == "num_rel":
        return [("num_rel", "R")]
    if name == "num_rel_ret":
        return [("num_rel_ret", nrr)]
    if name == "map":
        return [("map", _div(ap, "R"))]
    if name == "Rprec":
        return [("Rprec", _div(f"sum(CASE WHEN {rel} AND rank <= R THEN 1 ELSE 0 END)", "R"))]
    if name == "bpref":
        t = f"CASE WHEN cn = 0 THEN 1.0 ELSE 1.0 - {_div('least(cn, R)', 'least(Nn, R)')} END"
        return [("bpref", _div(f"sum(CASE WHEN {rel} THEN {t} ELSE 0 END)", "R"))]
    if name == "recip_rank":
        return [("recip_rank", f"coalesce(1.0 / min(CASE WHEN {rel} THEN rank END), 0.0)")]
    if name == "iprec_at_recall":
        return [(f"iprec_at_recall_{p:.2f}", _iprec(p, level)) for p in POINTS]
    if name == "11pt_avg":
        return [("11pt_avg", "(" + " + ".join(_iprec(p, level) for p in POINTS) + f") / {len(POINTS)}")]
    if name == "P":
        return [(f"P_{k}", f"{_hits(k, level)} / {_d(k)}") for k in CUTS]
    if name == "recall":
        return [(f"recall_{k}", _div(_hits(k, level), "R")) for k in CUTS]
    if name == "relative_P":
        return [(f"relative_P_{k}", _div(_hits(k, level), f"least({k}, R)")) for k in CUTS]
    if name == "success":
        return [(f"success_{k}", f"CASE WHEN {_hits(k, level)} > 0 THEN 1.0 ELSE 0.0 END") for k in [1, 5, 10]]
    if name == "map_cut":
        return [(f"map_cut_{k}", _div(f"sum(CASE WHEN {rel} AND rank <= {k} THEN CAST(cr AS DOUBLE) / rank ELSE 0 END)", "R"))
                for k in CUTS]
    if name == "Rprec_mult":
        return [(f"Rprec_mult_{p:.2f}",
                 _div(f"sum(CASE WHEN {rel} AND rank <= {_kcut(p)} THEN 1 ELSE 0 END)", _kcut(p)))
                for p in MULTS]
    if name == "infAP":
        e = _d(1e-5)
        t = (f"CASE WHEN rank = 1 THEN 1.0 ELSE 1.0 / rank + (CAST(rank - 1 AS DOUBLE) / rank) * "
             f"(CAST(cr - 1 + cn + cu AS DOUBLE) / (rank - 1)) * ((cr - 1 + {e}) / (cr - 1 + cn + 2 * {e})) END")
        return [("infAP", _div(f"sum(CASE WHEN {rel} THEN {t} ELSE 0 END)", "R"))]
    if name == "utility":
        return [("utility", f"1.0 * {nrr} - 1.0 * ({ret} - {nrr})")]
    if name == "binG":
        return [("binG", _div(f"sum(CASE WHEN {rel} THEN 1.0 / log2(rank - cr + 2) ELSE 0 END)", "R"))]
    if name == "set":
        p = _div(nrr, ret)
        r = _div(nrr, "R")
        return [("set_P", p), ("set_relative_P", _div(nrr, f"least({ret}, R)")),
                ("set_recall", r), ("set_map", _div(f"CAST({nrr} AS DOUBLE) * {nrr}", f"{ret} * R")),
                ("set_F", f"CASE WHEN {nrr} > 0 THEN {_div(f'2.0 * {p} * {r}', f'{p} + {r}')} ELSE 0.0 END")]
    if name == "num_nonrel_judged_ret":
        return [("num_nonrel_judged_ret", "sum(CASE WHEN code >= 0 AND code < %d THEN 1 ELSE 0 END)" % level)]
    raise KeyError(name)


def measure_sql(names, level=1, max_docs=None, judged_only=False, topic=None) -> str:
    items = []
    for n in names:
        items += m_items(n, level)
    return _with(FIX_B, judged_cte(level, max_docs, judged_only, topic)) + _long(items)


# ---------------------------------------------------------------- gains
IDEAL_CTE = """
ideal0 AS (SELECT qid, docno, CAST(rel AS DOUBLE) AS ig,
                  row_number() OVER (PARTITION BY qid ORDER BY rel DESC, docno) AS pos
           FROM qrels WHERE rel > 0),
ideal AS (SELECT qid, pos, ig,
                 sum(ig / log2(pos + 1)) OVER (PARTITION BY qid ORDER BY pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS icum,
                 coalesce(lead(ig) OVER (PARTITION BY qid ORDER BY pos), -1.0) <> ig AS bnd
          FROM ideal0),
itot AS (SELECT qid, count(*) AS L, max(icum) AS idcg, sum(ig) AS ig_total FROM ideal GROUP BY qid),
al AS (SELECT jr.*, ideal.ig, ideal.icum, ideal.bnd,
              CASE WHEN code > 0 THEN CAST(code AS DOUBLE) ELSE 0.0 END AS g
       FROM jr LEFT JOIN ideal ON jr.qid = ideal.qid AND jr.rank = ideal.pos),
al2 AS (SELECT al.*,
               sum(CASE WHEN g <> 0 THEN g / log2(rank + 1) ELSE 0 END) OVER w AS dcg_cum,
               sum(g) OVER w AS got_cum,
               sum(greatest(coalesce(ig, 0.0), 1.0)) OVER w AS cost_cum
        FROM al WINDOW w AS (PARTITION BY run_id, qid ORDER BY rank
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pt AS (SELECT run_id, qid, R, count(*) AS n,
              sum(CASE WHEN g <> 0 THEN g / log2(rank + 1) ELSE 0 END) AS dcg,
              sum(CASE WHEN g <> 0 THEN g / log2(2 + cost_cum - got_cum) ELSE 0 END) AS gsum,
              sum(CASE WHEN g > 0 AND icum IS NOT NULL THEN dcg_cum / icum ELSE 0 END) AS nr_in,
              sum(CASE WHEN g > 0 AND icum IS NULL THEN dcg_cum ELSE 0 END) AS nr_beyond,
              sum(CASE WHEN g > 0 THEN 1 ELSE 0 END) AS pos_ret,
              sum(CASE WHEN bnd THEN dcg_cum / icum ELSE 0 END) AS rb_sum,
              sum(CASE WHEN bnd THEN 1 ELSE 0 END) AS rb_cnt
       FROM al2 GROUP BY run_id, qid, R),
ptt AS (SELECT pt.*, coalesce(itot.L, 0) AS L, coalesce(itot.idcg, 0.0) AS idcg,
               coalesce(itot.ig_total, 0.0) AS ig_total
        FROM pt LEFT JOIN itot ON pt.qid = itot.qid),
tail AS (SELECT ptt.run_id, ptt.qid,
                coalesce(sum(ptt.dcg / i.icum) FILTER (WHERE i.bnd), 0.0) AS t_sum,
                count(*) FILTER (WHERE i.bnd) AS t_cnt
         FROM ptt LEFT JOIN ideal i ON ptt.qid = i.qid AND i.pos > ptt.n
         GROUP BY ptt.run_id, ptt.qid)
"""


def gain_sql(name: str, gains: dict | None = None) -> str:
    """One gain measure per topic; ``gains`` maps levels to gains."""
    ideal, out = IDEAL_CTE, name
    if gains:
        cases = "".join(f" WHEN {k} THEN {float(v)!r}" for k, v in gains.items())
        of = lambda c: f"(CASE {c}{cases} ELSE CAST(greatest({c}, 0) AS DOUBLE) END)"
        ideal = ideal.replace("CAST(rel AS DOUBLE) AS ig", f"{of('rel')} AS ig") \
            .replace("ORDER BY rel DESC, docno", f"ORDER BY {of('rel')} DESC, docno") \
            .replace("WHERE rel > 0", f"WHERE rel >= 0 AND {of('rel')} > 0") \
            .replace("CASE WHEN code > 0 THEN CAST(code AS DOUBLE) ELSE 0.0 END",
                     f"CASE WHEN code >= 0 THEN {of('code')} ELSE 0.0 END")
        out = name + "_" + ",".join(f"{k}={v}" for k, v in gains.items())
    if name == "ndcg":
        v = _div("dcg", "idcg")
    elif name == "G":
        v = _div("gsum", "ig_total")
    elif name == "ndcg_rel":
        tot = f"(nr_in + {_div('nr_beyond', 'idcg')} + (L - pos_ret) * {_div('dcg', 'idcg')})"
        v = f"CASE WHEN L > 0 AND {tot} > 0 THEN {tot} / L ELSE 0.0 END"
    elif name == "Rndcg":
        extra_s = f"CASE WHEN n > L + 1 THEN {_div('dcg', 'idcg')} ELSE 0.0 END"
        extra_c = "CASE WHEN n > L + 1 AND idcg > 0 THEN 1 ELSE 0 END"
        v = (f"CASE WHEN R = 0 THEN 0.0 ELSE "
             f"{_div(f'rb_sum + t_sum + {extra_s}', f'rb_cnt + t_cnt + {extra_c}')} END")
    else:
        raise KeyError(name)
    return (_with(FIX_B, judged_cte(), ideal)
            + f"SELECT ptt.run_id, ptt.qid, '{out}' AS measure, round(CAST({v} AS DOUBLE), 6) AS value "
              f"FROM ptt JOIN tail ON ptt.run_id = tail.run_id AND ptt.qid = tail.qid")


def ndcg_cut_sql() -> str:
    parts = []
    for k in CUTS:
        parts.append(
            f"SELECT d.run_id, d.qid, 'ndcg_cut_{k}' AS measure, "
            f"round({_div('d.dcg', 'coalesce(i.idcg, 0)')}, 6) AS value FROM "
            f"(SELECT run_id, qid, sum(CASE WHEN rank <= {k} AND code > 0 THEN code / log2(rank + 1) ELSE 0 END) AS dcg "
            f" FROM jr GROUP BY run_id, qid) d LEFT JOIN "
            f"(SELECT qid, sum(CASE WHEN pos <= {k} THEN ig / log2(pos + 1) ELSE 0 END) AS idcg FROM ideal0 GROUP BY qid) i "
            f"ON d.qid = i.qid")
    return _with(FIX_B, judged_cte(), IDEAL_CTE.split("ideal AS")[0].rstrip().rstrip(",")) + \
        "\nUNION ALL\n".join(parts)


def own_parameters_sql() -> str:
    """A5: the defaults' formulas with other numbers put in."""
    rel = "sum(CASE WHEN code >= 1 THEN 1 ELSE 0 END)"
    ap = lambda k: f"sum(CASE WHEN code >= 1 AND rank <= {k} THEN CAST(cr AS DOUBLE) / rank ELSE 0 END)"
    p, r = _div(rel, "count(*)"), _div(rel, "R")
    items = [*[(f"P_{k}", f"{_hits(k)} / {_d(k)}") for k in (3, 7)], ("recall_3", _div(_hits(3), "R")),
             ("relative_P_4", _div(_hits(4), "least(4, R)")),
             ("success_2", f"CASE WHEN {_hits(2)} > 0 THEN 1.0 ELSE 0.0 END"),
             *[(f"map_cut_{k}", _div(ap(k), "R")) for k in (4, 60)],
             *[(f"Rprec_mult_{x:.2f}", _div(f"sum(CASE WHEN code >= 1 AND rank <= {_kcut(x)} THEN 1 ELSE 0 END)", _kcut(x)))
               for x in (0.3, 2.5)],
             *[(f"iprec_at_recall_{x:.2f}", _iprec(x)) for x in (0.15, 0.35)],
             ("11pt_avg_0.25,0.5,0.75", "(" + " + ".join(_iprec(x) for x in (0.25, 0.5, 0.75)) + ") / 3.0"),
             ("utility_2,-1,0.5,0", f"2.0 * {rel} - (count(*) - {rel}) + 0.5 * (R - {rel})"),
             ("set_F_0.5", f"CASE WHEN {rel} > 0 THEN {_div(f'1.5 * {p} * {r}', f'0.5 * {p} + {r}')} ELSE 0.0 END")]
    own = _with(FIX_B, judged_cte()) + _long(items)
    cuts = "\nUNION ALL\n".join(
        f"SELECT d.run_id, d.qid, 'ndcg_cut_{k}' AS measure, round({_div('d.dcg', 'coalesce(i.idcg, 0)')}, 6) AS value FROM "
        f"(SELECT run_id, qid, sum(CASE WHEN rank <= {k} AND code > 0 THEN code / log2(rank + 1) ELSE 0 END) AS dcg "
        f" FROM jr GROUP BY run_id, qid) d LEFT JOIN "
        f"(SELECT qid, sum(CASE WHEN pos <= {k} THEN rel / log2(pos + 1) ELSE 0 END) AS idcg FROM "
        f" (SELECT qid, rel, row_number() OVER (PARTITION BY qid ORDER BY rel DESC) AS pos FROM qrels WHERE rel > 0) GROUP BY qid) i "
        f"ON d.qid = i.qid" for k in (3, 40))
    return own + "\nUNION ALL\n" + cuts


# ---------------------------------------------------------------- others
def relstring_sql(n=10) -> str:
    ch = ("CASE WHEN code > 9 THEN '>' WHEN code >= 0 THEN CAST(code AS VARCHAR) "
          "WHEN code = -1 THEN '-' WHEN code = -2 THEN '.' ELSE '<' END")
    return (_with(FIX_B, judged_cte()) +
            f"SELECT run_id, qid, 'relstring_{n}' AS measure, "
            f"string_agg({ch}, '' ORDER BY rank) FILTER (WHERE rank <= {n}) AS value "
            f"FROM jr GROUP BY run_id, qid")


def geo_sql(name: str) -> str:
    items = dict(m_items("map" if name == "gm_map" else "bpref"))
    v = list(items.values())[0]
    return (_with(FIX_B, judged_cte()) +
            f"SELECT run_id, '{name}' AS measure, round(exp(avg(lv)), 6) AS value FROM "
            f"(SELECT run_id, qid, ln(greatest({v}, {_d(1e-5)})) AS lv FROM jr GROUP BY run_id, qid, R, Nn) "
            f"GROUP BY run_id")


SUM_KIND = {"num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret"}


def summary_sql() -> str:
    names = ["num_ret", "num_rel", "num_rel_ret", "map", "Rprec", "bpref", "recip_rank",
             "iprec_at_recall", "P"]
    items = []
    for n in names:
        items += m_items(n)
    pt = "\nUNION ALL\n".join(
        f"SELECT run_id, qid, '{n}' AS measure, CAST(({e}) AS DOUBLE) AS value FROM jr GROUP BY run_id, qid, R, Nn"
        for n, e in items)
    sums = ", ".join(f"'{n}'" for n in SUM_KIND)
    return (_with(FIX_B, judged_cte()) +
            f"SELECT run_id, measure, round(CASE WHEN measure IN ({sums}) THEN sum(value) ELSE avg(value) END, 6) AS value "
            f"FROM ({pt}) GROUP BY run_id, measure "
            f"UNION ALL SELECT run_id, 'gm_map', round(exp(avg(ln(greatest(v, {_d(1e-5)})))), 6) FROM "
            f"(SELECT run_id, qid, {dict(m_items('map'))['map']} AS v FROM jr GROUP BY run_id, qid, R, Nn) GROUP BY run_id "
            f"UNION ALL SELECT run_id, 'num_q', CAST(count(DISTINCT qid) AS DOUBLE) FROM jr GROUP BY run_id")


def complete_sql() -> str:
    runs2 = "runs2 AS (SELECT * FROM runs WHERE NOT ends_with(qid, '-1'))"
    items = m_items("map") + m_items("num_ret") + m_items("P")
    pt = "\nUNION ALL\n".join(
        f"SELECT run_id, qid, '{n}' AS measure, CAST(({e}) AS DOUBLE) AS value FROM jr GROUP BY run_id, qid, R, Nn"
        for n, e in items)
    nq = "(SELECT count(DISTINCT qid) FROM qrels)"
    return (_with(FIX_B, runs2, judged_cte(runs="runs2")) +
            f"SELECT run_id, measure, round(CASE WHEN measure = 'num_ret' THEN sum(value) "
            f"ELSE sum(value) / {nq} END, 6) AS value FROM ({pt}) GROUP BY run_id, measure "
            f"UNION ALL SELECT run_id, 'gm_map', round(exp((sum(ln(greatest(v, {_d(1e-5)}))) "
            f"+ ({nq} - count(*)) * ln({_d(1e-5)})) / {nq}), 6) FROM "
            f"(SELECT run_id, qid, {dict(m_items('map'))['map']} AS v FROM jr GROUP BY run_id, qid, R, Nn) GROUP BY run_id "
            f"UNION ALL SELECT DISTINCT run_id, 'num_q', CAST({nq} AS DOUBLE) FROM jr")


def zscore_sql() -> str:
    items = m_items("num_ret") + m_items("num_rel_ret") + m_items("map")
    pt = "\nUNION ALL\n".join(
        f"SELECT run_id, qid, '{n}' AS measure, CAST(({e}) AS DOUBLE) AS value FROM jr GROUP BY run_id, qid, R, Nn"
        for n, e in items)
    return (_with(FIX_B, judged_cte(), f"pt AS ({pt})",
                  "zref AS (SELECT qid, measure, avg(value) AS mean, "
                  "CASE WHEN measure = 'num_rel' THEN 0.0 ELSE stddev_pop(value) END AS sd "
                  "FROM pt WHERE NOT ends_with(qid, '-5') GROUP BY qid, measure)") +
            "SELECT pt.run_id, pt.qid, pt.measure, round(CASE WHEN z.mean IS NULL THEN -1000000.0 "
            "WHEN z.sd <> 0 THEN (pt.value - z.mean) / z.sd WHEN pt.value = z.mean THEN 0.0 "
            "ELSE -1000000.0 END, 6) AS value FROM pt LEFT JOIN zref z ON pt.qid = z.qid AND pt.measure = z.measure")


def eval_oracles() -> dict[str, str]:
    rk = (_with(FIX_B) + "SELECT run_id, qid, docno, CAST(row_number() OVER "
          "(PARTITION BY run_id, qid ORDER BY sim DESC, docno DESC) AS BIGINT) AS rank FROM runs")
    j = ("SELECT run_id, qid, docno, CAST(code AS BIGINT) AS code, CAST(rank AS BIGINT) AS rank, "
         "CAST(cr AS BIGINT) AS cr, CAST(cn AS BIGINT) AS cn, CAST(cu AS BIGINT) AS cu FROM jr")
    return {
        "J1_rank_run": rk,
        "J2_rank_run_tie_asc": rk.replace("docno DESC", "docno ASC"),
        "A5_own_parameters": own_parameters_sql(),
        "M1_runid": _with(FIX_B) + "SELECT DISTINCT run_id, printf('%-22s\tall\t%s', 'runid', run_id) AS line FROM runs",
        "S12_no_overlap": _with(FIX_B) + """SELECT 'none' AS topics_kept, count(DISTINCT qrels.qid) AS topics, count(qrels.qid) = 0 AS raised
            FROM runs JOIN qrels ON 'x' || runs.qid = qrels.qid
            UNION ALL SELECT 'some', count(DISTINCT qrels.qid), count(qrels.qid) = 0
            FROM runs JOIN qrels ON CASE WHEN ends_with(runs.qid, '-1') THEN runs.qid ELSE 'x' || runs.qid END = qrels.qid""",
        "J3_max_docs": f"SELECT * FROM ({rk}) WHERE rank <= 50",
        "J4_J5_duplicates": _with(FIX_B) +
            "SELECT run_id, qid, docno, 2 * count(*) AS count FROM runs WHERE ends_with(docno, '7') GROUP BY ALL "
            "UNION ALL SELECT 'qrels', qid, docno, 2 * count(*) FROM qrels WHERE ends_with(docno, '7') GROUP BY ALL",
        "A5_gain_parameters": "\nUNION ALL\n".join(f"SELECT * FROM ({gain_sql(n, g)})" for n, g in (
            ("G", None), ("ndcg", {1: 3, 2: 9}), ("ndcg_rel", {1: 1, 2: 4}), ("Rndcg", {2: 1}))),
        "J6_judged_join": _with(FIX_B, judged_cte()) + j,
        "J8_judged_only": _with(FIX_B, judged_cte(judged_only=True)) + j,
        "J9_level": _with(FIX_B, judged_cte(level=2)) + j,
        "J15_running_counts_prefix_scan": _with(FIX_B, judged_cte()) + j,
        "J15_measures_prefix_scan": measure_sql(["map", "bpref", "infAP", "P"]),
        "J15_ndcg_rel_prefix_scan": gain_sql("ndcg_rel"),
        "J10_topic_stats": _with(FIX_B) +
            "SELECT qid, CAST(sum(CASE WHEN rel >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS R, "
            "CAST(sum(CASE WHEN rel = 0 THEN 1 ELSE 0 END) AS BIGINT) AS Nn, "
            "CAST(coalesce(max(rel) FILTER (WHERE rel >= 0) + 1, 0) AS BIGINT) AS num_levels, "
            "CAST(sum(CASE WHEN rel >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_judged FROM qrels GROUP BY qid",
        "J12_topic_match": _with(FIX_B) +
            "SELECT DISTINCT run_id, qid FROM runs WHERE qid IN (SELECT qid FROM qrels)",
        "J16_ideal_ranking": _with(FIX_B, IDEAL_CTE.split("itot AS")[0].rstrip().rstrip(",")) +
            "SELECT qid, CAST(pos AS BIGINT) AS pos, ig, round(icum, 6) AS icum FROM ideal",
        "M3_M5_counts": measure_sql(["num_ret", "num_rel", "num_rel_ret"]),
        "M6_map": measure_sql(["map"]),
        "M7_gm_map": geo_sql("gm_map"),
        "M8_Rprec": measure_sql(["Rprec"]),
        "M9_bpref": measure_sql(["bpref"]),
        "M10_recip_rank": measure_sql(["recip_rank"]),
        "M11_iprec_at_recall": measure_sql(["iprec_at_recall"]),
        "M12_P": measure_sql(["P"]),
        "M13_relstring": relstring_sql(),
        "M14_recall": measure_sql(["recall"]),
        "M15_infAP": measure_sql(["infAP"]),
        "M16_gm_bpref": geo_sql("gm_bpref"),
        "M17_Rprec_mult": measure_sql(["Rprec_mult"]),
        "M18_utility": measure_sql(["utility"]),
        "M19_11pt_avg": measure_sql(["11pt_avg"]),
        "M20_binG": measure_sql(["binG"]),
        "M21_G": gain_sql("G"),
        "M22_ndcg": gain_sql("ndcg"),
        "M23_ndcg_rel": gain_sql("ndcg_rel"),
        "M24_Rndcg": gain_sql("Rndcg"),
        "M25_ndcg_cut": ndcg_cut_sql(),
        "M26_map_cut": measure_sql(["map_cut"]),
        "M27_relative_P": measure_sql(["relative_P"]),
        "M28_success": measure_sql(["success"]),
        "M29_M33_set": measure_sql(["set"]),
        "M34_num_nonrel_judged_ret": measure_sql(["num_nonrel_judged_ret"]),
        "J8_measures_judged_only": measure_sql(["map", "P", "bpref", "num_ret"], judged_only=True),
        "J9_measures_level2": measure_sql(["map", "Rprec", "recip_rank", "num_rel_ret"], level=2),
        "J4_J5_scope": measure_sql(["map", "num_ret", "recall"], max_docs=50),
        "J3_measures_max_docs": measure_sql(["map", "num_ret", "recall"], max_docs=20),
        "J14_topic_filter": measure_sql(["map", "P"], topic="3-1"),
        "A1_A2_summary": summary_sql(),
        "J13_complete": complete_sql(),
        "A4_zscore": zscore_sql(),
    }


# ---------------------------------------------------------------- retrieval
STOPS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
         "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
         "their", "then", "there", "these", "they", "this", "to", "was", "will", "with"]
_STOPLIST = "[" + ", ".join(f"'{w}'" for w in STOPS) + "]"
_TOK = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def _tok(x: str) -> str:
    return f"list_filter({_TOK.format(x=x)}, lambda t: NOT list_contains({_STOPLIST}, t))"


FIX_A = f"""
docs AS (SELECT 'D' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS docno, text FROM documents),
dt AS (SELECT docno, {_tok('text')} AS toks FROM docs),
topics AS (SELECT CAST(item_id AS VARCHAR) AS qid,
                  array_to_string({_TOK.format(x='text')}[1:4], ' ') AS title,
                  text AS description FROM benchmark),
qt0 AS (SELECT 'short' AS kind, qid, {_tok('title')} AS toks FROM topics
        UNION ALL SELECT 'long' AS kind, qid, {_tok('description')} AS toks FROM topics),
qt AS (SELECT kind, qid, term, count(*) AS qtf, min(p) AS first_pos
       FROM (SELECT kind, qid, unnest(toks) AS term, unnest(range(len(toks))) AS p FROM qt0)
       GROUP BY kind, qid, term),
vocab AS (SELECT DISTINCT term FROM qt),
occ AS (SELECT docno, len(toks) AS dl, unnest(toks) AS term FROM dt),
post AS (SELECT docno, dl, term, count(*) AS tf FROM occ WHERE term IN (SELECT term FROM vocab)
         GROUP BY docno, dl, term),
cs AS (SELECT count(*) AS N, sum(len(toks)) AS T FROM dt),
ts AS (SELECT term, count(*) AS df, sum(tf) AS ttf FROM post GROUP BY term),
w AS (SELECT qt.kind, qt.qid, qt.term, qt.qtf, qt.first_pos,
             coalesce(ts.df, 0) AS df, coalesce(ts.ttf, 0) AS ttf FROM qt LEFT JOIN ts ON qt.term = ts.term),
j AS (SELECT w.*, post.docno, post.dl, post.tf, cs.N, cs.T, cs.T / cs.N AS avgdl
      FROM post JOIN w ON post.term = w.term CROSS JOIN cs)
"""

_SUMMAND = {
    "tfidf": "(CAST(tf AS DOUBLE) / dl) * log10(1 + CAST(N AS DOUBLE) / df)",
    "bm25": ("qtf * ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * 2.2 / "
             "(tf + 1.2 * (0.25 + 0.75 * dl / avgdl))"),
    "lm_dirichlet": ("qtf * greatest(0.0, ln(1 + tf / (2000.0 * ((ttf + 1.0) / (T + 1.0)))) "
                     "+ ln(2000.0 / (dl + 2000.0)))"),
    "lm_jm": "qtf * ln(1 + ((1 - 0.7) * tf / dl) / (0.7 * ((ttf + 1.0) / (T + 1.0))))",
}


def _model_select(model: str) -> str:
    if model == "classic":
        idf = "(1 + ln(CAST(N AS DOUBLE) / (df + 1)))"
        return (f"SELECT s.kind, s.qid, s.docno, s.raw * s.matched / n.clauses / sqrt(n.ssq) AS score "
                f"FROM (SELECT kind, qid, docno, sum(qtf * sqrt(tf) * {idf} * {idf} / sqrt(dl)) AS raw, "
                f"sum(qtf) AS matched FROM j GROUP BY kind, qid, docno) s JOIN "
                f"(SELECT kind, qid, sum(qtf) AS clauses, sum(qtf * {idf} * {idf}) AS ssq "
                f" FROM w CROSS JOIN cs GROUP BY kind, qid) n ON s.kind = n.kind AND s.qid = n.qid")
    return f"SELECT kind, qid, docno, sum({_SUMMAND[model]}) AS score FROM j GROUP BY kind, qid, docno"


TAGS = {"tfidf": "DEFAULT", "classic": "Default", "bm25": "BM25",
        "lm_dirichlet": "LMDirichlet", "lm_jm": "LMJelinekMercer"}


def _runs_cte(models, k) -> str:
    parts = [f"SELECT '{TAGS[m]}_' || upper(kind) AS run_id, qid, docno, score FROM ({_model_select(m)})"
             for m in models]
    allr = " UNION ALL ".join(parts)
    return (f"allruns AS (SELECT run_id, qid, docno, score, row_number() OVER (PARTITION BY run_id, qid "
            f"ORDER BY round(score, 6) DESC, docno) AS rank FROM ({allr})), "
            f"topk AS (SELECT * FROM allruns WHERE rank <= {k})")


FIX_A_QRELS = """
aq AS (SELECT DISTINCT CAST(b.item_id AS VARCHAR) AS qid, d.docno, 1 AS rel
       FROM benchmark b JOIN docs d ON contains(d.text, b.text))
"""


def retrieval_oracles() -> dict[str, str]:
    A = _with(FIX_A)
    models = ["tfidf", "classic", "bm25", "lm_dirichlet", "lm_jm"]
    o = {
        "T3_tokenize": A + "SELECT docno, array_to_string(toks, ' ') AS tokens, CAST(len(toks) AS BIGINT) AS dl FROM dt",
        "T5_query_terms": A + "SELECT kind, qid, term, CAST(qtf AS BIGINT) AS qtf, CAST(first_pos AS BIGINT) AS first_pos FROM qt",
        "T6_T10_collection_stats": A + "SELECT CAST(N AS BIGINT) AS num_docs, CAST(T AS BIGINT) AS total_tokens, "
                                       "round(CAST(T AS DOUBLE) / N, 6) AS avgdl FROM cs",
        "T7_doc_freq": A + "SELECT term, CAST(df AS BIGINT) AS df, CAST(ttf AS BIGINT) AS ttf FROM ts",
        "T8_doc_length": A + "SELECT docno, CAST(len(toks) AS BIGINT) AS dl FROM dt",
        "T9_postings": A + "SELECT docno, CAST(dl AS BIGINT) AS dl, term, CAST(tf AS BIGINT) AS tf FROM post",
        "T9_postings_bloom": A + "SELECT docno, CAST(dl AS BIGINT) AS dl, term, CAST(tf AS BIGINT) AS tf FROM post",
        "T16_top_k": _with(FIX_A, _runs_cte(["bm25"], 10)) +
            "SELECT run_id, qid, docno, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM topk",
        "T17_rank_zero_based": _with(FIX_A, _runs_cte(["classic"], 10)) +
            "SELECT run_id, qid, docno, CAST(rank - 1 AS BIGINT) AS rank, round(score, 6) AS score FROM topk",
        "T18_retrieve_grid": _with(FIX_A, _runs_cte(models, 1000)) +
            "SELECT run_id, qid, docno, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM topk",
        "T19_explain_scores": _with(FIX_A) +
            "SELECT kind, qid, docno, term, round(c, 6) AS contribution, round(sum(c) OVER (PARTITION BY kind, qid, docno "
            "ORDER BY first_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running FROM "
            f"(SELECT kind, qid, docno, term, first_pos, {_SUMMAND['tfidf']} AS c FROM j)",
        "T20_search": _with(FIX_A, _runs_cte(["bm25"], 1000)) +
            "SELECT run_id, docno, round(score, 6) AS score FROM topk "
            "WHERE run_id = 'BM25_SHORT' AND qid = (SELECT min(qid) FROM topics)",
        "FA_passage_qrels": _with(FIX_A, FIX_A_QRELS) + "SELECT qid, docno, rel FROM aq",
    }
    for m in models:
        name = {"tfidf": "T11_score_tfidf", "classic": "T12_score_classic", "bm25": "T13_score_bm25",
                "lm_dirichlet": "T14_score_lm_dirichlet", "lm_jm": "T15_score_lm_jm"}[m]
        o[name] = A + f"SELECT kind, qid, docno, round(score, 6) AS score FROM ({_model_select(m)})"
    # Retrieve top 1000 -> evaluate -> pivot
    runs_cte = _runs_cte(models, 1000)
    ev = f"""
runs AS (SELECT run_id, qid, docno, CAST(round(score, 6) AS FLOAT) AS sim FROM topk),
qrels AS (SELECT qid, docno, rel FROM aq)"""
    items = m_items("num_ret") + m_items("num_rel_ret") + m_items("map") + \
        [x for x in m_items("P") if x[0] == "P_10"] + m_items("recip_rank")
    pt = "\nUNION ALL\n".join(
        f"SELECT run_id, qid, '{n}' AS measure, CAST(({e}) AS DOUBLE) AS value FROM jr GROUP BY run_id, qid, R, Nn"
        for n, e in items)
    summ = (f"summ AS (SELECT run_id, measure, round(CASE WHEN measure IN ('num_ret', 'num_rel_ret') "
            f"THEN sum(value) ELSE avg(value) END, 6) AS value FROM ({pt}) GROUP BY run_id, measure)")
    runs_names = [f"{TAGS[m]}_{k}" for m in models for k in ("SHORT", "LONG")]
    cols = ", ".join(f"max(CASE WHEN run_id = '{r}' THEN value END) AS \"{r}{'_2' if r.startswith('Default') else ''}\""
                     for r in sorted(runs_names))
    o["T21_compare_narrow"] = (_with(FIX_A, FIX_A_QRELS, runs_cte, ev, judged_cte(), summ) +
                               "SELECT measure, run_id, value FROM summ")
    o["T21_compare_runs"] = (_with(FIX_A, FIX_A_QRELS, runs_cte, ev, judged_cte(), summ) +
                             f"SELECT measure, {cols} FROM summ GROUP BY measure")
    return o


# ---------------------------------------------------------------- sources
FIX_C = """
qj AS (SELECT qid, l_returnflag AS jg, docno,
              CAST(CASE WHEN q >= 60 THEN 2 WHEN q >= 25 THEN 1 WHEN q >= 8 THEN 0 ELSE -1 END AS INTEGER) AS rel
       FROM (SELECT qid, l_returnflag, docno, sum(l_quantity) AS q FROM b
             WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY qid, l_returnflag, docno))
"""
FIX_D = """
dm AS (SELECT qid, l_returnflag AS jg, l_partkey % 30 AS m, CAST(sum(l_quantity) AS INTEGER) % 4 AS lev
       FROM b WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY qid, l_returnflag, l_partkey % 30),
prefs AS (SELECT qid, jg, '0' AS jsg, 'M' || lpad(CAST(m AS VARCHAR), 2, '0') AS docno, CAST(lev AS FLOAT) AS rel_level
          FROM dm WHERE m % 3 IN (0, 1)
          UNION ALL
          SELECT qid, jg, '1' AS jsg, 'M' || lpad(CAST(m AS VARCHAR), 2, '0') AS docno, CAST(lev AS FLOAT) AS rel_level
          FROM dm WHERE m % 3 IN (1, 2))
"""


def _report_sql() -> str:
    items = m_items("num_ret") + m_items("num_rel_ret") + m_items("map") + m_items("P")
    pt = "\nUNION ALL\n".join(
        f"SELECT run_id, qid, '{n}' AS measure, CAST(({e}) AS DOUBLE) AS value FROM jr GROUP BY run_id, qid, R, Nn"
        for n, e in items)
    counts = "('num_ret', 'num_rel_ret')"
    fmt = ("CASE WHEN measure IN {c} THEN printf('%-22s\t%s\t%d', measure, qid, CAST(value AS BIGINT)) "
           "ELSE printf('%-22s\t%s\t%6.4f', measure, qid, value) END").format(c=counts)
    return (_with(FIX_B, judged_cte(), f"pt AS ({pt})") +
            f"SELECT run_id, {fmt} AS line FROM pt "
            f"UNION ALL SELECT run_id, {fmt.replace('qid', chr(39) + 'all' + chr(39))} AS line FROM "
            f"(SELECT run_id, measure, CASE WHEN measure IN {counts} THEN sum(value) ELSE avg(value) END AS value "
            f" FROM pt GROUP BY run_id, measure) "
            f"UNION ALL SELECT DISTINCT run_id, printf('%-22s\t%s\t%s', 'runid', 'all', run_id) FROM jr "
            f"WHERE FALSE")


def _zref_sql() -> str:
    items = m_items("num_ret") + m_items("num_rel_ret") + m_items("map")
    pt = "\nUNION ALL\n".join(
        f"SELECT run_id, qid, '{n}' AS measure, CAST(({e}) AS DOUBLE) AS value FROM jr GROUP BY run_id, qid, R, Nn"
        for n, e in items)
    return (_with(FIX_B, judged_cte(), f"pt AS ({pt})") +
            "SELECT qid, measure, round(avg(value), 6) AS mean, "
            "round(CASE WHEN measure = 'num_rel' THEN 0.0 ELSE stddev_pop(value) END, 6) AS stddev "
            "FROM pt WHERE NOT ends_with(qid, '-5') GROUP BY qid, measure")


def _number_fields_sql() -> str:
    """What is left of a whole number n after each ending (crc32 of the document
    modulo 9): n itself, but n.9 and n times 100 where decimals are read."""
    def kept(n, decimals):
        odd = f"WHEN 2 THEN {n} * 100.0 WHEN 3 THEN ({n}) + CASE WHEN {n} < 0 THEN -0.9 ELSE 0.9 END" if decimals else ""
        v = f"CASE k {odd} WHEN 7 THEN 0.0 WHEN 8 THEN abs({n}) ELSE {n} END"
        return f"CAST(CAST({v} AS {'FLOAT' if decimals else 'DOUBLE'}) AS DOUBLE)"
    n = "CAST(sim AS INTEGER)"
    own = "FROM runs JOIN crc USING (docno) WHERE run_id = 'sumqty'"
    z = kept(n, True).replace("AS FLOAT", "AS DOUBLE")
    return (_with(FIX_B, f"crc AS ({_CRC_SQL})") +
            f"SELECT 'qrels' AS kind, qid, docno, {kept('rel', False)} AS v FROM qrels JOIN crc USING (docno) "
            f"UNION ALL SELECT 'run', qid, docno, {kept(n, True)} {own} "
            f"UNION ALL SELECT 'prefs', qid, docno, {kept(n, True)} {own} "
            f"UNION ALL SELECT 'zref', qid, docno, {z} {own}")


#: crc32 of each document's name modulo 9, bit by bit.
_CRC_SQL = """SELECT docno, CAST(xor(4294967295::BIGINT, list_reduce(
      [4294967295::BIGINT] || list_transform(range(0, 8 * length(docno)), lambda i: (ascii(docno[1 + i // 8]) >> (i % 8)) & 1),
      lambda acc, x: CASE WHEN (xor(acc, x) & 1) = 1 THEN xor(acc >> 1, 3988292384::BIGINT) ELSE acc >> 1 END)) % 9 AS BIGINT) AS k
    FROM (SELECT docno FROM runs UNION SELECT docno FROM qrels)"""


def source_oracles() -> dict[str, str]:
    return {
        "S2_S9_run_roundtrip": _with(FIX_B) + "SELECT run_id, qid, docno, CAST(sim AS DOUBLE) AS sim FROM runs",
        "S9_run_lines": _with(FIX_B) + """SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY qid, rank) AS n,
            printf('%s 0 %s %d %.5f %s', qid, docno, rank, CAST(sim AS DOUBLE), run_id) AS line
            FROM (SELECT *, row_number() OVER (PARTITION BY run_id, qid ORDER BY sim DESC, docno DESC) AS rank FROM runs)""",
        "S2_S7_number_fields": _number_fields_sql(),
        "S11_malformed_lines": _with(FIX_B) + """SELECT qid AS topic, n AS line_no,
            CASE right(docno, 1) WHEN '7' THEN qid || ' 0 ' || docno WHEN '3' THEN qid || ' 0 ' || docno || ' ' || rel || ' more' ELSE '' END AS line,
            CAST(CASE right(docno, 1) WHEN '7' THEN 3 WHEN '3' THEN 5 ELSE 0 END AS BIGINT) AS n_fields
            FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY docno) AS n FROM qrels) WHERE right(docno, 1) IN ('1', '3', '7')""",
        "S3_qrels_roundtrip": _with(FIX_B) + "SELECT qid, docno, rel FROM qrels",
        "S4_S6_qrels_jg_roundtrip": _with(FIX_B, FIX_C) +
            "SELECT qid, jg, docno, CAST(rel AS DOUBLE) AS v, 'qrels_jg' AS src FROM qj "
            "UNION ALL SELECT qid, jg, docno, CAST(rel AS DOUBLE) AS v, 'prefs_jsg0' AS src FROM qj",
        "S5_prefs_roundtrip": _with(FIX_B, FIX_D) +
            "SELECT qid, jg, jsg, docno, CAST(rel_level AS DOUBLE) AS rel_level FROM prefs",
        "S10_report": _report_sql(),
        "S7_zref_roundtrip": _zref_sql(),
        "S1_T1_T2_topics_roundtrip": _with(FIX_A) +
            "SELECT CASE WHEN left(qid, 1) = '0' THEN substr(qid, 2) ELSE qid END AS qid, "
            "' ' || title || chr(10) || chr(10) AS title, "
            "' Description:' || chr(10) || description || chr(10) || chr(10) AS description, "
            f"array_to_string({_tok('title')}, ' ') AS short_terms, "
            f"array_to_string({_tok(chr(39) + ' Description:' + chr(39) + ' || chr(10) || description')}, ' ') AS long_terms "
            "FROM topics",
    }





# ---------------------------------------------------------------- groups
def judged_jg_cte(level=1) -> str:
    return f"""
gst AS (SELECT qid, jg, sum(CASE WHEN rel >= {level} THEN 1 ELSE 0 END) AS R,
               sum(CASE WHEN rel >= 0 AND rel < {level} THEN 1 ELSE 0 END) AS Nn FROM qj GROUP BY qid, jg),
grk AS (SELECT r.run_id, r.qid, g.jg, r.docno, r.sim,
               row_number() OVER (PARTITION BY r.run_id, r.qid, g.jg ORDER BY r.sim DESC, r.docno DESC) AS orig_rank
        FROM runs r JOIN (SELECT DISTINCT qid, jg FROM qj) g ON r.qid = g.qid),
gj AS (SELECT grk.run_id, grk.qid, grk.jg, grk.docno, grk.orig_rank,
              CASE WHEN q.rel IS NULL THEN -1 WHEN q.rel < 0 THEN -2 ELSE q.rel END AS code
       FROM grk LEFT JOIN qj q ON grk.qid = q.qid AND grk.jg = q.jg AND grk.docno = q.docno),
gjr AS (SELECT gj.*, gst.R, gst.Nn, row_number() OVER w AS rank,
               sum(CASE WHEN code >= {level} THEN 1 ELSE 0 END) OVER w AS cr
        FROM gj JOIN gst ON gj.qid = gst.qid AND gj.jg = gst.jg
        WINDOW w AS (PARTITION BY gj.run_id, gj.qid, gj.jg ORDER BY gj.orig_rank
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def _jg_measure(base: str, jgname: str) -> str:
    items = m_items(base)
    sels = []
    for n, e in items:
        out = jgname + n[len(base):]
        sels.append(f"SELECT run_id, qid, '{out}' AS measure, round(avg(v), 6) AS value FROM "
                    f"(SELECT run_id, qid, jg, CAST(({e}) AS DOUBLE) AS v FROM gjr GROUP BY run_id, qid, jg, R, Nn) "
                    f"GROUP BY run_id, qid")
    return _with(FIX_B, FIX_C, judged_jg_cte()) + "\nUNION ALL\n".join(sels)


def _jg_complete_sql() -> str:
    """map_avgjg over every judged topic, for runs without the topics ending in -1."""
    ap = dict(m_items("map"))["map"]
    jr = judged_jg_cte().replace("FROM runs r", "FROM (SELECT * FROM runs WHERE NOT ends_with(qid, '-1')) r")
    return (_with(FIX_B, FIX_C, jr, f"pg AS (SELECT run_id, qid, jg, CAST(({ap}) AS DOUBLE) AS v FROM gjr "
                                    "GROUP BY run_id, qid, jg, R, Nn)",
                  "pt AS (SELECT run_id, qid, avg(v) AS v FROM pg GROUP BY run_id, qid)",
                  "nq AS (SELECT count(DISTINCT qid) AS n FROM qj)") +
            "SELECT run_id, 'map_avgjg' AS measure, round(sum(v) / max(n), 6) AS value FROM pt, nq GROUP BY run_id "
            "UNION ALL SELECT DISTINCT run_id, 'num_q', CAST(n AS DOUBLE) FROM pt, nq")


# ---------------------------------------------------------------- preferences
def prefs_ctes(single: bool = False) -> str:
    own = "qid, jg || '/' || jsg AS jg, '0' AS jsg, docno, rel_level" if single else "*"
    return f"""
pf AS (SELECT {own} FROM prefs),
druns AS (SELECT 'sumqty' AS run_id, qid, 'M' || lpad(CAST(l_partkey % 30 AS VARCHAR), 2, '0') AS docno,
                 CAST(sum(l_quantity) AS FLOAT) AS sim
          FROM b WHERE l_shipdate < TIMESTAMP '1997-01-01' GROUP BY qid, l_partkey % 30),
shape AS (SELECT qid, jg, count(DISTINCT jsg) AS n_jsg FROM pf GROUP BY qid, jg),
direct AS (SELECT DISTINCT a.qid, a.jg, a.docno AS hi, b.docno AS lo FROM pf a JOIN pf b
           ON a.qid = b.qid AND a.jg = b.jg AND a.jsg = b.jsg AND a.rel_level > b.rel_level),
closed(qid, jg, hi, lo) AS (SELECT qid, jg, hi, lo FROM direct
                            UNION SELECT c.qid, c.jg, c.hi, d.lo FROM closed c JOIN direct d
                            ON c.qid = d.qid AND c.jg = d.jg AND c.lo = d.hi),
pairs AS (SELECT d.qid, d.jg, d.hi, d.lo, FALSE AS multi FROM direct d JOIN shape s
          ON d.qid = s.qid AND d.jg = s.jg WHERE s.n_jsg = 1
          UNION ALL
          SELECT c.qid, c.jg, c.hi, c.lo, TRUE AS multi FROM closed c JOIN shape s
          ON c.qid = s.qid AND c.jg = s.jg WHERE s.n_jsg > 1),
prk AS (SELECT run_id, qid, docno, row_number() OVER (PARTITION BY run_id, qid ORDER BY sim DESC, docno ASC) AS rank
        FROM druns),
jd AS (SELECT DISTINCT qid, docno FROM pf),
tp AS (SELECT DISTINCT run_id, qid FROM prk WHERE qid IN (SELECT qid FROM jd)),
pos AS (SELECT g.run_id, g.qid, g.docno,
               row_number() OVER (PARTITION BY g.run_id, g.qid ORDER BY r.rank ASC NULLS LAST, g.docno) - 1 AS pos,
               r.rank IS NOT NULL AS ret,
               count(r.rank) OVER (PARTITION BY g.run_id, g.qid) AS njr,
               count(*) OVER (PARTITION BY g.run_id, g.qid) AS nj
        FROM (SELECT tp.run_id, jd.qid, jd.docno FROM tp JOIN jd ON tp.qid = jd.qid) g
        LEFT JOIN prk r ON g.run_id = r.run_id AND g.qid = r.qid AND g.docno = r.docno),
pp AS (SELECT pr.qid, pr.jg, pr.hi, pr.lo, pr.multi, a.run_id, a.pos AS ph, b.pos AS pl, a.njr
       FROM pairs pr JOIN pos a ON pr.qid = a.qid AND pr.hi = a.docno
       JOIN pos b ON a.run_id = b.run_id AND pr.qid = b.qid AND pr.lo = b.docno),
ppa AS (SELECT *, CASE WHEN ph < pl THEN (CASE WHEN pl < njr THEN 'ful_ret' WHEN ph < njr THEN 'ful_imp' ELSE 'none' END)
                       ELSE (CASE WHEN ph < njr THEN 'nf_ret' WHEN pl < njr THEN 'nf_imp' ELSE 'none' END) END AS area
        FROM pp),
lvp AS (SELECT lv.qid, lv.jg, lv.docno, lv.lvl, s.n_jsg, pos.run_id, pos.pos, pos.ret, pos.njr,
               (s.n_jsg > 1 AND lv.lvl = 0) OR (s.n_jsg = 1 AND lv.lvl <= 0) AS is_non
        FROM (SELECT qid, jg, docno, max(rel_level) AS lvl FROM pf GROUP BY qid, jg, docno) lv
        JOIN shape s ON lv.qid = s.qid AND lv.jg = s.jg
        JOIN pos ON lv.qid = pos.qid AND lv.docno = pos.docno),
dc AS (SELECT run_id, qid, jg, max(n_jsg) AS n_jsg,
              sum(CASE WHEN lvl > 0 THEN 1 ELSE 0 END) AS rel,
              sum(CASE WHEN lvl > 0 AND ret THEN 1 ELSE 0 END) AS rel_ret,
              sum(CASE WHEN is_non THEN 1 ELSE 0 END) AS nonrel,
              sum(CASE WHEN is_non AND ret THEN 1 ELSE 0 END) AS nonrel_ret
       FROM lvp GROUP BY run_id, qid, jg),
ac AS (SELECT run_id, qid, jg,
              sum(CASE WHEN area = 'ful_ret' THEN 1 ELSE 0 END) AS ful_ret,
              sum(CASE WHEN area IN ('ful_ret', 'nf_ret') THEN 1 ELSE 0 END) AS poss_ret,
              sum(CASE WHEN area = 'ful_imp' THEN 1 ELSE 0 END) AS ful_imp,
              sum(CASE WHEN area IN ('ful_imp', 'nf_imp') THEN 1 ELSE 0 END) AS poss_imp,
              sum(CASE WHEN area = 'none' THEN 1 ELSE 0 END) AS notoccur
       FROM ppa GROUP BY run_id, qid, jg),
cnt AS (SELECT dc.*, coalesce(ac.ful_ret, 0) AS ful_ret, coalesce(ac.poss_ret, 0) AS poss_ret,
               coalesce(ac.ful_imp, 0) AS ful_imp, coalesce(ac.poss_imp, 0) AS poss_imp,
               coalesce(ac.notoccur, 0) AS notoccur
        FROM dc LEFT JOIN ac ON dc.run_id = ac.run_id AND dc.qid = ac.qid AND dc.jg = ac.jg),
kd AS (SELECT lvp.*, c.rel, c.rel_ret,
              CASE WHEN is_non THEN row_number() OVER (PARTITION BY lvp.run_id, lvp.qid, lvp.jg, is_non ORDER BY pos) END AS non_idx
       FROM lvp JOIN cnt c ON lvp.run_id = c.run_id AND lvp.qid = c.qid AND lvp.jg = c.jg),
kd2 AS (SELECT *, NOT is_non OR non_idx <= rel AS keep_all,
               NOT is_non OR (CASE WHEN n_jsg > 1 THEN non_idx <= rel ELSE non_idx <= rel_ret END) AS keep_ret
        FROM kd),
multi_rc AS (SELECT p.run_id, p.qid, p.jg,
                    sum(CASE WHEN h.keep_all AND l.keep_all AND p.area IN ('ful_ret', 'ful_imp') THEN 1 ELSE 0 END) AS rn_ful,
                    sum(CASE WHEN h.keep_all AND l.keep_all THEN 1 ELSE 0 END) AS rn_poss,
                    sum(CASE WHEN h.keep_ret AND l.keep_ret AND p.ph < p.njr AND p.pl < p.njr AND p.area = 'ful_ret' THEN 1 ELSE 0 END) AS rr_ful,
                    sum(CASE WHEN h.keep_ret AND l.keep_ret AND p.ph < p.njr AND p.pl < p.njr THEN 1 ELSE 0 END) AS rr_poss
             FROM ppa p JOIN kd2 h ON p.run_id = h.run_id AND p.qid = h.qid AND p.jg = h.jg AND p.hi = h.docno
             JOIN kd2 l ON p.run_id = l.run_id AND p.qid = l.qid AND p.jg = l.jg AND p.lo = l.docno
             WHERE p.multi GROUP BY p.run_id, p.qid, p.jg),
srr AS (SELECT p.run_id, p.qid, p.jg,
               sum(CASE WHEN p.ph < p.pl AND p.ph < p.njr THEN 1 ELSE 0 END) AS a_ful, count(*) AS a_poss,
               sum(CASE WHEN p.ph < p.njr AND p.pl < p.njr AND p.ph < p.pl THEN 1 ELSE 0 END) AS ar_ful,
               sum(CASE WHEN p.ph < p.njr AND p.pl < p.njr THEN 1 ELSE 0 END) AS ar_poss
        FROM pp p JOIN kd2 l ON p.run_id = l.run_id AND p.qid = l.qid AND p.jg = l.jg AND p.lo = l.docno
        WHERE NOT p.multi AND l.lvl > 0 GROUP BY p.run_id, p.qid, p.jg),
svn AS (SELECT d1.run_id, d1.qid, d1.jg,
               sum(CASE WHEN d2.is_non AND d2.keep_all AND d1.ret AND d1.pos < d2.pos THEN 1 ELSE 0 END) AS b_ful,
               sum(CASE WHEN d2.is_non AND d2.keep_all THEN 1 ELSE 0 END) AS b_poss,
               sum(CASE WHEN d2.is_non AND d2.keep_ret AND d2.ret AND d1.ret AND d1.pos < d2.pos THEN 1 ELSE 0 END) AS br_ful,
               sum(CASE WHEN d2.is_non AND d2.keep_ret AND d2.ret AND d1.ret THEN 1 ELSE 0 END) AS br_poss
        FROM kd2 d1 JOIN kd2 d2 ON d1.run_id = d2.run_id AND d1.qid = d2.qid AND d1.jg = d2.jg
        WHERE d1.n_jsg = 1 GROUP BY d1.run_id, d1.qid, d1.jg),
single_rc AS (SELECT v.run_id, v.qid, v.jg, coalesce(r.a_ful, 0) + v.b_ful AS rn_ful,
                     coalesce(r.a_poss, 0) + v.b_poss AS rn_poss,
                     coalesce(r.ar_ful, 0) + v.br_ful AS rr_ful, coalesce(r.ar_poss, 0) + v.br_poss AS rr_poss
              FROM svn v LEFT JOIN srr r ON v.run_id = r.run_id AND v.qid = r.qid AND v.jg = r.jg),
rc AS (SELECT * FROM multi_rc UNION ALL SELECT * FROM single_rc),
cj AS (SELECT c.*, coalesce(rc.rn_ful, 0) AS rn_ful0, coalesce(rc.rn_poss, 0) AS rn_poss0,
              coalesce(rc.rr_ful, 0) AS rr_ful0, coalesce(rc.rr_poss, 0) AS rr_poss0
       FROM cnt c LEFT JOIN rc ON c.run_id = rc.run_id AND c.qid = rc.qid AND c.jg = rc.jg),
cj2 AS (SELECT *,
          CASE WHEN rel >= nonrel THEN ful_ret + ful_imp + rel_ret * (rel - nonrel) ELSE rn_ful0 END AS rnf,
          CASE WHEN rel >= nonrel THEN poss_ret + poss_imp + notoccur + rel * (rel - nonrel) ELSE rn_poss0 END AS rnp,
          CASE WHEN rel_ret >= nonrel_ret THEN ful_ret + rel_ret * (rel_ret - nonrel_ret) ELSE rr_ful0 END AS rrf,
          CASE WHEN rel_ret >= nonrel_ret THEN poss_ret + rel * (rel_ret - nonrel_ret) ELSE rr_poss0 END AS rrp
        FROM cj),
topic AS (SELECT run_id, qid, count(*) AS num_jgs,
                 sum(ful_ret) AS s_ful_ret, sum(ful_imp) AS s_ful_imp, sum(poss_ret) AS s_poss_ret,
                 sum(poss_imp) AS s_poss_imp, sum(notoccur) AS s_notoccur,
                 sum(CASE WHEN poss_ret + poss_imp + notoccur > 0 THEN (ful_ret + ful_imp) / (poss_ret + poss_imp + notoccur) ELSE 0 END) AS aj,
                 sum(CASE WHEN poss_ret > 0 THEN ful_ret / poss_ret ELSE 0 END) AS aj_ret,
                 sum(CASE WHEN poss_ret + poss_imp > 0 THEN (ful_ret + ful_imp) / (poss_ret + poss_imp) ELSE 0 END) AS aj_imp,
                 max(CASE WHEN rnp = 0 THEN 1 ELSE 0 END) AS rn_nan,
                 sum(CASE WHEN rnp <> 0 THEN rnf / rnp ELSE 0 END) AS rn,
                 max(CASE WHEN rrp = 0 THEN 1 ELSE 0 END) AS rr_nan,
                 sum(CASE WHEN rrp <> 0 THEN rrf / rrp ELSE 0 END) AS rr
          FROM cj2 GROUP BY run_id, qid),
pc AS (SELECT run_id, qid, least(ph, pl) AS pu, greatest(ph, pl) AS pd, njr,
              sum(CASE WHEN ph < pl THEN 1 ELSE 0 END) AS c_up, sum(CASE WHEN ph > pl THEN 1 ELSE 0 END) AS c_down
       FROM pp GROUP BY run_id, qid, least(ph, pl), greatest(ph, pl), njr),
pscore AS (SELECT run_id, qid,
                  sum(CASE WHEN pd < njr THEN CAST(c_up AS DOUBLE) / (c_up + c_down) ELSE 0 END) AS s_rr,
                  sum(CASE WHEN pd < njr THEN 1 ELSE 0 END) AS n_rr,
                  sum(CASE WHEN pu < njr AND pd >= njr THEN CAST(c_up AS DOUBLE) / (c_up + c_down) ELSE 0 END) AS s_ri,
                  sum(CASE WHEN pu < njr AND pd >= njr THEN 1 ELSE 0 END) AS n_ri,
                  sum(CASE WHEN pu >= njr THEN 1 ELSE 0 END) AS n_uu
           FROM pc GROUP BY run_id, qid),
tv AS (SELECT t.*, coalesce(p.s_rr, 0) AS s_rr, coalesce(p.n_rr, 0) AS n_rr, coalesce(p.s_ri, 0) AS s_ri,
              coalesce(p.n_ri, 0) AS n_ri, coalesce(p.n_uu, 0) AS n_uu
       FROM topic t LEFT JOIN pscore p ON t.run_id = p.run_id AND t.qid = p.qid)
"""


def _pref_exprs() -> dict[str, str]:
    ful = "(s_ful_ret + s_ful_imp)"
    poss = "(s_poss_ret + s_poss_imp + s_notoccur)"

    def avgjg(s, nan=None):
        cond = f"{s} > 0" + (f" AND {nan} = 0" if nan else "")
        return f"CASE WHEN {cond} THEN {s} / num_jgs ELSE 0.0 END"
    return {
        "prefs_num_prefs_poss": f"CAST({poss} AS DOUBLE)",
        "prefs_num_prefs_ful": f"CAST({ful} AS DOUBLE)",
        "prefs_num_prefs_ful_ret": "CAST(s_ful_ret AS DOUBLE)",
        "prefs_simp": _div(ful, poss),
        "prefs_pair": _div("s_rr + s_ri", "n_rr + n_ri + n_uu"),
        "prefs_avgjg": avgjg("aj"),
        "prefs_avgjg_Rnonrel": avgjg("rn", "rn_nan"),
        "prefs_simp_ret": _div("s_ful_ret", "s_poss_ret"),
        "prefs_pair_ret": _div("s_rr", "n_rr"),
        "prefs_avgjg_ret": avgjg("aj_ret"),
        "prefs_avgjg_Rnonrel_ret": avgjg("rr", "rr_nan"),
        "prefs_simp_imp": _div(ful, "s_poss_ret + s_poss_imp"),
        "prefs_pair_imp": _div("s_rr + s_ri", "n_rr + n_ri"),
        "prefs_avgjg_imp": avgjg("aj_imp"),
    }


PREF_ORDER = ["prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret",
              "prefs_simp", "prefs_pair", "prefs_avgjg", "prefs_avgjg_Rnonrel",
              "prefs_simp_ret", "prefs_pair_ret", "prefs_avgjg_ret", "prefs_avgjg_Rnonrel_ret",
              "prefs_simp_imp", "prefs_pair_imp", "prefs_avgjg_imp"]


def _prefs_with(single=False, free_levels=False) -> str:
    fix_d = FIX_D.replace("AS INTEGER) % 4 AS lev", "AS INTEGER) AS lev") if free_levels else FIX_D
    return "WITH RECURSIVE " + ",".join(c.strip() for c in (FIX_B, fix_d, prefs_ctes(single))) + "\n"


def prefs_measure_sql(names, single=False) -> str:
    ex = _pref_exprs()
    sels = [f"SELECT run_id, qid, '{n}' AS measure, round(CAST(({ex[n]}) AS DOUBLE), 6) AS value FROM tv"
            for n in names]
    return _prefs_with(single) + "\nUNION ALL\n".join(sels)


def group_pref_oracles() -> dict[str, str]:
    W = _prefs_with()
    return {
        "J7_judged_join_jg": _with(FIX_B, FIX_C, judged_jg_cte()) +
            "SELECT run_id, qid, jg, docno, CAST(code AS BIGINT) AS code, CAST(rank AS BIGINT) AS rank FROM gjr",
        "G1_map_avgjg": _jg_measure("map", "map_avgjg"),
        "G2_P_avgjg": _jg_measure("P", "P_avgjg"),
        "G3_Rprec_mult_avgjg": _jg_measure("Rprec_mult", "Rprec_mult_avgjg"),
        "G_complete": _jg_complete_sql(),
        "P1_direct_pairs": W + "SELECT qid, jg, hi, lo FROM direct",
        "P2_closure": W + "SELECT qid, jg, hi, lo FROM pairs",
        "P3_inconsistencies": W.rstrip() + """,
bad AS (SELECT qid, jg, jsg, docno, rel_level FROM pf
        UNION ALL SELECT qid, jg, jsg, docno, rel_level + 1 FROM pf WHERE ends_with(docno, '7')
        UNION ALL SELECT qid, jg, 'z', docno, 0 FROM pf WHERE ends_with(docno, '3')
        UNION ALL SELECT qid, jg, 'r', docno, 5 - rel_level FROM pf WHERE jsg = '0' AND ends_with(qid, '-2')),
over AS (SELECT DISTINCT x.qid, x.jg, x.docno AS hi, y.docno AS lo FROM bad x
         JOIN bad y ON x.qid = y.qid AND x.jg = y.jg AND x.jsg = y.jsg AND x.rel_level > y.rel_level)
SELECT DISTINCT qid, jg, docno, 'levels_in_subgroup' AS kind FROM bad GROUP BY qid, jg, jsg, docno
HAVING count(DISTINCT rel_level) > 1
UNION ALL SELECT qid, jg, docno, 'zero_and_nonzero' FROM bad GROUP BY qid, jg, docno
HAVING bool_or(rel_level = 0) AND bool_or(rel_level > 0)
UNION ALL SELECT DISTINCT o.qid, o.jg, o.hi, 'preferred_both_ways' FROM over o
JOIN over p ON o.qid = p.qid AND o.jg = p.jg AND o.hi = p.lo AND o.lo = p.hi
""",
        "P4_judged_positions": W + "SELECT run_id, qid, docno, CAST(pos AS BIGINT) AS pos, "
                                   "CAST(njr AS BIGINT) AS njr, CAST(nj AS BIGINT) AS nj FROM pos",
        "P5_P6_jg_counts": W + "SELECT run_id, qid, jg, " + ", ".join(
            f"CAST({c} AS BIGINT) AS {c}" for c in ("ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur",
                                                     "rel", "rel_ret", "nonrel", "nonrel_ret")) + " FROM cnt",
        "P6_single_subgroup_counts": _prefs_with(True) + "SELECT run_id, qid, jg, " + ", ".join(
            f"CAST({c} AS BIGINT) AS {c}" for c in ("ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur",
                                                     "rel", "rel_ret", "nonrel", "nonrel_ret")) + " FROM cnt",
        "P6_free_levels": _prefs_with(True, True) + "SELECT run_id, qid, jg, " + ", ".join(
            f"CAST({c} AS BIGINT) AS {c}" for c in ("ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur",
                                                     "rel", "rel_ret", "nonrel", "nonrel_ret")) + " FROM cnt",
        "P7_pair_counts": W + "SELECT run_id, qid, CAST(pu AS BIGINT) AS pu, CAST(pd AS BIGINT) AS pd, "
                              "CAST(c_up AS BIGINT) AS c_up, CAST(c_down AS BIGINT) AS c_down FROM pc",
        "P8_P11_P15_P19_simple": prefs_measure_sql(["prefs_num_prefs_poss", "prefs_num_prefs_ful",
                                                    "prefs_num_prefs_ful_ret", "prefs_simp",
                                                    "prefs_simp_ret", "prefs_simp_imp"]),
        "P12_P16_P20_pair": prefs_measure_sql(["prefs_pair", "prefs_pair_ret", "prefs_pair_imp"]),
        "P13_P17_P21_avgjg": prefs_measure_sql(["prefs_avgjg", "prefs_avgjg_ret", "prefs_avgjg_imp"]),
        "P14_P18_Rnonrel": prefs_measure_sql(["prefs_avgjg_Rnonrel", "prefs_avgjg_Rnonrel_ret"]),
        "P_single_subgroup_all": prefs_measure_sql(PREF_ORDER, single=True),
        "P_single_subgroup_prefix_scan": prefs_measure_sql(PREF_ORDER, single=True),
    }


def all_oracles() -> dict[str, str]:
    o = {}
    o.update(eval_oracles())
    o.update(retrieval_oracles())
    o.update(source_oracles())
    o.update(group_pref_oracles())
    return o
