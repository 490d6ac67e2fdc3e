"""Measures over judged rankings (M1-M34) as Column expressions.

Each measure contributes aggregate expressions (evaluated in ONE
`groupBy(run, topic).agg(...)` over the judged frame) and finishing
expressions over the aggregated row.  Expressions are Spark SQL text: a
measure set of ~100 outputs is then a hundred `expr()` calls instead of tens
of thousands of driver round trips to build Column trees.  Only the requested measures enter the
plan, so Catalyst prunes everything else.  `register_measure` is the
extension point (the evaluator's "add a measure" recipe, as Columns).

Combine kinds: "sum" (counts), "mean", "geo" (stored per topic as a log,
averaged then exponentiated), "topic" (per-topic only, e.g. relstring),
"summary" (runid, num_q).
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Callable

from ..config import INFAP_EPSILON, MIN_GEO_MEAN, RELVALUE_NONPOOL, RELVALUE_UNJUDGED
from ..functions.sqlexpr import cnt, dbl, div0, fcut, sum0

# Fixed default parameters of the evaluator.
CUTOFFS = [5, 10, 15, 20, 30, 100, 200, 500, 1000]
RECALL_POINTS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
RPREC_MULTS = [0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0]
SUCCESS_CUTOFFS = [1, 5, 10]
UTILITY_PARAMS = [1.0, -1.0, 0.0, 0.0]
SET_F_PARAM = 1.0
RELSTRING_LEN = 10

# Registry order of the evaluator (report order).
MEASURE_ORDER = [
    "runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "map", "gm_map",
    "Rprec", "bpref", "recip_rank", "iprec_at_recall", "P", "relstring",
    "recall", "infAP", "gm_bpref", "Rprec_mult", "utility", "11pt_avg", "binG",
    "G", "ndcg", "ndcg_rel", "Rndcg", "ndcg_cut", "map_cut", "relative_P",
    "success", "set_P", "set_relative_P", "set_recall", "set_map", "set_F",
    "num_nonrel_judged_ret",
    "prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret",
    "prefs_simp", "prefs_pair", "prefs_avgjg", "prefs_avgjg_Rnonrel",
    "prefs_simp_ret", "prefs_pair_ret", "prefs_avgjg_ret",
    "prefs_avgjg_Rnonrel_ret", "prefs_simp_imp", "prefs_pair_imp",
    "prefs_avgjg_imp", "map_avgjg", "P_avgjg", "Rprec_mult_avgjg",
]

# Measure-set nicknames of the evaluator.
NICKNAMES = {
    "official": ["runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "map",
                 "gm_map", "Rprec", "bpref", "recip_rank", "iprec_at_recall", "P"],
    "set": ["runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "utility",
            "set_P", "set_recall", "set_relative_P", "set_map", "set_F"],
    "all_trec": ["runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "map",
                 "gm_map", "Rprec", "bpref", "recip_rank", "iprec_at_recall", "P",
                 "relstring", "recall", "infAP", "gm_bpref", "utility",
                 "11pt_avg", "ndcg", "relative_P", "Rprec_mult", "success",
                 "map_cut", "ndcg_cut", "ndcg_rel", "Rndcg", "binG", "G",
                 "set_P", "set_recall", "set_relative_P", "set_map", "set_F",
                 "num_nonrel_judged_ret"],
    "all_prefs": ["runid", "num_q", "prefs_num_prefs_poss", "prefs_num_prefs_ful",
                  "prefs_num_prefs_ful_ret", "prefs_simp", "prefs_pair",
                  "prefs_avgjg", "prefs_avgjg_Rnonrel", "prefs_simp_ret",
                  "prefs_pair_ret", "prefs_avgjg_ret", "prefs_avgjg_Rnonrel_ret",
                  "prefs_simp_imp", "prefs_pair_imp", "prefs_avgjg_imp"],
    "prefs": ["runid", "num_q", "prefs_num_prefs_poss", "prefs_num_prefs_ful",
              "prefs_num_prefs_ful_ret", "prefs_simp", "prefs_pair", "prefs_avgjg"],
    "qrels_jg": ["runid", "num_q", "map_avgjg", "P_avgjg", "Rprec_mult_avgjg"],
}


@dataclass
class Out:
    """One output value of a measure (SQL text over the aggregated row)."""
    name: str
    expr: str
    kind: str
    order: tuple


@dataclass
class Ctx:
    """Collects the aggregate expressions the selected measures need.
    Row-level columns of the judged frame: keep, rel, nonrel, unj, nonpool,
    rank, cr, cn, cu, code, R, Nn."""
    level: int
    num_docs: int
    aggs: dict = field(default_factory=dict)   # alias -> aggregate SQL
    gain_sets: list = field(default_factory=list)  # distinct level -> gain maps (None: level)
    needs_idcg_cut: set = field(default_factory=set)

    def agg(self, alias: str, expr: str) -> str:
        alias = re.sub(r"[^0-9A-Za-z_]", "_", alias)
        self.aggs.setdefault(alias, expr)
        return alias

    def gains(self, params) -> str:
        """Suffix of the aligned columns of these `level=gain` pairs: measures
        with equal pairs share one alignment, others have their own."""
        pairs = {int(k): float(v) for k, v in dict(params).items()} if params else None
        if pairs not in self.gain_sets:
            self.gain_sets.append(pairs)
        return f"_{self.gain_sets.index(pairs)}"


def _hits(ctx: Ctx, k) -> str:
    return ctx.agg(f"_hits_{int(k)}", cnt(f"rel AND rank <= {int(k)}"))


def _num_ret(ctx) -> str:
    return ctx.agg("_num_ret", cnt("keep"))


def _num_rel_ret(ctx) -> str:
    return ctx.agg("_num_rel_ret", cnt("rel"))


def _ap_sum(ctx) -> str:
    return ctx.agg("_ap_sum", sum0("rel", "cr / rank"))


def _bpref_sum(ctx) -> str:
    term = f"CASE WHEN cn = 0 THEN 1D ELSE 1D - {div0('least(cn, R)', 'least(Nn, R)')} END"
    return ctx.agg("_bpref_sum", sum0("rel", term))


def _iprec(ctx, p) -> str:
    k = fcut(p, "R")
    best = ctx.agg(f"_iprec_{p!r}", f"max(CASE WHEN keep AND cr >= {k} THEN cr / rank END)")
    return f"(CASE WHEN {k} > {_num_rel_ret(ctx)} THEN 0D ELSE coalesce({best}, 0D) END)"


def _log(x: str) -> str:
    return f"ln(greatest({x}, {dbl(MIN_GEO_MEAN)}))"


# ---------------------------------------------------------------- builders
def b_runid(ctx, params):
    return [Out("runid", "CAST(NULL AS DOUBLE)", "summary", ())]


def b_num_q(ctx, params):
    return [Out("num_q", "1D", "summary", ())]


def b_num_ret(ctx, params):
    return [Out("num_ret", f"CAST({_num_ret(ctx)} AS DOUBLE)", "sum", ())]


def b_num_rel(ctx, params):
    return [Out("num_rel", "CAST(R AS DOUBLE)", "sum", ())]


def b_num_rel_ret(ctx, params):
    return [Out("num_rel_ret", f"CAST({_num_rel_ret(ctx)} AS DOUBLE)", "sum", ())]


def b_map(ctx, params):
    return [Out("map", div0(_ap_sum(ctx), "R"), "mean", ())]


def b_gm_map(ctx, params):
    return [Out("gm_map", _log(div0(_ap_sum(ctx), "R")), "geo", ())]


def b_Rprec(ctx, params):
    hits = ctx.agg("_rprec_hits", cnt("rel AND rank <= R"))
    return [Out("Rprec", div0(hits, "R"), "mean", ())]


def b_bpref(ctx, params):
    return [Out("bpref", div0(_bpref_sum(ctx), "R"), "mean", ())]


def b_gm_bpref(ctx, params):
    return [Out("gm_bpref", _log(div0(_bpref_sum(ctx), "R")), "geo", ())]


def b_recip_rank(ctx, params):
    first = ctx.agg("_first_rel", "min(CASE WHEN rel THEN rank END)")
    return [Out("recip_rank", div0("1D", first), "mean", ())]


def b_iprec_at_recall(ctx, params):
    ps = params or RECALL_POINTS
    return [Out(f"iprec_at_recall_{p:.2f}", _iprec(ctx, p), "mean", (i,))
            for i, p in enumerate(ps)]


def b_11pt_avg(ctx, params):
    ps = params or RECALL_POINTS
    total = " + ".join(_iprec(ctx, p) for p in ps)
    name = "11pt_avg" if not params else "11pt_avg_" + ",".join(_fmt(p) for p in ps)
    return [Out(name, f"(({total}) / {dbl(len(ps))})", "mean", ())]


def b_P(ctx, params):
    ks = params or CUTOFFS
    return [Out(f"P_{k}", div0(_hits(ctx, k), dbl(k)), "mean", (i,)) for i, k in enumerate(ks)]


def b_recall(ctx, params):
    ks = params or CUTOFFS
    return [Out(f"recall_{k}", div0(_hits(ctx, k), "R"), "mean", (i,)) for i, k in enumerate(ks)]


def b_relative_P(ctx, params):
    ks = params or CUTOFFS
    return [Out(f"relative_P_{k}", div0(_hits(ctx, k), f"least({dbl(k)}, R)"), "mean", (i,))
            for i, k in enumerate(ks)]


def b_success(ctx, params):
    ks = params or SUCCESS_CUTOFFS
    return [Out(f"success_{k}", f"(CASE WHEN {_hits(ctx, k)} > 0 THEN 1D ELSE 0D END)",
                "mean", (i,)) for i, k in enumerate(ks)]


def b_map_cut(ctx, params):
    ks = params or CUTOFFS
    outs = []
    for i, k in enumerate(ks):
        s = ctx.agg(f"_ap_cut_{int(k)}", sum0(f"rel AND rank <= {int(k)}", "cr / rank"))
        outs.append(Out(f"map_cut_{k}", div0(s, "R"), "mean", (i,)))
    return outs


def b_Rprec_mult(ctx, params):
    ps = params or RPREC_MULTS
    outs = []
    for i, p in enumerate(ps):
        k = fcut(p, "R")
        hits = ctx.agg(f"_rpm_{p!r}", cnt(f"rel AND rank <= {k}"))
        outs.append(Out(f"Rprec_mult_{p:.2f}", div0(hits, k), "mean", (i,)))
    return outs


def b_infAP(ctx, params):
    eps = dbl(INFAP_EPSILON)
    term = (f"CASE WHEN rank = 1 THEN 1D ELSE 1D / rank + ((rank - 1) / rank) * "
            f"{div0('cr - 1 + cn + cu', 'rank - 1')} * "
            f"((cr - 1 + {eps}) / (cr - 1 + cn + 2 * {eps})) END")
    s = ctx.agg("_infap_sum", sum0("rel", term))
    return [Out("infAP", div0(s, "R"), "mean", ())]


def b_utility(ctx, params):
    p = [float(x) for x in (params or UTILITY_PARAMS)]
    if len(p) != 4:
        raise ValueError("utility needs exactly 4 coefficients")
    a, ret = _num_rel_ret(ctx), _num_ret(ctx)
    v = (f"({dbl(p[0])} * {a} + {dbl(p[1])} * ({ret} - {a}) + {dbl(p[2])} * (R - {a})"
         f" + {dbl(p[3])} * ({int(ctx.num_docs)} + {a} - {ret} - R))")
    name = "utility" if params is None else "utility_" + ",".join(_fmt(x) for x in p)
    return [Out(name, v, "mean", ())]


def b_binG(ctx, params):
    s = ctx.agg("_bing_sum", sum0("rel", "1D / log2(rank - cr + 2)"))
    return [Out("binG", div0(s, "R"), "mean", ())]


def b_set_P(ctx, params):
    return [Out("set_P", div0(_num_rel_ret(ctx), _num_ret(ctx)), "mean", ())]


def b_set_relative_P(ctx, params):
    return [Out("set_relative_P", div0(_num_rel_ret(ctx), f"least({_num_ret(ctx)}, R)"), "mean", ())]


def b_set_recall(ctx, params):
    return [Out("set_recall", div0(_num_rel_ret(ctx), "R"), "mean", ())]


def b_set_map(ctx, params):
    a = _num_rel_ret(ctx)
    return [Out("set_map", div0(f"CAST({a} AS DOUBLE) * {a}", f"CAST({_num_ret(ctx)} AS DOUBLE) * R"),
                "mean", ())]


def b_set_F(ctx, params):
    x = float(params[0]) if params else SET_F_PARAM
    a = _num_rel_ret(ctx)
    p, r = div0(a, _num_ret(ctx)), div0(a, "R")
    v = f"(CASE WHEN {a} > 0 THEN {div0(f'{dbl(x + 1)} * {p} * {r}', f'{dbl(x)} * {p} + {r}')} ELSE 0D END)"
    name = "set_F" if not params else f"set_F_{_fmt(x)}"
    return [Out(name, v, "mean", ())]


def b_num_nonrel_judged_ret(ctx, params):
    nonpool = ctx.agg("_nonpool", cnt("nonpool"))
    unj = ctx.agg("_unj", cnt("unj"))
    v = f"CAST({_num_ret(ctx)} - {nonpool} - {unj} - {_num_rel_ret(ctx)} AS DOUBLE)"
    return [Out("num_nonrel_judged_ret", v, "sum", ())]


def b_relstring(ctx, params):
    n = int(params[0]) if params else RELSTRING_LEN
    ch = (f"CASE WHEN code > 9 THEN '>' WHEN code >= 0 THEN CAST(code AS STRING) "
          f"WHEN code = {RELVALUE_NONPOOL} THEN '-' WHEN code = {RELVALUE_UNJUDGED} THEN '.' "
          f"ELSE '<' END")
    pairs = ctx.agg(f"_relstring_{n}",
                    f"collect_list(CASE WHEN keep AND rank <= {n} THEN named_struct('r', rank, 'c', {ch}) END)")
    text = f"array_join(transform(array_sort({pairs}), x -> x.c), '')"
    name = "relstring" if not params else f"relstring_{n}"
    return [Out(name, text, "topic", ())]


# Gain measures: need the ideal ranking (see operators/ideal.py and the
# aggregates added by plans/evaluate.py).
def _gain_name(base: str, params) -> str:
    pairs = ",".join(f"{k}={_fmt(v)}" for k, v in dict(params or {}).items())
    return f"{base}_{pairs}" if pairs else base


def b_ndcg(ctx, params):
    x = ctx.gains(params)
    return [Out(_gain_name("ndcg", params), div0(f"_dcg{x}", f"idcg{x}"), "mean", ())]


def b_G(ctx, params):
    x = ctx.gains(params)
    return [Out(_gain_name("G", params), div0(f"_g_sum{x}", f"ig_total{x}"), "mean", ())]


def b_ndcg_rel(ctx, params):
    x = ctx.gains(params)
    total = f"(_ndcg_rel_sum{x} + (L{x} - _pos_ret{x}) * {div0(f'_dcg{x}', f'idcg{x}')})"
    return [Out(_gain_name("ndcg_rel", params),
                f"(CASE WHEN L{x} > 0 AND {total} > 0 THEN {total} / L{x} ELSE 0D END)", "mean", ())]


def b_Rndcg(ctx, params):
    x = ctx.gains(params)
    v = div0(f"_rndcg_sum{x} + _rndcg_tail_sum{x}", f"_rndcg_cnt{x} + _rndcg_tail_cnt{x}")
    return [Out(_gain_name("Rndcg", params), f"(CASE WHEN R = 0 THEN 0D ELSE {v} END)", "mean", ())]


def b_ndcg_cut(ctx, params):
    ks = params or CUTOFFS
    outs = []
    for i, k in enumerate(ks):
        k = int(k)
        ctx.needs_idcg_cut.add(k)
        dcg = ctx.agg(f"_dcg_cut_{k}", sum0(f"keep AND rank <= {k} AND code > 0", "code / log2(rank + 1)"))
        outs.append(Out(f"ndcg_cut_{k}", div0(dcg, f"idcg_cut_{k}"), "mean", (i,)))
    return outs


def _fmt(x) -> str:
    x = float(x)
    return str(int(x)) if x.is_integer() else repr(x)


BUILDERS: dict[str, Callable] = {
    "runid": b_runid, "num_q": b_num_q, "num_ret": b_num_ret, "num_rel": b_num_rel,
    "num_rel_ret": b_num_rel_ret, "map": b_map, "gm_map": b_gm_map,
    "Rprec": b_Rprec, "bpref": b_bpref, "recip_rank": b_recip_rank,
    "iprec_at_recall": b_iprec_at_recall, "P": b_P, "relstring": b_relstring,
    "recall": b_recall, "infAP": b_infAP, "gm_bpref": b_gm_bpref,
    "Rprec_mult": b_Rprec_mult, "utility": b_utility, "11pt_avg": b_11pt_avg,
    "binG": b_binG, "G": b_G, "ndcg": b_ndcg, "ndcg_rel": b_ndcg_rel,
    "Rndcg": b_Rndcg, "ndcg_cut": b_ndcg_cut, "map_cut": b_map_cut,
    "relative_P": b_relative_P, "success": b_success, "set_P": b_set_P,
    "set_relative_P": b_set_relative_P, "set_recall": b_set_recall,
    "set_map": b_set_map, "set_F": b_set_F,
    "num_nonrel_judged_ret": b_num_nonrel_judged_ret,
}


def register_measure(name: str, builder: Callable, after: str | None = None) -> None:
    """Add a measure: ``builder(ctx, params) -> list[Out]`` using Columns only."""
    BUILDERS[name] = builder
    if name not in MEASURE_ORDER:
        idx = MEASURE_ORDER.index(after) + 1 if after in MEASURE_ORDER else len(MEASURE_ORDER)
        MEASURE_ORDER.insert(idx, name)


def resolve(measures) -> list[tuple[str, object]]:
    """Measure selection (A5): a nickname, a list of names, or a dict
    name -> params; returned in the evaluator's registry order."""
    if measures is None:
        measures = "official"
    if isinstance(measures, str):
        measures = [measures]
    chosen: dict[str, object] = {}
    items = measures.items() if isinstance(measures, dict) else [(m, None) for m in measures]
    for name, params in items:
        if name in NICKNAMES:
            for m in NICKNAMES[name]:
                chosen.setdefault(m, None)
        else:
            if name not in MEASURE_ORDER:
                raise KeyError(f"unknown measure {name}")
            chosen[name] = params
    return sorted(chosen.items(), key=lambda kv: MEASURE_ORDER.index(kv[0]))
