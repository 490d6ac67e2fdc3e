"""Preference evaluation.

Data flow (all DataFrame joins / windows / aggregates, keyed by run and topic):

* P4 `judged_positions`: every judged document of a topic gets a position:
  retrieved ones 0..NJR-1 in rank order (score desc, docno asc, after -M),
  the rest NJR.. in docno order.
* P3 `inconsistencies`: per-document level vectors; two documents preferred both
  ways are found by running maxima over the levels of two subgroups, without pairs.
* P1 `direct_pairs`: the direct relation as rows (hi, lo).
* P2 `class_relation`: documents of a group with equal level vectors form a class.
  What a class is preferred to is, per subgroup, all documents under a level; these
  levels are closed over the (subgroup, level) nodes in rounds cut with reliable
  checkpoints, and give the relation between classes.  Only `closure_pairs`, P2's
  own output, expands it to documents.
* P5/P6 `all_group_counts`: fulfilled / possible counts per (run, qid, jg) in the
  areas retrieved / implied / neither.  All but one are products of counts per
  level or class; pairs fulfilled among retrieved documents are inversions of
  positions, counted bit by bit of the level's rank (single-subgroup groups, rows
  grow as documents x log levels) or by running counts per class.
* P7 `pair_counts`: per unordered document pair, the number of groups
  preferring each side.  P12/P16/P20 (`pair_scores`) sum over pairs of topic-wide
  classes instead (topics judged by several groups; with one group the pair
  ratios follow from the P6 counts).
* Every per-topic window has a distributed prefix-scan variant (`scan`) used
  when a topic or run is too large for one task.
* P8-P21: arithmetic over those counts, then per topic.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EvalConfig
from ..session import cut_lineage, keep
from ..functions.sqlexpr import div0

PREF_MEASURES = [
    "prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret",
    "prefs_simp", "prefs_pair", "prefs_avgjg", "prefs_avgjg_Rnonrel",
    "prefs_simp_ret", "prefs_pair_ret", "prefs_avgjg_ret", "prefs_avgjg_Rnonrel_ret",
    "prefs_simp_imp", "prefs_pair_imp", "prefs_avgjg_imp",
]
COUNT_MEASURES = {"prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret"}


# ------------------------------------------------------------------ P3
GROUP = ["qid", "jg"]


def doc_vectors(prefs: DataFrame) -> DataFrame:
    """(qid, jg, docno, lv): a document's levels in the subgroups of a group, a
    sorted array of (jsg, lvl)."""
    level = F.struct("jsg", F.col("rel_level").cast("float").alias("lvl"))
    return prefs.groupBy(*GROUP, "docno").agg(F.sort_array(F.collect_set(level)).alias("lv"))


def _two_levels(lv: str = "lv") -> str:
    return f"size({lv}) > size(array_distinct({lv}.jsg))"


def _level_pairs(vectors: DataFrame) -> DataFrame:
    """(qid, jg, s, t, docno, a, b): every document with its levels a and b in two
    subgroups s < t; and with s = t in subgroups that hold a document at two levels,
    the only ones where one subgroup can prefer both ways."""
    two = F.expr("flatten(transform(lv, x -> transform(filter(lv, y -> y.jsg > x.jsg), "
                 "y -> named_struct('s', x.jsg, 't', y.jsg, 'a', x.lvl, 'b', y.lvl))))")
    across = vectors.where("size(lv) > 1").select(*GROUP, "docno", F.explode(two).alias("e"))
    rows = vectors.select(*GROUP, "docno", F.explode("lv").alias("x"))
    faulty = (vectors.where(_two_levels()).select(*GROUP, "docno", F.explode("lv").alias("x"))
              .groupBy(*GROUP, "docno", F.col("x.jsg").alias("s")).count().where("count > 1")
              .select(*GROUP, "s").distinct())
    own = rows.select(*GROUP, "docno", F.col("x.jsg").alias("s"), F.col("x.lvl").alias("a")) \
        .join(faulty, [*GROUP, "s"], "left_semi")
    inside = own.join(own.withColumnRenamed("a", "b"), [*GROUP, "docno", "s"]).select(
        *GROUP, "docno", F.struct("s", F.col("s").alias("t"), "a", "b").alias("e"))
    return across.unionByName(inside).select(*GROUP, "docno", "e.s", "e.t", "e.a", "e.b")


def _turned_levels(pairs: DataFrame) -> DataFrame:
    """(qid, jg, s, t, a, over, under): for each level a in s, the highest level in t
    of documents under a in s, and the lowest in t of those above it.  One row per
    level, whatever the number of documents."""
    keys = [*GROUP, "s", "t"]
    levels = pairs.groupBy(*keys, "a").agg(F.max("b").alias("top"), F.min("b").alias("low"))
    w = Window.partitionBy(*keys).orderBy("a")
    return levels.select(
        *keys, "a", "top", "low",
        F.max("top").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("over"),
        F.min("low").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("under"))


def inconsistencies(prefs: DataFrame) -> DataFrame:
    """(qid, jg, docno, kind) for a document at two levels in one subgroup, at
    level 0 and a non-0 level in one group, or preferred to another document and the
    other way round in subgroups of one group.

    For the last kind a document's level b in subgroup t is held against the levels
    in t of the documents under (or above) it in s: work and rows grow with the
    documents' levels, and no document pair is made."""
    vectors = keep(doc_vectors(prefs))
    two = vectors.where(_two_levels()).select(*GROUP, "docno", F.lit("levels_in_subgroup").alias("kind"))
    zero = vectors.where("exists(lv, x -> x.lvl = 0) AND exists(lv, x -> x.lvl > 0)") \
        .select(*GROUP, "docno", F.lit("zero_and_nonzero").alias("kind"))
    pairs = _level_pairs(vectors)
    turned = _turned_levels(pairs).where("over > low OR under < top").select(*GROUP, "s", "t", "a", "over", "under")
    both = (pairs.join(turned, [*GROUP, "s", "t", "a"]).where("over > b OR under < b")
            .select(*GROUP, "docno").distinct().withColumn("kind", F.lit("preferred_both_ways")))
    return two.unionByName(zero).unionByName(both)


def raise_if_inconsistent(prefs: DataFrame) -> None:
    """P3 as an error.  Whether there is a fault needs two aggregates; the documents
    are looked up only for the message."""
    vectors = cut_lineage(doc_vectors(prefs))
    plain = vectors.agg(F.max(F.expr(f"({_two_levels()}) OR (exists(lv, x -> x.lvl = 0) AND exists(lv, x -> x.lvl > 0))"))
                        .alias("x"), F.max(F.expr("size(lv) > 1")).alias("several")).first()
    faulty = bool(plain["x"])
    if not faulty and plain["several"]:
        faulty = bool(_turned_levels(_level_pairs(vectors)).agg(
            F.max(F.expr("coalesce(over > low, false) OR coalesce(under < top, false)")).alias("x")).first()["x"])
    if faulty:
        bad = inconsistencies(prefs).orderBy("qid", "jg", "docno", "kind").first()
        raise ValueError(f"inconsistent preferences: {bad.asDict()}")


# ------------------------------------------------------------------ P1/P2
def group_shape(prefs: DataFrame) -> DataFrame:
    """(qid, jg, n_jsg): number of judgement subgroups per group."""
    return prefs.groupBy("qid", "jg").agg(F.countDistinct("jsg").alias("n_jsg"))


def direct_pairs(prefs: DataFrame) -> DataFrame:
    """Within each (qid, jg, jsg), every document is preferred to every
    document of a lower level."""
    a = prefs.select("qid", "jg", "jsg", F.col("docno").alias("hi"), F.col("rel_level").alias("lh"))
    b = prefs.select("qid", "jg", "jsg", F.col("docno").alias("lo"), F.col("rel_level").alias("ll"))
    return (a.join(b, ["qid", "jg", "jsg"]).where(F.col("lh") > F.col("ll"))
            .select("qid", "jg", "hi", "lo").distinct())


def closure(pairs: DataFrame) -> DataFrame:
    """Transitive closure.  Each round joins only the pairs found in the last
    one with the direct pairs and ends when no new pair comes; a pair of a
    document with itself is a cycle and raises.  Rounds are cut with reliable
    checkpoints, so an executor loss replays at most one of them."""
    direct = cut_lineage(pairs.distinct())
    after = direct.select("qid", "jg", F.col("hi").alias("mid"), F.col("lo").alias("to"))
    known = new = direct
    while not new.isEmpty():
        cycle = new.where(F.col("hi") == F.col("lo")).limit(1).collect()
        if cycle:
            r = cycle[0]
            raise ValueError(f"preference cycle in topic {r['qid']} group {r['jg']} at {r['hi']}")
        step = new.withColumnRenamed("lo", "mid").join(after, ["qid", "jg", "mid"]) \
            .select("qid", "jg", "hi", F.col("to").alias("lo")).distinct()
        new = cut_lineage(step.join(known, ["qid", "jg", "hi", "lo"], "left_anti"))
        known = known.unionByName(new)
    return known


def doc_classes(prefs: DataFrame) -> DataFrame:
    """(qid, jg, docno, cls, lv): documents of a group whose levels are the same in
    all its subgroups have one class, and all preferences in common."""
    return doc_vectors(prefs).select(*GROUP, "docno", F.md5(F.to_json("lv").cast("binary")).alias("cls"), "lv")


def class_relation(classes: DataFrame) -> DataFrame:
    """P2 between classes: (qid, jg, hi, lo), transitively closed.

    A document at level l of subgroup s is preferred to all documents under l there,
    and through them to more.  In each subgroup t that is again all documents under
    some level, so a node (s, l) has one such level per t (`m`).  A round takes, for
    every class, the best levels of its nodes, and for every node the best of the
    classes under it; the table has nodes x subgroups rows.  It ends when no
    level rises.  A class preferred to itself is a cycle and raises."""
    c = classes.select(*GROUP, "cls", "lv").distinct()
    member = cut_lineage(c.select(*GROUP, "cls", F.explode("lv").alias("x"))
                         .select(*GROUP, "cls", F.col("x.jsg").alias("s"), F.col("x.lvl").alias("l")))
    nodes = member.select(*GROUP, "s", "l").distinct()
    subgroups = nodes.select(*GROUP, F.col("s").alias("t")).distinct()
    reach = cut_lineage(nodes.join(subgroups, GROUP).select(
        *GROUP, "s", "l", "t", F.when(F.col("s") == F.col("t"), F.col("l")).alias("m")))
    several = subgroups.groupBy(*GROUP).count().where("count > 1")
    rising = reach.join(several, GROUP, "left_semi")
    below = Window.partitionBy(*GROUP, "s", "t").orderBy("l").rowsBetween(Window.unboundedPreceding, -1)
    of_class = lambda r: member.join(r.where("m IS NOT NULL"), [*GROUP, "s", "l"]) \
        .groupBy(*GROUP, "cls", "t").agg(F.max("m").alias("m"))
    while not rising.isEmpty():
        under = member.join(of_class(reach), [*GROUP, "cls"]).groupBy(*GROUP, "s", "l", "t").agg(F.max("m").alias("w"))
        after = reach.join(under, [*GROUP, "s", "l", "t"], "left").withColumn("w", F.max("w").over(below))
        after = cut_lineage(after.select(
            *GROUP, "s", "l", "t", F.greatest("m", "w").alias("m"),
            (F.col("w").isNotNull() & (F.col("m").isNull() | (F.col("w") > F.col("m")))).alias("rose")))
        reach, rising = after.drop("rose"), after.where("rose")
    hi = of_class(reach).select(*GROUP, F.col("cls").alias("hi"), F.col("t").alias("s"), "m")
    lo = member.select(*GROUP, F.col("cls").alias("lo"), "s", "l")
    relation = cut_lineage(hi.join(lo, [*GROUP, "s"]).where("l < m").select(*GROUP, "hi", "lo").distinct())
    cycle = relation.where("hi = lo").join(classes.withColumnRenamed("cls", "hi"), [*GROUP, "hi"]) \
        .agg(F.min(F.struct(*GROUP, "docno")).alias("r")).first()["r"]
    if cycle is not None:
        raise ValueError(f"preference cycle in topic {cycle['qid']} group {cycle['jg']} at {cycle['docno']}")
    return relation


def closure_pairs(classes: DataFrame, relation: DataFrame) -> DataFrame:
    """P2's output: (qid, jg, hi, lo) between documents."""
    d = classes.select(*GROUP, "docno", "cls")
    return (relation.withColumnRenamed("hi", "cls").join(d.withColumnRenamed("docno", "hi"), [*GROUP, "cls"]).drop("cls")
            .withColumnRenamed("lo", "cls").join(d.withColumnRenamed("docno", "lo"), [*GROUP, "cls"]).drop("cls")
            .select(*GROUP, "hi", "lo"))


def preference_pairs(prefs: DataFrame, shape: DataFrame | None = None) -> DataFrame:
    """The preference relation (qid, jg, hi, lo, multi) between documents:
    single-subgroup groups directly, the others transitively closed."""
    shape = shape if shape is not None else group_shape(prefs)
    single = direct_pairs(prefs.join(shape.where("n_jsg = 1"), GROUP, "left_semi"))
    classes = keep(doc_classes(prefs.join(shape.where("n_jsg > 1"), GROUP, "left_semi")))
    multi = closure_pairs(classes, class_relation(classes))
    return (single.withColumn("multi", F.lit(False))
            .unionByName(multi.withColumn("multi", F.lit(True))))


# ------------------------------------------------------------------ P4
def judged_positions(runs: DataFrame, prefs: DataFrame, cfg: EvalConfig,
                     scan: bool = False) -> DataFrame:
    """(run_id, qid, docno, pos, ret, njr, nj) for every judged document of
    every evaluated (run, topic).  `scan`: positions by distributed prefix
    scans instead of per-topic windows (oversized topics)."""
    order = [F.col("sim").cast("float").desc(), F.col("docno").asc()]
    base = runs.select("run_id", "qid", "docno", F.col("sim").cast("float"))
    if scan:
        from .prefix import prefix_sums
        ranked = prefix_sums(base.withColumn("_one", F.lit(1)), ["run_id", "qid"], order,
                             {"rank": "_one"}, scan).drop("_one")
    else:
        w = Window.partitionBy("run_id", "qid").orderBy(*order)
        ranked = base.withColumn("rank", F.row_number().over(w))
    if cfg.cut is not None:
        ranked = ranked.where(F.col("rank") <= cfg.cut)
    docs = prefs.select("qid", "docno").distinct()
    topics = ranked.select("run_id", "qid").distinct().join(
        docs.select("qid").distinct(), "qid", "left_semi")
    grid = topics.join(docs, "qid")
    j = grid.join(ranked.select("run_id", "qid", "docno", "rank"),
                  ["run_id", "qid", "docno"], "left")
    if scan:
        from .prefix import prefix_sums
        tot = j.groupBy("run_id", "qid").agg(F.count("rank").alias("njr"),
                                             F.count(F.lit(1)).alias("nj"))
        p = prefix_sums(j.withColumn("_one", F.lit(1)), ["run_id", "qid"],
                        [F.col("rank").asc_nulls_last(), F.col("docno").asc()], {"_p": "_one"}, scan)
        return p.join(tot, ["run_id", "qid"]).select(
            "run_id", "qid", "docno", (F.col("_p") - 1).cast("int").alias("pos"),
            F.col("rank").isNotNull().alias("ret"), "njr", "nj")
    pw = Window.partitionBy("run_id", "qid").orderBy(
        F.col("rank").asc_nulls_last(), F.col("docno"))
    tw = Window.partitionBy("run_id", "qid")
    return j.select(
        "run_id", "qid", "docno",
        (F.row_number().over(pw) - 1).alias("pos"),
        F.col("rank").isNotNull().alias("ret"),
        F.count(F.col("rank")).over(tw).alias("njr"),
        F.count(F.lit(1)).over(tw).alias("nj"))


# ------------------------------------------------------------------ P5/P6
def pair_positions(pairs: DataFrame, pos: DataFrame) -> DataFrame:
    """Pairs with both documents' positions, per evaluated run."""
    ph = pos.select("run_id", "qid", F.col("docno").alias("hi"), F.col("pos").alias("ph"), "njr", "nj")
    pl = pos.select("run_id", "qid", F.col("docno").alias("lo"), F.col("pos").alias("pl"))
    return pairs.join(ph, ["qid", "hi"]).join(pl, ["run_id", "qid", "lo"])


def doc_levels(prefs: DataFrame, shape: DataFrame) -> DataFrame:
    """One level per (qid, jg, docno): relevant (>0) / nonrelevant (0) class."""
    return (prefs.groupBy("qid", "jg", "docno")
            .agg(F.max("rel_level").alias("lvl"))
            .join(shape, ["qid", "jg"]))


# ------------------------------------------------------------------ P6 linear
def inversions(rows: DataFrame, keys: list[str], level: str, pos: str, scan: bool = False) -> DataFrame:
    """(keys, level, above) summing up, over all rows of a level, the rows of higher
    levels placed before them: add up `above` per group for the group's inversions.

    Levels are ranked from 0.  Two ranks differ first at some bit, before which they
    are the same; so for each bit the rows that agree before it are taken in order
    of position, and those without the bit count the ones with it placed before.
    Each pair of rows is met at one bit only, and a row is repeated once per bit of
    the group's highest rank: documents x log2(levels), all-distinct levels
    included."""
    by_level = Window.partitionBy(*keys).orderBy(level)
    ranks = rows.groupBy(*keys, level).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_r", F.row_number().over(by_level) - 1) \
        .withColumn("_bits", F.ceil(F.log2(F.max("_r").over(Window.partitionBy(*keys)) + 1)).cast("int")).drop("_n")
    bit = F.expr("if(_bits > 0, sequence(0, _bits - 1), array())")
    x = rows.select(*keys, level, pos).join(ranks, [*keys, level]) \
        .select(*keys, level, pos, "_r", F.explode(bit).alias("_bit"))
    x = x.withColumn("_head", F.expr("shiftright(_r, _bit + 1)")) \
        .withColumn("_one", F.expr("shiftright(_r, _bit) & 1"))
    part = [*keys, "_bit", "_head"]
    if scan:
        from .prefix import prefix_sums
        x = prefix_sums(x.withColumn("_m", F.col("_one")), part, [F.col(pos).asc()], {"above": "_m"}, scan)
    else:
        w = Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumn("above", F.sum("_one").over(w))
    return x.where("_one = 0").groupBy(*keys, level).agg(F.sum("above").alias("above"))


def single_group_docs(levels: DataFrame, pos: DataFrame) -> DataFrame:
    """Documents of single-subgroup groups with their position per run."""
    return (levels.where("n_jsg = 1")
            .join(pos.select("run_id", "qid", "docno", "pos", "ret", "njr"), ["qid", "docno"]))


def single_group_counts(docs: DataFrame, scan: bool = False) -> DataFrame:
    """P6 for single-subgroup groups without emitting document pairs.

    Every document is preferred to every document of a lower level, so the
    implied / neither counts are products of per-level counts, and the
    fulfilled-retrieved count is, for each retrieved document, the number of
    retrieved documents of a higher level placed before it (`inversions`).
    Also returns the relevant-only parts the Rnonrel recounts need."""
    keys = ["run_id", "qid", "jg"]
    lc = docs.groupBy(*keys, "lvl").agg(
        F.sum(F.when(F.col("ret"), 1).otherwise(0)).alias("nr"),
        F.sum(F.when(F.col("ret"), 0).otherwise(1)).alias("nu"))
    hw = Window.partitionBy(*keys).orderBy(F.col("lvl").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    lc = lc.withColumn("hr", F.coalesce(F.sum("nr").over(hw), F.lit(0))) \
           .withColumn("hu", F.coalesce(F.sum("nu").over(hw), F.lit(0)))
    relv = F.col("lvl") > 0
    prod = lc.groupBy(*keys).agg(
        F.sum(F.col("nu") * F.col("hr")).alias("ful_imp"),
        F.sum(F.col("nr") * F.col("hu")).alias("nf_imp"),
        F.sum(F.col("nu") * F.col("hu")).alias("notoccur"),
        F.sum(F.col("nr") * F.col("hr")).alias("poss_ret"),
        F.sum(F.when(relv, (F.col("nr") + F.col("nu")) * (F.col("hr") + F.col("hu"))).otherwise(0)).alias("a_poss"),
        F.sum(F.when(relv, F.col("nr") * F.col("hr")).otherwise(0)).alias("ar_poss"),
        F.sum(F.when(relv, F.col("nu") * F.col("hr")).otherwise(0)).alias("a_imp"))
    ret = docs.where("ret").select(*keys, "docno", "lvl", "pos")
    above = inversions(ret, keys, "lvl", "pos", scan)
    fr = above.groupBy(*keys).agg(
        F.sum("above").alias("ful_ret"),
        F.sum(F.when(F.col("lvl") > 0, F.col("above")).otherwise(0)).alias("ful_ret_rel"))
    out = prod.join(fr, keys, "left").fillna(0, subset=["ful_ret", "ful_ret_rel"])
    return out.select(*keys, "ful_ret", "poss_ret", "ful_imp",
                      (F.col("ful_imp") + F.col("nf_imp")).alias("poss_imp"), "notoccur",
                      "a_poss", "ar_poss", "a_imp", "ful_ret_rel")


def doc_class_counts(levels: DataFrame, pos: DataFrame) -> DataFrame:
    """rel, rel_ret, nonrel, nonrel_ret per (run_id, qid, jg)."""
    lv = levels.join(pos.select("run_id", "qid", "docno", "ret"), ["qid", "docno"])
    rel = F.col("lvl") > 0
    nonrel = F.when(F.col("n_jsg") > 1, F.col("lvl") == 0).otherwise(F.col("lvl") <= 0)
    return lv.groupBy("run_id", "qid", "jg").agg(
        F.sum(F.when(rel, 1).otherwise(0)).alias("rel"),
        F.sum(F.when(rel & F.col("ret"), 1).otherwise(0)).alias("rel_ret"),
        F.sum(F.when(nonrel, 1).otherwise(0)).alias("nonrel"),
        F.sum(F.when(nonrel & F.col("ret"), 1).otherwise(0)).alias("nonrel_ret"))


PAIR_COUNTS = ["ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur"]


def class_docs(classes: DataFrame, pos: DataFrame) -> DataFrame:
    """(run_id, qid, jg, docno, cls, pos, ret): documents with class and position."""
    return classes.select(*GROUP, "docno", "cls").join(
        pos.select("run_id", "qid", "docno", "pos", "ret"), ["qid", "docno"])


def placed_before(docs: DataFrame, relation: DataFrame, keys: list[str], on: list[str],
                  kept: list[str], scan: bool = False) -> DataFrame:
    """For each retrieved document and each class `hi` related to its own: how many
    retrieved documents of `hi` stand before it.  `docs`: keys, cls, pos, ret and
    the flags `kept` (1 or 0); `relation`: `on`, hi, lo and more.  Returns keys, hi, lo,
    the relation's columns, and `n_<flag>` for every flag: the count among documents
    that have it, 0 where the document itself lacks it.

    Documents are rows of their class; a document looks into the classes above its
    own at its position: rows grow as documents x classes, never as pairs."""
    ret = docs.where("ret")
    more = [c for c in relation.columns if c not in (*on, "hi", "lo")]
    own = ret.select(*keys, F.col("cls").alias("hi"), "pos", F.lit(None).cast("string").alias("lo"),
                     *[F.lit(None).cast(dict(relation.dtypes)[c]).alias(c) for c in more],
                     *[F.col(k).alias(f"_m_{k}") for k in kept], *[F.lit(0).alias(f"_t_{k}") for k in kept])
    look = ret.withColumnRenamed("cls", "lo").join(relation, [*on, "lo"]).select(
        *keys, "hi", "pos", "lo", *more, *[F.lit(0).alias(f"_m_{k}") for k in kept], *[F.col(k).alias(f"_t_{k}") for k in kept])
    both = own.unionByName(look)
    part = [*keys, "hi"]
    if scan:
        from .prefix import prefix_sums
        both = prefix_sums(both, part, [F.col("pos").asc()], {f"n_{k}": f"_m_{k}" for k in kept}, scan)
    else:
        w = Window.partitionBy(*part).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        both = both.select("*", *[F.sum(f"_m_{k}").over(w).alias(f"n_{k}") for k in kept])
    return both.where("lo IS NOT NULL").select(*keys, "hi", "lo", *more, *[(F.col(f"n_{k}") * F.col(f"_t_{k}")).alias(f"n_{k}") for k in kept])


def relation_counts(docs: DataFrame, relation: DataFrame, kept: list[str], scan: bool = False) -> DataFrame:
    """P6 of groups with several subgroups: per (run_id, qid, jg) and flag f of
    `kept`, over pairs of documents that have the flag: ful_ret_f, poss_ret_f,
    ful_imp_f, poss_imp_f, notoccur_f."""
    keys = ["run_id", *GROUP]
    n = docs.groupBy(*keys, "cls").agg(
        *[F.sum(F.when(F.col("ret"), F.col(k)).otherwise(0)).alias(f"r_{k}") for k in kept],
        *[F.sum(F.when(F.col("ret"), 0).otherwise(F.col(k))).alias(f"u_{k}") for k in kept])
    side = lambda name: n.select(
        *keys, F.col("cls").alias(name), *[F.col(f"{x}_{k}").alias(f"{name}_{x}_{k}") for x in "ru" for k in kept])
    cells = side("hi").join(relation, [*GROUP, "hi"]).join(side("lo"), [*keys, "lo"])
    times = lambda a, b, k: F.col(f"hi_{a}_{k}") * F.col(f"lo_{b}_{k}")
    sums = cells.groupBy(*keys).agg(*[c for k in kept for c in (
        F.sum(times("r", "r", k)).alias(f"poss_ret_{k}"), F.sum(times("r", "u", k)).alias(f"ful_imp_{k}"),
        F.sum(times("r", "u", k) + times("u", "r", k)).alias(f"poss_imp_{k}"),
        F.sum(times("u", "u", k)).alias(f"notoccur_{k}"))])
    first = placed_before(docs, relation, keys, GROUP, kept, scan).groupBy(*keys).agg(
        *[F.sum(f"n_{k}").alias(f"ful_ret_{k}") for k in kept])
    return sums.join(first, keys, "left").fillna(0)


def all_group_counts(levels: DataFrame, pos: DataFrame, multi: DataFrame | None = None,
                     relation: DataFrame | None = None, single: bool = True, scan: bool = False,
                     marked: DataFrame | None = None):
    """P6 for every group: per-level counts for single-subgroup groups (if there are
    any: `single`), per-class counts for the others (`multi`: their documents as
    `class_docs`, `relation`: as `class_relation`).  Returns (counts, single_parts,
    multi_parts); with `marked` (`rnonrel_docs`) the multi parts hold the counts
    among the documents that the Rnonrel recounts keep as well, from the same pass."""
    keys = ["run_id", "qid", "jg"]
    parts, sc, rc = [], None, None
    if single:
        sc = cut_lineage(single_group_counts(cut_lineage(single_group_docs(levels, pos)), scan))
        parts.append(sc.select(*keys, *PAIR_COUNTS))
    if multi is not None:
        docs, flags = multi.withColumn("all", F.lit(1)), ["all"]
        if marked is not None:
            docs = docs.join(marked.select(*keys, "docno", F.col("keep_all").cast("int").alias("of_all"),
                                           F.col("keep_ret").cast("int").alias("of_ret")), [*keys, "docno"])
            flags += ["of_all", "of_ret"]
        rc = cut_lineage(relation_counts(cut_lineage(docs), relation, flags, scan))
        parts.append(rc.select(*keys, *[F.col(f"{x}_all").alias(x) for x in PAIR_COUNTS]))
    c = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    counts = cut_lineage(doc_class_counts(levels, pos).join(c, keys, "left").fillna(0, subset=PAIR_COUNTS))
    return counts, sc, rc


# ------------------------------------------------------------------ P14/P18
def rnonrel_docs(levels: DataFrame, pos: DataFrame, scan: bool = False) -> DataFrame:
    """Documents of every group with level and position, and whether the recounts
    keep them: `keep_all`, the first R nonrelevant documents (by position), and
    `keep_ret` for the variant over retrieved documents."""
    lv = levels.join(pos.select("run_id", "qid", "docno", "pos", "ret", "njr"), ["qid", "docno"])
    lv = lv.join(doc_class_counts(levels, pos).select("run_id", "qid", "jg", "rel", "rel_ret"), ["run_id", "qid", "jg"])
    is_non = F.when(F.col("n_jsg") > 1, F.col("lvl") == 0).otherwise(F.col("lvl") <= 0)
    lv = lv.withColumn("is_non", is_non)
    if scan:
        from .prefix import prefix_sums
        lv = prefix_sums(lv.withColumn("_one", F.lit(1)), ["run_id", "qid", "jg", "is_non"],
                         [F.col("pos").asc()], {"_ni": "_one"}, scan)
        lv = lv.withColumn("non_idx", F.when(F.col("is_non"), F.col("_ni"))).drop("_one", "_ni")
    else:
        nw = Window.partitionBy("run_id", "qid", "jg", "is_non").orderBy("pos")
        lv = lv.withColumn("non_idx", F.when(F.col("is_non"), F.row_number().over(nw)))
    # kept nonrelevant documents: the first R (all docs) / first R (retrieved
    # variant; multi-subgroup groups use total R, single-subgroup R_ret)
    keep_all = ~F.col("is_non") | (F.col("non_idx") <= F.col("rel"))
    keep_ret = ~F.col("is_non") | F.when(F.col("n_jsg") > 1, F.col("non_idx") <= F.col("rel")) \
        .otherwise(F.col("non_idx") <= F.col("rel_ret"))
    return cut_lineage(lv.withColumn("keep_all", keep_all).withColumn("keep_ret", keep_ret))


def rnonrel_counts(marked: DataFrame, single_parts: DataFrame | None, multi_parts: DataFrame | None,
                   scan: bool = False) -> DataFrame:
    """Recounts for groups with fewer relevant than nonrelevant documents, over the
    documents that `rnonrel_docs` keeps.

    Columns: run_id, qid, jg, rn_ful, rn_poss (all documents) and rr_ful, rr_poss
    (retrieved documents only)."""
    out = []
    if multi_parts is not None:
        out.append(multi_parts.select(
            "run_id", "qid", "jg", (F.col("ful_ret_of_all") + F.col("ful_imp_of_all")).alias("rn_ful"),
            (F.col("poss_ret_of_all") + F.col("poss_imp_of_all") + F.col("notoccur_of_all")).alias("rn_poss"),
            F.col("ful_ret_of_ret").alias("rr_ful"), F.col("poss_ret_of_ret").alias("rr_poss")))
    if single_parts is not None:
        out.append(_rnonrel_single(marked.where("n_jsg = 1"), single_parts, scan))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def _rnonrel_single(s: DataFrame, single_parts: DataFrame, scan: bool) -> DataFrame:
    """Recounts of single-subgroup groups: relevant x relevant pairs of different
    levels (from the linear counts), plus every document against each kept
    nonrelevant document (the document itself included), as the evaluator counts
    them."""
    rel_rel = single_parts.select(
        "run_id", "qid", "jg",
        (F.col("ful_ret_rel") + F.col("a_imp")).alias("a_ful"), "a_poss",
        F.col("ful_ret_rel").alias("ar_ful"), "ar_poss")
    # every doc d1 against kept nonrel docs d2: fulfilled when pos1 < pos2
    # (and d1 retrieved for the all-documents variant); counted with a
    # running count of kept nonrelevant docs after each position.
    kn_all = F.col("is_non") & F.col("keep_all")
    kn_ret = F.col("is_non") & F.col("keep_ret") & F.col("ret")
    gk = ["run_id", "qid", "jg"]
    if scan:
        from .prefix import prefix_sums
        fl = s.select(*gk, "pos", "ret", F.when(kn_all, 1).otherwise(0).alias("_ka"),
                      F.when(kn_ret, 1).otherwise(0).alias("_kr"))
        tot = fl.groupBy(*gk).agg(F.sum("_ka").alias("kall_tot"), F.sum("_kr").alias("kret_tot"))
        fl = prefix_sums(fl, gk, [F.col("pos").asc()], {"_ka_le": "_ka", "_kr_le": "_kr"}, scan)
        s2 = fl.join(tot, gk).select(
            *gk, "pos", "ret",
            (F.col("kall_tot") - F.col("_ka_le")).alias("kall_after"),
            (F.col("kret_tot") - F.col("_kr_le")).alias("kret_after"), "kall_tot", "kret_tot")
    else:
        gw = Window.partitionBy(*gk)
        after = gw.orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
        s2 = s.select(
            *gk, "pos", "ret",
            F.coalesce(F.sum(F.when(kn_all, 1).otherwise(0)).over(after), F.lit(0)).alias("kall_after"),
            F.coalesce(F.sum(F.when(kn_ret, 1).otherwise(0)).over(after), F.lit(0)).alias("kret_after"),
            F.sum(F.when(kn_all, 1).otherwise(0)).over(gw).alias("kall_tot"),
            F.sum(F.when(kn_ret, 1).otherwise(0)).over(gw).alias("kret_tot"))
    vs_non = s2.groupBy("run_id", "qid", "jg").agg(
        F.sum(F.when(F.col("ret"), F.col("kall_after")).otherwise(0)).alias("b_ful"),
        F.sum("kall_tot").alias("b_poss"),
        F.sum(F.when(F.col("ret"), F.col("kret_after")).otherwise(0)).alias("br_ful"),
        F.sum(F.when(F.col("ret"), F.col("kret_tot")).otherwise(0)).alias("br_poss"))
    single = vs_non.join(rel_rel, ["run_id", "qid", "jg"], "left").fillna(0).select(
        "run_id", "qid", "jg",
        (F.col("a_ful") + F.col("b_ful")).alias("rn_ful"),
        (F.col("a_poss") + F.col("b_poss")).alias("rn_poss"),
        (F.col("ar_ful") + F.col("br_ful")).alias("rr_ful"),
        (F.col("ar_poss") + F.col("br_poss")).alias("rr_poss"))
    return single


# ------------------------------------------------------------------ P7
def pair_counts(pp: DataFrame) -> DataFrame:
    """P7 per (run_id, qid, unordered pair): groups preferring the document
    placed first (c_up) and the one placed second (c_down), and the area."""
    up = F.least("ph", "pl")
    down = F.greatest("ph", "pl")
    return pp.groupBy("run_id", "qid", up.alias("pu"), down.alias("pd"), "njr").agg(
        F.sum(F.when(F.col("ph") < F.col("pl"), 1).otherwise(0)).alias("c_up"),
        F.sum(F.when(F.col("ph") > F.col("pl"), 1).otherwise(0)).alias("c_down"))


def topic_classes(classes: DataFrame) -> DataFrame:
    """(qid, docno, cls, parts): documents of a topic that have the same class in each
    of its groups; `parts`: array of (jg, cls)."""
    parts = F.sort_array(F.collect_list(F.struct("jg", "cls")))
    return classes.groupBy("qid", "docno").agg(parts.alias("parts")).select(
        "qid", "docno", F.md5(F.to_json("parts").cast("binary")).alias("cls"), "parts")


def topic_relation(topic: DataFrame, relation: DataFrame) -> DataFrame:
    """(qid, hi, lo, share): for every two topic-wide classes that some group prefers
    one of, in both orders, the share of these groups that prefer `hi`."""
    member = topic.select("qid", "cls", "parts").distinct().select("qid", "cls", F.inline(
        F.transform("parts", lambda p: F.struct(p["jg"].alias("jg"), p["cls"].alias("part")))))
    hi = member.select("qid", "jg", F.col("part").alias("hi"), F.col("cls").alias("top"))
    lo = member.select("qid", "jg", F.col("part").alias("lo"), F.col("cls").alias("low"))
    votes = relation.join(hi, [*GROUP, "hi"]).join(lo, [*GROUP, "lo"]) \
        .groupBy("qid", "top", "low").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    both = votes.select("qid", F.col("top").alias("hi"), F.col("low").alias("lo"), F.col("n").alias("a"), zero.alias("b")) \
        .unionByName(votes.select("qid", F.col("low").alias("hi"), F.col("top").alias("lo"), zero.alias("a"), F.col("n").alias("b")))
    return both.groupBy("qid", "hi", "lo").agg((F.sum("a") / (F.sum("a") + F.sum("b"))).alias("share"))


def pair_scores(topic: DataFrame, relation: DataFrame, pos: DataFrame, scan: bool = False) -> DataFrame:
    """P12/P16/P20 parts per (run_id, qid), summed over pairs of topic-wide classes:
    the share of groups that agree with the order of a pair, and the number of
    pairs, both retrieved / one retrieved / none."""
    keys = ["run_id", "qid"]
    docs = topic.select("qid", "docno", "cls").join(pos.select(*keys, "docno", "pos", "ret"), ["qid", "docno"]) \
        .withColumn("all", F.lit(1))
    n = docs.groupBy(*keys, "cls").agg(F.sum(F.when(F.col("ret"), 1).otherwise(0)).alias("r"),
                                       F.sum(F.when(F.col("ret"), 0).otherwise(1)).alias("u"))
    side = lambda name: n.select(*keys, F.col("cls").alias(name), F.col("r").alias(f"{name}_r"), F.col("u").alias(f"{name}_u"))
    cells = side("hi").join(relation, ["qid", "hi"]).join(side("lo"), [*keys, "lo"])
    ri = F.col("hi_r") * F.col("lo_u")
    sums = cells.groupBy(*keys).agg(
        F.sum(ri * F.col("share")).alias("s_ri"), F.sum(ri).alias("n_ri"),
        # a pair of classes is met in both orders
        (F.sum(F.col("hi_u") * F.col("lo_u")) / 2).cast("long").alias("n_uu"))
    first = placed_before(docs, relation, keys, ["qid"], ["all"], scan).groupBy(*keys).agg(
        F.sum(F.col("n_all") * F.col("share")).alias("s_rr"), F.sum("n_all").alias("n_rr"))
    return sums.join(first, keys, "left").fillna(0).select(*keys, "s_rr", "n_rr", "s_ri", "n_ri", "n_uu")


# ------------------------------------------------------------------ measures
def _avg_jg(ful: str, poss: str) -> str:
    return f"sum(CASE WHEN ({poss}) <> 0 THEN CAST(({ful}) AS DOUBLE) / ({poss}) ELSE 0D END)"


def topic_values(counts: DataFrame, rn: DataFrame | None, ps: DataFrame) -> DataFrame:
    """Wide per-topic values of P8-P21 over the per-group counts; without `rn`
    the values of the Rnonrel measures are not meaningful."""
    parts = ["rn_ful", "rn_poss", "rr_ful", "rr_poss"]
    if rn is None:
        c = counts.withColumns({p: F.lit(0).cast("long") for p in parts})
    else:
        c = counts.join(rn, ["run_id", "qid", "jg"], "left").fillna(0, subset=parts)
    R, N = "rel", "nonrel"
    Rr, Nr = "rel_ret", "nonrel_ret"
    rn_ful = (f"CASE WHEN {R} >= {N} THEN ful_ret + ful_imp + rel_ret * ({R} - {N}) ELSE rn_ful END")
    rn_poss = (f"CASE WHEN {R} >= {N} THEN poss_ret + poss_imp + notoccur + rel * ({R} - {N}) "
               f"ELSE rn_poss END")
    rr_ful = f"CASE WHEN {Rr} >= {Nr} THEN ful_ret + rel_ret * ({Rr} - {Nr}) ELSE rr_ful END"
    rr_poss = f"CASE WHEN {Rr} >= {Nr} THEN poss_ret + rel * ({Rr} - {Nr}) ELSE rr_poss END"
    g = c.groupBy("run_id", "qid").agg(
        F.count(F.lit(1)).alias("num_jgs"),
        F.sum("ful_ret").alias("s_ful_ret"), F.sum("ful_imp").alias("s_ful_imp"),
        F.sum("poss_ret").alias("s_poss_ret"), F.sum("poss_imp").alias("s_poss_imp"),
        F.sum("notoccur").alias("s_notoccur"),
        F.expr(_avg_jg("ful_ret + ful_imp", "poss_ret + poss_imp + notoccur")).alias("aj"),
        F.expr(_avg_jg("ful_ret", "poss_ret")).alias("aj_ret"),
        F.expr(_avg_jg("ful_ret + ful_imp", "poss_ret + poss_imp")).alias("aj_imp"),
        # 0/0 in any group makes the evaluator's sum NaN -> topic scores 0
        F.max(F.expr(f"CASE WHEN ({rn_poss}) = 0 THEN 1 ELSE 0 END")).alias("rn_nan"),
        F.sum(F.expr(f"CASE WHEN ({rn_poss}) <> 0 THEN CAST({rn_ful} AS DOUBLE) / ({rn_poss}) ELSE 0D END")).alias("rn"),
        F.max(F.expr(f"CASE WHEN ({rr_poss}) = 0 THEN 1 ELSE 0 END")).alias("rr_nan"),
        F.sum(F.expr(f"CASE WHEN ({rr_poss}) <> 0 THEN CAST({rr_ful} AS DOUBLE) / ({rr_poss}) ELSE 0D END")).alias("rr"),
    )
    g = g.join(ps, ["run_id", "qid"], "left").fillna(0)
    ful = "(s_ful_ret + s_ful_imp)"
    poss = "(s_poss_ret + s_poss_imp + s_notoccur)"

    def avgjg(s, nan=None):
        cond = f"{s} > 0" + (f" AND {nan} = 0" if nan else "")
        return f"CASE WHEN {cond} THEN {s} / num_jgs ELSE 0D END"

    exprs = {
        "prefs_num_prefs_poss": f"CAST({poss} AS DOUBLE)",
        "prefs_num_prefs_ful": f"CAST({ful} AS DOUBLE)",
        "prefs_num_prefs_ful_ret": "CAST(s_ful_ret AS DOUBLE)",
        "prefs_simp": div0(ful, poss),
        "prefs_pair": div0("s_rr + s_ri", "n_rr + n_ri + n_uu"),
        "prefs_avgjg": avgjg("aj"),
        "prefs_avgjg_Rnonrel": avgjg("rn", "rn_nan"),
        "prefs_simp_ret": div0("s_ful_ret", "s_poss_ret"),
        "prefs_pair_ret": div0("s_rr", "n_rr"),
        "prefs_avgjg_ret": avgjg("aj_ret"),
        "prefs_avgjg_Rnonrel_ret": avgjg("rr", "rr_nan"),
        "prefs_simp_imp": div0(ful, "s_poss_ret + s_poss_imp"),
        "prefs_pair_imp": div0("s_rr + s_ri", "n_rr + n_ri"),
        "prefs_avgjg_imp": avgjg("aj_imp"),
    }
    return g.select("run_id", "qid", *[F.expr(e).alias(n) for n, e in exprs.items()])


def evaluate_prefs(runs: DataFrame, prefs: DataFrame, measures="all_prefs",
                   config: EvalConfig | None = None):
    """Evaluate runs against preferences (qid, jg, jsg, docno, rel_level)."""
    from ..operators import measures as M
    from ..operators.summary import to_long
    from ..plans.evaluate import Evaluation

    cfg = config or EvalConfig()
    selected = M.resolve(measures)
    unknown = [n for n, _ in selected if n not in PREF_MEASURES and n not in ("runid", "num_q")]
    if unknown:
        raise KeyError(f"{unknown[0]} is not a preference measure")
    names = [n for n, _ in selected if n in PREF_MEASURES]
    if cfg.topic is not None:
        runs = runs.where(F.col("qid") == cfg.topic)
        prefs = prefs.where(F.col("qid") == cfg.topic)
    # the tables that several steps read are cut from their lineage: each is small
    # beside the judgements, and plans stay short
    prefs = cut_lineage(prefs.select("qid", "jg", "jsg", "docno", F.col("rel_level").cast("float")))
    shape = cut_lineage(group_shape(prefs))
    scan = cfg.skew_safe
    pos = cut_lineage(judged_positions(runs, prefs, cfg, scan))
    # only topics with both results and preferences are looked at
    prefs = cut_lineage(prefs.join(pos.select("qid").distinct(), "qid", "left_semi"))
    if cfg.strict:
        raise_if_inconsistent(prefs)
    levels = cut_lineage(doc_levels(prefs, shape))

    # the relation between classes, where products of level counts do not do: groups
    # with several subgroups, and for prefs_pair* all groups of topics that have several
    groups_of = Window.partitionBy("qid")
    groups = cut_lineage(shape.withColumn("n_groups", F.count(F.lit(1)).over(groups_of)))
    pairs = any(n.startswith("prefs_pair") for n in names)
    kinds = groups.agg(F.max(F.expr("n_jsg > 1")).alias("multi"), F.max(F.expr("n_jsg = 1")).alias("single"),
                       F.max(F.expr("n_groups > 1")).alias("many")).first()
    related = groups.where("n_jsg > 1 OR n_groups > 1" if pairs else "n_jsg > 1")
    classes = relation = multi = None
    if kinds["multi"] or (pairs and kinds["many"]):
        classes = cut_lineage(doc_classes(prefs.join(related, GROUP, "left_semi")))
        relation = class_relation(classes)
    if kinds["multi"]:
        multi = cut_lineage(class_docs(classes.join(groups.where("n_jsg > 1"), GROUP, "left_semi"), pos))
    rn = marked = None
    if any("Rnonrel" in n for n in names):   # recounted only when asked for
        marked = rnonrel_docs(levels, pos, scan)
    counts, single_parts, multi_parts = all_group_counts(
        levels, pos, multi, relation, single=kinds["single"] or not kinds["multi"], scan=scan, marked=marked)
    if marked is not None:
        rn = cut_lineage(rnonrel_counts(marked, single_parts, multi_parts, scan))

    # with one group a pair's ratio is 1 or 0, so the sums are counts
    one = counts.join(groups.where("n_groups = 1").select("qid").distinct(), "qid", "left_semi").select(
        "run_id", "qid", F.col("ful_ret").cast("double").alias("s_rr"), F.col("poss_ret").alias("n_rr"),
        F.col("ful_imp").cast("double").alias("s_ri"), F.col("poss_imp").alias("n_ri"),
        F.col("notoccur").alias("n_uu"))
    ps = one
    if pairs and kinds["many"]:
        several = groups.where("n_groups > 1").select("qid").distinct()
        topic = cut_lineage(topic_classes(classes.join(several, "qid", "left_semi")))
        ps = cut_lineage(ps.unionByName(pair_scores(topic, cut_lineage(topic_relation(topic, relation)), pos, scan)))
    wide = cut_lineage(topic_values(counts, rn, ps))
    outs = [(n, n, "sum" if n in COUNT_MEASURES else "mean", (M.MEASURE_ORDER.index(n),))
            for n in names]
    per_topic = to_long(wide, ["run_id", "qid"], outs)
    topics_per_run = wide.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_orig"))
    if cfg.complete:
        n = prefs.select("qid").distinct().count()
        num_q = topics_per_run.withColumn("n", F.lit(n).cast("long"))
    else:
        num_q = topics_per_run.withColumn("n", F.col("n_orig"))
    return Evaluation(per_topic, None, num_q, selected, cached=[])
