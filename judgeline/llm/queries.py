"""Registered queries of this subpackage and, where SQL can say the same, their
DuckDB oracles.  Each query applies its operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from judgeline.llm import (
    best_fit_packing, divergence_audit, embedding_dedup, fill_in_middle, language_id,
    license_scan, lm_scoring, minhash_dedup, mixing, quality_rules, sentencepiece_codec,
    sharding, url_filter)
from judgeline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.fixed_rules(spark),
                                 url_filter.fixed_unwanted(spark))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("failed_rules")


def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("matches")


def op9_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(table(spark, sf_dir, "documents"), keep_ids=False)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.audit(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def all_queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_minhash_dedup": op2_minhash_dedup,
        "op3_url_filter": op3_url_filter,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_quality_rules": op6_quality_rules,
        "op7_jump_shards": op7_jump_shards,
        "op8_license_scan": op8_license_scan,
        "op9_sentencepiece_dropout": op9_sentencepiece_dropout,
        "op10_language_id": op10_language_id,
        "op11_best_fit_packing": op11_best_fit_packing,
        "op12_source_divergence": op12_source_divergence,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


_KEY = "('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT"
_WORDS = r"len(regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+'))"

OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source AS src, CAST({_WORDS.format(text='text')} AS BIGINT) AS size,
         {_KEY.format(seed='mix')} AS key
  FROM documents),
s AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY src),
f AS (
  SELECT *, CAST(source_size AS DOUBLE) * 2 AS cap,
         sum(CAST(source_size AS DOUBLE)) OVER () * 1.5 AS budget,
         coalesce(sum(CAST(source_size AS DOUBLE) * 2) OVER (ORDER BY source_size * 2 / w, src NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY source_size * 2 / w, src NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM s),
g AS (SELECT *, cap * open_w <= (budget - before) * w AS is_full FROM f),
t AS (
  SELECT src, source_size,
         CASE WHEN is_full THEN cap ELSE
           (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) * w
           / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () END AS target
  FROM g),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
         coalesce(sum(d.size) OVER (PARTITION BY d.src ORDER BY d.key, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.src IS NOT DISTINCT FROM t.src),
e AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, words - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""


OP3_SQL = """
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM r),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
  FROM (SELECT DISTINCT host, path FROM h) u
  JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path)
SELECT h.page_id, h.host, h.path, best.rule,
       coalesce(best.v, CASE WHEN regexp_matches(h.host,
         '(^|[.])(spam-farm|cheap-pills|casino-win|free-bets|adult-x|ads-track)[.]example[.](com|net|org)$')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN best ON h.host = best.host AND h.path = best.path
"""


_WORD_LIST = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: {links}: (a, b) with a < b; {ids}: (id): every id with the smallest one reachable.
_REACHED = """
both_ways AS (SELECT a, b FROM {links} UNION ALL SELECT b, a FROM {links}),
reach(id, r) AS (SELECT id, id FROM {ids} UNION SELECT b, r FROM reach JOIN both_ways ON a = id WHERE r < b),
root AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

OP2_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORD_LIST.format(text=_LOWER.format(text='text'))} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS x FROM d),
n AS (SELECT doc_id AS id, len(x) AS n FROM s),
sets AS (SELECT min(doc_id) AS rep, list_sort(x) AS x, list(doc_id) AS ids FROM s WHERE len(x) > 0 GROUP BY list_sort(x)),
u AS (SELECT rep, len(x) AS n, unnest(x) AS x FROM sets),
common AS (SELECT p.rep AS a, q.rep AS b, p.n + q.n AS n, count(*) AS c FROM u p JOIN u q ON p.x = q.x AND p.rep < q.rep
           WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n) GROUP BY p.rep, q.rep, p.n + q.n),
link AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (n - c)
         UNION ALL SELECT rep, i FROM (SELECT rep, unnest(ids) AS i FROM sets) WHERE i > rep),
{_REACHED.format(links='link', ids='n').strip()}
SELECT n.id AS doc_id, CAST(n.n AS BIGINT) AS n_shingles, component_id, component_id = n.id AS kept
FROM n JOIN root ON n.id = root.id
"""

OP5_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x, sqrt(list_sum([e * e for e in CAST(embedding AS DOUBLE[])])) AS n
  FROM embeddings),
link AS (SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.label = q.label AND p.id < q.id
         WHERE list_dot_product(p.x, q.x) / (p.n * q.n) >= 0.98),
{_REACHED.format(links='link', ids='v').strip()},
n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.id AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, component_id = v.id AS kept
FROM v JOIN root ON v.id = root.id LEFT JOIN n ON v.id = n.a
"""


def _quality_sql() -> str:
    """The table of rules as a DuckDB projection over counts found by unnesting."""
    rules = " AND ".join("{0} {2} {3} * {1}".format(*m.split(" / "), sign, float(bound))
                         for _, m, sign, bound in quality_rules.RULES)
    stops = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORD_LIST.format(text='text')} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, len(w) AS n_words,
         length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
         len(list_filter(lines, lambda s: regexp_matches(s, '^\s*([-*•·]|[0-9]+[.)])\s'))) AS n_bullet_lines,
         len(list_filter(lines, lambda s: regexp_matches(s, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
b AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
             OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND {rules} AS kept
FROM b
"""


#: The CRC-32 table by half bytes.
_CRC = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
        "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")
_JUMP = """(CAST(floor((j + 1) * (2147483648.0::DOUBLE
        / (CAST((((k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT) // 8589934592) AS DOUBLE) + 1))) AS BIGINT))"""

OP7_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
         hex(encode(coalesce(text, ''))) AS h, {_KEY.format(seed='shard')} AS key,
         ('0x' || substr(md5('shard:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 16))::UBIGINT::HUGEINT AS k
  FROM documents),
c AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(
      [4294967295::BIGINT] || [CAST(instr('0123456789ABCDEF', h[CASE WHEN i % 2 = 0 THEN i - 1 ELSE i + 1 END]) - 1 AS BIGINT)
                               for i in [x + 1 for x in range(0, len(h))]],
      lambda acc, x: xor(CAST({_CRC}[1 + (xor(acc, x) & 15)] AS BIGINT), acc >> 4))) AS text_crc32 FROM d),
jump(r, n, k, b, j) AS (
  SELECT r, n, k, -1::BIGINT, 0::BIGINT FROM d, (VALUES ({sharding.SHARDS}), ({sharding.SHARDS + 1})) AS t(n)
  UNION ALL
  SELECT r, n, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT, j, {_JUMP} FROM jump WHERE j < n),
s AS (SELECT r, n, max(b) AS shard FROM jump WHERE b >= 0 GROUP BY r, n)
SELECT c.doc_id, c.size, c.text_crc32, 'key' AS law, CAST(p.shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY p.shard ORDER BY c.key, c.doc_id, c.text_crc32, c.size) - 1 AS BIGINT) AS slot,
       CAST(q.shard AS INTEGER) AS grown_shard
FROM c JOIN s p ON c.r = p.r AND p.n = {sharding.SHARDS} JOIN s q ON c.r = q.r AND q.n = {sharding.SHARDS + 1}
"""


#: Every group and kept term of a language, terms that a group lacks included.
OP12_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format(text="coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM (SELECT row_number() OVER () AS r, * FROM d)),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence_audit.MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
f AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c
  FROM g JOIN kept ON g.lang = kept.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER grp + 5 * count(*) OVER grp) AS p,
         1 + (1000000000::HUGEINT * (sum(c) OVER (PARTITION BY lang, term) + 5))
             // (sum(c) OVER (PARTITION BY lang) + 5 * count(*) OVER grp) AS q
  FROM f WINDOW grp AS (PARTITION BY lang, source)),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pair AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(apart.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart ON apart.lang = x.lang AND apart.source = x.source AND apart.item = y.source),
every AS (
  SELECT * FROM pair UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= {divergence_audit.TOP_TERMS}
"""


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
c AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
s AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""


def all_oracles() -> dict[str, str]:
    """Not here, as SQL cannot say them: op4 (context mixing), op8 (weighted
    alignment), op9 (merge-dropout), op10 (kernel regression), op11 (byte pair
    ids); tests hold them to brute force, an exact round trip or held-out accuracy."""
    return {"op1_mix_sources": OP1_SQL, "op2_minhash_dedup": OP2_SQL, "op3_url_filter": OP3_SQL,
            "op5_embedding_dedup": OP5_SQL, "op6_quality_rules": _quality_sql(), "op7_jump_shards": OP7_SQL,
            "op12_source_divergence": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
