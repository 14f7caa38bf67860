"""Queries of the training-data operators over the test tables.

Each query applies its operator to the whole table and derives the digest
columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_fold, chat_format, collocations, decontaminate, filter_audit, prefix_bpe, quality, secrets_scan,
               simhash, token_count, token_files, topk, url_rules)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = (table(spark, sf_dir, "embeddings", "vec_id", "embedding").where(topk.usable(F.col("embedding")))
            .select("vec_id", topk.quantised(F.col("embedding")).alias("vec")))
    return topk.top_k(vecs, vecs.where(F.col("vec_id") % 50 == 0), k=5)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(c.vec AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                      table(spark, sf_dir, "benchmark", "item_id", "text"))
    names = F.array_sort(F.col("items").cast("array<string>"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


URL_RULES = (url_rules.Rule("block", "net"), url_rules.Rule("allow", "example.net", "/en/"),
             url_rules.Rule("block", "example.com", "/de/"), url_rules.Rule("allow", "org", "/fr/"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


OP4_SQL = r"""
WITH a AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokens_to_files(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    public_tokenizers.path("piece_bpe_32k.model"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "labels", "doc_id", "quality"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    further = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                    "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(further)
    return chat_format.format_and_read(turns)


def _escaped(c: str) -> str:
    c = f"replace({c}, '\\', '\\\\')"
    for s in chat_format.CONTROL:
        c = f"replace({c}, '{s}', '{s[0]}\\{s[1:]}')"
    return c


OP8_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(chat_format.BEGIN) + len(chat_format.END) + 2}
                + length(replace({_escaped("role")}, chr(10), '\\' || chr(10)))
                + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secrets_scan.BASE + secrets_scan.FURTHER
    out = secrets_scan.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"), rules)
    base = F.filter("spans", lambda x: x["kind"] < len(secrets_scan.BASE))

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{rules[k].kind}")
    return out.select("doc_id", *[count(k) for k in range(len(secrets_scan.BASE))], F.sha2(secrets_scan.span_text(base, rules), 256).alias("base_sha256"),
                      secrets_scan.span_text(F.col("spans"), rules).alias("spans"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_fold.bpe(table(spark, sf_dir, "documents", "doc_id", "text"),
                       public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_bpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                              table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, min(doc_id) OVER (PARTITION BY t) AS first_id,
         [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM d),
m AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN w.doc_id > first_id THEN 16 ELSE 0 END AS fails
  FROM w LEFT JOIN m ON w.doc_id = m.doc_id),
b AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
v AS (
  SELECT part, s, coalesce(sum(n) FILTER (fails & s <> 0), 0) AS n, coalesce(sum(good) FILTER (fails & s <> 0), 0) AS good,
         coalesce(sum(toxic) FILTER (fails & s <> 0), 0) AS toxic, sum(n) AS total,
         coalesce(sum(n) FILTER (fails = s), 0) AS exactly
  FROM b, range(32) AS r(s) GROUP BY part, s),
l(i, c) AS (VALUES (1, 'A'), (2, 'B'), (4, 'C'), (8, 'D'), (16, 'E')),
o AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS filter_order, [p.i, q.i, r.i, s.i, t.i] AS bits
  FROM l p, l q, l r, l s, l t WHERE p.i + q.i + r.i + s.i + t.i = 31 AND p.i | q.i | r.i | s.i | t.i = 31),
x AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM o, range(1, 6) AS r(step)),
y AS (
  SELECT a.part, filter_order, step, own, a.total - a.n AS kept, a.n - p.n AS removed, i.n - (a.n - p.n) AS redundant,
         i.exactly AS unique_fails, a.good - p.good AS good_lost, a.toxic - p.toxic AS toxic_lost
  FROM x JOIN v a ON a.s = x.before + own JOIN v p ON p.part = a.part AND p.s = x.before
  JOIN v i ON i.part = a.part AND i.s = own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM y
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM p),
size AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM w GROUP BY lang),
place AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
gram AS (
  SELECT lang, ws[i:i + k - 1] AS g, CAST(count(*) AS HUGEINT) AS f
  FROM place, range(1, 6) AS r(k) WHERE i + k - 1 <= len(ws) GROUP BY lang, ws[i:i + k - 1] HAVING count(*) >= 100),
cut AS (
  SELECT c.lang, c.g, c.f AS a, k, h.f AS l, t.f AS r, n, (1000 * c.f * n) // (h.f * t.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM gram WHERE len(g) > 1) c
  JOIN gram h ON h.lang = c.lang AND h.g = c.g[1:k] JOIN gram t ON t.lang = c.lang AND t.g = c.g[k + 1:len(c.g)]
  JOIN size ON size.lang = c.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, g[i:i + m - 1] AS g, max(f) AS longer
  FROM (SELECT *, unnest(range(1, len(g) - m + 2)) AS i FROM (SELECT *, unnest(range(2, len(g))) AS m FROM gram WHERE len(g) > 2))
  GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.g = b.g
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a)
SELECT lang, row_number() OVER o AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_topk, op2_simhash, op3_decontaminate, op4_url_rules, op5_token_files,
                                   op6_token_count, op7_quality, op8_chat_format, op9_secrets,
                                   op10_byte_bpe, op11_prefix_bpe, op12_filter_audit, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": OP1_SQL, "op4_url_rules": OP4_SQL, "op8_chat_format": OP8_SQL, "op12_filter_audit": OP12_SQL,
            "op13_collocations": OP13_SQL}
