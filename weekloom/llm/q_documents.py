"""Queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import decontaminate, exact_dedup, lm_score, mixing, near_dedup, phrases, pii, toxicity
from weekloom.llm.common import table
from weekloom.llm.registry import query

#: A-Z lower-cased in DuckDB, whose lower() knows all of Unicode.
SQL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op8_exact_dedup", f"""
WITH t AS (SELECT doc_id, {SQL_LOWER.format("coalesce(text, '')")} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
 sha256(norm) AS text_sha256 FROM t WINDOW g AS (PARTITION BY norm)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(*exact_dedup.halves(table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL_WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))"

#: The level rises until the capped sources and the shares of the others add up; with few sources every round is a recursion step.
SQL_TARGETS = f"""
sized AS (SELECT doc_id, source, text, CAST({SQL_WORDS} AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY 1),
weighted AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM src),
level AS (
 SELECT 0 AS round, CAST(1.5 * sum(source_size) / sum(weight) AS DOUBLE) AS lvl FROM weighted
 UNION ALL
 SELECT round + 1, (SELECT (1.5 * sum(source_size) - coalesce(sum(2.0 * source_size) FILTER (weight * lvl >= 2.0 * source_size), 0))
   / nullif(sum(weight) FILTER (weight * lvl < 2.0 * source_size), 0) FROM weighted)
 FROM level WHERE round < 60),
target AS (SELECT source, source_size, least(weight * (SELECT max(lvl) FROM level), 2.0 * source_size) AS target FROM weighted)"""


@query("op6_mixing", f"""
WITH RECURSIVE {SQL_TARGETS},
rated AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS coin
  FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rated""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                      (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


SQL_ALNUM = f"list_filter(regexp_split_to_array({SQL_LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

SQL_HITS = f"""
dw AS (SELECT row_number() OVER () AS r, doc_id, {SQL_ALNUM} AS ws FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {SQL_ALNUM} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(ws[i:i + 9], ' ') AS w, len(ws[i:i + 9]) AS n
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM iw WHERE len(ws) > 0)),
place AS (SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, (SELECT DISTINCT n AS k FROM win) WHERE len(ws) >= k)),
hit AS (SELECT r, i, k, item FROM place JOIN win ON place.k = win.n AND place.w = win.w),
n_hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY 1),
n_items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY 1)"""


@query("op3_decontaminate", f"""
WITH {SQL_HITS}
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AS contaminated FROM dw LEFT JOIN n_hits USING (r) LEFT JOIN n_items USING (r)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_list").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_list", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _sql_kind(order: int, kind: str, pattern: str, valid: str) -> str:
    """Spans of one kind: starts are the lengths of all parts and matches before."""
    return f"""SELECT r, {order} AS ord, '{kind}' AS kind, start, start + length(m) AS finish FROM (
 SELECT r, found[i] AS m, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
 FROM (SELECT r, parts, found, unnest(range(1, len(found) + 1)) AS i
  FROM (SELECT r, regexp_split_to_array(t, '{pattern}') AS parts, regexp_extract_all(t, '{pattern}') AS found FROM d) WHERE len(found) > 0)) WHERE {valid}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN (length({_DIGITS}) - i) % 2 = 1 THEN "
         f"CAST({_DIGITS}[i] AS INT) * 2 - CASE WHEN CAST({_DIGITS}[i] AS INT) > 4 THEN 9 ELSE 0 END ELSE CAST({_DIGITS}[i] AS INT) END)) % 10 = 0")
_BARE = "replace(m, ' ', '')"
_MOD97 = (f"list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(string_split(substr({_BARE}, 5) || substr({_BARE}, 1, 4), ''), lambda c: "
          f"CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT))), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1")
SQL_PII = " UNION ALL ".join([
    _sql_kind(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    _sql_kind(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS HUGEINT))) <= 255"),
    _sql_kind(2, "card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}"),
    _sql_kind(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    _sql_kind(4, "iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", f"length({_BARE}) >= 15 AND {_MOD97}"),
])


@query("op5_pii", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({SQL_PII}),
g AS (SELECT r, count(*) FILTER (ord = 0) AS n_email, count(*) FILTER (ord = 1) AS n_ip, count(*) FILTER (ord = 2) AS n_card, count(*) FILTER (ord = 3) AS n_phone,
 string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, ord) FILTER (ord < 4) AS base,
 string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, ord) AS spans FROM s GROUP BY 1)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
 sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    base = {k.name for k in pii.KINDS if k.base}

    def count(name: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
                        F.sha2(pii.span_list(F.filter("pii", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"), pii.span_list(F.col("pii")).alias("spans"))


def sql_near(docs: str, words: int, percent: int) -> str:
    """CTEs: ``comp``(r, component_id) over ``docs``(r, doc_id, text), by all pairs that share a shingle."""
    norm = SQL_LOWER.format("coalesce(text, '')")
    return f"""
nw AS (SELECT r, list_filter(regexp_split_to_array({norm}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM {docs}),
sh AS (SELECT DISTINCT r, array_to_string(ws[i:i + {words - 1}], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - {words - 1}, 1) + 1)) AS i FROM nw WHERE len(ws) > 0)),
sz AS (SELECT r, count(*) AS n FROM sh GROUP BY 1),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN sz x ON x.r = a JOIN sz y ON y.r = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach AS (SELECT r, r AS o FROM nw UNION SELECT reach.r, CASE WHEN o = a THEN b ELSE a END FROM reach JOIN link ON o = a OR o = b),
comp AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN {docs} d ON d.r = o GROUP BY 1)"""


@query("op2_near_dedup", f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), {sql_near("d", 3, 85)}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN comp USING (r) LEFT JOIN sz USING (r)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(~toxicity.learnable("doc_id"), F.lit(False)).alias("held_out"), F.col("toxicity.score").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@query("op9_lm_score")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_score.score(docs, lm_score.labelled(docs, table(spark, sf_dir, "labels")), docs, vocabulary=None)
    return scored.select("doc_id", "lm.*")


@query("op11_phrases", rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({SQL_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM piece),
size AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM worded GROUP BY 1),
gram AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM worded, (VALUES (1), (2), (3)) AS v(k))),
f AS (SELECT lang, k, phrase, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 10),
candidate AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidate) c JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(ws[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(ws[j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_part AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM candidate WHERE k = 3),
around AS (SELECT lang, phrase, max(a) AS longer FROM inner_part GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * best.a)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM kept JOIN size USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
