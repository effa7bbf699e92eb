"""Queries over ``pages`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import chat, html_text, trie, url_filter, warc
from weekloom.llm.common import table
from weekloom.llm.registry import query


@query("op1_url_filter", r"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS raw, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
rules(rhost, rpath, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (SELECT page_id, host, path, (SELECT max_by(struct_pack(rule := rhost || rpath, action := action), length(rhost || rpath)) FROM rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best FROM h)
SELECT page_id, host, path, best.rule AS rule,
 coalesce(best.action, CASE WHEN contains(host || path, 'cheap-pills.') OR contains(host || path, 'cheap-meds.') OR contains(host || path, 'online-casino.') THEN 'block' ELSE 'allow' END) AS verdict FROM fit""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", F.when(F.col("rank") == 1, F.col("rule")).alias("rule"), "verdict")


#: What the template adds: markers, and a backslash for each backslash and for each control string, found from left to right as in the operator.
_SQL_EXTRA = r"""(length(x) - length(replace(x, '\', ''))) + len(regexp_extract_all(replace(x, '\', '\\'),
 '<\||\|>|</s>|<s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<bos>|<eos>|<start_of_turn>|<end_of_turn>')) + len(regexp_extract_all(x, '<\|>'))"""


@query("op4_chat", f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, length(role) + length(text) + {_SQL_EXTRA.replace("(x,", "(role,").replace("(x)", "(role)")} + {_SQL_EXTRA.replace("(x,", "(text,").replace("(x)", "(text)")}
  + length(role) - length(replace(role, chr(10), '')) + {len(chat.START) + len(chat.HEAD) + len(chat.END)} AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(chars) AS BIGINT) AS formatted_chars FROM l GROUP BY conv_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    done = chat.format_trees(chat.thread_of(given.unionByName(planted)))
    return done.select(F.col("conv").alias("conv_id"), chat.read_back("formatted", "loss").alias("d")).select("conv_id", "d.*")


#: Base32 of a SHA-1 in hex: five hex digits are four characters.
_SQL_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i:
 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '')"""


@query("op10_warc", f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex, coalesce(html, '') AS h FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_SQL_BASE32} AS payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN page_id > first THEN first END AS refers_to FROM m""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = warc.read_archive(warc.write_archive(pages, warc.archive_folder(pages)))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: CRC-32 of a decimal number, bit by bit.
_SQL_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
 lambda acc, b: list_reduce(list_prepend(xor(acc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


@query("op12_prefix_trie", f"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, md5(md5(role) || md5(text))) AS turns FROM given GROUP BY 1),
asked AS (SELECT *, {_SQL_CRC32} % 6 AS h FROM own),
built AS (SELECT a.conv_id, list_concat(coalesce(d.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM asked a LEFT JOIN own d ON d.conv_id = a.conv_id - a.conv_id % 100),
prefix AS (SELECT conv_id, turns[1:d] AS p, d, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
node AS (SELECT p, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, any_value(length(p[d].text)) AS chars,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM prefix GROUP BY p),
child AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
up AS (SELECT node.p[1:u] AS p, sum(CASE WHEN child.p IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((node.n_convs - 1) * coalesce(chars, 0)) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS u FROM node) node LEFT JOIN child ON child.p = node.p GROUP BY 1)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
 CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node LEFT JOIN child ON child.p = node.p JOIN up ON up.p = node.p LEFT JOIN node above ON node.depth > 0 AND above.p = node.p[1:node.depth - 1]""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = trie.sequences(table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    built = trie.with_openings(own, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, 5)
    return trie.prefix_trie(built).select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                                          F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


@query("op13_html_text")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
