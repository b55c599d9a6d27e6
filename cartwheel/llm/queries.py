"""Registered queries of the operators and their SQL (DuckDB)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, utf8
from .decontaminate import MIN_LITERALS, TEMPLATE, WINDOW, decontaminate, sql_canonical
from .exact_dedup import digests, exact_dedup
from .fixity import Tree, audit, manifest, replica
from .hmm import hmm_scores
from .language_id import language_ids
from .line_dedup import line_dedup
from .merkle_manifest import merkle_manifest
from .minhash_dedup import near_duplicates
from .mixing import mix
from .quality import quality_scores
from .sharding import shard_table
from .substring_dedup import substring_dedup
from .tokenizer_alignment import align_tokenizers


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the id range is the history, the earlier half the batch that is looked up in it."""
    rows = scratch(digests(documents(spark, sf_dir)), "digests")
    middle = F.expr("min(doc_id) + (max(doc_id) - min(doc_id)) div 2")
    split = rows.agg(middle.alias("m")).first()["m"]
    old = F.coalesce(F.col("doc_id") > F.lit(split), F.lit(False))
    out = exact_dedup(rows.where(old), rows.where(~old))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(utf8("kept_text"), 256).alias("kept_sha256"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a replica of the pages' WARC volumes in which some records rotted: of every 101 pages one has a
    flipped byte, of every 211 one is lost. One row per record; ``intact`` is what the audit says."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    flipped = F.concat(F.lit(b"X"), F.expr("substring(record, 2)"))
    copy = F.when(F.col("page_id") % 211 == 8, F.lit(None)).when(F.col("page_id") % 101 == 7, flipped).otherwise(F.col("record"))
    records = replica(pages).withColumn("copy", copy).withColumn("copy_length", F.length("copy").cast("long")).withColumn("copy_digest", F.sha2("copy", 256))
    listed = scratch(manifest(records, "copy_length", "copy_digest"), "manifest")
    seen = listed.select("volume", "place", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"))
    found = audit(Tree(listed, "one"), Tree(seen, "other")).withColumn("bad", F.lit(True))
    out = listed.join(found, ["volume", "place"], "left")
    return out.select("page_id", "volume", "place", "offset", "length", "digest", F.col("bad").isNull().alias("intact"))


def op5_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir).select("doc_id", "source"))


def op7_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_table(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_substring_dedup, op3_minhash_dedup, op4_warc_fixity, op5_quality_qda, op6_pfair_mix, op7_lpt_shards,
                                    op8_template_decontamination, op9_hmm_scores, op10_line_dedup, op11_tokenizer_alignment, op12_language_id, op13_merkle_manifest)}

#: crc32 of doc_id's decimal digits: eight shifts for each of them.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""

SQL = {
    "op1_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, i, list_slice(words, i, i + 49) AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
h AS (SELECT doc_id, i, sha256(array_to_string(win, ' ')) AS k FROM w),
f AS (SELECT k, min(doc_id) AS owner FROM h GROUP BY k),
bad AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM h JOIN f USING (k) WHERE owner < doc_id),
x AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM x ANTI JOIN bad ON x.doc_id = bad.doc_id AND x.p = bad.p GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM bad GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op3_minhash_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 2), ' ') AS sh FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
pairs AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op4_warc_fixity": """
WITH r AS (SELECT page_id, CAST(floor(page_id / 1024) AS BIGINT) AS volume, encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS record FROM pages)
SELECT page_id, volume, row_number() OVER w - 1 AS place, CAST(coalesce(sum(octet_length(record)) OVER (PARTITION BY volume ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  octet_length(record) AS length, sha256(record) AS digest, NOT (page_id % 101 = 7 OR page_id % 211 = 8) AS intact FROM r WINDOW w AS (PARTITION BY volume ORDER BY page_id)""",
    "op8_template_decontamination": f"""
WITH c AS (SELECT 'd' AS side, doc_id AS id, {sql_canonical()} AS c FROM documents UNION ALL SELECT 'b', item_id, {sql_canonical()} FROM benchmark),
t AS (SELECT side, id, string_split(c, ' ') AS v, string_split(regexp_replace(c, '{TEMPLATE[0]}', '\\1', 'g'), ' ') AS t FROM c WHERE c <> ''),
w AS (SELECT side, id, i, n, list_slice(v, i, i + n - 1) AS v, list_slice(t, i, i + n - 1) AS t
  FROM (SELECT *, least(len(t), {WINDOW}) AS n, unnest(range(1, CAST(len(t) - least(len(t), {WINDOW}) + 2 AS BIGINT))) AS i FROM t)),
k AS (SELECT side, id, i, n, array_to_string(t, ' ') AS template, CASE WHEN len(list_filter(v, lambda x: ascii(x) < 5)) = 0 THEN '' ELSE CAST(list_transform(v, lambda x: CASE WHEN ascii(x) < 5 THEN list_position(v, x) ELSE 0 END) AS VARCHAR) END AS pattern,
  len(list_filter(v, lambda x: ascii(x) >= 5)) AS literals FROM w),
b AS (SELECT template, pattern, min(id) AS item_id FROM k WHERE side = 'b' AND (literals >= {MIN_LITERALS} OR (n < {WINDOW} AND literals >= 3 AND 2 * literals >= n AND n - literals >= 2)) GROUP BY 1, 2),
short AS (SELECT DISTINCT n FROM k WHERE side = 'b' AND (literals >= {MIN_LITERALS} OR (n < {WINDOW} AND literals >= 3 AND 2 * literals >= n AND n - literals >= 2)) AND n < {WINDOW}),
h AS (SELECT k.id, count(*) AS n_hits, min(item_id) AS item_id FROM k JOIN b USING (template, pattern) WHERE side = 'd' GROUP BY 1)
SELECT doc_id, n_hits IS NOT NULL AS contaminated, coalesce(n_hits, 0) AS n_hits, coalesce(item_id, -1) AS item_id FROM documents LEFT JOIN h ON h.id = doc_id""",
    "op10_line_dedup": """
WITH RECURSIVE s AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text <> ''),
l AS (SELECT doc_id, unnest(a) AS line, unnest(range(0, len(a))) AS line_no FROM s),
u AS (SELECT line, min((doc_id, line_no)) AS first, length(line) AS n FROM l WHERE trim(line, ' ') <> '' GROUP BY line),
near AS (SELECT a.line AS a, b.line AS b FROM u a JOIN (SELECT *, unnest([n - 2, n - 1, n, n + 1, n + 2]) AS m FROM u WHERE n >= 20) b ON a.n = b.m
  WHERE a.n >= 20 AND a.line <> b.line AND levenshtein(encode(a.line)::VARCHAR, encode(b.line)::VARCHAR) <= 2),
reach(a, b) AS (SELECT line, line FROM u UNION SELECT reach.a, near.b FROM reach JOIN near ON near.a = reach.b),
stays AS (SELECT r.a AS line, min(u.first) AS first FROM reach r JOIN u ON u.line = r.b GROUP BY r.a),
gone AS (SELECT doc_id, count(*) AS n_removed, list(CAST(line_no AS INTEGER) ORDER BY line_no) AS removed_lines FROM l JOIN stays USING (line) WHERE (doc_id, line_no) <> first GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(a), 0) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed_lines, []) AS removed_lines
FROM documents d LEFT JOIN s USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE f(v, c) AS (SELECT * FROM (VALUES (0, 0), (1, 1)) t),
d AS (SELECT doc_id, lang, v, crc % 7 = 0 AS hit, sha256(coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(length((n_chars + c)::VARCHAR) || ':' || (n_chars + c), '-') || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf
  FROM (SELECT *, {CRC} AS crc FROM documents) CROSS JOIN f),
p AS (SELECT doc_id, lang, leaf, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM d WHERE v = 0),
tree(lang, lvl, nodes) AS (SELECT lang, 0, list(leaf ORDER BY i) FROM p GROUP BY lang
  UNION ALL SELECT lang, lvl + 1, list_transform(range(0, len(nodes), 2), lambda k: sha256(array_to_string(nodes[k + 1:k + 2], ''))) FROM tree WHERE len(nodes) > 1),
sub AS (SELECT lang, lvl AS top, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM tree WHERE len(nodes) = 1),
roots(lvl, nodes) AS (SELECT 0, list(subroot ORDER BY i) FROM sub
  UNION ALL SELECT lvl + 1, list_transform(range(0, len(nodes), 2), lambda k: sha256(array_to_string(nodes[k + 1:k + 2], ''))) FROM roots WHERE len(nodes) > 1),
whole AS (SELECT nodes[1] AS root FROM roots WHERE len(nodes) = 1),
way AS (SELECT p.doc_id, t.lvl, p.i // (1 << t.lvl) AS i, t.nodes FROM p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang WHERE len(t.nodes) > 1
  UNION ALL SELECT p.doc_id, s.top + r.lvl, s.i // (1 << r.lvl), r.nodes FROM p JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang CROSS JOIN roots r WHERE len(r.nodes) > 1),
step AS (SELECT doc_id, lvl, i % 2 AS side, CASE WHEN i % 2 = 1 THEN nodes[i] ELSE coalesce(nodes[i + 2], '') END AS sibling FROM way),
proof AS (SELECT doc_id, sha256(string_agg(sibling, '' ORDER BY lvl)) AS proof_sha256, max(lvl) + 1 AS height FROM step GROUP BY doc_id),
fold(doc_id, lvl, h) AS (SELECT doc_id, 0, leaf FROM d WHERE v = CASE WHEN hit THEN 1 ELSE 0 END
  UNION ALL SELECT f.doc_id, f.lvl + 1, sha256(CASE WHEN side = 1 THEN sibling || h ELSE h || sibling END) FROM fold f JOIN step s ON s.doc_id = f.doc_id AND s.lvl = f.lvl)
SELECT p.doc_id, p.leaf, s.subroot, w.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = w.root AS verified
FROM p JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang CROSS JOIN whole w LEFT JOIN proof q ON q.doc_id = p.doc_id JOIN fold f ON f.doc_id = p.doc_id AND f.lvl = coalesce(q.height, 0)""",
}
