"""The operators as queries over whole tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import (
    decontamination,
    embedding_dedup,
    html_extraction,
    line_dedup,
    manifest,
    mixing,
    pii,
    quality,
    sharding,
    simhash,
    url_filter,
    warc,
    whitening,
)
from salescope.llm.common import LOWER, UPPER
from salescope.session import durable, fresh, remove


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        REGISTRY[name] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
         list_aggregate(w[s : s + least(13, len(w)) - 1], 'string_agg', ' ') AS k
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s
        FROM i WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM iw),
dw AS (
  SELECT doc_id, s, m, list_aggregate(w[s : s + m - 1], 'string_agg', ' ') AS k
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS s
        FROM d, m WHERE len(w) >= m)),
occ AS (SELECT doc_id, s, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.k = iw.k),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + m - 1)) AS p FROM occ) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


@query("op4_decontamination", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    judged = decontamination.decontaminate(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return judged.select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query("op1_mixing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents")).drop("key")


# ---- fixed values ----
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# ---- end of fixed values ----

OP3_SQL = """
WITH r(rule_host, rule_path, verdict) AS (VALUES {rules}),
p AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (n)
""".format(rules=", ".join(map(str, RULES)), upper=UPPER, lower=LOWER)


@query("op3_url_filters", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    names = ("host", "path", "verdict")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in RULES]
    rules = spark.range(1).select(F.inline(F.array(*rows)))
    return url_filter.filter_urls(table(spark, folder, "pages"), rules)


OP6_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM g
"""


@query("op6_warc", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    path = fresh(spark, "warc")
    warc.write(pages, path)
    kind = pages.schema["page_id"].dataType
    found = warc.read(spark, path, payloads=False).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
    found = durable(found)
    remove(spark, path)
    return found


@query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("row.doc_id", "held_out", "score", "predicted")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, n, ls[n] AS line, len(regexp_extract_all(ls[n], '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS n FROM d)),
c AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY n) AS upto,
         row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i
  FROM l WHERE w > 0),
span AS (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b
    ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM c a JOIN c b
    ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.i),
win AS (
  SELECT span.doc_id, s, e, string_agg(line, chr(10) ORDER BY i) AS run
  FROM span JOIN c ON span.doc_id = c.doc_id AND c.i BETWEEN s AND e GROUP BY span.doc_id, s, e),
copies AS (
  SELECT doc_id, s, e FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS i FROM copies),
k AS (SELECT *, sum(CAST(w > 0 AS INT)) OVER (PARTITION BY doc_id ORDER BY n) AS i FROM l),
j AS (
  SELECT k.*, a.i IS NOT NULL AND (w > 0 OR b.i IS NOT NULL) AS cut FROM k
  LEFT JOIN gone a ON k.doc_id = a.doc_id AND k.i = a.i
  LEFT JOIN gone b ON k.doc_id = b.doc_id AND k.i + 1 = b.i)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (cut) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT cut), '') AS text
FROM j GROUP BY doc_id
"""


@query("op7_line_dedup", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select("row.doc_id", "n_lines", "n_removed", "text")


OP9_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, CASE WHEN len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(v, lambda x: x <> 0)) > 0 THEN v END AS v
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM e UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""


@query("op9_embedding_near_dedup", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query("op5_pii")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents")).select("row.doc_id", *pii.COLUMNS)


@query("op10_html_extraction")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(table(spark, folder, "pages"))


OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER () AS u, {leaf} AS leaf,
         CASE WHEN {even} THEN {cut} ELSE {leaf} END AS claimed FROM documents),
l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, u) - 1 AS i FROM d),
node(source, level, i, h, n) AS (
  SELECT source, 0, i, leaf, count(*) OVER (PARTITION BY source) FROM l
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM node WHERE n > 1 GROUP BY source, level, i // 3, n),
sub AS (SELECT source, level AS levels, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM node WHERE n = 1),
top(level, i, h, n) AS (
  SELECT 0, s, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, i // 3, n),
r AS (SELECT h AS root FROM top WHERE n = 1),
side AS (
  SELECT a.source, a.level, a.i,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM node a JOIN node b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY ALL),
top_side AS (
  SELECT a.level, a.i,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM top a JOIN top b ON a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
step AS (
  SELECT u, level, lft, rgt FROM l JOIN side
    ON l.source IS NOT DISTINCT FROM side.source AND side.i = l.i // CAST(pow(3, level) AS BIGINT)
  UNION ALL
  SELECT u, levels + level, lft, rgt FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source
    JOIN top_side ON top_side.i = s // CAST(pow(3, level) AS BIGINT)),
proof AS (SELECT u, sha256(string_agg(lft || rgt, '' ORDER BY level)) AS proof FROM step GROUP BY u),
fold(u, level, h) AS (
  SELECT u, 0, claimed FROM d
  UNION ALL
  SELECT fold.u, fold.level + 1, sha256(lft || h || rgt) FROM fold JOIN step ON fold.u = step.u AND fold.level = step.level),
folded AS (SELECT u, arg_max(h, level) AS folded FROM fold GROUP BY u)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source JOIN r ON true
JOIN folded USING (u) LEFT JOIN proof USING (u)
"""


def _leaf_sql(text: str) -> str:
    parts = [
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(parts)})"


# The lowest bit of the CRC-32 of a doc_id, bit by bit; 3988292384 is the reversed polynomial.
CRC_EVEN = (
    "list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(8 * length(CAST(doc_id AS VARCHAR))),"
    " lambda k: (ord(CAST(doc_id AS VARCHAR)[k // 8 + 1]) >> (k % 8)) & 1)),"
    " lambda crc, bit: CASE WHEN (crc & 1) <> bit THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END) % 2 = 1"
)
OP11_SQL = OP11_SQL.format(leaf=_leaf_sql("text"), cut=_leaf_sql("replace(text, chr(10), '')"), even=CRC_EVEN)


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    cut = F.translate("text", "\n", "")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    true = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    claimed = manifest.leaf(*true, F.when(tampered, cut).otherwise(F.col("text")))
    found = manifest.manifest(docs, claimed)
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified",
    )


@query("op13_sharding")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op12_embedding_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
