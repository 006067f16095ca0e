"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgate.llm import decontam, embedding, jaccard, mixing, negatives, pii, secret_scan, sharding, tokens, toxicity, url_filter, vector_codes, warc
from tripgate.llm.common import table

PII_KEY = "pseudonyms-1"
VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.plan_mix(table(spark, sf_dir, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymize(table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", "text", *[f"n_{k}" for k in pii.KINDS])


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(kind).cast("long").alias(f"n_{kind}")

    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = secret_scan.spans_text(*secret_scan.KINDS)
    return found.select("doc_id", *[count(k) for k in secret_scan.KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        secret_scan.spans_text(*secret_scan.KINDS, "random").alias("spans"))


def compressed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, ((F.col("label") + 1) % 10).cast("int")).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", relabelled), F.col("vec_id") % 50 == 0)


URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": mix,
    "op2_embedding_near_dups": embedding_near_dups,
    "op3_decontaminate": decontaminate,
    "op4_shard": shard,
    "op5_warc": warc_round_trip,
    "op6_ngram_jaccard": ngram_jaccard,
    "op7_token_counts": token_counts,
    "op8_pii": pii_pseudonyms,
    "op9_toxicity": toxicity_scores,
    "op10_secrets": secrets,
    "op11_vector_codes": compressed_vectors,
    "op12_hard_negatives": hard_negatives,
    "op13_url_filter": url_verdicts,
}

#: Shards: the least depth at which a prefix of the id's md5 holds at most the limit (or one record).
_SHARD_SQL = f"""
WITH keyed AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, {sharding.ID_BITS // 4}) AS BIGINT) AS k
  FROM documents),
depths AS (SELECT unnest(range({sharding.ID_BITS} + 1)) AS depth),
buckets AS (
  SELECT depth, k >> ({sharding.ID_BITS} - depth) AS b, sum(n_bytes) AS total, count(*) AS n
  FROM keyed, depths GROUP BY 1, 2),
fits AS (SELECT * FROM buckets WHERE total <= {sharding.SHARD_BYTES} OR n = 1),
least AS (
  SELECT keyed.doc_id, keyed.n_bytes, keyed.k, min(fits.depth) AS depth
  FROM keyed JOIN fits ON keyed.k >> ({sharding.ID_BITS} - fits.depth) = fits.b GROUP BY ALL)
SELECT doc_id, n_bytes,
       CASE WHEN least.depth = 0 THEN ''
            ELSE substr(lpad(bin(k), {sharding.ID_BITS}, '0'), 1, CAST(least.depth AS INTEGER)) END AS shard,
       CAST(least.depth AS INTEGER) AS depth, CAST(total AS BIGINT) AS shard_bytes
FROM least JOIN buckets ON buckets.depth = least.depth AND buckets.b = k >> ({sharding.ID_BITS} - least.depth)
"""

#: Equal payloads: the largest id is the response.
_WARC_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS hex FROM payloads),
groups AS (SELECT n, hex, max(page_id) AS top FROM hashed GROUP BY 1, 2),
digits AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((('0x' || substr(hex, 1 + 10 * CAST(i // 8 AS INTEGER), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1), '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT hex FROM hashed), range(32) AS t(i) GROUP BY hex)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM hashed JOIN groups USING (n, hex) JOIN digits USING (hex)
"""

#: Jaccard components by brute force over the pairs that share a shingle.
_JACCARD_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM split),
flat AS (SELECT doc_id, unnest(s) AS h FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM flat a JOIN flat b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * c >= 80 * (len(p.s) + len(q.s) - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.y)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(reach.y) AS component_id
FROM sets JOIN reach ON reach.x = sets.doc_id GROUP BY 1, 2
"""

#: Whole and finite vectors, each component as floor(scale * x).
_INTEGERS = """
SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
"""


def _codes_sql(rounds: int) -> str:
    """Every part against every entry in every round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
assigned{r} AS (
  SELECT vec_id, part, list_aggregate(list(d * 256 + entry), 'min') AS best
  FROM (SELECT p.vec_id, p.part, entry, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d
        FROM parts p JOIN book{r} b ON p.part = b.part) GROUP BY 1, 2)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY pos) AS c FROM (
      SELECT p.part, CAST(best AS BIGINT) % 256 AS entry, pos, floor(sum(x[pos]) / count(*)) AS mean
      FROM parts p JOIN assigned{r} a ON a.vec_id = p.vec_id AND a.part = p.part, range(1, 17) AS t(pos) GROUP BY ALL) GROUP BY 1, 2) m
  ON m.part = b.part AND m.entry = b.entry)""")
    return f"""
WITH kept AS ({_INTEGERS.format(scale=vector_codes.SCALE)}),
parts AS (SELECT vec_id, part, v[part * 16 + 1:part * 16 + 16] AS x FROM kept, range(4) AS t(part)),
book0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM parts
  QUALIFY entry < 256),{",".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best AS BIGINT) % 256), '' ORDER BY part) AS code, sum(CAST(best AS BIGINT) // 256) AS error
  FROM assigned{rounds} GROUP BY 1),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry)) AS sha
  FROM book{rounds})
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


#: Every anchor against every row.
_NEGATIVES_SQL = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v
  FROM ({_INTEGERS.format(scale=negatives.SCALE)}) WHERE label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_URL_PATTERN = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _part_sql(url: str, i: int) -> str:
    return f"regexp_extract({url}, '{_URL_PATTERN}', {i})"


def _node_sql(url: str) -> str:
    scheme, host, path, query = (_part_sql(url, i) for i in (1, 2, 3, 4))
    return (f"CASE WHEN contains({url}, '://') THEN translate({scheme}, {_UPPER_LOWER}) || '://' || translate({host}, {_UPPER_LOWER}) "
            f"|| {path} || {query} END")


def _attribute_sql(name: str) -> str:
    pattern = rf"""(?i)[\s"''/]{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return " || ".join(f"regexp_extract(tag, '{pattern}', {i})" for i in (1, 2, 3))


#: Rules by the longest fit; classes of aliases by a closure over all links.
_URL_SQL = rf"""
WITH RECURSIVE rules(host, path, verdict) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)}),
tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)', ' ', 'g'),
                     '(?i)<(?:link|meta)\s[^<>]*>')) AS tag
  FROM pages WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|refresh')),
read AS (
  SELECT url, tag, list_contains(regexp_split_to_array(lower({_attribute_sql("rel")}), '\s+'), 'canonical') AND regexp_matches(tag, '(?i)^<link') AS canonical,
         {_attribute_sql("href")} AS href, lower(trim({_attribute_sql("http-equiv")})) = 'refresh' AND regexp_matches(tag, '(?i)^<meta') AS refresh,
         regexp_extract({_attribute_sql("content")}, '(?i)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*[''"]?([^''"\s]+)', 1) AS sent_to
  FROM tags),
named AS (
  SELECT url, replace(trim(CASE WHEN canonical THEN href ELSE sent_to END), '&amp;', '&') AS target
  FROM read WHERE canonical OR (refresh AND sent_to <> '')),
based AS (
  SELECT url, target, {_part_sql("url", 1)} AS scheme, {_part_sql("url", 1)} || '://' || {_part_sql("url", 2)} AS origin, {_part_sql("url", 3)} AS path FROM named),
aimed AS (
  SELECT url, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN scheme || ':' || target WHEN starts_with(target, '/') THEN origin || target
    WHEN target = '' OR starts_with(target, '#') THEN url WHEN starts_with(target, '?') THEN origin || path || target
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE origin || CASE WHEN regexp_extract(path, '(?s)^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || target END AS target
  FROM based),
ends AS (SELECT DISTINCT {_node_sql("url")} AS a, {_node_sql("target")} AS b FROM aimed WHERE target IS NOT NULL),
links AS (SELECT a, b FROM ends WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM ends WHERE a IS NOT NULL AND b IS NOT NULL),
reach AS (SELECT a AS x, a AS y FROM links UNION SELECT x, b FROM reach JOIN links ON y = a),
every AS (SELECT url FROM pages UNION SELECT y FROM reach),
sites AS (
  SELECT url, coalesce(translate({_part_sql("url", 2)}, {_UPPER_LOWER}), '') AS host, coalesce({_part_sql("url", 3)}, '') AS path FROM every),
ruled AS (
  SELECT s.url, s.host, s.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM sites s LEFT JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY s.url, s.host, s.path),
blocked AS (SELECT DISTINCT x FROM reach JOIN ruled ON ruled.url = reach.y WHERE verdict = 'block')
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {_node_sql("pages.url")} IN (SELECT x FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM pages JOIN ruled ON ruled.url IS NOT DISTINCT FROM pages.url
"""

ORACLE_SQL: dict[str, str] = {
    "op4_shard": _SHARD_SQL,
    "op5_warc": _WARC_SQL,
    "op6_ngram_jaccard": _JACCARD_SQL,
    "op11_vector_codes": _codes_sql(vector_codes.ROUNDS),
    "op12_hard_negatives": _NEGATIVES_SQL,
    "op13_url_filter": _URL_SQL,
}
