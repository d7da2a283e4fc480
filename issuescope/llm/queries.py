"""The registered queries of the training-data operators, over whole tables, and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import load
from .html import extract_pages
from .language import fit_language, identify_language
from .minhash import minhash_components
from .mixing import by_position, plan_mix
from .packing import pack_documents
from .phrases import collocations
from .reputation import judge_pages
from .secrets import BASE_KINDS, scan_secrets, span_count, span_list
from .tokens import read_token_files, write_token_files
from .topk import exact_top_k
from .toxicity import fit_toxicity, score_toxicity
from .trie import prefix_trie
from .vectors import vector_components


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(load(spark, sf_dir, "embeddings"), 0.9)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(load(spark, sf_dir, "documents"), 85)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, load(spark, sf_dir, "labels")))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(load(spark, sf_dir, "pages"))


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files, read them back, and digest what was read."""
    path = f"{work_dir(spark)}/issuescope/tokens-{uuid.uuid4().hex}"
    write_token_files(load(spark, sf_dir, "documents"), path, "word_bpe_49k.json", 2)
    read = read_token_files(spark, path)
    tokens = (F.octet_length("ids") / 4).cast("long")
    return read.select("doc_id", "start", tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(load(spark, sf_dir, "documents"))
    return by_position(plan.select("doc_id", "size", "source_size", "target", "taken", "position"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"))


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(load(spark, sf_dir, "pages"), load(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return identify_language(docs, fit_language(docs))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(load(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents"), least=100, top=2000)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(load(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [span_count(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.sha2(span_list(spans, BASE_KINDS), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, span_list(spans).alias("spans"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup,
        op2_minhash_dedup,
        op3_toxicity,
        op4_html_text,
        op5_token_planes,
        op6_curriculum_mix,
        op7_best_fit_packing,
        op8_url_reputation,
        op9_language_id,
        op10_exact_top_k,
        op11_prefix_trie,
        op12_collocations,
        op13_secret_scan,
    )
}

_OP1_SQL = """
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, CAST((SELECT count(*) FROM links WHERE links.a = e.vec_id) AS BIGINT) AS n_links,
  low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.vec_id = e.vec_id
"""

_OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') for i in generate_series(1, len(w) - 4)] END) AS s
  FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d JOIN low ON low.doc_id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

_OP6_SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM sizes GROUP BY source
), rounds AS (  -- share by weight, stop what passes twice its size, share the rest again
  SELECT 0 AS round, source, source_size, CAST(weight AS DOUBLE) AS weight, false AS stops,
    1.5 * sum(source_size) OVER () / sum(CAST(weight AS DOUBLE)) OVER () AS level
  FROM sources
  UNION ALL
  SELECT round + 1, source, source_size, weight, stop_now,
    (1.5 * sum(source_size) OVER () - sum(CASE WHEN stop_now THEN 2 * source_size ELSE 0 END) OVER ())
      / nullif(sum(CASE WHEN stop_now THEN 0.0 ELSE weight END) OVER (), 0)
  FROM (SELECT *, stops OR 2 * source_size <= weight * level AS stop_now FROM rounds WHERE round < 40)
), targets AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(2 * source_size AS DOUBLE) ELSE weight * level END AS target,
    CAST(CASE weight WHEN 5 THEN 0.5 WHEN 2 THEN 1 ELSE 2 END AS DOUBLE) AS trend
  FROM rounds WHERE round = 40
), placed AS (
  SELECT doc_id, size, source_size, target, trend, CAST(round(target) AS BIGINT) AS want,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken = 0 THEN NULL WHEN trend = 1 THEN share ELSE
  (sqrt(4 * ((trend - 1) / 2) * ((trend + 1) / 2 * share) + 1) - 1) / (2 * ((trend - 1) / 2)) END AS position
FROM (SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, trend,
    least(1.0, (before + CAST(size AS DOUBLE) / 2) / CAST(nullif(want, 0) AS DOUBLE)) AS share,
    CAST(CASE WHEN source_size = 0 THEN 0 ELSE
      size * (want // source_size) + greatest(0, least(size, want % source_size - before)) END AS BIGINT) AS taken
  FROM placed) AS t
"""

_OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), rules(rule, name, start, decision) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')
), ruled AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(decision, length(rule)) AS decision
  FROM parts JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
  GROUP BY page_id, host, path
), pages_of AS (
  SELECT regexp_replace(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*\z', ''), '\.+\z', '') AS host, path FROM parts
), named AS (
  SELECT host, CASE WHEN host[1] = '[' OR regexp_full_match(host, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') THEN [host]
    ELSE string_split(host, '.') END AS l FROM pages_of WHERE host <> '' GROUP BY host
), tails AS (
  SELECT host, len(l) AS n, l[-1] AS one, array_to_string(l[-2:], '.') AS two, array_to_string(l[-3:], '.') AS three
  FROM named
), levels AS (
  SELECT host,
    CASE WHEN two IN ('ac.uk', 'co.in', 'co.jp', 'co.nz', 'co.uk', 'co.za', 'com.au', 'com.br', 'com.cn', 'com.mx',
      'gov.uk', 'org.uk') THEN three ELSE two END AS domain,
    CASE WHEN two IN ('ac.uk', 'co.in', 'co.jp', 'co.nz', 'co.uk', 'co.za', 'com.au', 'com.br', 'com.cn', 'com.mx',
      'gov.uk', 'org.uk') THEN two ELSE one END AS suffix
  FROM tails
), marks AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good FROM labels GROUP BY doc_id
), seen AS (
  SELECT levels.host, domain, suffix, count(*) AS n, sum(good) AS k FROM pages_of AS parts
  JOIN marks ON marks.doc_id = TRY_CAST(regexp_extract(path, '([0-9]{1,18})[^0-9]*$', 1) AS BIGINT)
  JOIN levels ON levels.host = parts.host GROUP BY levels.host, domain, suffix
), top AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS m FROM seen
), g1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM seen, top GROUP BY suffix
), s1 AS (SELECT sum(n * (k / n - m) ** 2) AS spread, max(m * (1 - m)) AS c, count(*) - 1 AS g, sum(n) - sum(n * n) / sum(n) AS d FROM g1
), w1 AS (SELECT CASE WHEN d > 0 AND spread - g * c > 0 AND c > 0 THEN greatest(2, least(200, c / ((spread - g * c) / d) - 1)) ELSE 200 END AS w FROM s1
), p1 AS (SELECT suffix, w * m + k AS a, w * (1 - m) + n - k AS b FROM g1, w1
), g2 AS (SELECT domain, seen.suffix, sum(n) AS n, sum(k) AS k, any_value(a / (a + b)) AS m FROM seen JOIN p1 ON p1.suffix = seen.suffix GROUP BY domain, seen.suffix
), s2 AS (SELECT sum(n * (k / n - m) ** 2) AS spread, max(m * (1 - m)) AS c, count(*) - 1 AS g, sum(n) - sum(n * n) / sum(n) AS d FROM g2
), w2 AS (SELECT CASE WHEN d > 0 AND spread - g * c > 0 AND c > 0 THEN greatest(2, least(200, c / ((spread - g * c) / d) - 1)) ELSE 200 END AS w FROM s2
), p2 AS (SELECT domain, w * m + k AS a, w * (1 - m) + n - k AS b FROM g2, w2
), g3 AS (SELECT host, n, k, a / (a + b) AS m FROM seen JOIN p2 ON p2.domain = seen.domain
), s3 AS (SELECT sum(n * (k / n - m) ** 2) AS spread, max(m * (1 - m)) AS c, count(*) - 1 AS g, sum(n) - sum(n * n) / sum(n) AS d FROM g3
), w3 AS (SELECT CASE WHEN d > 0 AND spread - g * c > 0 AND c > 0 THEN greatest(2, least(200, c / ((spread - g * c) / d) - 1)) ELSE 200 END AS w FROM s3
), p3 AS (SELECT host, w * m + k AS a, w * (1 - m) + n - k AS b FROM g3, w3
), judged AS (
  SELECT levels.host, coalesce(p3.a, p2.a, p1.a) AS a, coalesce(p3.b, p2.b, p1.b) AS b,
    CASE WHEN p3.a IS NOT NULL THEN 'host' WHEN p2.a IS NOT NULL THEN 'domain' WHEN p1.a IS NOT NULL THEN 'suffix' END AS level
  FROM levels
  LEFT JOIN p3 ON p3.host = levels.host LEFT JOIN p2 ON p2.domain = levels.domain LEFT JOIN p1 ON p1.suffix = levels.suffix
), bounds AS (
  SELECT host, level, a, b, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM judged
)
SELECT parts.page_id, parts.host, parts.path, rule,
  coalesce(decision, CASE WHEN bound < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  level, round(a, 6) AS a, round(b, 6) AS b, round(bound, 6) AS bound
FROM parts LEFT JOIN ruled ON ruled.page_id = parts.page_id AND ruled.host = parts.host AND ruled.path = parts.path
LEFT JOIN bounds ON bounds.host =
  regexp_replace(regexp_replace(regexp_replace(parts.host, '(?s)^.*@', ''), ':[0-9]*\z', ''), '\.+\z', '')
"""

_OP10_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
    CAST(list_sum([q.v[i] * r.v[i] for i in generate_series(1, len(q.v))]) AS BIGINT) AS score
  FROM whole q JOIN whole r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

_OP11_SQL = """
WITH own AS (
  SELECT conv_id, said, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos
  FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes, substr(sha256(concat(
      strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))), 1, 32) AS said
    FROM conversations WHERE conv_id IS NOT NULL) AS t
), ids AS (  -- the CRC-32 of a number's digits, bit by bit
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda c, bit: xor(c >> 1, 3988292384 * (c & 1))))) % 9 AS kept
  FROM (SELECT DISTINCT conv_id FROM own) AS t
), turns AS (
  SELECT i.conv_id, 0 AS part, pos, said, bytes FROM ids i JOIN own o
    ON o.conv_id = i.conv_id - i.conv_id % 5 AND o.pos <= i.kept
  UNION ALL
  SELECT i.conv_id, 1, pos, said, bytes FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos > i.kept
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, bytes, string_agg(said, '') OVER w AS path,
    count(*) OVER (PARTITION BY conv_id) AS n FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL
  SELECT conv_id, 0, 0, '', (SELECT count(*) FROM turns WHERE turns.conv_id = ids.conv_id) FROM ids
), nodes AS (
  SELECT path, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM paths GROUP BY path
), families AS (
  SELECT u.path, count(*) FILTER (v.depth = u.depth + 1) AS n_children, sum((v.n_convs - 1) * v.bytes) AS saved,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM nodes c WHERE c.depth = v.depth + 1 AND starts_with(c.path, v.path))) AS n_leaves
  FROM nodes u JOIN nodes v ON starts_with(v.path, u.path) GROUP BY u.path
)
SELECT u.conv_id, u.depth, p.conv_id AS parent_conv_id, u.n_convs, f.n_children, f.n_leaves,
  CAST(f.saved AS BIGINT) AS saved_tokens, u.ends_sha256
FROM nodes u JOIN families f ON f.path = u.path
LEFT JOIN nodes p ON p.depth = u.depth - 1 AND starts_with(u.path, p.path)
"""

_OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM documents) AS t
), grams AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i
    FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) AS sizes WHERE len(words) >= k) AS t
  GROUP BY lang, k, phrase HAVING count(*) >= 100
), totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang
), split AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2
), inner_ AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, w, f, k, i, unnest(generate_series(i + 1, k)) AS j
    FROM (SELECT lang, w, f, k, unnest(generate_series(1, k - 1)) AS i FROM split) AS a) AS b
  WHERE j - i + 1 < k GROUP BY lang, 2
), kept AS (
  SELECT s.* FROM split s LEFT JOIN inner_ i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.f IS NULL OR 100 * i.f < 100 * s.f
), cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS one, array_to_string(w[c + 1:], ' ') AS two
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM kept) AS t
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.c, o.f AS l, t.f AS r, n,
    CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(o.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cuts c JOIN grams o ON o.lang = c.lang AND o.phrase = c.one JOIN grams t ON t.lang = c.lang AND t.phrase = c.two
  JOIN totals ON totals.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_embedding_dedup": _OP1_SQL,
    "op2_minhash_dedup": _OP2_SQL,
    "op6_curriculum_mix": _OP6_SQL,
    "op8_url_reputation": _OP8_SQL,
    "op10_exact_top_k": _OP10_SQL,
    "op11_prefix_trie": _OP11_SQL,
    "op12_collocations": _OP12_SQL,
}
