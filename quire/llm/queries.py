"""The registered queries: each operator over its whole driver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import (
    decontaminate, divergence, langid, language_model, mixing, quality, simhash, suffixes,
    token_counts, tokens, toxicity, url_filter, vector_codes,
)
from quire.llm.shared import stored

RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op4_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op1_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.report(table(spark, folder, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(quality.measured(table(spark, folder, "documents")), "quality")
    return quality.judged(rows, table(spark, folder, "labels"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.report(table(spark, folder, "documents"))


def op8_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.shards(table(spark, folder, "documents").select("doc_id", "text"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.report(table(spark, folder, "embeddings"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.report(table(spark, folder, "documents").select("lang", "source", "text"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    file = token_counts.read_file(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.report(table(spark, folder, "documents"), file)


QUERIES = {
    "op1_language_model": op1_language_model,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op4_mix": op4_mix,
    "op7_simhash": op7_simhash,
    "op8_tokens": op8_tokens,
    "op9_language": op9_language,
    "op10_url_filter": op10_url_filter,
    "op11_vector_codes": op11_vector_codes,
    "op12_divergence": op12_divergence,
    "op13_token_counts": op13_token_counts,
}

ROUNDS = range(vector_codes.ROUNDS)
NEAREST = """near{i} AS MATERIALIZED (
  SELECT rid, part, entry, sum((x.value - b.value) * (x.value - b.value))::BIGINT AS square
  FROM x JOIN book{i} b USING (part, place) GROUP BY rid, part, entry
  QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY square, entry) = 1
)"""
MOVED = """book{j} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(mean, value) AS value
  FROM book{i} LEFT JOIN (
    SELECT part, entry, place, (total - ((total % n) + n) % n) // n AS mean FROM (
      SELECT part, entry, place, sum(value) AS total, count(*) AS n
      FROM near{i} JOIN x USING (rid, part) GROUP BY part, entry, place
    )
  ) USING (part, entry, place)
)"""

SQL = {
    "op11_vector_codes": """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
v AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id, ints) - 1 AS rid FROM kept),
cell AS (SELECT rid, unnest(range(len(ints))) AS i, unnest(ints) AS value, len(ints) // 8 AS size FROM v),
x AS MATERIALIZED (SELECT rid, i // size AS part, i % size AS place, value FROM cell),
book0 AS MATERIALIZED (SELECT part, rid AS entry, place, value FROM x WHERE rid < 16),
""" + ",\n".join(
        f"{NEAREST.format(i=i)},\n{MOVED.format(i=i, j=i + 1)}" for i in ROUNDS
    ) + f",\n{NEAREST.format(i=vector_codes.ROUNDS)}," + f"""
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(square)::BIGINT AS error
  FROM near{vector_codes.ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(value::VARCHAR, ',' ORDER BY part, entry, place))
        FROM book{vector_codes.ROUNDS}) AS codebooks_sha256
FROM v JOIN coded USING (rid)
""",
    "op12_divergence": """
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents
),
w AS (
  SELECT id, lang, source,
         translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS u(term)
),
kept AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3
),
whole AS (SELECT lang, sum(n) + count(*) AS m FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (
  SELECT lang, source, coalesce(sum(c.n), 0) + (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS m
  FROM groups g LEFT JOIN c USING (lang, source) GROUP BY lang, source
),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // size.m AS p,
         1 + 1000000000::HUGEINT * (kept.n + 1) // whole.m AS q
  FROM groups JOIN size USING (lang, source) JOIN kept USING (lang) JOIN whole USING (lang)
  LEFT JOIN c USING (lang, source, term)
),
value AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
report AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN value v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
FROM report QUALIFY part = 'pair' OR rank <= 200
""",
    "op4_mix": """
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         coalesce(md5(doc_id::VARCHAR), '') AS draw
  FROM documents
),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS w,
         3 * source_size AS cap FROM sources
),
share AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::BIGINT
          / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::BIGINT AS share,
         row_number() OVER (ORDER BY cap / w, encode(source) NULLS LAST) AS place
  FROM weighed
  WINDOW before AS (ORDER BY cap / w, encode(source) NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
goals AS (
  SELECT source, source_size,
         least(cap::DOUBLE, w * (SELECT arg_min(share, place) FROM share WHERE share * w <= cap)) AS target
  FROM share
),
queued AS (
  SELECT doc_id, s.source, size, draw, source_size, target,
         sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size
                         ROWS UNBOUNDED PRECEDING)::BIGINT AS passed
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
),
turn AS (
  SELECT *, (r * source_size + passed)::DOUBLE / target AS finish
  FROM queued, range(0, 3) t(r) WHERE r = 0 OR r < ceil(target / source_size)
),
run AS (
  SELECT *, sum(size) OVER (ORDER BY finish, encode(source) NULLS LAST, r, draw, doc_id
                            ROWS UNBOUNDED PRECEDING) AS running
  FROM turn
)
SELECT doc_id, size, source_size, target,
       sum(CASE WHEN running <= (SELECT sum(size) FROM sized) THEN size ELSE 0 END)::BIGINT AS taken
FROM run GROUP BY doc_id, size, source_size, target
""",
}
