"""Registered queries: each operator over its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm import (
    byte_bpe, collocations, hard_negatives, language, line_crf, line_dedup, minhash, mixing, packing, quality_rules, secrets, tokens, vectors,
)
from gridtide.llm.common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the texts that people marked as good and not toxic."""
    return table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select(F.col("doc_id").alias("id"))


def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > 512)


def op3_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted(spark, sf_dir))


def op5_embedding_near_dedup(spark, sf_dir):
    return vectors.vector_duplicates(table(spark, sf_dir, "embeddings"))


def op6_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("ids")


def op7_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"), lambda i: fold(i, 5) != 0)
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return line_crf.score(docs, model, "doc_id", "text", held_out)


def op8_line_dedup(spark, sf_dir):
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, fold(F.col("doc_id"), 4) != 2)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return language.identify(docs, model, "doc_id", "text", held_out)


def op10_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_byte_bpe(spark, sf_dir):
    encoded = byte_bpe.encode_documents(table(spark, sf_dir, "documents"))
    decoded = byte_bpe.decode_ids(encoded.select("doc_id", "n_tokens", byte_bpe.digest("ids").alias("ids_sha256"), "ids"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_collocations(spark, sf_dir):
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_minhash_near_dedup, op2_token_counts, op3_mixing, op4_quality_rules, op5_embedding_near_dedup,
        op6_packing, op7_quality_classifier, op8_line_dedup, op9_language_id, op10_secret_scan,
        op11_hard_negatives, op12_byte_bpe, op13_collocations,
    )
}

_REACH = """
reach(a, b) AS (
    SELECT x, y FROM links UNION SELECT y, x FROM links
    UNION SELECT r.a, e.b FROM reach r JOIN (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links) e ON r.b = e.a
),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""

SQL = {
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE
        WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i : concat(w[i], ' ', w[i + 1], ' ', w[i + 2])) END)) AS s
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
),
""" + _REACH + """
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON a = d.doc_id
""",
    "op5_embedding_near_dedup": """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x : x <> 0)) > 0
),
links AS (
    SELECT p.vec_id AS x, q.vec_id AS y FROM usable p JOIN usable q
    ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.v) = len(q.v)
    WHERE list_cosine_similarity(p.v, q.v) >= 0.98
),
""" + _REACH + """,
degree AS (SELECT a, count(*) AS n FROM (SELECT x AS a FROM links UNION ALL SELECT y FROM links) GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN least ON least.a = vec_id
""",
    # Pages are distinct texts; those that near copies (five words, 0.8) connect count as one.
    "op8_line_dedup": r"""
WITH RECURSIVE texts AS (SELECT page, row_number() OVER (ORDER BY page) AS id FROM (SELECT DISTINCT coalesce(text, '') AS page FROM documents)),
words AS (
    SELECT id, regexp_extract_all(
        translate(page, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM texts
),
shingles AS (
    SELECT id, unnest(list_distinct(CASE
        WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i:i + 4], ' ')) END)) AS s
    FROM words
),
amounts AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (SELECT a.id AS x, b.id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN amounts p ON p.id = x JOIN amounts q ON q.id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
),
""" + _REACH + r""",
pages AS (SELECT t.page AS body, least(t.id, coalesce(b, t.id)) AS page FROM texts t LEFT JOIN least ON a = t.id),
cut AS (
    SELECT doc_id, source, page, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents JOIN pages ON body = coalesce(text, '')
),
lines AS (SELECT *, trim(line, concat(' ', chr(9), chr(11), chr(12), chr(13))) AS core FROM cut),
counted AS (SELECT source, core, count(DISTINCT page) AS n FROM lines WHERE core <> '' GROUP BY source, core),
sites AS (SELECT source, count(DISTINCT page) AS pages FROM documents JOIN pages ON body = coalesce(text, '') GROUP BY source),
bad AS (
    SELECT c.source, core FROM counted c JOIN sites s ON c.source IS NOT DISTINCT FROM s.source
    WHERE n >= 5 AND n > 0.01 * pages
),
marked AS (
    SELECT l.*, b.core IS NOT NULL AS gone FROM lines l
    LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.core = b.core
),
cleaned AS (
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
        count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, d.source, c.text, coalesce(n_lines, 1) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN cleaned c ON c.doc_id = d.doc_id
""",
    "op11_hard_negatives": """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x : floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
),
ranked AS (
    SELECT p.anchor_id, positive_id, positive_score, n.other_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other_id) AS r
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    WHERE 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 5
""",
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i : array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3), (4), (5)) AS sizes(k) WHERE len(w) >= k
),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 100),
cuts AS (
    SELECT c.*, t.n, cut, l.f AS l, r.f AS r, CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
    FROM candidates c JOIN totals t USING (lang) JOIN (VALUES (1), (2), (3), (4)) AS places(cut) ON cut < c.k
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
    SELECT * FROM scored s WHERE NOT EXISTS (
        SELECT 1 FROM candidates h WHERE h.lang = s.lang AND h.k > s.k AND h.a >= s.a
        AND contains(concat(' ', h.phrase, ' '), concat(' ', s.phrase, ' '))
    )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept QUALIFY rank <= 2000
""",
}
