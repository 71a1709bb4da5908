"""One query per operator over its whole table; SQL that expects the same result where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.llm import embdup, fingerprints, forest, language, mixing, neardup, negatives, packing, pages, passages, secrets, substrings, whitening
from arborflow.llm.common import table


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: counts and digest of the plain patterns, and all spans with those of decoded layers."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    plain = F.filter("secret_spans", lambda s: s["depth"] == 0)

    def count(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(digest(plain), 256).alias("base_sha256"), digest(F.col("secret_spans")).alias("spans"), "cut_layers")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.nearest(vectors, vectors.where("vec_id % 50 = 0"), top=5)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without strings of 50 bytes that a smaller document has."""
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 tokens."""
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return pieces.select("doc_id", "start", "length", packing.crc32_of(F.col("ids")).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix with weights 5, 2, 1 takes of each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP5_SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source
), w AS (
    SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 3.0::DOUBLE * source_size AS most FROM s
), l AS (
    SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(weight) OVER (ORDER BY most / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after, sum(source_size) OVER () AS total
    FROM w
), t AS (
    SELECT source, source_size, least(most, max((total - before) / after) OVER () * weight) AS target FROM l
), p AS (
    SELECT d.doc_id, d.size, d.source, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS ratio,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS nth
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (SELECT unnest(range(32)) AS k), u AS (
    SELECT t.source, t.target, k.k, CAST('0x' || substr(md5('7:' || k.k || ':' || coalesce(t.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM t, k
), c AS (
    SELECT p.source, u.k, u.u, abs(sum(size * (floor((nth + 1) * ratio + u.u) - floor(nth * ratio + u.u))) - any_value(p.target)) AS miss
    FROM p JOIN u ON p.source IS NOT DISTINCT FROM u.source GROUP BY p.source, u.k, u.u
), b AS (SELECT source, u FROM c QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, k) = 1)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(p.size * (floor((nth + 1) * ratio + b.u) - floor(nth * ratio + b.u)) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate passages of 50 words and more over all documents."""
    return passages.near_passages(table(spark, sf_dir, "documents"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents by shingles of four words."""
    return neardup.link(table(spark, sf_dir, "documents"), words=4, percent=80)


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-sensitive fingerprints of every text, of its edit, and how alike they are."""
    return fingerprints.edits(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by models of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.where("not held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 8 components of the whole table."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), top=8)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 100; rows with an id divisible by 7 carry the next label."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0, positives=5, top=5, low=80, high=100)


_SOUND = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"
OP12_SQL = f"""
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(CAST(c AS DOUBLE) * 256)) AS x
    FROM embeddings WHERE label IS NOT NULL AND {_SOUND}
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
        s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
)
SELECT * FROM n WHERE rank <= 5
"""


def op13_embdup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of the same label among all vectors."""
    return embdup.link(table(spark, sf_dir, "embeddings"), least=0.98)


OP13_SQL = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE {_SOUND} AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), p AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached(id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, p.b FROM reached r JOIN p ON r.other = p.a
), c AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id), n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = id AS kept FROM c LEFT JOIN n ON n.a = c.id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_nearest": op2_nearest,
    "op3_substrings": op3_substrings,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_passages": op6_passages,
    "op7_neardup": op7_neardup,
    "op8_pages": op8_pages,
    "op9_fingerprints": op9_fingerprints,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_negatives": op12_negatives,
    "op13_embdup": op13_embdup,
}
SQL: dict[str, str] = {"op5_mixing": OP5_SQL, "op12_negatives": OP12_SQL, "op13_embdup": OP13_SQL}
