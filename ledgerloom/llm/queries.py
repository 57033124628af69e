"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.centroid_clustering import cluster_vectors
from ledgerloom.llm.common import table, text_of
from ledgerloom.llm.fingerprints import as_text, edited_text, fingerprint_documents, likeness, with_next
from ledgerloom.llm.hard_negatives import hard_negatives
from ledgerloom.llm.html_content import extract_content
from ledgerloom.llm.jaccard_join import similar_documents
from ledgerloom.llm.language_id import identify_languages, train_languages
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.piece_bpe import decode_documents, encode_documents
from ledgerloom.llm.secret_automaton import BASE_RULES, find_secrets
from ledgerloom.llm.sharding import interleaved_shards
from ledgerloom.llm.source_mixing import mix_sources
from ledgerloom.llm.url_cascade import judge_urls
from ledgerloom.llm.vector_search import top_k

URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of the base kinds, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs).drop("text")
    kinds = [rule.kind for rule in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("bigint")

    base = F.filter("spans", lambda x: x.kind.isin(*kinds))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(_joined_spans(base), 256).alias("base_sha256"),
        _joined_spans(F.col("spans")).alias("spans"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, compared with each other and
    with the next document's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    # Sketches are made after the exchange, also the next text's: they don't compress.
    docs = with_next(docs, "doc_id", ["text"])
    docs = docs.withColumn("edited", edited_text(F.col("text"), F.col("_next_text")))
    docs = fingerprint_documents(fingerprint_documents(docs), "_next_text", "_next_sketch")
    docs = fingerprint_documents(docs, "edited", "edited_sketch")
    return docs.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("_next_sketch"), F.col("text") == F.col("_next_text")).alias("near_next"),
    )


def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0, 5)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of 4096."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    digest = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(*digest, "sequence_tokens")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    # A null id has no checksum and is not held out.
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = train_languages(docs.where(~F.col("held_out")))
    return identify_languages(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_content(pages).select("page_id", "url", "text", "n_chars")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source: the words that the mix takes of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix_sources(docs)
    every = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("_row")
    return mixed.select("*", every).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
        "source",
        "copies",
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest one that similarity links can reach."""
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), 75)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, through the cascades."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, row counts at most one apart, sources mixed alike."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text_of()) + 8).cast("bigint").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
    )
    placed = interleaved_shards(docs, 24, tie_columns=["text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, and the text that these are decoded to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    # Ids take the place of the text, and the decoded text that of the ids: nothing that is
    # not needed any more goes through the tasks' Python and back.
    ids = encode_documents(docs, path, out="text").withColumnRenamed("text", "ids").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    decoded = decode_documents(ids, path, out="ids").withColumnRenamed("ids", "decoded")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five hardest negatives in the window of each positive of each anchor."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("id") % 100 == 0)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after ten rounds with eight centroids."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cluster_vectors(vectors).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_vector_search": op2_vector_search,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_language_id": op5_language_id,
    "op6_html_extract": op6_html_extract,
    "op7_source_mix": op7_source_mix,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_url_filter": op9_url_filter,
    "op10_sharding": op10_sharding,
    "op11_piece_codec": op11_piece_codec,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_centroids": op13_centroids,
}

def _centroid_sql(rounds: int = 10) -> str:
    """Rounds of assigning and moving, one pair of steps after the other."""
    nearest = """a{i} AS MATERIALIZED (
            SELECT vec_id, any_value(v) AS v,
                   min((list_dot_product(v, v) - 2 * list_dot_product(v, m) + list_dot_product(m, m))::BIGINT * 8 + c) AS best
            FROM kept, c{i} GROUP BY vec_id)"""
    moved = """s{i} AS (
            SELECT best % 8 AS c, unnest(v)::BIGINT AS x, generate_subscripts(v, 1) AS d FROM a{i}),
        f{i} AS (SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM s{i} GROUP BY c, d),
        c{j} AS MATERIALIZED (
            SELECT c{i}.c, coalesce(any_value(g.m), any_value(c{i}.m)) AS m
            FROM c{i} LEFT JOIN (
                SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY d) AS m FROM f{i} GROUP BY c) g
            ON g.c = c{i}.c GROUP BY c{i}.c)"""
    steps = [f.format(i=i, j=i + 1) for i in range(rounds) for f in (nearest, moved)] + [nearest.format(i=rounds)]
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v AS m
            FROM kept ORDER BY 1 LIMIT 8),
        {", ".join(steps)}
        SELECT vec_id, (best % 8)::INTEGER AS cluster, best // 8 AS distance,
               (sum(best // 8) OVER (PARTITION BY best % 8))::BIGINT AS cluster_inertia,
               (sum(best // 8) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(list_transform(m, lambda x: x::BIGINT), ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c = best % 8"""


SQL: dict[str, str] = {
    "op12_hard_negatives": """
        WITH usable AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        scored AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_dot_product(a.v, c.v)::BIGINT AS score
            FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
        positive AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        placed AS (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
            FROM positive JOIN scored USING (anchor_id)
            WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, place::INTEGER AS "rank", negative_id, positive_score, negative_score
        FROM placed WHERE place <= 5""",
    "op13_centroids": _centroid_sql(),
    "op2_vector_search": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
        SELECT query_id, place::INTEGER AS "rank", vec_id, score FROM ranked WHERE place <= 5""",
    "op9_url_filter": """
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
            END AS rule
            FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
}
