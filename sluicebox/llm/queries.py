"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluicebox.llm import clustering, decontamination, html, language_model, languages, merkle, near_duplicates, packing, substrings, token_counts, topk, toxicity, warc
from sluicebox.llm.common import importable, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        decontamination.items_digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.fit_and_score(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), spark)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "text", "removed", F.size("removed").cast("bigint").alias("n_removed"),
        F.expr("aggregate(removed, 0L, (n, s) -> n + s.end - s.begin)").alias("removed_chars"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return languages.predict(docs, languages.fit(docs))


_QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1_decontamination,
    "op2_html_text": op2_html_text,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_packing": op6_packing,
    "op7_language_model": op7_language_model,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_topk": op10_topk,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_language_id": op13_language_id,
}
QUERIES = {name: importable(query) for name, query in _QUERIES.items()}



def _merkle_sql(levels: int = 7) -> str:
    """Trees of up to 16 ** `levels` leaves, a level at a time; a node that is alone passes as it is."""
    coded = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(coded(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ctes = [f"""
        d AS (
            SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(f"translate(text, '{capitals}', '{capitals.lower()}')")} AS lowered,
                   xor(list_reduce([4294967295] || [CAST(ord(c) AS BIGINT) for c in string_split(CAST(doc_id AS VARCHAR), '')],
                       lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 5 = 0 AS tampered
            FROM documents
        ), g AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)),
        a0 AS (
            SELECT tree, d.*, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k
            FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
        ), n0 AS (SELECT tree, k, leaf AS digest FROM a0)"""]
    # nK: nodes after K levels; fK: of each leaf its fold so far and the siblings that it met
    fold = "f0 AS (SELECT tree, k AS leaf_no, k, CASE WHEN tampered THEN lowered ELSE leaf END AS node, '' AS proof FROM a0)"
    ctes.append(fold)

    def climb(tag: str, level: int) -> None:
        n, f = f"{tag}n{level}", f"{tag}f{level}"
        up_n, up_f = f"{tag}n{level + 1}", f"{tag}f{level + 1}"
        ctes.append(f"""
        {up_n} AS (
            SELECT tree, k // 16 AS k, CASE WHEN any_value(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY k)) END AS digest
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {n}) GROUP BY tree, k // 16
        ), {up_f} AS (
            SELECT f.tree, f.leaf_no, f.k // 16 AS k,
                   CASE WHEN count(*) = 1 AND NOT bool_or(s.size > 1) THEN any_value(f.node)
                        ELSE sha256(string_agg(CASE WHEN s.k = f.k THEN f.node ELSE s.digest END, '' ORDER BY s.k)) END AS node,
                   any_value(f.proof) || coalesce(string_agg(CASE WHEN s.k <> f.k THEN s.digest END, '' ORDER BY s.k), '') AS proof
            FROM {f} AS f JOIN (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {n}) AS s
              ON s.tree = f.tree AND s.k // 16 = f.k // 16
            GROUP BY f.tree, f.leaf_no, f.k
        )""")

    for level in range(levels):
        climb("", level)
    ctes.append(f"""
        tn0 AS (SELECT 0 AS tree, tree AS k, digest FROM n{levels}),
        tf0 AS (SELECT 0 AS tree, CAST(tree AS VARCHAR) || ' ' || leaf_no AS leaf_no, tree AS k, node, proof FROM f{levels})""")
    for level in range(3):
        climb("t", level)
    return f"""
        WITH {','.join(ctes)}
        SELECT a0.doc_id, a0.leaf, n{levels}.digest AS subroot, tn3.digest AS root, sha256(tf3.proof) AS proof_sha256,
               tf3.node AS folded_root, tf3.node = tn3.digest AS verified
        FROM a0 JOIN n{levels} ON n{levels}.tree = a0.tree CROSS JOIN tn3
        JOIN tf3 ON tf3.leaf_no = CAST(a0.tree AS VARCHAR) || ' ' || a0.k
    """


def _clusters_sql(rounds: int = 3) -> str:
    ctes = ["""
        v AS (
            SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS z
            FROM embeddings
            WHERE len(embedding) = 64 AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), z) - 1 AS c, z AS m FROM v
            WHERE vec_id IS NOT NULL ORDER BY c LIMIT 16
        )"""]
    for k in range(rounds + 1):
        ctes.append(f"""
        a{k} AS (
            SELECT v.r, min({{'d': CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.z, c.m)]) AS BIGINT), 'c': c.c}}) AS near
            FROM v CROSS JOIN c{k} AS c GROUP BY v.r
        ), s{k} AS (
            SELECT near.c AS c, i, sum(z[i]) AS s, count(*) AS n FROM a{k} JOIN v USING (r), unnest(range(1, 65)) AS u(i) GROUP BY near.c, i
        ), c{k + 1} AS (
            SELECT c.c, coalesce(any_value(l.m), any_value(c.m)) AS m FROM c{k} AS c LEFT JOIN (
                SELECT c, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY i) AS m FROM s{k} GROUP BY c
            ) AS l ON l.c = c.c GROUP BY c.c
        )""")
    return f"""
        WITH {','.join(ctes)}
        SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance,
               CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (r) JOIN c{rounds} AS c ON c.c = near.c
    """


ORACLES: dict[str, str] = {
    "op12_centroid_clustering": _clusters_sql(),
    "op11_merkle_manifest": _merkle_sql(),
    "op10_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS z
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_sum([p[1] * p[2] for p in list_zip(q.z, v.z)]) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
        ), k AS (SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html)
        SELECT page_id, url, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN keeper IS DISTINCT FROM page_id AND keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keeper IS DISTINCT FROM page_id THEN keeper END AS refers_to
        FROM p LEFT JOIN k ON p.html = k.html AND p.n >= 1000
    """,
}
