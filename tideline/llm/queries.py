"""The operators over their whole tables, each beside its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    centroid_clusters,
    embedding_dedup,
    fill_in_middle,
    fingerprints,
    html_extraction,
    license_scan,
    mixing,
    piece_encoding,
    quality,
    simhash_dedup,
    substring_dedup,
    surrogates,
    token_output,
)
from tideline.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _listed(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


ORACLES["op1_embedding_near_dedup"] = (
    "WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), "
    "usable AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
    "AND len(list_filter(e, lambda x: x <> 0)) > 0), "
    "links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b ON a.vec_id <> b.vec_id "
    f"AND list_cosine_similarity(a.e, b.e) >= {embedding_dedup.THRESHOLD}), "
    "reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a), "
    "components AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), "
    "counts AS (SELECT a, count(*) AS n FROM links GROUP BY a) "
    "SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v "
    "JOIN components ON vec_id = components.a LEFT JOIN counts ON vec_id = counts.a"
)

ORACLES["op3_substring_dedup"] = (
    r"WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents), "
    "windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM "
    "(SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)), "
    "firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k), "
    "hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE f < doc_id), "
    "covered AS (SELECT DISTINCT doc_id, i + j AS p FROM hits, range(13) AS r(j)), "
    "words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs), "
    "kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id), "
    "gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id) "
    "SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 "
    "FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"
)

_PHRASES = ", ".join(f"({_listed(p.split())}, '{label}')" for p, label in license_scan.PHRASES.items())
_TEMPLATES = ", ".join(
    f"({_listed(sorted(w.decode() for w in set(license_scan.words_of(text.encode()))))}, '{label}', {license_scan.span_of(text)})"
    for label, text in license_scan.TEMPLATES
)
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLES["op5_license_scan"] = (
    "WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') "
    f"AS t FROM documents), docs AS (SELECT doc_id, regexp_extract_all(t, '{_LICENSE_WORD}') AS w FROM low), "
    f"phrases(p, label) AS (VALUES {_PHRASES}), templates(p, label, span) AS (VALUES {_TEMPLATES}), spans AS (SELECT DISTINCT span FROM templates), "
    "starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs), "
    "places AS (SELECT doc_id, i - 1 AS spot, label FROM starts JOIN phrases ON w[i] = p[1] AND w[i:i + len(p) - 1] = p), "
    "base AS (SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, "
    "list_sort(list_distinct(list(label))) AS labels FROM places GROUP BY doc_id), "
    "lines AS (SELECT doc_id, regexp_extract_all(line, "
    f"'{_LICENSE_WORD}') AS w FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM low)), "
    "runs AS (SELECT doc_id, w FROM lines UNION ALL SELECT doc_id, w FROM docs), "
    "blocks AS (SELECT DISTINCT doc_id, span, w[k + 1:k + span] AS b FROM "
    "(SELECT doc_id, w, span, unnest(range(0, greatest(1, len(w) - span // 2), span // 2)) AS k FROM runs, spans) WHERE len(w) > 0), "
    "shares AS (SELECT doc_id, label, CAST(len(list_intersect(b, p)) AS DOUBLE) / len(p) AS c FROM blocks JOIN templates USING (span)), "
    f"notices AS (SELECT doc_id, list(DISTINCT label) AS labels, max(c) AS c FROM shares WHERE c >= {license_scan.THRESHOLD} "
    "GROUP BY doc_id) "
    "SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, "
    "coalesce(array_to_string(base.labels, ','), '') AS base_labels, "
    "array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(notices.labels, [])))), ',') AS labels, "
    "CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score "
    "FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN notices USING (doc_id)"
)

ORACLES["op12_fill_in_middle"] = (
    "WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents), "
    "drawn AS (SELECT doc_id, t, length(t) AS n, "
    + ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    + " FROM docs), cuts AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, "
    "CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' "
    "WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn), "
    "pieces AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts), "
    "outputs AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m "
    "ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM pieces) "
    "SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, "
    "sha256(o) AS output_sha256, sha256(CASE form WHEN 'plain' THEN o ELSE p || m || s END) AS restored_sha256 FROM outputs"
)


def _clusters_sql(clusters: int, rounds: int, dimensions: int, scale: int) -> str:
    """Every round as tables of its own: ``c`` the centroids by number, ``n`` each vector's least (distance, number)."""
    distance = f"list_sum(list_transform(range(1, {dimensions + 1}), lambda i: (u.p[i] - c.p[i]) * (u.p[i] - c.p[i])))::BIGINT"
    tables = [
        "v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
        f"usable AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(e, lambda x: TRY_CAST(floor({scale} * x) AS BIGINT)) AS p "
        f"FROM v WHERE len(e) = {dimensions} AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "c0 AS MATERIALIZED (SELECT k, p FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), p) - 1 AS k, p "
        f"FROM usable) WHERE k < {clusters})",
    ]
    for r in range(rounds + 1):
        tables.append(
            f"n{r} AS MATERIALIZED (SELECT rid, min({{'d': d, 'k': k}}) AS b FROM (SELECT u.rid, c.k, {distance} AS d FROM usable AS u, c{r} AS c) GROUP BY rid)"
        )
        if r < rounds:
            tables.append(
                f"m{r} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS p FROM (SELECT k, pos, sum(x) AS s, count(*) AS n FROM "
                f"(SELECT b.k AS k, unnest(p) AS x, generate_subscripts(p, 1) AS pos FROM usable JOIN n{r} USING (rid)) GROUP BY k, pos) GROUP BY k)"
            )
            tables.append(f"c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.p, c.p) AS p FROM c{r} AS c LEFT JOIN m{r} AS m ON c.k = m.k)")
    return (
        f"WITH {', '.join(tables)} SELECT vec_id, b.k::INTEGER AS cluster, b.d AS distance, (sum(b.d) OVER (PARTITION BY b.k))::BIGINT AS cluster_inertia, "
        f"(sum(b.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256 "
        f"FROM usable JOIN n{rounds} USING (rid) JOIN c{rounds} AS c ON c.k = b.k"
    )


ORACLES["op13_centroid_clusters"] = _clusters_sql(
    centroid_clusters.CLUSTERS, centroid_clusters.ROUNDS, centroid_clusters.DIMENSIONS, centroid_clusters.SCALE
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash_dedup.hexadecimal(F.col("fingerprint")))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digest(_read(spark, sf_dir, "documents"))


@query
def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-ids")
    token_output.write_tokens(_read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_tokens(spark, folder, with_ids=False)


@query
def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_pieces(
        _read(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spans_sha256"),
    )


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_read(spark, sf_dir, "documents")).drop("notices")


@query
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_edits(_read(spark, sf_dir, "documents"))
    shown = {c: fingerprints.hexadecimal(F.col(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(shown)


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_read(spark, sf_dir, "embeddings"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return surrogates.replace_entities(docs, report="entities").select("doc_id", "text", "entities")


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(_read(spark, sf_dir, "pages"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return fill_in_middle.fill_in_middle(_read(spark, sf_dir, "documents"), outputs=digests)


@query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.centroid_clusters(_read(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
