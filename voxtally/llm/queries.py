"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxtally.llm.binary_search import search, sign_codes
from voxtally.llm.common import crc_of_id, table
from voxtally.llm.exact_duplicates import exact_duplicates
from voxtally.llm.fingerprints import compare_with_next
from voxtally.llm.hadamard import cluster_vectors
from voxtally.llm.languages import detect_languages, fit_languages
from voxtally.llm.merkle import build_manifest, fold, proof_text, row_digest
from voxtally.llm.mixing import mix_sources
from voxtally.llm.near_duplicates import near_duplicates
from voxtally.llm.packing import pack
from voxtally.llm.passages import repeated_passages
from voxtally.llm.quality import fit_quality, score_quality
from voxtally.llm.secrets import as_text, fit_on_documents, scan_secrets
from voxtally.llm.warc import read_archives, save_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op10_near_duplicates", """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM split),
sized AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN sized x ON x.doc_id = p.a JOIN sized y ON y.doc_id = p.b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN sized s ON s.doc_id = d.doc_id LEFT JOIN least_id l ON l.a = d.doc_id
""")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op9_languages")
def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 4 == 2
    model = fit_languages(docs.where(~held_out))
    return detect_languages(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"))


@query("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, fit_on_documents(docs))
    kind = lambda name: F.size(F.filter("secrets", lambda s: s["kind"] == name)).cast("bigint")
    return found.select(
        "doc_id", kind("assign").alias("n_assign"), kind("access").alias("n_access"), kind("hex").alias("n_hex"),
        F.sha2(as_text(F.filter("secrets", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        as_text(F.col("secrets")).alias("spans"), kind("random").alias("n_random"))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * block + 1}, 5))::INT >> {15 - 5 * i}) & 31), 1)"
    for block in range(8) for i in range(4))


@query("op6_warc", f"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS f FROM hashed GROUP BY h)
SELECT page_id, size::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM hashed JOIN firsts USING (h)
""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = save_archives(write_archives(table(spark, sf_dir, "pages")))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _half(first: int) -> str:
    return (f"list_sum(list_transform(range({first}, {first + 32}), "
            f"lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1::BIGINT << (i - {first}) ELSE 0 END))::BIGINT")


@query("op7_nearest_codes", f"""
WITH codes AS (SELECT vec_id, {_half(0)} AS lo, {_half(32)} AS hi FROM embeddings WHERE len(embedding) = 64),
ranked AS (
  SELECT q.vec_id AS query_id, v.vec_id, bit_count(xor(q.lo, v.lo)) + bit_count(xor(q.hi, v.hi)) AS distance
  FROM codes q JOIN codes v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM ranked)
SELECT query_id, vec_id, rank, distance::BIGINT AS distance FROM numbered WHERE rank <= 10
""")
def op7_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select("vec_id", sign_codes("embedding").alias("code"))
    return search(codes, codes.where("vec_id % 100 = 0"))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id("doc_id") % 3 == 1
    model = fit_quality(docs, labels.where(~held_out))
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


@query("op1_mixing", """
WITH RECURSIVE numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS r FROM documents),
counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
sized AS (SELECT source, (n + 3) // 4 AS n FROM counts),
weighed AS (SELECT source, n::HUGEINT AS n, least(n * 100, (sum(n) OVER ())::BIGINT * 25)::HUGEINT AS w FROM sized),
deep AS (SELECT *, len(list_filter(range(0, 62), lambda e: w * (1::HUGEINT << e::INT) < whole)) AS d
  FROM (SELECT *, (sum(w) OVER ())::HUGEINT AS whole FROM weighed)),
widths AS (SELECT *, max(d) OVER () AS deepest FROM deep),
ranked AS (SELECT *, row_number() OVER (ORDER BY d, source NULLS FIRST) AS i,
  (sum(1::BIGINT << (deepest - d)::INT) OVER (ORDER BY d, source NULLS FIRST))::BIGINT - (1::BIGINT << (deepest - d)::INT) AS code FROM widths),
climbs AS (SELECT i, n, w, l, code >> l::INT AS node FROM (SELECT *, unnest(range(deepest - d, deepest)) AS l FROM ranked)),
nodes AS (SELECT l, node, sum(n)::HUGEINT AS n, sum(w)::HUGEINT AS w FROM climbs GROUP BY l, node),
steps AS (
  SELECT c.i, c.l, a.node % 2 AS late, a.w AS own, a.w + b.w AS whole, b.n AS other
  FROM climbs c JOIN nodes a ON a.l = c.l AND a.node = c.node
  LEFT JOIN nodes b ON b.l = c.l AND b.node = a.node + 1 - 2 * (a.node % 2)),
blocks AS (
  SELECT i, unnest(range(0, n::BIGINT)) AS block, false AS beyond FROM ranked UNION ALL SELECT i, n::BIGINT, true FROM ranked),
places AS (
  SELECT i, block, beyond, 0 AS l, block::HUGEINT AS p FROM blocks
  UNION ALL
  SELECT c.i, c.block, c.beyond, c.l + 1, CASE WHEN s.other IS NULL THEN c.p
    WHEN c.beyond THEN ((2 * c.p + 1) * s.whole - 1 + s.late) // (2 * s.own)
    ELSE least(((2 * c.p + 1) * s.whole - 1 + s.late) // (2 * s.own), s.other + c.p) END
  FROM places c LEFT JOIN steps s ON s.i = c.i AND s.l = c.l WHERE c.l < 62),
slots AS (SELECT i, block, beyond, p::BIGINT AS slot FROM places WHERE l = 62),
horizon AS (SELECT min(slot) AS horizon FROM slots WHERE beyond)
SELECT d.doc_id, d.source, d.r // 8 AS block, d.r % 8 AS place, s.slot, s.slot < h.horizon AS in_mix
FROM numbered d JOIN ranked k ON k.source IS NOT DISTINCT FROM d.source
JOIN slots s ON s.i = k.i AND s.block = d.r // 4 AND NOT s.beyond, horizon h
""")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op5_passages")
def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op11_exact_duplicates", r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
equal AS (SELECT t, min(doc_id) AS keep_id, count(*) AS n FROM normal GROUP BY t)
SELECT doc_id, keep_id, n::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM normal JOIN equal USING (t)
""")
def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


MANIFEST_VALUES = ("doc_id", "source", "lang", "n_chars", "text")


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value} END"


def _row_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(v if v != 'text' else text) for v in MANIFEST_VALUES)})"


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op12_merkle_manifest", f"""
WITH RECURSIVE crc_steps AS (
  SELECT list(list_reduce(list_concat([b], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY b) AS step
  FROM (SELECT unnest(range(256))::BIGINT AS b)),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_row_sql('text')} AS leaf,
    CASE WHEN xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, x: xor(c >> 8, step[xor(c & 255, x) + 1])), 4294967295) % 3 = 0 THEN {_row_sql(_LOWER_SQL)} ELSE {_row_sql('text')} END AS start,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place
  FROM documents, crc_steps),
up AS (
  SELECT 0 AS level, tree, place, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT level + 1, tree, place // 8, sha256(string_agg(h, '' ORDER BY place)), (max(n) + 7) // 8
  FROM up WHERE n > 1 GROUP BY level, tree, place // 8),
heights AS (SELECT max(level) AS height FROM up),
tops AS (
  SELECT 1 + height AS level, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, h, count(*) OVER () AS n, tree AS low
  FROM up, heights WHERE n = 1),
above AS (
  SELECT level, tree, place, h, n FROM tops
  UNION ALL
  SELECT level + 1, tree, place // 8, sha256(string_agg(h, '' ORDER BY place)), (max(n) + 7) // 8
  FROM above WHERE n > 1 GROUP BY level, tree, place // 8),
nodes AS (SELECT * FROM up UNION ALL SELECT * FROM above),
way AS (
  SELECT doc_id, 0 AS level, tree, place FROM leaves
  UNION ALL
  SELECT w.doc_id, CASE WHEN x.n > 1 THEN w.level + 1 ELSE t.level END, CASE WHEN x.n > 1 THEN w.tree ELSE '' END,
    CASE WHEN x.n > 1 THEN w.place // 8 ELSE t.place END
  FROM way w JOIN nodes x ON x.level = w.level AND x.tree = w.tree AND x.place = w.place LEFT JOIN tops t ON t.low = w.tree
  WHERE x.n > 1 OR w.tree <> ''),
proofs AS (
  SELECT w.doc_id, string_agg(s.h, '' ORDER BY w.level, s.place) AS proof
  FROM way w JOIN nodes s ON s.level = w.level AND s.tree = w.tree AND s.place // 8 = w.place // 8 AND s.place <> w.place GROUP BY w.doc_id),
folded AS (
  SELECT doc_id, 0 AS level, tree, place, start AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, any_value(CASE WHEN s.n > 1 THEN f.level + 1 ELSE t.level END), any_value(CASE WHEN s.n > 1 THEN f.tree ELSE '' END),
    any_value(CASE WHEN s.n > 1 THEN f.place // 8 ELSE t.place END),
    CASE WHEN max(s.n) > 1 THEN sha256(string_agg(CASE WHEN s.place = f.place THEN f.h ELSE s.h END, '' ORDER BY s.place)) ELSE any_value(f.h) END
  FROM folded f JOIN nodes s ON s.level = f.level AND s.tree = f.tree AND s.place // 8 = f.place // 8 LEFT JOIN tops t ON t.low = f.tree
  WHERE s.n > 1 OR f.tree <> '' GROUP BY f.doc_id, f.level),
ends AS (SELECT doc_id, h FROM folded WHERE tree = '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1),
root AS (SELECT h FROM above WHERE n = 1)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM leaves l JOIN tops t ON t.low = l.tree CROSS JOIN root r JOIN ends e ON e.doc_id = l.doc_id LEFT JOIN proofs p ON p.doc_id = l.doc_id
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    original = row_digest(*[F.col(v) for v in MANIFEST_VALUES])
    tampered = row_digest(*[F.translate(v, upper, upper.lower()) if v == "text" else F.col(v) for v in MANIFEST_VALUES])
    start = F.when(crc_of_id("doc_id") % 3 == 0, tampered).otherwise(original)
    proofs = build_manifest(docs, MANIFEST_VALUES, carry={"start": start}).proofs()
    folded = proofs.withColumn("folded_root", fold(F.col("start"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _rounds_sql(rounds: int) -> str:
    """Assignment and movement of the centres, one pair of expressions per round."""
    nearest = """
  SELECT vec_id, arg_min(i, d * 100 + i) AS cluster, min(d)::BIGINT AS distance
  FROM (SELECT v.vec_id, c.i, list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))::BIGINT AS d
        FROM whole v CROSS JOIN c{k} c) GROUP BY vec_id"""
    moved = """
  SELECT c.i, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
    SELECT cluster, list(y ORDER BY j) AS x FROM (
      SELECT a.cluster, j, floor(sum(v.x[j]) / count(*))::BIGINT AS y
      FROM a{k} a JOIN whole v USING (vec_id), range(1, 65) r(j) GROUP BY a.cluster, j) GROUP BY cluster) m ON m.cluster = c.i"""
    parts = []
    for k in range(rounds + 1):
        parts.append(f"a{k} AS ({nearest.format(k=k)})")
        if k < rounds:
            parts.append(f"c{k + 1} AS ({moved.format(k=k)})")
    return ",\n".join(parts)


@query("op13_hadamard_clusters", f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS i, x FROM whole
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16),
{_rounds_sql(3)}
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
  sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON c.i = a.cluster
""")
def op13_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))
