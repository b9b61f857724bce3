"""The operators' registered queries, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, language, merkle, neardup, packing, pieces, secrets, sharding, substrings, syncmers, tokenstore, toxicity, transport

TOXIC_FROM = 0.5


def tokenizer_file(name: str) -> str:
    """Where the public tokenizers' file lies; each process asks for itself."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose crc32 of the id as text leaves 1 modulo 3 (a null id: not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 40)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.token_store(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), chain)
    return scored.select("doc_id", (F.col("p_toxic") > TOXIC_FROM).alias("toxic"), "p_toxic", "p_severe", "p_low_quality")


def op5_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = pieces.with_pieces(docs, tokenizer_file("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        (F.octet_length("piece_ids") / 4).cast("long").alias("n_ids"),
        F.crc32("piece_ids").alias("ids_crc32"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op7_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = transport.with_transport_stream(table(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.octet_length("payload")
    return stored.select(
        "doc_id",
        "n_bytes",
        size.cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.to_json("entry_points").alias("entry_points"),
    )


def op8_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_by_retrieval(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language.fit_language(docs.where(~held_out()))
    return language.with_language(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def op11_secret_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, secrets.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


ALL = (
    op1_sharding, op2_token_store, op3_circulant_minhash, op4_toxicity_chain, op5_piece_transducer, op6_substring_dedup, op7_transport_stream,
    op8_retrieval_packing, op9_byte_network, op10_syncmers, op11_secret_layers, op12_merkle_manifest, op13_token_alignment,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


_SHINGLES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
lowest AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(lowest.b, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(lowest.b, doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN lowest USING (doc_id)"""

_REPEATS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s+34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM w WHERE len(ws) >= 35)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM win SEMI JOIN twice USING (k)),
each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    return table


_SHARDS = f"""
WITH bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
  list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)) AS b FROM documents),
sized AS (SELECT doc_id, size::BIGINT AS size, xor(list_reduce(b, lambda c, v: xor(c >> 8, ({_crc_table()}::UINTEGER[])[(xor(c, v) & 255) + 1]::BIGINT)), 4294967295) AS text_crc32 FROM bytes),
summed AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM sized),
placed AS (SELECT *, least(39, floor((upto - size / 2) / total * 40))::INTEGER AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, NULL::INTEGER AS grown_shard FROM placed"""


_FRAMED = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FRAMED.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_CRC_EVEN = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, v: xor(c >> 8, ({_crc_table()}::UINTEGER[])[(xor(c, v) & 255) + 1]::BIGINT)), 4294967295) % 2 = 0"
_TREE = """
{name} AS (
  SELECT tree, 0 AS level, i, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i, h, count(*) OVER (PARTITION BY tree)
  FROM (SELECT tree, level, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name} WHERE n > 1 GROUP BY tree, level, i // 3))"""
_CLIMB = """
{name} AS (
  SELECT doc_id, {start}
  UNION ALL
  SELECT c.doc_id, c.tree, level + 1, c.i // 3, proof || r.b || r.a, sha256(r.b || fold || r.a)
  FROM {name} c, LATERAL (SELECT coalesce(string_agg(h, '' ORDER BY t.i) FILTER (t.i < c.i), '') AS b, coalesce(string_agg(h, '' ORDER BY t.i) FILTER (t.i > c.i), '') AS a, max(n) AS n
    FROM {tree} t WHERE t.tree = c.tree AND t.level = c.level AND t.i // 3 = c.i // 3) r WHERE r.n > 1),
{name}_end AS (SELECT doc_id, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold FROM {name} GROUP BY doc_id)"""
_MANIFEST = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, {_LEAF.format(text="text")} AS h,
    CASE WHEN {_CRC_EVEN} THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text="text")} END AS seen FROM documents),
{_TREE.format(name="low", leaves="leaf")},
sub AS (SELECT 0 AS tree, tree AS i, h FROM low WHERE n = 1),
{_TREE.format(name="high", leaves="sub")},
{_CLIMB.format(name="up", tree="low", start="tree, 0 AS level, i, '' AS proof, seen AS fold FROM leaf")},
{_CLIMB.format(name="over", tree="high", start="0 AS tree, 0 AS level, leaf.tree AS i, proof, fold FROM up_end JOIN leaf USING (doc_id)")},
whole AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf.h AS leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM leaf JOIN sub ON sub.i = leaf.tree JOIN over_end USING (doc_id), whole"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it at the size of the check: shards, near-duplicate classes, repeated windows, the manifest."""
    return {"op1_sharding": _SHARDS, "op3_circulant_minhash": _SHINGLES, "op6_substring_dedup": _REPEATS, "op12_merkle_manifest": _MANIFEST}
