"""The operators of this subpackage bound to the given tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import alignment, ann, curriculum, manifest, ngram, packing, pieces, quality, secrets, shards, simhash, sketch, warc
from tidemark.sources.tables import read_table


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The place of a vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(read_table(spark, folder, "pages")).drop("payload", "url")


def op2_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_neighbours(read_table(spark, folder, "embeddings"))


def op3_ngram(spark: SparkSession, folder: str) -> DataFrame:
    return ngram.scored(read_table(spark, folder, "documents"))


def op4_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    return curriculum.mixture(read_table(spark, folder, "documents"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest_columns(secrets.find_secrets(read_table(spark, folder, "documents")))


def op6_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shards.sharded(docs).select(
        "record.doc_id", shards.record_bytes("record.text").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.edited_pairs(read_table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read_table(spark, folder, "documents"), tokenizer())


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = quality.scored(docs.select("doc_id", "text"), quality.learn(docs, read_table(spark, folder, "labels")))
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(read_table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(read_table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest(read_table(spark, folder, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_ann": op2_ann,
    "op3_ngram": op3_ngram,
    "op4_curriculum": op4_curriculum,
    "op5_secrets": op5_secrets,
    "op6_shards": op6_shards,
    "op7_sketch": op7_sketch,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_pieces": op11_pieces,
    "op12_alignment": op12_alignment,
    "op13_manifest": op13_manifest,
}

_WEIGHED = """WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, md5(doc_id::VARCHAR) AS h FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
 w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight, 2.0::DOUBLE * n AS cap FROM s),
 o AS (SELECT *, cap / weight AS ratio, (1.5::DOUBLE * sum(n) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own FROM w),
 t AS (SELECT source, n, weight, least(cap, coalesce((SELECT max(own) FROM o WHERE own <= ratio) * weight, cap)) AS target FROM o),
 p AS (SELECT d.*, n, weight, target, CASE WHEN n > 0 THEN floor(target / n) ELSE 1 END AS whole,
   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
   FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
 c AS (SELECT *, whole + CASE WHEN size > 0 AND 2 * start + size <= 2 * (target - whole * n) THEN 1 ELSE 0 END AS copies,
   CASE WHEN target > 0 THEN least(start / target, 1) ELSE 0 END AS u FROM p)"""


def _arrival_sql() -> str:
    """The inverse of each schedule's integral, piece by piece."""
    cases = []
    for weight, knots in curriculum.SCHEDULES.items():
        total = sum((a + b) / 2 * (t1 - t0) for (t0, a), (t1, b) in zip(knots, knots[1:]))
        done, pieces = 0.0, []
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            rest = f"(u * {total!r}::DOUBLE - {done!r}::DOUBLE)"
            pieces.append(f"WHEN {rest} >= 0 THEN {t0!r}::DOUBLE + 2 * {rest} / ({a!r}::DOUBLE + sqrt(greatest({a * a!r}::DOUBLE + {2 * (b - a) / (t1 - t0)!r}::DOUBLE * {rest}, 0)))")
            done += (a + b) / 2 * (t1 - t0)
        cases.append(f"WHEN weight = {weight} THEN CASE {' '.join(reversed(pieces))} END")
    return f"least(greatest(CASE {' '.join(cases)} END, 0), 1)"


def _merkle_sql(levels: int = 20) -> str:
    """Both trees level by level, and every leaf folded level by level; 20 levels of runs of three hold 3.4e9 leaves."""

    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def level(out: str, nodes: str) -> list[str]:
        run = "OVER (PARTITION BY tree, pos // 3 ORDER BY pos)"
        beside = f"coalesce(lag(h, 2) {run}, '') || coalesce(lag(h) {run}, '') AS l, coalesce(lead(h) {run}, '') || coalesce(lead(h, 2) {run}, '') AS r"
        up = f"{out}_up AS MATERIALIZED (SELECT tree, pos // 3 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, (any_value(n) + 2) // 3 AS n FROM {nodes} GROUP BY tree, pos // 3)"
        return [f"{out} AS MATERIALIZED (SELECT tree, pos, n, {beside} FROM {nodes})", up]

    def fold(out: str, rows: str, step: str) -> str:
        return f"{out} AS MATERIALIZED (SELECT f.* REPLACE (f.pos // 3 AS pos, CASE WHEN s.n > 1 THEN sha256(s.l || f.h || s.r) ELSE f.h END AS h, f.path || s.l || s.r AS path) FROM {rows} f JOIN {step} s ON s.tree = f.tree AND s.pos = f.pos)"

    crc = "list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT), lambda a, b: list_reduce([xor(a, b)] || list_transform(range(8), lambda i: 0::UBIGINT), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"
    leaf = f"sha256(concat({', '.join(map(field, manifest.FIELDS))}))"
    changed = leaf.replace("text::VARCHAR", "replace(text, chr(10), '')::VARCHAR")
    ctes = [
        f"d AS MATERIALIZED (SELECT *, {leaf} AS leaf, CASE WHEN doc_id IS NOT NULL AND xor({crc}, 4294967295) % 2 = 0 THEN {changed} ELSE {leaf} END AS h, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM documents)",
        "p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d)",
        "a0_up AS (SELECT tree, pos, leaf AS h, n FROM p)", "f0 AS (SELECT doc_id, leaf, tree, pos, h, '' AS path, tree AS top FROM p)",
    ]
    for i in range(levels):
        ctes += [*level(f"a{i + 1}", f"a{i}_up"), fold(f"f{i + 1}", f"f{i}", f"a{i + 1}")]
    ctes += [f"b0_up AS (SELECT 0 AS tree, tree AS pos, h, count(*) OVER () AS n FROM a{levels}_up)", f"g0 AS (SELECT * REPLACE (0 AS tree, top AS pos) FROM f{levels})"]
    for i in range(levels):
        ctes += [*level(f"b{i + 1}", f"b{i}_up"), fold(f"g{i + 1}", f"g{i}", f"b{i + 1}")]
    return f"""WITH {', '.join(ctes)} SELECT g.doc_id, g.leaf, s.h AS subroot, t.h AS root, sha256(g.path) AS proof_sha256, g.h AS folded_root, g.h = t.h AS verified
        FROM g{levels} g JOIN a{levels}_up s ON s.tree = g.top CROSS JOIN b{levels}_up t"""


SQL: dict[str, str] = {
    "op1_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f""",
    "op4_curriculum": f"""{_WEIGHED} SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, round(target, 6) AS target, CAST(size * copies AS BIGINT) AS taken,
        CASE WHEN copies > 0 THEN round({_arrival_sql()}, 6) END AS first_position FROM c""",
    "op13_manifest": _merkle_sql(),
}
