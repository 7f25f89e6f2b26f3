"""One query per operator of this subpackage, over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm import exact_dedup, hard_negatives, line_dedup, merkle, mixing, near_join, ngram_lm, packing, quality, records, sharding, substring_dedup, suffix_dedup
from postsieve.llm.common import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    files = records.write_sequences(table(spark, sf_dir, "documents"), folder, path, end_id=0)
    found = records.read_sequences(spark, folder, files, with_ids=False)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "record")


def op2_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(table(spark, sf_dir, "documents"))


#: Tokens of a sequence and the id behind each document.
PACK = {"capacity": 4096, "end_id": 1}


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    found = packing.pack(table(spark, sf_dir, "documents"), path, **PACK)
    return found.withColumn("piece", F.col("piece").cast("int")).drop("part", "row")


def op4_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = quality.train_field(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, field).drop("labels")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_lines", F.coalesce(n_removed, F.lit(0)).alias("n_removed"), "removed_words", "removed", "text"
    )


#: Every source has the same share of the mixture, which has as many documents as the table.
MIX = {"weights": None, "epochs": 1.0, "seed": 7}


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), **MIX)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest=True)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_join.near_duplicates(docs, n_words=4, share=(85, 100)).drop("row_key", "group")


N_SHARDS = 8


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sharding.document_sizes(table(spark, sf_dir, "documents"))
    return sharding.shards_by_bytes(sizes, N_SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(hard_negatives.integer_vectors(rows))


#: The manifest's check: rows whose id has a checksum divisible by three come with lower-cased text.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.translate("text", _UPPER, _UPPER.lower())
    found = merkle.manifest(docs, changed, tampered)
    return found.drop("group", "path")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_strings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_trie_scores": op2_trie_scores,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_compact_windows": op4_compact_windows,
    "op5_line_quality": op5_line_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_shards": op10_shards,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLES = {
    # The uniform numbers are hashes of seed, draw and id; the mean here is never above 16 per draw
    # without a further draw, so draws are summed.
    "op7_mix_sources": f"""
        WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (
            SELECT source, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS rate FROM sizes
        ),
        parts AS (SELECT source, rate, greatest(ceil(rate / 16.0), 1) AS draws FROM rates),
        steps AS (
            SELECT source, rate, CAST(draws AS BIGINT) AS draws, k,
                exp(-rate / draws) * list_product(
                    list_prepend(1.0, list_transform(range(1, k + 1), lambda i: rate / draws / i))
                ) AS p
            FROM parts, range(0, {mixing.MAX_COPIES + 1}) AS r(k)
        ),
        reached AS (
            SELECT source, rate, draws, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM steps
        ),
        ladders AS (SELECT source, rate, draws, list(c ORDER BY c) AS cs FROM reached GROUP BY ALL),
        named AS (
            SELECT d.*, l.rate, l.draws, l.cs, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS name
            FROM documents d JOIN ladders l ON d.source IS NOT DISTINCT FROM l.source
        ),
        counted AS (
            SELECT *, CAST(list_sum(list_transform(range(1, draws + 1), lambda j: len(list_filter(cs, lambda c:
                c <= CAST('0x' || substr(md5('{MIX["seed"]}:' || j || ':' || name), 1, 13) AS BIGINT) / {float(1 << 52)}
            )))) AS BIGINT) AS mix_count
            FROM named
        )
        SELECT doc_id, text, lang, source, n_chars, rate AS mix_rate, mix_count, mix_copy,
            md5('order:{MIX["seed"]}:' || mix_copy || ':' || name) AS mix_key
        FROM counted, LATERAL (SELECT unnest(range(0, mix_count)) AS mix_copy)
    """,
    "op8_exact_dedup": r"""
        WITH normal AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ),
        groups AS (
            SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM normal JOIN groups USING (text_sha256)
    """,
    # Checksums bit by bit: a byte is added, then eight steps (-1) are taken.
    "op12_merkle_manifest": f"""
        WITH RECURSIVE given AS (
            SELECT *, list_reduce(
                list_prepend(4294967295, flatten(list_transform(
                    string_split(CAST(doc_id AS VARCHAR), ''),
                    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
                ))),
                lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                    ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END
            ) AS reversed
            FROM documents
        ),
        texts AS (
            SELECT *, CASE WHEN xor(reversed, 4294967295) % 3 = 0
                THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END AS given_text
            FROM given
        ),
        fields AS (
            SELECT doc_id, lang,
                coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-')
                || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                coalesce(strlen(text) || ':' || text, '-') AS body,
                coalesce(strlen(given_text) || ':' || given_text, '-') AS given_body
            FROM texts
        ),
        leaves AS (
            SELECT doc_id, lang, sha256(head || body) AS leaf, sha256(head || given_body) AS given_leaf,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id, sha256(head || body)) - 1 AS pos
            FROM fields
        ),
        nodes AS (
            SELECT lang, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM leaves
            UNION ALL
            SELECT lang, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8
            FROM nodes WHERE n > 1 GROUP BY lang, level, n, pos // 8
        ),
        subroots AS (
            SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
            FROM nodes WHERE n = 1
        ),
        upper_nodes AS (
            SELECT 0 AS level, place AS pos, subroot AS node, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8
            FROM upper_nodes WHERE n > 1 GROUP BY level, n, pos // 8
        ),
        roots AS (SELECT node AS root FROM upper_nodes WHERE n = 1),
        runs AS (
            SELECT lang, level, pos // 8 AS run, list(node ORDER BY pos) AS members
            FROM nodes WHERE n > 1 GROUP BY ALL
        ),
        upper_runs AS (
            SELECT level, pos // 8 AS run, list(node ORDER BY pos) AS members
            FROM upper_nodes WHERE n > 1 GROUP BY ALL
        ),
        folded AS (
            SELECT doc_id, lang, leaf, pos AS leaf_pos, 0 AS level, pos, given_leaf AS node, '' AS siblings
            FROM leaves
            UNION ALL
            SELECT f.doc_id, f.lang, leaf, leaf_pos, f.level + 1, pos // 8,
                sha256(array_to_string(members[:pos % 8], '') || node || array_to_string(members[pos % 8 + 2:], '')),
                siblings || array_to_string(members[:pos % 8], '') || array_to_string(members[pos % 8 + 2:], '')
            FROM folded f JOIN runs r ON f.lang IS NOT DISTINCT FROM r.lang AND f.level = r.level AND f.pos // 8 = r.run
        ),
        at_subroot AS (
            SELECT f.*, subroot, place FROM (
                SELECT * FROM folded QUALIFY level = max(level) OVER (PARTITION BY lang, leaf_pos)
            ) f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang
        ),
        upper_folded AS (
            SELECT doc_id, lang, leaf, leaf_pos, subroot, 0 AS level, place AS pos, node, siblings FROM at_subroot
            UNION ALL
            SELECT doc_id, lang, leaf, leaf_pos, subroot, f.level + 1, pos // 8,
                sha256(array_to_string(members[:pos % 8], '') || node || array_to_string(members[pos % 8 + 2:], '')),
                siblings || array_to_string(members[:pos % 8], '') || array_to_string(members[pos % 8 + 2:], '')
            FROM upper_folded f JOIN upper_runs r ON f.level = r.level AND f.pos // 8 = r.run
        )
        SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, node AS folded_root,
            node = root AS verified
        FROM (
            SELECT * FROM upper_folded QUALIFY level = max(level) OVER (PARTITION BY lang, leaf_pos)
        ), roots
    """,
    "op11_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
                CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        ),
        positives AS (
            SELECT * FROM scores WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
            n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.alike
            AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
        QUALIFY rank <= 3
    """,
    # Bytes as pairs of hex digits.
    "op13_suffix_dedup": """
        WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        pieces AS (
            SELECT doc_id, base, substr(x, 2 * base + 1, 2146) AS piece
            FROM bytes, LATERAL (SELECT unnest(range(0, len(x) // 2 - 49, 1024)) AS base)
        ),
        strings AS (
            SELECT doc_id, base + pos AS pos, substr(piece, 2 * pos + 1, 100) AS s
            FROM pieces, LATERAL (SELECT unnest(range(0, least(1024, len(piece) // 2 - 49))) AS pos)
        ),
        firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
        marked AS (
            SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before
            FROM strings JOIN firsts USING (s) WHERE doc_id > first
        ),
        runs AS (
            SELECT doc_id, pos,
                sum(CASE WHEN before IS NULL OR pos > before + 50 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY doc_id ORDER BY pos) AS run
            FROM marked
        ),
        spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 50 AS b FROM runs GROUP BY doc_id, run),
        gaps AS (
            SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS free FROM spans
            UNION ALL
            SELECT d.doc_id, len(x) // 2, coalesce(max(b), 0) FROM bytes d LEFT JOIN spans s ON d.doc_id = s.doc_id
            GROUP BY d.doc_id, x
        ),
        left_over AS (
            SELECT d.doc_id, string_agg(substr(x, 2 * free + 1, 2 * (a - free)), '' ORDER BY a, free) AS kept
            FROM bytes d JOIN gaps g ON d.doc_id = g.doc_id GROUP BY d.doc_id
        )
        SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes,
            CAST(coalesce(sum(b - s.a), 0) AS BIGINT) AS n_removed, count(b) AS n_spans,
            any_value(sha256(unhex(kept))) AS kept_sha256
        FROM bytes d JOIN left_over l ON d.doc_id = l.doc_id LEFT JOIN spans s ON d.doc_id = s.doc_id
        GROUP BY d.doc_id, x
    """,
}
