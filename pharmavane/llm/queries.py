"""One query for each text operator over its whole table, and check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pharmavane.llm import bpe, chat, collocations, embedding_dedup, hard_negatives, licenses, line_dedup, mixing, ngram_join, packing, quality, sharding, token_files


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes of every document."""
    plan = mixing.plan_mix(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and dropped in every document."""
    found = line_dedup.dedup_lines(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_documents(_read(spark, sf_dir, "documents"), path)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every vector."""
    return embedding_dedup.near_vectors(_read(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the verdict of the learned rules for every document."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return quality.judge(docs, quality.fit(docs, labels)).drop("text")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    rows = rows.unionByName(extra)
    found = chat.format_conversations(chat.vary_layouts(chat.gather_messages(rows)), ["conv_id"])
    read = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.loss_text(F.col("turns"))
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(read, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of every document."""
    return ngram_join.jaccard_components(_read(spark, sf_dir, "documents"), percent=80)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    written = token_files.write_token_files(_read(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.read_token_files(spark, written)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards by jump consistent hashing, and the shard with a ninth."""
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), shards=8)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return licenses.scan_licenses(_read(spark, sf_dir, "documents")).drop("spans")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_read(spark, sf_dir, "documents"), path, end_id=0, capacity=2048)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(_read(spark, sf_dir, "documents"), least=30, top=2000, covered=80)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some labels shifted by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _read(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, "vec_id % 100 = 0", positives=5, negatives=10, low=30, high=90, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_bpe": op3_bpe,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_format": op6_chat_format,
    "op7_ngram_join": op7_ngram_join,
    "op8_token_files": op8_token_files,
    "op9_sharding": op9_sharding,
    "op10_license_scan": op10_license_scan,
    "op11_packing": op11_packing,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH cut AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM cut),
        owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
        marked AS (
            SELECT keyed.*, coalesce(owner < doc_id, false) AS gone FROM keyed LEFT JOIN owners USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op6_chat_format": """
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (
            SELECT *, length(text) + length(regexp_replace(text, '[^<\\\\]', '', 'g'))
                + length(role) + length(regexp_replace(role, '[^<|\\\\]', '', 'g'))
                + length('<|turn:') + length('|>') + 1 + length('<|end|>') + 1 AS chars
            FROM said)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op12_collocations": """
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]+')) AS said
            FROM documents),
        worded AS (
            SELECT lang, list_filter(string_split_regex(said, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM piece),
        gram AS (
            SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3, 4]) AS m))),
        f AS (SELECT lang, m, phrase, count(*) AS f FROM gram GROUP BY ALL),
        whole AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
        candidate AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
        cut AS (SELECT *, unnest(range(1, m)) AS k FROM candidate),
        scored AS (
            SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, k,
                CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
            FROM cut c
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.m], ' ')),
        best AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
            SELECT * FROM best b WHERE NOT EXISTS (
                SELECT 1 FROM candidate d
                WHERE d.lang = b.lang AND len(d.phrase) > len(b.phrase) AND 100 * CAST(d.a AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)
                    AND contains(' ' || d.phrase || ' ', ' ' || b.phrase || ' ')))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
            phrase, a, l, r, n, score
        FROM kept JOIN whole USING (lang)
        QUALIFY rank <= 2000""",
    "op13_hard_negatives": """
        WITH part AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        pair AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM part a JOIN part b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
        positive AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
            n.other_id AS negative_id, positive_score, n.score AS negative_score
        FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
            AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
