"""Registered queries of the operators and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlake.llm import chat, decontaminate, exact, infill, langid, licenses, merkle, minhash, passages, pieces, quality, simhash, warc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the benchmark items they hold."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs that recur, with their component and whether they go."""
    return passages.repeated_paragraphs(table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal conversations in the chat format."""
    return chat.format_chats(table(spark, folder, "conversations"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, folder, "documents"), k=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write(table(spark, folder, "pages"))
    return warc.read(archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the licenses they declare."""
    return licenses.scan(table(spark, folder, "documents"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.exact_groups(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's piece ids, and the text decoded from them compared with the given one."""
    decoded = pieces.round_trip(table(spark, folder, "documents"), pieces.load())
    return decoded.select("doc_id", "ids", F.size("ids").alias("n_ids"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every text in its fill-in-middle form, and the text restored from it, as digests."""
    found = infill.restore(infill.transform(table(spark, folder, "documents")))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; each seventh is tampered with and checked."""
    number = F.col("doc_id").cast("string")
    tampered = F.pmod(F.crc32(number.cast("binary")), F.lit(7)) == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(table(spark, folder, "documents"), altered={"n_chars": n_chars})
    siblings = F.transform("path", lambda step: merkle.as_hex(F.concat(step["left"], step["right"])))
    folded = merkle.fold(F.col("other_leaf"), F.col("path"))
    found = found.withColumn("folded", folded)
    return found.select(
        "doc_id",
        *[merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        merkle.as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_language_id": op4_language_id,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_warc": op7_warc,
    "op8_license_scan": op8_license_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}

ORACLE: dict[str, str] = {
    "op3_chat_formatting": """
        WITH said AS (
            SELECT conv_id, turn, role, text,
                   row_number() OVER o AS n,
                   count(*) OVER (PARTITION BY conv_id) AS total,
                   string_agg(coalesce(role, '~') || chr(1) || coalesce(text, '~') || chr(2), '') OVER o AS upto
            FROM conversations
            WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
        ), whole AS (
            SELECT min(conv_id) AS conv_id, upto FROM said WHERE n = total GROUP BY upto
        ), kept AS (
            SELECT conv_id FROM whole
            WHERE NOT EXISTS (SELECT 1 FROM said WHERE said.n < said.total AND said.upto = whole.upto)
        )
        SELECT conv_id,
               CAST(floor(coalesce(turn, -1) / 1024) AS BIGINT) AS chunk,
               count(*) AS n_turns,
               string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
                          ORDER BY turn, role, text) AS text
        FROM conversations WHERE conv_id IN (SELECT conv_id FROM kept)
        GROUP BY 1, 2
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), r AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
                   min(page_id) OVER (PARTITION BY payload) AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM r
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_fill_in_middle": """
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT doc_id, text, units, len(units) AS n,
                   CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS one,
                   CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS two,
                   CAST('0x' || h[17:24] AS BIGINT) % 100 AS three,
                   CAST('0x' || h[25:32] AS BIGINT) % 100 AS four
            FROM cut
        ), parts AS (
            SELECT doc_id, n, text,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR three >= 90 THEN 'plain'
                        WHEN four < 20 THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(units[1 : least(one, two)], '') AS prefix,
                   array_to_string(units[least(one, two) + 1 : greatest(one, two)], '') AS middle,
                   array_to_string(units[greatest(one, two) + 1 :], '') AS suffix
            FROM drawn
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE rows AS (
            SELECT doc_id, lang, n_chars,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                       || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS tail,
                   -- CRC-32 of the decimal id, bit by bit.
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                       lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
                   ), 4294967295) AS crc
            FROM documents
        ), hashed AS (
            SELECT doc_id, lang,
                   sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
                   sha256(head || coalesce(strlen(CAST(n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR)) || ':'
                       || (n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END), '-') || tail) AS other
            FROM rows
        ), leaves AS (
            SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY lang) AS n
            FROM hashed
        ), tree AS (
            SELECT 0 AS level, g, place, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT level + 1, g, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
            FROM tree WHERE n > 1 GROUP BY level, g, place // 2, n
        ), climb AS (
            SELECT 0 AS level, g, place AS leaf_place, place, n, '' AS proof, other AS folded FROM leaves
            UNION ALL
            SELECT c.level + 1, c.g, c.leaf_place, c.place // 2, (c.n + 1) // 2, c.proof || coalesce(s.digest, ''),
                   sha256(CASE WHEN c.place % 2 = 0 THEN c.folded || coalesce(s.digest, '') ELSE s.digest || c.folded END)
            FROM climb c LEFT JOIN tree s ON s.level = c.level AND s.g = c.g AND s.place = xor(c.place, 1)
            WHERE c.n > 1
        ), tops AS (
            SELECT g AS place, count(*) OVER () AS n, digest FROM tree WHERE n = 1
        ), upper_tree AS (
            SELECT 0 AS level, place, n, digest FROM tops
            UNION ALL
            SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
            FROM upper_tree WHERE n > 1 GROUP BY level, place // 2, n
        ), upper_climb AS (
            SELECT 0 AS level, g, leaf_place, g AS place, (SELECT count(*) FROM tops) AS n, proof, folded FROM climb WHERE n = 1
            UNION ALL
            SELECT c.level + 1, c.g, c.leaf_place, c.place // 2, (c.n + 1) // 2, c.proof || coalesce(s.digest, ''),
                   sha256(CASE WHEN c.place % 2 = 0 THEN c.folded || coalesce(s.digest, '') ELSE s.digest || c.folded END)
            FROM upper_climb c LEFT JOIN upper_tree s ON s.level = c.level AND s.place = xor(c.place, 1)
            WHERE c.n > 1
        )
        SELECT doc_id, leaf, t.digest AS subroot, (SELECT digest FROM upper_tree WHERE n = 1) AS root,
               sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
               c.folded = (SELECT digest FROM upper_tree WHERE n = 1) AS verified
        FROM leaves l
        JOIN upper_climb c ON c.g = l.g AND c.leaf_place = l.place AND c.n = 1
        JOIN tops t ON t.place = l.g
    """,
}
