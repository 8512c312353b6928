"""The registered queries of this subpackage: each applies one operator to its
whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (chat_format, fill_middle, jaccard_join, lexical_search, packing, page_text, piece_encoding, ppm_scores, quality_rules, secret_scan, suffix_dedup,
                        toxicity, vector_search)
from strata.llm.common import table


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.quality_scores(docs, model)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remaining(table(spark, sf_dir, "documents")).drop("ranges", "n_passages", "n_passage_bytes")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_spans(table(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(table(spark, sf_dir, "embeddings"))


def op8_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores.scores(table(spark, sf_dir, "documents"))


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, decoded again; the text comes back as a hash."""
    decoded = piece_encoding.decode(piece_encoding.encode(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", "n_ids", "ids_crc32", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.transform(table(spark, sf_dir, "documents")))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts hold control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], given.schema)
    return chat_format.digest(chat_format.format_log(chat_format.event_log(given.union(marked))))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_toxicity": op3_toxicity,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_packing": op5_packing,
    "op7_vector_search": op7_vector_search,
    "op8_ppm_scores": op8_ppm_scores,
    "op9_page_text": op9_page_text,
    "op10_piece_encoding": op10_piece_encoding,
    "op6_quality_rules": op6_quality_rules,
    "op11_fill_middle": op11_fill_middle,
    "op12_chat_format": op12_chat_format,
    "op13_lexical_search": op13_lexical_search,
}

# DuckDB SQL where it can express the whole result of a query
ORACLE: dict[str, str] = {
    "op11_fill_middle": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units FROM t),
        c AS (SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                     CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
        f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                          WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c),
        p AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:n], '') AS suf FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p""",
    "op12_chat_format": r"""
        WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|SYS\]|ROLE))', '\1\\\2', 'g') AS body,
                     CASE role WHEN 'user' THEN 18 WHEN 'system' THEN 16 WHEN 'assistant' THEN 5 ELSE 19 + length(role) END AS marks FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(body) + marks) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op13_lexical_search": r"""
        WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        d AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
        c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM d),
        f AS (SELECT doc_id, term, count(*) AS tf FROM w SEMI JOIN i USING (term) GROUP BY doc_id, term),
        g AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, c GROUP BY term, docs),
        s AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l)))) AS BIGINT) AS score
              FROM f JOIN g USING (term) JOIN d USING (doc_id) JOIN i USING (term), c GROUP BY item_id, doc_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}
