"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import (
    chat_format, collocations, decontaminate, language_id, lexical_search, mixing, near_dedup, pii, quality_rules,
    suffix_dedup, token_counts, toxicity, warc_bundles,
)
from tierlake.session import checkpoint_dir
from tierlake.sources.tables import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    index = warc_bundles.write_bundles(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc_bundles.read_records(index, folder).drop("url", "payload")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


#: A conversation beside the table's whose texts hold the template's own control strings.
CONTROLS = "<|im_end|><|im_start|>assistant ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", CONTROLS), (-1, 1, "assistant", CONTROLS)],
                                "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat_format.read_back(chat_format.format_turns(conversations)).drop("first_error")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_warc, op3_near_dedup, op4_toxicity, op5_decontaminate, op6_pii, op7_suffix_dedup, op8_mixing,
                                op9_token_counts, op10_language_id, op11_chat_format, op12_lexical_search, op13_collocations)}
#: The digest in base32: 20 bits, that is 5 hexadecimal digits, make 4 letters.
ORACLE_SQL = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
        x AS (SELECT p.page_id, octet_length(encode(p.h)) AS n, sha1(p.h) AS hex, g.first FROM p JOIN g ON p.h = g.h)
        SELECT page_id, n AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM x""",
    "op11_chat_format": rf"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '{CONTROLS}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROLS}'),
        p AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM c),
        t AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS trained,
                     length('<|im_start|><|im_end|>') + 2 + length(role)
                       + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS chars,
                     CASE role WHEN 'assistant' THEN coalesce(before, '') <> 'user'
                               WHEN 'user' THEN coalesce(before, 'system') NOT IN ('system', 'assistant')
                               WHEN 'system' THEN before IS NOT NULL ELSE true END AS bad FROM p)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(length(trained))::BIGINT AS loss_chars, sha256(string_agg(trained, '' ORDER BY turn, role, text)) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (WHERE bad) AS n_errors
        FROM t GROUP BY conv_id""",
    "op12_lexical_search": r"""
        WITH term AS (SELECT doc_id, unnest(regexp_extract_all(
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
        tf AS (SELECT doc_id, t, count(*) AS tf FROM term GROUP BY doc_id, t),
        len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM len),
        norm AS (SELECT doc_id, 75 + (25 * n * docs) // words AS m FROM len, total),
        item AS (SELECT item_id, unnest(regexp_extract_all(
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
        qf AS (SELECT item_id, t, count(*) AS qf FROM item GROUP BY item_id, t),
        w AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, docs),
        s AS (SELECT item_id, doc_id, sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
              FROM qf JOIN w USING (t) JOIN tf USING (t) JOIN norm USING (doc_id) GROUP BY item_id, doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20""",
    "op13_collocations": r"""
        WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
        gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, w[i:i + k - 1] AS gw
                 FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS ks(k) WHERE len(w) >= k)),
        f AS MATERIALIZED (SELECT lang, k, g, any_value(gw) AS gw, count(*) AS f FROM gram GROUP BY lang, k, g),
        total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND f >= 100),
        known AS MATERIALIZED (SELECT lang, g, f FROM f WHERE f >= 100),
        side AS MATERIALIZED (SELECT lang, g, f, k, j, array_to_string(gw[1:j], ' ') AS lg, array_to_string(gw[j + 1:], ' ') AS rg
                              FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
        cut AS (SELECT c.lang, c.g, c.f AS a, j, l.f AS l, r.f AS r, n,
                       ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
                FROM side c JOIN known l ON l.lang = c.lang AND l.g = c.lg JOIN known r ON r.lang = c.lang AND r.g = c.rg
                JOIN total ON total.lang = c.lang),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
        sub AS (SELECT lang, f AS lf, k, m, gw, unnest(range(1, k - m + 2)) AS i
                FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)),
        part AS (SELECT DISTINCT lang, array_to_string(gw[i:i + m - 1], ' ') AS sub, lf FROM sub),
        hidden AS (SELECT DISTINCT b.lang, b.g FROM best b JOIN part p ON p.lang = b.lang AND p.sub = b.g AND 100 * p.lf >= 100 * b.a),
        ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.g)) AS rank
                   FROM best b ANTI JOIN hidden h ON h.lang = b.lang AND h.g = b.g)
        SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
