"""Registered queries of the training-data operators: thin digests of the
operators' outputs over whole tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (
    decontaminate, filter_audit, importance, jaccard_join, line_dedup, line_rules, packing,
    quality, sharding, substring_dedup, token_counts, topk, toxicity)
from lodestar.llm.common import read_table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_records(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", "grown_shard")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = token_counts.count_tokens(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_hits(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"),
                        lambda n, s: n + s["stop"] - s["start"])
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers as p
    return packing.pack(docs, p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"),
                        p.PATTERN)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents")).drop("ids")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_recurring_lines(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(
        F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.join_components(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "class_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.drop_repeated_spans(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"),
        read_table(spark, sf_dir, "benchmark"), n=1, buckets=10_000, percent=10,
        least_words=20, seed="2024").select("doc_id", "n_features", "weight", "score", "rank")


def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.apply_rules(
        read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_boilerplate_words", "kept")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read_table(spark, sf_dir, "documents"),
                                        read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_token_counts": op2_token_counts,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_topk": op10_topk,
    "op11_importance": op11_importance,
    "op12_line_rules": op12_line_rules,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM benchmark WHERE item_id IS NOT NULL),
        p AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n,
                   array_to_string(w[i:i + 9], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                  FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM p),
        x AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d, sizes WHERE len(w) >= n)),
        hit AS (SELECT x.doc_id, x.n, x.i, p.item_id FROM x JOIN p USING (n, s)),
        words AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
        ids AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit)
            GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op9_substring_dedup": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        x AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i
                  FROM d WHERE len(w) >= 13)),
        f AS (SELECT s, min(doc_id) AS least FROM x GROUP BY s),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k
            FROM x JOIN f USING (s) WHERE doc_id > least),
        word AS (
            SELECT doc_id, w[k] AS v, k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d)),
        kept AS (
            SELECT doc_id, string_agg(v, ' ' ORDER BY k) AS t, count(*) AS n
            FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)
                            FOR x IN embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_sum(list_transform(range(1, len(a.q) + 1),
                        lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
                             AND len(a.q) = len(b.q)),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id
                                              ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_importance": """
        WITH tab AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
                       THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
            FROM range(256) r(i)),
        f AS (
            SELECT 's' AS side, doc_id, unnest(w) AS x
            FROM (SELECT doc_id, regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents)
            UNION ALL
            SELECT 't', item_id, unnest(w)
            FROM (SELECT item_id, regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)),
        word AS (
            SELECT x, xor(list_reduce(b, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]),
                                      CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
            FROM (SELECT x, [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT)
                             FOR i IN range(len(h) // 2)] AS b
                  FROM (SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM f))), tab),
        c AS (
            SELECT bucket, CAST(count(*) FILTER (WHERE side = 's') AS DOUBLE) AS s,
                   CAST(count(*) FILTER (WHERE side = 't') AS DOUBLE) AS t
            FROM f JOIN word USING (x) GROUP BY bucket),
        g AS (
            SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)
                       / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM c),
        d AS (
            SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
            FROM f JOIN word USING (x) JOIN g USING (bucket) WHERE side = 's' GROUP BY doc_id),
        s AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || sha256(
                       '2024:' || doc_id)[1:8] AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT)
                       AS score
            FROM documents LEFT JOIN d USING (doc_id)),
        r AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k,
                   count(*) OVER () AS n FROM s WHERE n_features >= 20)
        SELECT s.doc_id, n_features, weight, score, CASE WHEN k <= 10 * n // 100 THEN k END AS rank
        FROM s LEFT JOIN r USING (doc_id)""",
    "op12_line_rules": """
        WITH d AS (
            SELECT doc_id, source, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        l AS (
            SELECT doc_id, source, text, i, v, len(regexp_extract_all(v, '[^\\x20\\x09-\\x0D]+')) AS n,
                   regexp_replace(array_to_string(regexp_extract_all(translate(v,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+'), ' '), '[0-9]+', '0', 'g') AS key
            FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS v,
                         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)),
        x AS (SELECT * FROM l WHERE n > 0),
        again AS (
            SELECT doc_id, sum(c - 1) AS n_dup_lines
            FROM (SELECT doc_id, v, count(*) AS c FROM x GROUP BY ALL) GROUP BY doc_id),
        win AS (
            SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS t
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
        rep AS (
            SELECT doc_id, count(DISTINCT k) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k
                  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM win) WHERE c > 1)
            GROUP BY doc_id),
        hosts AS (SELECT source, count(DISTINCT text) AS n FROM x GROUP BY source),
        above AS (
            SELECT x.source, key, count(DISTINCT text) AS n_docs
            FROM x JOIN hosts h ON x.source IS NOT DISTINCT FROM h.source
            GROUP BY x.source, key, h.n
            HAVING count(DISTINCT text) > 3 AND count(DISTINCT text) > 0.01 * h.n),
        hit AS (
            SELECT x.doc_id, x.source, x.text, x.key, n, len(d.w) AS words
            FROM x JOIN above a ON x.source IS NOT DISTINCT FROM a.source AND x.key = a.key
            JOIN d ON d.doc_id = x.doc_id),
        low AS (
            SELECT DISTINCT text
            FROM (SELECT doc_id, text FROM hit GROUP BY doc_id, text, words
                  HAVING words - sum(n) < 0.5 * words)),
        gone AS (
            SELECT a.source, a.key
            FROM above a JOIN hit h ON a.source IS NOT DISTINCT FROM h.source AND a.key = h.key
            GROUP BY a.source, a.key, a.n_docs
            HAVING 2 * count(DISTINCT h.text) FILTER (WHERE h.text IN (SELECT text FROM low))
                   <= a.n_docs),
        lost AS (
            SELECT x.doc_id, sum(n) AS n
            FROM x JOIN gone g ON x.source IS NOT DISTINCT FROM g.source AND x.key = g.key
            GROUP BY x.doc_id),
        m AS (
            SELECT d.doc_id, len(w) AS n_words,
                   len(text) - len(regexp_extract_all(text, '[\\x20\\x09-\\x0D]')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost.n, 0) AS lost
            FROM d LEFT JOIN again USING (doc_id) LEFT JOIN rep USING (doc_id)
            LEFT JOIN lost USING (doc_id))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
               CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               CAST(lost AS BIGINT) AS n_boilerplate_words,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND n_words - lost >= 0.5 * n_words AS kept
        FROM m""",
    "op13_filter_audit": """
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        firsts AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
        lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels
                GROUP BY doc_id),
        flags AS (
            SELECT t.doc_id, part, quality, toxic,
                   {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
                    'C': 100 * len(regexp_extract_all(t.text, '[A-Z]')) > 2 * len(t.text),
                    'D': regexp_matches(t.text, '[#$%&*|]'), 'E': t.doc_id > least} AS f
            FROM t JOIN firsts USING (text) LEFT JOIN lab USING (doc_id)),
        fails AS (
            SELECT part, quality, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x:
                CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C
                       WHEN 'D' THEN f.D ELSE f.E END) AS failed
            FROM flags),
        cell AS (
            SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
                   count(*) FILTER (WHERE toxic = 1) AS toxic
            FROM fails GROUP BY part, failed),
        letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letter a, letter b, letter c, letter d, letter e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
            SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier
            FROM orders, range(1, 6) s(step)),
        audit AS (
            SELECT part, filter_order, step, own,
                   sum(n) FILTER (WHERE NOT fails AND NOT gone) AS kept,
                   sum(n) FILTER (WHERE fails AND NOT gone) AS removed,
                   sum(n) FILTER (WHERE fails AND gone) AS redundant,
                   sum(n) FILTER (WHERE fails AND len(failed) = 1) AS unique_fails,
                   sum(good) FILTER (WHERE fails AND NOT gone) AS good_lost,
                   sum(toxic) FILTER (WHERE fails AND NOT gone) AS toxic_lost
            FROM (SELECT *, list_contains(failed, own) AS fails,
                         len(list_filter(failed, lambda x: contains(earlier, x))) > 0 AS gone
                  FROM cell, steps)
            GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step,
               CAST(coalesce(kept, 0) AS BIGINT) AS kept,
               CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
               CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
               CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM audit""",
}
