"""Text queries (N-series) over whole documents / conversations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import text as TX
from lodestar.plans.registry import query
from lodestar.tables import Tables

_WORDS_SQL = """w AS (
  SELECT unnest(regexp_split_to_array(text, '\\s+')) AS raw FROM documents)"""


@query("n_word_count_raw", "N1 F4 X4 H5", sql=f"""
WITH {_WORDS_SQL}
SELECT raw AS word, count(*) AS n FROM w WHERE raw <> '' GROUP BY raw""")
def n_word_count_raw(spark, sf):
    return TX.word_counts(Tables(spark, sf).documents)


@query("n_word_count_top10", "N1 O3 O4 Q12", sql=f"""
WITH {_WORDS_SQL}
SELECT raw AS word, count(*) AS n FROM w WHERE raw <> '' GROUP BY raw
ORDER BY n DESC, word LIMIT 10""")
def n_word_count_top10(spark, sf):
    return TX.top_words(TX.word_counts(Tables(spark, sf).documents), 10)


@query("n_clean_word_count", "N2 F2 A11", sql=f"""
WITH {_WORDS_SQL},
     c AS (SELECT trim(regexp_replace(lower(raw), '{T.WORD_CLEAN_DROP}', '', 'g')) AS word FROM w)
SELECT word, count(*) AS n FROM c WHERE length(word) > 3 GROUP BY word HAVING count(*) > 1""")
def n_clean_word_count(spark, sf):
    return TX.clean_word_counts(Tables(spark, sf).documents)


@query("n_clean_word_top10", "N2 O3 A11 Q12", sql=f"""
WITH {_WORDS_SQL},
     c AS (SELECT trim(regexp_replace(lower(raw), '{T.WORD_CLEAN_DROP}', '', 'g')) AS word FROM w)
SELECT word, count(*) AS n FROM c WHERE length(word) > 3 GROUP BY word HAVING count(*) > 1
ORDER BY n DESC, word LIMIT 10""")
def n_clean_word_top10(spark, sf):
    return TX.top_words(TX.clean_word_counts(Tables(spark, sf).documents), 10)


# The oracle's regex engine (RE2) has no back-references, so the SQL form
# of the repeat rule walks the characters: a character is dropped when it
# equals the two before it (runs keep their first two), except line
# terminators, which Java's "." does not match.
def _social_sql(table: str, ids: str) -> str:
    return r"""
WITH a AS (SELECT {ids},
                  regexp_replace(regexp_replace(lower(text), '@[^\s]+', 'USER', 'g'),
                                 'https?://\S+|www\.\S+', 'URL', 'g') AS t FROM {table}),
     b AS (SELECT {ids}, string_split(t, '') AS cs FROM a),
     c AS (SELECT {ids},
                  array_to_string(list_filter(list_transform(range(1, len(cs) + 1), lambda i:
                      CASE WHEN i >= 3 AND cs[i] = cs[i - 1] AND cs[i - 1] = cs[i - 2]
                                AND cs[i] NOT IN (chr(10), chr(13), chr(133), chr(8232), chr(8233))
                           THEN NULL ELSE cs[i] END), lambda x: x IS NOT NULL), '') AS t FROM b),
     d AS (SELECT {ids},
                  regexp_replace(regexp_replace(t, '[^a-zA-Z\d\s]', '', 'g'), '\d+', 'NUM', 'g') AS text_norm
           FROM c)
SELECT {ids}, text_norm,
       CAST(len(list_filter(regexp_split_to_array(text_norm, '\s+'), lambda w: w <> '')) AS INTEGER) AS n_tokens
FROM d""".format(table=table, ids=ids)


@query("n_social_normalize", "N3 F2 Q7 Q8", sql=_social_sql("conversations", "conv_id, turn"))
def n_social_normalize(spark, sf):
    """Normalised conversation turns (also checked against Python ``re``
    in the tests)."""
    c = Tables(spark, sf).conversations
    norm = T.normalize_social("text")
    return c.select("conv_id", "turn", norm.alias("text_norm"),
                    F.size(T.words(norm)).alias("n_tokens"))


@query("n_social_normalize_documents", "N3 F2 Q7", sql=_social_sql("documents", "doc_id"))
def n_social_normalize_documents(spark, sf):
    """The same normalisation over whole documents (mentions, digits,
    repeated characters occur there)."""
    d = Tables(spark, sf).documents.select("doc_id", "text")
    norm = T.normalize_social("text")
    return d.select("doc_id", norm.alias("text_norm"), F.size(T.words(norm)).alias("n_tokens"))


@query("n_tfidf_features", "N4 N5 N6 N7 E11")
def n_tfidf_features(spark, sf):
    """Tokenizer -> stop words -> hashing TF -> IDF on every document; per
    document: token counts and the L1 norm of its TF-IDF vector."""
    d = Tables(spark, sf).documents.select("doc_id", "text")
    model = TX.tfidf_model().fit(d)
    out = model.transform(d)
    arr = vector_to_array("features")
    return out.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.size("terms").alias("n_terms"),
        F.aggregate(arr, F.lit(0.0), lambda a, x: a + F.abs(x)).alias("tfidf_l1"))


@query("n_uri_local_names", "F5 F3", sql="""
SELECT regexp_extract(url, '^(https?)://', 1) AS scheme,
       count(*) AS n, count(DISTINCT CASE WHEN strpos(url, '#') > 0
                                          THEN split_part(url, '#', -1) END) AS n_fragments
FROM pages GROUP BY 1""")
def n_uri_local_names(spark, sf):
    p = Tables(spark, sf).pages.select("url")
    frag = F.when(F.instr("url", "#") > 0, T.uri_local_name("url"))
    return p.groupBy(T.title_from_name("url", r"^(https?)://").alias("scheme")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(frag).alias("n_fragments"))
