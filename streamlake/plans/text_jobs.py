"""Text jobs over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.tables import load
from .registry import register


def g12_word_count(spark, sf):
    """Batch word count over whole documents."""
    docs = load(spark, sf, "documents", "doc_id", "text")
    return T.word_count(T.tokenize_words(docs))


def p06_long_line_words(spark, sf):
    """Words of lines longer than 15 characters, split on spaces."""
    ls = T.lines(load(spark, sf, "documents", "doc_id", "text"), number=None)
    return T.word_count(T.tokenize_long_lines(ls, "line", 15))


def p07_whitespace_words(spark, sf):
    """Split on single whitespace characters, empty tokens kept."""
    ls = T.lines(load(spark, sf, "documents", "doc_id", "text"), number=None)
    return T.word_count(T.tokenize_whitespace_keep_empty(ls, "line"))


def p08_english_words(spark, sf):
    """JSON records -> English texts -> whitespace tokens (S21 lines)."""
    docs = load(spark, sf, "documents", "doc_id", "lang", "text")
    js = docs.select(F.to_json(F.struct(F.struct(F.col("lang")).alias("user"),
                                        F.col("text"))).alias("value"))
    return T.word_count(T.english_tokens(js, "value"))


KEYWORDS = (" the ", " and ")


def p13_keyword_documents(spark, sf):
    """Documents that contain every (space padded) keyword."""
    docs = load(spark, sf, "documents", "doc_id", "text")
    return docs.filter(T.contains_all("text", KEYWORDS)).select("doc_id")


def p17_words_seen_twice(spark, sf):
    """HAVING-style filter on the word count."""
    return g12_word_count(spark, sf).filter(F.col("cnt") == 2)


def p05_document_word_counts(spark, sf):
    """P05 per document: number of word tokens in each whole text."""
    docs = load(spark, sf, "documents", "doc_id", "text")
    toks = F.filter(T.word_tokens("text"), lambda w: F.length(w) > 0)
    return docs.select("doc_id", F.size(toks).cast("long").alias("n_words"))


WORDS_SQL = "SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents"
LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"

register("g12_word_count", g12_word_count,
         f"SELECT word, COUNT(*) AS cnt FROM ({WORDS_SQL}) WHERE length(word) > 0 GROUP BY word")
register("p05_document_word_counts", p05_document_word_counts, """
SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda w: length(w) > 0)) AS n_words
FROM documents""")
register("p06_long_line_words", p06_long_line_words, f"""
WITH g AS (SELECT rtrim(line, ' ') AS s FROM ({LINES_SQL}) WHERE length(line) > 15)
SELECT word, COUNT(*) AS cnt FROM (
  SELECT unnest(CASE WHEN s = '' THEN []::VARCHAR[] ELSE string_split(s, ' ') END) AS word FROM g)
GROUP BY word""")
register("p07_whitespace_words", p07_whitespace_words, f"""
WITH g AS (SELECT line, regexp_replace(line, '\\s+$', '') AS s FROM ({LINES_SQL}))
SELECT word, COUNT(*) AS cnt FROM (
  SELECT unnest(CASE WHEN s = '' AND line <> '' THEN []::VARCHAR[] ELSE regexp_split_to_array(s, '\\s') END) AS word FROM g)
GROUP BY word""")
register("p08_english_words", p08_english_words, """
SELECT word, COUNT(*) AS cnt FROM (
  SELECT lower(regexp_replace(tok, '\\s', '', 'g')) AS word FROM (
    SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS tok FROM documents
    WHERE lang = 'en' AND text IS NOT NULL))
WHERE word <> '' GROUP BY word""")
register("p13_keyword_documents", p13_keyword_documents,
         "SELECT doc_id FROM documents WHERE contains(text, ' the ') AND contains(text, ' and ')")
register("p17_words_seen_twice", p17_words_seen_twice,
         f"SELECT word, COUNT(*) AS cnt FROM ({WORDS_SQL}) WHERE length(word) > 0 GROUP BY word HAVING COUNT(*) = 2")
