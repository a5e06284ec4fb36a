"""Tokenizers and text predicates.

Java-compatible splitting rules are expressed with built-in regex
functions so they run JVM-side over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import col_


def _empty() -> Column:
    return F.array().cast("array<string>")


def lines(df: DataFrame, text: str = "text", out: str = "line",
          number: str | None = "line_no") -> DataFrame:
    """Split a text column into its lines (``\\n``), one row per line."""
    parts = F.split(F.col(text), "\n")
    if number:
        return df.select(*[c for c in df.columns if c != text],
                         F.posexplode(parts).alias(number, out))
    return df.select(*[c for c in df.columns if c != text], F.explode(parts).alias(out))


def java_split(c, sep_regex: str) -> Column:
    """``String.split(regex)``: interior empty tokens kept, trailing empty
    tokens dropped; a non-empty text made only of separators yields none."""
    s = col_(c)
    stripped = F.regexp_replace(s, f"(?:{sep_regex})+$", "")
    return F.when((stripped == "") & (s != ""), _empty()).otherwise(F.split(stripped, sep_regex))


def java_split_space(c) -> Column:
    """``String.split(" ")``: interior empty tokens kept, trailing ones dropped;
    a non-empty text made only of separators yields no tokens."""
    s = col_(c)
    stripped = F.regexp_replace(s, " +$", "")
    return F.when((stripped == "") & (s != ""), _empty()).otherwise(F.split(stripped, " "))


def java_split_ws(c) -> Column:
    """``String.split("\\\\s")``: single-whitespace separator, trailing empties
    dropped (P07)."""
    s = col_(c)
    stripped = F.regexp_replace(s, r"\s+$", "")
    return F.when((stripped == "") & (s != ""), _empty()).otherwise(F.split(stripped, r"\s"))


def word_tokens(c) -> Column:
    """``lower`` then split on ``\\W+``; empties must be filtered after."""
    return F.split(F.lower(col_(c)), r"\W+")


def tokenize_words(df: DataFrame, text: str = "text", out: str = "word", keep=()) -> DataFrame:
    """One row per non-empty lower-case word (with the columns ``keep``)."""
    return df.select(*keep, F.explode(word_tokens(text)).alias(out)).filter(F.length(out) > 0)


def split_by_length(words: DataFrame, word: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """The words that go on, and those over ``limit`` characters for the side output."""
    long = F.length(word) > limit
    return words.filter(~long), words.filter(long)


def windowed_word_counts(words: DataFrame, ts: str, word: str, size: str) -> DataFrame:
    """``word, window_start, cnt`` per tumbling window (on a stream with a
    watermark on ``ts`` each window is emitted when it is final)."""
    return words.groupBy(word, F.window(ts, size).alias("w")).agg(F.count(F.lit(1)).alias("cnt")) \
        .select(word, F.col("w.start").alias("window_start"), "cnt")


def tokenize_long_lines(df: DataFrame, line: str = "line", limit: int = 15,
                        out: str = "word") -> DataFrame:
    """Lines longer than ``limit`` characters split on single spaces
    (case kept, Java trailing-empty rule)."""
    return df.filter(F.length(line) > limit).select(F.explode(java_split_space(line)).alias(out))


def tokenize_whitespace_keep_empty(df: DataFrame, line: str = "line",
                                   out: str = "word") -> DataFrame:
    """Split on each whitespace char, empty tokens kept."""
    return df.select(F.explode(java_split_ws(line)).alias(out))


TWEET_SCHEMA = "struct<user: struct<lang: string>, text: string>"


def english_tokens(df: DataFrame, json_col: str = "value", out: str = "word") -> DataFrame:
    """Parse JSON, keep ``user.lang == 'en'`` records having ``text``,
    split on whitespace runs, drop inner whitespace, lower-case, drop empties."""
    j = F.from_json(F.col(json_col), TWEET_SCHEMA)
    kept = df.select(j.alias("_j")).filter((F.col("_j.user.lang") == "en") &
                                           F.col("_j.text").isNotNull())
    tok = F.explode(F.split(F.col("_j.text"), r"[ \t\n\r\f]+"))
    return kept.select(tok.alias("_t")) \
               .select(F.lower(F.regexp_replace("_t", r"\s", "")).alias(out)) \
               .filter(F.col(out) != "")


def contains_all(c, keywords) -> Column:
    """Every keyword occurs in the text."""
    cond = None
    for k in keywords:
        t = col_(c).contains(k)
        cond = t if cond is None else cond & t
    return cond


def word_count(words: DataFrame, word: str = "word", out: str = "cnt") -> DataFrame:
    """Count per word; partial aggregation combines hot words
    map-side before the shuffle."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(out))
