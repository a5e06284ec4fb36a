"""Web-log analysis (G15): documents with all keywords, joined with their
ranks above a threshold, minus documents visited in a given year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_all
from ..operators.joins import anti_join
from ..operators.relational import filter_year


def web_log_analysis(docs: DataFrame, ranks: DataFrame, visits: DataFrame, keywords,
                     min_rank: int = 40, year: int = 2007) -> DataFrame:
    """docs (url, text); ranks (rank, url, avg_duration); visits (url, date).
    The year test is ``==`` on the visit date, a pushed range."""
    d = docs.filter(contains_all("text", keywords)).select("url")
    r = ranks.filter(F.col("rank") > min_rank)
    v = filter_year(visits, "date", "==", year).select("url")
    return anti_join(d.join(r, "url").select("rank", "url", "avg_duration"), v, "url")
