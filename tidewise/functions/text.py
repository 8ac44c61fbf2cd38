"""Text analysis: terms, all-terms match, highlighting and BM25 scoring.

The analyser is ``lower`` plus a split on everything that is neither letter nor
digit. Chinese, Japanese and Korean ideographs carry no spaces, so with
``cjk=True`` each run of them is indexed as overlapping pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_IDEOGRAPH = r"\p{IsHan}"
_WORD = r"[\p{L}\p{N}&&[^\p{IsHan}]]+"
_PAIR = rf"(?=({_IDEOGRAPH}{_IDEOGRAPH}))"
_LONE = rf"(?<!{_IDEOGRAPH})({_IDEOGRAPH})(?!{_IDEOGRAPH})"

# The usual BM25 saturation and length parameters.
BM25_K1 = 1.2
BM25_B = 0.75


def tokens(text: Column, cjk: bool = False) -> Column:
    """Terms of a text, in order for words, with repeats."""
    low = F.lower(text)
    if not cjk:
        return F.array_remove(F.split(low, r"[^\p{L}\p{N}]+"), "")
    return F.concat(
        F.regexp_extract_all(low, F.lit(f"({_WORD})"), F.lit(1)),
        F.regexp_extract_all(low, F.lit(_PAIR), F.lit(1)),
        F.regexp_extract_all(low, F.lit(_LONE), F.lit(1)),
    )


def query_terms(spark: SparkSession, query: str, cjk: bool = False) -> list[str]:
    """Distinct terms of a user's query, from the same expression the data goes through.

    Evaluated on a one-row constant relation, which needs no Spark job.
    """
    one = spark.sql("SELECT 1 AS one")
    return list(one.select(F.array_distinct(tokens(F.lit(query), cjk)).alias("terms")).first().terms)


def matches_all(text: Column, terms: list[str], cjk: bool = False) -> Column:
    """True where every term occurs. No term at all matches nothing."""
    if not terms:
        return F.lit(False)
    # The substring test is implied by the term test and spares most rows the split.
    quick = reduce(Column.__and__, [F.lower(text).contains(t) for t in terms])
    exact = reduce(Column.__and__, [F.array_contains(tokens(text, cjk), t) for t in terms])
    return quick & exact


def highlight(
    text: Column, terms: list[str], cjk: bool = False, before: str = "<em>", after: str = "</em>"
) -> Column:
    """Wrap every occurrence of a term. Terms hold letters and digits only, so they need no quoting."""
    if not terms:
        return text
    longest_first = sorted(terms, key=lambda t: (-len(t), t))
    # A term is a whole word; ideographs have no word boundary when indexed as pairs.
    joined = r"[\p{L}\p{N}&&[^\p{IsHan}]]" if cjk else r"[\p{L}\p{N}]"
    pattern = rf"(?iu)(?<!{joined})({'|'.join(longest_first)})(?!{joined})"
    return F.regexp_replace(text, pattern, f"{before}$1{after}")


def term_frequency(terms_of_text: Column, term: str) -> Column:
    """How often a term occurs in an array of terms."""
    return (F.size(terms_of_text) - F.size(F.array_remove(terms_of_text, term))).cast("double")


def bm25_term(tf: Column, length: Column, n_docs: Column, doc_freq: Column, avg_length: Column) -> Column:
    """BM25 contribution of one term to one document."""
    idf = F.log(1 + (n_docs - doc_freq + 0.5) / (doc_freq + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * length / avg_length)
    return idf * tf * (BM25_K1 + 1) / (tf + norm)
