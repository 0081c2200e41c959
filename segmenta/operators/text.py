"""Text analytics over open-answer columns.

Nothing collects a document's tokens into one array beyond the regex result of that row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import NEGATIVE_ES, POSITIVE_ES, STOP_WORDS_ES
from ..functions.text import polarity_text, tokens
from ._util import present


def corpus(df: DataFrame, text_cols: list[str], key_cols: list[str]) -> DataFrame:
    """UNION ALL of the text columns as (key..., field, text), null cells dropped."""
    cols = present(df, text_cols)
    if not cols:
        raise ValueError("corpus: none of the text columns is present")
    src = df.select(*key_cols, *[F.col(c).cast("string").alias(c) for c in cols])
    return src.unpivot(key_cols, cols, "field", "text").where(F.col("text").isNotNull())


def sentiment_rows(df: DataFrame, text_cols: list[str], keep: list[str] | None = None,
                   positive=POSITIVE_ES, negative=NEGATIVE_ES) -> DataFrame:
    """``{col}_polaridad`` per present text column plus their row mean ``sentimiento_promedio``."""
    cols = present(df, text_cols)
    if not cols:
        raise ValueError("sentiment_rows: none of the text columns is present")
    keep = keep or []
    out = df.select(*keep, *cols).select(
        *keep, *[polarity_text(c, positive, negative).alias(f"{c}_polaridad") for c in cols])
    mean = sum((F.col(f"{c}_polaridad") for c in cols), F.lit(0.0)) / len(cols)
    return out.withColumn("sentimiento_promedio", mean)


def sentiment_by_group(scored: DataFrame, group_col: str, value_col: str = "sentimiento_promedio") -> DataFrame:
    """(group, mean polarity, n) with null groups dropped."""
    return (scored.where(F.col(group_col).isNotNull()).groupBy(group_col)
            .agg(F.avg(value_col).alias("polaridad_media"), F.count(F.lit(1)).alias("n")))


def tfidf_terms(df: DataFrame, text_cols: list[str], key_cols: list[str], max_features: int = 10,
                stop_words=STOP_WORDS_ES, min_token_len: int = 2) -> DataFrame:
    """Corpus TF-IDF of the top ``max_features`` terms: (term, tfidf) descending.

    doc = one non-null cell; tokens = lower-cased runs of >= 2 word characters
    minus stop words; vocabulary = top-k by total count (ties: term); raw tf;
    idf = ln((1 + n) / (1 + df)) + 1 with n = all documents (empty ones too);
    L2 per document over the vocabulary terms; summed over documents.

    A document is a cell: rows with the same key stay apart.  The text is read twice.  The first pass counts each term
    and the documents that hold it (map-side combined; a document's sorted tokens mark a term's first place), with a null
    term counting the documents.  The k terms with their idf, k rows, become literals of the second pass, which weighs
    and normalises each document within its row and adds up k sums.
    """
    docs = corpus(df, text_cols, key_cols).select("text")
    found = tokens("text", min_token_len)
    if stop_words:
        found = F.filter(found, lambda t: ~t.isin(list(stop_words)))

    def per_document(words, marked):
        """``marked`` of each document's words; as a generator's input they are made once, wherever they are used."""
        return docs.select(F.inline(F.transform(F.array(words), lambda s: F.struct(marked(s).alias("found")))))

    def first_places(s):
        return F.transform(s, lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get(s, i - 1) != t)).cast("long").alias("first")))

    none = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("first")))
    counts = (per_document(F.sort_array(found), first_places).select(F.inline(F.concat(none, "found"))).groupBy("term")
              .agg(F.count(F.lit(1)).alias("total"), F.sum("first").alias("df")))
    # the null term, whose total is the number of documents, comes first
    top = counts.orderBy(F.col("term").isNotNull(), F.desc("total"), "term").limit(max_features + 1).collect()
    if len(top) < 2:
        return df.sparkSession.createDataFrame([], "term string, tfidf double")
    n_docs = top[0]["total"]
    idf = {r["term"]: math.log((1 + n_docs) / (1 + r["df"])) + 1.0 for r in top[1:]}
    vocab = F.create_map(*[F.lit(x) for pair in idf.items() for x in pair])

    def weights(s):
        return F.transform(F.array_distinct(s), lambda v: F.struct(
            v.alias("term"), (F.size(F.filter(s, lambda t: t == v)) * F.element_at(vocab, v)).alias("w")))

    weighed = per_document(F.filter(tokens("text", min_token_len), lambda t: t.isin(list(idf))), weights)
    norm = F.sqrt(F.aggregate("found", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    return (weighed.select(norm.alias("norm"), F.inline("found"))
            .groupBy("term").agg(F.sum(F.col("w") / F.col("norm")).alias("tfidf"))
            .orderBy(F.desc("tfidf"), "term"))
