"""Scalar text expressions (F1-F5, F17) and the lexicon polarity expression.

All are native Catalyst expressions (regex + higher-order functions): no Python
UDF, so they run inside the JVM and on streaming DataFrames unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import NEGATIVE_ES, POSITIVE_ES

# Unicode word characters (Python's \w): letters, numbers, underscore.  Java's \w is ASCII-only.
WORD = r"[\p{L}\p{N}_]+"
WORD2 = r"[\p{L}\p{N}_]{2,}"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: str | Column, min_len: int = 1) -> Column:
    """lower-case, then every maximal run of word characters (of ``min_len``+ chars)."""
    pat = WORD if min_len <= 1 else r"[\p{L}\p{N}_]{%d,}" % min_len
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(pat), F.lit(0))


def is_blank(c: str | Column) -> Column:
    """null or only whitespace."""
    return _c(c).isNull() | _c(c).rlike(r"^\s*$")


def strip_non_ascii(c: str | Column) -> Column:
    """drop every non-ASCII character."""
    return F.regexp_replace(_c(c), r"[^\x00-\x7F]", "")


def _arr(words) -> Column:
    return F.lit(list(words))  # one array literal


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def polarity_sql_expr(text_col: str, positive=POSITIVE_ES, negative=NEGATIVE_ES) -> str:
    """Spark SQL text of the N1 polarity of a text column (one call into the JVM to build).

    The lower-case text and its tokens are made once per cell (bound as a lambda's variable).  Exact hits are looked up in hash
    sets.  Only for texts without one, as ``coalesce`` is lazy, the entries that the whole text contains are found, and
    only these are looked for in its tokens: an entry inside a token is inside the text.
    """
    col = "`" + text_col.replace("`", "``") + "`"
    pos = "array(" + ", ".join(_sql_str(w) for w in positive) + ")"
    neg = "array(" + ", ".join(_sql_str(w) for w in negative) + ")"

    def among(words) -> str:
        return f"w IN ({', '.join(_sql_str(w) for w in words)})" if words else "false"

    ratio = "acc -> CASE WHEN acc.p + acc.n > 0 THEN CAST(acc.p - acc.n AS DOUBLE) / (acc.p + acc.n) END"
    exact = (f"transform(array(named_struct('p', size(filter(tk, w -> {among(positive)})), "
             f"'n', size(filter(tk, w -> {among(negative)})))), {ratio})[0]")
    partial = (f"transform(array(named_struct('p', filter({pos}, e -> contains(low, e)), 'n', filter({neg}, e -> contains(low, e)))), "
               "held -> CASE WHEN size(held.p) + size(held.n) > 0 THEN aggregate(tk, named_struct('p', 0, 'n', 0), (acc, w) -> named_struct("
               "'p', acc.p + size(filter(held.p, e -> contains(w, e))), "
               f"'n', acc.n + size(filter(held.n, e -> contains(w, e)))), {ratio}) END)[0]")
    return (f"coalesce(transform(array(lower({col})), low -> transform(array(regexp_extract_all(low, {_sql_str(WORD)}, 0)), "
            f"tk -> coalesce({exact}, {partial}))[0])[0], 0.0D)")


def polarity_text(text_col: str, positive=POSITIVE_ES, negative=NEGATIVE_ES) -> Column:
    """N1 polarity of a named text column, as one native expression."""
    return F.expr(polarity_sql_expr(text_col, positive, negative))


def _polarity_columns(tk: Column, positive, negative) -> Column:
    pos, neg = _arr(positive), _arr(negative)
    zero = F.struct(F.lit(0).alias("p"), F.lit(0).alias("n"))

    def ratio(acc):
        tot = acc["p"] + acc["n"]
        return F.when(tot > 0, (acc["p"] - acc["n"]) / tot)

    exact = F.aggregate(tk, zero, lambda acc, w: F.struct(
        (acc["p"] + F.array_contains(pos, w).cast("int")).alias("p"),
        (acc["n"] + F.array_contains(neg, w).cast("int")).alias("n")), ratio)
    partial = F.aggregate(tk, zero, lambda acc, w: F.struct(
        (acc["p"] + F.size(F.filter(pos, lambda e: w.contains(e)))).alias("p"),
        (acc["n"] + F.size(F.filter(neg, lambda e: w.contains(e)))).alias("n")), ratio)
    return F.coalesce(exact.cast("double"), partial.cast("double"), F.lit(0.0))


def polarity(c: str | Column, positive=POSITIVE_ES, negative=NEGATIVE_ES) -> Column:
    """Lexicon polarity in [-1, 1].

    Exact word hits give (pos - neg) / (pos + neg).  With no exact hit, every
    (word, entry) pair where the entry is a substring of the word counts a half
    hit on its side, and the same ratio is taken.  Null / blank / no words / no
    hit give 0.0.
    """
    if isinstance(c, str):
        return polarity_text(c, positive, negative)
    return _polarity_columns(tokens(c), positive, negative)


def polarity_sql(col: str, positive=POSITIVE_ES, negative=NEGATIVE_ES) -> str:
    """DuckDB SQL for the same polarity (used by the oracle)."""
    p = "[" + ", ".join(f"'{w}'" for w in positive) + "]"
    n = "[" + ", ".join(f"'{w}'" for w in negative) + "]"
    tk = f"regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}_]+')"
    ep = f"len(list_filter({tk}, lambda w: list_contains({p}, w)))"
    en = f"len(list_filter({tk}, lambda w: list_contains({n}, w)))"
    sp = f"coalesce(list_sum(list_transform({tk}, lambda w: len(list_filter({p}, lambda e: contains(w, e))))), 0)"
    sn = f"coalesce(list_sum(list_transform({tk}, lambda w: len(list_filter({n}, lambda e: contains(w, e))))), 0)"
    return (f"coalesce(CASE WHEN {col} IS NULL THEN 0.0 "
            f"WHEN {ep} + {en} > 0 THEN CAST({ep} - {en} AS DOUBLE) / ({ep} + {en}) "
            f"WHEN {sp} + {sn} > 0 THEN CAST({sp} - {sn} AS DOUBLE) / ({sp} + {sn}) ELSE 0.0 END, 0.0)")


def band(score: str | Column) -> Column:
    """label of a silhouette score."""
    s = _c(score)
    return (F.when(s >= 0.5, F.lit("strong")).when(s >= 0.25, F.lit("acceptable"))
            .otherwise(F.lit("overlapping")))
