"""Polarity (N1, J4, J5) under lexicons of any size, given as tables.

A word's score depends on the word alone, so it is made once per distinct word of the corpus: the entries equal to it (J4), and
the entries it contains (J5).  For the latter, every entry is filed under the rarest of its three-letter parts (a shorter
entry under itself), rarest among the corpus' distinct words; a word meets only the entries filed under one of its
own parts, and ``contains`` decides.  Texts are then sums over their scored words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import materialize

GRAM = 3
BROADCAST_BYTES = 32 << 20  # a table of scored words up to this size is sent to all tasks
SLICE_BYTES = 32 << 20  # text that meets the scores of its words in one task
_SUMS = ("up", "down", "up_part", "down_part")


def _parts(col: str, lengths) -> Column:
    """Distinct substrings of ``col`` of the given lengths."""
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(col) - n + 1)
        return F.when(F.length(col) >= n, F.transform(starts, lambda i: F.substr(F.col(col), i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(of, lengths)))


def _entries(lexicon: DataFrame) -> DataFrame:
    """``entry, up, down``: distinct entries with whether they stand on the positive and the negative side."""
    side = F.col("sign").cast("int")
    return (lexicon.where(F.col("entry").isNotNull() & (F.col("entry") != "") & (side != 0))
            .groupBy("entry").agg(F.max((side > 0).cast("int")).alias("up"), F.max((side < 0).cast("int")).alias("down")))


def scored_words(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``word, up, down, up_part, down_part``: entries equal to each of the distinct ``words(word)``, and entries it contains; words without any are left out."""
    entries = materialize(_entries(lexicon), "lexicon")
    size = F.least(F.length("entry"), F.lit(GRAM))
    lengths = sorted(r[0] for r in entries.select(size).distinct().collect())  # at most GRAM numbers
    if not lengths:
        return words.select("word", *[F.lit(0).alias(c) for c in ("up", "down", "up_part", "down_part")]).limit(0)
    filed = entries.select("*", F.explode(F.when(F.length("entry") >= GRAM, _parts("entry", [GRAM])).otherwise(F.array("entry"))).alias("gram"))
    held = words.select("word", F.explode(_parts("word", lengths)).alias("gram")).join(filed.select("gram").distinct(), "gram", "left_semi")
    held = materialize(held, "word-parts")
    common = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # an entry with a part that no word has comes under that part, and so meets no word
    filed = (filed.join(common, "gram", "left").groupBy("entry", "up", "down")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest")).select("entry", "up", "down", "rarest.gram"))
    filed = materialize(filed, "filed-entries")
    # most words' parts are common ones, under which no entry is filed
    held = held.join(filed.select("gram").distinct(), "gram", "left_semi")
    part = (held.join(filed, "gram").where(F.col("word").contains(F.col("entry")))
            .groupBy("word").agg(F.sum("up").cast("int").alias("up_part"), F.sum("down").cast("int").alias("down_part")))
    # a word that equals an entry contains it
    equal = entries.select(F.col("entry").alias("word"), "up", "down")
    return part.join(equal, "word", "left").select("word", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("up", "down")], "up_part", "down_part")


def polarity_by_lexicon(df: DataFrame, text_col: str, lexicon: DataFrame, out_col: str = "polaridad",
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the N1 polarity of ``text_col`` under ``lexicon(entry, sign)``: sign above 0 positive, below 0 negative.

    Repeated entries count once, one on both sides counts on both.  Null texts and texts without a hit have 0.0; no key is
    needed, equal texts are scored together.
    """
    words = df.where(F.col(text_col).isNotNull()).select(F.explode(tokens(text_col)).alias("word")).distinct()
    scores = materialize(scored_words(words, lexicon), "scored-words")
    size = scores.agg(F.sum(F.octet_length("word") + 32).alias("bytes")).first()["bytes"] or 0
    if size > broadcast_bytes:
        return _by_slices(df.drop(out_col), text_col, scores, out_col)
    text = F.sha2(F.col(text_col).cast("binary"), 256)
    uses = df.where(F.col(text_col).isNotNull()).select(text.alias("text"), F.explode(tokens(text_col)).alias("word"))
    # copies of a text scale all of its sums alike, and the ratio stays
    sums = uses.join(F.broadcast(scores), "word").groupBy("text").agg(*[F.sum(c).alias(c) for c in _SUMS])

    def ratio(up: str, down: str) -> Column:
        return F.when(F.col(up) + F.col(down) > 0, (F.col(up) - F.col(down)) / (F.col(up) + F.col(down)))

    sums = sums.select(F.col("text").alias("__text"), F.coalesce(ratio("up", "down"), ratio("up_part", "down_part"), F.lit(0.0)).alias("__polarity"))
    rest = df.drop(out_col)
    return (rest.withColumn("__key", text).join(sums, F.col("__key") == F.col("__text"), "left")
            .select(*rest.columns, F.coalesce("__polarity", F.lit(0.0)).alias(out_col)))


def _by_slices(df: DataFrame, text_col: str, scores: DataFrame, out_col: str) -> DataFrame:
    """The polarity without a row per text and word: rows are dealt to slices of about ``SLICE_BYTES`` of text, a word is looked up
    once per slice, and a slice's texts meet the scores of its words in one task."""
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "lexicon-texts")
    total = numbered.agg(F.sum(F.octet_length(text_col)).alias("bytes")).first()["bytes"] or 0
    dealt = numbered.withColumn("__slice", F.pmod(F.xxhash64("__row"), F.lit(max(1, -(-total // SLICE_BYTES))).cast("long")))
    words = dealt.select("__slice", F.explode(tokens(text_col)).alias("word")).distinct()
    known = words.join(scores, "word").select(F.col("__slice").alias("__part"), "word", *_SUMS)
    # texts are shuffled, not their words
    texts = dealt.select("__slice", "__row", text_col).repartition("__slice").select("__slice", "__row", tokens(text_col).alias("__words"))
    found = (texts.groupBy("__slice").cogroup(known.groupBy("__part"))
             .applyInArrow(_slice_polarity, "__at long, __polarity double"))
    return (numbered.join(found, F.col("__row") == F.col("__at"))
            .select(*df.columns, F.col("__polarity").alias(out_col)))


def _slice_polarity(texts: pa.Table, known: pa.Table) -> pa.Table:
    """``__at, __polarity`` of a slice's rows ``(__row, __words)``, by the scores of its words."""
    lists = texts.column("__words").combine_chunks()
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    at = pc.fill_null(pc.index_in(lists.flatten(), value_set=known.column("word")), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), n)[at >= 0]
    at = at[at >= 0]
    up, down, up_part, down_part = (np.bincount(row, known.column(c).to_numpy()[at], len(n)) for c in _SUMS)
    hits, parts = up + down, up_part + down_part
    polarity = np.where(hits > 0, (up - down) / np.maximum(hits, 1), (up_part - down_part) / np.maximum(parts, 1))
    return pa.table({"__at": texts.column("__row"), "__polarity": pa.array(polarity)})
