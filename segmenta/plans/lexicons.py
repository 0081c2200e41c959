"""Polarity of documents under a lexicon made from another table: all longer words of the conversations, signed by a hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WORD, tokens
from ..operators._util import round_doubles as R6
from ..operators.lexicon import polarity_by_lexicon
from ..tables import table
from .registry import query

_MIN = 5  # letters of an entry; shorter words are so common that no text lacks one
_WORDS = "SELECT {key}, unnest(regexp_extract_all(lower(text), '" + WORD.replace("{", "{{").replace("}", "}}") + "')) AS word FROM {table} WHERE text IS NOT NULL"

_SQL = f"""WITH lex AS (SELECT DISTINCT word AS entry, CASE WHEN substr(md5(word), 1, 1) < '8' THEN 1 ELSE -1 END AS sign
  FROM ({_WORDS.format(key="conv_id", table="conversations")}) WHERE length(word) >= {_MIN} AND substr(md5(word), 2, 1) < '4')
, uses AS ({_WORDS.format(key="doc_id", table="documents")})
, words AS (SELECT DISTINCT word FROM uses)
, scored AS (SELECT w.word, count_if(l.entry = w.word AND sign > 0) AS up, count_if(l.entry = w.word AND sign < 0) AS down,
    count_if(sign > 0) AS up_part, count_if(sign < 0) AS down_part FROM words w JOIN lex l ON contains(w.word, l.entry) GROUP BY w.word)
, sums AS (SELECT doc_id, sum(up) AS up, sum(down) AS down, sum(up_part) AS up_part, sum(down_part) AS down_part FROM uses JOIN scored USING (word) GROUP BY doc_id)
SELECT doc_id, round(coalesce(CASE WHEN up + down > 0 THEN CAST(up - down AS DOUBLE) / (up + down)
    WHEN up_part + down_part > 0 THEN CAST(up_part - down_part AS DOUBLE) / (up_part + down_part) END, 0.0), 6) AS polaridad
FROM documents LEFT JOIN sums USING (doc_id)"""


@query("sentiment_large_lexicon", _SQL)
def q_sentiment_large_lexicon(spark, d):
    words = table(spark, d, "conversations").where(F.col("text").isNotNull()).select(F.explode(tokens("text")).alias("entry")).distinct()
    digit = F.md5(F.col("entry").cast("binary"))
    lexicon = words.where((F.length("entry") >= _MIN) & (F.substring(digit, 2, 1) < "4")).select(
        "entry", F.when(F.substring(digit, 1, 1) < "8", 1).otherwise(-1).alias("sign"))
    return R6(polarity_by_lexicon(table(spark, d, "documents").select("doc_id", "text"), "text", lexicon).select("doc_id", "polaridad"))
