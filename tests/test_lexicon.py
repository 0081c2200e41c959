"""Polarity under lexicon tables against the list version and a plain loop."""

import random
import re

import pytest
from pyspark.sql import functions as F

from segmenta.functions.lexicon import NEGATIVE_ES, POSITIVE_ES
from segmenta.functions.text import polarity
from segmenta.operators import lexicon as LX
from segmenta.operators.lexicon import polarity_by_lexicon

TEXTS = ["Soy muy creativo y apasionado", "La rutina me pone triste", "creativos y aburridos", "", None, "¡¡ !!", "alegre triste", "sin nada", "alegre triste",
         "Los intuitivos: líder, LIDERAZGO y rutinas", "a a a bueno"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "id long, text string, word string, polaridad string").repartition(3)


def lexicon(spark, up, down):
    return spark.createDataFrame([(w, 1) for w in up] + [(w, -1) for w in down], "entry string, sign int")


def found(df):
    return {r["id"]: r["polaridad"] for r in df.collect()}


def test_equals_the_list_version(spark):
    df = frame(spark, TEXTS)
    want = {r["id"]: r["p"] for r in df.select("id", polarity("text").alias("p")).collect()}
    for limit in (1 << 20, 0):  # sent to all tasks, or joined
        got = found(polarity_by_lexicon(df, "text", lexicon(spark, POSITIVE_ES, NEGATIVE_ES), broadcast_bytes=limit))
        assert got == pytest.approx(want) and set(want.values()) > {0.0}


def test_large_lexicon(spark):
    rng = random.Random(7)
    syllables = [a + b for a in "bcdfglmnprstv" for b in "aeiou"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    up, down = ({word(rng.randint(2, 5)) for _ in range(30_000)} for _ in "ab")
    up |= {"ba", "e", "zu"}
    texts = [" ".join(word(rng.randint(1, 6)) for _ in range(rng.randint(1, 4))) for _ in range(150)]

    def plain(text):
        words = re.findall(r"\w+", text.lower())
        hits = [sum(w in side for w in words) for side in (up, down)]
        if not sum(hits):
            hits = [sum(e in side for w in words for e in {w[i:j] for i in range(len(w)) for j in range(i + 1, len(w) + 1)}) for side in (up, down)]
        return (hits[0] - hits[1]) / sum(hits) if sum(hits) else 0.0

    got = found(polarity_by_lexicon(frame(spark, texts), "text", lexicon(spark, up, down)))
    assert got == pytest.approx({i: plain(t) for i, t in enumerate(texts)})


def test_awkward_lexicons(spark):
    df = frame(spark, ["bueno malo", "buenos"])
    assert found(polarity_by_lexicon(df, "text", lexicon(spark, [], []))) == {0: 0.0, 1: 0.0}
    odd = lexicon(spark, ["bueno", "bueno", "", None, "malo"], ["malo"]).union(spark.createDataFrame([("buenos", 0)], "entry string, sign int"))
    assert found(polarity_by_lexicon(df, "text", odd)) == {0: pytest.approx(1 / 3), 1: 1.0}
    assert polarity_by_lexicon(df.where(F.lit(False)), "text", odd).count() == 0


def test_words_are_looked_up_once_per_slice(spark, monkeypatch):
    """A row per text and word went through three shuffles where the scored words are too many to be sent to all tasks."""
    texts = TEXTS * 20
    df = frame(spark, texts)
    want = {r["id"]: r["p"] for r in df.select("id", polarity("text").alias("p")).collect()}
    for size in (LX.SLICE_BYTES, 200):
        monkeypatch.setattr(LX, "SLICE_BYTES", size)
        out = polarity_by_lexicon(df, "text", lexicon(spark, POSITIVE_ES, NEGATIVE_ES), broadcast_bytes=0)
        assert out.columns == df.columns and found(out) == pytest.approx(want)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "Aggregate [text#" not in plan
    got = found(polarity_by_lexicon(df.where("id > 5000"), "text", lexicon(spark, POSITIVE_ES, NEGATIVE_ES), broadcast_bytes=0))
    assert got == {}
