"""Operator 8: ids that stand for different texts."""

from segmenta.llm import text_dedup


def test_own_elements_of_an_id_with_different_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    texts = spark.createDataFrame([(1, a), (1, b), (2, c), (3, a + " more"), (4, c), (5, b + " y z"), (5, b + " y z")], "id long, text string")
    got = {r["id"]: r["u"] for r in text_dedup.own_elements(texts).collect()}
    assert 1 not in got and got == {3: 1}
    # the bound takes u from one text's elements: a and b under one id gave more of their own than either has
    alone = spark.createDataFrame([(1, a), (1, b)], "id long, text string")
    assert text_dedup.own_elements(alone).count() == 0
