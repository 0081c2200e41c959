"""Script values that hold semicolons, and CSV files split by Spark."""

from segmenta.sources import pages


def test_script_values_with_semicolons(spark):
    values = ['"a;b"', "'it;s'", '["x;y", "q\\"; z", 1]', "`t;\n;`", "5", "it's", '"' + "w;" * 50_000 + '"', "[" + '"k;v",' * 20_000 + "0]"]
    rows = [(i, f"<html><script> var v{i} = {v};</script> and; more</html>") for i, v in enumerate(values)]
    got = {r["page_id"]: (r["name"], r["value"]) for r in pages.script_vars(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert got == {i: (f"v{i}", v) for i, v in enumerate(values)}
