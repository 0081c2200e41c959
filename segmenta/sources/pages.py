"""Embedded-JSON extraction from raw HTML pages (S15) as a job over a pages table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_non_ascii

FORM_VAR = "FB_PUBLIC_LOAD_DATA_"  # fixed value: the form page's variable name
#: A value ends at the first semicolon outside quotes; a quote that does not close stands for itself.  Possessive, so long values need no stack.
QUOTED = r"""\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'|`(?:[^`\\]|\\.)*+`"""
SCRIPT_VAR = r"(?s)<script>\s*var\s+(\w+)\s*=\s*((?:[^;\"'`]|" + QUOTED + r"|[\"'`])*+);"


def script_vars(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Every ``<script>var NAME = VALUE;`` of every page: (key, name, value)."""
    names = F.regexp_extract_all(F.col(html), F.lit(SCRIPT_VAR), F.lit(1))
    values = F.regexp_extract_all(F.col(html), F.lit(SCRIPT_VAR), F.lit(2))
    return (pages.select(key, F.arrays_zip(names.alias("name"), values.alias("value")).alias("z"))
            .select(key, F.inline("z")))


def form_questions(pages: DataFrame, key: str = "page_id", html: str = "html", var: str = FORM_VAR) -> DataFrame:
    """(key, position, title): the JSON array assigned to ``var``, questions at [1][1], title at [1]
    of each, non-ASCII stripped.  Pages without the variable or with invalid JSON yield no rows."""
    pattern = r"(?s)var " + var + r" = (\[.*?\]);\s*</script>"
    doc = F.try_parse_json(F.regexp_extract(F.col(html), pattern, 1))
    qs = F.try_variant_get(doc, "$[1][1]", "array<variant>")
    return (pages.select(key, F.posexplode(qs).alias("position", "q"))
            .select(key, "position", strip_non_ascii(F.try_variant_get("q", "$[1]", "string")).alias("title")))
