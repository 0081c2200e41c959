r"""Operator 9: personal data.

Regular expressions propose spans; validators confirm them (address parts at most 255, Luhn, digit counts, mod-97);
words near a span raise or lower its score.  Base kinds (email, ip, card, phone) are kept whenever their validator
agrees.  The extra kinds need more: ``iban`` must pass mod-97, and ``ssn`` (ddd-dd-dddd) is kept only if the words around
bring its score to ``min_score``.

Per base kind, matches are the leftmost non-overlapping ones of these patterns; a match that fails its validator is
dropped and the search goes on after it:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, parts at most 255
* card ``[0-9]([\x20-]?[0-9])+``, 13 to 19 digits passing Luhn
* phone ``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits

The searches below give the same matches in time linear in the text.  Null text is the empty text; repeated rows give
repeated results; an empty table gives no rows; extra columns are ignored (``find``) or kept (``redact``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .textarrays import text_rows, text_slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a failing address fails from every digit of its first run, so only run starts are tried
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Words near a span that speak for (or against) its kind.
CONTEXT = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server"},
    "card": {"card", "visa", "credit", "tarjeta", "carte", "karte"},
    "phone": {"phone", "tel", "call", "mobile", "telefono", "telefon"},
    "iban": {"iban", "bank", "account", "konto", "cuenta", "compte"},
    "ssn": {"ssn", "social", "security"},
}
AGAINST = {"version", "isbn", "serial", "part", "order", "invoice", "example"}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
NEAR = 48  # characters looked at on either side
WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def mod97(text: str) -> bool:
    code = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in code)) % 97 == 1


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        end = at
        m = DOMAIN.match(text, at)
        if m:
            start = at
            while start > done and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
                start -= 1
            if start < at:
                end = done = m.end()
                yield start, end
        at = text.find("@", max(end, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(only_digits(m[0])) <= 15:
                yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        if 15 <= len(bare := m[0].replace(" ", "")) <= 34 and mod97(bare):
            yield m.span()


def numbers(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in SSN.finditer(text))


FINDERS = dict(zip(KINDS, (emails, addresses, cards, phones, ibans, numbers), strict=True))


def score(text: str, kind: str, start: int, end: int) -> float:
    """Confidence in 0..1: the kind's prior, moved by the words within ``NEAR`` characters."""
    words = {w.lower() for w in WORD.findall(text[max(0, start - NEAR):start]) + WORD.findall(text[end:end + NEAR])}
    return min(1.0, max(0.0, PRIOR[kind] + 0.25 * bool(words & CONTEXT[kind]) - 0.25 * bool(words & AGAINST)))


def spans_of(text: str, min_score: float) -> list[tuple[str, int, int, float]]:
    """All spans as (kind, start, end, score), by kind as listed, then start; offsets are code points, end exclusive."""
    found = []
    for kind, finder in FINDERS.items():
        for start, end in finder(text):
            s = score(text, kind, start, end)
            if kind in BASE_KINDS or s >= min_score:
                found.append((kind, start, end, s))
    return found


SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


def find(docs: DataFrame, min_score: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: the spans with their scores, in one narrow pass."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans_of(t, min_score)]
                    for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, kind)], names=[id_col, "spans"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, f"{id_col} long, spans {SPANS}")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and joined ``kind:start:end`` strings of a ``find`` result."""

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(id_col, *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def masked(text: str, min_score: float) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, done = [], 0
    merged: list[list] = []
    for kind, start, end, _ in sorted(spans_of(text, min_score), key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, min_score: float = 0.6, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` masked; all other columns and null texts stay as they are."""

    @F.pandas_udf(StringType())
    def mask(texts):
        return texts.map(lambda t: None if t is None else masked(t, min_score))

    return docs.withColumn(text_col, mask(F.col(text_col)))


