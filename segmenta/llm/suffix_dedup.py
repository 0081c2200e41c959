"""Operator 3: removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (in a smaller document, or earlier in the same
one).  In terms of the suffix array: suffix s of the corpus has a longest previous factor of at least LENGTH.  Sorted
in suffix order, an earlier match of a suffix is found at its previous or next smaller position; here ties (LENGTH bytes
in common) are ordered by position, so the previous smaller position is the predecessor whenever such a match exists.

The suffix array is made in buckets, and only where it can matter:

1. Every LENGTH-byte string chooses the smallest-hashed SEED-byte string in it as its anchor (a function of its bytes), so
   equal strings share their anchor and the place of it.  Documents are scanned once for anchors.
2. Anchors are dealt out by their hash.  An anchor that occurs once rules out repeats around it.  Occurrences whose
   whole surroundings (every string around the anchor) are equal form one class: all but the first are repeats
   outright, and only the first stands for the class further on.  Classes met within one batch are merged before the shuffle.
3. For anchors with several classes the first occurrences come with their bytes.  In each bucket the suffixes that start a
   bytes before the anchor are sorted (bucketed by what stands before, then in suffix order of what follows, ties by
   position) for each a, and those with a previous smaller position at LENGTH bytes in common are marked.
4. Marked strings and repeats go back to their documents, which drop the covered bytes.

Anchors that hold more than a quarter of an average shuffle partition (seen in a sample of 1 in 64 documents; a miss costs time
only) are dealt out by their surroundings, and in step 3 by single strings, whose first occurrence is an aggregate
with partial sums and whose join Spark can split.  Texts are never shuffled more than once per pass.

Null text is the empty text.  Rows with equal id and text are one document (each gets its result); other rows that share an
id are separate documents, ordered by a hash of their text; a null id comes first.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cluster.components import dense_numbering
from ..session import materialize
from .rolling import Rolling, sliding
from .textarrays import give_back, mix, small_batches, text_bytes, text_slices

LENGTH = 100
SEED = 40
REACH = LENGTH - SEED  # bytes on either side of an anchor that a string around it can hold
SEGMENT = 1 << 20  # string starts looked at together
ROOM = SEGMENT + 4 * LENGTH
SAMPLED = 64
SLICE = 4 << 20  # bytes of text worked on at once: the arrays made from them take about 30 times as much


def marks(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Boolean array of length n, true within the given [start, end) ranges."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


def anchors(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, hash of surroundings) of all anchors of the documents in ``buf``, by position."""
    out: list[tuple[np.ndarray, ...]] = []
    long_ = off[1:] - off[:-1] >= LENGTH
    starts = marks(len(buf), off[:-1][long_], (off[1:] - LENGTH + 1)[long_])
    last = -1
    for lo in range(0, len(buf), SEGMENT):
        hi = min(lo + SEGMENT, len(buf))
        ok = starts[lo:hi]
        if not ok.any():
            continue
        left, right = max(0, lo - 2 * LENGTH), min(len(buf), hi + 2 * LENGTH)
        part = buf[left:right]
        roll = Rolling(part, ROOM)
        gram = roll.grams(SEED)[lo - left:]
        width = REACH + 1
        gram = gram[:hi - lo + REACH]
        least = np.zeros(len(gram), np.uint64)
        low = sliding(gram, width, np.minimum)[:hi - lo]
        least[:len(low)][ok[:len(low)]] = low[ok[:len(low)]]
        # a gram is an anchor if it is the least of some string that holds it
        most = sliding(np.concatenate([np.zeros(REACH, np.uint64), least]), width, np.maximum)
        at = np.flatnonzero((gram == most) & (most > 0))
        at = at[at + lo > last]
        if not len(at):
            continue
        last = int(at[-1]) + lo
        doc = np.searchsorted(off, at + lo, side="right") - 1
        before = np.maximum(at + lo - REACH, off[doc])
        after = np.minimum(at + lo + LENGTH, off[doc + 1])
        around = roll.of(before - left, after - left)
        with np.errstate(over="ignore"):
            around = mix(around + (at + lo - before).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        out.append((at + lo, gram[at], around))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


ROWS = "key long, around long, doc long, at long, end long, hot boolean"


def seed_rows(hot: np.ndarray):
    """Anchors of each batch; of those with equal surroundings the first, the others as ranges of repeats (``end`` set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, SLICE):
            buf, off = text_bytes(b.column("text"))
            at, key, around = anchors(buf, off)
            row = np.searchsorted(off, at, side="right") - 1
            doc = b.column("doc").to_numpy(zero_copy_only=False)[row]
            place = at - off[row]
            order = np.lexsort((place, doc, around, key))
            same = np.zeros(len(order), bool)
            same[1:] = (key[order][1:] == key[order][:-1]) & (around[order][1:] == around[order][:-1])
            first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            same &= (doc[order] != doc[first]) | (place[order] != place[first])
            rep = np.sort(order[~same])
            repeat = np.sort(order[same])
            is_hot = np.isin(key[rep], hot)
            with np.errstate(over="ignore"):
                dealt = np.where(is_hot, mix(key[rep] ^ mix(around[rep])), key[rep])
            # neighbouring repeats of a row run together
            start, end = np.maximum(place[repeat] - REACH, 0), np.minimum(place[repeat] + LENGTH, (off[1:] - off[:-1])[row[repeat]])
            new = np.ones(len(repeat), bool)
            new[1:] = (row[repeat][1:] != row[repeat][:-1]) | (start[1:] > end[:-1])
            n = int(new.sum())
            ends = end[np.append(np.flatnonzero(new)[1:], len(repeat)) - 1] if n else end
            r_doc, zero = doc[repeat][new], np.zeros(n, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([signed(dealt), signed(mix(r_doc.astype(np.uint64)))]), pa.concat_arrays([signed(around[rep]), pa.array(zero)]),
                 pa.array(np.concatenate([doc[rep], r_doc])), pa.array(np.concatenate([place[rep], start[new]])),
                 pa.array(np.concatenate([np.zeros(len(rep), np.int64), ends])), pa.array(np.concatenate([is_hot, np.zeros(n, bool)]))],
                names=["key", "around", "doc", "at", "end", "hot"])

    return run


def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (key, around, doc, at) -> repeats as ranges, and what stays open: (doc, at, end, key, hot).

    Streams: of a key only its last surroundings and, until a second kind is met, its first occurrence are held.
    """
    key, around, first, several, waiting = None, None, None, False, None

    def table(doc, at, end, key, hot):
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(end, pa.int64()),
                                           pa.array(key, pa.int64()), pa.array(hot, pa.bool_())], names=["doc", "at", "end", "key", "hot"])

    for b in batches:
        if not b.num_rows:
            continue
        k, c, doc, at, end, hot = (b.column(x).to_numpy(zero_copy_only=False) for x in ("key", "around", "doc", "at", "end", "hot"))
        ready = end > 0
        yield table(doc[ready], at[ready], end[ready], np.zeros(int(ready.sum()), np.int64), hot[ready])
        k, c, doc, at, hot = (x[~ready] for x in (k, c, doc, at, hot))
        if not len(k):
            continue
        joins = key is not None and k[0] == key
        new_key = np.concatenate([[not joins], k[1:] != k[:-1]])
        new_kind = new_key | np.concatenate([[not joins or c[0] != around], c[1:] != c[:-1]])
        # the first occurrence of each row's kind
        lead = np.maximum.accumulate(np.where(new_kind, np.arange(len(k)), -1))
        carried = lead < 0
        f_doc, f_at = np.where(carried, first[0] if first else 0, doc[lead]), np.where(carried, first[1] if first else 0, at[lead])
        repeat = ~new_kind & ((doc != f_doc) | (at != f_at))
        yield table(doc[repeat], np.maximum(at[repeat] - REACH, 0), at[repeat] + LENGTH, np.zeros(int(repeat.sum()), np.int64), hot[repeat])
        run = np.cumsum(new_key) - (0 if joins else 1)  # 0: the carried key, if it goes on, else the first
        kinds = np.bincount(run, weights=new_kind, minlength=run[-1] + 1)
        if joins:
            kinds[0] += 2 if several else 1
            if waiting is not None and kinds[0] > 1:
                yield table(*[[x] for x in waiting])
                waiting = None
        open_ = new_kind & ((kinds[run] > 1) | hot)
        yield table(doc[open_], at[open_], np.zeros(int(open_.sum()), np.int64), k[open_], hot[open_])
        key, around, several = k[-1], c[-1], kinds[-1] > 1
        if lead[-1] >= 0:
            first = (doc[lead[-1]], at[lead[-1]])
        if not joins or run[-1] > 0:
            waiting = None
        if not several and not hot[-1] and new_kind[run == run[-1]].any():
            i = int(np.flatnonzero((run == run[-1]) & new_kind)[0])
            waiting = (int(doc[i]), int(at[i]), 0, int(k[i]), False)
    give_back()


OPEN = "key long, more long, doc long, at long, before binary, after binary"


def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open anchors with their bytes on either side; those of hot anchors as the hashes of all strings around them."""
    for b in batches:
        parts: dict[str, list] = {x: [] for x in ("key", "more", "doc", "at", "before", "after")}
        strings: list[list[np.ndarray]] = []
        for doc, text, places in zip(b.column("doc").to_pylist(), b.column("text"), b.column("places"), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            place = places.values
            ends, ats, keys, hots = (place.field(x).to_numpy(zero_copy_only=False) for x in ("end", "at", "key", "hot"))
            for i in np.flatnonzero((ends == 0) & ~hots):
                at = int(ats[i])
                parts["key"].append(int(keys[i]))
                parts["doc"].append(doc)
                parts["at"].append(at)
                parts["before"].append(raw[max(0, at - REACH):at])
                parts["after"].append(raw[at + SEED:at + LENGTH])
            for i in np.flatnonzero((ends == 0) & hots):
                lo, hi = max(0, int(ats[i]) - REACH), min(len(raw), int(ats[i]) + LENGTH)
                near = np.frombuffer(raw, np.uint8)[lo:hi]
                if len(near) >= LENGTH:
                    one, two = (Rolling(near, 4 * LENGTH, w).grams(LENGTH) for w in (0, 1))
                    strings.append([one, two, np.full(len(one), doc), np.arange(lo, lo + len(one))])
        n = len(parts["key"])
        one, two, doc, at = (np.concatenate(x) for x in zip(*strings, strict=True)) if strings else (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
        none = pa.nulls(len(one), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(parts["key"], pa.int64()), signed(one)]), pa.concat_arrays([pa.nulls(n, pa.int64()), signed(two)]),
             pa.array(np.concatenate([np.array(parts["doc"], np.int64), doc])), pa.array(np.concatenate([np.array(parts["at"], np.int64), at])),
             pa.concat_arrays([pa.array(parts["before"], pa.binary()), none]), pa.concat_arrays([pa.array(parts["after"], pa.binary()), none])],
            names=["key", "more", "doc", "at", "before", "after"])


def padded(col: pa.Array, mirror: bool) -> tuple[np.ndarray, np.ndarray]:
    """(rows of REACH bytes, their lengths); ``mirror``: read from the end backward."""
    raw, off = text_bytes(col)
    length = np.diff(off)
    out = np.zeros((len(length), REACH), np.uint8)
    k = np.arange(REACH)
    inside = k < length[:, None]
    src = (off[1:, None] - 1 - k) if mirror else (off[:-1, None] + k)
    out[inside] = raw[src[inside]]
    return out, length


def suffix_classes(bucket: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``rows`` within buckets, and the common prefix of each with the one before (-1 across buckets)."""
    wide = np.zeros((len(rows), -(-REACH // 8) * 8), np.uint8)
    wide[:, :REACH] = rows
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], bucket))
    differ = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differ.any(1), differ.argmax(1), REACH)
    common[bucket[order[1:]] != bucket[order[:-1]]] = -1
    return order, np.concatenate([[-1], common])


def repeats_in_buckets(bucket: np.ndarray, doc: np.ndarray, at: np.ndarray, before: pa.Array, after: pa.Array) -> np.ndarray:
    """[occurrence, a]: whether the string that starts a bytes before the anchor has an earlier equal one."""
    left, n_left = padded(before, mirror=True)
    right, n_right = padded(after, mirror=False)
    by_left, common_left = suffix_classes(bucket, left)
    by_right, common_right = suffix_classes(bucket, right)
    in_order = np.lexsort((at, doc))  # by position
    marked = np.zeros((len(doc), REACH + 1), bool)
    head, tail = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    for a in range(REACH + 1):
        head[by_left] = np.cumsum(common_left < a)  # same bucket and same a bytes before the anchor
        tail[by_right] = np.cumsum(common_right < REACH - a)  # same bytes after it, in suffix order
        live = in_order[((n_left >= a) & (n_right >= REACH - a))[in_order]]
        suffix = head[live] * (len(doc) + 1) + tail[live]
        order = np.argsort(suffix, kind="stable")  # suffix order, ties by position
        equal = np.zeros(len(live), bool)
        equal[1:] = suffix[order][1:] == suffix[order][:-1]  # LENGTH bytes in common with the previous smaller position
        here, prev = live[order], np.roll(live[order], 1)
        equal &= (doc[here] != doc[prev]) | (at[here] != at[prev])
        marked[here[equal], a] = True
    return marked


def longest_previous(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by key -> ``doc, at, end`` ranges covered by marked strings; only whole buckets are looked at together."""
    held: list[pa.RecordBatch] = []

    def resolve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        col = {c: t[c].chunk(0) if t[c].num_chunks else pa.array([], t[c].type) for c in t.column_names}
        key, doc, at = (col[c].to_numpy(zero_copy_only=False) for c in ("key", "doc", "at"))
        marked = repeats_in_buckets(key, doc, at, col["before"], col["after"]) if len(key) else np.zeros((0, REACH + 1), bool)
        edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, past = np.nonzero(edge == -1)
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(at[row] - past + 1), pa.array(at[row] - first + LENGTH)], names=["doc", "at", "end"])

    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("key").to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
        if cut or (held and held[-1].column("key")[-1].as_py() != key[0]):
            held.append(b.slice(0, cut))
            yield resolve(pa.Table.from_batches(held))
            held = []
        held.append(b.slice(cut))
    if held:
        yield resolve(pa.Table.from_batches(held))
    give_back()


def unique_documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a document number ``doc`` in document order, distinct ``doc, text``)."""
    rows = small_batches(docs).withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    ids = rows.groupBy(F.col(id_col).alias("i")).agg(F.count(F.lit(1)).alias("n"))
    clash = ids.where("n > 1 or i is null").limit(1).count()
    if not clash:
        rows = rows.withColumn("doc", F.col(id_col).cast("long"))
        return rows, rows.where("doc is not null").select("doc", F.col("__text").alias("text"))
    rows = rows.withColumn("__key", F.struct(F.col(id_col).cast("long").alias("i"), F.xxhash64("__text").alias("h")))
    number = dense_numbering(rows.select("__key"), "__key", "doc").withColumn("doc", F.col("doc").cast("long"))
    rows = rows.join(number, rows["__key"].eqNullSafe(number["__key"])).drop("__key")
    return rows, rows.select("doc", F.col("__text").alias("text")).dropDuplicates(["doc"]).where("doc is not null")


def hot_anchors(texts: DataFrame) -> np.ndarray:
    """Hashes of anchors that hold more than a quarter of an average shuffle partition, by a sample of documents."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = texts.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLED)) == 0).mapInArrow(seed_rows(np.zeros(0, np.uint64)), ROWS)
    counts = sample.where("end = 0").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") >= max(16, total / (4 * partitions))).collect()  # at most 4 x partitions keys
    return np.array([r["key"] for r in found], np.int64).view(np.uint64)


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """``doc, text, ranges`` for every distinct document: ``ranges`` the (start, end) stretches to drop, unordered, may overlap."""
    seeds = texts.mapInArrow(seed_rows(hot_anchors(texts)), ROWS)
    dealt = seeds.repartition("key").sortWithinPartitions("key", "around", "doc", "at")
    found = materialize(dealt.mapInArrow(classify, "doc long, at long, end long, key long, hot boolean"), "anchors")
    places = found.groupBy("doc").agg(F.collect_list(F.struct("at", "end", "key", "hot")).alias("places"))
    by_doc = texts.join(places, "doc", "left")
    opened = (by_doc.where(F.exists("places", lambda p: p["end"] == 0)).mapInArrow(surroundings, OPEN))
    near = opened.where("before is not null").select("key", "doc", "at", "before", "after")
    marked = near.repartition("key").sortWithinPartitions("key").mapInArrow(longest_previous, "doc long, at long, end long")
    single = opened.where("before is null").select("key", "more", "doc", "at")
    first = (single.groupBy("key", "more").agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = (single.join(first, ["key", "more"]).where((F.col("doc") != F.col("first.doc")) | (F.col("at") != F.col("first.at")))
             .select("doc", "at", (F.col("at") + LENGTH).alias("end")))
    more = marked.unionByName(again).groupBy("doc").agg(F.collect_list(F.struct("at", "end")).alias("more"))
    empty = F.array().cast("array<struct<at:long,end:long>>")
    plain = F.transform(F.filter("places", lambda p: p["end"] > 0), lambda p: F.struct(p["at"].alias("at"), p["end"].alias("end")))
    return (by_doc.join(more, "doc", "left")
            .select("doc", "text", F.concat(F.coalesce(plain, empty), F.coalesce("more", empty)).alias("ranges")))


def drop_ranges(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches, SLICE):
        buf, off = text_bytes(b.column("text"))
        ranges = b.column("ranges").flatten()
        owner = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column("ranges")).to_numpy(zero_copy_only=False))
        start = ranges.field("at").to_numpy(zero_copy_only=False) + off[owner]
        end = np.minimum(ranges.field("end").to_numpy(zero_copy_only=False) + off[owner], off[owner + 1])
        gone = marks(len(buf), start, end)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        begins[heads] = gone[heads]  # runs do not cross documents
        total, spans = (np.concatenate([[0], np.cumsum(x)])[off] for x in (gone, begins))
        left = buf[~gone].tobytes()
        at = off - total
        rest = [left[at[i]:at[i + 1]] for i in range(b.num_rows)]
        last = pa.array([x.decode(errors="ignore") for x in rest], pa.string()) if keep_text else pa.array([hashlib.sha256(x).hexdigest() for x in rest], pa.string())
        yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(np.diff(off)), pa.array(np.diff(total).astype(np.int64)), pa.array(np.diff(spans).astype(np.int64)), last],
                                         names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def repeats(docs: DataFrame, keep_text: bool, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    rows, texts = unique_documents(docs, id_col, text_col)
    out = repeated_ranges(texts).mapInArrow(lambda batches: drop_ranges(batches, keep_text),
                                            "doc long, n_bytes long, n_removed long, n_spans long, kept string")
    return rows, out


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    rows, out = repeats(docs, False, id_col, text_col)
    return (rows.select(id_col, "doc").join(out, "doc")
            .select(id_col, "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the remaining text (a character that a cut splits is left out); null texts stay null, other columns as they are."""
    rows, out = repeats(docs, True, id_col, text_col)
    return (rows.join(out.select("doc", F.col("kept").alias("__kept")), "doc")
            .withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.col("__kept"))).select(*docs.columns))
