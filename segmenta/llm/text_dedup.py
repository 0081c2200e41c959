"""Operator 8: near-duplicate texts by DartMinHash.

A text is the weighted set of its five-word shingles (lower case, split at white space; weight: how often; a shorter text
is one shingle).  Two texts are linked if their weighted Jaccard similarity, sum of minima over sum of maxima, is at
least the threshold; classes are the connected components.

Signatures: darts rain on every element's region (its weight wide) at one per unit of weight and rank, drawn from a hash
of (element, unit, number), and hit one of ``COORDINATES`` coordinates each.  Per coordinate the earliest dart is kept, so
two texts agree on a coordinate with probability equal to their similarity.  Only darts up to a rank of about
t (ln t + 2) / weight are thrown; a text with a coordinate still empty throws further.

Candidates: ``BANDS`` bands of ``ROWS_IN_BAND`` coordinates; at the threshold a pair of similarity 0.8 shares no band with a
probability of 5e-8.  In every bucket the members meet the smallest id (an aggregate, and a join that Spark can split).
Pairs whose signatures agree on enough coordinates (short of that with probability below 1e-6 at 0.8) are compared exactly by
their texts.  Buckets whose members then lie in several components are looked at again.  For their texts the shingles that no
other of these texts has are counted; with n shingles, u of them its own, a pair shares at most min(n - u), which bounds its
similarity from above.  First every member meets the bucket's hub, the member with the smallest share of own shingles
(the least edited copy).  Then members of still different components meet in blocks of ``BLOCK`` signatures; those with a
partner that agrees enough, whose bound allows it and with whom no earlier band is shared come back with their shingles, and the
block's similarities are computed exactly at once.  What leaves a block is a spanning forest of its links.  So no link between
different classes is lost, and no bucket's pairs are written out.

Equal word sequences are one class from the start.  Null text and text without a word are left alone, each its own
class.  Rows that share an id: the class of an id is that of all its rows.  An empty table gives no rows; extra columns are
ignored (``near_duplicates``) or kept (``keep_first``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cluster.components import connected_components
from ..session import materialize
from .textarrays import distinct_chunks, mix, ragged_take, text_rows, text_slices
from .vector_dedup import forest

SHINGLE = 5
COORDINATES = 128
ROWS_IN_BAND = 4
BANDS = COORDINATES // ROWS_IN_BAND
BLOCK = 512
ENOUGH = 80  # of 128 equal coordinates: 5 standard deviations below the mean at similarity 0.8
K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ptr, hashes) of the lower-case words of every row."""
    chunks, codes, _, rows = distinct_chunks(text)
    lists = [c.lower().split() for c in chunks.to_pylist()]
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    flat = np.fromiter((xxhash.xxh64_intdigest(w) for one in lists for w in one), np.uint64, int(ptr[-1]))
    words, at = ragged_take(ptr, flat, codes)
    return at[rows], words


def elements(ptr: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of unit-weight elements: the j-th occurrence of a shingle in its row is an element of its own."""
    n = np.diff(ptr)
    per = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), per)
    first = np.repeat(ptr[:-1], per) + np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    length = np.minimum(n, SHINGLE)[row]
    h = mix(length.astype(np.uint64))
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            on = k < length
            h[on] = mix(h[on] * K1 + words[first[on] + k])
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        at = np.arange(len(h))
        copy = at - np.maximum.accumulate(np.where(new, at, 0))
        return row, np.where(copy > 0, mix(h + copy.astype(np.uint64) * K3), h)


def dart_signatures(row: np.ndarray, h: np.ndarray, n_rows: int, t: int = COORDINATES) -> np.ndarray:
    """[row, coordinate]: the earliest dart's hash; rows without elements stay 0."""
    weight = np.bincount(row, minlength=n_rows)
    limit = t * (np.log(t) + 2) / np.maximum(weight, 1)
    best = np.full(n_rows * t, np.inf)
    sig = np.zeros(n_rows * t, np.uint64)
    rank = np.zeros(len(h))  # of the last dart thrown for each element
    number = np.zeros(len(h), np.uint64)
    active = np.arange(len(h))
    while len(active):
        who, r, k = active, rank[active], number[active]
        with np.errstate(over="ignore"):
            while len(who):
                x = mix(h[who] + (k + np.uint64(1)) * K2)
                r = r - np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
                fits = r <= limit[row[who]]
                who, r, k, x = who[fits], r[fits], k[fits] + np.uint64(1), x[fits]
                rank[who], number[who] = r, k
                dart = mix(x ^ K3)
                place = row[who] * t + (dart % np.uint64(t)).astype(np.int64)
                np.minimum.at(best, place, r)
                won = best[place] == r
                sig[place[won]] = dart[won]
        empty = np.isinf(best).reshape(n_rows, t).any(1) & (weight > 0)
        active = np.flatnonzero(empty[row])
        limit[empty] *= 2
    return sig.reshape(n_rows, t)


SIGNED = "id long, words long, h1 long, h2 long, bands array<long>, sig binary"


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: hashes of the whole word sequence, the band keys, and a byte of every coordinate."""
    for b in text_slices(batches, 4 << 20):
        ptr, words = word_hashes(b.column("text"))
        n, count = b.num_rows, np.diff(ptr)
        sig = dart_signatures(*elements(ptr, words), n)
        with np.errstate(over="ignore"):
            place = (np.arange(len(words)) - np.repeat(ptr[:-1], count)).astype(np.uint64)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(words ^ mix(place * k + k)))]) for k in (K1, K2)]
            h1, h2 = (mix((s[ptr[1:]] - s[ptr[:-1]]) + count.astype(np.uint64)) for s in sums)
            keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (n, BANDS)).copy()
            for k in range(ROWS_IN_BAND):
                keys = mix(keys * K1 + sig[:, k::ROWS_IN_BAND])
        small = (sig >> np.uint64(40)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(count), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1).view(np.int64))),
             pa.array([x.tobytes() for x in small], pa.binary())], names=["id", "words", "h1", "h2", "bands", "sig"])


def similarity(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows ``a, b, text_a, text_b`` -> the pairs whose weighted Jaccard similarity reaches the threshold."""
    for b in text_slices(text_slices(batches, column="text_a"), column="text_b"):
        sets = []
        for name in ("text_a", "text_b"):
            row, h = elements(*word_hashes(b.column(name)))
            sets.append(np.split(h, np.searchsorted(row, np.arange(1, b.num_rows))))
        good = np.zeros(b.num_rows, bool)
        for i, (x, y) in enumerate(zip(*sets, strict=True)):
            both = len(np.intersect1d(x, y, assume_unique=True))
            good[i] = both >= threshold * (len(x) + len(y) - both) and both > 0
        keep = pa.array(good)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def most_similar(n_a, u_a, n_b, u_b):
    """Upper bound of the similarity of texts with n elements, of which u occur in no other text (numpy or columns alike)."""
    least = np.minimum if isinstance(n_b, np.ndarray) else F.least
    shared = least(n_a - u_a, n_b - u_b)
    return shared / (n_a + n_b - shared)


def meet_again(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Cells of two blocks of a bucket's members -> members with a partner of another component that may be similar enough."""
    for b in batches:
        for at in range(b.num_rows):
            sides = []
            for name in ("left", "right"):
                one = b.column(name)[at].values
                sig = np.frombuffer(b"".join(one.field("sig").to_pylist()), np.uint8).reshape(-1, COORDINATES)
                keys = one.field("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
                sides.append([one.field(c).to_numpy(zero_copy_only=False) for c in ("id", "comp", "n", "u")] + [sig, keys])
            (ida, ca, na, ua, sa, ka), (idb, cb, nb, ub, sb, kb) = sides
            band = b.column("band")[at].as_py()
            met_a, met_b = np.zeros(len(ida), bool), np.zeros(len(idb), bool)
            for k in range(len(ida)):
                may = np.flatnonzero((cb != ca[k]) & (most_similar(np.full(len(nb), na[k]), np.full(len(nb), ua[k]), nb, ub) >= threshold))
                may = may[(sb[may] == sa[k]).sum(1) >= ENOUGH]
                may = may[(kb[may] == ka[k]).argmax(1) == band]  # by the buckets' own keys: a byte of a coordinate may agree by chance
                met_a[k] = len(may) > 0
                met_b[may] = True
            ids = np.unique(np.concatenate([ida[met_a], idb[met_b]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), b.column(c)[at].as_py(), np.int64)) for c in ("key", "i", "j")] + [pa.array(ids)],
                                             names=["key", "i", "j", "id"])


def element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches, 4 << 20):
        row, h = elements(*word_hashes(b.column("text")))
        sets = np.split(h, np.searchsorted(row, np.arange(1, b.num_rows)))
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x.tobytes() for x in sets], pa.binary())], names=["id", "elements"])


def exact_links(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One cell's ``id, comp, elements`` -> a spanning forest of its links between different components."""
    sets = [np.frombuffer(x, np.uint64) for x in pdf["elements"]]
    n = np.array(list(map(len, sets)), np.int64)
    who, column = np.repeat(np.arange(len(sets)), n), np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width + 1, width))
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        has = np.zeros((len(sets), width), np.float32)
        has[who[lo:hi], column[lo:hi] - k * width] = 1
        shared += has @ has.T
    comp, ids = pdf["comp"].to_numpy(np.int64), pdf["id"].to_numpy(np.int64)
    both = shared.astype(np.float64)
    linked = (both >= threshold * (n[:, None] + n[None, :] - both)) & (comp[:, None] != comp[None, :])
    return pd.DataFrame(forest(linked, ids, ids), columns=["a", "b"], dtype=np.int64)


def element_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and element: how many texts have it, and one of them."""
    for b in text_slices(batches, 4 << 20):
        row, h = elements(*word_hashes(b.column("text")))
        each, first, n = np.unique(h, return_index=True, return_counts=True)
        ids = b.column("id").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(n), pa.array(ids[row[first]])], names=["h", "n", "id"])


def own_elements(texts: DataFrame) -> DataFrame:
    """``id, u``: elements of a text that no other of ``texts`` has (no row where there are none).

    An id that stands for different texts has no row: their elements cannot be told apart by the id.
    """
    h = F.xxhash64("text")
    different = texts.groupBy("id").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("id")
    counts = texts.mapInArrow(element_counts, "h long, n long, id long").groupBy("h").agg(F.sum("n").alias("n"), F.min("id").alias("id"))
    return counts.where("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("u")).join(different, "id", "left_anti")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, name: str) -> DataFrame:
    """Pairs ``a, b`` that hold up by their texts."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return materialize(both.mapInArrow(lambda batches: similarity(batches, threshold), "a long, b long"), name)


def agreement(x: str, y: str):
    """Equal coordinates of two signatures, in SQL."""
    pick = F.sequence(F.lit(1), F.lit(COORDINATES))
    return F.size(F.filter(pick, lambda i: F.substring(x, i, F.lit(1)) == F.substring(y, i, F.lit(1))))


def classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, component``: smallest id of the class of every id."""
    rows = text_rows(docs, id_col, text_col).where("id is not null")
    signed = materialize(rows.mapInArrow(signatures, SIGNED), "signatures")
    worded = signed.where("words > 0")
    exact = worded.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    member = worded.select("id", "h1", "h2").distinct().join(exact, ["h1", "h2"]).select("id", "rep")
    # one row per class of equal texts; an id may stand for several if its rows differ
    reps = materialize(worded.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.min_by(F.struct("bands", "sig", "words"), "id").alias("s"))
                       .select("id", "s.bands", "s.sig", F.greatest(F.col("s.words") - SHINGLE + 1, F.lit(1)).alias("n")), "representatives")
    spread = reps.select("id", F.posexplode("bands").alias("band", "key"))
    centres = spread.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    in_bucket = materialize(spread.join(centres, "key").where("id <> centre"), "buckets")
    stars = in_bucket.select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    sigs = reps.groupBy("id").agg(F.collect_list("sig").alias("sigs"))
    close = F.exists("sigs_a", lambda x: F.exists("sigs_b", lambda y: agreement(x, y) >= ENOUGH))
    likely = (stars.join(sigs.select(F.col("id").alias("b"), F.col("sigs").alias("sigs_b")), "b")
              .join(sigs.select(F.col("id").alias("a"), F.col("sigs").alias("sigs_a")), "a").where(close).select("a", "b"))
    wanted = in_bucket.select("id").union(in_bucket.select("centre")).distinct()
    texts = materialize(rows.join(wanted, "id", "left_semi"), "texts")
    links = verified(likely, texts, threshold, "links")
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(member.where("id <> rep").select("id", "rep"))
    first = materialize(connected_components(worded.select("id"), edges), "components")
    # buckets whose members, but for the centre that all have met, lie in several components
    about = in_bucket.select("key", "band", "id").join(first, "id")
    open_ = materialize(about.join(several(about), "key").join(reps.select("id", "sig", "bands", "n"), "id"), "open-buckets")
    own = own_elements(texts.join(open_.select("id").distinct(), "id", "left_semi"))
    members = materialize(open_.join(own, "id", "left").withColumn("u", F.coalesce("u", F.lit(0))), "open-members")
    hubs = members.groupBy("key").agg(F.min_by(F.struct("id", "comp", "sig", "n", "u"), F.struct(F.col("u") / F.col("n"), "id")).alias("hub"))
    may = ((F.col("hub.comp") != F.col("comp")) & (most_similar(F.col("hub.n"), F.col("hub.u"), F.col("n"), F.col("u")) >= threshold)
           & (agreement("hub.sig", "sig") >= ENOUGH))
    to_hub = (members.join(hubs, "key").where(may)
              .select(F.least("hub.id", "id").alias("a"), F.greatest("hub.id", "id").alias("b")).distinct())
    second = materialize(merged(first, verified(to_hub, texts, threshold, "hub-links")), "components")
    rest = members.drop("comp", "size").join(second, "id")
    dealt = (rest.join(several(rest), "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK))
             .withColumn("block", F.pmod(F.xxhash64("id"), "blocks")))
    blocks = dealt.groupBy("key", "band", "blocks", "block").agg(F.collect_list(F.struct("id", "comp", "n", "u", "sig", "bands")).alias("members"))
    left = blocks.select("key", "band", F.col("block").alias("i"), F.col("members").alias("left"),
                         F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    cells = left.join(blocks.select("key", F.col("block").alias("j"), F.col("members").alias("right")), ["key", "j"])
    met = materialize(cells.select("key", "band", "i", "j", "left", "right")
                      .mapInArrow(lambda batches: meet_again(batches, threshold), "key long, i long, j long, id long"), "met")
    sets = texts.join(met.select("id").distinct(), "id", "left_semi").mapInArrow(element_rows, "id long, elements binary")
    more = (met.join(sets, "id").join(second, "id").groupBy("key", "i", "j")
            .applyInPandas(lambda pdf: exact_links(pdf, threshold), "a long, b long"))
    return merged(second, materialize(more, "more-links")).withColumnRenamed("comp", "component")


def several(members: DataFrame) -> DataFrame:
    """``key, size`` of the buckets of ``members(key, id, comp)`` that hold several components."""
    return (members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
            .where("lo <> hi").select("key", "size"))


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components(id, comp)`` with those that ``links(a, b)`` join made one."""
    named = lambda side: components.select(F.col("id").alias(side), F.col("comp").alias(f"comp_{side}"))
    joined = links.join(named("a"), "a").join(named("b"), "b").select(F.col("comp_a").alias("src"), F.col("comp_b").alias("dst"))
    top = connected_components(components.select(F.col("comp").alias("id")), joined)
    return components.join(top.select(F.col("id").alias("comp"), F.col("comp").alias("top")), "comp").select("id", F.col("top").alias("comp"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, component_id, kept`` for every row; ``kept``: the row's id is the smallest of its class."""
    found = classes(docs, threshold, id_col, text_col)
    out = docs.select(F.col(id_col).cast("long").alias("id")).join(found, "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("component", "id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of its class; of rows that share an id and stay, equal texts stay once.

    Rows with a null id, or with a null text, all stay.
    """
    gone = near_duplicates(docs, threshold, id_col, text_col).where("not kept").select(id_col).distinct()
    rest = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    shared = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not shared.limit(1).count():
        return rest
    alone = F.when(F.col(id_col).isNull() | F.col(text_col).isNull(), F.monotonically_increasing_id())
    return rest.withColumn("__alone", alone).dropDuplicates([id_col, text_col, "__alone"]).drop("__alone")
