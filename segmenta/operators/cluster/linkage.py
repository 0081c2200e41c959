"""Ward, average and complete linkage (M6, M7) by rounds in which all reciprocal nearest clusters merge at once.

Under these linkages a merger never comes nearer to a third cluster than the nearer of its two parts was.  So two clusters
that are each other's nearest stay so until they merge, whatever merges elsewhere, and merging all such pairs in
one round gives the tree that merging one pair after the other gives.  For the same reason a cluster's nearest one
stays valid until that one merges: a round asks again only for new clusters and for those whose nearest has gone.

Under all three, two clusters are no nearer than their centroids (the mean of distances is no less than the distance of
the means; Ward's factor is no less than 1).  So a merge inside a box of neighbouring centroids is the whole table's if it is
nearer than both centroids are to the box's border, whatever merges outside.  Boxes of about ``BLOCK`` clusters make all such merges at
once (``box_merges``), with other borders in every level, and leave the clusters along the borders; a few levels leave few clusters.  Where
they stop helping (many dimensions), rounds over all pairs of blocks go on.

Ward needs a cluster's size and sum.  Average and complete linkage need all distances between members: whole clusters lie in
one block, so a pair of blocks gives each asking cluster its nearest there (a row per cluster and block); a cluster too
large for that is spread over blocks of its own, and only its pairs come out as partial sums or maxima to be added up.
Under complete linkage in one or two dimensions a merged cluster keeps only the corners of its hull.

Of equally near clusters the one with the smallest key counts (a cluster's key is its smallest row's); distances are
compared to 12 digits, so that sums added up in different orders agree.  Once at most ``LOCAL`` clusters are left, their
distances fit in one task, which makes the remaining merges.  Average linkage meets every pair of vectors once for that, in pairs of
blocks: its last distances are means over all of them.  Compute of a round over all pairs of blocks is quadratic in the distinct vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...session import materialize
from . import blocks as B

LINKAGES = ("ward", "average", "complete")
LOCAL = 1024  # clusters whose merges one task finishes
BLOCK = 2048
STRIP = 64  # clusters of a block whose distances are held at once
SHARES = (0.5, 0.38, 0.62)  # where boxes are halved, by level: no border stays in its place


def rounded(gap: np.ndarray) -> np.ndarray:
    """``gap`` to 12 significant digits."""
    with np.errstate(divide="ignore", invalid="ignore"):
        unit = 10.0 ** (11 - np.floor(np.log10(gap)))
        return np.where((gap > 0) & np.isfinite(gap), np.rint(gap * unit) / unit, gap)


def ward_gaps(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Ward distances between clusters given by sums and sizes."""
    n = nx[:, None] * ny[None, :] / (nx[:, None] + ny[None, :])
    return rounded(np.sqrt(2.0 * n) * B.distances(x / nx[:, None], y / ny[:, None]))


def nearest_of(cids: np.ndarray, others: np.ndarray, gap: np.ndarray) -> pd.DataFrame:
    """Each row's nearest column; ``others`` ascend, so the first of equals is the smallest."""
    gap = np.where(cids[:, None] == others[None, :], np.inf, gap)
    best = gap.argmin(axis=1)
    out = pd.DataFrame({"cid": cids, "gap": gap[np.arange(len(cids)), best], "other": others[best]})
    return out[np.isfinite(out["gap"])]


def _ward_cell(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("cid")
    x, nx, y, ny = B.matrix(asks), asks["n"].to_numpy(float), B.matrix(rows), rows["n"].to_numpy(float)
    cids, others = asks["cid"].to_numpy(), rows["cid"].to_numpy()
    strips = [slice(k, k + STRIP) for k in range(0, len(asks), STRIP)]
    return pd.concat([nearest_of(cids[k], others, ward_gaps(x[k], nx[k], y, ny)) for k in strips]).assign(whole=True, n=0.0)


def _member_gaps(kind: str, x: pd.DataFrame, y: pd.DataFrame):
    """(clusters of x, of y, their first rows, sum or maximum of the members' distances per pair) of frames sorted by cluster."""
    gap = B.distances(B.matrix(x), B.matrix(y))
    (cx, fx), (cy, fy) = (np.unique(f["cid"].to_numpy(), return_index=True) for f in (x, y))
    if kind == "complete":
        total = np.maximum.reduceat(np.maximum.reduceat(gap, fx, axis=0), fy, axis=1)
    else:
        gap *= x["w"].to_numpy(float)[:, None] * y["w"].to_numpy(float)[None, :]
        total = np.add.reduceat(np.add.reduceat(gap, fx, axis=0), fy, axis=1)
    return cx, cy, fx, fy, total


def _member_cell(kind: str):
    """Nearest clusters among whole ones; sums or maxima for each pair with a spread cluster."""
    def work(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        asks, rows = asks.sort_values("cid"), rows.sort_values("cid")
        cx, cy, fx, fy, total = _member_gaps(kind, asks, rows)
        n = asks["n"].to_numpy(float)[fx][:, None] * rows["n"].to_numpy(float)[fy][None, :]
        spread = asks["spread"].to_numpy()[fx][:, None] | rows["spread"].to_numpy()[fy][None, :]
        spread &= cx[:, None] != cy[None, :]
        i, j = np.nonzero(spread)
        parts = pd.DataFrame({"cid": cx[i], "gap": total[i, j], "other": cy[j], "whole": False, "n": n[i, j]})
        gap = rounded(total if kind == "complete" else total / n)
        gap[spread] = np.inf
        return pd.concat([nearest_of(cx, cy, gap).assign(whole=True, n=0.0), parts])

    return work


def _pair_totals(kind: str):
    """Sums or maxima for each pair of different clusters, ``cid`` < ``other``, of a pair of blocks."""
    def work(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        same = right is None
        right = left if same else right
        if not len(left) or not len(right):
            return pd.DataFrame({"cid": left["cid"].iloc[:0], "other": left["cid"].iloc[:0], "total": np.zeros(0)})
        cx, cy, _, _, total = _member_gaps(kind, left.sort_values("cid"), right.sort_values("cid"))
        i, j = np.nonzero(cx[:, None] < cy[None, :] if same else cx[:, None] != cy[None, :])
        swapped = cx[i] > cy[j]
        return pd.DataFrame({"cid": np.where(swapped, cy[j], cx[i]), "other": np.where(swapped, cx[i], cy[j]), "total": total[i, j]})

    return work


def _dealt(rows: DataFrame, n: int, block: int) -> DataFrame:
    return rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(max(1, -(-n // block))).cast("long")))


def _placed(members: DataFrame, clusters: DataFrame, block: int) -> DataFrame:
    """``members`` (cid, w, v, n) of ``clusters`` in numbered blocks: small clusters whole, large ones (``spread``) in blocks of their own."""
    sized = members.join(clusters.select("cid", "n"), "cid").join(members.groupBy("cid").agg(F.count(F.lit(1)).alias("m")), "cid")
    spread = F.col("m") > block // 8
    bins = max(1, -(-members.count() // block))
    name = F.when(spread, F.concat_ws("/", "cid", F.pmod(F.xxhash64("vid"), F.ceil(F.col("m") / F.lit(block)))))
    named = sized.select("cid", "w", "v", "n", spread.alias("spread"),
                         F.coalesce(name, F.concat(F.lit("h"), F.pmod(F.xxhash64("cid"), F.lit(bins)))).alias("name"))
    # one row per block: their names are numbered, not the members
    numbers = named.select("name").distinct().select("name", (F.row_number().over(Window.orderBy("name")) - 1).cast("long").alias("block"))
    return named.join(numbers, "name").drop("name")


def _found_schema(kind: str) -> str:
    return f"cid {kind}, gap double, other {kind}, whole boolean, n double"


def nearest_clusters(linkage: str, asks: DataFrame, clusters: DataFrame, members: DataFrame, kind: str, n: int, block: int) -> DataFrame:
    """``cid, gap, other`` for the clusters of ``asks(cid)``."""
    if linkage == "ward":
        rows = clusters.select("cid", "n", F.col("s").alias("v"))
        found = B.over_grid(_dealt(rows.join(asks, "cid"), asks.count(), block), _dealt(rows, n, block), _ward_cell, _found_schema(kind))
    else:
        rows = materialize(_placed(members, clusters, block), "linkage-members")
        own = rows.join(asks, "cid")
        blocks = own.select("block").distinct().select("block", (F.row_number().over(Window.orderBy("block")) - 1).cast("long").alias("at"))
        own = own.join(blocks, "block").drop("block").withColumnRenamed("at", "block")
        found = B.over_grid(own, rows, _member_cell(linkage), _found_schema(kind))
        found = materialize(found, "linkage-found")
        added = F.max("gap") if linkage == "complete" else F.sum("gap") / F.max("n")
        parts = found.where(~F.col("whole")).groupBy("cid", "other").agg(added.alias("gap"))
        unit = F.pow(F.lit(10.0), 11 - F.floor(F.log10("gap")))
        parts = parts.select("cid", F.when(F.col("gap") > 0, F.rint(F.col("gap") * unit) / unit).otherwise(F.col("gap")).alias("gap"), "other")
        found = found.where("whole").select("cid", "gap", "other").unionByName(parts)
    return found.groupBy("cid").agg(F.min(F.struct("gap", "other")).alias("e")).select("cid", F.col("e.gap").alias("gap"), F.col("e.other").alias("other"))


def _merged(gap, a, b) -> tuple:
    """(distance, level) of a merge: never below its parts', and after those of the same distance that it builds on."""
    gap = max(gap, a[0], b[0])
    return gap, max([x[1] + 1 for x in (a, b) if x[0] == gap and x[1] >= 0], default=0)


def local_merges(linkage: str, clusters: pd.DataFrame, pairs: pd.DataFrame | None) -> pd.DataFrame:
    """All merges of a few clusters (cid, n, s, height, level), nearest first; ``pairs`` has the members' sums or maxima."""
    clusters = clusters.sort_values("cid").reset_index(drop=True)
    cid, n = clusters["cid"].to_numpy(), clusters["n"].to_numpy(float)
    state = list(zip(clusters["height"].tolist(), clusters["level"].tolist()))
    m = len(cid)
    if linkage == "ward":
        s = np.array(clusters["s"].tolist(), float).reshape(m, -1)
        gap = ward_gaps(s, n, s, n)
    else:
        total = np.zeros((m, m))
        i, j = np.searchsorted(cid, pairs["cid"].to_numpy()), np.searchsorted(cid, pairs["other"].to_numpy())
        total[i, j] = total[j, i] = pairs["total"].to_numpy()
        gap = rounded(total if linkage == "complete" else total / (n[:, None] * n[None, :]))
    gap[np.tril_indices(m)] = np.inf
    alive = np.ones(m, bool)
    out = []
    for _ in range(m - 1):
        lo, hi = divmod(int(gap.argmin()), m)
        state[lo] = _merged(float(gap[lo, hi]), state[lo], state[hi])
        if linkage == "ward":
            s[lo] += s[hi]
        elif linkage == "complete":
            total[lo] = np.maximum(total[lo], total[hi])
        else:
            total[lo] += total[hi]
        n[lo] += n[hi]
        n_lo = np.array([n[lo]])
        out.append((*state[lo], cid[lo], cid[hi], int(n[lo])))
        if linkage == "ward":
            row = ward_gaps(s[[lo]], n_lo, s, n)[0]
        else:
            total[:, lo] = total[lo]
            row = rounded(total[lo] if linkage == "complete" else total[lo] / (n[lo] * n))
        alive[hi] = False
        row[~alive] = np.inf
        gap[hi], gap[:, hi] = np.inf, np.inf
        gap[lo, lo + 1:], gap[:lo, lo] = row[lo + 1:], row[:lo]
    return pd.DataFrame(out, columns=["distance", "level", "lo", "hi", "size"])


def corners(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` among which one is farthest from any place: in one or two dimensions the hull's corners, else all."""
    if x.shape[1] == 1:
        return np.unique([x[:, 0].argmin(), x[:, 0].argmax()])
    if x.shape[1] != 2 or len(x) < 4:
        return np.arange(len(x))
    order = np.lexsort((x[:, 1], x[:, 0])).tolist()
    p, q = x[:, 0].tolist(), x[:, 1].tolist()
    kept = set()
    for path in (order, order[::-1]):
        chain = []
        for c in path:
            while len(chain) > 1:
                a, b = chain[-2], chain[-1]
                if (p[b] - p[a]) * (q[c] - q[a]) - (q[b] - q[a]) * (p[c] - p[a]) > 0:
                    break
                chain.pop()
            chain.append(c)
        kept.update(chain)
    return np.array(sorted(kept))


def _box_totals(linkage: str, members: pd.DataFrame) -> np.ndarray:
    """Sums or maxima of the members' distances per pair of clusters, for members sorted by cluster; some rows at once."""
    first = np.unique(members["cid"].to_numpy(), return_index=True)[1]
    x, w = B.matrix(members), members["w"].to_numpy(float)
    ends = np.append(first[1:], len(members))
    out = np.empty((len(first), len(first)))
    k = 0
    while k < len(first):
        # whole clusters of together about 256 members, one at least
        to = max(k + 1, int(np.searchsorted(ends, first[k] + 256, side="right")))
        rows = slice(first[k], ends[to - 1])
        starts = first[k:to] - first[k]
        out[k:to] = 0.0
        for strip in range(rows.start, rows.stop, 256):  # of a large cluster
            at = slice(strip, min(strip + 256, rows.stop))
            gap = B.distances(x[at], x)
            if linkage == "complete":
                part = np.maximum.reduceat(gap, first, axis=1)
                out[k:to] = np.maximum(out[k:to], np.maximum.reduceat(part, starts if to > k + 1 else [0], axis=0))
            else:
                gap *= w[at, None] * w[None, :]
                part = np.add.reduceat(gap, first, axis=1)
                out[k:to] += np.add.reduceat(part, starts if to > k + 1 else [0], axis=0)
        k = to
    return out


def _box_gaps(linkage: str, s: np.ndarray, n: np.ndarray, total: np.ndarray | None, at: np.ndarray) -> np.ndarray:
    """Distances of the clusters ``at`` to all of the box; infinite to themselves."""
    out = np.empty((len(at), len(n)))
    for k in range(0, len(at), STRIP):
        i = at[k:k + STRIP]
        if linkage == "ward":
            out[k:k + STRIP] = ward_gaps(s[i], n[i], s, n)
        else:
            out[k:k + STRIP] = rounded(total[i] if linkage == "complete" else total[i] / (n[i][:, None] * n[None, :]))
    out[np.arange(len(at)), at] = np.inf
    return out


def box_merges(linkage: str, clusters: pd.DataFrame, members: pd.DataFrame | None, low: np.ndarray, high: np.ndarray):
    """(merges, clusters left, ``home`` of each cluster) of the clusters (cid, n, s, height, level) whose centroids lie in the box ``low`` .. ``high``.

    Two clusters that are each other's nearest merge if they are nearer than both centroids are to the border.
    """
    clusters = clusters.sort_values("cid").reset_index(drop=True)
    cid, n = clusters["cid"].to_numpy(), clusters["n"].to_numpy(float)
    s = np.array(clusters["s"].tolist(), float).reshape(len(cid), -1)
    state = list(zip(clusters["height"].tolist(), clusters["level"].tolist()))
    total = None if linkage == "ward" else _box_totals(linkage, members.sort_values("cid"))
    gap = _box_gaps(linkage, s, n, total, np.arange(len(cid)))
    hair = 1e-9 * (1 + np.abs(s / n[:, None]).max(initial=0.0))  # for rounding
    at, home, out = np.arange(len(cid)), np.arange(len(cid)), []

    def room() -> np.ndarray:
        mean = s / n[:, None]
        return np.minimum(mean - low, high - mean).min(axis=1, initial=np.inf) * (1 - 1e-9) - hair

    while len(at) > 1:
        near = gap.argmin(axis=1)  # of equals the smallest key
        best, free = gap[np.arange(len(at)), near], room()
        each = np.arange(len(at))
        lo = np.flatnonzero((near[near] == each) & (each < near) & (best < np.minimum(free, free[near])))
        if not len(lo):
            break
        hi = near[lo]
        s[lo] += s[hi]
        n[lo] += n[hi]
        for i, j in zip(lo.tolist(), hi.tolist()):
            state[at[i]] = _merged(float(best[i]), state[at[i]], state[at[j]])
            out.append((*state[at[i]], cid[at[i]], cid[at[j]], int(n[i])))
            home[at[j]] = at[i]
        keep = np.ones(len(at), bool)
        keep[hi] = False
        new = np.flatnonzero(np.isin(np.flatnonzero(keep), lo))
        if total is not None:
            add = np.maximum if linkage == "complete" else np.add
            total[lo] = add(total[lo], total[hi])
            total[:, lo] = add(total[:, lo], total[:, hi])
            total = total[np.ix_(keep, keep)]
            both = np.triu(total[np.ix_(new, new)])
            total[np.ix_(new, new)] = both + np.triu(both, 1).T
        at, s, n = at[keep], s[keep], n[keep]
        gap = gap[np.ix_(keep, keep)]
        gap[new] = _box_gaps(linkage, s, n, total, new)
        gap[:, new] = gap[new].T
    while (home[home] != home).any():
        home = home[home]
    left = pd.DataFrame({"cid": cid[at], "n": n.astype(np.int64), "s": list(s), "height": [state[i][0] for i in at], "level": [state[i][1] for i in at]})
    return pd.DataFrame(out, columns=["distance", "level", "lo", "hi", "size"]), left, pd.DataFrame({"cid": cid, "home": cid[home]})


def _leaf_boxes(tree: list, low: np.ndarray, high: np.ndarray) -> list:
    """Corners of the leaves of a tree of halvings, in their order."""
    if not tree:
        return [(low, high)]
    k, border = tree[:2]
    under, over = high.copy(), low.copy()
    under[k] = over[k] = border
    return _leaf_boxes(tree[2], low, under) + _leaf_boxes(tree[3], over, high)


def _level_work(linkage: str, boxes: list, block: int, share: float):
    """Merges (side 0), clusters (1) and members (2) left by the boxes of one leaf; a crowded one is halved further."""
    def work(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = boxes[int(frame["leaf"].iat[0])]
        first = frame.drop_duplicates("cid").reset_index(drop=True)
        mean = np.array(first["s"].tolist(), float).reshape(len(first), -1) / first["n"].to_numpy(float)[:, None]
        tree = B.splits(mean, -(-len(first) // (2 * block)), share)
        leaf = B.leaves(mean, tree)
        out = []
        for k, corner in enumerate(_leaf_boxes(tree, low, high)):
            own = first[leaf == k]
            rows = frame if len(own) == len(first) else frame[frame["cid"].isin(own["cid"])]
            if not len(own):
                continue
            done, left, homes = box_merges(linkage, own, rows, *corner)
            out.append(done.assign(side=0, v=None))
            out.append(pd.DataFrame({"side": 1, "distance": left["height"], "level": left["level"], "lo": left["cid"], "hi": left["cid"], "size": left["n"], "v": left["s"]}))
            if linkage != "ward":
                rows = rows.merge(homes, on="cid")
                if linkage == "complete" and len(done):
                    rows = pd.concat([f.iloc[corners(B.matrix(f))] for _, f in rows.groupby("home")])
                out.append(pd.DataFrame({"side": 2, "distance": 0.0, "level": -1, "lo": rows["home"], "hi": rows["vid"], "size": rows["w"], "v": rows["v"]}))
        return pd.concat([f for f in out if len(f)])[["side", "distance", "level", "lo", "hi", "size", "v"]]

    return work


def merged_in_boxes(linkage: str, clusters: DataFrame, members: DataFrame, kind: str, n: int, block: int, step: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(merges, clusters, members, number of merges) after the merges that are sure inside boxes of neighbouring clusters."""
    held = n if linkage == "ward" else members.count()
    leaves = max(-(-n // block), -(-held // (4 * block)))
    mean = F.transform("s", lambda x: x / F.col("n"))
    sample = clusters.select(mean.alias("v")).orderBy(F.xxhash64("cid")).limit(B.SAMPLE).toPandas()
    share = SHARES[step % len(SHARES)]
    tree = B.splits(B.matrix(sample), leaves, share)
    d = len(sample["v"].iat[0])
    boxes = _leaf_boxes(tree, np.full(d, -np.inf), np.full(d, np.inf))

    def place(frames):
        for f in frames:
            x = np.array(f["s"].tolist(), float).reshape(len(f), -1) / f["n"].to_numpy(float)[:, None]
            yield f.assign(leaf=B.leaves(x, tree))

    rows = clusters.select("cid", "n", "s", "height", "level").mapInPandas(place, f"cid {kind}, n long, s array<double>, height double, level long, leaf long")
    if linkage != "ward":
        rows = rows.join(members, "cid")
    schema = f"side int, distance double, level long, lo {kind}, hi {kind}, size long, v array<double>"
    found, seen = materialize(rows.repartition(2 * leaves, "leaf").groupBy("leaf").applyInPandas(_level_work(linkage, boxes, block, share), schema), "linkage-boxes",
                              [F.count(F.when(F.col("side") == 0, 1)).alias("merges")])
    none = F.lit(None)
    done = found.where("side = 0").select("distance", "level", "lo", "hi", "size")
    left = found.where("side = 1").select(F.col("lo").alias("cid"), F.col("size").alias("n"), F.col("v").alias("s"), F.col("distance").alias("height"), "level",
                                          none.cast("double").alias("gap"), none.cast(kind).alias("other"))
    if linkage != "ward":
        members = found.where("side = 2").select(F.col("hi").alias("vid"), F.col("lo").alias("cid"), F.col("size").alias("w"), "v")
    return done, left, members, seen["merges"]


def merges(vec: DataFrame, linkage: str, block: int = BLOCK, local: int = LOCAL) -> DataFrame:
    """The whole tree over ``vec(vid, w, v)``: (distance, level, lo, hi, size); in order of (distance, level, lo, hi) each merge comes after its parts'."""
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {', '.join(LINKAGES)}")
    kind = vec.schema["vid"].dataType.simpleString()
    schema = f"distance double, level long, lo {kind}, hi {kind}, size long"
    none = F.lit(None)
    clusters = vec.select(F.col("vid").alias("cid"), F.col("w").alias("n"), F.transform("v", lambda x: x * F.col("w")).alias("s"), F.lit(0.0).alias("height"),
                          F.lit(-1).cast("long").alias("level"), none.cast("double").alias("gap"), none.cast(kind).alias("other"))
    members = vec.select("vid", F.col("vid").alias("cid"), "w", "v")
    tree, n = vec.sparkSession.createDataFrame([], schema), vec.count()
    step, idle = 0, 0
    while n > local and idle < 2:  # levels of other borders, until two in turn merge less than a tenth
        done, clusters, members, merged = merged_in_boxes(linkage, clusters, members, kind, n, block, step)
        tree, idle = tree.unionByName(done), idle + 1 if merged * 10 < n else 0
        n, step = n - merged, step + 1
    while n > local:
        asks = clusters.where(F.col("other").isNull()).select("cid")
        found = nearest_clusters(linkage, asks, clusters, members, kind, n, block).select("cid", F.col("gap").alias("g"), F.col("other").alias("o"))
        known = materialize(clusters.join(found, "cid", "left").withColumn("gap", F.coalesce("gap", "g")).withColumn("other", F.coalesce("other", "o"))
                            .drop("g", "o"), "linkage-nearest")
        a, b = known.alias("a"), known.alias("b")
        pairs = a.join(b, (F.col("a.other") == F.col("b.cid")) & (F.col("b.other") == F.col("a.cid")) & (F.col("a.cid") < F.col("b.cid")))
        distance = F.greatest("a.gap", "a.height", "b.height")
        level = F.greatest(*[F.when((F.col(f"{x}.height") == distance) & (F.col(f"{x}.level") >= 0), F.col(f"{x}.level") + 1) for x in "ab"])
        done, seen = materialize(pairs.select(
            distance.alias("distance"), F.coalesce(level, F.lit(0)).cast("long").alias("level"), F.col("a.cid").alias("lo"), F.col("b.cid").alias("hi"),
            (F.col("a.n") + F.col("b.n")).alias("size"), F.zip_with("a.s", "b.s", lambda x, y: x + y).alias("s")), "linkage-merges",
            [F.count(F.lit(1)).alias("n")])
        if not seen["n"]:
            raise RuntimeError("no two clusters are each other's nearest")
        tree = tree.unionByName(done.drop("s"))
        touched = done.select(F.explode(F.array("lo", "hi")).alias("t"))
        rest = known.join(touched, F.col("cid") == F.col("t"), "left_anti").join(touched, F.col("other") == F.col("t"), "left")
        rest = rest.withColumn("gap", F.when(F.col("t").isNull(), F.col("gap"))).withColumn("other", F.when(F.col("t").isNull(), F.col("other"))).drop("t")
        new = done.select(F.col("lo").alias("cid"), F.col("size").alias("n"), "s", F.col("distance").alias("height"), "level",
                          none.cast("double").alias("gap"), none.cast(kind).alias("other"))
        clusters = materialize(rest.unionByName(new), "linkage-clusters")
        n -= seen["n"]
        if linkage != "ward":
            moved = done.select(F.col("hi").alias("cid"), "lo")
            members = materialize(members.join(moved, "cid", "left").withColumn("cid", F.coalesce("lo", "cid")).drop("lo"), "linkage-labels")
    few = clusters.select(F.lit(0).alias("side"), "cid", F.col("cid").alias("other"), "n", "s", "height", "level", F.lit(0.0).alias("total"))
    if linkage != "ward":
        rows = materialize(_placed(members, clusters, block), "linkage-members")
        blocks = rows.select("block").distinct()
        pairs = blocks.select(F.col("block").alias("a")).crossJoin(blocks.select(F.col("block").alias("b"))).where("a <= b")
        parts = B.over_pairs(rows, pairs, _pair_totals(linkage), f"cid {kind}, other {kind}, total double")
        added = F.max("total") if linkage == "complete" else F.sum("total")
        # at most LOCAL * (LOCAL - 1) / 2 pairs
        sums = parts.groupBy("cid", "other").agg(added.alias("total"))
        few = few.unionByName(sums.select(F.lit(1).alias("side"), "cid", "other", F.lit(0).cast("long").alias("n"), F.array().cast("array<double>").alias("s"),
                                          F.lit(0.0).alias("height"), F.lit(-1).cast("long").alias("level"), "total"))

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        return local_merges(linkage, frame[frame["side"] == 0], None if linkage == "ward" else frame[frame["side"] == 1])

    # at most LOCAL clusters are left
    return materialize(tree.unionByName(few.withColumn("together", F.lit(0)).groupBy("together").applyInPandas(finish, schema)), "linkage-tree")
