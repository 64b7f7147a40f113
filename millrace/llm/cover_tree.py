"""Exact cosine links between vectors by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), so all bounds
are metric. Equal vectors form one class and only classes are compared. The classes are dealt
to cells around pivots, large cells again to cells around pivots of their own, and neighbouring
small cells share a block; each block gets a cover tree whose nested levels
have halving radii, and every node keeps the exact radius that covers its points. Pairs of
blocks, then pairs of nodes level by level, are dropped when the distance of their centres
exceeds both radii and the threshold distance together, and taken whole when even their
farthest points must be linked. Pairs of points that are still open are compared in double
precision on the vectors themselves.

Pairs of blocks are worked off in tiles of some blocks by some blocks. A tree travels once to a
tile; a task holds the trees of one side of the tile, and those of the other pass by. It returns
counts of links per class and a spanning forest of them; pairs are never listed.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import components, forest, hash_below, ragged_ranges, written

THRESHOLD = 0.95
#: Vectors in a block, at most, but for cells that only their hash can cut.
BLOCK = 4096
#: Blocks along a side of a tile, at most; a task holds so many trees of some 10 MB.
SIDE = 8
#: Nodes of an upper level, at most, by which a block is known before its tree is sent.
NODES = 16
#: Pivots that a large cell is dealt to, and vectors from which they are taken.
FAN, FAN_SAMPLE = 16, 64
#: The pivots of the cells are chosen from about this many vectors.
SAMPLE = 8192
MAX_CELLS = 4096
#: Characters of a cell's name that hold the length of its vectors, and that and its first pivot.
WIDTH, TOP = 9, 14
#: Block centres that are held together when pairs of blocks are looked for.
CENTRES = 16384
#: Radii of the levels. Unit vectors are at most 2 apart; below the last radius, points.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Bounds are widened by this much, so that rounding never decides.
SLACK = 1e-7
#: Pairs that one numpy step compares.
STEP = 1 << 18
#: Rows and columns of a product of matrices that stays in a core's cache.
PATCH = (256, 1024)
#: Points of a wide node, at most, that are compared without the levels between.
FEW = 8


# --- one tree -------------------------------------------------------------------------------


def unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    # Scaling by the largest component first keeps squares in range.
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def cover(points: np.ndarray, within: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres so that every point is within ``radius`` of its centre, which has the same
    parent (``within``); centres of one parent are more than ``radius`` apart.

    Returns the points that are centres, and for each point the number of its centre.
    """
    order = np.argsort(within, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(within[order]) > 0, True])
    sizes = np.diff(bounds)
    alone = order[bounds[:-1][sizes == 1]]
    centres: list[int] = alone.tolist()
    owner = np.empty(len(points), np.int64)
    owner[alone] = np.arange(len(alone))
    for lo, size in zip(bounds[:-1][sizes > 1], sizes[sizes > 1], strict=True):
        first = len(centres)
        for at in range(lo, lo + size, 512):
            part = order[at : min(at + 512, lo + size)]
            here = np.array(centres[first:], np.int64)
            if len(here):
                gaps = distances(points[part], points[here])
                best = gaps.argmin(1)
                near = gaps[np.arange(len(part)), best] <= radius
                owner[part[near]] = first + best[near]
                part = part[~near]
            # What no earlier centre covers is covered greedily, in order.
            while len(part):
                gaps = distances(points[part], points[part[:1]])[:, 0]
                gaps[0] = 0.0
                owner[part[gaps <= radius]] = len(centres)
                centres.append(int(part[0]))
                part = part[gaps > radius]
    return np.array(centres, np.int64), owner


class Tree:
    """A cover tree over unit vectors, as arrays per level from the root down.

    Nodes of a level are ordered by parent, so that the children of a node are a range. The
    last level has the points themselves, in ``order``.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        points = unit(vectors)
        n = len(points)
        owners = [np.zeros(n, np.int64)]
        chosen = [np.zeros(1, np.int64)]
        for radius in RADII:
            centres, owner = cover(points, owners[-1], radius)
            owners.append(owner)
            chosen.append(centres)
        self.order = np.lexsort(tuple(reversed(owners)))
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.vectors, self.points = vectors[self.order], points[self.order]
        self.levels = []
        for owner, centres in zip(owners, chosen, strict=True):
            at = owner[self.order]
            starts = np.flatnonzero(np.r_[True, np.diff(at) != 0])
            centre = place[centres[at[starts]]]
            level = {"at": centre, "from": starts, "to": np.r_[starts[1:], n]}
            own = np.repeat(centre, level["to"] - starts)
            dots = np.einsum("ij,ij->i", self.points, self.points[own])
            gaps = np.sqrt(np.maximum(2 - 2 * dots, 0.0))
            level["radius"] = np.maximum.reduceat(gaps, starts) + SLACK
            self.levels.append(level)
        for above, below in zip(self.levels, self.levels[1:], strict=False):
            above["child_from"] = np.searchsorted(below["from"], above["from"])
            above["child_to"] = np.searchsorted(below["from"], above["to"])
        self._finish()

    def _finish(self) -> None:
        every = np.arange(len(self.points))
        leaf = self.levels[-1]
        leaf["child_from"], leaf["child_to"] = leaf["from"], leaf["to"]
        point = {"at": every, "radius": np.zeros(len(every)), "from": every, "to": every + 1}
        self.levels = [*self.levels, point]
        for level in self.levels:
            level["centre"] = self.points[level["at"]]

    def __getstate__(self) -> dict:
        """Vectors once, in single precision where that is exact, and node numbers."""
        short = self.vectors.astype(np.float32)
        exact = np.array_equal(short.astype(np.float64), self.vectors)
        levels = [
            {k: v.astype(np.float64 if k == "radius" else np.int32) for k, v in level.items() if k != "centre"}
            for level in self.levels[:-1]
        ]
        return {"vectors": short if exact else self.vectors, "order": self.order, "levels": levels}

    def __setstate__(self, state: dict) -> None:
        self.order = state["order"]
        self.vectors = state["vectors"].astype(np.float64)
        self.points = unit(self.vectors)
        self.levels = [
            {k: v if k == "radius" else v.astype(np.int64) for k, v in level.items()}
            for level in state["levels"]
        ]
        self._finish()


def traverse(
    one: Tree, two: Tree, reach: float
) -> Iterator[tuple[str, np.ndarray, np.ndarray, int]]:
    """Descend both trees together. Yields ("all", nodes of one, nodes of two, level) for
    pairs of nodes whose points are all linked, ("own", node, node, level) for nodes whose own
    points are all linked, and ("some", points, points, level) for pairs of points that must be
    compared. In a tree against itself each pair comes once."""
    same = one is two
    a = b = np.zeros(1, np.int64)
    last = len(one.levels) - 1
    stack = [(0, a, b)]
    while stack:
        level, a, b = stack.pop()
        x, y = one.levels[level], two.levels[level]
        if len(a) > STEP:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        dots = np.einsum("ij,ij->i", x["centre"][a], y["centre"][b])
        gap = np.sqrt(np.maximum(2 - 2 * dots, 0.0))
        both = x["radius"][a] + y["radius"][b]
        keep = gap - both <= reach + SLACK
        if level == last:
            keep &= (a != b) if same else True
            if keep.any():
                yield "some", a[keep], b[keep], level
            continue
        whole = keep & (gap + both <= reach - SLACK)
        if same and (own := whole & (a == b)).any():
            yield "own", a[own], b[own], level
            whole &= ~own
            keep &= ~own
        if whole.any():
            yield "all", a[whole], b[whole], level
        a, b = a[keep & ~whole], b[keep & ~whole]
        if not len(a):
            continue
        n, m = x["child_to"][a] - x["child_from"][a], y["child_to"][b] - y["child_from"][b]
        wide = n * m
        if wide.max(initial=0) > STEP or level == 0:
            # Many children each: one product of matrices bounds all their pairs.
            big = np.flatnonzero((wide > STEP) | (level == 0))
            for i in big:
                got = _children(one, two, level, a[i], b[i], reach, same)
                stack += list(got)
            small = np.setdiff1d(np.arange(len(a)), big)
            a, b, n, m, wide = a[small], b[small], n[small], m[small], wide[small]
            if not len(a):
                continue
        turn = ragged_ranges(np.zeros(len(a), np.int64), wide)
        width = np.repeat(m, wide)
        p = np.repeat(x["child_from"][a], wide) + turn // width
        q = np.repeat(y["child_from"][b], wide) + turn % width
        if same:
            once = p <= q
            p, q = p[once], q[once]
        stack.append((level + 1, p, q))


def _open_pairs(
    one: dict, rows: np.ndarray, two: dict, columns: np.ndarray, reach: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes of two levels that their radii do not rule out, and some that rounding
    leaves in; those are bounded in double precision when their turn comes.

    Products of matrices in single precision, a patch at a time, with nodes of about equal radii
    side by side; most patches are ruled out by their largest product.
    """
    rows = rows[np.argsort(one["radius"][rows], kind="stable")]
    columns = columns[np.argsort(two["radius"][columns], kind="stable")]
    us, vs = one["centre"][rows].astype(np.float32), two["centre"][columns].astype(np.float32)
    wide_u, wide_v = one["radius"][rows], two["radius"][columns]
    # What single precision may add to a product of unit vectors, and some more.
    rounding = (us.shape[1] + 8) * 2.0**-23
    patch = np.empty(min(PATCH[0], len(us)) * min(PATCH[1], len(vs)), np.float32)
    for i in range(0, len(us), PATCH[0]):
        part = us[i : i + PATCH[0]]
        for j in range(0, len(vs), PATCH[1]):
            other = vs[j : j + PATCH[1]]
            out = patch[: len(part) * len(other)].reshape(len(part), len(other))
            dots = np.matmul(part, other.T, out=out)
            far = wide_u[i + len(part) - 1] + wide_v[j + len(other) - 1] + (reach + 2 * SLACK)
            # gap <= far, squared: 2 - 2 * dot <= far^2.
            least = 1.0 - far * far / 2 - rounding
            if dots.max() < least:
                continue
            p, q = np.nonzero(dots >= np.float32(least - rounding))
            far = wide_u[i + p] + wide_v[j + q] + (reach + 2 * SLACK)
            near = dots[p, q] >= 1.0 - far * far / 2 - rounding
            yield rows[i + p[near]], columns[j + q[near]]


def _split(tree: Tree, level: int, node: int, reach: float) -> tuple[np.ndarray, ...]:
    """Children of a node; points, and for each the child it stands for.

    A child of few points that lie farther apart than links reach is better known by its points.
    """
    here, below = tree.levels[level], tree.levels[level + 1]
    kids = np.arange(here["child_from"][node], here["child_to"][node])
    size = below["to"][kids] - below["from"][kids]
    loose = (size == 1) | (size <= FEW) & (below["radius"][kids] > reach)
    points = ragged_ranges(below["from"][kids[loose]], size[loose])
    return kids[~loose], points, np.repeat(kids[loose], size[loose])


def _children(
    one: Tree, two: Tree, level: int, a: int, b: int, reach: float, same: bool
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pairs of children of two nodes, with their level, that may have links.

    Unrelated vectors have little use for the levels between, where a child of few points is about
    as wide as all are apart. Two such children are compared by their points at once.
    """
    u, points_u, child_u = _split(one, level, a, reach)
    v, points_v, child_v = _split(two, level, b, reach)
    last, next_ = len(one.levels) - 1, level + 1
    x, y = one.levels[next_], two.levels[next_]
    p_one, p_two = one.levels[last], two.levels[last]
    for at, pairs, by_points in (
        (last, _open_pairs(p_one, points_u, p_two, points_v, reach), None),
        (next_, _open_pairs(x, u, y, v, reach), None),
        (next_, _open_pairs(x, u, p_two, points_v, reach), (None, (points_v, child_v))),
        (next_, _open_pairs(p_one, points_u, y, v, reach), ((points_u, child_u), None)),
    ):
        found, size = [], 0
        for p, q in pairs:
            if by_points is not None:
                p, q = (
                    n if known is None else known[1][np.searchsorted(known[0], n)]
                    for n, known in zip((p, q), by_points, strict=True)
                )
            if same:
                once = p < q if at == last else p <= q
                p, q = p[once], q[once]
            found.append((p, q))
            size += len(p)
            if size > STEP:
                found = [tuple(map(np.concatenate, zip(*found, strict=True)))]
                if by_points is None:
                    yield at, *found.pop()
                else:
                    found = [_distinct(*found[0])]
                size = 0
        if any(len(p) for p, _ in found):
            p, q = map(np.concatenate, zip(*found, strict=True))
            yield at, *(_distinct(p, q) if by_points is not None else (p, q))


def _distinct(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children once, which may have met by several of their points."""
    wide = int(q.max(initial=0)) + 1
    code = np.unique(p * wide + q)
    return code // wide, code % wide


def links(
    one: Tree, two: Tree, weight_one: np.ndarray, weight_two: np.ndarray,
    ids_one: np.ndarray, ids_two: np.ndarray, threshold: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weighted link counts of the points of both trees, and a forest of links.

    Weights, ids and counts follow the trees' own order of points.
    """
    reach = float(np.sqrt(2.0 - 2.0 * threshold))
    more_one, more_two = np.zeros(len(ids_one) + 1, np.int64), np.zeros(len(ids_two) + 1, np.int64)
    sum_one, sum_two = np.r_[0, np.cumsum(weight_one)], np.r_[0, np.cumsum(weight_two)]
    less = np.zeros(len(ids_one), np.int64)
    tied: list[tuple[np.ndarray, np.ndarray]] = []
    same = one is two
    for kind, a, b, level in traverse(one, two, reach):
        if kind == "some":
            cosine = np.einsum("ij,ij->i", one.points[a], two.points[b])
            a, b = a[cosine >= threshold], b[cosine >= threshold]
            np.add.at(more_one, a, weight_two[b])
            np.add.at(more_one, a + 1, -weight_two[b])
            np.add.at(more_two, b, weight_one[a])
            np.add.at(more_two, b + 1, -weight_one[a])
            tied.append((ids_one[a], ids_two[b]))
            if sum(len(p) for p, _ in tied) > STEP:
                tied = [forest(*map(np.concatenate, zip(*tied, strict=True)))]
            continue
        x, y = one.levels[level], two.levels[level]
        fa, ta, fb, tb = x["from"][a], x["to"][a], y["from"][b], y["to"][b]
        if kind == "own":
            points = ragged_ranges(fa, ta - fa)
            np.add.at(more_one, fa, sum_one[ta] - sum_one[fa])
            np.add.at(more_one, ta, sum_one[fa] - sum_one[ta])
            less[points] += weight_one[points]
            tied.append((ids_one[points], ids_one[np.repeat(fa, ta - fa)]))
            continue
        gain, back = sum_two[tb] - sum_two[fb], sum_one[ta] - sum_one[fa]
        np.add.at(more_one, fa, gain)
        np.add.at(more_one, ta, -gain)
        np.add.at(more_two, fb, back)
        np.add.at(more_two, tb, -back)
        # All are linked to all: each to the first of the other side.
        for nodes, other, own, theirs in ((fa, ta, fb, 0), (fb, tb, fa, 1)):
            size = other - nodes
            points, first = ragged_ranges(nodes, size), np.repeat(own, size)
            tied.append(
                (ids_one[points], ids_two[first]) if theirs == 0 else (ids_one[first], ids_two[points])
            )
        if sum(len(p) for p, _ in tied) > STEP:
            tied = [forest(*map(np.concatenate, zip(*tied, strict=True)))]
    count_one, count_two = np.cumsum(more_one)[:-1], np.cumsum(more_two)[:-1]
    if same:
        count_one = count_two = count_one + count_two - less
    edges = forest(*map(np.concatenate, zip(*tied, strict=True))) if tied else forest([], [])
    return count_one, count_two, *edges


# --- Spark ----------------------------------------------------------------------------------


def _pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` vectors of the sample, each the farthest from those before it: the first ones are
    centres of the upper levels of a cover tree of the sample."""
    chosen = [0]
    gap = distances(sample, sample[:1])[:, 0]
    for _ in range(n - 1):
        at = int(gap.argmax())
        if gap[at] <= 1e-6:
            break
        chosen.append(at)
        gap = np.minimum(gap, distances(sample, sample[at : at + 1])[:, 0])
    return sample[chosen]


def _plant(rows: pd.DataFrame) -> pd.DataFrame:
    tree = Tree(np.stack(rows["vector"].to_numpy()).astype(np.float64))
    root = tree.levels[0]
    few = [level for level in tree.levels if len(level["at"]) <= NODES][-1]
    ids, weights = rows["class_id"].to_numpy(), rows["n"].to_numpy()
    blob = pickle.dumps((tree, ids[tree.order], weights[tree.order]), protocol=5)
    return pd.DataFrame(
        {
            "block": [rows["block"].iloc[0]], "centre": [root["centre"][0]],
            "radius": [float(root["radius"][0])],
            "nodes": [few["centre"].ravel()], "radii": [few["radius"]], "tree": [blob],
        }
    )


def _near_order(pivots: np.ndarray) -> np.ndarray:
    """Rank of each pivot in an order in which near pivots are near each other.

    The first pivots are centres of a cover of all, so that the nearest of the first 4, 16, 64,
    ... pivots are the nodes above a pivot.
    """
    keys, size = [], 4
    while size < len(pivots):
        keys.append((pivots @ pivots[:size].T).argmax(1))
        size *= 4
    order = np.lexsort((np.arange(len(pivots)), *reversed(keys)))
    rank = np.empty(len(pivots), np.int64)
    rank[order] = np.arange(len(pivots))
    return rank


def _choose(rows: pd.DataFrame) -> pd.DataFrame:
    """Up to FAN different vectors of a cell, drawn by hash."""
    points = unit(np.stack(rows.sort_values("class_id")["vector"].to_numpy()))
    return pd.DataFrame({"cell": [rows["cell"].iloc[0]], "pivots": [_pivots(points, FAN).ravel()]})


def _deal_again(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """Some rows of a large cell, dealt to the cells around its pivots."""
    if not len(rows):
        return rows[["class_id", "n", "vector", "cell"]]
    points = unit(np.stack(rows["vector"].to_numpy()))
    some = np.zeros((0, points.shape[1]))
    if len(pivots):
        some = np.asarray(pivots["pivots"].iloc[0]).reshape(-1, points.shape[1])
    if len(some) > 1:
        nearest = _near_order(some)[(points @ some.T).argmax(1)]
        parts = [f"{c}.{k:02d}" for c, k in zip(rows["cell"], nearest, strict=True)]
    else:
        # Vectors of one direction; the hash is all that tells them apart.
        parts = [f"{c}.x{k}" for c, k in zip(rows["cell"], rows["salt"], strict=True)]
    return rows[["class_id", "n", "vector"]].assign(cell=parts)


def _in_small_cells(placed: DataFrame) -> DataFrame:
    """Cells of more than a quarter of a block dealt to cells around pivots of their own, until
    there are none. A cell that is hard to divide loses at least its pivots in each round."""
    most = max(1, BLOCK // 4)
    done = None
    while True:
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
        # A cell cut by hash stays as it is.
        large = written(sizes.where((F.col("size") > most) & ~F.col("cell").contains("x")), "large-cells")
        if not large.limit(1).count():
            return placed if done is None else done.union(placed)
        rest = placed.join(large, "cell", "left_anti").select("class_id", "n", "vector", "cell")
        done = rest if done is None else done.union(rest)
        cuts = F.ceil(F.col("size") / most)
        mine = placed.join(large, "cell").withColumn("salt", F.expr(f"pmod(class_id, ceil(size / {most}))"))
        drawn = mine.where(F.expr(f"pmod(xxhash64(class_id), size) < {FAN_SAMPLE}"))
        pivots = written(
            drawn.select("cell", "class_id", "vector").groupBy("cell").applyInPandas(
                _choose, "cell string, pivots array<double>"
            ),
            "pivots",
        )
        salted = pivots.join(large, "cell").select(
            "cell", "pivots", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)).alias("salt")
        )
        placed = written(
            mine.groupBy("cell", "salt").cogroup(salted.groupBy("cell", "salt")).applyInPandas(
                _deal_again, "class_id long, n long, vector array<double>, cell string"
            ),
            "cells",
        )


def _in_blocks(placed: DataFrame) -> DataFrame:
    """Rows with their ``block``: blocks are numbered from 0, and near cells share one."""
    spark = placed.sparkSession
    room = max(1, BLOCK - BLOCK // 4)
    sizes = written(
        placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
        .withColumn("top", F.substring("cell", 1, TOP)),
        "cell-sizes",
    )
    # Top cells in order, with the rows before each: at most MAX_CELLS a length of vectors.
    before, width, tops = 0, None, []
    for top, size in sorted(map(tuple, sizes.groupBy("top").agg(F.sum("size")).collect())):
        if top[:WIDTH] != width:  # blocks hold vectors of one length
            before, width = -(-before // room) * room, top[:WIDTH]
        tops.append((top, before))
        before += size
    firsts = spark.createDataFrame(tops, "top string, before long")
    earlier = Window.partitionBy("top").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    where = (
        sizes.withColumn("inside", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .join(F.broadcast(firsts), "top")
        .select("cell", F.floor((F.col("before") + F.col("inside")) / room).cast("long").alias("block"))
    )
    return placed.join(where, "cell").select("class_id", "n", "vector", "block")


def _meet(threshold: float):
    """Compare the trees of a tile, which come in order: tile, side, block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tile, held = None, []
        for batch in batches:
            for here, side, block, partners, blob in zip(
                *(batch[c] for c in ("tile", "side", "block", "partners", "tree")), strict=True
            ):
                if here != tile:
                    tile, held = here, []
                own = pickle.loads(blob)
                if side == 0:
                    held.append((block, own))
                    continue
                wanted = set(partners)
                for other, theirs in held:
                    if other in wanted:
                        yield _links_of(theirs, theirs if other == block else own, threshold)

    return run


def _links_of(one: tuple, two: tuple, threshold: float) -> pd.DataFrame:
    a, ids_a, weight_a = one
    b, ids_b, weight_b = two
    na, nb, x, y = links(a, b, weight_a, weight_b, ids_a, ids_b, threshold)
    ids, counts = (ids_a, na) if a is b else (np.r_[ids_a, ids_b], np.r_[na, nb])
    some = counts > 0
    size = int(some.sum()) + len(x)
    return pd.DataFrame(
        {
            "class_id": np.r_[ids[some], x],
            "n": np.r_[counts[some], np.zeros(len(x), np.int64)],
            "least": np.r_[np.full(int(some.sum()), -1), y],
            "tie": np.arange(size) >= int(some.sum()),
        }
    )


def class_links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Link counts and ties of distinct vectors (class_id, n, vector).

    Rows with ``tie`` false add ``n`` links to a class; rows with ``tie`` true say that two
    classes belong together. Vectors of different lengths are never linked.
    """
    spark = classes.sparkSession
    total = classes.count()
    cells = int(min(MAX_CELLS, max(1, -(-total // BLOCK))))
    drawn = classes.where(hash_below(F.col("class_id"), SAMPLE, total)).select("vector", "class_id").collect()
    drawn.sort(key=lambda row: row["class_id"])
    widths = {len(row[0]) for row in drawn}
    pivots = {
        w: _pivots(unit(np.array([r[0] for r in drawn if len(r[0]) == w])), cells) for w in widths
    }
    # At most MAX_CELLS vectors a length.
    sent = spark.sparkContext.broadcast({w: (p, _near_order(p)) for w, p in pivots.items()})

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            widths = batch["vector"].map(len).to_numpy()
            cell = np.empty(len(batch), object)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                near, rank = sent.value.get(width, (None, None))
                nearest = np.zeros(len(own), np.int64)
                if near is not None:
                    points = unit(np.stack(batch["vector"].iloc[own].to_numpy()))
                    nearest = rank[(points @ near.T).argmax(1)]
                cell[own] = [f"{width:0{WIDTH}d}.{k:0{TOP - WIDTH - 1}d}" for k in nearest]
            yield batch.assign(cell=cell)

    placed = written(
        classes.mapInPandas(deal, "class_id long, n long, vector array<double>, cell string"), "cells"
    )
    blocks = written(
        _in_blocks(_in_small_cells(placed)).groupBy("block").applyInPandas(
            _plant,
            "block long, centre array<double>, radius double, nodes array<double>,"
            " radii array<double>, tree binary",
        ),
        "trees",
    )
    pairs = written(_node_pairs(blocks, _block_pairs(blocks, threshold), threshold), "block-pairs")
    # Tiles as large as leaves every core some of them.
    tasks = max(1, spark.sparkContext.defaultParallelism)
    side = min(SIDE, max(1, int((pairs.count() / (4 * tasks)) ** 0.5)))
    tiled = pairs.select(F.expr(f"shiftleft(one div {side}, 31) + two div {side}").alias("tile"), "one", "two")
    rows = tiled.select("tile", F.lit(0).alias("side"), F.col("one").alias("block"), F.array().cast("array<long>").alias("partners"))
    columns = tiled.groupBy("tile", F.col("two").alias("block")).agg(F.collect_set("one").alias("partners"))
    needed = rows.distinct().union(columns.select("tile", F.lit(1).alias("side"), "block", "partners"))
    return written(
        needed.join(blocks.select("block", "tree"), "block")
        .select("tile", "side", "block", "partners", "tree")
        .repartition(4 * tasks, "tile").sortWithinPartitions("tile", "side", "block")
        .mapInPandas(_meet(threshold), "class_id long, n long, least long, tie boolean"),
        "vector-links",
    )


def _block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs of blocks (one <= two) that their covering radii do not rule out.

    The centres are held CENTRES at a time, whatever their number.
    """
    spark = blocks.sparkSession
    reach = float(np.sqrt(2.0 - 2.0 * threshold))
    roots = blocks.select("block", "centre", "radius")
    top = roots.agg(F.max("block")).first()[0]  # blocks are numbered without great gaps
    found = None
    for start in range(0, (top or 0) + 1, CENTRES):
        part = roots.where(F.col("block").between(start, start + CENTRES - 1)).collect()
        by_width: dict[int, list] = {}
        for block, centre, radius in part:
            by_width.setdefault(len(centre), []).append((block, centre, radius))
        sent = spark.sparkContext.broadcast(
            {w: tuple(map(np.array, zip(*some, strict=True))) for w, some in by_width.items()}
        )

        def meet(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for block, centre, radius in zip(batch["block"], batch["centre"], batch["radius"], strict=True):
                    others, places, sizes = sent.value.get(len(centre), ([], [], []))
                    if not len(others):
                        continue
                    gaps = np.sqrt(((places - np.asarray(centre)) ** 2).sum(1))
                    near = (others >= block) & (gaps <= radius + sizes + reach + SLACK)
                    yield pd.DataFrame({"one": block, "two": others[near]}, dtype="int64")

        some = roots.mapInPandas(meet, "one long, two long")
        found = some if found is None else found.union(some)
    return found


def _node_pairs(blocks: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs of blocks that the nodes of an upper level of their trees do not rule out.

    A block of several small cells is far wider than any of its nodes.
    """
    reach = float(np.sqrt(2.0 - 2.0 * threshold))

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            open_ = []
            for a, r, b, t in zip(*(batch[c] for c in ("a", "r", "b", "t")), strict=True):
                gaps = distances(a.reshape(len(r), -1), b.reshape(len(t), -1))
                open_.append(bool((gaps <= r[:, None] + t + reach + SLACK).any()))
            yield batch.loc[open_, ["one", "two"]]

    first = blocks.select(F.col("block").alias("one"), F.col("nodes").alias("a"), F.col("radii").alias("r"))
    second = blocks.select(F.col("block").alias("two"), F.col("nodes").alias("b"), F.col("radii").alias("t"))
    return pairs.join(first, "one").join(second, "two").mapInPandas(test, "one long, two long")


def linked(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing and are components of their own. Equal vectors are linked with each other. Rows
    with the same key are different vectors for the counts; a null key is linked like any
    other and named only where its component has no other key. Keys must be whole numbers or text of
    such. Other columns are not read.
    An empty table gives an empty result.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector")
    )
    valid = F.expr(
        "vector is not null and size(vector) > 0 and forall(vector, x -> x is not null and not"
        " isnan(x) and abs(x) < double('Infinity')) and exists(vector, x -> x != 0)"
    )
    # -0.0 and 0.0 are one number; grouping normalises them.
    good = rows.where(valid)
    classes = (
        good.groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"))
        .select(F.xxhash64("vector").alias("class_id"), "n", "least", "vector")
    )
    classes = written(classes, "vector-classes")
    found = class_links(classes.select("class_id", "n", "vector"), threshold)
    counts = found.where("not tie").groupBy("class_id").agg(F.sum("n").alias("others"))
    ties = components(found.where("tie").select(F.col("class_id").alias("a"), F.col("least").alias("b")))
    named = (
        classes.select("class_id", "n", "least")
        .join(counts, "class_id", "left")
        .join(ties, F.col("class_id") == F.col("node"), "left")
        .select(
            "class_id", "least", F.coalesce("component", "class_id").alias("component"),
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        )
    )
    named = written(named, "vector-components")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "component").select("class_id", "n_links", "component_id")
    linked_rows = good.select("key", F.xxhash64("vector").alias("class_id")).join(ids, "class_id")
    alone = rows.where(~valid | valid.isNull()).select(
        "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id")
    )
    return linked_rows.select("key", "n_links", "component_id").union(alone).select(
        F.col("key").alias(key), "n_links", "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
