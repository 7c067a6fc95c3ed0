"""Nearest vectors by inner product through a low-dimensional stable projection.

Inner products become distances by lifting: every vector x gets one more component sqrt(M^2 - |x|^2), M being the largest norm
of its length, and a query gets 0 there, so that |q - x|^2 = |q|^2 + M^2 - 2 q.x. A Gaussian matrix (the normal law is 2-stable)
projects the lifted vectors to ``DIMS`` numbers: the squared distance of two projections is the squared distance of
the vectors times a chi-square variable of ``DIMS`` degrees of freedom.

1. At most ``SAMPLE`` projections give the cuts of a kd-tree of at most ``CELLS`` cells. Every vector is indexed: it goes to its
   cell, and cells beyond ``TREE_BYTES`` are dealt to several trees by a hash, so no tree grows with the data.
2. A tree is a balanced kd-tree over its vectors' projections, with the box of every node.
3. A search takes projected neighbours in rounds of 1, 2, 4, ... leaves a query, nearest boxes first, and verifies
   them by their true inner products. With d the distance of the k-th best so far, it stops when the next box or point is
   projected farther than d sqrt(x), x being the quantile of the chi-square law at ``CHANCE``: a vector that
   belongs among the k best would be projected nearer with at least that probability. Boxes of inner nodes
   cut off whole subtrees by the same test.
4. Every query first searches the tree of its own cell. The k-th best there is the bound in all other cells,
   and cells whose boxes stop the test are not visited.

So each of the k true neighbours is found with a probability of at least ``CHANCE``; tests measure the recall against brute
force. Scores are inner products in double precision, summed from the first component to the last, so equal vectors tie.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import stored

DIMS = 10                    # even, for the closed form of the chi-square law
CHANCE = 0.95
SAMPLE = 16_384              # projections that place the cells; every vector is indexed
CELLS = 1024
TREE_BYTES = 4 << 20         # of a tree's vectors
LEAF = 128
QUERY_BLOCK = 4096


def chi_square_quantile(chance: float, dims: int) -> float:
    """x with P[chi-square of ``dims`` (even) degrees of freedom <= x] = ``chance``, by bisection."""
    def law(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if law(mid) < chance else (low, mid)
    return high


def tree_rows(length: int) -> int:
    return max(LEAF, TREE_BYTES // (8 * max(1, length)))


def gaussian(length: int) -> np.ndarray:
    return np.random.default_rng([2014, length]).standard_normal((length + 1, DIMS))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _norms(x: np.ndarray) -> np.ndarray:
    return (x ** 2).sum(axis=1)


def projected(x: np.ndarray, top2: float | None) -> np.ndarray:
    """Projections of vectors lifted to the squared norm ``top2``, or of queries (None)."""
    lift = np.zeros(len(x)) if top2 is None else np.sqrt(np.maximum(top2 - _norms(x), 0))
    a = gaussian(x.shape[1])
    return x @ a[:-1] + np.outer(lift, a[-1])


# -- kd-trees --------------------------------------------------------------------------------------

class Cuts:
    """Cuts of space into cells, from a sample of projections."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim, self.value, self.child = [], [], []
        self.cells = 0
        cells = max(1, min(cells, len(sample) // 4))
        self.root = self._cut(sample, cells)
        self.dim, self.value, self.child = np.array(self.dim, int), np.array(self.value), np.array(self.child, int).reshape(-1, 2)

    def _cut(self, x: np.ndarray, cells: int) -> int:
        """A node's number, or -1 - cell."""
        if cells > 1 and len(x):
            d = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
            at = np.quantile(x[:, d], (cells // 2) / cells)
            left = x[:, d] < at
            if left.any() and not left.all():
                node = len(self.dim)
                self.dim.append(d)
                self.value.append(at)
                self.child.append([0, 0])
                self.child[node] = [self._cut(x[left], cells // 2), self._cut(x[~left], cells - cells // 2)]
                return node
        self.cells += 1
        return -self.cells

    def cell(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root)
        while (rows := np.flatnonzero(at >= 0)).size:
            node = at[rows]
            at[rows] = self.child[node, (x[rows, self.dim[node]] >= self.value[node]).astype(int)]
        return -1 - at


def build_tree(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): the rows in the order of the leaves, and where each leaf begins, with the end. There are a power of
    two leaves; each level cuts every node at the middle of its widest dimension."""
    order, bounds = np.arange(len(p)), np.array([0, len(p)])
    while len(p) > LEAF * (len(bounds) - 1):
        middles = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own, mid = order[a:b], (a + b) // 2
            if b - a > 1:
                x = p[own]
                d = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
                order[a:b] = own[np.argpartition(x[:, d], mid - a)]
            middles.append(mid)
        bounds = np.sort(np.concatenate([bounds, middles]))
    return order, bounds


class Tree:
    """A tree as the search reads it: vectors and projections in the order of the leaves, boxes by level."""

    def __init__(self, ids, rows, x, p, bounds):
        self.ids, self.rows, self.x, self.p, self.bounds = ids, rows, x, p, bounds
        low = np.array([p[a:b].min(axis=0) if b > a else np.full(DIMS, np.inf) for a, b in zip(bounds[:-1], bounds[1:])])
        high = np.array([p[a:b].max(axis=0) if b > a else np.full(DIMS, -np.inf) for a, b in zip(bounds[:-1], bounds[1:])])
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = np.minimum(low[0::2], low[1::2]), np.maximum(high[0::2], high[1::2])
            self.levels.append((low, high))
        self.levels.reverse()


def box_distance(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes (row by row); an empty box is infinitely far."""
    gap = np.maximum(np.maximum(low - p, p - high), 0)
    return (gap ** 2).sum(axis=-1)


class Search:
    """Search of a block of queries in one tree."""

    def __init__(self, q: np.ndarray, own: np.ndarray, top2: float, k: int, floor: np.ndarray, floor_id: np.ndarray):
        self.q, self.own, self.k = q, own, k
        self.base = _norms(q) + top2
        self.slack = 1e-12 * self.base
        self.quantile = chi_square_quantile(CHANCE, DIMS)
        self.floor, self.floor_id = floor, floor_id          # a score that k others are known to reach, or -inf
        self.kth = floor.copy()
        self.found = (np.zeros(0, int), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))   # query, score, id, row
        self.verified = 0

    def limit(self, rows) -> np.ndarray:
        """The squared projected distance at which the stopping test holds."""
        return self.quantile * (np.maximum(self.base[rows] - 2 * self.kth[rows], 0) + self.slack[rows])

    def run(self, tree: Tree) -> None:
        p = projected(self.q, None)
        rows, node = np.arange(len(self.q)), np.zeros(len(self.q), int)
        for level, (low, high) in enumerate(tree.levels):
            if level:
                rows, node = np.repeat(rows, 2), np.repeat(node * 2, 2) + np.tile([0, 1], len(node))
            far = box_distance(p[rows], low[node], high[node])
            go = far <= self.limit(rows)
            go &= np.isfinite(far)
            rows, node, far = rows[go], node[go], far[go]
        order = np.lexsort((far, rows))
        rows, node, far = rows[order], node[order], far[order]
        first = np.searchsorted(rows, np.arange(len(self.q)))
        turn = np.arange(len(rows)) - first[rows] if len(rows) else rows
        done, step = 0, 1
        while len(rows) and done <= turn.max():
            now = (turn >= done) & (turn < done + step)
            now &= far <= self.limit(rows)
            if not now.any():
                break                        # boxes come by distance: nobody has a nearer one
            self._verify(tree, p, rows[now], node[now])
            done, step = done + step, step * 2

    def _verify(self, tree: Tree, p: np.ndarray, rows: np.ndarray, leaves: np.ndarray) -> None:
        new = [self.found]
        order = np.argsort(leaves, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(leaves[order])) + 1):
            r, leaf = rows[part], int(leaves[part[0]])
            a, b = tree.bounds[leaf], tree.bounds[leaf + 1]
            x, y = p[r], tree.p[a:b]
            far = _norms(x)[:, None] + _norms(y)[None, :] - 2 * x @ y.T
            near = far <= (self.limit(r) * (1 + 1e-9) + 1e-9 * self.base[r])[:, None]
            near &= tree.rows[a:b][None, :] != self.own[r][:, None]
            self.verified += int(near.sum())
            score = self.q[r] @ tree.x[a:b].T
            i, j = np.nonzero(near & (score >= (self.kth[r] - 1e-9 * self.base[r])[:, None]))
            if len(i):
                new.append((r[i], _scores(self.q[r[i]], tree.x[a + j]), tree.ids[a + j], tree.rows[a + j]))
        rows, score, ids, at = (np.concatenate(c) for c in zip(*new))
        keep = (score > self.floor[rows]) | ((score == self.floor[rows]) & (ids <= self.floor_id[rows]))
        rows, score, ids, at = rows[keep], score[keep], ids[keep], at[keep]
        order = np.lexsort((at, ids, -score, rows))
        rows, score, ids, at = rows[order], score[order], ids[order], at[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep, last = rank < self.k, rank == self.k - 1
        self.found = rows[keep], score[keep], ids[keep], at[keep]
        self.kth[rows[last]] = np.maximum(self.kth[rows[last]], score[last])


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component on."""
    out = np.zeros(len(q))
    for k in range(q.shape[1]):
        out += q[:, k] * x[:, k]
    return out


# -- the distributed index -------------------------------------------------------------------------

_TREE = "length int, cell int, chunk int, n int, ids binary, at binary, vectors binary, points binary, bounds binary"
_FOUND = "query_row long, query_id long, vec_id long, cand_row long, score double"


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(row, vec_id, v, length, norm2) of the rows that take part, as a stored table: those with an id and a vector of finite
    numbers that are not all zero."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(~F.coalesce(bad, F.lit(True)))
         .select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v")))
    v = v.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).where("norm2 > 0")
    return stored(v.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("length"), "norm2"),
                  "usable")


def _search_trees(tasks: DataFrame, trees: DataFrame, tops: dict[int, float], k: int, blocks: int) -> DataFrame:
    def search(asked: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "cand_row": []}, dtype="int64").assign(score=np.zeros(0))
        if not len(asked) or not len(pages):
            return out
        t = pages.iloc[0]
        tree = Tree(np.frombuffer(t["ids"], np.int64), np.frombuffer(t["at"], np.int64),
                    np.frombuffer(t["vectors"]).reshape(t["n"], -1), np.frombuffer(t["points"]).reshape(t["n"], DIMS),
                    np.frombuffer(t["bounds"], np.int64))
        own = asked["query_row"].to_numpy(np.int64)
        floor = asked["floor_score"].to_numpy(np.float64, na_value=-np.inf)
        floor = np.where(np.isnan(floor), -np.inf, floor)
        s = Search(_matrix(asked["v"]), own, tops[int(t["length"])], k, floor,
                   asked["floor_id"].fillna(np.iinfo(np.int64).max).to_numpy(np.int64))
        s.run(tree)
        q, score, ids, at = s.found
        return pd.DataFrame({"query_row": own[q], "query_id": asked["query_id"].to_numpy(np.int64)[q], "vec_id": ids,
                             "cand_row": at, "score": score})

    keys = ["length", "cell", "chunk", "block"]
    asked = tasks.withColumn("block", F.pmod(F.xxhash64("query_row", F.lit(9)), F.lit(blocks)).cast("int"))
    # A tree is copied once for each block of queries that asks for it.
    wanted = asked.select(*(F.col(c).alias(f"w_{c}") for c in keys)).distinct()
    copies = trees.join(wanted, [F.col(c) == F.col(f"w_{c}") for c in keys[:3]]).drop(*keys[:3]).withColumnRenamed("w_length", "length")
    return (asked.groupBy(*keys).cogroup(copies.groupBy("length", *(f"w_{c}" for c in keys[1:])))
            .applyInPandas(search, _FOUND))


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "cand_row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row of ``vectors`` (as :func:`whole_vectors` gives them) that the
    condition ``is_query`` holds for, the ``k`` rows with the largest inner products that the search finds, ties to the
    smaller vec_id.

    A row is no candidate of its own; other rows are, also with the same vec_id or the same vector, so an id that repeats
    can come more than once, and each row of a repeated query id has ranks of its own. Rows with a null, zero or
    not finite vector take no part, nor do rows without id; vectors of another length are no candidates. Fewer
    candidates give fewer rows, and empty tables none. Extra columns are not read.
    """
    spark = vectors.sparkSession
    # One row for each length that occurs.
    facts = {r["length"]: (r["n"], r["top"] * (1 + 1e-12)) for r in
             vectors.groupBy("length").agg(F.count("*").alias("n"), F.max("norm2").alias("top")).collect()}
    tops = {d: top for d, (_, top) in facts.items()}
    total = max(1, sum(n for n, _ in facts.values()))

    def project(batches):
        for df in batches:
            for d, part in df.groupby("length", sort=True):
                yield pd.DataFrame({"length": part["length"], "p": list(projected(_matrix(part["v"]), tops[d]))})

    share = int(min(1.0, SAMPLE / total) * (1 << 20))
    sample = (vectors.where(F.pmod(F.xxhash64("row", F.lit(4)), F.lit(1 << 20)) < max(1, share)).select("length", "v")
              .mapInPandas(project, "length int, p array<double>").limit(2 * SAMPLE).toPandas())
    by_length = dict(tuple(sample.groupby("length"))) if len(sample) else {}
    cuts = {d: Cuts(_matrix(by_length[d]["p"]) if d in by_length else np.zeros((0, DIMS)), min(CELLS, -(-2 * n // tree_rows(d))))
            for d, (n, _) in facts.items()}
    sent = spark.sparkContext.broadcast(cuts)

    def to_cells(is_asked: bool):
        def run(batches):
            for df in batches:
                for d, part in df.groupby("length", sort=True):
                    p = projected(_matrix(part["v"]), None if is_asked else tops[d])
                    yield part.assign(cell=sent.value[d].cell(p), p=list(p))
        return run

    placed = "row long, vec_id long, v array<double>, length int, cell int, p array<double>"
    cells = stored(vectors.select("row", "vec_id", "v", "length").mapInPandas(to_cells(False), placed), "cells")
    # One row for each cell: at most CELLS for each length, with the cell's box.
    box = [f(F.col("p")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(DIMS)]
    stats = cells.groupBy("length", "cell").agg(F.count("*").alias("n"), *box).collect()
    chunks = {(r["length"], r["cell"]): -(-r["n"] // tree_rows(r["length"])) for r in stats}
    boxes = {(r["length"], r["cell"]): tuple(np.array([r[f"{n}{i}"] for i in range(DIMS)]) for n in ("low", "high")) for r in stats}
    plan = spark.createDataFrame([(*key, n) for key, n in chunks.items()], "length int, cell int, chunks int")

    def build(df: pd.DataFrame) -> pd.DataFrame:
        p, x = _matrix(df["p"]), _matrix(df["v"])
        order, bounds = build_tree(p)
        return pd.DataFrame([{
            "length": df["length"].iloc[0], "cell": df["cell"].iloc[0], "chunk": df["chunk"].iloc[0], "n": len(df),
            "ids": df["vec_id"].to_numpy(np.int64)[order].tobytes(), "at": df["row"].to_numpy(np.int64)[order].tobytes(),
            "vectors": np.ascontiguousarray(x[order]).tobytes(), "points": np.ascontiguousarray(p[order]).tobytes(),
            "bounds": bounds.astype(np.int64).tobytes()}])

    chunk = F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int")
    dealt = cells.join(F.broadcast(plan), ["length", "cell"]).withColumn("chunk", chunk)       # at most CELLS rows a length
    trees = stored(dealt.groupBy("length", "cell", "chunk").applyInPandas(build, _TREE), "trees")

    asked = stored(vectors.where(is_query).select("row", "vec_id", "v", "length").mapInPandas(to_cells(True), placed), "asked")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    # A query outside all cells' boxes still has the cell of the cuts; where no vector is, it has no home.
    home = (asked.join(F.broadcast(plan), ["length", "cell"]).withColumn("chunk", chunk)
            .select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "v", "length", "cell", "chunk",
                    F.lit(None).cast("double").alias("floor_score"), F.lit(None).cast("long").alias("floor_id")))
    first = stored(_search_trees(home, trees, tops, k, blocks), "first")
    floor = (_best(first, k).where(F.col("rank") == k)
             .select("query_row", F.col("score").alias("floor_score"), F.col("vec_id").alias("floor_id")))
    seeded = asked.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "v", "length", "p").join(
        floor, "query_row", "left")
    sent_boxes = spark.sparkContext.broadcast((boxes, chi_square_quantile(CHANCE, DIMS)))
    names = ["query_row", "query_id", "v", "length", "cell", "floor_score", "floor_id"]

    def routes(batches):
        boxes, quantile = sent_boxes.value
        for df in batches:
            for d, part in df.groupby("length", sort=True):
                p = _matrix(part["p"])
                base = _norms(_matrix(part["v"])) + tops[d]
                score = part["floor_score"].to_numpy(np.float64, na_value=np.nan)
                reach = np.where(np.isnan(score), np.inf, quantile * (np.maximum(base - 2 * score, 0) + 1e-12 * base))
                for (length, cell), (low, high) in boxes.items():
                    if length == d:
                        go = box_distance(p, low, high) <= reach
                        if go.any():
                            yield part[go].assign(cell=cell)[names]

    reached = (seeded.mapInPandas(
        routes, "query_row long, query_id long, v array<double>, length int, cell int, floor_score double, floor_id long")
        .join(F.broadcast(plan), ["length", "cell"])
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks"))
    own = home.select("query_row", F.col("cell").alias("home"), F.col("chunk").alias("home_chunk"))
    tasks = (reached.join(own, "query_row", "left")
             .where(~((F.col("cell") == F.col("home")) & (F.col("chunk") == F.col("home_chunk"))) | F.col("home").isNull()))
    rest = _search_trees(tasks.drop("home", "home_chunk"), trees, tops, k, blocks)
    out = _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return out
