"""Exact top-k by inner product with M-trees.

Inner products become distances by lifting: every vector x gets one more component
sqrt(M^2 - |x|^2), M being the largest norm, and a query gets 0 there. Then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest vectors are those with the largest inner products, and the
triangle inequality holds.

* The vectors are dealt to cells around at most ``PIVOTS`` sampled vectors, and cells beyond ``TREE_ROWS``
  vectors into several trees by a hash, so no tree grows with the data, also not by equal vectors.
* A tree is a set of pages. An entry of an inner page is a routing vector with its covering radius, its
  distance to the page's own routing vector (the parent distance), the child page and the smallest
  id below it; a leaf entry is a vector with its parent distance.
* The search goes best first: the page with the smallest lower bound comes next. With the distance d(q, p) to
  the page's routing vector known, an entry whose |d(q, p) - parent distance| - radius is beyond the k-th best
  distance is passed over without computing its distance. A block of queries shares the pages it reads, each
  query with bounds of its own.
* Every query first searches the tree of its own cell. The k-th best score there bounds the search
  in all other cells, and cells whose covering radius rules them out are not visited.

Scores are exact whole numbers. Bounds are floating-point with a margin that is far above their error, so
that rounding never excludes anything; a subtree of equal vectors is compared by exact score and smallest
id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import stored

PIVOTS = 256
TREE_ROWS = 4096
PAGE = 64
QUERY_BLOCK = 1024
_PAGES = ("cell string, chunk int, page int, leaf boolean, ids binary, vectors binary, lift binary, parent binary, "
          "radius binary, least binary, single binary")


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): each component as floor(256 x). Vectors that are null or hold a null or a number that is not
    finite, and rows without id, are left out. Rows that repeat an id with another vector are vectors of their own; rows that
    repeat both count once."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(~F.coalesce(bad, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c * 256).cast("long")).alias("v")).distinct())


def _matrix(column, width: int | None = None) -> np.ndarray:
    rows = [np.asarray(v, np.int64) for v in column]
    return np.stack(rows) if rows else np.zeros((0, width or 0), np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors: in floating point where every sum stays below 2^53."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= 2.0 ** 53:
        return a @ b.T
    return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)


def _norms(a: np.ndarray) -> np.ndarray:
    return (a.astype(np.float64) ** 2).sum(axis=1)


def _apart(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Distances between lifted vectors."""
    sq = (_norms(a) + la ** 2)[:, None] + (_norms(b) + lb ** 2)[None, :]
    return np.sqrt(np.maximum(sq - 2 * (a.astype(np.float64) @ b.T.astype(np.float64) + np.outer(la, lb)), 0))


# -- building --------------------------------------------------------------------------------------

def build_pages(ids: np.ndarray, x: np.ndarray, lift: np.ndarray) -> list[dict]:
    """The pages of one tree. Page 0 has one entry, the root's routing vector."""
    pages: list[dict] = []
    margin = 1e-9 * (1 + float(np.sqrt((_norms(x) + lift ** 2).max())))

    def place(rows: np.ndarray) -> int:
        pages.append({})
        return len(pages) - 1

    def entry_of(rows: np.ndarray, seed: int, centre: int | None) -> dict:
        far = _apart(x[rows], lift[rows], x[[seed]], lift[[seed]])[:, 0]
        same = bool((x[rows] == x[seed]).all())
        back = 0.0 if centre is None else float(_apart(x[[seed]], lift[[seed]], x[[centre]], lift[[centre]])[0, 0])
        return {"seed": seed, "radius": 0.0 if same else float(far.max()) + margin, "parent": back,
                "least": int(ids[rows].min()), "single": same}

    todo = [(np.arange(len(ids)), int(np.argmin(ids)), place(np.arange(0)), True)]
    while todo:
        rows, centre, page, top = todo.pop()
        if top:
            groups = [(rows, centre)]
        elif len(rows) <= PAGE:
            back = _apart(x[rows], lift[rows], x[[centre]], lift[[centre]])[:, 0]
            pages[page] = {"page": page, "leaf": True, "ids": ids[rows], "vectors": x[rows], "lift": lift[rows],
                           "parent": back, "radius": np.zeros(0), "least": np.zeros(0, np.int64),
                           "single": np.zeros(0, bool)}
            continue
        else:
            groups = _split(rows, x, lift, centre)
        found = [entry_of(g, s, None if top else centre) for g, s in groups]
        children = [place(g) for g, _ in groups]
        seeds = [e["seed"] for e in found]
        pages[page] = {"page": page, "leaf": False, "ids": np.array(children, np.int64), "vectors": x[seeds], "lift": lift[seeds],
                       "parent": np.array([e["parent"] for e in found]), "radius": np.array([e["radius"] for e in found]),
                       "least": np.array([e["least"] for e in found], np.int64), "single": np.array([e["single"] for e in found])}
        todo += [(g, s, c, False) for (g, s), c in zip(groups, children)]
    return pages


def _split(rows: np.ndarray, x: np.ndarray, lift: np.ndarray, centre: int) -> list[tuple[np.ndarray, int]]:
    """Groups of a page's rows around seeds that lie far from each other. Rows that would hardly be split so
    (equal or nearly equal vectors) are cut along their distance from the centre."""
    many = min(16, -(-len(rows) // (PAGE // 2)))
    seeds = [centre]
    near = _apart(x[rows], lift[rows], x[[centre]], lift[[centre]])[:, 0]
    first, owner = near.copy(), np.zeros(len(rows), np.int64)
    while len(seeds) < many and near.max() > 0:
        seeds.append(int(rows[int(np.argmax(near))]))
        d = _apart(x[rows], lift[rows], x[[seeds[-1]]], lift[[seeds[-1]]])[:, 0]
        owner[d < near] = len(seeds) - 1
        near = np.minimum(near, d)
    groups = [(rows[owner == k], s) for k, s in enumerate(seeds) if (owner == k).any()]
    if max(len(g) for g, _ in groups) <= 0.8 * len(rows):
        return groups
    order = np.argsort(first, kind="stable")
    return [(rows[part], int(rows[part[0]])) for part in np.array_split(order, -(-len(rows) // PAGE))]


def _packed(cell: str, chunk: int, pages: list[dict]) -> pd.DataFrame:
    kinds = {"ids": np.int64, "vectors": np.int64, "lift": np.float64, "parent": np.float64, "radius": np.float64,
             "least": np.int64, "single": np.uint8}
    return pd.DataFrame([{"cell": cell, "chunk": chunk, "page": p["page"], "leaf": p["leaf"],
                          **{k: np.ascontiguousarray(p[k], t).tobytes() for k, t in kinds.items()}} for p in pages])


class Tree:
    """The pages of a tree as the search reads them."""

    def __init__(self, table: pd.DataFrame):
        self.pages = {}
        for r in table.itertuples(index=False):
            ids = np.frombuffer(r.ids, np.int64)
            self.pages[r.page] = {
                "leaf": r.leaf, "ids": ids, "vectors": np.frombuffer(r.vectors, np.int64).reshape(len(ids), -1),
                "parent": np.frombuffer(r.parent), "radius": np.frombuffer(r.radius),
                "least": np.frombuffer(r.least, np.int64), "single": np.frombuffer(r.single, np.uint8).astype(bool)}


# -- searching -------------------------------------------------------------------------------------

class Search:
    """Best-first search of a block of queries in one tree."""

    def __init__(self, q: np.ndarray, own: np.ndarray, top2: float, k: int,
                 floor_score: np.ndarray, floor_id: np.ndarray, has_floor: np.ndarray):
        self.q, self.own, self.k = q, own, k
        self.base = _norms(q) + top2
        self.margin = 1e-7 * (1 + np.sqrt(self.base))
        self.low = np.iinfo(np.int64).min
        self.scores = np.full((len(q), k), self.low, np.int64)
        self.ids = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
        # A score that k others are known to reach: (score, id) of the k-th.
        self.floor_score = np.where(has_floor, floor_score, self.low)
        self.floor_id = np.where(has_floor, floor_id, np.iinfo(np.int64).max)
        self.computed = 0

    def kth(self, rows) -> tuple[np.ndarray, np.ndarray]:
        s, i = self.scores[rows, -1], self.ids[rows, -1]
        better = (self.floor_score[rows] > s) | ((self.floor_score[rows] == s) & (self.floor_id[rows] < i))
        return np.where(better, self.floor_score[rows], s), np.where(better, self.floor_id[rows], i)

    def reach(self, rows) -> np.ndarray:
        """The distance beyond which nothing can enter a query's best k."""
        s, _ = self.kth(rows)
        d = np.sqrt(np.maximum(self.base[rows] - 2.0 * s, 0))
        return np.where(s == self.low, np.inf, d + self.margin[rows])

    def run(self, tree: Tree) -> None:
        everyone = np.arange(len(self.q))
        heap: list[tuple] = [(0.0, 0, everyone, np.zeros(len(everyone)), None)]
        while heap:
            _, page_id, rows, bound, to_centre = heapq.heappop(heap)
            page = tree.pages[page_id]
            reach = self.reach(rows)
            live = bound <= reach
            rows, reach = rows[live], reach[live]
            if not len(rows):
                continue
            wanted = np.ones((len(rows), len(page["ids"])), bool)
            if to_centre is not None:       # stored distances first: they cost nothing
                to_centre = to_centre[live]
                gap = np.abs(to_centre[:, None] - page["parent"][None, :])
                wanted = (gap - (0 if page["leaf"] else page["radius"])) <= reach[:, None]
            cols, some = np.flatnonzero(wanted.any(axis=0)), wanted.any(axis=1)
            if not len(cols):
                continue
            rows, reach, wanted = rows[some], reach[some], wanted[some][:, cols]
            score = _products(self.q[rows], page["vectors"][cols])
            self.computed += int(wanted.sum())
            if page["leaf"]:
                self._take(rows, score, page["ids"][cols], wanted)
                continue
            apart = np.sqrt(np.maximum(self.base[rows][:, None] - 2.0 * score, 0))
            bound = np.maximum(apart - page["radius"][cols], 0)
            wanted &= bound <= reach[:, None]
            s, i = self.kth(rows)
            for c, e in enumerate(cols):
                go = wanted[:, c]
                if page["single"][e]:
                    go = go & ((score[:, c] > s) | ((score[:, c] == s) & (page["least"][e] < i)))
                if go.any():
                    heapq.heappush(heap, (float(bound[go, c].min()), int(page["ids"][e]), rows[go], bound[go, c], apart[go, c]))

    def _take(self, rows, score, ids, wanted) -> None:
        s, i = self.kth(rows)
        ids = np.broadcast_to(ids, score.shape)
        enters = wanted & (ids != self.own[rows][:, None]) & (
            (score > s[:, None]) | ((score == s[:, None]) & (ids <= i[:, None])))
        some = enters.any(axis=1)
        if not some.any():
            return
        rows, cols = rows[some], np.flatnonzero(enters.any(axis=0))
        enters, score, ids = enters[some][:, cols], score[some][:, cols], ids[some][:, cols]
        score = np.concatenate([self.scores[rows], np.where(enters, score, self.low)], axis=1)
        ids = np.concatenate([self.ids[rows], np.where(enters, ids, np.iinfo(np.int64).max)], axis=1)
        order = np.lexsort((ids, -score.astype(np.float64) if np.abs(score[score != self.low]).max(initial=0) < 2 ** 53
                            else ~score), axis=1)[:, :self.k]
        self.scores[rows] = np.take_along_axis(score, order, 1)
        self.ids[rows] = np.take_along_axis(ids, order, 1)


_FOUND = "query_id long, vec_id long, score long"


def _search_trees(tasks: DataFrame, trees: DataFrame, top2: float, k: int, blocks: int) -> DataFrame:
    """Results of (query_id, v, cell, chunk, floor_score, floor_id): at most k rows of each, with ids."""

    def search(asked: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(pages):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        own = asked["query_id"].to_numpy(np.int64)
        has = asked["floor_score"].notna().to_numpy()
        s = Search(_matrix(asked["v"]), own, top2, k, asked["floor_score"].fillna(0).to_numpy(np.int64),
                   asked["floor_id"].fillna(0).to_numpy(np.int64), has)
        s.run(Tree(pages))
        real = s.scores != s.low
        return pd.DataFrame({"query_id": np.repeat(own, real.sum(axis=1)), "vec_id": s.ids[real], "score": s.scores[real]})

    block = F.pmod(F.xxhash64("query_id", F.lit(9)), F.lit(blocks)).cast("int")
    asked = tasks.withColumn("block", block)
    keys = ["cell", "chunk", "block"]
    # A tree is copied once for each block of queries that asks for it.
    wanted = asked.select(*(F.col(c).alias(f"w_{c}") for c in keys)).distinct()
    copies = trees.join(wanted, (F.col("cell") == F.col("w_cell")) & (F.col("chunk") == F.col("w_chunk"))).drop("cell", "chunk")
    return asked.groupBy(*keys).cogroup(copies.groupBy(*(f"w_{c}" for c in keys))).applyInPandas(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every id of ``queries`` the ``k`` rows of ``vectors`` (both
    vec_id, v as :func:`whole_vectors` gives them) with the largest inner products, ties to the smaller id. Rows
    with the query's own id are no candidates, and vectors of another length are none either; each other row is one, also of
    a repeated id. Of queries that share an id the largest vector asks. Fewer candidates give
    fewer rows; empty tables give none."""
    spark = vectors.sparkSession
    v = stored(vectors, "vectors")
    norm = F.aggregate(F.col("v"), F.lit(0).cast("double"), lambda a, c: a + c.cast("double") * c)
    facts = v.agg(F.count("*").alias("n"), F.coalesce(F.max(norm), F.lit(0.0)).alias("top")).first()
    rows, top2 = facts["n"], facts["top"] * (1 + 1e-12)
    # At most PIVOTS vectors reach the driver.
    chosen = (v.orderBy(F.xxhash64("vec_id", F.lit(4)), "vec_id").limit(max(1, min(PIVOTS, rows // (TREE_ROWS // 2)))).collect())
    pivots: dict[int, np.ndarray] = {}
    for r in chosen:
        pivots.setdefault(len(r["v"]), []).append(r["v"])
    pivots = {d: np.array(p, np.int64).reshape(len(p), d) for d, p in pivots.items()}
    sent = spark.sparkContext.broadcast(pivots)

    def nearest(x: np.ndarray, lift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = sent.value[x.shape[1]]
        d = _apart(x, lift, p, np.sqrt(np.maximum(top2 - _norms(p), 0)))
        return d.argmin(axis=1), d.min(axis=1)

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(top2 - _norms(x), 0))

    def to_cells(is_query: bool):
        def run(batches):
            for df in batches:
                sizes = df["v"].map(len)
                for d, part in df.groupby(sizes, sort=True):
                    part = part.copy()
                    if d in sent.value:
                        x = _matrix(part["v"])
                        at, far = nearest(x, np.zeros(len(x)) if is_query else lifted(x))
                    else:
                        at, far = np.full(len(part), -1), np.full(len(part), np.inf)
                    part["cell"] = [f"{d}:{i}" for i in at]
                    part["far"] = far
                    yield part
        return run

    cells = stored(v.mapInPandas(to_cells(False), "vec_id long, v array<bigint>, cell string, far double"), "cells")
    # One row per cell: at most PIVOTS and one more per length of vector.
    stats = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    chunks = {r["cell"]: -(-r["n"] // TREE_ROWS) for r in stats}
    radius = {r["cell"]: r["radius"] for r in stats}
    plan = spark.createDataFrame([(c, n) for c, n in chunks.items()], "cell string, chunks int")

    def build(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("vec_id")
        x = _matrix(df["v"])
        return _packed(df["cell"].iloc[0], int(df["chunk"].iloc[0]), build_pages(df["vec_id"].to_numpy(np.int64), x, lifted(x)))

    dealt = cells.join(plan, "cell").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.col("chunks")).cast("int"))
    trees = stored(dealt.groupBy("cell", "chunk").applyInPandas(build, _PAGES), "trees")

    asked = stored(queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.max("v").alias("v")).mapInPandas(
        to_cells(True), "query_id long, v array<bigint>, cell string, far double"), "asked")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    none = F.lit(None).cast("long")
    home = (asked.join(plan, "cell").withColumn("chunk", F.pmod(F.xxhash64("query_id", "v"), F.col("chunks")).cast("int"))
            .select("query_id", "v", "cell", "chunk", none.alias("floor_score"), none.alias("floor_id")))
    first = stored(_search_trees(home, trees, top2, k, blocks), "first")
    floor = (_best(first, k).where(F.col("rank") == k)
             .select("query_id", F.col("score").alias("floor_score"), F.col("vec_id").alias("floor_id")))
    seeded = asked.join(floor, "query_id", "left").join(
        home.select("query_id", F.col("cell").alias("home"), F.col("chunk").alias("home_chunk")), "query_id", "left")

    def routes(batches):
        names = ["query_id", "v", "cell", "chunk", "floor_score", "floor_id"]
        for df in batches:
            for d, part in df.groupby(df["v"].map(len), sort=True):
                x = _matrix(part["v"])
                base = _norms(x) + top2
                has = part["floor_score"].notna().to_numpy()
                reach = np.where(has, np.sqrt(np.maximum(base - 2.0 * part["floor_score"].fillna(0).to_numpy(float), 0))
                                 + 1e-7 * (1 + np.sqrt(base)), np.inf)
                p = sent.value.get(d)
                far = None if p is None else _apart(x, np.zeros(len(x)), p, lifted(p))
                for cell in chunks:
                    length, at = map(int, cell.split(":"))
                    if length != d:
                        continue
                    go = np.ones(len(x), bool) if at < 0 else far[:, at] - radius[cell] <= reach
                    for chunk in range(chunks[cell]):
                        new = go & ~((part["home"] == cell) & (part["home_chunk"] == chunk)).to_numpy()
                        if new.any():
                            yield part[new].assign(cell=cell, chunk=chunk)[names]

    tasks = seeded.drop("cell", "far").mapInPandas(
        routes, "query_id long, v array<bigint>, cell string, chunk int, floor_score long, floor_id long")
    rest = _search_trees(tasks, trees, top2, k, blocks)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
