"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; the products of both are the
cells of a grid.  A vector is filed in its nearest cell and looks for partners
in the cells that are nearest to it by the sum of both distances, as many as
partners at the least similarity need for the wanted recall.  What it meets
there is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import checkpoint, components, ship


@dataclass(frozen=True)
class Grid:
    """``recall`` is aimed at on ``queries`` sampled vectors, for partners planted at the least similarity and for their
    links to all rows; codebooks are fitted on ``per_centroid`` other sampled vectors for each centroid.  The number of centroids follows the number of vectors, so that
    a cell holds ``occupancy`` of them on average, up to ``centroids``.  Blocks of a cell have at most ``block``
    vectors on each side, whatever the cell holds.
    """

    similarity: float = 0.95
    recall: float = 0.998
    queries: int = 512
    occupancy: int = 4
    centroids: int = 1024
    per_centroid: int = 16
    least_cells: int = 4
    block: int = 512


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.frombuffer(v, dtype="<f8") for v in column]) if len(column) else np.zeros((0, 1))


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)[None, :], 0)


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced rows of the sample, which is in order of a hash."""
    centers = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = _distances(x, centers).argmin(axis=1)
        sums, n = np.zeros_like(centers), np.bincount(own, minlength=k)
        np.add.at(sums, own, x)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


#: Partners planted for each sampled vector.
PLANTED = 8


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, the number of cells to visit, and the recall and number of links it was chosen by."""

    left: np.ndarray
    right: np.ndarray
    visits: int = 1
    recall: float = 1.0
    sampled_links: int = 0

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _distances(x[:, :half], self.left), _distances(x[:, half:], self.right)

    def own_cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def nearest_cells(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The ``visits`` cells of least summed distance, nearest first.

        Of the cells in order of each half, the i-th and j-th can only be among the first n if i * j <= n; the
        traversal of both sequences visits these alone.
        """
        a, b = self.distances(x)
        visits = min(visits, a.shape[1] * b.shape[1])
        by_a, by_b = a.argsort(axis=1, kind="stable"), b.argsort(axis=1, kind="stable")
        pairs = [(i, j) for i in range(min(visits, a.shape[1])) for j in range(min(visits // (i + 1), b.shape[1]))]
        i, j = map(np.array, zip(*pairs, strict=True))
        sums = np.take_along_axis(a, by_a, 1)[:, i] + np.take_along_axis(b, by_b, 1)[:, j]
        order = sums.argsort(axis=1, kind="stable")[:, :visits]
        return by_a[:, i][np.arange(len(x))[:, None], order] * b.shape[1] + by_b[:, j][np.arange(len(x))[:, None], order]

    def ranks(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells one vector visits before and with each of these."""
        a, b = (d[0] for d in self.distances(q[None, :]))
        sums = a[cells // len(b)] + b[cells % len(b)]
        ordered = np.sort(b)
        return np.array([np.searchsorted(ordered, s - a + 1e-12, side="right").sum() for s in sums])


def _vectors(embeddings: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, node, unit): the vectors at length 1, ``node`` null where one links with nothing."""
    e = F.col("e")
    fine = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(e, lambda x: x != 0)
    return (
        embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
        .withColumn("e", F.when(fine & some, e))
        .withColumn("node", F.unhex(F.md5(F.array_join(F.transform("e", lambda x: (x + F.lit(0.0)).cast("string")), ",").cast("binary"))))
    )


def _unit(frames: Iterator) -> Iterator:
    """Vectors of length 1 as bytes.  The largest component becomes 1 first, so that no square over- or underflows."""
    for f in frames:
        out = []
        for e in f["e"]:
            x = np.asarray(e, dtype=np.float64)
            x = x / np.abs(x).max()
            out.append((x / np.sqrt((x * x).sum())).astype("<f8").tobytes())
        yield pd.DataFrame({"node": f["node"], "copies": f["copies"], "unit": out, "size": f["e"].map(len)})


def _planted(index: Index, queries: np.ndarray, rule: Grid) -> np.ndarray:
    """For partners at the least similarity in random directions, the visits after which one of both finds the other."""
    rng, out = np.random.default_rng(queries.shape[1]), []
    here = index.own_cells(queries)
    for _ in range(PLANTED):
        aside = rng.normal(size=queries.shape)
        aside -= (aside * queries).sum(1)[:, None] * queries
        aside /= np.sqrt((aside * aside).sum(1))[:, None]
        partners = rule.similarity * queries + np.sqrt(1 - rule.similarity**2) * aside
        there = index.own_cells(partners)
        out += [min(index.ranks(q, t)[0], index.ranks(p, h)[0])
                for q, p, h, t in zip(queries, partners, here[:, None], there[:, None], strict=True)]
    return np.array(out)


def _reaching(ranks: np.ndarray, weights: np.ndarray, recall: float) -> int:
    """The least rank up to which the weights have this share."""
    order = ranks.argsort(kind="stable")
    share = np.cumsum(weights[order]) / weights.sum()
    return int(ranks[order][min(np.searchsorted(share, recall), len(order) - 1)])


def build_index(nodes: DataFrame, rule: Grid, count: int, size: int) -> Index:
    """Codebooks from a bounded sample, and the visits that reach the wanted recall on sampled queries.

    The recall is reached both for planted partners, which need no links in the data, and for the links of the queries,
    where each query that has any counts once.  The queries are the last of the sample: codebooks lie nearer to what
    they were fitted on.
    """
    k = max(1, min(rule.centroids, int(np.ceil(np.sqrt(count / rule.occupancy)))))
    fitted = max(rule.per_centroid * k, rule.queries)
    rows = nodes.where(F.col("size") == size).orderBy(F.xxhash64("node"), "node").limit(fitted + rule.queries).select("unit").collect()
    every = np.array([np.frombuffer(r["unit"], dtype="<f8") for r in rows])
    sample, queries = every[:fitted], every[-rule.queries:]
    half = (size + 1) // 2
    k = min(k, len(sample))
    index = Index(_codebook(sample[:, :half], k), _codebook(sample[:, half:], k) if half < size else np.zeros((1, 0)))
    query_cells = index.own_cells(queries)

    def ranked(frames: Iterator) -> Iterator:
        found: dict[tuple[int, int], int] = {}
        for f in frames:
            f = f[f["size"] == size]
            if not len(f):
                continue
            x = _matrix(f["unit"])
            cells = index.own_cells(x)
            near = queries @ x.T
            hit = (near >= rule.similarity) & (near < 1 - 1e-12)  # not itself
            rank = np.zeros(hit.shape, dtype=np.int64)
            for q in np.flatnonzero(hit.any(axis=1)):
                own, at = np.unique(cells[hit[q]], return_inverse=True)
                rank[q, hit[q]] = index.ranks(queries[q], own)[at]
            for j in np.flatnonzero(hit.any(axis=0)):
                own, at = np.unique(query_cells[hit[:, j]], return_inverse=True)
                rank[hit[:, j], j] = np.minimum(rank[hit[:, j], j], index.ranks(x[j], own)[at])
            for q in np.flatnonzero(hit.any(axis=1)):
                for r, m in zip(*(v.tolist() for v in np.unique(rank[q, hit[q]], return_counts=True)), strict=True):
                    found[q, r] = found.get((q, r), 0) + m
        yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["q", "rank", "n"])

    # A row per query and rank that occurs.
    links = nodes.select("unit", "size").mapInPandas(ranked, "q int, rank bigint, n bigint").groupBy("q", "rank").agg(
        F.sum("n").alias("n")).orderBy("q", "rank").collect()
    q, ranks, n = np.array([tuple(r) for r in links], dtype=np.int64).reshape(-1, 3).T
    weighed = [(ranks, n / np.bincount(q, n)[q])] if len(links) else []
    if size > 1:  # one component leaves no direction
        planted = _planted(index, queries, rule)
        weighed.append((planted, np.ones(len(planted))))
    visits = max([rule.least_cells, *(_reaching(r, w, rule.recall) for r, w in weighed)])
    got = min([1.0, *(float(w[r <= visits].sum() / w.sum()) for r, w in weighed)])
    return Index(index.left, index.right, visits, got, int(n.sum()))


def _file(index: Index, size: int):
    def run(frames: Iterator) -> Iterator:
        for f in frames:
            f = f[f["size"] == size]
            if len(f):
                cells = index.nearest_cells(_matrix(f["unit"]), index.visits)
                yield f[["node", "copies", "unit"]].assign(cell=cells[:, 0].astype(np.int64), visited=list(cells.astype(np.int64)))
    return run


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs that connect what the links connect, fewer than rows and columns together."""
    left, out = link.any(axis=1), []
    columns_left = np.ones(link.shape[1], dtype=bool)
    while left.any():
        front = np.array([left.argmax()])
        left[front] = False
        while len(front):
            reached = link[front] & columns_left
            columns = np.flatnonzero(reached.any(axis=0))
            out += [(int(front[reached[:, c].argmax()]), int(c)) for c in columns]
            columns_left[columns] = False
            rows = np.flatnonzero(left & link[:, columns].any(axis=1)) if len(columns) else np.zeros(0, dtype=int)
            out += [(int(r), int(columns[link[r, columns].argmax()])) for r in rows]
            left[rows] = False
            front = rows
    return out


_FOUND = "a binary, b binary, n bigint"


def _meet(least: float):
    """Of one block: how many partners each visitor found, and links that connect those found."""
    def run(frame):
        here, come = frame[~frame["visitor"]], frame[frame["visitor"]]
        if not len(here) or not len(come):
            return pd.DataFrame([], columns=["a", "b", "n"])
        link = _matrix(come["unit"]) @ _matrix(here["unit"]).T >= least
        a, b = come["node"].to_numpy(object), here["node"].to_numpy(object)
        link &= a[:, None] != b[None, :]
        if not link.any():
            return pd.DataFrame([], columns=["a", "b", "n"])
        out = [(a[i], None, int(n)) for i, n in enumerate(link @ here["copies"].to_numpy(np.int64)) if n]
        # A partner that does not visit the visitor's cell learns of the link here.
        own, copies = come["cell"].to_numpy(np.int64), come["copies"].to_numpy(np.int64)
        for j in np.flatnonzero(link.any(axis=0)):
            unaware = link[:, j] & ~np.isin(own, here["visited"].iloc[j])
            if unaware.any():
                out.append((b[j], None, int(copies[unaware].sum())))
        out += [(a[i], b[j], 0) for i, j in _forest(link)]
        return pd.DataFrame(out, columns=["a", "b", "n"])
    return run


def near_vectors(embeddings: DataFrame, rule: Grid = Grid(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    ``n_links`` counts the other rows found at a cosine of ``rule.similarity`` or more, in double precision;
    ``component_id`` is the least vec_id that links lead to, ``kept`` whether it is the row's own.

    Equal vectors are one, with their number.  A link between two is found if one visits the other's cell, and then
    counts for both.  Vectors that are null, empty or zero or hold null or non-finite components link with nothing.
    Vectors of different lengths don't link; each length has its own grid.  Repeated rows count as vectors.  A null
    vec_id never names a component that has another.  Other columns are not read; an empty table gives no row.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vectors = _vectors(embeddings, vec_id, embedding)
    distinct = vectors.where("node is not null").groupBy("node").agg(F.any_value("e").alias("e"), F.count("*").alias("copies"))
    nodes = checkpoint(distinct.mapInPandas(_unit, "node binary, copies bigint, unit binary, size int"))
    found = None
    for row in nodes.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect():
        one = _links(nodes, build_index(nodes, rule, row["n"], row["size"]), row["size"], rule)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    found = checkpoint(found)
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = components(found.where("b is not null").select("a", "b"))
    rows = checkpoint(vectors.select("vec_id", "node"))
    placed = checkpoint(
        nodes.select("node", "copies").join(counts, "node", "left").join(labels, "node", "left")
        .select("node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                F.coalesce("component", "node").alias("component")))
    first = checkpoint(
        rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("least"))
        .join(placed, "node").groupBy("component").agg(F.min("least").alias("component_id")))
    named = checkpoint(placed.join(first, "component").select("node", "n_links", "component_id"))
    linked = rows.where("node is not null").join(named, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(nodes: DataFrame, index: Index, size: int, rule: Grid) -> DataFrame:
    filed = checkpoint(nodes.mapInPandas(
        _file(index, size), "node binary, copies bigint, unit binary, cell bigint, visited array<bigint>"))
    visits = filed.select("node", "copies", "unit", F.col("cell").alias("own"), F.explode("visited").alias("cell"))
    # At most a row per cell of the grid, so the square of the number of centroids.
    parts = lambda n: F.ceil(F.col(n) / rule.block).cast("int")
    cells = checkpoint(
        filed.groupBy("cell").agg(F.count("*").alias("n_here"))
        .join(visits.groupBy("cell").agg(F.count("*").alias("n_come")), "cell")
        .select("cell", parts("n_here").alias("here"), parts("n_come").alias("come")))
    part = lambda n: F.pmod(F.hash("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = (filed.join(F.broadcast(cells), "cell").withColumn("i", part("here")).withColumn("j", every("come"))
            .select("cell", "i", "j", "node", "copies", "unit", "visited", F.lit(False).alias("visitor"), F.col("cell").alias("own")))
    come = (visits.join(F.broadcast(cells), "cell").withColumn("j", part("come")).withColumn("i", every("here"))
            .select("cell", "i", "j", "node", "copies", "unit", F.lit(None).cast("array<bigint>").alias("visited"),
                    F.lit(True).alias("visitor"), "own"))
    blocks = here.unionByName(come).withColumnRenamed("cell", "block").withColumnRenamed("own", "cell")
    return blocks.groupBy("block", "i", "j").applyInPandas(_meet(rule.similarity), _FOUND)
