"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one vector kept of each group.

Equal vectors are one class throughout. Every class has a home cell (the nearest
centroid) and visits other cells that may be the home of a partner. If x has its home
at c and y at e, then y(e - c) <= |y - x| |e - c|, as x is no nearer to e; so y need
visit c only if it lies that near to the plane between e and c. Of these cells the
PROBES nearest are visited, or all of them in exact mode. A pair is compared in the
home of one where the other is at home or a visitor. A task multiplies a block of a
cell's home vectors with a block of its visitors and hands on counts of links and
spanning edges, not pairs.

Cells grow with the table, so that a cell keeps about CELL vectors: MOST_CELLS
centroids at most are fitted on the sample, and beyond CELL * MOST_CELLS vectors each
of these cells is parted by a second set of centroids, fitted on what the first leaves
over. A cell is then a pair of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.llm.components import components
from neumata.llm.shared import Scratch, is_small

LEAST = 0.95
#: k-means is fitted on so many vectors at most, drawn by a hash of the vector; every vector is indexed.
SAMPLE, CELL, MOST_CELLS, STEPS = 32_768, 1000, 4096, 8
PROBES = 8
#: Vectors of a cell's home block and of a block of its visitors.
HOME_BLOCK, VISIT_BLOCK = 1024, 4096
SMALL_COUNTS = 200_000


def fit_cells(sample: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Unit centroids of spherical k-means; sample rows have unit length. Empty cells keep their centroid."""
    centres = sample[np.random.default_rng(seed).permutation(len(sample))[:k]].copy()
    for _ in range(STEPS):
        near = np.concatenate([(sample[i : i + 2048] @ centres.T).argmax(1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1)
        centres[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return centres


def fit(sample: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, centroids of what they leave over) for ``count`` vectors; the second set has one zero row if not needed."""
    k = max(1, min(MOST_CELLS, len(sample) // 8, -(-count // CELL)))
    first = fit_cells(sample, k)
    parts = max(1, min(MOST_CELLS, len(sample) // 8, -(-count // (CELL * k))))
    if parts == 1:
        return first, np.zeros((1, sample.shape[1]))
    near = np.concatenate([(sample[i : i + 2048] @ first.T).argmax(1) for i in range(0, len(sample), 2048)])
    left = sample - first[near]
    norm = np.linalg.norm(left, axis=1)
    second = fit_cells(left[norm > 0] / norm[norm > 0, None], parts, seed=2) if (norm > 0).any() else np.zeros((1, sample.shape[1]))
    return first, second * np.median(norm)


def cells_of(x: np.ndarray, first: np.ndarray, second: np.ndarray, least: float, probes: int | None) -> list[np.ndarray]:
    """Of each unit vector the numbers of its home cell and then of the cells it visits, nearest first.

    With a second set of centroids those of the nearest ``probes`` first cells are weighed.
    """
    reach = np.sqrt(2 - 2 * least) + 1e-9

    def chosen(like: np.ndarray, home: int, apart: np.ndarray) -> np.ndarray:
        near = np.flatnonzero(like[home] - like <= reach * apart + 1e-9)
        near = near[np.argsort(-like[near], kind="stable")]
        return np.concatenate([[home], near[near != home]])[:probes].astype(np.int64)

    out = []
    if len(second) == 1:
        for at in range(0, len(x), 1024):
            like = x[at : at + 1024] @ first.T
            home = like.argmax(1)
            apart = np.sqrt(np.maximum(2 - 2 * first[home] @ first.T, 0))  # centroids have unit length
            out += [chosen(*row) for row in zip(like, home, apart, strict=True)]
        return out
    for row in x:
        some = np.argsort(-(first @ row), kind="stable")[: probes or len(first)]
        centres = (first[some, None] + second[None]).reshape(-1, x.shape[1])
        centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-12)[:, None]
        number = (some[:, None] * len(second) + np.arange(len(second))).reshape(-1)
        like = centres @ row
        home = int(like.argmax())
        out.append(number[chosen(like, home, np.linalg.norm(centres[home] - centres, axis=1))])
    return out


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _placed(classes: DataFrame, centres: tuple[np.ndarray, np.ndarray], least: float, probes: int | None) -> DataFrame:
    """(class_id, n, embedding, cells): the home cell first, then the cells visited."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)  # 2 * MOST_CELLS rows at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, second = shared.value
        for pdf in batches:
            cells = []
            if len(pdf):
                x = _matrix(pdf["embedding"])
                cells = cells_of(x / np.linalg.norm(x, axis=1)[:, None], first, second, least, probes)
            yield pdf.assign(cells=cells)

    kinds = classes.schema["embedding"].dataType.simpleString()
    return classes.mapInPandas(run, f"class_id long, n long, embedding {kinds}, cells array<long>")


def _compared(home: pd.DataFrame, other: pd.DataFrame, cell: int, least: float) -> pd.DataFrame:
    """Links between ``home`` (at home in the cell) and ``other`` (at home or visiting): rows (a, b, n).

    b null: a has n more links. Else an edge of a forest that connects what the links
    connect. Pairs that are both at home are counted with the lower class first, and a
    pair that would meet again in the other's home is counted in the lower cell.
    """
    out = pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
    if not len(home) or not len(other):
        return out
    home, other = home.sort_values("class_id", kind="stable"), other.sort_values("class_id", kind="stable")
    x, y = _matrix(home["embedding"]), _matrix(other["embedding"])
    cosine = (x @ y.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None, :]
    i, j = np.nonzero(cosine >= least)
    ids, others = home["class_id"].to_numpy(), other["class_id"].to_numpy()
    from_cell = other["cells"].map(lambda c: c[0]).to_numpy()
    visits = [set(c) for c in home["cells"]]
    at_home = from_cell[j] == cell
    again = np.fromiter((from_cell[q] < cell and from_cell[q] in visits[p] for p, q in zip(i, j, strict=True)), bool, len(i))
    keep = np.where(at_home, ids[i] < others[j], ~again)
    i, j = i[keep], j[keep]
    if not len(i):
        return out
    n_home, n_other = home["n"].to_numpy(), other["n"].to_numpy()
    here = np.bincount(i, weights=n_other[j], minlength=len(ids)).astype(np.int64)
    there = np.bincount(j, weights=n_home[i], minlength=len(others)).astype(np.int64)
    nodes, at = np.unique(np.concatenate([ids[i], others[j]]), return_inverse=True)
    p, q = at[: len(i)], at[len(i) :]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, p, label[q])
        np.minimum.at(low, q, label[p])
        low = low[low]
        if (low == label).all():
            break
        label = low
    edge = label != np.arange(len(nodes))
    counted = [pd.DataFrame({"a": v[c > 0], "b": pd.NA, "n": c[c > 0]}) for v, c in ((ids, here), (others, there))]
    edges = pd.DataFrame({"a": nodes[edge], "b": nodes[label[edge]], "n": 0})
    return pd.concat([*(t.astype({"b": "Int64"}) for t in counted), edges.astype({"b": "Int64"})])


def near_vectors(spark: SparkSession, vectors: DataFrame, least: float = LEAST, exact: bool = False) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Links join vectors whose cosine, in double precision, is at least ``least``; equal
    vectors always link. ``exact`` visits every cell that may hold a partner and misses
    no link; else PROBES cells are visited at most. Vectors that are null, empty, zero or
    hold a null or non-finite component, or have no id, link with nothing. Vectors are
    compared among those of their own length. Rows that repeat an id are rows of the
    result, told apart by their vectors, and link like others; an empty table gives an
    empty result; other columns are ignored.
    """
    scratch = Scratch(spark, "vectors")
    good = F.exists("embedding", lambda x: x != 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = scratch.keep(
        vectors.select("vec_id", "embedding", F.coalesce(good & F.col("vec_id").isNotNull(), F.lit(False)).alias("good")).select(
            "vec_id",
            "good",
            F.when(F.col("good"), F.xxhash64("embedding")).alias("h1"),
            F.when(F.col("good"), F.xxhash64(F.lit(11), F.reverse("embedding"))).alias("h2"),
            F.when(F.col("good"), F.col("embedding")).alias("embedding"),
        ),
        "rows",
    )
    distinct = rows.where("good").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first("embedding").alias("embedding")
    )
    # a number of its own for each class, fixed by being written
    classes = scratch.keep(distinct.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    found = None
    sizes = classes.groupBy(F.size("embedding").alias("d")).count().collect()  # one row per dimension
    for d, count in sizes:
        some = classes.where(F.size("embedding") == d).select("class_id", "n", "embedding")
        part = _links(spark, scratch, some, count, d, least, None if exact else PROBES)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    found = scratch.keep(found, "found")
    degree = found.where("b IS NULL").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("links"))
    linked = components(spark, found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "class_id")
    named = (
        classes.select("h1", "h2", "class_id", "first_id", "n")
        .join(degree, "class_id", "left")
        .join(linked, "class_id", "left")
        .withColumn("component", F.coalesce("component", "class_id"))
    )
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id")
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def _links(spark: SparkSession, scratch: Scratch, classes: DataFrame, count: int, d: int, least: float, probes: int | None) -> DataFrame:
    share = min(1.0, SAMPLE / 2 / max(1, count))
    drawn = classes.where(F.pmod(F.xxhash64(F.lit(5), "embedding"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array([r[0] for r in drawn.select("embedding").limit(SAMPLE).collect()] or [[1.0] * d], np.float64)
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    centres = fit(sample, count)
    if probes is None:
        centres = centres[0], np.zeros((1, d))  # the plane bound holds where the home is the nearest of all centroids
    placed = scratch.keep(_placed(classes, centres, least, probes), f"placed{d}")
    filed = placed.select(F.posexplode("cells").alias("k", "cell"))
    counts = filed.groupBy("cell").agg(F.count_if(F.col("k") == 0).alias("at_home"), F.count("*").alias("every"))
    blocks = scratch.keep(
        counts.where("at_home > 0").select(
            "cell", F.ceil(F.col("at_home") / HOME_BLOCK).cast("int").alias("homes"), F.ceil(F.col("every") / VISIT_BLOCK).cast("int").alias("visits")
        ),
        f"blocks{d}",
    )
    aside = F.broadcast(blocks) if is_small(blocks, SMALL_COUNTS) else blocks
    spread = F.pmod(F.xxhash64(F.lit(9), "class_id"), F.lit(1 << 30))
    columns = ["cell", "i", "j", "class_id", "n", "embedding", "cells"]
    homes = (
        placed.withColumn("cell", F.col("cells")[0])
        .join(aside, "cell")
        .withColumn("i", F.pmod(spread, "homes").cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("visits") - 1)))
        .select(*columns)
    )
    others = (
        scratch.read(f"placed{d}", placed).withColumn("cell", F.explode("cells"))
        .join(aside, "cell")
        .withColumn("j", F.pmod(spread, "visits").cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
        .withColumn("cells", F.slice("cells", 1, 1))
        .select(*columns)
    )

    def run(key: tuple, home: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        cell = key[0]
        return _compared(home, other, cell, least)

    by = ["cell", "i", "j"]
    return homes.groupBy(*by).cogroup(others.groupBy(*by)).applyInPandas(run, "a long, b long, n long")
