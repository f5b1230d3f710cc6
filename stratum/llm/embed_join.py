"""Embedding near-duplicates: an exact metric range join.

Unit vectors whose cosine reaches a threshold lie within r = sqrt(2 - 2 cos).  Equal vectors
are first made one.  Pivots cut the vectors of each label into cells, each vector's home being
the nearest pivot.  By the triangle inequality a vector can have a neighbour at home in cell j
only if its distance to pivot j is at most that to its own pivot plus 2 r, and at most the
cell's radius plus r; it is replicated there.  So the home vectors of a cell meet all their
neighbours in the cell, and cells join independently.  A cell is dealt out as (block of home
vectors, block of all vectors) of at most ``BLOCK`` rows each, whatever its size.  A block
pair returns each home vector's number of links and a spanning forest, not the pairs.

The pivots are at most ``MOST_PIVOTS`` in all, which bounds what is broadcast; labels without
pivots are a single cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import Scratch
from stratum.llm.components import components

CELL = 1024                     # vectors of a label for each pivot
PIVOTS = 256                    # of a label
MOST_PIVOTS = 16384             # of all labels
BLOCK = 8192
TILE = 256
NEAR = 1e-10                    # cosines this close to the threshold are computed again, pair by pair


def _usable(vector: str, id: str, label: str) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(id).isNotNull() & F.col(label).isNotNull() & good & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit length, in double precision."""
    width = len(column[0]) if len(column) else 0
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * x @ pivots.T, 0))


def choose_pivots(vectors: DataFrame) -> dict[str, np.ndarray]:
    """Group -> pivots: of each large group, the vectors whose id hash falls below the share wanted."""
    sizes = vectors.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > 2 * CELL).orderBy(F.desc("n"), "grp").limit(MOST_PIVOTS).collect()
    share, most = {}, MOST_PIVOTS
    for r in sizes:
        want = min(PIVOTS, -(-r["n"] // CELL), most)
        most -= want
        if want > 1:
            share[r["grp"]] = (want, want / r["n"])
    if not share:
        return {}
    spark = vectors.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(g, w, s) for g, (w, s) in share.items()], "grp string, want int, share double"))
    draw = F.pmod(F.xxhash64("first", F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    # twice the share, so that enough are found; then the lowest draws of each group
    rows = vectors.join(wanted, "grp").withColumn("draw", draw).where(F.col("draw") < 2 * F.col("share")).select("grp", "draw", "want", "vector").toArrow().to_pandas()
    out = {}
    for grp, own in rows.sort_values(["grp", "draw"]).groupby("grp"):
        own = own.head(int(own["want"].iloc[0]))
        out[grp] = _matrix(pa.array(own["vector"].tolist()))
    return out


def _homes(vectors: DataFrame, pivots, radius: float) -> DataFrame:
    """grp, cell, distance of every vector of a group with pivots, for the cells' radii and sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for grp, rows in _by_group(b):
                if grp in pivots.value:
                    d = _distances(_matrix(rows.column("vector")), pivots.value[grp])
                    home = d.argmin(1)
                    yield pa.RecordBatch.from_arrays([pa.array([grp] * len(d)), pa.array(home.astype(np.int32)), pa.array(d[np.arange(len(d)), home])], names=["grp", "cell", "distance"])

    return vectors.select("grp", "vector").mapInArrow(run, "grp string, cell int, distance double")


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    groups = np.array(batch.column("grp").to_pylist(), object)
    for grp in dict.fromkeys(groups.tolist()):
        yield grp, batch.take(pa.array(np.flatnonzero(groups == grp)))


def _placed(vectors: DataFrame, pivots, radii, radius: float) -> DataFrame:
    """grp, cell, home, first, copies, vector: each vector at home and wherever it may have a neighbour at home."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for grp, rows in _by_group(b):
                n = rows.num_rows
                row, cell, home = np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
                if grp in pivots.value:
                    d = _distances(_matrix(rows.column("vector")), pivots.value[grp])
                    own = d.argmin(1)
                    near = (d <= d[row, own][:, None] + 2 * radius + 1e-9) & (d <= radii.value[grp][None, :] + radius + 1e-9)
                    near[row, own] = True
                    row, cell = np.nonzero(near)
                    home = own[row] == cell
                out = rows.take(pa.array(row))
                for s in range(0, len(row), 20_000):
                    part = out.slice(s, 20_000)
                    yield pa.RecordBatch.from_arrays([part.column("grp"), pa.array(cell[s:s + 20_000].astype(np.int32)), pa.array(home[s:s + 20_000]),
                                                      part.column("first"), part.column("copies"), part.column("vector")],
                                                     names=["grp", "cell", "home", "first", "copies", "vector"])

    kind = dict(vectors.dtypes)["vector"]
    return vectors.mapInArrow(run, f"grp string, cell int, home boolean, first bigint, copies bigint, vector {kind}")


def _compare(left: pa.RecordBatch, right: pa.RecordBatch, threshold: float) -> Iterator[pa.RecordBatch]:
    a, b = _matrix(left.column("vector")), _matrix(right.column("vector"))
    ida, idb = left.column("first").to_numpy(), right.column("first").to_numpy()
    copies = right.column("copies").to_numpy().astype(np.float64)
    ids, place = np.unique(np.r_[ida, idb], return_inverse=True)
    pa_, pb = place[:len(ida)], place[len(ida):]
    label = np.arange(len(ids))
    links = np.zeros(len(ida), np.int64)
    for s in range(0, len(a), TILE):
        cos = a[s:s + TILE] @ b.T
        hit = cos >= threshold
        for i, j in zip(*np.nonzero(np.abs(cos - threshold) < NEAR)):
            hit[i, j] = float(np.dot(a[s + i], b[j])) >= threshold
        hit &= ida[s:s + TILE][:, None] != idb[None, :]
        links[s:s + TILE] = (hit @ copies).astype(np.int64)
        i, j = np.nonzero(hit)
        x, y = pa_[s + i], pb[j]
        while len(x):
            apart = label[x] != label[y]
            if not apart.any():
                break
            x, y = x[apart], y[apart]
            low = np.minimum(label[x], label[y])
            np.minimum.at(label, label[x], low)
            np.minimum.at(label, label[y], low)
            while (label[label] != label).any():
                label = label[label]
    rooted = np.flatnonzero(label != np.arange(len(ids)))
    some = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[ida[some], ids[rooted]]), pa.array(np.r_[links[some], np.zeros(len(rooted), np.int64)]),
                                      pa.array(np.r_[ida[some], ids[label[rooted]]])], names=["node", "links", "root"])


def _links(placed: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """node, links, root: partial link counts of home vectors, and spanning links."""
    unit = ["grp", "cell", "a", "b"]
    rows = placed.join(sizes, ["grp", "cell"])
    own = lambda n, seed: F.pmod(F.xxhash64("first", F.lit(seed)), n).cast("int")
    left = rows.where("home").withColumn("a", own(F.col("homes"), 1)).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("alls") - 1))).withColumn("side", F.lit(0))
    right = rows.withColumn("b", own(F.col("alls"), 2)).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("homes") - 1))).withColumn("side", F.lit(1))
    dealt = left.select(*unit, "side", "first", "copies", "vector").union(right.select(*unit, "side", "first", "copies", "vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = list(zip(*(b.column(c).to_pylist() for c in unit)))
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start]:
                    if now is not None and keys[start] != now:
                        yield from unit_links(held)
                        held = []
                    now = keys[start]
                    held.append(b.slice(start, i - start))
                    start = i
        if held:
            yield from unit_links(held)

    def unit_links(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        side = t.column("side").to_numpy()
        left, right = (t.take(pa.array(np.flatnonzero(side == s))) for s in (0, 1))
        if left.num_rows and right.num_rows:
            yield from _compare(left, right, threshold)

    return dealt.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "node bigint, links bigint, root bigint")


def near_duplicates(docs: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93) -> DataFrame:
    """``id``, n_links, component_id, kept for every row.

    Only vectors of equal label and dimension are compared.  Null, empty and zero vectors,
    those with null or non-finite components, and rows without label or id link with nothing:
    n_links 0, a component of their own, kept (kept is null for a null id).  Equal vectors
    are linked with each other.  Rows that repeat an id count as one vector for components,
    and the id's links are added up.  Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "embeddings")
    own = docs.select(F.col(id).cast("bigint").alias("id"), F.concat_ws("/", F.col(label).cast("string"), F.size(vector).cast("string")).alias("grp"),
                      F.col(vector).alias("vector"), F.coalesce(_usable(vector, id, label), F.lit(False)).alias("usable"))
    good = own.where("usable")
    # a hot vector is combined before the shuffle
    vectors = scratch.keep(good.groupBy("grp", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies")).select("grp", "first", "copies", "vector"), "vectors")
    radius = float(np.sqrt(2 - 2 * threshold))
    chosen = choose_pivots(vectors)
    pivots = spark.sparkContext.broadcast(chosen)
    radii = {g: np.zeros(len(p)) for g, p in chosen.items()}
    if chosen:
        for r in _homes(vectors, pivots, radius).groupBy("grp", "cell").agg(F.max("distance").alias("d")).collect():
            radii[r["grp"]][r["cell"]] = r["d"]
    placed = scratch.keep(_placed(vectors, pivots, spark.sparkContext.broadcast(radii), radius), "placed")
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK).cast("int"), F.lit(1))
    sizes = placed.groupBy("grp", "cell").agg(blocks(F.count(F.when(F.col("home"), 1))).alias("homes"), blocks(F.count("*")).alias("alls"))
    found = scratch.keep(_links(placed, sizes, threshold), "links")
    scratch.drop(placed)
    counts = found.groupBy("node").agg(F.sum("links").alias("others"))
    roots = components(found.select("node", "root"), scratch)
    node = (vectors.select("grp", "vector", "first", "copies").join(counts, F.col("first") == F.col("node"), "left").drop("node")
            .join(roots, F.col("first") == F.col("node"), "left")
            .select("grp", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "first").alias("c")))
    known = good.drop("usable").join(node, ["grp", "vector"]).select("id", F.col("n").cast("long").alias("n_links"), F.col("c").alias("component_id"))
    alone = own.where(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.union(alone).select(F.col("id").alias(id), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
