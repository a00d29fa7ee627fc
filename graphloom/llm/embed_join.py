"""Near-duplicate embeddings: an exact range join in Euclidean space, partitioned by pivots.

On unit vectors cosine >= s means distance <= r = sqrt(2 - 2 s). A vector lives in the cell of its nearest pivot. Two
vectors within r of each other whose home cells are p and q: by the triangle inequality the first is at most 2 r
farther from q than from p, so it visits q only under that bound; the distance to the plane halfway between p and q,
|d(x,q)^2 - d(x,p)^2| / (2 d(p,q)) <= r, bounds visits more tightly and is applied too. A cell compares its residents
with all who are there and needs no other cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from .common import materialize, mix

COSINE = 0.95
#: Residents of a cell on average; a cell of more is compared in chunks of as many.
CELL = 16_384
#: Pivots at most; they are drawn from the vectors of least digest, so any order of rows gives the same ones.
PIVOTS = 1024
#: Members that one unit of work compares its residents with, on average at most.
VISITORS = 32_768
BLOCK = 1024
#: Rows that go to the JVM at once.
SENT = 16_384
#: Cosines are first taken in single precision; so much below the threshold they are taken again in double.
NEAR = 1e-3
#: Bounds are widened by this much, so that rounding never loses a link that the exact test would make.
SLACK = 1e-6


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def homes(vectors: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and [n, pivots] whether it is in a cell at all."""
    square = np.maximum(0, 2 - 2 * vectors @ pivots.T)
    home = square.argmin(axis=1)
    near = np.take_along_axis(square, home[:, None], axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))[home]
    there = np.sqrt(square) <= np.sqrt(near) + 2 * radius + SLACK
    there &= square - near <= 2 * apart * (radius + SLACK)
    there[np.arange(len(home)), home] = True
    return home, there


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1).astype(np.float64)


def _pack(kind: str):
    """Vectors as bytes, so that equal ones can be grouped; unusable ones are null."""

    def usable(x) -> bool:
        return x is not None and len(x) > 0 and None not in x and bool(np.isfinite(x).all()) and bool(np.any(np.asarray(x, dtype=kind) != 0))

    def run(batches):
        for batch in batches:
            # Adding zero turns -0.0 into 0.0, so equal vectors have equal bytes.
            packed = [(np.asarray(x, dtype=kind) + np.dtype(kind).type(0)).tobytes() if usable(x) else None for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], names=["vec_id", "packed"])

    return run


def _sizes(pivots: np.ndarray, radius: float, kind: str):
    """Residents and members of each cell, batch by batch."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                home, there = homes(unit(_matrix(batch.column(1).slice(at, BLOCK), kind)), pivots, radius)
                residents = np.bincount(home, minlength=len(pivots))
                yield pa.record_batch([pa.array(np.arange(len(pivots), dtype=np.int32)), pa.array(residents), pa.array(there.sum(axis=0))], names=["cell", "residents", "members"])

    return run


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and running number of each row repeated count times."""
    rows = np.repeat(np.arange(len(count)), count)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)


def _units(pivots: np.ndarray, radius: float, left: np.ndarray, right: np.ndarray, kind: str):
    """Deal to units (cell, chunk of residents, chunk of members): left rows are residents, right rows members."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids = part.column(0).to_numpy()
                home, there = homes(unit(_matrix(part.column(1), kind)), pivots, radius)
                rows, other = _spread(right[home])
                chunk = mix(ids.astype(np.uint64))  # ids may all be multiples of something
                yield from rows_of(part, rows, home[rows], chunk[rows] % left[home[rows]].astype(np.uint64), other, True)
                at_rows, at_cells = np.nonzero(there)
                again, other = _spread(left[at_cells])
                rows, cells = at_rows[again], at_cells[again]
                yield from rows_of(part, rows, cells, other, chunk[rows] % right[cells].astype(np.uint64), False)

    def rows_of(part, rows, cells, i, j, resident):
        for at in range(0, len(rows), SENT):
            some = slice(at, at + SENT)
            take = pa.array(rows[some])
            columns = [*(pa.array(x[some].astype(np.int32)) for x in (cells, i, j)), pa.array(np.full(len(take), resident)), *(c.take(take) for c in part.columns)]
            yield pa.record_batch(columns, names=["cell", "i", "j", "resident", "id", "packed", "copies"])

    return run


_FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("least", pa.int64())])


def _compare(cosine: float, kind: str):
    """Residents against members: number of links of each resident, and the least id it is connected to here.

    Pairs are counted block by block and folded into a forest, never listed.
    """

    def run(table: pa.Table) -> pa.Table:
        resident = table.column("resident").to_numpy()
        mine, all_ = (table.filter(pa.array(x)).combine_chunks() for x in (resident, ~resident))
        mine_id, all_id = mine.column("id").to_numpy(), all_.column("id").to_numpy()
        ids = np.unique(np.concatenate([mine_id, all_id]))
        mine_at, all_at = np.searchsorted(ids, mine_id), np.searchsorted(ids, all_id)
        copies = all_.column("copies").to_numpy()
        x, y = unit(_matrix(mine.column("packed").combine_chunks(), kind)), unit(_matrix(all_.column("packed").combine_chunks(), kind))
        links, root = np.zeros(len(x), dtype=np.int64), np.arange(len(ids))
        rough, roughly = x.astype(np.float32), y.astype(np.float32)
        for i in range(0, len(x), BLOCK):
            for j in range(0, len(y), BLOCK):
                a, b = _alike(x[i : i + BLOCK], y[j : j + BLOCK], rough[i : i + BLOCK], roughly[j : j + BLOCK], cosine)
                a, b = a + i, b + j
                apart = mine_at[a] != all_at[b]
                a, b = a[apart], b[apart]
                np.add.at(links, a, copies[b])
                root = _hook(root, mine_at[a], all_at[b])
        least = ids[root]  # roots are least places of a sorted array
        counted = np.zeros(len(ids), dtype=np.int64)
        counted[mine_at] = links
        keep = (counted > 0) | (least != ids)
        return pa.table([pa.array(ids[keep]), pa.array(counted[keep]), pa.array(least[keep])], schema=_FOUND)

    return run


def _alike(x: np.ndarray, y: np.ndarray, rough: np.ndarray, roughly: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose cosine in double precision is at least ``cosine``; single precision rules most of them out."""
    a, b = np.nonzero(rough @ roughly.T >= np.float32(cosine - NEAR))
    if 20 * len(a) > len(x) * len(y):
        return np.nonzero(x @ y.T >= cosine)
    sure = np.einsum("ij,ij->i", x[a], y[b]) >= cosine
    return a[sure], b[sure]


def _hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart]))
        while not np.array_equal(root, up := root[root]):
            root = up
    return root


def _joined(classes: DataFrame, n: int, cosine: float, cell: int, pivots: int, kind: str) -> DataFrame:
    """(key, links, least) of n classes (key, packed, copies) of vectors of one length, once for each unit of work."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    chosen = classes.orderBy(F.xxhash64("packed"), "key").limit(min(pivots, max(1, -(-n // cell)))).select("packed").collect()
    centres = unit(_matrix(pa.array([bytes(r[0]) for r in chosen], pa.binary()), kind))
    sizes = classes.select("key", "packed").mapInArrow(_sizes(centres, radius, kind), "cell int, residents long, members long").groupBy("cell").sum("residents", "members").collect()
    left, right = np.ones(len(centres), dtype=np.int64), np.ones(len(centres), dtype=np.int64)
    for k, residents, members in sizes:
        left[k], right[k] = max(1, -(-residents // cell)), max(1, -(-members // VISITORS))
    units = classes.select("key", "packed", "copies").mapInArrow(_units(centres, radius, left, right, kind), "cell int, i int, j int, resident boolean, id long, packed binary, copies long")
    return units.groupBy("cell", "i", "j").applyInArrow(_compare(cosine, kind), "id long, links long, least long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, pivots: int = PIVOTS) -> DataFrame:
    """One row per row of (vec_id, embedding): vec_id, n_links, component_id, kept.

    Null, zero and non-finite vectors link with nothing, whatever they equal, nor do rows without a vec_id; such a row
    is a component of its own. Vectors of different lengths do not link. Equal vectors are compared once, as a class,
    and count each other as links; rows that repeat, or share an id, count one by one. An empty table gives no rows;
    columns beyond vec_id and embedding are ignored.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull) else "<f8"
    rows = materialize(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_pack(kind), "vec_id long, packed binary"), "vectors")
    usable = F.col("packed").isNotNull() & F.col("vec_id").isNotNull()
    classes = rows.where(usable).groupBy("packed").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("key"), "id", "packed", "copies"), "classes")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    size = F.octet_length("packed").alias("size")
    lengths = classes.groupBy(size).count().orderBy("size").collect()  # as many rows as lengths of vectors
    if not lengths:
        return alone
    found = None
    for length, n in lengths:
        one = _joined(classes.where(size == length) if len(lengths) > 1 else classes, n, cosine, cell, pivots, kind)
        found = one if found is None else found.union(one)
    found = materialize(found, "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "key")
    roots = components(found.where("id <> least"), "id", "least").withColumnRenamed("node", "key")
    classes = classes.join(counts, "key", "left").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = classes.join(named, "root").select("packed", (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.where(usable).join(classes, "packed")
    return linked.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).union(alone)
