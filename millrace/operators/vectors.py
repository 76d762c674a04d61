"""Search by cosine over a stored index of vectors.

Vectors of length 1 are dealt to cells by their nearest centroid. A row keeps its vector, the residual to its centroid as
one signed byte a dimension, the length of what that leaves out, and its angle to the centroid. Centroids and the scale of
the residuals are fitted on SAMPLE rows at most, those with the least hash of their id; every row is indexed.

* search() probes each query's nearest cells, keeps the best by residuals and ranks them again by their vectors. How many
  cells are probed is fitted on the same sample for a share of true neighbours, so it is near that recall, not exact.
* within() is exact: a cell is left out if the triangle inequality of angles shows that nothing in it is near enough, a row
  if its angle or its residual with its error does; all others are compared by their vectors.

Cells are cut into parts of PART_ROWS rows or so by a hash of the id, and queries are dealt alike, so that a cell that holds
a third of all rows (copies of one vector) is many bounded groups. A query meets the rows of the cells it probes, not the table.

Null vectors, those of length 0, with null, infinite or undefined numbers, or with another number of dimensions than most of the
sample are indexed in cell -1 and similar to nothing. Rows with equal ids are one row's result each; ties rank by id. An empty
table gives an index without rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as T

SAMPLE, ROUNDS = 20_000, 12
MOST_CELLS, PART_ROWS, PART_QUERIES = 4096, 50_000, 4096
#: Rounding of cosines: below a threshold by this much, nothing is left out.
SLACK = 1e-4


def _matrix(col: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1, and which rows have one."""
    out = np.zeros((len(col), d))
    ok = np.zeros(len(col), bool)
    size = np.asarray(pc.fill_null(pc.list_value_length(col), -1))
    fit = np.flatnonzero(size == d)
    if len(fit):
        flat = col.take(pa.array(fit)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
        with np.errstate(invalid="ignore", over="ignore"):
            norm = np.sqrt((flat * flat).sum(axis=1))
            good = np.isfinite(norm) & (norm > 0)
        ok[fit[good]] = True
        out[fit[good]] = flat[good] / norm[good, None]
    return out, ok


def _angles(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _fitted(sample: np.ndarray, n_cells: int, recall: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Centroids of length 1, the residuals' scale, and how many cells hold that share of a row's nearest in the sample."""
    rng = np.random.default_rng(0)
    centroids = sample[rng.choice(len(sample), min(n_cells, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        cell = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, sample)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centroids = np.where(norm[:, None] > 0, sums / np.maximum(norm, 1e-12)[:, None], centroids)
    cell = (sample @ centroids.T).argmax(axis=1)
    scale = np.maximum(np.abs(sample - centroids[cell]).max(axis=0), 1e-9) / 127
    probes = rng.choice(len(sample), min(500, len(sample)), replace=False)
    cosine = sample[probes] @ sample.T
    cosine[np.arange(len(probes)), probes] = -2
    near = np.argsort(-cosine, axis=1)[:, : min(k, max(1, len(sample) - 1))]
    place = np.argsort(np.argsort(-(sample[probes] @ centroids.T), axis=1), axis=1)  # of each cell, from each probe
    rank = np.sort(np.take_along_axis(place, cell[near], axis=1), axis=None)
    return centroids, scale, int(rank[min(len(rank) - 1, math.ceil(recall * len(rank)) - 1)]) + 1


def write_index(vectors: DataFrame, path: str, id_col: str, vec_col: str, n_cells: int | None = None, recall: float = 0.97, k: int = 10) -> None:
    """Write an index below path. recall, k: what search() is fitted for."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    n = rows.count()
    drawn = [r["vec"] for r in rows.filter("vec is not null").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()]
    d = Counter(map(len, drawn)).most_common(1)[0][0] if drawn else 1
    sample, ok = _matrix(pa.array(drawn, pa.list_(pa.float64())), d)
    sample = sample[ok]
    if not len(sample):
        sample = np.eye(1, d)
    n_cells = max(1, min(n_cells or math.isqrt(n), MOST_CELLS, len(sample)))
    centroids, scale, n_probe = _fitted(sample, n_cells, recall, k)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, ok = _matrix(b.column(1), d)
            cosine = x @ centroids.T
            cell = cosine.argmax(axis=1)
            left = x - centroids[cell]
            codes = np.clip(np.rint(left / scale), -127, 127)
            error = np.sqrt(((left - codes * scale) ** 2).sum(axis=1))
            angle = _angles(cosine[np.arange(len(x)), cell])
            cols = [b.column(0), b.column(1), pa.array([c.tobytes() for c in codes.astype(np.int8)], pa.binary()), pa.array(error), pa.array(angle), pa.array(np.where(ok, cell, -1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["id", "vec", "codes", "error", "angle", "cell"])

    dealt = rows.mapInArrow(deal, "id long, vec array<double>, codes binary, error double, angle double, cell int")
    dealt.repartitionByRange("cell", F.xxhash64("id")).sortWithinPartitions("cell").write.partitionBy("cell").parquet(f"{path}/rows")
    spark.createDataFrame([(d, n_probe, scale.tolist())], "d int, n_probe int, scale array<double>").coalesce(1).write.parquet(f"{path}/settings")
    held = {r["cell"]: r for r in _rows(spark, path).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()}  # a row a cell
    cells = [(c, v.tolist(), held[c]["n"] if c in held else 0, held[c]["radius"] if c in held else 0.0) for c, v in enumerate(centroids)]
    spark.createDataFrame(cells, "cell int, centroid array<double>, n long, radius double").coalesce(1).write.parquet(f"{path}/cells")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id long, vec array<double>, codes binary, error double, angle double, cell int").parquet(f"{path}/rows")


class Index:
    """A written index. Its cells are few and of a known size, so tasks get them whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.rows = spark, _rows(spark, path)
        self.d, self.n_probe, scale = spark.read.parquet(f"{path}/settings").first()
        cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
        self.scale, self.centroids = np.array(scale), np.array([r["centroid"] for r in cells])
        self.n, self.radius = np.array([r["n"] for r in cells]), np.array([r["radius"] for r in cells])

    def _probes(self, queries: DataFrame, id_col: str, vec_col: str, n_probe: int | None, reach: float) -> DataFrame:
        """query_id, unit, angle, cell, n_parts: each query with the cells that it meets: the nearest n_probe, or those within reach."""
        d, centroids, radius, n_parts = self.d, self.centroids, self.radius, -(-self.n // PART_ROWS)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 1000):
                    ids, (x, ok) = b.column(0)[at : at + 1000], _matrix(b.column(1)[at : at + 1000], d)
                    angle = _angles(x @ centroids.T)
                    if n_probe is None:
                        met = angle - radius <= reach
                    else:
                        met = np.zeros(angle.shape, bool)
                        np.put_along_axis(met, np.argsort(angle, axis=1, kind="stable")[:, :n_probe], True, axis=1)
                    q, cell = np.nonzero(met & ok[:, None] & (n_parts > 0))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), pa.array(list(x[q]), pa.list_(pa.float64())), pa.array(angle[q, cell]), pa.array(cell.astype(np.int32)), pa.array(n_parts[cell].astype(np.int32))], ["query_id", "unit", "angle", "cell", "n_parts"])

        wanted = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("vec"))
        return wanted.mapInArrow(choose, "query_id long, unit array<double>, angle double, cell int, n_parts int")

    def _met(self, queries: DataFrame, id_col: str, vec_col: str, n_probe: int | None, reach: float, best: int | None, least: float) -> DataFrame:
        """query_id, id, cell, near: of each group of rows and queries the best by residuals, or all that may reach the least cosine."""
        probes, centroids, scale = self._probes(queries, id_col, vec_col, n_probe, reach), self.centroids, self.scale
        shares = self.n * (n_probe / len(self.n) if n_probe else 1.0)
        n_deals = max(1, math.ceil(queries.count() * float(shares.sum()) / max(1, int(self.n.sum())) / PART_QUERIES))
        deal = F.pmod(F.xxhash64("query_id"), F.lit(n_deals)).cast("int")
        asked = probes.select("query_id", "unit", "angle", "cell", deal.alias("deal"), F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part"))
        of = F.element_at(F.array(*[F.lit(max(1, int(-(-n // PART_ROWS)))) for n in self.n]), F.col("cell") + 1)
        part = F.pmod(F.xxhash64("id"), of).cast("int")
        held = self.rows.filter("cell >= 0").select("id", "codes", "error", F.col("angle").alias("row_angle"), "cell", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_deals - 1))).alias("deal"))
        keys = ["cell", "part", "deal"]

        def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
            found: list[list[np.ndarray]] = [[], [], []]
            if rows.num_rows and asked.num_rows:
                cell = rows.column("cell")[0].as_py()
                ids, error, angle = (rows.column(c).to_numpy() for c in ("id", "error", "row_angle"))
                codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.int8).reshape(len(ids), -1) * scale
                units = asked.column("unit").combine_chunks().flatten().to_numpy().reshape(asked.num_rows, -1)
                for q, unit, near_by in zip(asked.column("query_id").to_pylist(), units, asked.column("angle").to_numpy(), strict=True):
                    near = codes @ unit + centroids[cell] @ unit
                    if best is None:
                        keep = np.flatnonzero((near + error >= least) & (np.abs(angle - near_by) <= reach) & (ids != q))
                    else:
                        keep = np.argpartition(-near, min(best, len(near) - 1))[: best + 1]  # one more, for the query itself
                        keep = keep[ids[keep] != q]
                    found[0].append(np.full(len(keep), -1 if q is None else q))
                    found[1].append(ids[keep])
                    found[2].append(near[keep])
            cols = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(found, (np.int64, np.int64, float), strict=True)]
            return pa.table([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(np.full(len(cols[0]), rows.column("cell")[0].as_py() if rows.num_rows else -1, np.int32)), pa.array(cols[2].astype(float))], ["query_id", "id", "cell", "near"])

        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, "query_id long, id long, cell int, near double")

    def _exact(self, met: DataFrame, queries: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        wanted = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("query_vec"))
        pairs = met.join(self.rows.select("id", "cell", "vec"), ["cell", "id"]).join(wanted, "query_id")
        return pairs.select("query_id", "id", F.round(T.cosine(F.col("vec"), F.col("query_vec")), 4).alias("cosine"))

    def search(self, queries: DataFrame, id_col: str, vec_col: str, k: int, n_probe: int | None = None, spare: int = 4) -> DataFrame:
        """query_id, id, cosine, rank: of each query the k most similar others that its cells hold."""
        met = self._met(queries, id_col, vec_col, min(n_probe or self.n_probe, len(self.n)), math.pi, spare * k, -1.0)
        by = W.partitionBy("query_id")
        some = met.withColumn("r", F.row_number().over(by.orderBy(F.desc("near"), "id"))).filter(F.col("r") <= spare * k)
        rank = F.row_number().over(by.orderBy(F.desc("cosine"), "id"))
        return self._exact(some, queries, id_col, vec_col).withColumn("rank", rank).filter(F.col("rank") <= k)

    def within(self, queries: DataFrame, id_col: str, vec_col: str, threshold: float) -> DataFrame:
        """query_id, id, cosine: all others at least so similar, none left out."""
        least = threshold - SLACK
        reach = math.acos(max(-1.0, min(1.0, least))) + 1e-6
        return self._exact(self._met(queries, id_col, vec_col, None, reach, None, least), queries, id_col, vec_col).filter(F.col("cosine") >= threshold)
