"""Exact top-k cosine search over clusters: the triangle inequality tells which clusters cannot hold a match.

Vectors of unit length are dealt to the nearest of a bounded number of centres; a cluster is known by its centre, its
radius and its size. A question first meets its nearest clusters until they hold k vectors. Its k-th best score then bounds the
distance of a match, and of the other clusters it meets only those whose centre is no farther than that distance and the radius
together. No cluster that could hold a match is left out, so the result is exact.

Vectors are written once, by cluster, and shuffled once a round, however many questions there are. A large cluster is several
cells of bounded size. A task holds one cell's vectors while questions stream past them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.scores import ROUNDING, Best, arrow_type, unit_rows
from sluice.sources.staging import staged

# Ship the search code with the tasks, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLUSTER_ROWS = 4096  # vectors that a cluster has on average, until there are MAX_CENTRES of them
CENTRE_BYTES = 32 << 20  # bound of all centres together, and of the sample that they are fitted on
MAX_CENTRES = 4096
CELL_BYTES = 64 << 20  # bound of the vectors that a task holds at once
ROUNDS = 4  # of moving centres to the middle of their sample
SLACK = 1e-7  # more than rounding can move a distance
ASKED = 1024  # questions that meet a cell together
NO_CLUSTER = -1  # of vectors without a direction
LEAST, BLANK = "least", "blank"  # cells of the k least ids of all, and of all without a direction


@dataclass(frozen=True)
class Clusters:
    """Centres, radii and sizes of clusters, in order of number: what tasks that place questions are sent."""

    dim: int
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


@dataclass(frozen=True)
class Index:
    """``vectors`` (cluster, id, values), a written table if there are several clusters, and the clusters."""

    vectors: DataFrame
    clusters: Clusters

    @property
    def kind(self) -> str:
        return dict(self.vectors.dtypes)["id"]


def _fit(sample: np.ndarray, centres: int) -> np.ndarray:
    """Centres of unit length for a sample of unit vectors: the first rows, moved to the middle of what is nearest to them."""
    found = np.unique(sample[:centres], axis=0)
    for _ in range(ROUNDS):
        nearest = np.argmax(sample @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        moved = norms > 1e-6
        found[moved] = sums[moved] / norms[moved, None]
    return found


def build(vectors: DataFrame, dim: int, cluster_rows: int = CLUSTER_ROWS) -> Index:
    """An index of ``id, values``; rows of another length than ``dim`` take no part.

    Centres are fitted on a sample of at most CENTRE_BYTES, chosen by a hash of the id; every vector is indexed, and radii
    and sizes are those of all vectors. At most MAX_CENTRES rows of them come to the driver.
    """
    rows = vectors.where(F.size("values") == dim).select("id", F.col("values").cast("array<double>").alias("values"))
    bound = max(1, CENTRE_BYTES // (8 * dim))
    head = rows.orderBy(F.xxhash64("id"), "id").limit(bound).toArrow()
    n = head.num_rows if head.num_rows < bound else rows.count()
    sample, blank = unit_rows(head.column("values"), dim)
    sample = sample[~blank]
    wanted = min(MAX_CENTRES, bound, max(1 if n == head.num_rows else 2, round(n / cluster_rows)))
    centres = _fit(sample, wanted) if len(sample) else np.zeros((0, dim))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, none = unit_rows(batch.column("values"), dim)
            cluster, far = np.full(len(found), NO_CLUSTER), np.zeros(len(found))
            if len(centres) and len(found):
                cosine = found @ centres.T
                cluster = np.where(none, NO_CLUSTER, np.argmax(cosine, axis=1))
                far = np.where(none, 0.0, np.linalg.norm(found - centres[np.maximum(cluster, 0)], axis=1))
            names = ["cluster", "id", "values", "far"]
            yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), batch.column("id"), batch.column("values"), pa.array(far)], names=names)

    kind = dict(rows.dtypes)["id"]
    made = rows.mapInArrow(assign, f"cluster int, id {kind}, values array<double>, far double")
    if len(centres) < 2:  # the sample is all of them: one cluster, which every question meets
        return Index(made.drop("far"), Clusters(dim, centres, np.full(len(centres), 2.0), np.full(len(centres), len(sample))))
    made = staged(made, "index")
    radii, sizes = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for r in made.where(F.col("cluster") >= 0).groupBy("cluster").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect():
        radii[r.cluster], sizes[r.cluster] = r.radius, r.n
    return Index(made.drop("far"), Clusters(dim, centres, radii, sizes))


def _nearest(clusters: Clusters, k: int):
    """The first round's clusters of each question: the nearest, until they hold k vectors."""

    def choose(questions: np.ndarray, floors: None) -> list[np.ndarray]:
        order = np.argsort(-(questions @ clusters.centres.T), axis=1, kind="stable")
        held = np.cumsum(clusters.sizes[order], axis=1)
        enough = np.argmax(held >= k, axis=1) + 1
        enough[held[:, -1] < k] = order.shape[1]
        return [row[:n] for row, n in zip(order, enough)]

    return choose


def _within(clusters: Clusters, k: int):
    """The second round's clusters: those that can hold a match as good as the k-th best, without the first round's."""
    first = _nearest(clusters, k)

    def choose(questions: np.ndarray, floors: np.ndarray) -> list[np.ndarray]:
        apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (questions @ clusters.centres.T)))
        least = np.maximum(0.0, apart - clusters.radii - SLACK)
        possible = (1.0 - least * least / 2.0 >= floors[:, None] - ROUNDING) & (clusters.sizes > 0)
        for row, done in zip(possible, first(questions, None)):
            row[done] = False
        return [np.flatnonzero(row) for row in possible]

    return choose


def _placed(clusters: Clusters, asked: DataFrame, choose, cell_rows: int, lacking: bool = False) -> DataFrame:
    """``query_id, values, floor, cell``: a row for every cell that a question meets.

    Questions without a direction meet the least ids alone; where vectors are ``lacking``, all others meet those without one too.
    """
    kind, dim = dict(asked.dtypes)["query_id"], clusters.dim
    cells = np.maximum(1, -(-clusters.sizes // cell_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ASKED):
                part = batch.slice(start, ASKED)
                questions, none = unit_rows(part.column("values"), dim)
                floors = part.column("floor").to_numpy(zero_copy_only=False)
                chosen = choose(questions, floors) if len(clusters.centres) else [np.empty(0, np.int64)] * len(questions)
                rows, met = [], []
                for row, own in enumerate(chosen):
                    names = [LEAST] if none[row] else [f"{c}:{piece}" for c in own.tolist() for piece in range(cells[c])]
                    names += [BLANK] if lacking and not none[row] else []
                    met += names
                    rows += [row] * len(names)
                if rows:
                    taken = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([taken.column("query_id"), taken.column("values"), taken.column("floor"), pa.array(met)], names=["query_id", "values", "floor", "cell"])

    return asked.mapInArrow(run, f"query_id {kind}, values array<double>, floor double, cell string")


def _meet(index: Index, placed: DataFrame, k: int, cell_rows: int, more: DataFrame | None = None) -> DataFrame:
    """``query_id, id, score``: of every cell the k best that reach the question's floor."""
    id_kind, query_kind, dim = index.kind, dict(placed.dtypes)["query_id"], index.clusters.dim
    cells = dict(enumerate(np.maximum(1, -(-index.clusters.sizes // cell_rows)).tolist()))
    split = {c: n for c, n in cells.items() if n > 1}  # at most one entry per centre
    pieces = F.lit(1)
    if split:
        pieces = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in split.items() for x in pair]), F.col("cluster")), F.lit(1))
    cell = F.concat_ws(":", "cluster", F.pmod(F.xxhash64("id"), pieces))
    held_rows = index.vectors.where(F.col("cluster") >= 0).select(cell.alias("cell"), "id", "values")
    own = (held_rows if more is None else held_rows.unionByName(more)).select(
        "cell", F.lit(0).alias("asked"), "id", F.lit(None).cast(query_kind).alias("query_id"), "values", F.lit(None).cast("double").alias("floor")
    )
    questions = placed.select("cell", F.lit(1).alias("asked"), F.lit(None).cast(id_kind).alias("id"), "query_id", "values", "floor")
    tasks = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = own.unionByName(questions).repartition(tasks, "cell").sortWithinPartitions("cell", "asked")
    id_type, query_type = arrow_type(id_kind), arrow_type(query_kind)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
        """Runs of rows of one cell and kind."""
        for batch in batches:
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("asked").to_pylist()))
            first = 0
            for row in range(1, len(keys) + 1):
                if row == len(keys) or keys[row] != keys[first]:
                    yield keys[first], batch.slice(first, row - first)
                    first = row

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(runs(batches), lambda run: run[0][0]):
            held: list[pa.RecordBatch] = []
            matrix = ids = None
            for (_, asked), part in group:
                if not asked:
                    held.append(part)
                    continue
                if not held:
                    break
                if matrix is None:
                    whole = pa.Table.from_batches(held)
                    matrix, ids = unit_rows(whole.column("values"), dim), whole.column("id").to_numpy()
                for start in range(0, part.num_rows, ASKED):
                    some = part.slice(start, ASKED)
                    best = Best(some.num_rows, k, some.column("floor").to_numpy(zero_copy_only=False))
                    best.add(unit_rows(some.column("values"), dim), matrix, ids)
                    yield best.rows(some.column("query_id").to_numpy(zero_copy_only=False), id_type, query_type)

    return table.mapInArrow(search, f"query_id {query_kind}, id {id_kind}, score double")


def top_k(index: Index, queries: DataFrame, k: int, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """``query_id, rank, id, score`` of the k nearest vectors of each question (``query_id, values``), by cosine.

    Scores are compared at nine decimals, and ties go to the smaller id. A vector without a direction has no angle: its
    score is NULL and comes last; for a question without one all scores are NULL.
    """
    clusters = index.clusters
    cell_rows = max(1, cell_bytes // (8 * clusters.dim))
    several = len(clusters.centres) > 1
    asked = queries.where(F.size("values") == clusters.dim).select(
        "query_id", F.col("values").cast("array<double>").alias("values"), F.lit(float("-inf")).alias("floor")
    )
    asked = staged(asked, "questions") if several else asked
    lacking = int(clusters.sizes.sum()) < k
    more = index.vectors.orderBy("id").limit(k).select(F.lit(LEAST).alias("cell"), "id", "values")
    if lacking:
        blank = index.vectors.where(F.col("cluster") == NO_CLUSTER).orderBy("id").limit(k)
        more = more.unionByName(blank.select(F.lit(BLANK).alias("cell"), "id", "values"))
    found = _meet(index, _placed(clusters, asked, _nearest(clusters, k), cell_rows, lacking), k, cell_rows, more)
    if several:
        found = staged(found, "first-round")
        # the k-th best score so far; a question that met fewer than k vectors has met all there are
        known = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
        floors = known.select("query_id", F.get("scores", F.lit(k - 1)).alias("floor")).where(F.col("floor").isNotNull())
        again = _placed(clusters, asked.drop("floor").join(floors, "query_id"), _within(clusters, k), cell_rows)
        found = found.unionByName(_meet(index, again, k, cell_rows))
    place = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
