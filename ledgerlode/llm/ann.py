"""Approximate nearest neighbours on shifted space-filling curves.

Vectors are projected on ``CURVES`` random subspaces of ``DIMS`` dimensions, scaled and
shifted, and each projection orders them along a Hilbert curve. Spark range-partitions
and sorts every ordering, so each vector has a rank in it. A query's candidates are the
vectors whose blocks of ``BLOCK`` ranks lie within the window around its own rank, in any
ordering; they are merged and reranked by inner product on the original vectors in double
precision.

The window is measured, not guessed: for ``PROBES`` queries (a bounded sample) the true
neighbours are found by scanning all vectors, and the window is made so wide that
``TARGET`` of these neighbours come within it in some ordering, at every size of the table. Centre and scale of the
projections come from ``SAMPLE`` vectors; every vector is indexed.

Equal vectors are one node with its least ids, one more than the neighbours asked for,
which is all that a result can hold; so a vector that a third of the rows share neither
crowds a block nor hides its least ids. Blocks have equal sizes, so no task is larger than
the others; queries and candidates meet in them by an equi-join on the block.

Vectors that are null, zero, of another length than most, or hold a null or non-finite
component take no part. Rows that repeat vec_id and vector count once, and no row with
the query's own vec_id is its candidate. Null ids take no part. Fewer candidates than
asked for give fewer rows; an empty table gives none. Columns beside vec_id and embedding
aren't read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.llm.common import bounded, checkpoint, table

NEIGHBOURS = 20
CURVES, DIMS, DEPTH = 16, 8, 6
BLOCK = 4096
PROBES, TARGET = 64, 0.97
SAMPLE = 4096


def hilbert(cell: np.ndarray, depth: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points, shape (points, dims), below 2**depth each."""
    x = cell.astype(np.int64).T.copy()
    d = len(x)
    for bit in range(depth - 1, 0, -1):  # undo the curve's rotations, from the coarsest cells
        low = (1 << bit) - 1
        for i in range(d):
            on = (x[i] >> bit) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(depth - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> bit) & 1
    return key


class Curves:
    """Projections, shifts and scales of all orderings."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.dims = min(DIMS, sample.shape[1])
        self.centre = sample.mean(0)
        self.axes, self.scale, self.shift = [], [], []
        for _ in range(curves):
            axes = np.linalg.qr(rng.standard_normal((sample.shape[1], self.dims)))[0]
            self.axes.append(axes)
            self.scale.append(6 * np.maximum(((sample - self.centre) @ axes).std(0), 1e-9))
            self.shift.append(0.5 + rng.uniform(-0.1, 0.1, self.dims))

    def keys(self, x: np.ndarray) -> list[np.ndarray]:
        out = []
        for axes, scale, shift in zip(self.axes, self.scale, self.shift, strict=True):
            y = (x - self.centre) @ axes / scale + shift
            out.append(hilbert(np.clip((y * (1 << DEPTH)).astype(np.int64), 0, (1 << DEPTH) - 1), DEPTH))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _top(score: np.ndarray, k: int, tie: np.ndarray) -> np.ndarray:
    """Columns of the k largest of each row; ties to the smaller ``tie``."""
    k = min(k, score.shape[1])
    edge = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
    out = np.empty((len(score), k), np.int64)
    for r in range(len(score)):
        at = np.flatnonzero(score[r] >= edge[r])
        out[r] = at[np.lexsort((tie[at], -score[r][at]))[:k]]
    return out


def _ranks(nodes: DataFrame, curves: Curves) -> DataFrame:
    """(curve, node, rank) in every ordering."""
    sent = nodes.sparkSession.sparkContext.broadcast(curves)

    def keys(batches):
        for batch in bounded(batches):
            if batch.num_rows:
                all_keys = sent.value.keys(_matrix(batch.column(1)))
                for c, k in enumerate(all_keys):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), c, np.int32)), pa.array(k), batch.column(0)], names=["curve", "key", "node"])

    def number(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve = batch.column(0).to_numpy()
            place = np.zeros(len(curve), np.int64)
            for c in np.unique(curve):
                own = np.flatnonzero(curve == c)
                place[own] = seen.get(c, 0) + np.arange(len(own))
                seen[c] = seen.get(c, 0) + len(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(curve), part, np.int32)), batch.column(0), batch.column(2), pa.array(place)], names=["part", "curve", "node", "place"])

    keyed = nodes.select("node", "vec").mapInArrow(keys, "curve int, key bigint, node bigint")
    dealt = keyed.repartitionByRange("curve", "key", "node").sortWithinPartitions("curve", "key", "node")
    placed = checkpoint(dealt.mapInArrow(number, "part int, curve int, node bigint, place bigint"))
    sizes = placed.groupBy("curve", "part").agg((F.max("place") + 1).alias("n")).collect()  # a row for each curve and task
    first, rows = {}, []
    for r in sorted(sizes, key=lambda r: (r.curve, r.part)):
        rows.append((r.curve, r.part, first.get(r.curve, 0)))
        first[r.curve] = first.get(r.curve, 0) + r.n
    start = nodes.sparkSession.createDataFrame(rows, "curve int, part int, first bigint")
    return placed.join(F.broadcast(start), ["curve", "part"]).select("curve", "node", (F.col("place") + F.col("first")).alias("rank"))


def _window(nodes: DataFrame, queries: DataFrame, ranks: DataFrame, n: int, k: int) -> int:
    """The rank distance within which ``TARGET`` of the true neighbours of some queries lie in their best ordering."""
    probe = queries.orderBy(F.xxhash64("node"), "node").limit(PROBES).collect()
    q = np.array([r.vec for r in probe], np.float64)
    names = np.array([r.node for r in probe])

    def scan(batches):
        best: list = [([], []) for _ in names]
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy()
            score = q @ _matrix(batch.column(1)).T
            for r, at in enumerate(_top(score, k, node)):
                s, m = np.concatenate([best[r][0], score[r][at]]), np.concatenate([best[r][1], node[at]])
                keep = np.lexsort((m, -s))[:k]
                best[r] = (s[keep], m[keep])
        rows = [(names[r], int(m), float(s)) for r, (ss, mm) in enumerate(best) for s, m in zip(ss, mm, strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["q", "node", "score"])

    near = nodes.select("node", "vec").mapInArrow(scan, "q bigint, node bigint, score double").where("q <> node")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "node"))).where(F.col("n") <= k).collect()
    wanted = sorted({r.node for r in near} | {r.q for r in near})
    at = {(r.curve, r.node): r.rank for r in ranks.where(F.col("node").isin(wanted)).collect()}
    gap = [min(abs(at[c, r.q] - at[c, r.node]) for c in range(CURVES)) for r in near]
    return int(np.quantile(gap, TARGET)) + 1 if gap else n


def search(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` vectors found nearest for each vec_id of ``queries``.

    vectors: vec_id and embedding; queries: a subset of its rows.
    """
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"

    def usable(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind).alias("vec"))
        bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return df.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))

    rows = usable(vectors)
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not length:
        return none
    rows = rows.where(F.size("vec") == length[0].n)
    few = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    nodes = checkpoint(few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("node", F.monotonically_increasing_id()))
    asked = checkpoint(usable(queries).distinct().join(nodes.select("vec", "node"), "vec").select("vec_id", "node"))
    probes = asked.select("node").distinct().join(nodes.select("node", "vec"), "node")
    if not probes.limit(1).count():
        return none
    n = nodes.count()
    sample = nodes.orderBy(F.xxhash64("vec"), "node").limit(SAMPLE).select("vec").collect()
    ranks = checkpoint(_ranks(nodes, Curves(np.array([r.vec for r in sample], np.float64))))
    window = _window(nodes, probes, ranks, n, k)
    block = min(BLOCK, max(64, window))
    reach = -(-window // block)

    own = F.floor(F.col("rank") / block).cast("long")
    candidates = ranks.select("curve", own.alias("block"), F.lit(1).alias("kind"), "node").join(nodes.select("node", "vec", F.col("ids")[0].alias("tie")), "node")
    asks = ranks.join(probes, "node").select("node", "curve", F.explode(F.sequence(F.greatest(own - reach, F.lit(0)), F.least(own + reach, F.lit((n - 1) // block)))).alias("block"), F.lit(0).alias("kind"), "vec", F.lit(0).cast("long").alias("tie"))
    meet = candidates.select("curve", "block", "kind", "node", "vec", "tie").union(asks.select("curve", "block", "kind", "node", "vec", "tie"))
    meet = meet.repartition("curve", "block").sortWithinPartitions("curve", "block", "kind")

    def rerank(batches):
        key, held, best = None, [], {}

        def flush():
            rows = [(q, int(m), float(s)) for q, (ss, mm, _) in best.items() for s, m in zip(ss, mm, strict=True)]
            held.clear()
            best.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["q", "node", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            curve, blk, kind = (batch.column(c).to_numpy() for c in range(3))
            node, vec, tie = batch.column(3).to_numpy(), _matrix(batch.column(4)), batch.column(5).to_numpy()
            cut = np.flatnonzero((np.diff(curve) != 0) | (np.diff(blk) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cut], [*cut, len(curve)], strict=True):
                if (curve[i], blk[i]) != key:
                    yield from flush()
                    key = (curve[i], blk[i])
                if kind[i] == 0:
                    held.append((node[i:j], vec[i:j]))
                    continue
                for names, q in held:
                    for a in range(0, len(names), 512):
                        score = q[a : a + 512] @ vec[i:j].T
                        for r, at in enumerate(_top(score, k + 1, tie[i:j])):
                            s, m, t = best.get(int(names[a + r]), ((), (), ()))
                            s, m, t = np.concatenate([s, score[r][at]]), np.concatenate([m, node[i:j][at]]), np.concatenate([t, tie[i:j][at]])
                            order = np.lexsort((t, -s))[: k + 1]
                            best[int(names[a + r])] = (s[order], m[order], t[order])
        yield from flush()

    found = meet.mapInArrow(rerank, "q bigint, node bigint, score double").groupBy("q", "node").agg(F.max("score").alias("score"))
    found = found.join(nodes.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("vec_id"))
    nearest = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("n", nearest).where(F.col("n") <= k + 1)
    out = asked.toDF("query_id", "q").join(found, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), F.col("vec_id"), "score")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))


QUERIES = {"op5_ann": op5_ann}
ORACLE: dict[str, str] = {}
