"""Hard negatives by exact inner products, with coordinate pruning in length buckets.

Vectors are dealt to shards by a hash of the row, so equal vectors and rows of one label
are spread. A task reads a shard, sorts it by length into buckets whose shortest vector
has at least ``LENGTH_RATIO`` of the longest, and keeps a sorted list of every coordinate
of the unit vectors for each bucket. Then the anchors stream past in batches. An anchor
has a threshold, the least score that could still enter its results, which rises as
buckets are worked off from the longest vectors on:

* a bucket whose longest vector cannot reach the threshold ends the shard;
* a score of at least the threshold bounds the angle between anchor and vector, and so
  the value that the vector may have in each coordinate. The feasible ranges of the
  anchor's ``FOCUS`` largest coordinates are cut out of the sorted lists and
  intersected, starting with the shortest;
* what is left is verified by the exact integer product. Where the shortest range holds
  most of a bucket, the whole bucket is verified by one matrix product.

Results are exact: a pruned vector cannot be in them. Every shard gives its best for
each wanted range of scores, and these are merged. First the positives are found, each
anchor in the shards of its label; their scores are the ranges in which negatives are
sought, each anchor in all shards. A task holds one shard of at most ``SHARD_CELLS``
components and one batch of anchors.

Cases: rows without an id, a label or a vector, with an empty vector or with a null or
non-finite component take no part. A row that is repeated counts once; rows that share
an id but not the vector or label are rows each. Vectors of different dimension are
never compared. Ties go to the smaller id. An anchor without other rows of its label has
no positives and gives no rows, as does a positive with a negative score. Scores that a
long cannot hold end the job. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.scratch import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
FOCUS = 4
LENGTH_RATIO = 0.9
BUCKET_ROWS = 2048
#: Components of a shard at most, and at least where there are enough tasks.
SHARD_CELLS, LEAST_CELLS = 1 << 22, 1 << 17
ANCHORS_TOGETHER = 256
#: Beyond this share of a bucket a range does not select.
DENSE = 0.5
#: Angles and unit vectors are rounded; feasible ranges are widened by this.
_SLACK = 1e-5
_EXACT = 2.0**53
_LEAST, _MOST = -(2**63), 2**63 - 1

HITS = "anchor_id long, _key long, want long, vec_id long, score long"


def integer_vectors(table: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (integers), ``dim`` and ``_key`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("int")
    moved = F.when(vec_id % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    return (
        table.where(vec_id.isNotNull() & label.isNotNull() & (F.size(v) > 0) & finite)
        .select(
            vec_id.alias("vec_id"),
            moved.alias("label"),
            F.transform(v, lambda x: F.floor(x * SCALE)).alias("vector"),
        )
        .distinct()
        .withColumn("dim", F.size("vector"))
        .withColumn("_key", F.xxhash64("label", "vector"))
    )


@dataclass
class Bucket:
    """Rows of similar length; row i of ``order`` and ``values`` lists coordinate i, ascending."""

    vectors: np.ndarray
    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    longest: float
    shortest: float
    unit: np.ndarray
    order: np.ndarray
    values: np.ndarray


def length_buckets(vectors, ids, keys, labels) -> Iterator[Bucket]:
    """Buckets from the longest vectors on."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    by_length = np.argsort(-lengths, kind="stable")
    start, n = 0, len(by_length)
    while start < n:
        longest = lengths[by_length[start]]
        near = np.searchsorted(-lengths[by_length], -longest * LENGTH_RATIO, side="right")
        stop = min(max(int(near), start + 1), start + BUCKET_ROWS)
        at = by_length[start:stop]
        unit = vectors[at].astype(np.float64) / np.maximum(lengths[at], 1e-300)[:, None]
        unit = unit.astype(np.float32)
        order = np.argsort(unit, axis=0).T.astype(np.int32).copy()
        yield Bucket(
            vectors[at], ids[at], keys[at], labels[at], longest, lengths[at[-1]],
            unit, order, np.take_along_axis(unit.T, order, 1),
        )
        start = stop


class Anchor:
    """An anchor's vector and, for each wanted range of scores, the best found so far."""

    def __init__(self, row: dict, vector: np.ndarray, most: int, same: bool):
        self.id, self.key, self.label = row["vec_id"], row["_key"], row["label"]
        self.wants, self.highs = row["wants"], row["highs"]
        self.bounds = list(row["lows"])  # the least score that still enters
        self.found = [[] for _ in self.wants]
        self.most, self.same, self.vector = most, same, vector
        floats = vector.astype(np.float64)
        self.length = float(np.sqrt((floats**2).sum()))
        unit = floats / (self.length or 1)
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        self.angles = np.arccos(np.clip(unit[self.focus], -1, 1))

    def threshold(self) -> float:
        return min(self.bounds)

    def unreachable(self, bucket: Bucket) -> bool:
        """No vector of the bucket, or of a shorter one, reaches the threshold."""
        reach = self.length * bucket.longest
        return self.threshold() > reach * (1 + _SLACK)

    def candidates(self, bucket: Bucket) -> np.ndarray | None:
        """Rows in the feasible ranges of the focus coordinates; None for most of them."""
        threshold, n = self.threshold(), len(bucket.ids)
        if threshold == _LEAST or not self.length or not bucket.shortest:
            return None
        length = bucket.longest if threshold > 0 else bucket.shortest
        widest = np.arccos(np.clip(threshold / (self.length * length) - _SLACK, -1, 1))
        low = np.cos(np.minimum(np.pi, self.angles + widest)) - _SLACK
        high = np.cos(np.maximum(0, self.angles - widest)) + _SLACK
        starts = [np.searchsorted(bucket.values[f], x) for f, x in zip(self.focus, low)]
        stops = [np.searchsorted(bucket.values[f], x, "right") for f, x in zip(self.focus, high)]
        sizes = np.subtract(stops, starts)
        first = int(np.argmin(sizes))
        if sizes[first] > DENSE * n:
            return None
        rows = bucket.order[self.focus[first], starts[first] : stops[first]]
        for i in np.argsort(sizes)[1:]:
            values = bucket.unit[rows, self.focus[i]]
            rows = rows[(values >= low[i]) & (values <= high[i])]
        return rows

    def offer(self, bucket: Bucket, rows: np.ndarray | None, scores: np.ndarray) -> None:
        """Verified scores of all rows of a bucket, or of some."""
        good = scores >= self.threshold()
        at = np.flatnonzero(good)
        scores, rows = scores[at], at if rows is None else rows[at]
        if self.same:
            own = (bucket.ids[rows] == self.id) & (bucket.keys[rows] == self.key)
            good = (bucket.labels[rows] == self.label) & ~own
        else:
            good = bucket.labels[rows] != self.label
        scores, ids = scores[good], bucket.ids[rows[good]]
        for i, high in enumerate(self.highs):
            fits = np.flatnonzero((scores >= self.bounds[i]) & (scores <= high))
            if len(fits) > self.most:
                least = np.partition(scores[fits], -self.most)[-self.most]
                fits = fits[scores[fits] >= least]
            if not len(fits):
                continue
            both = self.found[i] + list(zip((-scores[fits]).tolist(), ids[fits].tolist()))
            self.found[i] = sorted(both)[: self.most]
            if len(self.found[i]) == self.most:
                self.bounds[i] = -self.found[i][-1][0]


def search_shard(buckets: list[Bucket], anchors: list[Anchor]) -> None:
    """Offer every anchor the rows that can be among its results."""
    for bucket in buckets:
        anchors = [a for a in anchors if not a.unreachable(bucket)]
        whole = []
        for a in anchors:
            rows = a.candidates(bucket)
            if rows is None:
                whole.append(a)
            elif len(rows):
                a.offer(bucket, rows, bucket.vectors[rows] @ a.vector)
        if whole:
            products = np.stack([a.vector for a in whole]) @ bucket.vectors.T
            for a, scores in zip(whole, products):
                a.offer(bucket, None, scores)


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def best_of_shards(
    rows: DataFrame, anchors: DataFrame, keys: list[str], most: int, same: bool, exact: bool = True
) -> DataFrame:
    """The ``most`` best rows of each shard for every wanted range of every anchor, merged.

    ``keys`` are the columns that name a shard, in both tables. ``anchors`` also has
    ``wants`` (names of the ranges), ``lows`` and ``highs``. With ``same`` the rows have
    the anchor's label and are not the anchor itself, else another label. ``exact`` tells
    that all products are exact in doubles; else they are made of Python integers.
    """
    schema = pa.schema([(c.split()[0], pa.int64()) for c in HITS.split(", ")])
    kind = np.float64 if exact else object
    columns = [*keys, *[c for c in ("vec_id", "_key", "label", "vector", "dim") if c not in keys]]
    wanted = ["wants", "lows", "highs"]
    nothing = F.array().cast("array<long>")
    stream = rows.select(
        *columns, *[nothing.alias(c) for c in wanted], F.lit(False).alias("_anchor")
    ).unionByName(anchors.select(*columns, *wanted, F.lit(True).alias("_anchor")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        buckets: list[Bucket] = []
        for batch in batches:
            is_anchor = batch.column("_anchor").to_numpy(zero_copy_only=False)
            cut = int(np.argmax(is_anchor)) if is_anchor.any() else len(is_anchor)
            if cut:
                if buckets or not is_anchor[cut:].all():
                    raise RuntimeError("the rows of a shard must come before its anchors")
                held.append(batch.slice(0, cut))
            asked = batch.slice(cut)
            if not asked.num_rows or not held:
                continue
            dim = asked.column("dim")[0].as_py()
            if not buckets:
                shard = pa.Table.from_batches(held).combine_chunks()
                vectors = _matrix(shard.column("vector").combine_chunks(), dim).astype(kind)
                names = [shard.column(c).to_numpy() for c in ("vec_id", "_key", "label")]
                buckets = list(length_buckets(vectors, *names))
            for start in range(0, asked.num_rows, ANCHORS_TOGETHER):
                part = asked.slice(start, ANCHORS_TOGETHER)
                matrix = _matrix(part.column("vector"), dim).astype(kind)
                info = part.select(["vec_id", "_key", "label", *wanted]).to_pylist()
                group = [Anchor(r, v, most, same) for r, v in zip(info, matrix)]
                search_shard(buckets, group)
                out = [
                    (a.id, a.key, want, vec_id, int(-minus))
                    for a in group
                    for want, found in zip(a.wants, a.found)
                    for minus, vec_id in found
                ]
                if out:
                    arrays = [pa.array(c, pa.int64()) for c in zip(*out)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    shards = rows.select(*keys).distinct().count()
    # A shard is few bytes and much work: a stated number of partitions is not merged.
    dealt = stream.repartition(max(1, 2 * shards), *keys).sortWithinPartitions(*keys, "_anchor")
    hits = dealt.groupBy(*keys).applyInArrow(run, HITS)
    best = Window.partitionBy("anchor_id", "_key", "want").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= most)


def _dealt(rows: DataFrame, by: list[str], cells: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``shard`` among those of their ``by`` columns, and the ``shards``."""
    counts = materialize(
        rows.groupBy(*by).agg(F.ceil(F.sum("dim") / F.lit(cells)).cast("int").alias("shards")),
        "lemp-shards",
    )
    own = F.pmod(F.xxhash64("vec_id", "_key"), F.col("shards")).cast("int")
    return rows.join(counts, by).withColumn("shard", own).drop("shards"), counts


def _in_every(anchors: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """Every anchor for each of the shards of its ``by`` columns."""
    each = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    return anchors.join(counts, by).withColumn("shard", each).drop("shards")


def mine(
    table: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    anchor_every: int = ANCHOR_EVERY,
) -> DataFrame:
    """Hard negatives of each positive of every row whose id is divisible by ``anchor_every``.

    A negative scores at least half and at most 95 % of its positive.
    """
    rows = materialize(integer_vectors(table), "lemp-rows")
    widest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    found = rows.agg(F.sum("dim"), F.max(widest * widest * F.col("dim"))).first()
    total, product = found[0] or 1, found[1] or 0
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = min(SHARD_CELLS, max(LEAST_CELLS, total // tasks))
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    # No product of two rows exceeds the larger of their squares' bounds.
    exact = product * 1.01 < _EXACT

    by = ["dim", "label"]
    dealt, counts = _dealt(rows, by, cells)
    any_score = anchors.withColumns(
        {
            "wants": F.array(F.lit(0).cast("long")),
            "lows": F.array(F.lit(_LEAST)),
            "highs": F.array(F.lit(_MOST)),
        }
    )
    asked = _in_every(any_score, counts, by)
    near = materialize(
        best_of_shards(dealt, asked, [*by, "shard"], positives, True, exact).select(
            "anchor_id",
            "_key",
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "lemp-positives",
    )

    wanted = (
        near.where(F.col("positive_score") >= 0)
        .select(F.col("anchor_id").alias("vec_id"), "_key", "positive_score")
        .distinct()
        .groupBy("vec_id", "_key")
        .agg(F.sort_array(F.collect_list("positive_score")).alias("wants"))
        .withColumn("lows", F.expr("transform(wants, s -> s - s div 2)"))
        .withColumn("highs", F.expr("transform(wants, s -> s - s div 20 - if(s % 20 = 0, 0, 1))"))
    )
    by = ["dim"]
    dealt, counts = _dealt(rows, by, cells)
    asked = _in_every(anchors.join(wanted, ["vec_id", "_key"]), counts, by)
    hits = best_of_shards(dealt, asked, [*by, "shard"], negatives, False, exact).select(
        "anchor_id",
        "_key",
        F.col("want").alias("positive_score"),
        F.col("_n").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return near.join(hits, ["anchor_id", "_key", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
