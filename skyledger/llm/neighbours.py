"""Approximate nearest neighbours by inner product: one HNSW graph per shard.

Equal vectors are one node, with the ``k`` + 1 smallest ids that carry them; more can
never be among the ``k`` nearest of a query. Nodes are dealt to shards by a hash of the
vector, a graph is built for each shard and stored as flat arrays, one row per shard.
A task opens a shard once and all queries of its dimension stream past it in batches;
each shard gives its nearest by the exact product in double precision, and the results
are merged.

Every row is indexed; nothing is sampled. Shards have about ``SHARD_NODES`` nodes, more
in a large table (there are no more shards than shuffle partitions) up to
``MOST_NODES``. A task holds one shard's arrays and one batch of queries; a shard is
moved once. A vector that a third of all rows
share reaches the shuffle as at most ``k`` + 1 ids per task.

Cases: vectors that are null, empty, all zero or hold a null or non-finite component
take no part, nor do rows without an id. Vectors of other dimensions are no candidates
of a query. A row that is repeated counts once; an id with several vectors is a query
for each. If there are fewer than ``k`` candidates all are returned; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import hnsw
from skyledger.sources.scratch import materialize

K = 20
SHARD_NODES, MOST_NODES = 8192, 65536
TASKS_PER_SHARD = 4
QUERY_EVERY = 20

INDEX = (
    "dim int, shard int, vectors binary, ids binary, id_counts binary, "
    "nodes array<binary>, links array<binary>"
)
HITS = "query_id long, _query long, vec_id long, score double"


def usable(table: DataFrame) -> DataFrame:
    """Distinct ``vec_id``, ``embedding`` (doubles) and ``dim`` of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return (
        table.select(
            F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
        )
        .where(F.col("vec_id").isNotNull() & v.isNotNull())
        .where(finite & F.exists(v, lambda x: x != 0))
        .distinct()
        .withColumn("dim", F.size(v))
    )


def build_index(vectors: DataFrame, k: int = K) -> DataFrame:
    """A stored row of flat arrays for each shard of each dimension."""
    first = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = materialize(
        vectors.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k + 1)
        .groupBy("dim", "embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "ann-nodes",
    )
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(max(SHARD_NODES, nodes.count() // tasks), max(SHARD_NODES, MOST_NODES))
    shards = nodes.groupBy("dim").agg(
        F.ceil(F.count("*") / F.lit(size)).cast("int").alias("shards")
    )
    dealt = nodes.join(shards, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int")
    )
    schema = pa.schema(
        [
            ("dim", pa.int32()),
            ("shard", pa.int32()),
            ("vectors", pa.binary()),
            ("ids", pa.binary()),
            ("id_counts", pa.binary()),
            ("nodes", pa.list_(pa.binary())),
            ("links", pa.list_(pa.binary())),
        ]
    )

    def build(table: pa.Table) -> pa.Table:
        dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        vectors = _matrix(table.column("embedding"), dim)
        ids = table.column("ids").combine_chunks()
        order = np.lexsort(vectors.T[::-1])  # the same graph on every run
        vectors = vectors[order]
        lists = ids.take(pa.array(order))
        graph = hnsw.Graph.build(vectors)
        row = [
            [dim],
            [shard],
            [vectors.tobytes()],
            [lists.flatten().to_numpy().tobytes()],
            [np.diff(lists.offsets.to_numpy()).astype(np.int64).tobytes()],
            [[x.nodes.astype(np.int32).tobytes() for x in graph.levels]],
            [[x.links[x.nodes].tobytes() for x in graph.levels]],
        ]
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema
        )

    # A shard is few bytes and much work: a stated number of partitions is not merged.
    total = shards.agg(F.sum("shards")).first()[0] or 1
    spread = dealt.select("dim", "shard", "embedding", "ids").repartition(
        TASKS_PER_SHARD * total, "dim", "shard"
    )
    built = spread.groupBy("dim", "shard")
    return materialize(built.applyInArrow(build, INDEX), "ann-index")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _opened(index: pa.Table):
    """The graph of a shard, its vectors, and the ids of each node."""
    row = {c: index.column(c)[0].as_py() for c in index.column_names}
    vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    graph = hnsw.Graph(hnsw.same_length(vectors))
    for nodes, links in zip(row["nodes"], row["links"]):
        at = np.frombuffer(nodes, np.int32)
        table = np.frombuffer(links, np.int32).reshape(len(at), -1)
        spread = np.full((len(vectors), table.shape[1]), -1, dtype=np.int32)
        spread[at] = table
        graph.levels.append(hnsw.Level(at.astype(np.int64), spread))
    counts = np.frombuffer(row["id_counts"], np.int64)
    return graph, vectors, np.frombuffer(row["ids"], np.int64), counts


def search(
    index: DataFrame, queries: DataFrame, k: int = K, ef: int = hnsw.SEARCH_EF
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest of each query.

    ``queries`` has the columns of ``usable``.
    """
    sizes = index.groupBy("dim").agg(F.count("*").cast("int").alias("_shards"))
    asked = queries.withColumn("_query", F.xxhash64("embedding")).join(sizes, "dim")
    every = F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)).alias("shard")
    arrays = [c for c in index.columns if c not in ("dim", "shard")]
    stream = index.select(
        *index.columns,
        F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("long").alias("_query"),
        F.lit(None).cast("array<double>").alias("embedding"),
    ).unionByName(
        asked.select("dim", every, "vec_id", "_query", "embedding"), allowMissingColumns=True
    )
    schema = pa.schema(
        [
            ("query_id", pa.int64()),
            ("_query", pa.int64()),
            ("vec_id", pa.int64()),
            ("score", pa.float64()),
        ]
    )

    def answer(opened, asked: pa.RecordBatch) -> pa.RecordBatch:
        graph, vectors, ids, counts = opened
        ends = np.cumsum(counts)
        wanted = _matrix(asked.column("embedding"), vectors.shape[1])
        query_ids = asked.column("vec_id").to_numpy()
        keys = asked.column("_query").to_numpy()
        near = graph.search(wanted, ef)
        out = []
        for i in range(len(wanted)):
            found = np.unique(near[i][near[i] >= 0])
            # One product for all, so that equal vectors have equal scores.
            score = (vectors[found] * wanted[i]).sum(axis=1)
            best = found[np.argsort(-score, kind="stable")[: k + 1]]
            found_ids = np.concatenate([ids[ends[x] - counts[x] : ends[x]] for x in best])
            scores = np.repeat(np.sort(score)[::-1][: k + 1], counts[best])
            other = found_ids != query_ids[i]
            found_ids, scores = found_ids[other], scores[other]
            top = np.lexsort((found_ids, -scores))[:k]
            n = len(top)
            out.append((np.full(n, query_ids[i]), np.full(n, keys[i]), found_ids[top], scores[top]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None
        for batch in batches:
            if batch.column("vectors").null_count < batch.num_rows:
                first = batch.slice(0, 1)
                if opened is not None or first.column("vectors").null_count:
                    raise RuntimeError("a shard must come before its queries")
                opened = _opened(pa.Table.from_batches([first]))
                batch = batch.slice(1)
            for at in range(0, batch.num_rows, hnsw.TOGETHER):
                yield answer(opened, batch.slice(at, hnsw.TOGETHER))

    # The row of the shard sorts before those of the queries.
    total = index.count() or 1
    dealt = stream.select("dim", "shard", *arrays, "vec_id", "_query", "embedding")
    dealt = dealt.repartition(TASKS_PER_SHARD * total, "dim", "shard").sortWithinPartitions(
        "dim", "shard", F.col("vec_id").asc_nulls_first()
    )
    hits = dealt.groupBy("dim", "shard").applyInArrow(run, HITS)
    nearest = Window.partitionBy("query_id", "_query").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_of_every(table: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """The nearest of all rows whose id is divisible by ``every``, among all other rows."""
    vectors = usable(table)
    queries = vectors.where(F.col("vec_id") % every == 0)
    return search(build_index(vectors, k), queries, k)
