"""MinHash near-dedup with HyperMinHash registers.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles
is at least ``PERCENT``; linked documents form a component, of which the one with the
smallest id is kept.

1. One pass stores each document with its set's size and digest and its registers: a
   leading-zero count and ten mantissa bits for the least hash in each of 160 buckets.
   Documents with equal sets are one node from here on, so copies cost nothing more.
2. The registers are cut into 32 bands of 5. Nodes that agree in a band share a bucket.
   Two nodes at 0.85 share none with a probability of 1e-8.
3. Every node is compared with the least node of each of its buckets: first by the
   similarity that the registers tell, corrected for chance collisions, then, unless
   that is ``MARGIN`` (six standard deviations) too low, on the full sets.
4. Buckets whose nodes are not all connected by then are compared in full, in blocks
   of bounded size: a large bucket is cut into blocks and each pair of blocks is a
   group of its own, in which nodes of one component are not compared again. Only
   links leave a group, never pairs.
5. Components of all links are found by label propagation on stored tables.

A third of all rows in one group of copies is one node; in one group of near copies it
is a bucket whose join is split by the adaptive planner and whose blocks are spread
over tasks. No step collects rows to the driver.

Cases: a null or empty text, or one without words, has no shingles and is linked with
nothing. Fewer than five words are one shingle. Rows that repeat an id are rows each,
equal texts among them one node. A null id is above all others. A column named like a
result is replaced, others are kept as asked; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.llm import shingles as sh
from skyledger.llm.arrow import map_slices, text_udf, without
from skyledger.llm.components import components
from skyledger.sources.scratch import materialize

PERCENT = 85
#: What an estimate may fall short: 6 * sqrt(0.85 * 0.15 / 160).
MARGIN = 0.17
#: Nodes and shingles in a block of a large bucket.
BLOCK_NODES = 512
BLOCK_SHINGLES = 400_000
_SETS_KEPT = 64


SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("c1", T.LongType()),
        T.StructField("c2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("registers", T.BinaryType()),
    ]
)


def sketched(docs: DataFrame) -> DataFrame:
    """All columns and ``_row``, ``_n``, ``_c1``, ``_c2`` (a digest), ``_bands``, ``_registers``."""

    def make():
        of = sh.Shingler()

        def sketch(text):
            found = of.shingles(text)
            digest = blake2b(found.tobytes(), digest_size=16).digest()
            registers = sh.registers(found) if len(found) else None
            return {
                "n": len(found),
                "c1": int.from_bytes(digest[:8], "little", signed=True),
                "c2": int.from_bytes(digest[8:], "little", signed=True),
                "bands": None if registers is None else sh.bands(registers).tolist(),
                "registers": None if registers is None else registers.tobytes(),
            }

        return lambda found: pa.array(map(sketch, found), to_arrow_type(SKETCH))

    out = docs.withColumn("_sketch", text_udf(make, SKETCH)("text"))
    return out.select(
        *[f"`{c}`" for c in docs.columns],
        *[F.col(f"_sketch.{f}").alias(f"_{f}") for f in SKETCH.names],
        F.monotonically_increasing_id().alias("_row"),
    )


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, sh.REGISTERS)


def _likely(a, b, n, m, percent: int) -> np.ndarray:
    """Whether sizes and registers leave a chance of being similar enough."""
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return fits & (sh.estimate(a, b, n, m) >= percent / 100 - MARGIN)


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that registers do not rule out."""
    side = lambda x: nodes.select(
        F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, x, y = (batch.column(c) for c in ("a", "b", "n_a", "n_b", "r_a", "r_b"))
            if batch.num_rows:
                keep = _likely(
                    _matrix(x.to_pylist()), _matrix(y.to_pylist()), n.to_numpy(), m.to_numpy(), percent
                )
                out = pa.RecordBatch.from_arrays([a, b], names=["a", "b"])
                yield out.filter(pa.array(keep))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, stored: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    side = lambda x: stored.select(
        F.col("_row").alias(x), F.col("text").alias(f"t_{x}")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def make():
        of, sets = sh.Shingler(), {}

        def get(node, text):
            if node not in sets:
                if len(sets) >= _SETS_KEPT:
                    sets.clear()
                sets[node] = of.shingles(text)
            return sets[node]

        def apply(part):
            found = [
                (a, b)
                for a, b, s, t in zip(
                    *(part.column(c).to_pylist() for c in ("a", "b", "t_a", "t_b"))
                )
                if sh.similar(get(a, s), get(b, t), percent)
            ]
            if found:
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], schema=schema
                )
            return None

        return apply

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return map_slices(joined.select("a", "b", "t_a", "t_b"), make, "a long, b long", "t_a")


def _within_blocks(percent: int):
    """A function that links the nodes of a group of one block, or of two with each other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, n, block = (table.column(c).to_numpy() for c in ("node", "n", "block"))
        group = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        registers = _matrix(table.column("registers").to_pylist())
        text = table.column("text")
        of, sets = sh.Shingler(), {}

        def get(i):
            if i not in sets:
                sets[i] = of.shingles(text[i].as_py())
            return sets[i]

        two = block.min() != block.max()
        links = []
        for i in range(len(node) - 1):
            rest = np.arange(i + 1, len(node))
            rest = rest[group[rest] != group[i]]
            if two:
                rest = rest[block[rest] != block[i]]
            size = np.full(len(rest), n[i])
            near = _likely(registers[i][None, :], registers[rest], size, n[rest], percent)
            for j in rest[near].tolist():
                if group[j] != group[i] and sh.similar(get(i), get(j), percent):
                    links.append((node[i], node[j]))
                    group[group == group[j]] = group[i]
        columns = zip(*links) if links else ([], [])
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def _links_in_blocks(
    members: DataFrame, nodes: DataFrame, stored: DataFrame, known: DataFrame, percent: int
) -> DataFrame:
    """Links between nodes of a bucket that other links do not connect."""
    labelled = (
        members.join(known, "node", "left")
        .join(nodes.select("node", "n"), "node")
        .withColumn("component", F.coalesce("component", "node"))
    )
    # The least node of a bucket was compared with all others.
    other = F.col("node") != F.col("pivot")
    buckets = (
        labelled.groupBy("band", "key")
        .agg(
            F.min(F.when(other, F.col("component"))).alias("_first"),
            F.max(F.when(other, F.col("component"))).alias("_last"),
            F.count("*").alias("_size"),
            F.sum("n").alias("_shingles"),
            F.bit_xor(F.xxhash64("node")).alias("_x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y"),
        )
        .where("_first < _last")
    )
    # Bands often hold the same nodes; one bucket of them is enough.
    chosen = buckets.groupBy("_x", "_y", "_size").agg(
        F.min(F.struct("band", "key", "_shingles")).alias("_bucket")
    )
    chosen = chosen.select(
        F.col("_bucket.band").alias("band"),
        F.col("_bucket.key").alias("key"),
        F.greatest(
            F.lit(1),
            F.ceil(F.col("_size") / BLOCK_NODES),
            F.ceil(F.col("_bucket._shingles") / BLOCK_SHINGLES),
        )
        .cast("int")
        .alias("blocks"),
    )
    chosen = materialize(chosen, "open-buckets")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = materialize(
        labelled.join(chosen, ["band", "key"]).select(
            "band", "key", "node", "component", own.alias("block"), "blocks"
        ),
        "open-members",
    )
    dealt = placed.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_other")
    ).select(
        "band",
        "key",
        F.least("block", "_other").alias("i"),
        F.greatest("block", "_other").alias("j"),
        "node",
        "component",
        "block",
    )
    with_sets = dealt.join(nodes.select("node", "n", "registers"), "node").join(
        stored.select(F.col("_row").alias("node"), "text"), "node"
    )
    return with_sets.groupBy("band", "key", "i", "j").applyInArrow(
        _within_blocks(percent), "a long, b long"
    )


def find_links(stored: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all similar nodes, of sketched and stored rows."""
    nodes = materialize(
        stored.select(
            F.col("_row").alias("node"),
            F.col("_n").alias("n"),
            F.col("_bands").alias("bands"),
            F.col("_registers").alias("registers"),
        ).join(classes.select("node"), "node"),
        "nodes",
    )
    exploded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    pivots = materialize(
        exploded.groupBy("band", "key")
        .agg(F.min("node").alias("pivot"), F.count("*").alias("_size"))
        .where("_size > 1")
        .drop("_size"),
        "pivots",
    )
    members = materialize(exploded.join(pivots, ["band", "key"]), "members")
    pairs = (
        members.where("node != pivot")
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    likely = materialize(_estimated(pairs, nodes, percent), "likely-pairs")
    first = materialize(_confirmed(likely, stored, percent), "links-to-pivots")
    known = components(first)
    more = _links_in_blocks(members, nodes, stored, known, percent)
    return materialize(first.unionByName(more), "all-links")


def near_duplicates(
    docs: DataFrame, keep: list[str] | None = None, percent: int = PERCENT
) -> DataFrame:
    """Columns ``keep`` (all, if not given), ``n_shingles``, ``component_id``, ``kept``.

    ``representative`` is true for one row of each component, of those with its id.
    """
    results = "n_shingles", "component_id", "kept", "representative"
    docs = without(docs, *results)
    keep = docs.columns if keep is None else keep
    read = list(dict.fromkeys([*keep, "doc_id", "text"]))
    stored = materialize(
        sketched(docs.select(*[f"`{c}`" for c in read])), "sketches", compression="zstd"
    )
    classes = materialize(
        stored.where("_n > 0")
        .groupBy("_c1", "_c2")
        .agg(F.min("_row").alias("node"), F.min("doc_id").alias("_least")),
        "classes",
    )
    links = find_links(stored, classes, percent)
    # Stored, as both sides of the joins on a component, so that a hot one is split.
    labelled = materialize(
        classes.join(components(links), "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        ),
        "labelled-sets",
    )
    least = materialize(
        labelled.groupBy("component").agg(F.min("_least").alias("component_id")), "least-ids"
    )
    by_set = labelled.join(least, "component").select("_c1", "_c2", "component", "component_id")
    rows = materialize(
        stored.select("_row", "doc_id", "_n", "_c1", "_c2")
        .join(by_set, ["_c1", "_c2"], "left")
        .select(
            "_row",
            F.col("_n").alias("n_shingles"),
            "component",
            F.when(F.col("component").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
            F.col("doc_id").alias("_id"),
        )
        .withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id"))),
        "components",
    )
    firsts = materialize(
        rows.where("kept and component is not null")
        .groupBy("component")
        .agg(F.min("_row").alias("_first")),
        "first-rows",
    )
    marked = rows.join(firsts, "component", "left").select(
        "_row",
        "n_shingles",
        "component_id",
        "kept",
        (F.col("component").isNull() | (F.col("_row") == F.col("_first"))).alias(
            "representative"
        ),
    )
    return stored.select("_row", *[f"`{c}`" for c in keep]).join(marked, "_row").drop("_row")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group of near duplicates."""
    return near_duplicates(docs).where("representative").select(*docs.columns)
