"""A Merkle manifest of a dataset, its proofs made by a butterfly exchange.

A row's leaf is a digest of its columns. The leaves of a group (a language) ascend by
the order column; every ``FANOUT`` consecutive nodes become the digest of their hex
texts, level by level, until one node is left, the group's subtree root. The roots,
ordered by group, make the root of the dataset in the same way.

Leaves are numbered within their group by a stored range sort and dealt to aligned
partitions of ``FANOUT ** BLOCK_LEVELS`` leaves, each of which hashes its own
subtree. Then partitions swap roots round by round: in round r those of a run of
``FANOUT`` subtrees that differ in one base-``FANOUT`` digit of their number meet,
every one of them hashes the common ancestor itself and notes the siblings it saw. So
each partition ends with the whole upper part of its proofs and nothing is sent down
again. The members of a subtree with fewer partitions than its siblings stand in for
the missing ones in turn. The groups' roots are swapped in the same way.

An exchange holds at most ``FANOUT`` rows a group, a task one partition's leaves; texts are
hashed where they are read and never moved. A group or an id that holds a third of
all rows is many partitions like any other.

Cases: a null column counts as ``-``; null ids and the null group come first. Rows
with one id follow each other by leaf, repeated rows are leaves each, with equal
digests and proofs of their own places. An empty table gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.keys import dense_key
from skyledger.operators.skew import lookup_join
from skyledger.sources.scratch import materialize

FANOUT = 8
BLOCK_LEVELS = 4
ROWS_PER_RANGE = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Texts of documents whose id has a checksum divisible by this are tampered with.
TAMPERED_EVERY = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value as it enters a digest: its UTF-8 length and itself, or ``-`` for null."""
    text = value.cast("string")
    framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(text.isNull(), F.lit("-")).otherwise(framed)


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one after another, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(
    table: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    tampered: Column | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Stored leaves in their places: ``_group``, ``block``, ``slot``, ``size``, digests.

    ``tampered`` is what became of the column ``text`` in the copy that is verified;
    where it is null or unchanged the copy's leaf is null.
    """
    parts = {c: field(F.col(f"`{c}`")) for c in fields}
    changed = F.lit(None).cast("binary")
    if tampered is not None:
        copy = {**parts, "text": field(tampered)}
        differs = tampered.isNotNull() & (tampered != F.col("text"))
        changed = F.when(differs, digest(*[copy[c] for c in fields]))
    key = F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit(":"), F.col(group)))
    hashed = materialize(
        table.select(
            key.alias("_group"),
            F.col(order).cast("long").alias("doc_id"),
            digest(*[parts[c] for c in fields]).alias("leaf"),
            changed.alias("copy"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "tree-leaves",
    )
    # The row number keeps repeated rows apart, so that no range outgrows a task.
    by = ["_group", "doc_id", "leaf", "_row"]
    shuffles = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(shuffles, math.ceil(hashed.count() / ROWS_PER_RANGE))
    ranked = materialize(
        hashed.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .drop("_row")
        .withColumn("_at", F.monotonically_increasing_id()),
        "tree-ranked",
    ).withColumn("_range", F.shiftright("_at", 33))
    runs = ranked.groupBy("_group", "_range").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    earlier = Window.partitionBy("_group").orderBy("_range")
    all_ = Window.partitionBy("_group")
    starts = materialize(
        runs.select(
            "_group",
            "_range",
            (
                F.coalesce(
                    F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0),
                )
                - F.col("_first")
            ).alias("_shift"),
            F.sum("_n").over(all_).alias("size"),
        ),
        "tree-starts",
    )
    at = F.col("_at") + F.col("_shift")
    block = FANOUT**block_levels
    return lookup_join(ranked, starts, ["_group", "_range"], "inner").select(
        "_group",
        F.floor(at / block).cast("long").alias("block"),
        F.pmod(at, F.lit(block)).cast("int").alias("slot"),
        "size",
        "doc_id",
        "leaf",
        "copy",
    )


def _parents(nodes: list[str]) -> list[str]:
    """One level up: the digest of every run of nodes."""
    return [
        sha256("".join(nodes[i : i + FANOUT]).encode()).hexdigest()
        for i in range(0, len(nodes), FANOUT)
    ]


def _levels(table: pa.Table, block_levels: int) -> tuple[pa.Table, list[list[str]]]:
    """A partition's leaves in order, and the levels of its subtree with the root last.

    A partition of several goes up all ``block_levels``, also where a run is one node.
    """
    table = table.sort_by("slot")
    levels = [[x.hex() for x in table.column("leaf").to_pylist()]]
    several = table.column("size")[0].as_py() > FANOUT**block_levels
    while len(levels[-1]) > 1 or (several and len(levels) <= block_levels):
        levels.append(_parents(levels[-1]))
    return table, levels


def _subtree_roots(placed: DataFrame, block_levels: int) -> DataFrame:
    """One row for each aligned partition: its number, the group's partitions, its root."""

    def root(table: pa.Table) -> pa.Table:
        head = {c: [table.column(c)[0].as_py()] for c in ("_group", "block", "size")}
        return pa.table({**head, "root": [_levels(table, block_levels)[1][-1][0]]})

    groups = placed.select("_group", "block", "slot", "size", "leaf")
    roots = groups.groupBy("_group", "block").applyInArrow(
        root, "_group string, block long, size long, root string"
    )
    blocks = F.ceil(F.col("size") / FANOUT**block_levels).cast("long")
    return roots.withColumn("blocks", blocks).drop("size")


def _swap(members: DataFrame) -> DataFrame:
    """One round: every member learns its node's siblings and hashes the parent.

    ``tree`` and ``node`` name the subtree that a member belongs to, ``slot`` the member
    among the ``slots`` of its subtree, ``most`` the most slots of a subtree in the run.
    """
    carried = [c for c in members.columns if c not in ("root", "before", "after")]
    sent = members.withColumn(
        "_meet", F.explode(F.sequence("slot", F.col("most") - 1, F.col("slots")))
    )
    own = F.struct(*carried, "before", "after")
    met = sent.groupBy("tree", F.floor(F.col("node") / FANOUT).alias("_run"), "_meet").agg(
        F.array_sort(F.collect_list(F.struct("node", "root"))).alias("_all"),
        F.collect_list(F.when(F.col("_meet") == F.col("slot"), own)).alias("_own"),
    )
    one = met.select("_all", F.explode("_own").alias("m"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("_all", keep), lambda x: x["root"]), "")

    node = F.col("m.node")
    return one.select(
        *[F.col(f"m.{c}") for c in carried],
        F.sha2(joined(lambda x: F.lit(True)), 256).alias("root"),
        F.concat("m.before", F.array(joined(lambda x: x["node"] < node))).alias("before"),
        F.concat("m.after", F.array(joined(lambda x: x["node"] > node))).alias("after"),
    )


def _rounds(nodes: int) -> int:
    """Levels above ``nodes`` nodes."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def _group_rounds(members: DataFrame, most_blocks: int) -> DataFrame:
    """Swap roots within the groups; a group that has one root left waits."""
    done = []
    for r in range(_rounds(most_blocks)):
        span = FANOUT**r
        waiting = F.col("blocks") <= span
        done.append(members.where(waiting))
        node = F.floor(F.col("block") / span)
        first = F.floor(F.col("block") / (span * FANOUT)) * FANOUT
        left = F.col("blocks")
        swapped = _swap(
            members.where(~waiting)
            .withColumn("tree", F.col("_group"))
            .withColumn("node", node)
            .withColumn("slot", F.col("block") % span)
            .withColumn("slots", F.least(F.lit(span), left - node * span))
            .withColumn("most", F.least(F.lit(span), left - first * span))
        )
        # Read twice, by those that wait and by those that go on.
        members = materialize(swapped.drop("tree", "node", "slot", "slots", "most"), "tree-round")
    return reduce(DataFrame.unionByName, done, members)


def _dataset_rounds(members: DataFrame, sizes: DataFrame, groups: int) -> DataFrame:
    """Swap the groups' roots, among all their partitions."""
    ranks = dense_key(sizes, ["_group"], "_rank")
    nodes = ranks.select((F.col("_rank") - 1).alias("node"), F.col("blocks").alias("slots"))
    ranks = ranks.select("_group", (F.col("_rank") - 1).alias("node"))
    members = lookup_join(members, materialize(ranks, "tree-groups"), ["_group"], "inner")
    members = members.withColumn("slot", F.col("block")).withColumn("tree", F.lit(""))
    for _ in range(_rounds(groups)):
        run = Window.partitionBy(F.floor(F.col("node") / FANOUT))
        earlier = run.orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        nodes = materialize(
            nodes.select(
                "node",
                "slots",
                F.max("slots").over(run).alias("most"),
                F.coalesce(F.sum("slots").over(earlier), F.lit(0)).alias("_offset"),
            ),
            "tree-nodes",
        )
        members = (
            _swap(lookup_join(members, nodes, ["node"], "inner"))
            .withColumn("slot", F.col("slot") + F.col("_offset"))
            .withColumn("node", F.floor(F.col("node") / FANOUT))
            .drop("slots", "most", "_offset")
        )
        nodes = nodes.groupBy(F.floor(F.col("node") / FANOUT).alias("node")).agg(
            F.sum("slots").alias("slots")
        )
    return members


def upper_proofs(placed: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``subroot``, ``root`` and the siblings above it for every aligned partition."""
    nothing = F.array().cast("array<string>")
    members = materialize(
        _subtree_roots(placed, block_levels)
        .withColumn("before", nothing)
        .withColumn("after", nothing),
        "tree-blocks",
    )
    sizes = materialize(members.groupBy("_group").agg(F.max("blocks").alias("blocks")), "tree-sizes")
    found = sizes.agg(F.max("blocks").alias("most"), F.count("*").alias("groups")).first()
    members = materialize(_group_rounds(members, found.most or 0), "tree-subroots")
    members = members.withColumn("subroot", F.col("root"))
    return materialize(
        _dataset_rounds(members, sizes, found.groups).select(
            "_group", "block", "subroot", "root", "before", "after"
        ),
        "tree-proofs",
    )


PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean, before array<string>, after array<string>"
)


def proofs(
    placed: DataFrame, siblings: bool = True, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """One row per leaf: its proof, and the root folded from the copy's leaf with it.

    ``before`` and ``after`` hold the siblings on both sides, a text for each level
    from the leaf up; without ``siblings`` only their digest is returned.
    """
    upper = upper_proofs(placed, block_levels)

    def prove(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, levels = _levels(rows, block_levels)
        (over,) = above.to_pylist()
        over_text = "".join(b + a for b, a in zip(over["before"], over["after"]))
        copies = rows.column("copy").to_pylist()
        proof, folded, all_before, all_after = [], [], [], []
        for i, leaf in enumerate(levels[0]):
            before, after, at = [], [], i
            for level in levels[:-1]:
                start = at // FANOUT * FANOUT
                before.append("".join(level[start:at]))
                after.append("".join(level[at + 1 : start + FANOUT]))
                at //= FANOUT
            own = "".join(map(str.__add__, before, after))
            proof.append(sha256((own + over_text).encode()).hexdigest())
            before += over["before"]
            after += over["after"]
            node = copies[i].hex() if copies[i] is not None else leaf
            for left, right in zip(before, after):
                node = sha256((left + node + right).encode()).hexdigest()
            folded.append(node)
            if siblings:
                all_before.append(before)
                all_after.append(after)
        n = len(folded)
        columns = {
            "doc_id": rows.column("doc_id"),
            "leaf": levels[0],
            "subroot": [over["subroot"]] * n,
            "root": [over["root"]] * n,
            "proof_sha256": proof,
            "folded_root": folded,
            "verified": [x == over["root"] for x in folded],
        }
        if siblings:
            columns |= {"before": all_before, "after": all_after}
        return pa.table(columns)

    schema = PROOFS if siblings else PROOFS.split(", before")[0]
    keys = ("_group", "block")
    return placed.groupBy(*keys).cogroup(upper.groupBy(*keys)).applyInArrow(prove, schema)


def tampered_texts(every: int = TAMPERED_EVERY) -> Column:
    """The text with A-Z in lower case where the id's checksum is divisible by ``every``."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    lowered = F.translate(F.col("text"), _UPPER, _LOWER)
    return F.when(hit, lowered).otherwise(F.col("text"))


def verify_tampered(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Digests of all proofs of ``documents``, and whether a tampered copy passes them."""
    placed = leaves(docs, tampered=tampered_texts(), block_levels=block_levels)
    return proofs(placed, siblings=False, block_levels=block_levels)
