"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon keeps the terms whose inverse document frequency lies in a band. The
distinct lexicon terms of a document are sorted and hashed: once as a whole, and once
for each of ``len(RATES)`` random subsets of the lexicon. A subset keeps each term
with its own probability, a power of one half, so that texts of any length meet
subsets in which only a term or two of theirs is left; two fingerprints are as alike
as the share of subsets, of those that hold a term of either, with equal hashes.

Scale: document frequencies are counted per task and then summed. The band is
relative to the number of documents, so the lexicon has at most (mean distinct terms
of a document) / ``MIN_SHARE`` terms whatever the number of documents; only it is
sent to all tasks. A document with fewer than ``MIN_TERMS`` lexicon terms (short
texts) uses all its terms.

Cases: a null text is empty; an empty text has a fingerprint of its own that equals
that of all other empty texts. Equal texts have equal fingerprints. Repeated rows give
a row each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.arrow import map_slices, slices, texts

MIN_SHARE, MAX_SHARE = 0.001, 0.05
MIN_TERMS = 3
SUBSETS_PER_RATE = 8
RATES = np.repeat(np.arange(1, 13, dtype=np.uint64), SUBSETS_PER_RATE)
EMPTY = "----"
#: Terms a task counts before it passes its counts on.
COUNTED = 300_000
#: Neighbour buckets for each shuffle partition, so that partitions are even.
BUCKETS_PER_PARTITION = 4


def terms(text: str) -> set[str]:
    return set(text.lower().split())


def term_hash(term: str) -> int:
    return int.from_bytes(blake2b(term.encode(), digest_size=8).digest(), "little")


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term``, ``n``: in how many rows a term occurs."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush():
            out = pa.RecordBatch.from_pydict(
                {"term": list(counts), "n": list(counts.values())},
                schema=pa.schema([("term", pa.string()), ("n", pa.int64())]),
            )
            counts.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                for text in texts(part, "text"):
                    counts.update(terms(text))
                if len(counts) >= COUNTED:
                    yield flush()
        if counts:
            yield flush()

    partial = docs.select("text").mapInArrow(count, "term string, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(
    docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE
) -> list[str]:
    """The terms in the band, of a size bounded by the mean text, not by the table."""
    total = docs.count()
    band = F.col("n").between(min_share * total, max_share * total)
    return [r.term for r in document_frequencies(docs).where(band).select("term").collect()]


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEEDS = _mixed(np.arange(1, len(RATES) + 1, dtype=np.uint64) << np.uint64(32))


class Fingerprinter:
    """Fingerprints of texts under one lexicon."""

    def __init__(self, words: Iterable[str]):
        self.hashes = {w: term_hash(w) for w in words}

    def of(self, text: str) -> str:
        """The hash of all terms, then four hex digits for each subset."""
        found = terms(text)
        kept = sorted(t for t in found if t in self.hashes)
        if len(kept) < MIN_TERMS:
            kept = sorted(found)
        hashes = self.hashes
        h = np.array([hashes.get(t) or term_hash(t) for t in kept], dtype=np.uint64)
        whole = blake2b(h.tobytes(), digest_size=8).hexdigest()
        parts = [EMPTY] * len(RATES)
        if len(h):
            drawn = _mixed(h[None, :] ^ SEEDS[:, None]) >> (np.uint64(64) - RATES)[:, None]
            subset, place = np.nonzero(drawn == 0)
            data, ends = h[place].tobytes(), np.searchsorted(subset, np.arange(len(RATES) + 1))
            for k in np.unique(subset).tolist():
                chosen = data[8 * ends[k] : 8 * ends[k + 1]]
                parts[k] = blake2b(chosen, digest_size=2).hexdigest()
        return whole + ":" + "".join(parts)


def likeness(a: str, b: str) -> float:
    """0 to 1: the share of subsets with equal hashes."""
    if a == b:
        return 1.0
    x, y = (np.array([f[i : i + 4] for i in range(17, len(f), 4)]) for f in (a, b))
    held = (x != EMPTY) | (y != EMPTY)
    return float(np.mean(x[held] == y[held])) if held.any() else 0.0


def fingerprints(docs: DataFrame, words: Iterable[str] | None = None) -> DataFrame:
    """``doc_id``, ``n_chars``, ``fingerprint`` of every row."""
    words = lexicon(docs) if words is None else words
    shared = docs.sparkSession.sparkContext.broadcast(list(words))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())]
    )

    def make():
        of = Fingerprinter(shared.value).of

        def apply(part):
            own = texts(part)
            return pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t) for t in own], pa.int64()),
                    pa.array([of(t) for t in own], pa.string()),
                ],
                schema=schema,
            )

        return apply

    source = docs.select(F.col("doc_id").cast("long"), "text")
    return map_slices(source, make, "doc_id long, n_chars long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Each row's ``text`` beside ``next_text``, of the next lower ``doc_id``; both zstd.

    After the lowest comes the highest; equal ids are ordered by text. Rows are dealt
    into ranges of ``doc_id``, and the first rows of a range also go to the range
    before it, so one shuffle of compressed texts is all that moves.
    """
    spark = docs.sparkSession

    def make():
        pack = zstandard.ZstdCompressor(level=3).compress
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])

        def apply(part):
            packed = [pack(t.encode()) for t in texts(part)]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(packed, pa.binary())], schema=schema
            )

        return apply

    source = docs.select(F.col("doc_id").cast("long"), "text")
    # Ranges follow from the ids alone. Null ids come last, as the lowest.
    ids = source.select(F.col("doc_id").cast("double").alias("_at"))
    n = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.na.drop().approxQuantile("_at", [i / n for i in range(1, n)], 0.1 / n)
    splits = [-float("inf"), *sorted({0.0, *cuts}), float("inf")]
    deal = Bucketizer(splits=splits, inputCol="_at", outputCol="_range", handleInvalid="keep")

    def ranged(df):
        at = F.col("doc_id").cast("double")
        dealt = deal.transform(df.withColumn("_at", at)).drop("_at")
        return dealt.withColumn("_range", F.when(F.col("doc_id").isNull(), -1.0).otherwise(F.col("_range")))

    tops = sorted(
        ranged(source.select("doc_id")).groupBy("_range").agg(F.max("doc_id")).collect(),
        reverse=True,
    )
    # One row for each range: the highest id of it and the range it follows.
    follows = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]
    halo = spark.createDataFrame(follows, "_top long, _before double")
    rows = ranged(map_slices(source, make, "doc_id long, text binary"))
    dealt = rows.join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("_top")), "left").select(
        "doc_id",
        "text",
        F.explode(
            F.when(
                F.col("_before").isNull(), F.array(F.struct(F.lit(False).alias("copy"), "_range"))
            ).otherwise(
                F.array(
                    F.struct(F.lit(False).alias("copy"), "_range"),
                    F.struct(F.lit(True).alias("copy"), F.col("_before").alias("_range")),
                )
            )
        ).alias("_to"),
    )
    order = Window.partitionBy("_to._range").orderBy(
        "_to.copy", F.col("doc_id").desc_nulls_last(), "text"
    )
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .where(~F.col("_to.copy"))
        .select("doc_id", "text", "next_text")
    )


def edited(text: str, following: str) -> str:
    """The second half gives way to the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, its edited form and their likeness; see ``edited``."""
    words = docs.sparkSession.sparkContext.broadcast(lexicon(docs))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )

    def make():
        of = Fingerprinter(words.value).of
        unpack = zstandard.ZstdDecompressor().decompress
        last = ("", of(""))  # rows come in order: the next text is soon the own one

        def apply(part):
            nonlocal last
            rows = []
            for doc_id, own, after in zip(*(c.to_pylist() for c in part.columns)):
                own, after = unpack(own).decode(), unpack(after).decode()
                print_own = last[1] if last[0] == own else of(own)
                print_next = of(after)
                last = (after, print_next)
                changed = edited(own, after)
                print_changed = of(changed)
                rows.append(
                    (
                        doc_id,
                        len(own),
                        sha256(changed.encode()).hexdigest(),
                        print_own,
                        print_changed,
                        likeness(print_own, print_changed),
                        likeness(print_own, print_next),
                    )
                )
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

        return apply

    return map_slices(
        with_next(docs),
        make,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
