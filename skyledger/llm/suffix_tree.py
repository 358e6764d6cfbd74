"""A probabilistic suffix tree over words, and the log probability of texts under it.

A state is a context of up to ``DEPTH`` words. The root's next-symbol distribution is
the smoothed unigram one; that of a state s is discounted by one and falls back to its
suffix (the state without its first word):

    P(w | s) = (max(c(s, w) - 1, 0) + types(s) * P(w | suffix(s))) / c(s)

A context that is at least ``MIN_SHARE`` of all training symbols (and was seen
``MIN_COUNT`` times) is tested against its suffix if that is a state itself: it is kept if the next symbols seen twice or more, weighted by their
counts, diverge from what the suffix predicts by ``MIN_GAIN`` nats in all, after what
the symbols seen once lose by falling back. A token is scored by the longest kept
suffix of the words before it.

Spark deals the work by context. Texts are cut into stored slices of some
``SLICE_TOKENS`` words, as codes of a vocabulary of the slice. For each length of
context every slice sends, per context that is still tested, its distinct next symbols
and their counts; those of one context meet, are added up and tested, and every slice
gets back the counts of what it sent. Contexts beyond ``PART_COUNT`` occurrences, the
root first of all, are dealt in parts by next symbol, so no task holds more than one
part, however frequent a context is. As the least count follows the corpus, a slice sends
about as much of a large corpus as of a small one. Next symbols whose pair with the suffix is unique
cannot repeat and are sent as a number. Nothing is collected but two totals; the
statistics grow with the corpus and every text is scored whole.

Cases: a null or empty text is the end symbol alone. Repeated rows count and are scored
each. A row without an id is not held out and trains. If all rows are held out, all
symbols are unknown. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.skew import lookup_join
from skyledger.sources.scratch import materialize

DEPTH = 2
MIN_COUNT = 32
MIN_SHARE = 1e-6
MIN_GAIN = 12.0
SLICE_TOKENS = 2_000_000
PART_COUNT = 1_000_000
HELD_OUT_OF, HELD_OUT = 5, 1
#: The end of a text; no word contains a line break.
END = b"\n"
#: Entries that a task merges together, beyond those of one part.
_WINDOW = 1_000_000
#: Bytes of a text that are cut into words at a time.
_CUT = 4 << 20
_SPACE = re.compile(rb"[\x09-\x0d\x20]")
_ROOT = np.uint64(0)
#: Bits of a word's number for its place in a part of the root; the part is above them.
_PLACE_BITS = 24

SLICE = (
    "slice long, rows array<long>, ids array<long>, held_out array<boolean>, ends array<int>, "
    "lead int, words binary, codes binary"
)
SENT = (
    "slice long, context long, part int, total long, lone int, symbols binary, counts binary, "
    "predicted binary"
)
MERGED = (
    "slice long, context long, part int, total long, counts binary, places binary, "
    "gain double, lone long, types long"
)
SCORES = "_row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def held_out(doc_id):
    """Whether a row is kept from training, by the checksum of its id."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in lower case, some megabytes at a time, and the end."""
    data, at = (text or "").encode().lower(), 0
    while len(data) - at > _CUT:
        space = _SPACE.search(data, at + _CUT)
        stop = space.start() if space else len(data)
        yield data[at:stop].split()
        at = stop
    yield [*data[at:].split(), END]


class _Codes(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Cutter:
    """Collects texts into rows of ``SLICE``; long ones go on in the next, with some lead."""

    def __init__(self, size: int, depth: int):
        self.size, self.depth = size, depth
        self._clear(np.empty(0, np.int32), _Codes())

    def _clear(self, lead: np.ndarray, lead_words: _Codes) -> None:
        self.codes: list[np.ndarray] = [lead]
        self.known = lead_words
        self.lead, self.n = len(lead), len(lead)
        self.rows, self.ids, self.out, self.ends = [], [], [], []

    def add(self, row: int, doc_id: int | None, out: bool, text: str | None) -> Iterator[dict]:
        for part in words(text):
            for at in range(0, len(part), self.size):
                some = part[at : at + self.size]
                code = map(self.known.__getitem__, some)
                self.codes.append(np.fromiter(code, dtype=np.int32, count=len(some)))
                self.n += len(some)
                if self.n >= self.size and some[-1] is not END:
                    yield self._end(row, doc_id, out, goes_on=True)
        yield from [self._end(row, doc_id, out)] if self.n >= self.size else []
        if self.n:
            self._note(row, doc_id, out)

    def _note(self, row, doc_id, out) -> None:
        self.rows.append(row)
        self.ids.append(doc_id)
        self.out.append(out)
        self.ends.append(self.n)

    def _end(self, row, doc_id, out, goes_on=False) -> dict:
        self._note(row, doc_id, out)
        codes, known = np.concatenate(self.codes), list(self.known)
        made = self.row(codes, known)
        start = self.ends[-2] if len(self.ends) > 1 else 0
        tail = codes[max(start, len(codes) - self.depth) :] if goes_on else codes[:0]
        kept = _Codes()
        self._clear(np.array([kept[known[c]] for c in tail], dtype=np.int32), kept)
        return made

    def row(self, codes: np.ndarray, known: list[bytes]) -> dict:
        """Frequent words get small codes, which store well."""
        rank = np.argsort(-np.bincount(codes, minlength=len(known)), kind="stable")
        code = np.empty(len(known), dtype="<u4")
        code[rank] = np.arange(len(known))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), dtype="<u8", count=len(known))[rank]
        planes = code[codes].view(np.uint8).reshape(-1, 4).T.tobytes()
        return {
            "rows": self.rows, "ids": self.ids, "held_out": self.out, "ends": self.ends,
            "lead": self.lead, "words": hashes.tobytes(),
            "codes": zstandard.ZstdCompressor(3).compress(planes),
        }

    def rest(self) -> Iterator[dict]:
        if self.ends:
            yield self.row(np.concatenate(self.codes), list(self.known))


def slices(docs: DataFrame, tokens: int = SLICE_TOKENS, depth: int = DEPTH) -> DataFrame:
    """Stored rows of ``SLICE``: the words of many texts, or of a part of a long one."""
    schema = pa.schema(
        [
            ("rows", pa.list_(pa.int64())),
            ("ids", pa.list_(pa.int64())),
            ("held_out", pa.list_(pa.bool_())),
            ("ends", pa.list_(pa.int32())),
            ("lead", pa.int32()),
            ("words", pa.binary()),
            ("codes", pa.binary()),
        ]
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(tokens, depth)
        for batch in batches:
            columns = [batch.column(c) for c in ("_row", "doc_id", "held_out", "text")]
            for values in zip(*columns):
                for row in cutter.add(*(v.as_py() for v in values)):
                    yield pa.RecordBatch.from_pylist([row], schema)
        for row in cutter.rest():
            yield pa.RecordBatch.from_pylist([row], schema)

    read = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    made = read.mapInArrow(cut, SLICE.split(", ", 1)[1])
    numbered = made.withColumn("slice", F.monotonically_increasing_id())
    return materialize(numbered, "pst-slices", "zstd")


@dataclass
class Totals:
    """Training symbols, and how many different ones."""

    tokens: int
    types: int | None = None


@dataclass
class Tested:
    """The contexts of one length in a slice, as they are sent and come back."""

    contexts: np.ndarray  # hash of the context of each sent row
    parts: np.ndarray  # part of each row
    total: np.ndarray  # occurrences of the row's context
    lone: np.ndarray  # unique symbols of the row that are not sent
    starts: np.ndarray  # first entry of each row, and the end
    symbols: np.ndarray
    counts: np.ndarray
    predicted: np.ndarray
    at: np.ndarray  # positions that have a context of this length under test
    row: np.ndarray  # their row
    entry: np.ndarray  # their entry, -1 where it is not sent


class Slice:
    """The positions of a slice and what is known of them at each length of context."""

    def __init__(self, row: dict, totals: Totals, part_count: int, min_count: int):
        self.totals, self.part_count, self.min_count = totals, part_count, min_count
        self.hashes = np.frombuffer(row["words"], "<u8")
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["codes"]), np.uint8)
        self.codes = planes.reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int32)
        self.numbers: np.ndarray | None = None  # of the words, once the root has come back
        n, lead = len(self.codes), row["lead"]
        ends = np.array(row["ends"], dtype=np.int32)
        starts = np.concatenate([ends[:0], [0], ends[:-1]]).astype(np.int32)
        lengths = ends - starts
        self.doc = np.repeat(np.arange(len(ends), dtype=np.int32), lengths)
        # Words before each position in its text.
        self.depth = np.arange(n, dtype=np.int32) - np.repeat(starts, lengths)
        self.counted = np.arange(n) >= lead
        self.train = self.counted & ~np.array(row["held_out"], dtype=bool)[self.doc]
        # Of each position: its count after the longest context tested, its log probability,
        # and whether the longest context so far is a state.
        self.count = np.zeros(n, dtype=np.int64)
        self.log = np.zeros(n)
        self.state = np.ones(n, dtype=bool)
        self.level = 0

    def _under_test(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions with a context of the present length, and its occurrences."""
        total = np.zeros(len(self.codes), dtype=np.int64)
        total[1:] = self.count[:-1]  # of the context's last word after those before it
        good = self.state & (self.depth >= self.level) & (total >= self.min_count)
        at = np.flatnonzero(good)
        return at, total[at]

    def _tested_root(self) -> Tested:
        """``tested`` for the root: every word is an entry, so only words are sorted."""
        total = max(self.totals.tokens, 1)
        part = np.zeros(len(self.hashes), dtype=np.int32)
        if total > self.part_count:
            part[:] = _mixed(self.hashes) % np.uint64(-(-total // self.part_count))
        order = np.argsort(part, kind="stable")
        entry = np.empty(len(order), dtype=np.int32)
        entry[order] = np.arange(len(order))
        parts, row, size = np.unique(part, return_inverse=True, return_counts=True)
        counts = np.bincount(self.codes[self.train], minlength=len(order))
        return Tested(
            contexts=np.full(len(parts), _ROOT),
            parts=parts,
            total=np.full(len(parts), total),
            lone=np.zeros(len(parts), dtype=np.int32),
            starts=np.concatenate([[0], np.cumsum(size)]),
            symbols=self.hashes[order],
            counts=counts[order].astype("<u4"),
            predicted=np.zeros(len(order), dtype="<f2"),
            at=np.arange(len(self.codes)),
            row=row.astype(np.int32)[self.codes],
            entry=entry[self.codes],
        )

    def tested(self) -> Tested:
        """What this slice sends for contexts of the present length."""
        if self.level == 0:
            return self._tested_root()
        at, total = self._under_test()
        n, width = len(at), len(self.hashes)
        # A symbol whose pair with the shorter context is unique is so here as well.
        sent = self.count[at] >= 2
        context = np.zeros(n, dtype=np.int64)
        for d in range(self.level, 0, -1):
            context = context * width + self.codes[at - d]
            if 1 < d:
                context = np.unique(context, return_inverse=True)[1]
        # Symbols of hot contexts go to a part by their hash.
        part = np.zeros(n, dtype=np.int32)
        hot = np.flatnonzero(total > self.part_count)
        if len(hot):
            parts = -(-total[hot] // self.part_count)
            part[hot] = _mixed(self.hashes[self.codes[at[hot]]]) % parts.astype(np.uint64)
        # Rows by context, part and symbol; symbols that are not sent are 0.
        key = context
        key *= int(part.max(initial=0)) + 1
        key += part
        key *= width + 1
        key += np.where(sent, self.codes[at] + 1, 0)
        order = np.argsort(key)
        key = key[order]
        new_entry = np.ones(n, dtype=bool)
        new_entry[1:] = key[1:] != key[:-1]
        has = key % (width + 1) > 0
        new_entry &= has
        key //= width + 1
        new_row = np.ones(n, dtype=bool)
        new_row[1:] = key[1:] != key[:-1]
        del key, context
        first, entries = order[new_row], order[new_entry]
        row, entry = np.empty(n, dtype=np.int32), np.empty(n, dtype=np.int32)
        row[order] = np.cumsum(new_row) - 1
        entry[order] = np.where(has, np.cumsum(new_entry) - 1, -1)
        rows = len(first)
        # The hash of a context of several words; only its words count.
        contexts = np.full(rows, _ROOT)
        for d in range(self.level, 0, -1):
            word = self.hashes[self.codes[at[first] - d]]
            contexts = _mixed(contexts * np.uint64(0x9E3779B97F4A7C15) + word)
        train, has = self.train[at], entry >= 0
        lone = train & ~has  # each a symbol of its own
        words = self.codes[at[entries]]
        symbols = self.hashes[words] if self.numbers is None else self.numbers[words]
        return Tested(
            contexts=contexts,
            parts=part[first],
            total=total[first],
            lone=np.bincount(row[lone], minlength=rows).astype(np.int32),
            starts=np.concatenate([[0], np.cumsum(np.bincount(row[entries], minlength=rows))]),
            symbols=symbols,
            counts=np.bincount(entry[has & train], minlength=len(entries)).astype("<u4"),
            predicted=self.log[at[entries]].astype("<f2"),
            at=at,
            row=row,
            entry=entry,
        )

    def learn(self, tested: Tested, counts: np.ndarray, kept: np.ndarray, types: np.ndarray) -> None:
        """Take in the counts of the entries, and of each row if its context is a state."""
        at, entry = tested.at, tested.entry
        found = np.where(entry >= 0, counts[entry] if len(counts) else 0, 0).astype(np.int64)
        self.count = np.zeros(len(self.codes), dtype=np.int64)
        self.count[at] = found
        if self.level == 0:
            n, v = self.totals.tokens, self.totals.types
            self.log = np.log((found + 0.5) / (n + 0.5 * (v + 1)))
            self.base = self.log
            self.known = found > 0
        else:
            state = kept[tested.row]
            self.state = np.zeros(len(self.codes), dtype=bool)
            self.state[at] = state
            hit, total = np.maximum(found - 1, 0)[state], tested.total[tested.row][state]
            back = types[tested.row][state] * np.exp(self.log[at[state]])
            log = self.log.copy()
            log[at[state]] = np.log((hit + back) / total)
            self.log = log
        self.level += 1

    def learn_replies(self, table: pa.Table) -> None:
        """Learn the levels that are in the replies to this slice, in their order."""
        level_of = table.column("level").to_numpy()
        for level in range(int(level_of.max(initial=-1)) + 1):
            asked = self.tested()
            mine = table.filter(pa.array(level_of == level)).combine_chunks()
            context = mine.column("context").to_numpy().view(np.uint64)
            part = mine.column("part").to_numpy()
            theirs = np.lexsort((part, context))
            ours = np.lexsort((asked.parts, asked.contexts))
            if not np.array_equal(context[theirs], asked.contexts[ours]):
                raise RuntimeError("the replies to a slice are not those it asked for")
            back = np.empty(len(ours), dtype=np.int64)
            back[ours] = theirs
            rows = mine.take(pa.array(back))
            data = b"".join(rows.column("counts").to_pylist())
            kept = rows.column("kept").to_numpy(zero_copy_only=False)
            if level == 0:
                # Every word is an entry of one row; rows are parts of the root.
                place = np.frombuffer(b"".join(rows.column("places").to_pylist()), "<u4")
                above = np.repeat(asked.parts.astype(np.uint64) << np.uint64(_PLACE_BITS), np.diff(asked.starts))
                number = above + place
                small = number.max(initial=0) < 1 << 32
                self.numbers = np.zeros(len(self.hashes), dtype="<u4" if small else "<u8")
                self.numbers[self.codes[asked.at]] = number[asked.entry]
            self.learn(asked, np.frombuffer(data, "<u4"), kept, rows.column("types").to_numpy())

    def scores(self, row: dict) -> pa.RecordBatch:
        """Sums over the positions of each text, of this slice's part of it."""
        n = len(row["rows"])

        def sums(values) -> np.ndarray:
            found = np.bincount(self.doc[self.counted], weights=values[self.counted], minlength=n)
            return found.astype(float)

        columns = [
            pa.array(row["rows"], pa.int64()),
            pa.array(row["ids"], pa.int64()),
            pa.array(row["held_out"], pa.bool_()),
            pa.array(sums(np.ones(len(self.codes))).astype(np.int64)),
            pa.array(sums(self.known).astype(np.int64)),
            pa.array(sums(self.base) / np.log(10)),
            pa.array(sums(self.log) / np.log(10)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCORES.split(", ")])


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary value of the bytes of each run of an array."""
    width = values.dtype.itemsize
    offsets = (starts * width).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers).cast(pa.binary())


def _sent(part: Slice, number: int) -> pa.Table:
    asked = part.tested()
    n = len(asked.contexts)
    return pa.table(
        {
            "slice": np.full(n, number),
            "context": asked.contexts.view(np.int64),
            "part": asked.parts,
            "total": asked.total,
            "lone": asked.lone,
            "symbols": _binary(asked.symbols, asked.starts),
            "counts": _binary(asked.counts, asked.starts),
            "predicted": _binary(asked.predicted, asked.starts),
        }
    )


def _joined(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)


def _symbols(table: pa.Table, sizes: np.ndarray) -> np.ndarray:
    """Numbers of 4 or 8 bytes; slices whose words have small numbers send the shorter."""
    data = table.column("symbols").to_pylist()
    if all(len(x) == 8 * n for x, n in zip(data, sizes.tolist())):
        return np.frombuffer(b"".join(data), "<u8")
    if all(len(x) == 4 * n for x, n in zip(data, sizes.tolist())):
        return np.frombuffer(b"".join(data), "<u4")
    parts = [np.frombuffer(x, f"<u{len(x) // n}") for x, n in zip(data, sizes.tolist()) if n]
    return np.concatenate([p.astype("<u8") for p in parts])


def merge(table: pa.Table, level: int) -> pa.Table:
    """Counts of all slices for whole parts of contexts, and the parts' share of the test.

    The root also numbers its symbols, by their place in the part.
    """
    context, part = table.column("context").to_numpy(), table.column("part").to_numpy()
    new = np.ones(len(context), dtype=bool)
    new[1:] = (context[1:] != context[:-1]) | (part[1:] != part[:-1])
    group = np.cumsum(new) - 1
    sizes = pc.binary_length(table.column("counts")).to_numpy().astype(np.int64) // 4
    of = np.repeat(group, sizes)
    counts, symbols = _joined(table, "counts", "<u4"), _symbols(table, sizes)
    order = np.lexsort((symbols, of))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (of[order][1:] != of[order][:-1]) | (symbols[order][1:] != symbols[order][:-1])
    entry = np.empty(len(order), dtype=np.int64)
    entry[order] = np.cumsum(first) - 1
    total = np.bincount(entry, weights=counts, minlength=first.sum())
    one, n = order[first], int(new.sum())
    lone = np.bincount(group, weights=table.column("lone").to_numpy(), minlength=n)
    seen = table.column("total").to_numpy()[new].astype(float)
    at = of[one]
    log = _joined(table, "predicted", "<f2")[one].astype(float)
    twice = total >= 2
    gain = total[twice] * (np.log((total[twice] - 1) / seen[at[twice]]) - log[twice])
    gains = np.bincount(at[twice], weights=gain, minlength=n)
    once = lone + np.bincount(at[total == 1], minlength=n)
    types = lone + np.bincount(at[total >= 1], minlength=n)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if level:
        places = pa.array([b""] * len(table), pa.binary())
    else:
        place = entry - np.searchsorted(at, of)
        if place.max(initial=0) >> _PLACE_BITS:
            raise OverflowError("a part of the root has too many words")
        places = _binary(place.astype("<u4"), starts)
    return pa.table(
        {
            **{c: table.column(c) for c in ("slice", "context", "part", "total")},
            "counts": _binary(total[entry].astype("<u4"), starts),
            "places": places,
            "gain": gains[group].astype(float),
            "lone": once[group].astype(np.int64),
            "types": types[group].astype(np.int64),
        }
    )


def _merged(sent: DataFrame, level: int) -> DataFrame:
    """``MERGED`` for every sent row; parts of contexts are merged whole, some at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held.append(table)
            if sum(t.column("counts").nbytes for t in held) < 4 * _WINDOW:
                continue
            table = pa.concat_tables(held).combine_chunks()
            context, part = table.column("context").to_numpy(), table.column("part").to_numpy()
            same = (context == context[-1]) & (part == part[-1])
            stop = int(np.argmax(same))  # the last part may go on
            held = [table.slice(stop)]
            if stop:
                yield from merge(table.slice(0, stop), level).to_batches()
        if held:
            yield from merge(pa.concat_tables(held).combine_chunks(), level).to_batches()

    by = ["context", "part"]
    return sent.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, MERGED)


def replies(sent: DataFrame, level: int, min_gain: float, part_count: int) -> DataFrame:
    """Stored counts for every sent row, whether its context is a state, and its types."""
    merged = materialize(_merged(sent, level), "pst-merged", "zstd")
    sums = ["gain", "lone", "types"]
    split = (
        merged.where(F.col("total") > part_count)
        .groupBy("context", "part")
        .agg(*[F.first(c).alias(c) for c in sums])  # equal in all rows of a part
        .groupBy("context")
        .agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    )
    split = materialize(split, "pst-split")
    # Only the rows of hot contexts need the sums over all parts.
    one = merged.where(F.col("total") <= part_count)
    several = lookup_join(merged.where(F.col("total") > part_count), split, ["context"], "inner")
    whole = one.unionByName(
        several.select(*[c for c in merged.columns if c not in sums], *[F.col(f"_{c}").alias(c) for c in sums])
    )
    gain, once, types = (F.col(c) for c in sums)
    # What symbols seen once gain by falling back: the logarithm of the share of types.
    share = F.log(F.greatest(types, F.lit(1)) / F.col("total"))
    kept = F.lit(True) if level == 0 else gain + once * share >= min_gain
    return whole.select(
        "slice",
        F.lit(level).alias("level"),
        "context",
        "part",
        "counts",
        "places",
        kept.alias("kept"),
        types.alias("types"),
    )


def score(
    docs: DataFrame,
    depth: int = DEPTH,
    min_count: int = MIN_COUNT,
    min_share: float = MIN_SHARE,
    min_gain: float = MIN_GAIN,
    slice_tokens: int = SLICE_TOKENS,
    part_count: int = PART_COUNT,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, base and score.

    The tree is learnt from the rows that are not held out; all rows are scored.
    """
    made = slices(docs, slice_tokens, depth)
    lengths = F.zip_with(
        F.zip_with("ends", F.concat(F.array("lead"), F.slice("ends", 1, F.size("ends") - 1)), lambda a, b: a - b),
        "held_out",
        lambda n, out: F.when(out, 0).otherwise(n).cast("long"),
    )
    found = made.agg(
        F.sum(F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)), F.count("*")
    ).first()
    totals, pieces = Totals(found[0] or 0), found[1]
    min_count = max(min_count, 2, math.ceil(min_share * totals.tokens))
    # A slice is few bytes and much work: a stated number of partitions is not merged.
    dealt = made.repartition(max(1, 2 * pieces), "slice").groupBy("slice")
    known: DataFrame | None = None

    def send_first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Slice(row, totals, part_count, min_count)
                yield from _sent(part, row["slice"]).to_batches()

    def after(table: pa.Table, found: pa.Table) -> tuple[Slice, dict]:
        (row,) = table.to_pylist()
        part = Slice(row, totals, part_count, min_count)
        part.learn_replies(found)
        return part, row

    def send(table: pa.Table, found: pa.Table) -> pa.Table:
        part, row = after(table, found)
        return _sent(part, row["slice"])

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        part, row = after(table, found)
        return pa.Table.from_batches([part.scores(row)])

    def with_replies():
        return known.repartition(max(1, 2 * pieces), "slice").groupBy("slice")

    for level in range(depth + 1):
        if level == 0:
            sent = made.mapInArrow(send_first, SENT)
        else:
            sent = dealt.cogroup(with_replies()).applyInArrow(send, SENT)
        reply = replies(sent, level, min_gain, part_count)
        if level == 0:
            totals.types = reply.agg(F.max("types")).first()[0] or 0  # those of the root
        known = reply if known is None else known.unionByName(reply)

    pieces_scored = dealt.cogroup(with_replies()).applyInArrow(finish, SCORES)
    return (
        pieces_scored.groupBy("_row", "doc_id", "held_out")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .withColumn("train_tokens", F.lit(totals.tokens).cast("long"))
        .select(
            "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
        )
    )
