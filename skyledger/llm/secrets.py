"""Secret scans with multipart credential linking.

Three kinds of span are reported wherever they stand: ``assign`` (a password or token
is assigned), ``access`` (an access key identifier) and ``hex`` (a long hexadecimal
run). Three more kinds are weak: ``identifier`` (a user or client name is assigned),
``secret`` (a short or oddly named secret is assigned, or a bare mixed token of 40
characters) and ``endpoint`` (a URL). Taken alone they are common in clean text, so a
weak span is reported only if a complementary part of a credential (an identifier or
an endpoint for a secret, a secret for either) lies within ``SCOPE`` code points of
it. That is an interval join: spans are dealt to cells of ``SCOPE`` code points of
their text, a candidate looks into the cells that its scope reaches, and a semi join
on text, cell and part with the distance as condition keeps it.

Only DataFrame functions. The scan is narrow and stored once, with a row number that
later joins use; only spans of texts with weak candidates are shuffled, by cell, so a
text with very many spans is split. Nothing is paired: the join only asks whether a
partner exists.

Positions count code points. Cases: a null or empty text has no spans. Repeated rows
are scanned each. A table column named like a result is replaced, others are kept as
asked; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.arrow import without
from skyledger.sources.scratch import materialize

SCOPE = 200
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = KINDS[:3]

# Patterns by kind, the group whose length counts, and the least length.
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS = (
    (
        "assign",
        rf"((?i:password|passwd|secret|token|api_?key)){_VALUE}([A-Za-z0-9+/_.=-]+)",
        "$2",
        12,
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", "$0", 18),
    ("hex", r"[0-9a-f]{16,}", "$0", 16),
    (
        "identifier",
        r"((?i:access_?key_?id|client_?id|user_?name|user|login|account))"
        rf"{_VALUE}([A-Za-z0-9+/_.@-]+)",
        "$2",
        3,
    ),
    (
        "secret",
        r"((?i:pass_?phrase|pass|pwd|private_?key|secret_?key|credential|auth))"
        rf"{_VALUE}([A-Za-z0-9+/_.=-]+)",
        "$2",
        6,
    ),
    ("secret", r"[A-Za-z0-9+/]{40,}", "$0", 40),
    (
        "endpoint",
        r"(?i:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|ftp|s3)"
        r"://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+",
        "$0",
        8,
    ),
)
#: What a part of a credential is, and what completes it.
PART = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "identifier": "identifier",
    "secret": "secret",
    "endpoint": "endpoint",
}
COMPLETES = {
    "secret": ("identifier", "endpoint"),
    "identifier": ("secret",),
    "endpoint": ("secret",),
}
#: Code points of a text that are kept together while it is masked.
BLOCK = 1024
MASK = "[SECRET]"

_MARK, _OTHER = "\u0001", "\u0002"
_BLOCK_BITS = 8
_SPANS = "array<struct<start:int,rank:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _starts(lengths: Column) -> Column:
    """The sum before each block of lengths."""
    block = 1 << _BLOCK_BITS
    count = F.shiftright(F.size(lengths), _BLOCK_BITS)
    sums = F.transform(
        F.sequence(F.lit(0), count), lambda k: _total(F.slice(lengths, k * block + 1, block))
    )
    return F.aggregate(
        sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )


def _before(lengths: Column, starts: Column, i: Column) -> Column:
    """The sum of the first ``i`` lengths, within one block."""
    k = F.shiftright(i, _BLOCK_BITS)
    block = 1 << _BLOCK_BITS
    rest = F.slice(lengths, k * block + 1, i.bitwiseAND(F.lit(block - 1)))
    return F.element_at(starts, k + 1) + _total(rest)


def _matches(text: Column, kind: str, pattern: str, group: str, least: int) -> Column:
    """Spans of a pattern, by cutting the text at marks around each match.

    The marks stand for no character of any pattern; one that a text holds itself is
    replaced before. Parts come in threes: text, match, and the group that counts.
    """
    free = F.translate(text, _MARK, _OTHER)
    marked = F.regexp_replace(free, pattern, f"{_MARK}$0{_MARK}{group}{_MARK}")

    def spans(parts: Column) -> Column:
        lengths = F.transform(
            parts, lambda x, i: F.when(i % 3 == 2, 0).otherwise(F.length(x))
        )
        good = F.filter(
            F.sequence(F.lit(1), F.size(parts) - 3, F.lit(3)),
            lambda i: F.length(F.get(parts, i + 1)) >= least,
        )
        return _let(
            lengths,
            lambda n: _let(
                _starts(n),
                lambda s: F.transform(
                    good,
                    lambda i: F.struct(
                        _before(n, s, i).alias("start"),
                        F.lit(KINDS.index(kind)).alias("rank"),
                        (_before(n, s, i) + F.get(n, i)).alias("end"),
                    ),
                ),
            ),
        )

    found = _let(F.split(marked, _MARK), spans)
    if kind == "secret" and group == "$0":  # a bare token mixes letters and digits
        found = F.filter(
            found,
            lambda x: (x["end"] - x["start"] == least)
            & _token(text, x).rlike("[0-9]")
            & _token(text, x).rlike("[a-z]")
            & _token(text, x).rlike("[A-Z]"),
        )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def _token(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def _spans(text: Column, base: bool) -> Column:
    found = [
        _matches(text, *p).cast(_SPANS) for p in PATTERNS if (p[0] in BASE) == base
    ]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def _parts(found: DataFrame, column: str) -> DataFrame:
    kinds = F.array(*[F.lit(PART[k]) for k in KINDS])
    return found.select("_row", F.explode(column).alias("_span")).select(
        "_row", "_span", F.get(kinds, F.col("_span.rank")).alias("_part")
    )


def _linked(found: DataFrame) -> DataFrame:
    """``_row`` and the weak spans of it that a complementary part stands near."""
    weak = found.where(F.size("_weak") > 0)
    all_parts = _parts(weak.withColumn("_all", F.concat("_base", "_weak")), "_all")
    held = all_parts.select(
        F.col("_row").alias("_of"),
        F.col("_part").alias("_is"),
        F.col("_span.start").alias("_from"),
        F.col("_span.end").alias("_to"),
        F.explode(
            F.sequence(
                (F.col("_span.start") / SCOPE).cast("int"),
                (F.col("_span.end") / SCOPE).cast("int"),
            )
        ).alias("_cell"),
    )
    wanted = F.create_map(
        *[
            x
            for part, others in COMPLETES.items()
            for x in (F.lit(part), F.array(*map(F.lit, others)))
        ]
    )
    start, end = F.col("_span.start"), F.col("_span.end")
    asking = (
        _parts(weak, "_weak")
        .select("_row", "_span", F.explode(F.element_at(wanted, F.col("_part"))).alias("_wants"))
        .select(
            "*",
            F.explode(
                F.sequence(
                    (F.greatest(start - SCOPE, F.lit(0)) / SCOPE).cast("int"),
                    ((end + SCOPE) / SCOPE).cast("int"),
                )
            ).alias("_at"),
        )
    )
    near = asking.join(
        held,
        (F.col("_row") == F.col("_of"))
        & (F.col("_at") == F.col("_cell"))
        & (F.col("_wants") == F.col("_is"))
        & (F.col("_from") <= end + SCOPE)
        & (F.col("_to") >= start - SCOPE),
        "left_semi",
    )
    return (
        near.select("_row", "_span")
        .distinct()
        .groupBy("_row")
        .agg(F.collect_list("_span").alias("_added"))
    )


def _named(spans: Column) -> Column:
    """Spans with their kind, by start and kind."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.transform(
        F.array_sort(spans),
        lambda x: F.struct(
            F.get(kinds, x["rank"]).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
        ),
    )


def find_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all, if not given), ``base_spans`` and ``secret_spans``.

    Both are arrays of ``kind``, ``start``, ``end`` (exclusive); the second holds the
    first and the linked weak spans.
    """
    docs = without(docs, "base_spans", "secret_spans")
    keep = docs.columns if keep is None else keep
    text = F.coalesce(F.col("text"), F.lit(""))
    found = materialize(
        docs.select(
            *[f"`{c}`" for c in keep],
            F.monotonically_increasing_id().alias("_row"),
            _spans(text, base=True).alias("_base"),
            _spans(text, base=False).alias("_weak"),
        ),
        "secret-scan",
    )
    added = materialize(_linked(found), "secret-links")
    return found.join(added, "_row", "left").select(
        *[f"`{c}`" for c in keep],
        _named(F.col("_base")).alias("base_spans"),
        _named(
            F.concat("_base", F.coalesce("_added", F.array().cast(_SPANS)))
        ).alias("secret_spans"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def span_digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        of_kind = F.filter("base_spans", lambda x: x["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.col("secret_spans")).alias("spans"),
    )


def _merged(spans: Column) -> Column:
    """Overlapping spans as one; spans that only touch stay apart.

    With starts and ends sorted each on its own, a new run begins at place i exactly if
    all i spans before have ended by its start, and a run ends with the last of its ends.
    """

    def runs(starts: Column, ends: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(starts) - 1)
        opens = F.filter(every, lambda i: (i == 0) | (F.get(ends, i - 1) <= F.get(starts, i)))
        return _let(
            opens,
            lambda first: F.transform(
                first,
                lambda i, k: F.struct(
                    F.get(starts, i).alias("start"),
                    F.get(ends, F.coalesce(F.get(first, k + 1), F.size(starts)) - 1).alias("end"),
                ),
            ),
        )

    starts = F.array_sort(F.transform(spans, lambda x: x["start"]))
    ends = F.array_sort(F.transform(spans, lambda x: x["end"]))
    return _let(starts, lambda a: _let(ends, lambda b: runs(a, b)))


def _between(blocks: Column, a: Column, b: Column) -> Column:
    """Code points from ``a`` to ``b`` of a text in blocks; only blocks it touches are read."""
    first, last = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
    head, tail = F.coalesce(F.get(blocks, first), F.lit("")), F.coalesce(F.get(blocks, last), F.lit(""))
    from_, to = (a % BLOCK).cast("int"), (b % BLOCK).cast("int")
    across = F.concat(
        F.substring(head, from_ + 1, F.lit(BLOCK)),
        F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substring(tail, F.lit(1), to),
    )
    return F.when(first == last, F.substring(head, from_ + 1, to - from_)).otherwise(across)


def redact(found: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """Texts with a mask in place of each span; overlapping spans share one.

    A text is cut into blocks once, so its time grows with its length and its spans.
    """

    def masked(spans: Column, blocks: Column) -> Column:
        """The gaps between spans, joined by the mask."""
        gaps = F.transform(
            F.sequence(F.lit(0), F.size(spans)),
            lambda i: _between(
                blocks,
                _edge(spans, i - 1, "end", F.lit(0)),
                _edge(spans, i, "start", F.length(text)),
            ),
        )
        return F.array_join(gaps, mask)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    new = _let(
        _merged(F.col("secret_spans")),
        lambda spans: _let(blocks, lambda cut: masked(spans, cut)),
    )
    return found.withColumn(
        text, F.when(F.size("secret_spans") == 0, F.col(text)).otherwise(new)
    )


def _edge(spans: Column, i: Column, field: str, default: Column) -> Column:
    return F.coalesce(F.get(spans, i)[field], default)
