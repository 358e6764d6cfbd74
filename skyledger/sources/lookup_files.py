"""Small reference files (airports, countries): CSV in, database table out."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.casts import to_double
from skyledger.operators.skew import lookup_join
from skyledger.sources.scratch import materialize

AIRPORT_COLUMNS = (
    "type",
    "name",
    "latitude_deg",
    "longitude_deg",
    "iso_country",
    "iso_region",
    "municipality",
)
JDBC_BATCH_ROWS = 1000
# Text columns of the airport table that get a fixed width in the database.
AIRPORT_COLUMN_TYPES = {"name": "VARCHAR(255)", "type": "VARCHAR(255)"}


# How CSV files are read: double quotes, doubled inside a quoted value.
CSV_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false"}
#: Character sets in which a byte of a line break or quote is never part of another character.
SPLITTABLE = {"UTF-8", "UTF8", "US-ASCII", "ISO-8859-1", "LATIN1", "CP1252", "WINDOWS-1252", "GBK", "GB18030"}


def _read_whole_files(spark, paths: list[str], encoding: str) -> DataFrame:
    """CSV records, which may hold quoted line breaks; a file is read by one task."""
    options = {**CSV_OPTIONS, "encoding": encoding, "multiLine": "true"}
    return spark.read.options(**options).csv(paths)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open after a line, given whether one was before.

    A quote opens a value only at its start; elsewhere in a bare value it is plain.
    """
    at, n = 0, len(line)
    while True:
        if inside:
            close = line.find('"', at)
            while close >= 0 and line[close + 1 : close + 2] == '"':
                close = line.find('"', close + 2)
            if close < 0:
                return True
            inside, at = False, close + 1
        elif line[at : at + 1] == '"':
            inside, at = True, at + 1
            continue
        comma = line.find(",", at)
        if comma < 0 or comma + 1 > n:
            return False
        at = comma + 1


_BLOCK = "path string, start long"
_RECORDS = f"{_BLOCK}, at long, kind int, text string"
# A record that a block holds whole, the end of one begun before, one that goes on, and a
# block within a record.
WHOLE, HEAD, TAIL, MIDDLE = range(4)


def _lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Lines of text files with the byte range they were read in; ranges are read in order."""
    text = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        text = F.decode(text.cast("binary"), encoding)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        text.alias("line"),
    )


def _by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str], list]]:
    """The lines of a task, cut where a new byte range begins, with the other columns' values."""
    for batch in batches:
        paths, starts = batch.column("path"), batch.column("start").to_numpy()
        names = paths.dictionary_encode().indices.to_numpy()
        change = (np.diff(starts) != 0) | (np.diff(names) != 0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            rest = [part.column(c)[0].as_py() for c in part.schema.names if c == "inside"]
            yield (paths[a].as_py(), int(starts[a])), part.column("line").to_pylist(), rest


def quote_maps(lines: DataFrame) -> DataFrame:
    """Per byte range whether a quoted value is open at its end, for both ways to begin.

    The two answers of a range compose with those of the next, as a sum of parities does.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[bool]] = {}
        for key, part, _ in _by_block(batches):
            state = found.setdefault(key, [False, True])
            for line in part:
                if '"' in line:
                    state[:] = [ends_inside(line, s) for s in state]
                # A line without a quote changes neither: a record ends or a value goes on.
        rows = [{"path": k[0], "start": k[1], "out": v[0], "in": v[1]} for k, v in found.items()]
        if rows:
            kinds = [("path", pa.string()), ("start", pa.int64())]
            kinds += [("out", pa.bool_()), ("in", pa.bool_())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return lines.mapInArrow(run, f"{_BLOCK}, out boolean, in boolean")


def open_quotes(maps: DataFrame) -> DataFrame:
    """``inside``: whether a quoted value is open where each byte range begins."""
    ranges = F.array_sort(F.collect_list(F.struct("start", "out", "in")))
    none = F.array().cast("array<struct<start:bigint,inside:boolean,now:boolean>>")

    def follow(done: Column, x: Column) -> Column:
        now = F.coalesce(F.element_at(done, -1)["now"], F.lit(False))
        after = F.when(now, x["in"]).otherwise(x["out"])
        one = F.struct(x["start"].alias("start"), now.alias("inside"), after.alias("now"))
        return F.concat(done, F.array(one))

    def begun(done: Column, x: Column) -> Column:
        return F.when(F.size(done) == 0, follow_first(x)).otherwise(follow(done, x))

    def follow_first(x: Column) -> Column:
        return F.array(
            F.struct(x["start"].alias("start"), F.lit(False).alias("inside"), x["out"].alias("now"))
        )

    states = maps.groupBy("path").agg(F.aggregate(ranges, none, begun).alias("s"))
    return states.select("path", F.explode("s").alias("s")).select("path", "s.start", "s.inside")


def _fragments(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Records of each byte range, and the ends of those that cross its borders."""
    kinds = [("path", pa.string()), ("start", pa.int64()), ("at", pa.int64())]
    schema = pa.schema([*kinds, ("kind", pa.int32()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, inside, begun, at = None, False, False, 0
        held: list[str] = []
        out: list[tuple] = []

        def flush_block():
            # What is open at the end of a range goes on in the next one.
            if here is not None and held:
                out.append((*here, at, TAIL if begun else MIDDLE, "\n".join(held)))

        for key, part, (was,) in _by_block(batches):
            if key != here:
                flush_block()
                here, inside, begun, at, held = key, was, not was, 0, []
            for line in part:
                held.append(line)
                if '"' in line:
                    inside = ends_inside(line, inside)
                if not inside:
                    out.append((*here, at, WHOLE if begun else HEAD, "\n".join(held)))
                    held, begun, at = [], True, at + 1
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
                )
                out = []
        flush_block()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
            )

    known = lookup_join(lines, states, ["path", "start"], "inner")
    return known.select("path", "start", "line", "inside").mapInArrow(run, _RECORDS)


def csv_records(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Records of CSV files of any size as text, with ``first`` for the first of a file.

    A file is read by as many tasks as its size asks for. A first pass finds for each
    byte range whether a quoted value is open at its end, whichever way it began; from
    that follows where each begins, and a second pass cuts the records, which may hold
    line breaks and cross the borders of ranges. Blank lines between records are skipped.
    """
    lines = _lines(spark, paths, encoding)
    states = materialize(open_quotes(quote_maps(lines)), "csv-states")
    found = _fragments(lines, states)
    crossing = found.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("path").orderBy("start", "at")
    joined = (
        crossing.withColumn("_n", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
        .groupBy("path", "_n")
        .agg(F.array_sort(F.collect_list(F.struct("start", "at", "text"))).alias("p"))
        .select(
            "path",
            F.col("p")[0]["start"].alias("start"),
            F.col("p")[0]["at"].alias("at"),
            F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"),
        )
    )
    records = found.where(F.col("kind") == WHOLE).drop("kind").unionByName(joined)
    first = (F.col("start") == 0) & (F.col("at") == 0)
    text = F.when(first, F.ltrim("text", F.lit("\ufeff"))).otherwise(F.col("text"))
    return records.select(first.alias("first"), text.alias("text")).where(F.col("text") != "")


def _read_csv(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """The records of files with one header, as text columns named by it."""
    if encoding.upper() not in SPLITTABLE:
        return _read_whole_files(spark, paths, encoding)
    names = _read_whole_files(spark, paths, encoding).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    rows = csv_records(spark, paths, encoding).select(
        "first", F.from_csv("text", schema, {"escape": CSV_OPTIONS["escape"]}).alias("r")
    )
    other = F.lit(False)
    for n in names:  # a column without a name was given one
        found = F.col("r").getField(n)
        other = other | (found.isNotNull() & (found != n))
    wrong = F.raise_error(F.lit("a file has another header than the first one")).cast("boolean")
    header = F.when(F.col("first") & other, wrong).otherwise(F.col("first"))
    return rows.where(~header).select("r.*")


def files_not_utf8(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Names of the files that hold a line which is not valid UTF-8.

    Lines are checked where they are read, so a file may be split over tasks.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.is_valid_utf8("value").alias("valid"),
    )
    bad = lines.where(~F.col("valid")).select("path").distinct()
    return [row.path for row in bad.collect()]


def load_lookup_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    fallback_encoding: str | None = None,
) -> DataFrame:
    """Read CSV files with a header as text columns; keep ``columns`` only.

    With ``fallback_encoding`` each file that is not valid UTF-8 is read in that
    encoding instead. Spark reads GBK and cp1252 only in a session that sets
    ``spark.sql.legacy.javaCharsets``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no files to read")
    if fallback_encoding is None:
        groups = [(paths, encoding)]
    else:
        names = [
            r.path
            for r in spark.read.format("binaryFile").load(paths).select("path").collect()
        ]
        bad = set(files_not_utf8(spark, paths))
        groups = [
            ([n for n in names if n not in bad], "UTF-8"),
            ([n for n in names if n in bad], fallback_encoding),
        ]
    out = None
    for files, charset in groups:
        if files:
            df = _read_csv(spark, files, charset)
            df = df.select(*columns) if columns else df
            out = df if out is None else out.unionByName(df)
    return out


def airports_table(df: DataFrame) -> DataFrame:
    """Empty rows dropped, missing text blank, coordinates numeric or NULL."""
    filled = df.select(*AIRPORT_COLUMNS).dropna(how="all").fillna("")
    return filled.withColumns(
        {c: to_double(F.col(c)) for c in ("latitude_deg", "longitude_deg")}
    )


def countries_table(df: DataFrame) -> DataFrame:
    """Empty rows dropped; the two columns, whatever their names, are code and name."""
    if len(df.columns) != 2:
        raise ValueError(f"expected two columns, got {df.columns}")
    return df.dropna(how="all").toDF("code", "name")


def jdbc_options(
    url: str, table: str, column_types: Mapping[str, str] | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(JDBC_BATCH_ROWS)}
    if column_types:
        options["createTableColumnTypes"] = ", ".join(
            f"{name} {kind}" for name, kind in column_types.items()
        )
    return options


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    column_types: Mapping[str, str] | None = None,
    connection: Mapping[str, str] | None = None,
) -> None:
    """Replace a database table. User, password and driver come in ``connection``."""
    (
        df.write.format("jdbc")
        .options(**jdbc_options(url, table, column_types), **(connection or {}))
        .mode("overwrite")
        .save()
    )
