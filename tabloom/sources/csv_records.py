"""Records of CSV files read in parallel byte ranges, with line breaks inside quoted cells.

A line of a file cannot be told to start a record before it is known whether the quotes of all earlier text are closed. Each
range therefore maps both possibilities (its first line starts a record, or continues a quoted cell) to the state behind its last
line. Chaining these maps over the ranges of a file tells how each range begins; only those that begin inside a cell are
kept and broadcast. A second pass cuts records within the ranges, all at the same time; the few pieces of
records that cross a range are put together by file and range.

A cell is quoted if its first character is a quote; two quotes inside it stand for one. Lines end with LF or CR LF. Ranges are the
splits of Spark's text source, so ``spark.sql.files.maxPartitionBytes`` sets their size and any number of ranges gives the same
records. A compressed file is one range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.functions.attach import BROADCAST_BYTES, BROADCAST_ROWS

QUOTE = '"'


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the text behind ``line`` is inside a quoted cell, given whether its start is."""
    at = line.find(QUOTE)
    if at < 0:
        return inside
    at = 0
    while True:
        if not inside:
            if not line.startswith(QUOTE, at):
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += 1
                continue
            at += 1
        close = line.find(QUOTE, at)
        while close >= 0 and line.startswith(QUOTE, close + 1):
            close = line.find(QUOTE, close + 2)
        if close < 0:
            return True
        inside = False
        at = line.find(sep, close + 1)
        if at < 0:
            return False
        at += 1


def _maps(sep: str):
    """Lines of ranges in order -> per range the state behind it for either state before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, (False, True), []
        for batch in batches:
            for line, file, start in zip(*[c.to_pylist() for c in batch.columns]):
                if (file, start) != now:
                    if now is not None:
                        done.append((*now, *state))
                    now, state = (file, start), (False, True)
                if QUOTE in line:
                    state = tuple(ends_inside(line, s, sep) for s in state)
        if now is not None:
            done.append((*now, *state))
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
        columns = [pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "outside", "inside"])

    return run


def _begins(table: pa.Table) -> pa.Table:
    """The ranges of one file that begin inside a quoted cell."""
    state, starts = False, []
    rows = table.sort_by("start").to_pylist()
    for r in rows:
        if state:
            starts.append(r["start"])
        state = r["inside"] if state else r["outside"]
    return pa.table({"file": pa.array([rows[0]["file"]] * len(starts), pa.string()), "start": pa.array(starts, pa.int64())})


#: a whole record, the rest of a record of an earlier range, the begin of one that goes on in a later range
WHOLE, REST, BEGIN = 0, 1, 2


def _cut(sep: str):
    """Lines of ranges in order, each with the state its range begins in -> records and pieces; whole headers are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, lines, kind, header = None, False, [], WHOLE, False
        out: list[tuple] = []

        def put(how: int) -> None:
            nonlocal kind, header
            if lines and not (header and how == WHOLE):
                out.append((how, "\n".join(lines), *now, header))
            lines.clear()
            kind, header = WHOLE, False

        def flush() -> pa.RecordBatch:
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["kind", "record", "file", "start", "header"])

        for batch in batches:
            for line, file, start, begins in zip(*[c.to_pylist() for c in batch.columns]):
                if (file, start) != now:
                    put(REST if kind == REST else BEGIN)
                    now, inside = (file, start), begins
                    kind, header = REST if begins else WHOLE, start == 0
                if QUOTE in line:
                    inside = ends_inside(line, inside, sep)
                lines.append(line)
                if not inside:
                    put(kind)
            if len(out) > 2000:
                yield flush()
        put(REST if kind == REST else BEGIN)
        yield flush()

    return run


def csv_records(spark: SparkSession, path: str, sep: str = ",", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(file, record) of all files of ``path`` without each file's first record (its header) and empty lines."""
    where = F.col("_metadata")
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("value").alias("line"), where["file_path"].alias("file"), where["file_block_start"].alias("start")
    )
    maps = lines.mapInArrow(_maps(sep), "file string, start bigint, outside boolean, inside boolean")
    begins = maps.groupBy("file").applyInArrow(_begins, "file string, start bigint").withColumn("inside", F.lit(True)).persist()
    n, size = begins.agg(F.count("*"), F.sum(F.octet_length("file") + 24)).first()
    if n == 0:
        told = lines.withColumn("inside", F.lit(False))
    elif n <= BROADCAST_ROWS and size <= broadcast_bytes:
        told = lines.join(F.broadcast(begins), ["file", "start"], "left")
    else:  # so many ranges that their states are joined by shuffle; lines are put in order again
        numbered = lines.withColumn("number", F.monotonically_increasing_id()).join(begins, ["file", "start"], "left")
        told = numbered.repartition("file", "start").sortWithinPartitions("file", "start", "number")
    told = told.select("line", "file", "start", F.coalesce("inside", F.lit(False)))
    cut = told.mapInArrow(_cut(sep), "kind int, record string, file string, start bigint, header boolean")
    whole = cut.where(F.col("kind") == WHOLE).select("file", "record")
    if n == 0:  # then no record crosses a range but one that is never closed
        return _clean(whole.unionByName(cut.where((F.col("kind") == BEGIN) & ~F.col("header")).select("file", "record")))
    along = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    pieces = cut.where(F.col("kind") != WHOLE).withColumn("r", F.sum((F.col("kind") == BEGIN).cast("int")).over(along))
    joined = (
        pieces.groupBy("file", "r").agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("p"), F.bool_or("header").alias("header"))
        .where(~F.col("header"))
        .select("file", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    )
    return _clean(whole.unionByName(joined))


def _clean(records: DataFrame) -> DataFrame:
    record = F.when(F.col("record").endswith("\r"), F.expr("substring(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    return records.select("file", record.alias("record")).where("record <> ''")
