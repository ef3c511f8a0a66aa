"""Delimited files read in ranges of bytes, quoted line breaks and all, many files and releases in one scan.

Spark splits text files at line ends, and a quoted value may hold one. So each range of a file, as the scan deals them
out, first counts its quotes: an even number before a line means that the line begins outside quotes. A range's own
count is one row; running sums over a file's ranges tell each whether it begins inside a quoted value. In the second
scan a task then knows which of its lines begin a record. A record that a range ends in the middle of is put together
from the pieces, which are the only rows that are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.operators.common import CheckFailed, materialise

#: Ranges that begin inside quotes, up to which their list goes to every task. With more, lines are sorted to meet it.
LISTED = 1_000_000
#: Values as they stand in the file: quotes doubled inside quotes, white space part of a value.
AS_WRITTEN = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
PIECES = "file string, range bigint, place bigint, kind int, record string"
#: A whole record; the begin of one that goes on in later ranges; what a range has of one that began before.
WHOLE, BEGIN, REST = 0, 1, 2


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(file, range, line)`` in the order of the file within a range; carriage returns stay."""
    text = spark.read.option("lineSep", "\n").text(list(paths))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.col("value").alias("line"))


def quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def range_starts(rows: DataFrame) -> DataFrame:
    """``(file, range, inside)``: whether a range of ``rows(file, range, line)`` begins inside quotes. A row per range of a file
    meets in a task, whatever the file's size."""
    own = rows.groupBy("file", "range").agg((F.sum(quotes(F.col("line"))) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    return own.select("file", "range", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))


def pieces(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Records, and pieces of those that a range cuts, from ``rows(file, range, line)``. ``place`` counts the lines of a range."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, place, held, held_at = None, False, 0, [], 0

        def row(kind: int) -> pa.RecordBatch:
            values = (key[0], key[1], held_at, kind, "\n".join(held))
            return pa.RecordBatch.from_pylist([dict(zip(("file", "range", "place", "kind", "record"), values, strict=True))], schema)

        for batch in batches:
            ranges = batch.column("range").to_numpy()
            files = batch.column("file").dictionary_encode()
            of_file = files.indices.to_numpy()
            cuts = np.flatnonzero((ranges[1:] != ranges[:-1]) | (of_file[1:] != of_file[:-1])) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(ranges)], strict=True):
                if start == stop:
                    continue
                now = (files.dictionary[int(of_file[start])].as_py(), int(ranges[start]))
                if now != key:
                    if held:
                        yield row(BEGIN if not began_inside else REST)
                    key, place, held = now, 0, []
                    inside = began_inside = batch.column("inside")[start].as_py()
                text = batch.column("line").slice(start, stop - start)
                odd = pc.count_substring(text, '"').to_numpy() % 2
                after = (np.cumsum(odd) + inside) % 2  # whether the next line begins inside quotes
                before = np.r_[int(inside), after[:-1]]
                # Lines of a record each: begun and ended outside quotes.
                single = np.flatnonzero((before == 0) & (after == 0))
                if len(single):
                    n, same = len(single), lambda value, kind: pa.repeat(pa.scalar(value, kind), len(single))  # noqa: B023
                    yield pa.RecordBatch.from_arrays(
                        [same(key[0], pa.string()), same(key[1], pa.int64()), pa.array(place + single, pa.int64()), pa.array(np.zeros(n, np.int32)), text.take(pa.array(single))], schema=schema
                    )
                for i in np.flatnonzero((before == 1) | (after == 1)).tolist():
                    if not held:
                        held_at = place + i
                    held.append(text[i].as_py())
                    if after[i] == 0:
                        yield row(REST if began_inside else WHOLE)
                        held, began_inside = [], False
                inside, place = bool(after[-1]), place + stop - start
        if held:
            yield row(REST if began_inside else BEGIN)

    schema = pa.schema([("file", pa.string()), ("range", pa.int64()), ("place", pa.int64()), ("kind", pa.int32()), ("record", pa.string())])
    seen = Observation()
    inside_ones = materialise(starts.where("inside").observe(seen, F.count(F.lit(1)).alias("n")), "ranges-inside")
    if seen.get["n"] <= LISTED:
        met = rows.join(F.broadcast(inside_ones), ["file", "range"], "left")  # rows keep their order
    else:
        numbered = rows.withColumn("id", F.monotonically_increasing_id())
        met = numbered.join(inside_ones, ["file", "range"], "left").sortWithinPartitions("file", "range", "id")
    met = met.select("file", "range", "line", F.coalesce("inside", F.lit(False)).alias("inside"))
    return met.mapInArrow(work, PIECES)


def records(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The header of each file under ``paths`` and all other records, both ``(file, record)``. Quoted line breaks are kept; empty
    lines outside quotes are left out.

    A file is worked on by as many tasks as Spark makes ranges of it. Files are read twice for the places of records and
    once for the records. Lines end with a line feed, after a carriage return or not.
    """
    rows = lines(spark, paths)
    found = pieces(rows, range_starts(rows))
    first = (F.col("range") == 0) & (F.col("place") == 0)
    few = materialise(found.where((F.col("kind") != WHOLE) | first), "records-cut")
    # A record that ranges cut is the begin in one, all of those in between, and the rest in the last.
    begins = F.when(F.col("kind") == BEGIN, F.struct("range", "place"))
    owned = few.where(F.col("kind") != WHOLE).withColumn("at", F.last(begins, ignorenulls=True).over(Window.partitionBy("file").orderBy("range", "place")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "place", "record"))), lambda p: p["record"]), "\n")
    joined = owned.groupBy("file", "at").agg(text.alias("record")).select("file", "at.range", "at.place", "record")
    tidy = lambda df: df.select("file", F.regexp_replace("record", "\r$", "").alias("record"))
    small = few.where(F.col("kind") == WHOLE).select("file", "range", "place", "record").unionByName(joined)
    heads = tidy(small.where(first)).withColumn("record", F.regexp_replace("record", "^\ufeff", ""))
    rest = tidy(found.where((F.col("kind") == WHOLE) & ~first)).unionByName(tidy(joined.where(~first)))
    return heads, rest.where("record <> ''")


def fields(record: Column, width: int) -> Column:
    """The first ``width`` values of a record as a struct; NULL where nothing stands between two commas."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    # Nothing at all is missing, quoted empty text is text: the sign for the first is in no text file.
    return F.from_csv(record, schema, {**AS_WRITTEN, "nullValue": "\x01", "lineSep": "\x02", "maxCharsPerColumn": "-1"})


def listed(parsed: str, width: int) -> Column:
    return F.array(*(F.col(f"{parsed}.c{i}") for i in range(width)))


def whole_path(spark: SparkSession, path: str) -> str:
    """A path with its file system and one slash after the scheme."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub("^([a-z0-9]+):/+", r"\1:/", at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString())


def scan_releases(spark: SparkSession, releases: Sequence[tuple[str, str, str]], required: Mapping[str, str]) -> DataFrame:
    """The ``required`` columns of releases ``(id, release date, path)``, as text, by the header of each file, with ``benchmark_id``
    and ``release_date``. A path is a file or a folder of files. Raises if a file lacks a required column."""
    heads, rest = records(spark, [path for _, _, path in releases])
    seen, commas = Observation(), F.length("record") - F.length(F.replace("record", F.lit(","), F.lit("")))
    heads = materialise(heads.observe(seen, F.max(commas).alias("commas")), "csv-heads")
    width = seen.get["commas"]
    names = [F.lit(name) for name in required]
    tags = spark.createDataFrame([(whole_path(spark, path), name, day) for name, day, path in releases], "path string, benchmark_id string, release_date string")
    width = (width or 0) + 1
    parsed = heads.withColumn("parsed", fields(F.col("record"), width)).withColumn("names", listed("parsed", width))
    at = F.regexp_replace("file", "^([a-z0-9]+):/+", "$1:/")
    tagged = parsed.select("file", "names", F.explode(F.array(at, F.regexp_replace(at, "/[^/]*$", ""))).alias("path")).join(tags, "path")
    places = F.transform(F.array(*names), lambda n: F.array_position("names", n).cast("int"))
    tagged = tagged.select("file", "benchmark_id", F.col("release_date").cast("date").alias("release_date"), places.alias("places"))
    lacking = F.count_if(F.array_contains("places", 0)).alias("lacking")
    layout = materialise(tagged.observe(seen := Observation(), lacking), "csv-layout")
    if seen.get["lacking"]:
        found = layout.where(F.array_contains("places", 0)).first()
        missing = [name for name, place in zip(required, found.places, strict=True) if not place]
        raise CheckFailed(f"Release {found.benchmark_id} lacks required columns: {', '.join(missing)}")
    rows = rest.join(layout, "file").withColumn("parsed", fields(F.col("record"), width)).withColumn("values", listed("parsed", width))
    values = [F.get("values", F.get("places", F.lit(i)) - 1).alias(name) for i, name in enumerate(required.values())]
    return rows.select(*values, "benchmark_id", "release_date")
