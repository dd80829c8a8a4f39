"""Record assembly of files of any size (T2+T3): a segmented scan.

``records.assemble_records`` takes a whole file as one row. Here the splits of Spark's text
reader are the segments of a file, and no step holds a file:

1. Markers: every line gives its own; a line has its segment (where its split starts in the
   file) and its place there.
2. Candidates: a marker stays if it stands at a line start, or if no marker of its number stands
   at a line start further on (an aggregate by number, joined back).
3. A segment's effect is a function: the number expected on entry -> the number expected after
   it. It is constant over long stretches, since a segment with the records 100 to 199
   maps all of 100 to 199 to 200: a segment gives a row for each such stretch.
4. A fold over a file's segments, in order, carries the expected number along: its input is a few
   numbers for each segment.
5. With its entry number each segment opens its records, and lines are cut at the opened
   markers. The pieces of a record are joined in order, over segments too.

Same rows as ``records.split_records``, for the same rule. Every step but 4 is spread over segments
or keys; a record has to fit in a row. Lines are stored once in the shared folder, so that all
steps see the same segments and places.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundscope.operators.joins import salted_join
from fundscope.operators.records import FILE_PATTERN, MARKER
from fundscope.session import stored_table

LINE_SHIFT = 1 << 31                        # a marker's place: line number x LINE_SHIFT + offset


def read_lines(spark: SparkSession, path: str, name_from: str | None = None) -> DataFrame:
    """``file, lo, hi, seg, line, value, bytes``: the lines of description files, by split.

    ``bytes`` is the file's size (tells whether a newline ends the file). ``name_from`` takes
    the name from the file's path by a pattern with one group.
    """
    meta = F.col("_metadata")
    name = F.regexp_extract(meta["file_path"], name_from, 1) if name_from else meta["file_name"]
    rows = (spark.read.option("lineSep", "\n").text(path)
            .select("value", name.alias("file"), meta["file_block_start"].alias("seg"),
                    meta["file_size"].alias("bytes"), F.monotonically_increasing_id().alias("line")))
    rows = rows.withColumns({"lo": F.regexp_extract("file", FILE_PATTERN, 1).try_cast("bigint"),
                             "hi": F.regexp_extract("file", FILE_PATTERN, 2).try_cast("bigint")})
    rows = rows.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    lines = stored_table(rows, "file-lines")
    first = lines.groupBy("file", "seg").agg(F.min("line").alias("first_line"))
    # line numbers from 0 in each segment
    return (lines.join(F.broadcast(first), ["file", "seg"])          # one row for each split
            .select("file", "lo", "hi", "seg", (F.col("line") - F.col("first_line")).alias("line"),
                    "value", "bytes"))


MARKS = "file string, lo long, seg long, at long, stop int, number long, at_start boolean"

TYPES = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "lo", "seg", "at", "stop", "number", "at_start"]
    for batch in batches:
        found: list[list] = [[] for _ in names]
        columns = [batch.column(c).to_pylist() for c in ("file", "lo", "hi", "seg", "line", "value")]
        for file, lo, hi, seg, line, value in zip(*columns, strict=True):
            for m in MARKER.finditer(value or ""):
                if len(m[1]) < 19 and lo <= int(m[1]) < hi:
                    for c, x in zip(found, (file, lo, seg, line * LINE_SHIFT + m.start(), m.end(),
                                            int(m[1]), m.start() == 0), strict=True):
                        c.append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(found, TYPES, strict=True)], names)


def candidates(lines: DataFrame) -> DataFrame:
    """``file, lo, seg, at, stop, number``: markers that may open a record."""
    marks = stored_table(lines.select("file", "lo", "hi", "seg", "line", "value").mapInArrow(_marks, MARKS),
                         "markers")
    last = marks.where("at_start").groupBy("file", "number").agg(
        F.max(F.struct("seg", "at")).alias("last"))
    kept = salted_join(marks, last, ["file", "number"], F.struct("seg", "at"), "left")
    after = F.col("last").isNull() | (F.struct("seg", "at") > F.col("last"))
    return stored_table(kept.where(F.col("at_start") | after).select("file", "lo", "seg", "at", "stop", "number"),
                        "candidates")


def stretches(numbers: list[int]) -> list[tuple[int, int, int]]:
    """(first, last, exit): a segment's function, from its candidates in order.

    A number outside all stretches is its own exit.
    """
    exits: dict[int, int] = {}
    for n in reversed(numbers):
        exits[n] = exits.get(n + 1, n + 1)                 # the nearest n to the right counts
    out: list[list[int]] = []
    for n in sorted(exits):
        if out and out[-1][1] == n - 1 and out[-1][2] == exits[n]:
            out[-1][1] = n
        else:
            out.append([n, n, exits[n]])
    return [tuple(x) for x in out]


def _segment_function(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("at")
    found = stretches(rows["number"].to_pylist())
    same = {c: [rows[c][0].as_py()] * len(found) for c in ("file", "lo", "seg")}
    return pa.table({**same, "first": [x[0] for x in found], "last": [x[1] for x in found],
                     "exit": [x[2] for x in found]}, schema=FUNCTION)


FUNCTION = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("lo", "seg", "first", "last", "exit")]])


def _fold(rows: pa.Table) -> pa.Table:
    """The expected number on entry to each of a file's segments."""
    by_seg: dict[int, list[tuple[int, int, int]]] = {}
    for r in rows.to_pylist():
        by_seg.setdefault(r["seg"], []).append((r["first"], r["last"], r["exit"]))
    file, expected, entries = rows["file"][0].as_py(), rows["lo"][0].as_py(), []
    for seg in sorted(by_seg):
        entries.append(expected)
        expected = next((x for a, b, x in by_seg[seg] if a <= expected <= b), expected)
    return pa.table({"file": [file] * len(entries), "seg": sorted(by_seg), "entry": entries})


def _open(rows: pa.Table) -> pa.Table:
    """The candidates that open a record, given the number expected on entry."""
    rows = rows.sort_by("at")
    expected, at = rows["entry"][0].as_py(), []
    for place, stop, number in zip(*(rows[c].to_pylist() for c in ("at", "stop", "number")), strict=True):
        if number == expected:
            at.append((place, stop, number))
            expected += 1
    same = {c: pa.array([rows[c][0].as_py()] * len(at), t) for c, t in (("file", pa.string()), ("seg", pa.int64()))}
    return pa.table({**same, "at": pa.array([a for a, _, _ in at], pa.int64()),
                     "stop": pa.array([e for _, e, _ in at], pa.int32()),
                     "idx": pa.array([n for _, _, n in at], pa.int64())})


def opened_markers(lines: DataFrame) -> DataFrame:
    """``file, seg, at, stop, idx``: the markers that open a record."""
    marks = candidates(lines)
    function = marks.groupBy("file", "seg").applyInArrow(
        _segment_function, "file string, lo long, seg long, first long, last long, exit long")
    entries = function.groupBy("file").applyInArrow(_fold, "file string, seg long, entry long")
    return stored_table(marks.join(entries, ["file", "seg"]).groupBy("file", "seg").applyInArrow(
        _open, "file string, seg long, at long, stop int, idx long"), "opened")


def assemble_large(lines: DataFrame) -> DataFrame:
    """``file_name, idx, text, complete`` from ``read_lines``, as ``records.assemble_records``."""
    opened = opened_markers(lines)
    line = F.floor(F.col("at") / LINE_SHIFT).cast("long")
    cuts = opened.groupBy("file", "seg", line.alias("line")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("at") % LINE_SHIFT).cast("int").alias("p"), "stop", "idx"))).alias("cuts"))
    rows = lines.join(cuts, ["file", "seg", "line"], "left")
    # a record that goes on from the line, or the segment, before
    in_segment = Window.partitionBy("file", "seg").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    last_idx = F.element_at("cuts", -1)["idx"]
    ends = opened.groupBy("file", "seg").agg(F.max("idx").alias("top"))
    segs = lines.groupBy("file", "seg").agg(F.count("*").alias("n_lines"),
                                            F.sum(F.octet_length("value") + 1).alias("held"),
                                            F.first("bytes").alias("bytes"))
    before = Window.partitionBy("file").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    segs = (segs.join(ends, ["file", "seg"], "left")
            .select("file", "seg", F.max("top").over(before).alias("carried"),
                    F.max("top").over(whole).alias("file_top"),
                    (F.sum("held").over(whole) == F.col("bytes")).alias("newline_ends")))
    rows = (rows.withColumn("own", F.last(last_idx, ignorenulls=True).over(in_segment))
            .join(segs, ["file", "seg"]).withColumn("goes_on", F.coalesce("own", "carried")))
    # pieces of a line: what goes on, then the text after each marker
    head = F.when(F.col("cuts").isNull(), F.col("value")).otherwise(
        F.substring("value", F.lit(1), F.col("cuts")[0]["p"]))
    goes_on = F.when(F.col("goes_on").isNotNull() & (F.col("cuts").isNull() | (F.col("cuts")[0]["p"] > 0)),
                     F.array(F.struct(F.col("goes_on").alias("idx"), head.alias("text"))))
    until = lambda i: F.coalesce(F.get(F.col("cuts"), i + 1)["p"], F.length("value"))
    pieces = F.transform("cuts", lambda c, i: F.struct(
        c["idx"].alias("idx"), F.substring("value", c["stop"] + 1, until(i) - c["stop"]).alias("text")))
    pieces = F.concat(F.coalesce(goes_on, F.array().cast("array<struct<idx:bigint,text:string>>")),
                      F.coalesce(pieces, F.array().cast("array<struct<idx:bigint,text:string>>")))
    parts = rows.select("file", "lo", "hi", "seg", "line", "file_top", "newline_ends",
                        F.posexplode(pieces).alias("k", "piece"))
    ordered = F.array_sort(F.collect_list(F.struct("seg", "line", "k", F.col("piece.text").alias("text"))))
    out = (parts.groupBy("file", F.col("piece.idx").alias("idx"))
           .agg(ordered.alias("p"), F.first("hi").alias("hi"), F.first("file_top").alias("file_top"),
                F.first("newline_ends").alias("newline_ends")))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    last = (F.col("idx") == F.col("file_top")) & F.col("newline_ends")
    return out.select(F.col("file").alias("file_name"), "idx",
                      F.when(last, F.concat(text, F.lit("\n"))).otherwise(text).alias("text"),
                      (F.col("file_top") + 1 >= F.col("hi")).alias("complete"))
