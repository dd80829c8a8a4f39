"""Delimited description records: assembly, repair, completeness, merge.

A description file ``project_description_<lo>_<hi>.txt`` holds records
``<index>|<text>`` for ``index`` in ``[lo, hi)``, joined by a newline; the text
may itself hold newlines and ``<digits>|``. Rule: a marker opens a record only
if it carries the next expected number of its file (starting at ``lo``); when
that number also appears later at a line start, the line-start one wins.
Everything else folds back into the record before it, word for word.

Each file is one row (``wholetext``), parsed in one pass over its markers inside
``mapInArrow``: linear in the file, parallel across files, no shuffle. (The same walk
as SQL array functions copies its state at every marker, so its cost grew with the
square of the markers.) Completeness (T4) is plain SQL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_PATTERN = r"project_description_([0-9]+)_([0-9]+)"
# A marker: digits not preceded by a digit, then '|'.
MARKER = re.compile(r"(?<![0-9])([0-9]+)\|")


def _file_range(df: DataFrame, name_col: str) -> DataFrame:
    return df.withColumns({
        "lo": F.regexp_extract(name_col, FILE_PATTERN, 1).try_cast("bigint"),
        "hi": F.regexp_extract(name_col, FILE_PATTERN, 2).try_cast("bigint"),
    })


LINE_START_MARKER = r"(?:^|\n)([0-9]+)\|"


def split_records(value: str, lo: int, hi: int) -> list[tuple[int, str]]:
    """``(idx, text)`` of one file; stops at the first index that no marker opens.

    The newline that joined two records is removed from the earlier one; the last
    record keeps its text as is.
    """
    marks = [(int(m[1]), m.start() == 0 or value[m.start() - 1] == "\n", m.start(), m.end())
             for m in MARKER.finditer(value)]
    last_at_line_start = {number: i for i, (number, at_start, *_) in enumerate(marks) if at_start}
    opened: list[tuple[int, int, int]] = []
    expected = lo
    for i, (number, at_start, start, end) in enumerate(marks):
        if number == expected < hi and (at_start or last_at_line_start.get(number, -1) < i):
            opened.append((number, start, end))
            expected += 1
    ends = [start for _, start, _ in opened[1:]]
    texts = [value[end:stop].removesuffix("\n") for (_, _, end), stop in zip(opened, ends)]
    if opened:
        texts.append(value[opened[-1][2]:])
    return [(number, text) for (number, _, _), text in zip(opened, texts, strict=True)]


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, value, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = split_records(value or "", lo, hi)
            yield pa.RecordBatch.from_pydict({                  # one file at a time
                "file_name": pa.array([name] * len(found), pa.string()),
                "idx": pa.array([i for i, _ in found], pa.int64()),
                "text": pa.array([t for _, t in found], pa.string()),
                "complete": pa.array([lo + len(found) >= hi] * len(found), pa.bool_())})


def assemble_records(files: DataFrame, name_col: str = "file_name",
                     value_col: str = "value") -> DataFrame:
    """T2+T3: ``(file_name, value)`` whole files -> ``(file_name, idx, text, complete)``.

    ``complete`` is false on every record of a file in which some index of its range was
    opened by no marker: there the last record holds the rest of the file.
    """
    df = _file_range(files.select(F.col(name_col).alias("file_name"),
                                  F.col(value_col).alias("value")), "file_name")
    return (df.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
            .mapInArrow(_assemble, "file_name string, idx long, text string, complete boolean"))


def missing_records(files: DataFrame, name_col: str = "file_name",
                    value_col: str = "value") -> DataFrame:
    """T4: indexes in a file's range with no line-start marker: ``(file_name, idx)``.

    Computed from the markers, not from the assembled records, so a missing
    record is reported even though it stalls the assembly chain.
    """
    df = _file_range(files.select(F.col(name_col).alias("file_name"),
                                  F.col(value_col).alias("value")), "file_name")
    found = F.array_distinct(F.transform(
        F.regexp_extract_all("value", F.lit(LINE_START_MARKER), 1), lambda s: s.cast("bigint")))
    df = df.where(F.col("lo").isNotNull() & (F.col("hi") > F.col("lo")))
    df = df.withColumn("found", found)
    # array_except works through a hash set: linear in range and markers
    missing = F.array_except(F.sequence("lo", F.col("hi") - 1), F.col("found"))
    return (df.select("file_name", F.explode_outer(missing).alias("idx"))
            .where(F.col("idx").isNotNull()))


def record_counts(files: DataFrame, name_col: str = "file_name",
                  value_col: str = "value") -> DataFrame:
    """T4: per file, expected range size and distinct markers found at line starts."""
    df = _file_range(files.select(F.col(name_col).alias("file_name"),
                                  F.col(value_col).alias("value")), "file_name")
    marks = F.transform(F.regexp_extract_all("value", F.lit(LINE_START_MARKER), 1),
                        lambda s: s.cast("bigint"))
    found = F.size(F.array_distinct(F.filter(
        marks, lambda k: (k >= F.col("lo")) & (k < F.col("hi")))))
    return df.select("file_name", (F.col("hi") - F.col("lo")).alias("expected"),
                     found.alias("found"))


def assert_complete(files: DataFrame, **kw) -> None:
    """Fail loudly when any file misses a record (one bounded ``take``)."""
    gaps = missing_records(files, **kw).take(5)
    if gaps:
        raise ValueError(f"missing records, e.g. {[(r.file_name, r.idx) for r in gaps]}")


def description_files(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      batch: int = 500) -> DataFrame:
    """Write-side twin (S11 format, unescaped): ``(file_name, value)`` per key batch.

    Batch ``b`` holds keys ``[b*batch, ...)``; its range ends at the largest key
    present + 1. One group per batch, so a group holds at most ``batch`` rows
    when the key is unique.
    """
    b = F.floor(F.col(key) / batch).cast("bigint")
    grouped = (docs.select(b.alias("b"), F.col(key).alias("k"), F.col(text).alias("t"))
               .groupBy("b")
               .agg(F.max("k").alias("kmax"),
                    F.array_sort(F.collect_list(F.struct("k", "t"))).alias("recs")))
    value = F.array_join(F.transform("recs", lambda r: F.concat(
        r["k"].cast("string"), F.lit("|"), F.coalesce(r["t"], F.lit("")))), "\n")
    name = F.concat(F.lit("project_description_"), (F.col("b") * batch).cast("string"),
                    F.lit("_"), (F.col("kmax") + 1).cast("string"), F.lit(".txt"))
    return grouped.select(name.alias("file_name"), value.alias("value"))


def merge_scraped(scraped: DataFrame, name_col: str = "file_name",
                  row_col: str = "row_idx") -> DataFrame:
    """T5: each scraped batch file is trusted only for the rows of its own range."""
    pattern = r"project_scraped_([0-9]+)_([0-9]+)"
    lo = F.regexp_extract(name_col, pattern, 1).try_cast("bigint")
    hi = F.regexp_extract(name_col, pattern, 2).try_cast("bigint")
    return scraped.where((F.col(row_col) >= lo) & (F.col(row_col) < hi))
