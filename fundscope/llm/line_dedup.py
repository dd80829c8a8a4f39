"""Line dedup: drop lines that many documents share, as keep bitmaps.

Native: DataFrame functions only. Each line becomes a 128-bit hash of its key with
its document and position. The hashes are range-partitioned on (hash, document), so
a hot line spans several tasks, and sorted within partitions by hash, document and
position. One streaming pass over that order marks the first occurrence of a line in
each document; the marks are summed to document counts. What comes back per document
is a run-length keep bitmap (runs of kept lines), never text.

Cases: null and empty texts are one empty line. Rows that agree in document id and
text are one document and get the same bitmap. A null id is a value like any other
(rows with a null id and different texts are different documents). Empty tables give
empty results. Only the two named columns are read; others pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.common import HASH_SEED, fresh, key_pair, salted_join, stored

MIN_DOCS = 10
MIN_CHARS = 1
BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       *key_pair(F.col(id_col), text))


def _hashed_lines(base: DataFrame, min_chars: int) -> DataFrame:
    key = line_key(F.col("line"))
    return (base.select("id", "k1", "k2", F.posexplode(_split(F.col("text"))).alias("pos", "line"))
            .select("id", "k1", "k2", "pos", F.xxhash64(key).alias("h1"),
                    F.xxhash64(F.lit(HASH_SEED), key).alias("h2"),
                    F.char_length(key).alias("chars"))
            .where(F.col("chars") >= min_chars).drop("chars"))


def _runs(drops: Column, n_lines: Column) -> Column:
    """Runs of kept lines (start, length) from the sorted dropped positions."""
    starts = F.filter(drops, lambda x, i: (i == 0) | (F.get(drops, i - 1) != x - 1))
    ends = F.filter(drops, lambda x, i: (i == F.size(drops) - 1) | (F.get(drops, i + 1) != x + 1))
    edges = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x + 1)).alias("a"),
        F.concat(starts, F.array(n_lines)).alias("b"))
    return F.filter(F.transform(edges, lambda e: F.struct(
        e["a"].alias("start"), (e["b"] - e["a"]).alias("length"))), lambda r: r["length"] > 0)


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 keep_first: bool = False) -> DataFrame:
    """Documents that lose lines: ``k1, k2, drops`` (sorted positions).

    A key found in ``min_docs`` documents or more is dropped everywhere, or, with
    ``keep_first``, everywhere but at its first place by (id, position).
    """
    # written once: the sampling of ranges, the counts and the join all read hashes, not texts
    lines = stored(_hashed_lines(_keyed(docs, id_col, text_col), min_chars), "line-hashes")
    ordered = (lines.repartitionByRange("h1", "h2", "k1", "k2")
               .sortWithinPartitions("h1", "h2", "k1", "k2", "pos"))
    first = F.row_number().over(Window.partitionBy("h1", "h2", "k1", "k2").orderBy("pos"))
    firsts = ordered.withColumn("nth", first).where("nth = 1")
    aggs = [F.count(F.lit(1)).alias("n_docs")]
    if keep_first:
        aggs.append(F.min(F.struct("id", "k1", "k2", "pos")).alias("first"))
    shared = firsts.groupBy("h1", "h2").agg(*aggs).where(F.col("n_docs") >= min_docs).drop("n_docs")
    hits = salted_join(lines, shared, ["h1", "h2"], F.col("k1"))
    if keep_first:
        hits = hits.where(~F.struct("id", "k1", "k2", "pos").eqNullSafe(F.col("first")))
    return (hits.groupBy("k1", "k2")
            .agg(F.sort_array(F.collect_set("pos")).alias("drops")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               keep_first: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_lines``, ``n_dropped`` and ``keep_runs``.

    ``keep_runs`` is the compressed bitmap: array of (start, length) of kept lines.
    New columns whose name is taken get a trailing underscore.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = line_bitmaps(docs, id_col, text_col, min_docs, min_chars, keep_first)
    names = [fresh(docs, n) for n in ("line_k1", "line_k2", "line_drops")]
    marks = marks.toDF(*names).hint("shuffle_hash")
    k1, k2 = key_pair(F.col(id_col), text)
    keyed = docs.withColumns({names[0]: k1, names[1]: k2})
    joined = keyed.join(marks, names[:2], "left").drop(*names[:2])
    drops = F.coalesce(F.col(names[2]), F.array().cast("array<int>"))
    n_lines = F.size(_split(F.col(text_col)))
    return joined.select(*[F.col(c) for c in docs.columns],
                         n_lines.cast("long").alias(fresh(docs, "n_lines")),
                         F.size(drops).cast("long").alias(fresh(docs, "n_dropped")),
                         _runs(drops, n_lines).alias(fresh(docs, "keep_runs")))


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The kept lines joined by newline; linear in the number of lines."""
    lines = _split(text)
    return F.array_join(F.flatten(F.transform(
        keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
