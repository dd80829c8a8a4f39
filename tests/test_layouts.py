"""Inferred schemas, laid-out tables, stored sketches, counts of url classes."""
import pathlib
import re
import time
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.operators import shape, stats
from fundscope.plans import catalog
from fundscope.sources import files, schemas, tables


def by_name(t):
    """A schema without the order of its fields; a field that was never set is text."""
    if isinstance(t, T.StructType):
        return {f.name: by_name(f.dataType) for f in t.fields}
    return t.simpleString()


def test_inferred_schema_equals_the_declared_one(spark, sf, scratch):
    raw = tables.raw_campaigns(spark, sf).withColumn("data", F.col("data").withField(
        "converted_pledged_amount", F.lit(5).cast("long")))
    raw.write.json(f"{scratch}/crawl")
    lines = spark.read.text(f"{scratch}/crawl")
    found, want = by_name(files.infer_json_schema(lines)), by_name(schemas.RAW_RECORD)
    assert set(found["data"]) <= set(want["data"]) and len(found["data"]) > 10
    assert all(found["data"][c] == want["data"][c] for c in found["data"])


def test_broken_lines_are_returned(spark, scratch):
    lines = ['{"a": 1, "b": {"c": 1.5}}', '{"a": 2, "b": {"c": 2, "d": "x"}, "e": [1, 2]}', '{"a": 3', "7",
             "[1]", "", "   ", "null", '{"n": null}', "not json"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(f"{scratch}/in")
    rows, bad = files.read_inferred_json(spark, f"{scratch}/in")
    assert rows.schema.simpleString() == ("struct<a:bigint,b:struct<c:double,d:string>,e:array<bigint>,n:string>")
    assert sorted((r.a or 0, r.b.c if r.b else 0.0) for r in rows.collect()) == [(0, 0.0), (1, 1.5), (2, 2.0)]
    assert sorted(r.value for r in bad.collect()) == sorted(['{"a": 3', "7", "[1]", "null", "not json"])
    assert all(r.file_name for r in bad.collect())
    spark.createDataFrame([], "value string").write.text(f"{scratch}/none")
    assert files.infer_json_schema(spark.read.text(f"{scratch}/none")) == T.StructType([])


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_laid_out_tables_need_no_exchange(spark, sf):
    crawl, lengths, names = catalog.laid_out(spark, sf)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        first = shape.dedupe_by_key(crawl.select("id", "name"), ["id"], order=["name"])
        longest = lengths.groupBy("id").agg(F.max("name_chars").alias("longest"))
        for df in (first, shape.attach_by_key(first, longest, "id", ["longest"])):
            assert not re.search(r"\bExchange\b", final_plan(df))
        plain = crawl.select("id", "name").repartition(3)
        assert "Exchange" in final_plan(shape.dedupe_by_key(plain, ["id"], order=["name"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            spark.sql(f"DROP TABLE {name}")
    catalog.laid_out_tables(spark, sf).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("fundscope_laid_")]


def test_sketches_are_united_by_any_grouping(spark, scratch):
    rows = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 3).alias("shop"),
                                      (F.col("id") % 20_011).alias("name"))
    name = f"{scratch}/{uuid.uuid4().hex}"
    stats.distinct_sketches(rows, ["month", "shop"], ["name"]).write.parquet(name)
    kept = spark.read.parquet(name)
    for by in ([], ["month"], ["shop"], ["month", "shop"]):
        exact = {tuple(r)[:-1]: r.n for r in rows.groupBy(*by).agg(F.count_distinct("name").alias("n")).collect()}
        near = {tuple(r)[:-1]: r.name_estimate for r in stats.united_estimates(kept, by, ["name"]).collect()}
        assert near.keys() == exact.keys()
        assert all(abs(near[k] - exact[k]) <= 4 * stats.sketch_error() * exact[k] for k in exact)


def test_url_classes_tell_how_many_pairs_there_are(spark):
    rows = [(1, "a", "u"), (2, "a", "u"), (3, "b", "u"), (4, "c", "u"), (5, "a", "v"), (6, "a", "v"),
            (7, None, "u"), (8, "x", None)]
    df = spark.createDataFrame(rows, "id long, name string, url string").withColumn("launched_at", F.lit(0))
    got = {r.id: (r.url_rows, r.partners) for r in shape.same_url_conflicts(df).collect()}
    pairs = {i: sum(bool(u == w and n and m and n != m) for j, m, w in rows) for i, n, u in rows if n and u}
    assert got == {i: (4, n) for i, n in pairs.items() if n}


def test_compressed_exports_hold_every_row(spark, scratch, monkeypatch):
    rows = [(i, f"line {i}\nnext, \"quoted\"\n" + "word " * 200) for i in range(25)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    monkeypatch.setattr(files, "ROWS_PER_FILE", 10)
    files.write_json(df, f"{scratch}/json", compressed=True)
    files.write_csv(df, f"{scratch}/csv", compressed=True)
    files.write_lines(df.select("text"), f"{scratch}/text", compressed=True)
    for kind in ("json", "csv", "text"):
        names = spark.read.text(f"{scratch}/{kind}").inputFiles()
        assert len(names) == 3 and all(n.endswith(".gz") for n in names)
    back = [spark.read.schema(df.schema).json(f"{scratch}/json"),
            files.read_scraped_csv(spark, f"{scratch}/csv", df.schema, row_col=None).select("id", "text")]
    assert all(sorted(tuple(r) for r in b.collect()) == rows for b in back)


def test_campaign_exports_are_compressed(spark, sf):
    for name in ("json_round_trip", "csv_round_trip", "inferred_json", "slice_round_trip"):
        names = catalog.QUERIES[name](spark, sf).inputFiles()
        assert names and all(n.endswith(".gz") for n in names), name


def shuffled_bytes(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in map(found.apply, range(found.size())) if f.getName().endswith(".data"))


def test_the_csv_export_shuffles_texts_once_and_drops_what_it_shuffled(spark, sf, monkeypatch):
    """both joins shuffled the texts, and these files lay beside the export."""
    plans, real = [], files.write_csv

    def write_csv(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        real(df, *args, **kwargs)

    monkeypatch.setattr(files, "write_csv", write_csv)
    set_to = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in set_to}
    before = shuffled_bytes(spark) + 1000                 # the counts of documents stay
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        back = catalog.QUERIES["csv_round_trip"](spark, sf)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"[-:] Exchange hashpartitioning\((?:d_)?doc_id", plans[0])) == 1
    assert len(re.findall(r"ReusedExchange \[d_doc_id", plans[0])) == 1
    end = time.time() + 20                                 # files are deleted in the background
    while shuffled_bytes(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffled_bytes(spark) <= before and back.count() == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_compressed_csv_finds_texts_that_come_again(spark, scratch):
    """at the fastest level rows that hold a text twice took half as much again."""
    words = [f"{a}{b}" for a in ("th", "on", "er", "in") for b in ("at", "ing", "ed", "ou", "es")]
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(400)), lambda i: F.element_at(
        F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", i), F.lit(20)) + 1).cast("int"))), " ")
    df = spark.range(200).withColumn("a", text).withColumn("b", F.col("a")).coalesce(1)
    files.write_csv(df, f"{scratch}/csv", compressed=True)
    files._writer(df, "errorifexists", True).csv(f"{scratch}/fastest")
    sizes = [sum(p.stat().st_size for p in pathlib.Path(f"{scratch}/{d}").glob("*.gz")) for d in ("csv", "fastest")]
    assert sizes[0] < 0.85 * sizes[1]
