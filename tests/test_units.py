"""Hand-made rows: edges, nulls, repeatability, round trips."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscope.functions import columns as C
from fundscope.operators import metrics, pages, records, sampling, shape, stats
from fundscope.plans import features as feat
from fundscope.sources import files, schemas


def test_goal_bin_edges_and_null(spark):
    df = spark.createDataFrame([(v,) for v in (14999.99, 15000.0, 34999.99, 35000.0,
                                                54999.99, 55000.0, None)], "goal double")
    got = [r[0] for r in df.select(C.goal_bin("goal")).collect()]
    assert got == [1, 2, 2, 3, 3, 4, 4]
    fine = [r[0] for r in spark.createDataFrame(
        [(99999.0,), (100000.0,), (250000.0,), (None,)], "goal double")
        .select(C.bin_by_edges("goal", C.GOAL_EDGES_FINE)).collect()]
    assert fine == [4, 5, 7, 7]


def test_flags_and_nulls(spark):
    df = spark.createDataFrame([(True, "US", "successful", " x"), (False, None, None, "\n"),
                                (None, "DE", "canceled", None)],
                               "sp boolean, country string, state string, t string")
    rows = df.select(C.bool_to_int("sp").alias("sp"),
                     C.indicator(F.col("country") == "US").alias("us"),
                     C.recode_state("state").alias("st"),
                     C.has_text("t").alias("ht")).collect()
    assert [tuple(r) for r in rows] == [(1, 1, "successful", 1), (0, 0, "other", 0),
                                        (0, 0, "other", 0)]


def test_epoch_to_date_around_midnight(spark):
    df = spark.createDataFrame([(86399,), (86400,), (-1,)], "e long")
    got = [r[0] for r in df.select(C.epoch_to_date("e")).collect()]
    assert got == [dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1969, 12, 31)]
    # independent of the session time zone
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert [r[0] for r in df.select(C.epoch_to_date("e")).collect()] == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_split_first(spark):
    df = spark.createDataFrame([("technology/apps",), ("games",), (None,)], "s string")
    assert [r[0] for r in df.select(C.split_first("s")).collect()] == ["technology", "games",
                                                                       None]


def test_feature_filters(spark):
    rows = [(1, "a", "b", 1.0, "live", "US", dt.date(2016, 1, 1), dt.date(2016, 1, 2),
             dt.date(2016, 2, 1), True, "technology", "Apps"),
            (2, "a", None, 20000.0, "failed", "US", dt.date(2015, 12, 31), dt.date(2016, 1, 2),
             dt.date(2016, 2, 1), None, "technology", "Apps"),
            (3, "name", None, 20000.0, "successful", "GB", dt.date(2016, 1, 1),
             dt.date(2016, 1, 11), dt.date(2016, 3, 1), None, "technology", "Robots")]
    df = spark.createDataFrame(rows, "id long, name string, blurb string, goal double, "
                               "state string, country string, created_at date, "
                               "launched_at date, deadline date, staff_pick boolean, "
                               "mainCategory string, subCategory string")
    out = feat.campaign_features(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.id, r.staff_pick, r.blurblen, r.namelen, r.countryUS, r.campaignlen,
            r.preparelen, r.newsubCategory, r.monthdead, r.monthLaunched, r.goalBin,
            r.label) == (3, 0, None, 4, 0, 50, 10, "Other", 3, 1, 2, 1)


def test_dedupe_is_idempotent_and_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 1), (2, "c", 0)],
                               "id long, name string, v long")
    once = shape.dedupe_by_key(df, ["id"], order=["name"])
    twice = shape.dedupe_by_key(once, ["id"], order=["name"])
    got = sorted(tuple(r) for r in once.collect())
    assert got == [(1, "a", 3), (2, "c", 0)]
    assert sorted(tuple(r) for r in twice.collect()) == got
    again = shape.dedupe_by_key(df.repartition(3), ["id"], order=["name"])
    assert sorted(tuple(r) for r in again.collect()) == got


def test_same_url_conflicts(spark):
    df = spark.createDataFrame([(1, "x", "u1"), (2, "y", "u1"), (3, "z", "u2"),
                                (4, "z", "u2"), (5, None, "u1")],
                               "id long, name string, url string").withColumn(
        "launched_at", F.lit(None).cast("date"))
    got = sorted((r.id, r.other_name) for r in shape.same_url_conflicts(df).collect())
    assert got == [(1, "y"), (2, "x")]


def test_later_duplicates(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "a")], "k long, t string")
    got = sorted((r.k, r.first_k) for r in shape.later_duplicates(df, "t", "k").collect())
    assert got == [(2, 0), (3, 0)]
    nulls = spark.createDataFrame([(0, None), (1, "x"), (2, None)], "k long, t string")
    got = [(r.k, r.first_k) for r in shape.later_duplicates(nulls, "t", "k").collect()]
    assert got == [(2, 0)]


def test_split_is_partition_and_repartition_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "id")
    a, b = sampling.keyed_split(df, "id")
    ids_a = {r.id for r in a.collect()}
    ids_b = {r.id for r in b.collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 2000
    a2, _ = sampling.keyed_split(df.repartition(7), "id")
    assert {r.id for r in a2.collect()} == ids_a
    assert 0.70 < len(ids_a) / 2000 < 0.80


def test_rebalance_equal_and_repeatable(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    r1 = sampling.rebalance(df, oversample=200, per_class=500)
    counts = {r.label: r["count"] for r in r1.groupBy("label").count().collect()}
    assert counts == {0: 500, 1: 500}
    r2 = sampling.rebalance(df.repartition(5), oversample=200, per_class=500)
    key = lambda d: sorted((r.id, r.copy_no) for r in d.collect())
    assert key(r1) == key(r2)


def test_first_n_matches_a_plain_sort(spark, monkeypatch):
    from fundscope.functions.columns import hash_unit
    df = spark.range(5000).select("id")
    ordered = [r.id for r in df.orderBy(hash_unit(9, F.col("id")), "id").collect()]
    for bits in (16, 1, 0):
        monkeypatch.setattr(sampling, "BUCKET_BITS", bits)
        for n in (0, 1, 1234, 5000, 9000):
            got = sorted(r.id for r in sampling.first_n_by_hash(df, n, 9, "id").collect())
            assert got == sorted(ordered[:n]), (bits, n)


def test_rows_without_a_key_train(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "id long")
    train, test = sampling.keyed_split(df)
    assert train.count() + test.count() == 3
    assert train.where("id is null").count() == 1


def test_histogram_max_on_last_edge_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,)], "x double")
    h = stats.histogram(df, "x", bins=5).collect()
    assert [r["count"] for r in h] == [2, 0, 1, 0, 1]
    assert sum(r["count"] for r in h) == 4
    c = stats.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert [r["count"] for r in c] == [2, 0, 0, 0]
    vals = np.random.default_rng(1).normal(size=500)
    d = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r["count"] for r in stats.histogram(d, "x", bins=13).collect()]
    assert got == list(np.histogram(vals, bins=13)[0])


def test_exact_quantiles_match_numpy(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.exponential(size=3000), np.full(1500, 2.5)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    monkeypatch.setattr(stats, "QUANTILE_BUCKETS", 16)
    d = stats.describe(df, "x").first()
    for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        assert math.isclose(d[name], float(np.quantile(vals, q)), rel_tol=1e-12)
    assert d["count"] == len(vals)


@pytest.mark.parametrize("extra", [[], [float("inf")] * 3, [float("-inf"), float("inf")],
                                   [-1.7e308, 1.7e308], [5e-324, 1e-323, 0.0]])
def test_order_statistics_end_on_wide_and_infinite_ranges(spark, extra):
    vals = [float(x) for x in np.random.default_rng(2).normal(size=300)] + extra
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "x double")
    ranks = [0, 1, 75, 150, len(vals) - 2, len(vals) - 1]
    got = stats.exact_order_stats(df, "x", ranks)
    assert [got[r] for r in ranks] == [sorted(vals)[r] for r in ranks]
    assert stats.exact_order_stats(df.where("x is null"), "x", [0]) == {}
    assert stats.describe(df, "x").first()["count"] == len(vals)


def test_metrics_edge_cases(spark):
    one_class = spark.createDataFrame([(1, 1), (1, 0)], "label int, prediction int")
    prf = {r.label: (r.precision, r.recall, r.f1)
           for r in metrics.prf_by_label(one_class).collect()}
    assert prf[0] == (0.0, 0.0, 0.0)
    assert prf[1] == (1.0, 0.5, pytest.approx(2 / 3))
    conf = {r.label: (r.pred_0, r.pred_1) for r in metrics.confusion(one_class).collect()}
    assert conf == {1: (1, 1)}


def test_auc_score_matches_brute_force(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(3)
    rows = [(int(y), float(np.round(rng.normal() + y, 1))) for y in rng.integers(0, 2, 800)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.auc_score(df).first()[0] == pytest.approx(brute, abs=1e-12)
    for parts in ("1", "3", "64"):                     # one, several and empty score ranges
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert metrics.auc_score(df).first()[0] == pytest.approx(brute, abs=1e-12)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # MLlib agrees once -0.0 is written as 0.0 (its RDD path keys doubles by Java
    # equality, which tells -0.0 from 0.0; SQL grouping does not).
    from pyspark.ml.functions import array_to_vector
    z = df.select(F.col("label").cast("double").alias("label"),
                  array_to_vector(F.array(-(F.col("score") + 0.0), F.col("score") + 0.0))
                  .alias("raw"))
    ml = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(z)
    assert ml == pytest.approx(brute, abs=1e-12)
    hard = df.select("label", (F.col("score") > 0.5).cast("int").alias("prediction"))
    ours_hard = metrics.auc_hard(hard).first()[0]
    hv = hard.select(F.col("label").cast("double").alias("label"),
                     F.col("prediction").cast("double").alias("prediction"))
    ml_hard = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(hv)
    assert ours_hard == pytest.approx(ml_hard, abs=1e-12)


def test_auc_of_one_class_and_of_huge_counts(spark, monkeypatch):
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert metrics.auc_score(one).first()[0] is None
    huge = spark.createDataFrame([(0.1, 5 * 10**9, 0), (0.9, 0, 5 * 10**9)],
                                 "score double, neg long, pos long")
    monkeypatch.setattr(metrics, "_score_counts", lambda *_: huge)
    assert metrics.auc_score(one).first()[0] == 1.0


def test_fixture_auc_values(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    assert q["auc_score"](spark, "/root/testdata/sf0.001").first()[0] == pytest.approx(
        0.488834154, abs=1e-9)
    assert q["auc_hard"](spark, "/root/testdata/sf0.001").first()[0] == pytest.approx(
        0.49355501, abs=1e-8)


# ------------------------------------------------------------ records

def _files(spark, rows):
    return spark.createDataFrame(rows, "file_name string, value string")


def test_assemble_fixture_case(spark):
    f = _files(spark, [("project_description_9488_9491.txt",
                        "9488|see 9492|x and 7|y\n9489|\n9490|last 9490|dup")])
    got = [(r.idx, r.text) for r in records.assemble_records(f).orderBy("idx").collect()]
    assert got == [(9488, "see 9492|x and 7|y"), (9489, ""), (9490, "last 9490|dup")]
    assert records.missing_records(f).count() == 0


def test_assemble_prefers_line_start_and_reports_gap(spark):
    f = _files(spark, [("project_description_0_3.txt", "0|a 1| b\n1|x\n\n2|ends in 7"),
                       ("project_description_10_13.txt", "10|a\n12|c")])
    got = {(r.file_name, r.idx): r.text for r in records.assemble_records(f).collect()}
    assert got[("project_description_0_3.txt", 0)] == "a 1| b"
    assert got[("project_description_0_3.txt", 1)] == "x\n"
    assert got[("project_description_0_3.txt", 2)] == "ends in 7"
    gaps = [(r.file_name, r.idx) for r in records.missing_records(f).collect()]
    assert gaps == [("project_description_10_13.txt", 11)]
    whole = {r.file_name: r.complete for r in records.assemble_records(f).collect()}
    assert whole == {"project_description_0_3.txt": True, "project_description_10_13.txt": False}
    with pytest.raises(ValueError):
        records.assert_complete(f)


def test_parsing_is_linear_in_the_markers(monkeypatch):
    """Each marker is found once and looked at once: steps are counted, not seconds."""
    class Counted:
        steps = 0

        def finditer(self, value):
            for m in marker.finditer(value):
                Counted.steps += 1
                yield m

    marker = records.MARKER
    monkeypatch.setattr(records, "MARKER", Counted())
    for chunks in (5_000, 20_000):
        Counted.steps = 0
        text = "0|" + "x 7| " * chunks + "".join(f"\n{i}|r" for i in range(1, 500))
        assert len(records.split_records(text, 0, 500)) == 500
        assert Counted.steps == chunks + 500


def test_two_containers_on_a_page(spark):
    from fundscope.operators import pages
    html = ["<article><p>a</p></article><article><figure></figure><p>b</p></article>",
            "<article><figure></figure></article><video></video><article></article>",
            "<article><p>open <figure></figure>"]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").selectExpr(
        "page_id", "'u' as url", "html")
    parsed = {r.page_id: (r.has_image, r.has_video) for r in pages.page_features(df).collect()}
    flags = {r.page_id: (r.has_image, r.has_video) for r in pages.page_flags(df).collect()}
    assert parsed == flags == {0: (0, 0), 1: (1, 1), 2: (1, 0)}


def test_assemble_round_trip(spark, sf):
    from fundscope.sources import tables
    docs = tables.load(spark, sf, "documents").select("doc_id", "text")
    files_df = records.description_files(docs, batch=37)
    back = records.assemble_records(files_df).select(F.col("idx").alias("doc_id"), "text")
    assert back.exceptAll(docs.na.fill({"text": ""})).count() == 0
    assert back.count() == docs.count()


def test_merge_scraped(spark):
    df = spark.createDataFrame([("project_scraped_0_2.csv", 0), ("project_scraped_0_2.csv", 5),
                                ("project_scraped_2_4.csv", 3)], "file_name string, row_idx long")
    assert sorted(r.row_idx for r in records.merge_scraped(df).collect()) == [0, 3]


# ------------------------------------------------------------ pages

PAGE_FULL = ('<html><body><video src="v"></video><div class="rte__content">'
             '<p>One &amp; two<p>three</p><figure><img></figure>'
             '<script>var t="</p>";</script></div><p>outside</p></body></html>')
PAGE_BROKEN = '<html><article><h1>T</h1><p><b>Open<br><p>para</article><p>after</p>'
PAGE_NONE = '<html><body><p>no container</p></body></html>'


def test_parse_page_cases():
    assert pages.parse_page(PAGE_FULL, "div", "rte__content") == ("One & twothree", 1, 1)
    assert pages.parse_page(PAGE_BROKEN, "article") == ("Openpara", 0, 0)
    assert pages.parse_page(PAGE_NONE, "article") == ("", 0, 0)
    assert pages.parse_page(None) == ("", 0, 0)


def test_page_features_and_flags(spark):
    df = spark.createDataFrame([(1, "u1", PAGE_FULL.replace('div class="rte__content"',
                                                             "article").replace("</div>",
                                                                                "</article>")),
                                (2, "u2", PAGE_NONE)], "page_id long, url string, html string")
    got = {r.page_id: tuple(r)[2:] for r in pages.page_features(df).collect()}
    assert got[1] == ("One & twothree", 1, 1, 1)
    assert got[2] == ("", 0, 0, 0)
    flags = {r.page_id: tuple(r)[1:] for r in pages.page_flags(df).collect()}
    assert flags == {1: (1, 1, 1), 2: (0, 0, 0)}
    assert [r.page_id for r in pages.pages_missing_text(pages.page_features(df)).collect()] == [2]


# ------------------------------------------------------------ sources and sinks

def test_json_read_flatten(spark, scratch):
    import json
    path = f"{scratch}/crawl.json"
    rec = {"data": {"id": 7, "name": "n", "blurb": "b", "goal": 1.5, "state": "failed",
                    "country": "US", "currency": "USD", "created_at": 86399,
                    "launched_at": 86400, "deadline": 172800, "staff_pick": None,
                    "backers_count": 3, "converted_pledged_amount": 4, "usd_pledged": "12.5",
                    "category": {"slug": "tech/apps", "name": "Apps"},
                    "creator": {"id": 99}, "urls": {"web": {"project": "http://x"}},
                    "friends": [1, 2], "photo": {"a": 1}}}
    with open(path, "w") as fh:
        fh.write(json.dumps(rec) + "\n")
    df = files.read_campaigns(spark, path)
    assert tuple(df.columns) == schemas.CAMPAIGN_COLUMNS
    r = df.first()
    assert (r.created_at, r.launched_at, r.mainCategory, r.subCategory, r.creatorID, r.url,
            r.usd_pledged) == (dt.date(1970, 1, 1), dt.date(1970, 1, 2), "tech", "Apps", 99,
                               "http://x", 12.5)


def test_json_sink_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    files.write_json(df, f"{scratch}/out")
    with pytest.raises(Exception):
        files.write_json(df, f"{scratch}/out")
    back = spark.read.schema("id long, name string").json(f"{scratch}/out")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]


def test_csv_round_trip_and_merge(spark, scratch):
    fields = [f.name for f in schemas.SCRAPED.fields]
    row = {f: None for f in fields}
    row.update(id=1, name="x", blurb=" padded ", Description="line1\nline2, \"q\"", Image=1,
               Video=0)
    ddl = "row_idx long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                       for f in schemas.SCRAPED.fields)
    df = spark.createDataFrame([(0, *[row[f] for f in fields])], ddl)
    files.write_csv(df, f"{scratch}/project_scraped_0_1.csv")
    back = files.read_scraped_csv(spark, f"{scratch}/project_scraped_0_1.csv/*.csv").first()
    assert back.Description == "line1\nline2, \"q\"" and back.Image == 1 and back.row_idx == 0
    assert back.blurb == " padded "        # no trimming on write


def test_delimited_text_round_trip(spark, scratch):
    texts = ["plain", "two\nlines", "back\\slash\\n", "cr\r\nlf", "nul\u0000x", "", "9|x\n10|y"]
    df = spark.createDataFrame(list(enumerate(texts)), "idx long, text string")
    files.write_delimited_text(df, f"{scratch}/desc", "idx", "text")
    back = files.read_delimited_text(spark, f"{scratch}/desc")
    assert sorted((r.idx, r.text) for r in back.collect()) == list(enumerate(texts))


def test_whole_text_files(spark, scratch):
    import os
    os.makedirs(f"{scratch}/d")
    with open(f"{scratch}/d/project_description_0_2.txt", "w") as fh:
        fh.write("0|a\nb\n1|c")
    f = files.read_text_files(spark, f"{scratch}/d/*.txt")
    got = [(r.idx, r.text) for r in records.assemble_records(f).orderBy("idx").collect()]
    assert got == [(0, "a\nb"), (1, "c")]


def test_save_table_replaces(spark):
    df = spark.createDataFrame([(1,)], "x int")
    files.save_table(df, "fs_test_tbl")
    files.save_table(df.union(df), "fs_test_tbl")
    assert spark.table("fs_test_tbl").count() == 2
    spark.sql("drop table if exists fs_test_tbl")


def test_columns_like_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "aVec int, bVec int, c int")
    assert shape.columns_like(df, "Vec") == ["aVec", "bVec"]
    assert shape.drop_columns(df, "c", "missing").columns == ["aVec", "bVec"]


def test_profile_covers_types(spark):
    df = spark.createDataFrame([("ab", 1, 2.0, dt.date(2020, 1, 1), True),
                                (None, 3, None, dt.date(2021, 1, 1), False)],
                               "s string, n long, d double, day date, b boolean")
    p = {(r.column, r.metric): (r.num_value, r.date_value) for r in stats.profile(df).collect()}
    assert p[("s", "max_length")][0] == 2 and p[("s", "count")][0] == 1
    assert p[("n", "max")][0] == 3 and p[("d", "count")][0] == 1
    assert p[("day", "min")][1] == dt.date(2020, 1, 1)
    assert p[("b", "n_true")][0] == 1


def test_tech_slice_round_trip_month_text(spark, scratch):
    """S5 -> S6: the slice comes back with dates as text; E12 still reads the month."""
    df = spark.createDataFrame([(1, dt.date(2017, 3, 9)), (2, dt.date(2018, 11, 30))],
                               "id long, launched_at date")
    files.write_json(df, f"{scratch}/tech", single_file=True)
    back = files.read_line_json(spark, f"{scratch}/tech")
    assert dict(back.dtypes)["launched_at"] == "string"
    got = sorted((r.id, r.m) for r in back.select("id", C.month_text("launched_at").alias("m"))
                 .collect())
    assert got == [(1, "03"), (2, "11")]


def test_distinct_counts_approx_option(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("k"))
    exact = stats.distinct_counts(df, ["k"]).first()["distinct_k"]
    approx = stats.distinct_counts(df, ["k"], approx=True, rsd=0.02).first()["distinct_k"]
    assert exact == 5000 and abs(approx - exact) / exact < 0.06


def test_merge_bins_step(spark):
    df = spark.createDataFrame([(v,) for v in (1, 3, 4, 5, 7)], "b int")
    assert [r[0] for r in df.select(C.merge_bins("b", 4)).collect()] == [1, 3, 4, 4, 4]


def test_value_share_counts_nulls_as_not_equal(spark):
    df = spark.createDataFrame([("US",), ("US",), ("DE",), (None,)], "country string")
    assert stats.value_share(df, "country", "US").first()["share"] == 0.5


def test_share_by_against_an_external_total(spark):
    part = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    whole = spark.range(6)
    got = {r.k: r.share for r in stats.share_by(part, "k", total_of=whole).collect()}
    assert got == {"a": 2 / 6, "b": 1 / 6}


def test_top_keywords_of_any_blocks(spark, monkeypatch):
    """term statistics go to blocks, not to each document's terms; same rows for any blocks."""
    import math
    import re
    from collections import Counter

    from fundscope.operators import keywords
    rows = [(1, "Elm elm, oak"), (2, "oak ash ash yew"), (2, "yew fig"), (None, "elm bay"), (None, "bay bay"),
            (3, None), (4, ""), (5, "12 34"), (6, "\u00c9t\u00e9 oak \u00e9t\u00e9"), (7, "bay ash oak elm yew fig")]
    counts = {}
    for key, text in rows:
        counts.setdefault(key, Counter()).update(t for t in re.split(r"[\W\d_]+", (text or "").lower()) if t)
    df, tf = Counter(t for c in counts.values() for t in c), sum(counts.values(), Counter())
    want = set()
    for key, c in counts.items():
        best = sorted((-n * math.log((len(rows) + 1) / (df[t] + 1)), t) for t, n in c.items())[:3]
        want |= {(key, i, t, round(-x, 9), tf[t]) for i, (x, t) in enumerate(best, 1)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (1, 30, 1 << 20):
        monkeypatch.setattr(keywords, "BLOCK_BYTES", size)
        found = keywords.top_keywords(docs, k=3)
        got = [(r.doc_id, r.rank, r.term, round(r.tfidf, 9), r.corpus_tf) for r in found.collect()]
        assert len(got) == len(want) and set(got) == want
    empty = keywords.top_keywords(docs.where("doc_id = 3"), k=3)
    assert empty.count() == 0 and empty.columns == ["doc_id", "rank", "term", "tfidf", "corpus_tf"]
