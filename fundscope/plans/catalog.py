"""Registered queries: one per inventory item, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or the campaign stand-in Spark derives from
them) in full. ``ORACLE`` holds the DuckDB SQL for the SQL-expressible ones;
queries without an entry are checked by row count only.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundscope.functions import columns as C
from fundscope.operators import keywords, metrics, pages, records, sampling, segments, shape, similar, stats
from fundscope.plans import features as feat
from fundscope.plans import models, search
from fundscope.plans.oracle import on_campaigns, on_features, on_scored
from fundscope.session import stored_table
from fundscope.sources import tables
from fundscope.sources.tables import CATEGORY, CUTOFF, HOME_COUNTRY, KEEP_STANDIN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return tables.campaigns(spark, sf)


def features(spark: SparkSession, sf: str) -> DataFrame:
    return feat.campaign_features(campaigns(spark, sf), cutoff=CUTOFF, category=CATEGORY,
                                  home=HOME_COUNTRY, keep=KEEP_STANDIN)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic scorer over the features (stands in for a fitted model)."""
    f = features(spark, sf)
    score = 2 * F.col("staff_pick") + (4 - F.col("goalBin")) + F.col("preparelen") % 3
    return f.select("id", "label", score.alias("score"),
                    F.when(score >= 2, 1).otherwise(0).alias("prediction"))


# ------------------------------------------------------------ flagship

@register("success_by_goal_bin", on_features("""
select goalBin, count(*) as campaigns, cast(sum(label) as bigint) as successes,
       round(avg(label), 6) as success_rate,
       round(count(*) / (select count(*) from features), 6) as share
from features group by goalBin"""))
def success_by_goal_bin(spark, sf):
    groups = (features(spark, sf).groupBy("goalBin")
              .agg(F.count(F.lit(1)).alias("campaigns"), F.sum("label").alias("successes"),
                   F.round(F.avg("label"), 6).alias("success_rate")))
    total = F.sum("campaigns").over(Window.partitionBy())      # over four bins
    return (groups.withColumn("share", F.round(F.col("campaigns") / total, 6))
            .orderBy("goalBin"))


# ------------------------------------------------------------ features (E*, F*)

@register("campaign_features", on_features("select * from features"))
def campaign_features(spark, sf):
    return features(spark, sf)


@register("filter_closed", on_campaigns(
    "select id, state from campaigns where state <> 'live'"))
def filter_closed(spark, sf):
    return feat.closed_campaigns(campaigns(spark, sf)).select("id", "state")


@register("filter_since", on_campaigns(
    "select id, created_at from campaigns where created_at >= '1996-01-01'"))
def filter_since(spark, sf):
    return feat.created_since(campaigns(spark, sf), CUTOFF).select("id", "created_at")


@register("state_recode", on_campaigns("""
select id, case when state in ('successful', 'failed') then state else 'other' end as state
from campaigns where state <> 'live'"""))
def state_recode(spark, sf):
    return feat.state_recoded(campaigns(spark, sf)).select("id", "state")


@register("rare_to_other", on_campaigns("""
select id, case when subCategory in ('URGENT', 'HIGH', 'MEDIUM') then subCategory
                else 'Other' end as newsubCategory
from campaigns"""))
def rare_to_other(spark, sf):
    return campaigns(spark, sf).select(
        "id", C.keep_or_other("subCategory", KEEP_STANDIN).alias("newsubCategory"))


@register("goal_bins", on_campaigns("""
select id, goal,
       case when goal < 15000 then 1 when goal < 35000 then 2 when goal < 55000 then 3
            when goal < 100000 then 4 when goal < 140000 then 5 when goal < 250000 then 6
            else 7 end as goalBin7,
       case when goal < 15000 then 1 when goal < 35000 then 2 when goal < 55000 then 3
            else 4 end as goalBin
from campaigns"""))
def goal_bins(spark, sf):
    c = campaigns(spark, sf)
    return c.select("id", "goal",
                    C.bin_by_edges("goal", C.GOAL_EDGES_FINE).alias("goalBin7"),
                    C.goal_bin("goal").alias("goalBin"))


@register("split_category", on_campaigns("""
select id, split_part(concat(mainCategory, '/', lower(subCategory)), '/', 1) as mainCategory,
       subCategory
from campaigns"""))
def split_category(spark, sf):
    c = campaigns(spark, sf)
    slug = F.concat("mainCategory", F.lit("/"), F.lower("subCategory"))
    return c.select("id", C.split_first(slug, "/").alias("mainCategory"), "subCategory")


@register("epoch_to_date", """
select event_id, cast(floor(epoch(ts)) as bigint) as epoch_s,
       date '1970-01-01' + cast(floor(epoch(ts) / 86400) as integer) as event_date
from events""")
def epoch_to_date(spark, sf):
    ev = tables.load(spark, sf, "events")
    epoch = F.unix_timestamp("ts")
    return ev.select("event_id", epoch.alias("epoch_s"), C.epoch_to_date(epoch).alias("event_date"))


@register("flatten_struct", on_campaigns("""
select id, name, blurb, goal, state, country, currency, created_at, launched_at, deadline,
       staff_pick, backers_count, cast(null as bigint) as converted_pledged_amount,
       usd_pledged, mainCategory, subCategory, creatorID, url
from campaigns"""))
def flatten_struct(spark, sf):
    return shape.flatten_campaigns(tables.raw_campaigns(spark, sf))


@register("json_props", """
select event_id, cast(json_extract(props, '$.k') as bigint) as k
from events""")
def json_props(spark, sf):
    ev = tables.load(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"))


@register("month_counts", on_campaigns("""
select strftime(launched_at, '%m') as month, count(*) as count
from campaigns group by 1"""))
def month_counts(spark, sf):
    c = campaigns(spark, sf)
    return stats.group_count(c.select(C.month_text("launched_at").alias("month")), "month")


# ------------------------------------------------------------ stats (A*)

@register("row_count", on_campaigns("select count(*) as rows from campaigns"))
def row_count(spark, sf):
    return stats.row_count(campaigns(spark, sf))


@register("distinct_counts", on_campaigns("""
select count(*) as rows, count(distinct name) as distinct_name,
       count(distinct url) as distinct_url, count(distinct subCategory) as distinct_subCategory
from campaigns"""))
def distinct_counts(spark, sf):
    return stats.distinct_counts(campaigns(spark, sf), ["name", "url", "subCategory"])


@register("distinct_sketches", on_campaigns("""
select cast(year(launched_at) as integer) as year, count(distinct name) as names, count(distinct url) as urls,
       true as names_near, true as urls_near
from campaigns group by 1"""))
def distinct_sketches(spark, sf):
    """A2: sketches stored by month, united by year; within four standard errors of the counts."""
    c = campaigns(spark, sf).select(F.year("launched_at").alias("year"),
                                    F.month("launched_at").alias("month"), "name", "url")
    kept = stored_table(stats.distinct_sketches(c, ["year", "month"], ["name", "url"]), "sketches")
    exact = c.groupBy("year").agg(F.count_distinct("name").alias("names"), F.count_distinct("url").alias("urls"))
    both = exact.join(stats.united_estimates(kept, ["year"], ["name", "url"]), "year")
    near = lambda n, e: F.abs(F.col(e) - F.col(n)) <= 4 * stats.sketch_error() * F.col(n)
    return both.select("year", "names", "urls", near("names", "name_estimate").alias("names_near"),
                       near("urls", "url_estimate").alias("urls_near"))


@register("distinct_states", on_campaigns("select distinct state from campaigns"))
def distinct_states(spark, sf):
    return stats.distinct_values(campaigns(spark, sf), "state")


@register("name_repeats", on_campaigns("""
select name, count(*) as number from campaigns group by name"""))
def name_repeats(spark, sf):
    return stats.group_count(campaigns(spark, sf), "name", name="number")


@register("category_share", on_campaigns("""
select mainCategory, count(*) as count,
       round(count(*) / (select count(*) from campaigns), 9) as perc
from campaigns group by mainCategory"""))
def category_share(spark, sf):
    return stats.share_by(campaigns(spark, sf), "mainCategory", name="perc", digits=9)


@register("share_by", on_features("""
select 'countryUS' as feature, cast(countryUS as varchar) as value, count(*) as count,
       round(count(*) / (select count(*) from features), 9) as share
from features group by countryUS
union all
select 'label', cast(label as varchar), count(*),
       round(count(*) / (select count(*) from features), 9) from features group by label
union all
select 'newsubCategory', newsubCategory, count(*),
       round(count(*) / (select count(*) from features), 9) from features group by newsubCategory
union all
select 'goalBin', cast(goalBin as varchar), count(*),
       round(count(*) / (select count(*) from features), 9) from features group by goalBin"""))
def share_by(spark, sf):
    names = ("countryUS", "label", "newsubCategory", "goalBin")
    long = features(spark, sf).select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in names])))
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    total = counts.select(F.sum("count") / len(names)).scalar()  # each row counts once a name
    return counts.withColumn("share", F.round(F.col("count") / total, 9))


@register("share_raw_category", on_features("""
select subCategory, count(*) as count,
       round(count(*) / (select count(*) from campaigns), 9) as share
from campaigns group by subCategory"""))
def share_raw_category(spark, sf):
    return stats.share_by(campaigns(spark, sf), "subCategory", digits=9)


@register("class_balance", on_features(
    "select label, count(*) as count from features group by label"))
def class_balance(spark, sf):
    return stats.group_count(features(spark, sf), "label")


@register("per_year", on_campaigns("""
select cast(year(launched_at) as integer) as year, count(*) as count
from campaigns group by 1"""))
def per_year(spark, sf):
    return stats.per_year(campaigns(spark, sf), "launched_at")


@register("monthly_mean", on_campaigns("""
select month, round(avg(number), 2) as mean_count
from (select cast(month(launched_at) as integer) as month, year(launched_at) as year,
             count(*) as number from campaigns group by 1, 2) t
group by month"""))
def monthly_mean(spark, sf):
    return stats.monthly_mean(campaigns(spark, sf), "launched_at")


@register("value_counts", on_campaigns("""
select country, count(*) as count from campaigns group by country"""))
def value_counts(spark, sf):
    return stats.value_counts(campaigns(spark, sf), "country", include_null=True)


@register("value_share", on_campaigns("""
select avg(case when country = 'NATION_0' then 1 else 0 end) as share from campaigns"""))
def value_share(spark, sf):
    return stats.value_share(campaigns(spark, sf), "country", HOME_COUNTRY)


def _profile_sql() -> str:
    """Long-form profile in DuckDB: one union branch per (column, metric)."""
    strings = ["name", "blurb", "state", "country", "currency", "mainCategory",
               "subCategory", "url"]
    numbers = ["id", "goal", "backers_count", "usd_pledged", "creatorID"]
    dates = ["created_at", "launched_at", "deadline"]
    parts = []

    def num(col, metric, expr):
        parts.append(f"select '{col}' as \"column\", '{metric}' as metric, "
                     f"round(cast({expr} as double), 6) as num_value, "
                     f"cast(null as date) as date_value from campaigns")

    for c in strings:
        num(c, "count", f"count({c})")
        num(c, "min_length", f"min(length({c}))")
        num(c, "max_length", f"max(length({c}))")
        num(c, "mean_length", f"avg(length({c}))")
        num(c, "stddev_length", f"stddev_samp(length({c}))")
    for c in numbers:
        num(c, "count", f"count({c})")
        num(c, "min", f"min({c})")
        num(c, "max", f"max({c})")
        num(c, "mean", f"avg({c})")
        num(c, "stddev", f"stddev_samp({c})")
    for c in dates:
        num(c, "count", f"count({c})")
        for m in ("min", "max"):
            parts.append(f"select '{c}', '{m}', cast(null as double), {m}({c}) from campaigns")
    num("staff_pick", "count", "count(staff_pick)")
    num("staff_pick", "n_true", "sum(cast(staff_pick as integer))")
    return on_campaigns("\nunion all\n".join(parts))


@register("profile", _profile_sql())
def profile(spark, sf):
    p = stats.profile(campaigns(spark, sf))
    return p.withColumn("num_value", F.round("num_value", 6))


@register("max_lengths", on_campaigns("""
select cast(max(length(name)) as integer) as max_len_name, cast(max(length(state)) as integer) as max_len_state,
       cast(max(length(blurb)) as integer) as max_len_blurb, cast(max(length(country)) as integer) as max_len_country,
       cast(max(length(currency)) as integer) as max_len_currency, cast(max(length(mainCategory)) as integer) as max_len_mainCategory,
       cast(max(length(subCategory)) as integer) as max_len_subCategory, cast(max(length(url)) as integer) as max_len_url
from campaigns"""))
def max_lengths(spark, sf):
    return stats.max_lengths(campaigns(spark, sf), ["name", "state", "blurb", "country",
                                                     "currency", "mainCategory",
                                                     "subCategory", "url"])


@register("ranges", on_campaigns("""
select max(backers_count) as max_backers_count, min(backers_count) as min_backers_count,
       max(usd_pledged) as max_usd_pledged, min(usd_pledged) as min_usd_pledged,
       max(goal) as max_goal, min(goal) as min_goal, max(id) as max_id, min(id) as min_id,
       max(creatorID) as max_creatorID, min(creatorID) as min_creatorID,
       max(created_at) as max_created_at, min(created_at) as min_created_at,
       max(launched_at) as max_launched_at, min(launched_at) as min_launched_at,
       max(deadline) as max_deadline, min(deadline) as min_deadline
from campaigns"""))
def ranges(spark, sf):
    return stats.ranges(campaigns(spark, sf), ["backers_count", "usd_pledged", "goal", "id",
                                                "creatorID", "created_at", "launched_at",
                                                "deadline"])


@register("describe_goal", on_campaigns("""
select count(goal) as count, round(avg(goal), 6) as mean, round(stddev_samp(goal), 6) as std,
       round(min(goal), 6) as min, round(quantile_cont(goal, 0.25), 6) as q25,
       round(quantile_cont(goal, 0.5), 6) as q50, round(quantile_cont(goal, 0.75), 6) as q75,
       round(max(goal), 6) as max
from campaigns"""))
def describe_goal(spark, sf):
    return stats.describe(campaigns(spark, sf), "goal", digits=6)


def _hist_oracle(where: str, n: int) -> str:
    return on_campaigns(f"""
select cast(bins.bin as integer) as bin,
       round(b.lo + bins.bin * (b.hi - b.lo) / {n}, 6) as bin_lo,
       round(b.lo + (bins.bin + 1) * (b.hi - b.lo) / {n}, 6) as bin_hi,
       coalesce(c.cnt, 0) as count
from bins cross join b left join c on c.bin = bins.bin""",
        f"src as (select goal from campaigns where goal is not null {where})",
        "b as (select min(goal) as lo, max(goal) as hi from src)",
        f"bins as (select range as bin from range(0, {n}))",
        f"""c as (select case when b.hi = b.lo then 0
                  else least(cast(floor((goal - b.lo) * {n} / (b.hi - b.lo)) as bigint), {n} - 1)
             end as bin, count(*) as cnt
      from src, b group by 1)""")


@register("hist", _hist_oracle("", 50))
def hist(spark, sf):
    h = stats.histogram(campaigns(spark, sf), "goal", bins=50)
    return h.withColumn("bin_lo", F.round("bin_lo", 6)).withColumn("bin_hi", F.round("bin_hi", 6))


@register("hist_range", _hist_oracle("and goal > 250000 and goal < 30000000", 10))
def hist_range(spark, sf):
    h = stats.histogram(campaigns(spark, sf), "goal", bins=10, open_range=(250000.0, 30000000.0))
    return h.withColumn("bin_lo", F.round("bin_lo", 6)).withColumn("bin_hi", F.round("bin_hi", 6))


# ------------------------------------------------------------ shape (J*)

@register("same_url_pairs", on_campaigns("""
select c.id, c.launched_at, c.name, c.url,
       (select case when min(o.name) < c.name then min(o.name) else max(o.name) end
        from campaigns o where o.url = c.url and o.name <> c.name) as other_name,
       (select count(*) from campaigns o where o.url = c.url and o.name is not null) as url_rows,
       (select count(*) from campaigns o where o.url = c.url and o.name <> c.name) as partners
from campaigns c
where exists (select 1 from campaigns o where o.url = c.url and o.name <> c.name)"""))
def same_url_pairs(spark, sf):
    return shape.same_url_conflicts(campaigns(spark, sf))


def _hash_sql(seed: str, key_sql: str) -> str:
    """DuckDB twin of ``columns.hash_unit``."""
    return f"cast(('0x' || substr(md5('{seed}|' || cast({key_sql} as varchar)), 1, 8)) as bigint)"


def _recrawl(spark, sf) -> DataFrame:
    """Campaigns plus a second crawl of every 7th id under another name (duplicate ids)."""
    c = campaigns(spark, sf)
    again = (c.where(F.col("id") % 7 == 0)
             .withColumn("name", F.concat(F.col("name"), F.lit(" (recrawl)"))))
    return c.unionByName(again)


_RECRAWL_CTE = """crawl as (select * from campaigns union all
    select * replace (concat(name, ' (recrawl)') as name) from campaigns where id % 7 = 0)"""


@register("dedupe_by_key", on_campaigns("""
select id, name, url, launched_at from (
  select *, row_number() over (partition by id order by name) as rn from crawl) t
where rn = 1""", _RECRAWL_CTE))
def dedupe_by_key(spark, sf):
    # narrow first: the survivor is packed into one aggregate with all its columns
    crawl = _recrawl(spark, sf).select("id", "name", "url", "launched_at")
    return shape.dedupe_by_key(crawl, ["id"], order=["name"])


@register("distinct_rows", on_features("""
select distinct staff_pick, blurblen, namelen, countryUS, campaignlen, preparelen,
       newsubCategory, monthdead, monthLaunched, goalBin, label from features"""))
def distinct_rows(spark, sf):
    return shape.distinct_rows(features(spark, sf).drop("id"))


@register("later_duplicates", """
select doc_id, first_doc_id from (
  select doc_id, min(doc_id) over (partition by text) as first_doc_id from documents) t
where doc_id > first_doc_id""")
def later_duplicates(spark, sf):
    docs = tables.load(spark, sf, "documents").select("doc_id", "text")
    return shape.later_duplicates(docs, "text", "doc_id").select("doc_id", "first_doc_id")


@register("attach_description", """
select l.doc_id, l.quality, l.toxic, cast(length(d.text) as integer) as description_chars,
       case when regexp_matches(d.text, '\\S') then 1 else 0 end as has_description
from labels l left join documents d on l.doc_id = d.doc_id""")
def attach_description(spark, sf):
    labels = tables.load(spark, sf, "labels")
    docs = tables.load(spark, sf, "documents").select("doc_id", F.col("text").alias("description"))
    j = shape.attach_by_key(labels, docs, "doc_id", ["description"])
    return j.select("doc_id", "quality", "toxic",
                    F.length("description").alias("description_chars"),
                    C.has_text("description").alias("has_description"))


# ------------------------------------------------------------ sort / sample (L*)

@register("top_goals", on_campaigns(
    "select id, name, goal from campaigns order by goal desc, id limit 10"))
def top_goals(spark, sf):
    return campaigns(spark, sf).select("id", "name", "goal").orderBy(
        F.col("goal").desc(), F.col("id")).limit(10)


_TRAIN_CTE = f"""train as (select * from features where {_hash_sql('101', 'id')} % 100 < 75)"""


@register("split_train", on_features("select id, label from train", _TRAIN_CTE))
def split_train(spark, sf):
    train, _ = sampling.keyed_split(features(spark, sf), "id", 75, 101)
    return train.select("id", "label")


@register("sample_class", on_features(f"""
select id, label from features where label = 1
order by {_hash_sql('7', 'id')}, id limit 500"""))
def sample_class(spark, sf):
    return sampling.sample_class(features(spark, sf), 500, "label", 1, 7, "id").select(
        "id", "label")


_REBALANCE_CTES = (
    _TRAIN_CTE,
    "base as (select *, 0 as copy_no from train)",
    f"""extra as (select * replace (1 as copy_no) from base where label = 1
        order by {_hash_sql('101a', "id || '#' || copy_no")}, id, copy_no limit 2000)""",
    "training as (select * from base union all select * from extra)",
    f"""neg as (select * from training where label = 0
        order by {_hash_sql('101b', "id || '#' || copy_no")}, id, copy_no limit 4700)""",
    f"""pos as (select * from training where label = 1
        order by {_hash_sql('101c', "id || '#' || copy_no")}, id, copy_no limit 4700)""",
)


@register("rebalance", on_features("select * from neg union all select * from pos",
                                    *_REBALANCE_CTES))
def rebalance(spark, sf):
    train, _ = sampling.keyed_split(features(spark, sf), "id", 75, 101)
    return sampling.rebalance(train, oversample=2000, per_class=4700, seed=101)


@register("class_balance_rebalanced", on_features("""
select label, count(*) as count from (select * from neg union all select * from pos) t
group by label""", *_REBALANCE_CTES))
def class_balance_rebalanced(spark, sf):
    return stats.group_count(rebalance(spark, sf), "label")


# ------------------------------------------------------------ metrics (V*)

@register("auc_hard", on_scored("""
select (avg(case when label = 1 then prediction end)
        + avg(case when label = 0 then 1 - prediction end)) / 2 as auc_hard from scored"""))
def auc_hard(spark, sf):
    return metrics.auc_hard(scored(spark, sf))


@register("auc_score", on_scored("""
select sum(pos * (coalesce(neg_before, 0) + 0.5 * neg)) / (sum(pos) * sum(neg)) as auc_score
from (select score, pos, neg,
             sum(neg) over (order by score rows between unbounded preceding and 1 preceding)
               as neg_before
      from (select cast(score as double) as score,
                   sum(case when label = 1 then 1 else 0 end) as pos,
                   sum(case when label = 1 then 0 else 1 end) as neg
            from scored group by 1) s) t"""))
def auc_score(spark, sf):
    return metrics.auc_score(scored(spark, sf))


@register("confusion", on_scored("""
select label, count(*) filter (where prediction = 0) as pred_0,
       count(*) filter (where prediction = 1) as pred_1
from scored group by label"""))
def confusion(spark, sf):
    return metrics.confusion(scored(spark, sf))


@register("prf_by_label", on_scored("""
select c as label,
       case when n_pred > 0 then tp / n_pred else 0 end as precision,
       case when n_act > 0 then tp / n_act else 0 end as recall,
       case when (case when n_pred > 0 then tp / n_pred else 0 end)
               + (case when n_act > 0 then tp / n_act else 0 end) > 0
            then 2 * (case when n_pred > 0 then tp / n_pred else 0 end)
                   * (case when n_act > 0 then tp / n_act else 0 end)
                 / ((case when n_pred > 0 then tp / n_pred else 0 end)
                   + (case when n_act > 0 then tp / n_act else 0 end))
            else 0 end as f1
from (select c, sum(case when label = c and prediction = c then 1 else 0 end)::double as tp,
             sum(case when label = c then 1 else 0 end) as n_act,
             sum(case when prediction = c then 1 else 0 end) as n_pred
      from scored, (select label as c from scored union select prediction from scored) k
      group by c) t"""))
def prf_by_label(spark, sf):
    return metrics.prf_by_label(scored(spark, sf))


@register("accuracy", on_scored(
    "select avg(case when label = prediction then 1 else 0 end) as accuracy from scored"))
def accuracy(spark, sf):
    return metrics.accuracy(scored(spark, sf))


@register("roc_points", on_scored("""
select score as threshold, tp, fp, tp / p_all as tpr, fp / n_all as fpr,
       tp / (tp + fp) as precision
from (select score,
             cast(sum(pos) over (order by score desc) as bigint) as tp,
             cast(sum(neg) over (order by score desc) as bigint) as fp,
             sum(pos) over () as p_all, sum(neg) over () as n_all
      from (select cast(score as double) as score,
                   sum(case when label = 1 then 1 else 0 end) as pos,
                   sum(case when label = 1 then 0 else 1 end) as neg
            from scored group by 1) s) t"""))
def roc_points(spark, sf):
    return metrics.roc_points(scored(spark, sf))


# ------------------------------------------------------------ records, pages, keywords (T*)

def _description_files(spark, sf) -> DataFrame:
    """Description files (S11 format) that Spark derives from ``documents``."""
    return records.description_files(tables.load(spark, sf, "documents"))


_BATCH_CTE = """batched as (select doc_id, text, (doc_id // 500) * 500 as lo,
    max(doc_id) over (partition by doc_id // 500) + 1 as hi from documents)"""


@register("assemble_records", """
with """ + _BATCH_CTE + """
select 'project_description_' || lo || '_' || hi || '.txt' as file_name,
       doc_id as idx, coalesce(text, '') as text, true as complete
from batched""")
def assemble_records(spark, sf):
    return records.assemble_records(_description_files(spark, sf))


_FALSE_MARKERS_SQL = """coalesce(text, '') || ' see ' || (doc_id + 1) || '| and' || chr(10)
    || (doc_id + 7) || '|end'"""


@register("repaired_records", """
with """ + _BATCH_CTE + """
select 'project_description_' || lo || '_' || hi || '.txt' as file_name,
       doc_id as idx, """ + _FALSE_MARKERS_SQL + """ as text, true as complete
from batched""")
def repaired_records(spark, sf):
    """Every text holds the next record's marker inside a line and a later record's
    marker at a line start; the true texts must come back."""
    return records.assemble_records(_false_marker_files(spark, sf))


def _false_marker_files(spark, sf):
    docs = tables.load(spark, sf, "documents")
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" see "), (F.col("doc_id") + 1).cast(
        "string"), F.lit("| and\n"), (F.col("doc_id") + 7).cast("string"), F.lit("|end"))
    return records.description_files(docs.withColumn("text", text))


@register("segmented_records", """
with """ + _BATCH_CTE + """
select 'project_description_' || lo || '_' || hi || '.txt' as file_name,
       doc_id as idx, """ + _FALSE_MARKERS_SQL + """ as text, true as complete
from batched""")
def segmented_records(spark, sf):
    """T2+T3 on files of any size: the same files written out and read by splits."""
    path = _export_dir(spark, "segmented-files")
    made = _false_marker_files(spark, sf).select("value", F.col("file_name").alias("file"))
    made.repartition("file").write.partitionBy("file").text(path)
    lines = segments.read_lines(spark, f"{path}/*", name_from=r"file=([^/]*)/")
    # the text sink ends every file with a newline
    return segments.assemble_large(lines).withColumn("text", F.regexp_replace("text", r"\n\z", ""))


@register("missing_records", """
with labelled as (select d.* from documents d semi join labels l on d.doc_id = l.doc_id),
""" + _BATCH_CTE.replace("from documents", "from labelled") + """,
files as (select distinct lo, hi from batched)
select 'project_description_' || lo || '_' || hi || '.txt' as file_name, idx
from (select lo, hi, unnest(range(lo, hi)) as idx from files) r
where idx not in (select doc_id from labels)""")
def missing_records(spark, sf):
    docs = tables.load(spark, sf, "documents")
    labels = tables.load(spark, sf, "labels").select("doc_id")
    labelled = docs.join(labels, "doc_id", "left_semi")
    return records.missing_records(records.description_files(labelled))


@register("record_counts", """
with """ + _BATCH_CTE + """
select 'project_description_' || lo || '_' || hi || '.txt' as file_name,
       max(hi) - min(lo) as expected, cast(count(distinct doc_id) as integer) as found
from batched group by lo, hi""")
def record_counts(spark, sf):
    return records.record_counts(_description_files(spark, sf))


def _varied_pages(spark, sf) -> DataFrame:
    """The pages with media and gaps by id: a figure in the container (id % 3 = 0), a video
    before it (id % 5 = 0), paragraphs renamed so that no text is left (id % 7 = 0)."""
    p = tables.load(spark, sf, "pages").select("page_id", "url", "html")
    k = F.col("page_id")
    html = F.when(k % 7 == 0, F.regexp_replace("html", r"(?i)<(/?)p([\s>])", "<$1q$2")).otherwise(
        F.col("html"))
    html = F.when(k % 3 == 0, F.regexp_replace(
        html, r"(?i)(<article\b[^>]*>)", "$1<figure></figure>")).otherwise(html)
    html = F.when(k % 5 == 0, F.concat(F.lit("<video></video>"), html)).otherwise(html)
    return p.withColumn("html", html)


_VARIED_CTE = r"""with named as (select page_id, url,
        case when page_id % 7 = 0 then regexp_replace(html, '<(/?)p([\s>])', '<\1q\2', 'gi')
             else html end as html from pages),
    pictured as (select page_id, url,
        case when page_id % 3 = 0 then regexp_replace(html, '(<article\b[^>]*>)',
             '\1<figure></figure>', 'gi') else html end as html from named),
    varied as (select page_id, url,
        case when page_id % 5 = 0 then '<video></video>' || html else html end as html
        from pictured),
    flags as (select page_id, url,
        case when regexp_matches(html, '(?i)<article[\s>]') then 1 else 0 end as has_container,
        coalesce(regexp_extract(html, '(?is)<article\b[^>]*>(.*?)(?:</article\s*>|$)', 1), '')
            as body,
        case when regexp_matches(html, '(?i)<video[\s>]') then 1 else 0 end as has_video
        from varied) """


@register("page_features", _VARIED_CTE + r"""
select page_id, url, case when regexp_matches(body, '(?i)<figure[\s>]') then 1 else 0 end as has_image,
       has_video,
       case when regexp_matches(body, '(?is)<p(?:\s[^>]*)?>(?:\s|</?(?:a|b|i|em|br|span|strong)\b[^>]*>)*[^<\s]') then 1 else 0 end
           as has_description
from flags""")
def page_features(spark, sf):
    """T1 on pages with and without text, figures and videos."""
    return pages.page_features(_varied_pages(spark, sf)).drop("description")


@register("page_texts")
def page_texts(spark, sf):
    """The descriptions themselves."""
    return pages.page_features(tables.load(spark, sf, "pages"))


@register("pages_missing_text", _VARIED_CTE + r"""
select page_id, url from flags
where not regexp_matches(body, '(?is)<p(?:\s[^>]*)?>(?:\s|</?(?:a|b|i|em|br|span|strong)\b[^>]*>)*[^<\s]')""")
def pages_missing_text(spark, sf):
    """pages without text."""
    return pages.pages_missing_text(pages.page_features(_varied_pages(spark, sf)))


@register("page_flags", _VARIED_CTE + r"""
select page_id, has_container, case when regexp_matches(body, '(?i)<figure[\s>]') then 1 else 0 end
       as has_image, has_video from flags""")
def page_flags(spark, sf):
    return pages.page_flags(_varied_pages(spark, sf))


_TOKENS_CTE = r"""toks as (select doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) as term
    from documents)"""


@register("term_stats", "with " + _TOKENS_CTE + """
select term, cast(sum(n) as bigint) as tf, count(*) as df
from (select doc_id, term, count(*) as n from toks group by 1, 2) t group by term""")
def term_stats(spark, sf):
    return keywords.term_stats(tables.load(spark, sf, "documents"))


@register("top_keywords", "with " + _TOKENS_CTE + """,
per_doc as (select doc_id, term, count(*) as n from toks group by 1, 2),
dfs as (select term, count(*) as df, cast(sum(n) as bigint) as corpus_tf
        from per_doc group by term),
scored as (select p.doc_id, p.term, p.n * ln(((select count(*) from documents) + 1) / (d.df + 1))
               as tfidf, d.corpus_tf
           from per_doc p join dfs d using (term))
select doc_id, cast(rank as integer) as rank, term, round(tfidf, 6) as tfidf, corpus_tf from (
  select *, row_number() over (partition by doc_id order by tfidf desc, term) as rank
  from scored) r where rank <= 5""")
def top_keywords(spark, sf):
    kw = keywords.top_keywords(tables.load(spark, sf, "documents"), k=5)
    return kw.withColumn("tfidf", F.round("tfidf", 6))


@register("similar_documents", "with " + _TOKENS_CTE + """,
per_doc as (select doc_id, term, count(*) as n from toks group by 1, 2),
dfs as (select term, count(*) as df from per_doc group by term),
weighted as (select p.doc_id, p.term, d.df,
                    p.n * ln(((select count(distinct doc_id) from documents) + 1) / (d.df + 1)) as x
             from per_doc p join dfs d using (term)),
unit as (select doc_id, term, x / sqrt(sum(x * x) over (partition by doc_id)) as w
         from weighted where x > 0),
scored as (select q.doc_id as query, d.doc_id as doc, round(sum(q.w * d.w), 9) as cosine
           from unit q join unit d on q.term = d.term and q.doc_id <> d.doc_id
           where q.doc_id % 100 = 0 group by 1, 2)
select query, cast(rank as integer) as rank, doc, round(cosine, 6) as cosine from (
  select *, row_number() over (partition by query order by cosine desc, doc) as rank
  from scored where cosine > 0) r where rank <= 5""")
def similar_documents(spark, sf):
    """The five most similar documents of every hundredth document."""
    found = similar.similar_documents(tables.load(spark, sf, "documents"), F.col("doc") % 100 == 0)
    return found.withColumn("cosine", F.round("cosine", 6))


# ------------------------------------------------------------ models (M*)

@register("string_index", on_features("""
select f.id, f.newsubCategory, cast(i.idx as double) as subCategoryIndex
from features f join (
  select newsubCategory, row_number() over (order by count(*) desc, newsubCategory) - 1 as idx
  from features group by newsubCategory) i using (newsubCategory)"""))
def string_index(spark, sf):
    from pyspark.ml.feature import StringIndexer
    f = features(spark, sf)
    model = StringIndexer(inputCol="newsubCategory", outputCol="subCategoryIndex",
                          stringOrderType="frequencyDesc").fit(f)
    return model.transform(f).select("id", "newsubCategory", "subCategoryIndex")


_STD_COLS = ("blurblen", "namelen", "campaignlen", "preparelen")


@register("standardize", on_features(
    "select id, " + ", ".join(
        f"case when s.s_{c} = 0 then 0.0 else round(({c} - s.m_{c}) / s.s_{c}, 6) end "
        f"as {c}_scaled" for c in _STD_COLS)
    + " from complete, s",
    "complete as (select * from features where "
    + " and ".join(f"{c} is not null" for c in _STD_COLS) + ")",
    "s as (select " + ", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}"
                                for c in _STD_COLS) + " from complete)"))
def standardize(spark, sf):
    from pyspark.ml.functions import vector_to_array
    f = features(spark, sf)
    fitted = models.numeric_scaler(_STD_COLS, output="scaled").fit(f)
    arr = vector_to_array(F.col("scaled"))
    return fitted.transform(f).select(
        "id", *[F.round(arr[i], 6).alias(f"{c}_scaled") for i, c in enumerate(_STD_COLS)])


def _prepared(spark, sf) -> models.Prepared:
    return models.prepare(features(spark, sf))


@register("model_matrix")
def model_matrix(spark, sf):
    from pyspark.ml.functions import vector_to_array
    p = _prepared(spark, sf)
    return p.train.select("id", "label", "fold", vector_to_array("features").alias("features"))


@register("vector_index")
def vector_index(spark, sf):
    from pyspark.ml.functions import vector_to_array
    f = features(spark, sf)
    pipe = models.encoder_stages(scale=False, output="modelFeatures")
    enc = pipe.fit(f).transform(f)
    vi = models.vector_indexer("modelFeatures", "indexFeatures").fit(enc)
    return vi.transform(enc).select("id", vector_to_array("indexFeatures").alias("indexFeatures"))


def _evaluate(pred: DataFrame) -> DataFrame:
    """Long form ``metric, value``: area under ROC on hard predictions and on
    scores, and accuracy (a union of three one-row aggregates, no join)."""
    parts = [metrics.auc_hard(pred), metrics.auc_score(pred), metrics.accuracy(pred)]
    return sampling.union_all([p.select(F.lit(p.columns[0]).alias("metric"),
                                        F.col(p.columns[0]).alias("value")) for p in parts])


@register("lr_plain")
def lr_plain(spark, sf):
    p = _prepared(spark, sf)
    model = models.fit_plain(p, "logistic")
    return _evaluate(models.predict(model, p.test))


@register("lr_optimum", """
select true as intercept_at_optimum, true as slopes_at_optimum""")
def lr_optimum(spark, sf):
    """M8 checked: the gradient of the mean log loss vanishes at the fitted coefficients."""
    p = _prepared(spark, sf)
    model = models.fit_plain(p, "logistic", maxIter=200, tol=1e-10)
    intercept, slopes = models.logistic_gradient(model, p.train)
    return spark.createDataFrame([(abs(intercept) < 1e-4, slopes < 1e-4)],
                                 "intercept_at_optimum boolean, slopes_at_optimum boolean")


def _grid_sql(kind: str, grid: dict) -> str:
    """Settings of a grid in the order of the search, as rows."""
    names = list(grid)
    rows = []
    for i, values in enumerate(itertools.product(*grid.values())):
        text = ", ".join(f"{n}={v}" for n, v in sorted(zip(names, values, strict=True)))
        rows.append(f"('{kind}', {i}, '{text}', true, true)")
    return ("select * from (values " + ", ".join(rows)
            + ") t(model, setting, params, auc_in_range, best_is_largest)")


def _search_query(kind: str, grid: dict):
    def run(spark, sf):
        """One row per setting; mean areas under ROC in [0, 1], the best one chosen."""
        best, results = models.search(_prepared(spark, sf), kind, grid)
        chosen = max(best.avgMetrics)
        # the chosen model's own parameters are those of the setting with the largest mean
        wanted = best.getEstimatorParamMaps()[best.avgMetrics.index(chosen)]
        same = all(best.bestModel.getOrDefault(p.name) == v for p, v in wanted.items())
        return results.select("model", "setting", "params",
                              F.col("mean_auc").between(0, 1).alias("auc_in_range"),
                              (F.lit(same) & (F.col("mean_auc") <= chosen)).alias("best_is_largest"))
    return run


# The four reference grids, whole. Tree and forest are registered in slices by their first
# parameter, so that one query stays a few minutes; the slices together are the grid.
SEARCHES = {"lr_cv": ("logistic", models.REFERENCE_GRIDS["logistic"]),
            "svc_cv": ("svm", models.REFERENCE_GRIDS["svm"])}
for _kind, _short, _first in (("tree", "dt_cv", "impurity"), ("forest", "rf_cv", "numTrees")):
    for _value in models.REFERENCE_GRIDS[_kind][_first]:
        SEARCHES[f"{_short}_{_value}"] = (_kind, {**models.REFERENCE_GRIDS[_kind], _first: [_value]})
for _name, (_kind, _grid) in SEARCHES.items():
    register(_name, _grid_sql(_kind, _grid))(_search_query(_kind, _grid))


def _whole_search_query(kind: str):
    def run(spark, sf):
        """Mean area of each setting of the whole grid, from the ledger; one is the best."""
        ledger = search.run(_prepared(spark, sf), kind, models.REFERENCE_GRIDS[kind],
                            _export_dir(spark, f"ledger-{kind}"))
        return search.results(ledger)
    return run


def _searched_predict_query(kind: str):
    def run(spark, sf):
        """The searched best model and its encoder, saved, read back and applied."""
        p = _prepared(spark, sf)
        grid, path = models.REFERENCE_GRIDS[kind], _export_dir(spark, f"searched-{kind}")
        search.finish(p, kind, grid, search.run(p, kind, grid, f"{path}/ledger"), path)
        f = features(spark, sf)
        pred = search.predict(kind, path, f).select("id", "prediction", "score")
        return f.select("id", F.col("label").cast("int").alias("label")).join(pred, "id", "left").select(
            "id", "label", F.col("prediction").isNotNull().alias("predicted"),
            F.col("prediction").isin(0, 1).alias("valid"),
            (F.col("prediction") == (F.col("score") > models.THRESHOLDS[kind]).cast("int")).alias("agrees"))
    return run


# Whole grids in one search each (the slices above are parts of them).
for _kind, _short in (("tree", "dt"), ("forest", "rf")):
    register(f"{_short}_search")(_whole_search_query(_kind))


# One setting of each reference grid, for the predictions.
FIXED_SETTINGS = {"logistic": {"regParam": 0.01, "elasticNetParam": 0.0},
                  "tree": {"impurity": "gini", "maxDepth": 5, "maxBins": 20, "minInstancesPerNode": 10},
                  "forest": {"numTrees": 50, "maxDepth": 5, "seed": 101},
                  "svm": {"regParam": 0.01}}


def _predict_query(kind: str):
    def run(spark, sf):
        """Predictions of both sides, training rows once each."""
        p = _prepared(spark, sf)
        model = models.fit_plain(p, kind, **FIXED_SETTINGS[kind])
        _, test = sampling.keyed_split(features(spark, sf), "id", 75, 101)
        sides = []
        for side, rows, data in (("train", p.train.select("id", "label"), p.train),
                                 ("test", test.select("id", "label"), p.test)):
            pred = models.predict(model, data.dropDuplicates(["id"])).select(
                "id", "prediction", "score")
            # rows that the encoder skips (a null number) have no prediction
            sides.append(rows.dropDuplicates(["id"]).join(pred, "id", "left").select(
                F.lit(side).alias("side"), "id", F.col("label").cast("int").alias("label"),
                F.col("prediction").isNotNull().alias("predicted"),
                F.col("prediction").isin(0, 1).alias("valid"),
                (F.col("prediction") == (F.col("score") > models.THRESHOLDS[kind]).cast("int"))
                .alias("agrees")))
        return sides[0].unionByName(sides[1])
    return run


_NUMBERS_GIVEN = " and ".join(f"{c} is not null" for c in models.NUMERIC)
_PREDICT_SQL = on_features(f"""
select 'train' as side, id, label, true as predicted, true as valid, true as agrees
from (select distinct id, label from (select * from neg union all select * from pos) r
      where {_NUMBERS_GIVEN}) a
union all
select 'test', id, label, {_NUMBERS_GIVEN}, case when {_NUMBERS_GIVEN} then true end,
       case when {_NUMBERS_GIVEN} then true end
from features where not {_hash_sql('101', 'id')} % 100 < 75""", *_REBALANCE_CTES)
for _kind, _name in (("logistic", "lr_predict"), ("tree", "dt_predict"),
                     ("forest", "rf_predict"), ("svm", "svc_predict")):
    register(_name, _PREDICT_SQL)(_predict_query(_kind))

register("svc_searched_predict", on_features(f"""
select id, label, {_NUMBERS_GIVEN} as predicted, case when {_NUMBERS_GIVEN} then true end as valid,
       case when {_NUMBERS_GIVEN} then true end as agrees from features"""))(
    _searched_predict_query("svm"))


# ------------------------------------------------------------ SQL text on a temp view (S3, L-1)

@register("sql_category_goals", on_campaigns("""
select mainCategory, state, count(*) as campaigns, round(max(goal), 2) as largest_goal
from campaigns where state in ('successful', 'failed') group by mainCategory, state"""))
def sql_category_goals(spark, sf):
    """S3: the campaign table as a session temp view, queried with SQL text."""
    campaigns(spark, sf).createOrReplaceTempView("fundscope_campaigns")
    return spark.sql("""
        SELECT mainCategory, state, count(1) AS campaigns, round(max(goal), 2) AS largest_goal
        FROM fundscope_campaigns
        WHERE state = 'successful' OR state = 'failed'
        GROUP BY ALL""")


@register("standardize_embeddings", """
with e as (select vec_id, unnest(embedding)::double as x,
                  unnest(generate_series(0, len(embedding) - 1)) as dim from embeddings),
s as (select dim, avg(x) as m, stddev_samp(x) as sd from e group by dim)
select e.vec_id, cast(e.dim as integer) as dim,
       case when s.sd = 0 then 0.0 else round((e.x - s.m) / s.sd, 4) end as value
from e join s using (dim)""")
def standardize_embeddings(spark, sf):
    """M3+M4 on the 64-wide embedding vectors: standardize every slot, long form."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    emb = tables.load(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double")))
        .alias("vec"))
    scaled = StandardScaler(inputCol="vec", outputCol="scaled", withMean=True,
                            withStd=True).fit(emb).transform(emb)
    return scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("dim", "v")
                         ).select("vec_id", F.col("dim").cast("int").alias("dim"),
                                  F.round("v", 4).alias("value"))


_ENCODE_CTES = _REBALANCE_CTES + (
    "rb as (select * from neg union all select * from pos)",
    """sidx as (select newsubCategory,
        row_number() over (order by count(*) desc, newsubCategory) - 1 as si
        from rb group by newsubCategory)""",
    """sz as (select max(staff_pick) + 1 as s_sp, max(countryUS) + 1 as s_us,
        (select count(*) from sidx) as s_sc, max(monthdead) + 1 as s_md,
        max(monthLaunched) + 1 as s_ml, max(goalBin) + 1 as s_gb from rb)""",
    """off as (select s_sp, s_us, s_sc, s_md, s_ml, s_gb, 0 as o_sp, s_sp - 1 as o_us,
        s_sp + s_us - 2 as o_sc, s_sp + s_us + s_sc - 3 as o_md,
        s_sp + s_us + s_sc + s_md - 4 as o_ml, s_sp + s_us + s_sc + s_md + s_ml - 5 as o_gb,
        s_sp + s_us + s_sc + s_md + s_ml + s_gb - 6 as o_num from sz)""",
    """ok as (select rb.*, sidx.si from rb join sidx using (newsubCategory)
        where blurblen is not null and namelen is not null and campaignlen is not null
          and preparelen is not null)""",
    """raw as (
        select id, copy_no, o_sp + k as slot, (staff_pick = k)::double as x
          from (select *, unnest(range(0, s_sp - 1)) as k from ok, off)
        union all select id, copy_no, o_us + k, (countryUS = k)::double
          from (select *, unnest(range(0, s_us - 1)) as k from ok, off)
        union all select id, copy_no, o_sc + k, (si = k)::double
          from (select *, unnest(range(0, s_sc - 1)) as k from ok, off)
        union all select id, copy_no, o_md + k, (monthdead = k)::double
          from (select *, unnest(range(0, s_md - 1)) as k from ok, off)
        union all select id, copy_no, o_ml + k, (monthLaunched = k)::double
          from (select *, unnest(range(0, s_ml - 1)) as k from ok, off)
        union all select id, copy_no, o_gb + k, (goalBin = k)::double
          from (select *, unnest(range(0, s_gb - 1)) as k from ok, off)
        union all select id, copy_no, o_num, blurblen::double from ok, off
        union all select id, copy_no, o_num + 1, namelen::double from ok, off
        union all select id, copy_no, o_num + 2, campaignlen::double from ok, off
        union all select id, copy_no, o_num + 3, preparelen::double from ok, off)""",
    """mom as (select slot, avg(x) as m, stddev_samp(x) as sd from raw group by slot)""",
)


@register("encoded_features", on_features("""
select raw.id, cast(raw.slot as integer) as slot,
       case when mom.sd = 0 then 0.0 else round((raw.x - mom.m) / mom.sd, 4) + 0.0 end as value
from raw join mom using (slot)""", *_ENCODE_CTES))
def encoded_features(spark, sf):
    """M2+M3+M4+M5: the encoded, standardized training matrix in long form.

    Index (by frequency), one-hot (drop last), assemble (rows with a null number
    skipped) and standardize, all fitted on the rebalanced training rows.
    """
    from pyspark.ml.functions import vector_to_array
    p = _prepared(spark, sf)
    return (p.train.select("id", F.posexplode(vector_to_array("features")).alias("slot", "v"))
            .select("id", F.col("slot").cast("int").alias("slot"),
                    (F.round("v", 4) + 0.0).alias("value")))



def _unscaled_ctes(base: str) -> tuple[str, ...]:
    """Index, one-hot and assemble the rows of CTE ``base`` (long form ``raw``),
    with every size taken from ``base`` as the fitted stages take it."""
    sidx, sz, off, ok, raw = _ENCODE_CTES[-6:-1]
    return (sidx.replace("from rb", f"from {base}"), sz.replace("from rb", f"from {base}"),
            off, ok.replace("from rb join", f"from {base} rb join"), raw)


@register("indexed_features", on_features("""
select raw.id, cast(raw.slot as integer) as slot,
       case when nd.n > 20 then raw.x else cast(ix.idx as double) end as value
from raw join nd using (slot) left join ix on ix.slot = raw.slot and ix.v = raw.x""",
    "fb as (select *, 0 as copy_no from features)", *_unscaled_ctes("fb"),
    "dv as (select distinct slot, x as v from raw)",
    "nd as (select slot, count(*) as n, max(case when v = 0 then 1 else 0 end) as has_zero "
    "from dv group by slot)",
    """ix as (select dv.slot, dv.v,
        case when dv.v = 0 then 0
             else row_number() over (partition by dv.slot, dv.v = 0 order by dv.v) - 1
                  + nd.has_zero end as idx
        from dv join nd using (slot))"""))
def indexed_features(spark, sf):
    """M7 checked: categorical slots (<= 20 values) re-indexed, long form.

    Value 0 keeps index 0 (documented); other values take ascending order,
    which is Spark's current assignment. Continuous slots pass through.
    """
    from pyspark.ml.functions import vector_to_array
    f = features(spark, sf)
    enc = models.encoder_stages(scale=False, output="modelFeatures").fit(f).transform(f)
    vi = models.vector_indexer("modelFeatures", "indexFeatures").fit(enc)
    return (vi.transform(enc)
            .select("id", F.posexplode(vector_to_array("indexFeatures")).alias("slot", "v"))
            .select("id", F.col("slot").cast("int").alias("slot"), F.col("v").alias("value")))


@register("blurb_counter", on_campaigns(
    "select blurb, count(*) as count from campaigns group by blurb"))
def blurb_counter(spark, sf):
    """A14, ``Counter`` semantics: the null blurb is a value of its own."""
    return stats.value_counts(campaigns(spark, sf), "blurb", include_null=True)


@register("blurb_value_counts", on_campaigns(
    "select blurb, count(*) as count from campaigns where blurb is not null group by blurb"))
def blurb_value_counts(spark, sf):
    """A14, ``value_counts`` semantics: nulls dropped, largest first."""
    return stats.value_counts(campaigns(spark, sf), "blurb", include_null=False)


# ------------------------------------------------------------ file round trips

def _export_dir(spark, kind: str) -> str:
    """A fresh folder under the reliable checkpoint folder (shared on a cluster)."""
    from fundscope.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/{kind}-{uuid.uuid4().hex}"


@register("table_round_trip", on_campaigns("select id, name, url from campaigns"))
def table_round_trip(spark, sf):
    """Campaigns saved as a managed table and read from the catalog."""
    from fundscope.sources import files
    name = f"fundscope_export_{uuid.uuid4().hex}"
    files.save_table(campaigns(spark, sf).select("id", "name", "url"), name)
    return spark.table(name)


def laid_out(spark, sf, buckets: int = 8) -> tuple[DataFrame, DataFrame, list[str]]:
    """Two crawls of the campaigns as managed tables laid out by id, and the tables' names."""
    from fundscope.sources import files
    names = [f"fundscope_laid_{uuid.uuid4().hex}" for _ in range(2)]
    c = _recrawl(spark, sf).select("id", "name", "url", "launched_at")
    files.save_bucketed(c, names[0], ["id"], buckets)
    files.save_bucketed(c.select("id", F.length("name").alias("name_chars")).distinct(), names[1], ["id"], buckets)
    return spark.table(names[0]), spark.table(names[1]), names


@register("laid_out_tables", on_campaigns("""
select k.id, k.name, cast(max(n.name_chars) as integer) as longest from (
  select id, name, row_number() over (partition by id order by name) as rn from crawl) k
join (select id, length(name) as name_chars from crawl) n using (id)
where rn = 1 group by 1, 2""", _RECRAWL_CTE))
def laid_out_tables(spark, sf):
    """De-duplication (J4) and attachment (J2) on laid-out tables, without a shuffle."""
    crawl, lengths, names = laid_out(spark, sf)
    first = shape.dedupe_by_key(crawl.select("id", "name"), ["id"], order=["name"])
    longest = lengths.groupBy("id").agg(F.max("name_chars").alias("longest"))
    out = stored_table(shape.attach_by_key(first, longest, "id", ["longest"]), "laid-out")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return out


@register("slice_round_trip", on_campaigns("""
select id, name, state, goal, strftime(launched_at, '%Y-%m-%d') as launched_at
from campaigns where mainCategory = 'machinery'"""))
def slice_round_trip(spark, sf):
    """S10 then S6: one category as line JSON with dates as text, read with its schema."""
    from fundscope.sources import files
    path = _export_dir(spark, "slice-json")
    chosen = campaigns(spark, sf).where(F.col("mainCategory") == CATEGORY)
    files.write_json(chosen.withColumn("launched_at", F.date_format("launched_at", "yyyy-MM-dd")),
                     path, compressed=True)
    return files.read_line_json(spark, path, "id long, name string, state string, goal double, "
                                             "launched_at string")


@register("text_file_round_trip", """
with """ + _BATCH_CTE + """
select doc_id as idx, coalesce(text, '') as text, true as complete from batched""")
def text_file_round_trip(spark, sf):
    """Description files written as whole text files, read back one row a file."""
    from fundscope.sources import files
    path = _export_dir(spark, "description-files")
    made = _description_files(spark, sf).select("value", F.col("file_name").alias("file"))
    made.repartition("file").write.partitionBy("file").text(path)
    back = files.read_text_files(spark, f"{path}/*", name_from=r"file=([^/]*)/")
    # the text sink ends every row with a newline
    back = back.withColumn("value", F.regexp_replace("value", r"\n\z", ""))
    return records.assemble_records(back).select("idx", "text", "complete")


@register("columns_like", on_campaigns("""
select created_at, launched_at from campaigns"""))
def columns_like(spark, sf):
    """The columns whose name holds ``ed_at``."""
    c = campaigns(spark, sf)
    return c.select(*shape.columns_like(c, "ed_at"))


@register("merge_scraped", on_campaigns("""
select 'project_scraped_' || lo || '_' || (lo + 500) || '.csv' as file_name, id as row_idx, name
from (select *, (id // 500) * 500 as lo from campaigns)"""))
def merge_scraped(spark, sf):
    """T5: every batch file also holds rows of the next range; only its own count."""
    c = campaigns(spark, sf).select(F.col("id").alias("row_idx"), "name")
    lo = F.floor(F.col("row_idx") / 500) * 500
    batches = [c.withColumn("lo", lo), c.withColumn("lo", lo - 500)]
    rows = batches[0].unionByName(batches[1]).select(
        F.concat(F.lit("project_scraped_"), F.col("lo").cast("string"), F.lit("_"),
                 (F.col("lo") + 500).cast("string"), F.lit(".csv")).alias("file_name"),
        "row_idx", "name")
    return records.merge_scraped(rows)


@register("json_round_trip", ORACLE["flatten_struct"])
def json_round_trip(spark, sf):
    """S5 then S1 + S2: raw crawl records written as line JSON, read back with the
    declared schema and flattened."""
    from fundscope.sources import files
    path = _export_dir(spark, "crawl-json")
    files.write_json(tables.raw_campaigns(spark, sf), path, compressed=True)
    return files.read_campaigns(spark, path)


@register("inferred_json", ORACLE["flatten_struct"])
def inferred_json(spark, sf):
    """Crawl records with broken lines among them, read with the schema that they have."""
    from fundscope.sources import files
    path = _export_dir(spark, "dirty-json")
    raw = tables.raw_campaigns(spark, sf)
    lines = raw.select(F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"}).alias("value"))
    half = F.substring("value", F.lit(1), (F.length("value") / 2).cast("int"))
    # each record and its broken copy in one pass over the joined tables
    files.write_lines(lines.select(F.explode(F.array("value", half)).alias("value")), path, compressed=True)
    # a field that no record sets has no type of its own
    return shape.flatten_campaigns(files.read_inferred_json(spark, path)[0]).withColumn(
        "converted_pledged_amount", F.col("converted_pledged_amount").try_cast("bigint"))


@register("delimited_round_trip", """
select doc_id as idx, coalesce(text, '') as text from documents""")
def delimited_round_trip(spark, sf):
    """Whole documents written as escaped ``idx|text`` lines and read back."""
    from fundscope.sources import files
    path = _export_dir(spark, "descriptions")
    files.write_delimited_text(tables.load(spark, sf, "documents"), path, "doc_id", "text")
    return files.read_delimited_text(spark, path)


@register("csv_round_trip", on_campaigns("""
select c.id as row_idx, c.id, c.name, c.blurb, c.goal, strftime(c.created_at, '%Y-%m-%d') as created_at,
       c.staff_pick, d.text as Description,
       case when c.staff_pick then 1 else 0 end as Image,
       case when c.country = 'NATION_0' then 1 else 0 end as Video
from campaigns c cross join (select count(*) as n from documents) nd
     left join documents d on d.doc_id = c.id % nd.n"""))
def csv_round_trip(spark, sf):
    """S9 then S8: a scraped-batch table (campaign columns, dates as text, whole
    multi-line document texts as ``Description``) written as CSV with a header,
    read back with the declared schema."""
    from fundscope.sources import files
    from fundscope.sources.schemas import SCRAPED
    c = campaigns(spark, sf)
    docs = tables.load(spark, sf, "documents")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    # named as in ``campaigns``, so that both joins read one shuffle of the texts
    docs = docs.select(F.col("doc_id").alias("d_doc_id"), F.col("text").alias("d_text"))
    scraped = (c.join(docs, F.col("d_doc_id") == F.try_mod(F.col("id"), n_docs), "left")
               .withColumnRenamed("d_text", "Description")
               .withColumn("row_idx", F.col("id"))
               .withColumn("converted_pledged_amount", F.lit(None).cast("long"))
               .withColumn("Image", C.bool_to_int("staff_pick"))
               .withColumn("Video", C.indicator(F.col("country") == HOME_COUNTRY)))
    for d in ("created_at", "launched_at", "deadline"):
        scraped = scraped.withColumn(d, F.date_format(d, "yyyy-MM-dd"))
    path = _export_dir(spark, "scraped-csv")
    files.write_csv(scraped.select("row_idx", *[f.name for f in SCRAPED.fields]), path,
                    compressed=True)
    back = files.read_scraped_csv(spark, path)
    return back.select("row_idx", "id", "name", "blurb", "goal", "created_at", "staff_pick",
                       "Description", "Image", "Video")
