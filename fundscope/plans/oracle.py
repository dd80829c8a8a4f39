"""DuckDB oracle SQL for the registered queries.

Shared building blocks are CTEs: ``campaigns`` (the stand-in over the driver
tables), ``features`` (the campaign features) and ``scored`` (a deterministic
scorer used in place of a fitted model for the metric oracles).
"""

CAMPAIGNS = """
campaigns as (
select o_orderkey as id,
       concat(c_name, ' #', cast(o_orderkey % 5 as varchar(20))) as name,
       case when o_orderkey % 50 = 0 then null else d.text end as blurb,
       o_totalprice as goal,
       case when o_orderstatus = 'F' then 'successful' when o_orderstatus = 'P' then 'failed'
            when o_orderkey % 3 = 0 then 'live' when o_orderkey % 3 = 1 then 'canceled'
            else 'suspended' end as state,
       n_name as country, 'USD' as currency,
       o_orderpriority = '1-URGENT' as staff_pick,
       cast(o_orderdate as date) as created_at,
       cast(o_orderdate as date) + cast(o_orderkey % 90 as int) as launched_at,
       cast(o_orderdate as date) + cast(o_orderkey % 90 + 1 + o_custkey % 60 as int) as deadline,
       lower(c_mktsegment) as mainCategory, substr(o_orderpriority, 3) as subCategory,
       concat('https://c.example/', cast(cast(floor(o_orderkey / 2) as bigint) as varchar(20))) as url,
       c_custkey as creatorID, o_custkey % 400 as backers_count, o_totalprice as usd_pledged
from orders join customer on o_custkey = c_custkey
            join nation on c_nationkey = n_nationkey
            cross join (select count(*) as n from documents) nd
            left join documents d on d.doc_id = o_orderkey % nd.n
)"""

FEATURES = """
features as (
select id,
       case when staff_pick = true then 1 else 0 end as staff_pick,
       cast(length(blurb) as integer) as blurblen,
       cast(length(name) as integer) as namelen,
       case when country = 'NATION_0' then 1 else 0 end as countryUS,
       cast(date_diff('day', launched_at, deadline) as integer) as campaignlen,
       cast(date_diff('day', created_at, launched_at) as integer) as preparelen,
       case when subCategory in ('URGENT', 'HIGH', 'MEDIUM') then subCategory
            else 'Other' end as newsubCategory,
       cast(month(deadline) as integer) as monthdead,
       cast(month(launched_at) as integer) as monthLaunched,
       case when goal < 15000 then 1 when goal < 35000 then 2 when goal < 55000 then 3
            else 4 end as goalBin,
       case when state = 'successful' then 1 else 0 end as label
from campaigns
where state <> 'live' and created_at >= date '1996-01-01' and mainCategory = 'machinery'
)"""

SCORED = """
scored as (
select id, label,
       2*staff_pick + (4 - goalBin) + preparelen % 3 as score,
       case when 2*staff_pick + (4 - goalBin) + preparelen % 3 >= 2 then 1 else 0 end as prediction
from features
)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "with " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def on_campaigns(body: str, *extra: str) -> str:
    return with_ctes(body, CAMPAIGNS, *extra)


def on_features(body: str, *extra: str) -> str:
    return with_ctes(body, CAMPAIGNS, FEATURES, *extra)


def on_scored(body: str, *extra: str) -> str:
    return with_ctes(body, CAMPAIGNS, FEATURES, SCORED, *extra)
