"""Declared schemas (no inference pass; numeric fields never come back as strings)."""

from pyspark.sql import types as T

CATEGORY = T.StructType([
    T.StructField("slug", T.StringType()),
    T.StructField("name", T.StringType()),
])
CREATOR = T.StructType([T.StructField("id", T.LongType())])
URLS = T.StructType([
    T.StructField("web", T.StructType([T.StructField("project", T.StringType())])),
])

# One campaign as it sits under ``data`` in the raw crawl. Fields the reference
# drops right after reading are simply not declared, so they are never parsed.
RAW_CAMPAIGN = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("blurb", T.StringType()),
    T.StructField("goal", T.DoubleType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("launched_at", T.LongType()),
    T.StructField("deadline", T.LongType()),
    T.StructField("staff_pick", T.BooleanType()),
    T.StructField("backers_count", T.LongType()),
    T.StructField("converted_pledged_amount", T.LongType()),
    # Seen as number or as text in crawls: read as text, cast with try_cast.
    T.StructField("usd_pledged", T.StringType()),
    T.StructField("category", CATEGORY),
    T.StructField("creator", CREATOR),
    T.StructField("urls", URLS),
])

RAW_RECORD = T.StructType([T.StructField("data", RAW_CAMPAIGN)])

# Flat campaign table, in this column order.
CAMPAIGN = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("blurb", T.StringType()),
    T.StructField("goal", T.DoubleType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("created_at", T.DateType()),
    T.StructField("launched_at", T.DateType()),
    T.StructField("deadline", T.DateType()),
    T.StructField("staff_pick", T.BooleanType()),
    T.StructField("backers_count", T.LongType()),
    T.StructField("converted_pledged_amount", T.LongType()),
    T.StructField("usd_pledged", T.DoubleType()),
    T.StructField("mainCategory", T.StringType()),
    T.StructField("subCategory", T.StringType()),
    T.StructField("creatorID", T.LongType()),
    T.StructField("url", T.StringType()),
])
CAMPAIGN_COLUMNS = tuple(f.name for f in CAMPAIGN.fields)

# Technology slice written as line JSON and read back: dates come back as text.
TECH_SLICE = T.StructType([
    f if not isinstance(f.dataType, T.DateType) else T.StructField(f.name, T.StringType())
    for f in CAMPAIGN.fields
])

# Scraped batch CSV: campaign columns plus the page-derived columns.
SCRAPED = T.StructType(TECH_SLICE.fields + [
    T.StructField("Description", T.StringType()),
    T.StructField("Image", T.IntegerType()),
    T.StructField("Video", T.IntegerType()),
])

FEATURE_COLUMNS = ("staff_pick", "blurblen", "namelen", "countryUS", "campaignlen",
                   "preparelen", "newsubCategory", "monthdead", "monthLaunched",
                   "goalBin", "label")
