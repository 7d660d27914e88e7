"""Column layouts of the layers. The raw layout is fixed: nothing is inferred from the data."""

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


RAW = _struct(
    ("event_id", STRING),
    ("timestamp", STRING),
    ("campaign_id", STRING),
    ("campaign_name", STRING),
    ("campaign_type", STRING),
    ("advertiser", STRING),
    ("platform", STRING),
    ("channel", STRING),
    ("date", STRING),
    ("impressions", INT),
    ("clicks", INT),
    ("conversions", INT),
    ("spend_usd", DOUBLE),
    ("revenue_usd", DOUBLE),
)

#: The raw texts in the order in which they are packed: those with the fewest values first.
PACKED = ["campaign_type", "advertiser", "platform", "channel", "campaign_name", "campaign_id", "event_id", "date", "timestamp"]

CAMPAIGN_ATTRIBUTES = ["campaign_id", "campaign_name", "campaign_type", "advertiser"]

SILVER = T.StructType(
    [T.StructField(f.name, T.DateType() if f.name == "date" else f.dataType, True) for f in RAW]
    + [
        T.StructField(name, DOUBLE, True)
        for name in (
            "ctr",
            "cpc",
            "roas",
            "conversion_rate",
            "rolling_7d_impressions",
            "rolling_7d_clicks",
            "rolling_7d_spend",
            "running_total_spend",
        )
    ]
    + [T.StructField("roas_rank_in_channel", LONG, True)]
)

DIM_CAMPAIGN = _struct(*[(name, STRING) for name in CAMPAIGN_ATTRIBUTES], ("campaign_key", LONG))

DIM_CAMPAIGN_VERSIONS = T.StructType(
    [*DIM_CAMPAIGN.fields, *_struct(("valid_from", T.DateType()), ("valid_to", T.DateType())).fields]
)

DIM_CHANNEL = _struct(
    ("channel_name", STRING), ("platform", STRING), ("channel_type", STRING), ("channel_key", LONG)
)

DIM_DATE = _struct(
    ("full_date", T.DateType()),
    ("year", INT),
    ("quarter", INT),
    ("month", INT),
    ("week", INT),
    ("day", INT),
    ("day_of_week", STRING),
    ("is_weekend", T.BooleanType()),
    ("date_key", INT),
)

FACT = _struct(
    ("event_id", STRING),
    ("campaign_key", LONG),
    ("date_key", INT),
    ("channel_key", LONG),
    ("impressions", INT),
    ("clicks", INT),
    ("conversions", INT),
    ("spend_usd", DOUBLE),
    ("revenue_usd", DOUBLE),
    ("ctr", DOUBLE),
    ("cpc", DOUBLE),
    ("roas", DOUBLE),
    ("rolling_7d_impressions", DOUBLE),
    ("rolling_7d_spend", DOUBLE),
    ("running_total_spend", DOUBLE),
    ("roas_rank_in_channel", LONG),
)

CAMPAIGN_DAILY = _struct(
    *[(name, STRING) for name in CAMPAIGN_ATTRIBUTES],
    ("date", T.DateType()),
    ("total_impressions", LONG),
    ("total_clicks", LONG),
    ("total_conversions", LONG),
    ("total_spend", DOUBLE),
    ("total_revenue", DOUBLE),
    ("avg_ctr", DOUBLE),
    ("avg_roas", DOUBLE),
)

CHANNEL_WEEKLY = _struct(
    ("channel", STRING),
    ("platform", STRING),
    ("year", INT),
    ("week", INT),
    ("total_impressions", LONG),
    ("total_clicks", LONG),
    ("total_spend", DOUBLE),
    ("total_revenue", DOUBLE),
    ("avg_roas", DOUBLE),
    ("avg_ctr", DOUBLE),
)

# The documented domains of the raw columns.
CAMPAIGN_TYPES = ["awareness", "conversion", "retargeting"]
PLATFORMS = ["Google", "Meta"]
CHANNELS = ["Google Search", "Google Display", "Meta Feed", "Meta Stories"]

# Channel name -> channel type, for exact-name lookup.
CHANNEL_TYPES = {
    "Google Search": "search",
    "Google Display": "display",
    "Meta Feed": "social_feed",
    "Meta Stories": "social_story",
}

# Published industry ranges (low, high) of ctr, cpc, conversion rate and roas.
BENCHMARK_BANDS = [
    ("Google Search", 0.02, 0.05, 1.0, 4.0, 0.02, 0.08, 2.0, 5.0),
    ("Google Display", 0.001, 0.005, 0.5, 2.0, 0.005, 0.02, 1.0, 3.0),
    ("Meta Feed", 0.009, 0.015, 0.5, 1.5, 0.01, 0.04, 1.5, 4.0),
    ("Meta Stories", 0.005, 0.01, 0.3, 1.0, 0.008, 0.03, 1.2, 3.5),
]
BENCHMARK_COLUMNS = (
    "channel string, ctr_low double, ctr_high double, cpc_low double, cpc_high double, "
    "cvr_low double, cvr_high double, roas_low double, roas_high double"
)
