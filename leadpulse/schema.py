"""Schemas and fixed layout values of the lead data model."""

from pyspark.sql import types as T

# --- fixed values: they must equal the archived line format ------------------
# Lead fields in line order (position = index after splitting on ";").
LEAD_FIELDS = (
    "leadId", "createTime", "dealerId", "dealerName",
    "countyCode", "countyName", "cityCode", "cityName",
    "provinceCode", "provinceName", "regionCode", "regionName",
    "seriesCode", "seriesName", "vfrom1", "vfrom2", "vfrom3", "vfrom4",
    "newLeadHQ", "newLeadDealer",
)
FLAG_FIELDS = ("newLeadHQ", "newLeadDealer")
LINE_SEPARATOR = ";"
MISSING = "\\N"
LINE_TAG = "lead_center"
# Dimension key of the per-source counters, and its result-table names.
DIMS = ("vfrom1", "vfrom2", "vfrom3", "vfrom4", "regionCode", "provinceCode")
DIM_COLUMNS = ("vfrom1", "vfrom2", "vfrom3", "vfrom4", "region_code", "province_code")
# Result tables: (date column, count column).
TOTAL_COLUMNS = ("clue_dt", "clue_amounts")
HQ_COLUMNS = ("clue_hq_dt", "clue_hq_amounts")
DEALER_COLUMNS = ("clue_new_dt", "clue_new_amounts")
# -----------------------------------------------------------------------------

TEXT_FIELDS = tuple(f for f in LEAD_FIELDS if f not in FLAG_FIELDS)
CORRUPT_COLUMN = "_corrupt_record"

# Every field is read as STRING: flags arrive as "true"/"false"/"" and a
# BOOLEAN field would send the string forms to the corrupt column.
LEAD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in LEAD_FIELDS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

# Envelope of one message: the contract of every source.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("ingest_ts", T.TimestampType()),
])

# Identity message (all identity fields are NULL in what is sent, so only the
# dates carry values; NULL fields are omitted from the JSON text).
ONEID_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (
        "oneId", "idCard", "driverNo", "aId", "mobile", "cookieId",
        "deviceId", "unionId", "openId", "vin", "faceId", "source")]
    + [T.StructField("createTime", T.LongType()),
       T.StructField("updateTime", T.LongType())]
)

# Reply of the identity service; ``data`` stays raw JSON text.
REPLY_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("data", T.StringType()),
])
