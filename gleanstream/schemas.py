"""Fixed schemas. Nothing here is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# --- fixed values: field names of a message, a stored row and a published row ---
MESSAGE_FIELDS = (
    "SearchKeyWord", "Job", "Company", "Salary",
    "Location", "Deadline", "JobDetails", "Created",
)
POSTING_FIELDS = (
    "SearchWord", "Job", "Company", "Salary",
    "Location", "Deadline", "JobsDetails", "Created",
)
TOPIC = "jobs-data"
MESSAGE_KEY = "name"
NOT_ENCODABLE = "Not found"
NO_SALARY = "Not disclosed"
LISTINGS_PER_PAGE = 15
SNAPSHOT_MAX_COLUMNS = 26
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# --- end of fixed values ---

# Position decides: message field i becomes posting column i.
MESSAGE_TO_POSTING = dict(zip(MESSAGE_FIELDS, POSTING_FIELDS, strict=True))
EXTRACTED_FIELDS = MESSAGE_FIELDS[1:-1]
PUBLISHED_FIELDS = (*POSTING_FIELDS, "QueryAt")

LISTING = _strings(*MESSAGE_FIELDS)
POSTING = _strings(*POSTING_FIELDS)
PUBLISHED = _strings(*PUBLISHED_FIELDS)

CAPTURE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

RAW = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
