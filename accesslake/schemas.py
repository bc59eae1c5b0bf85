"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Operation names per family, as they appear in bucket access logs.
# A name is looked up in the order GET, WRITE, DELETE, MISC.
# ---------------------------------------------------------------------------------------------
GET_OPERATIONS = (
    "REST.GET.OBJECT",
    "REST.COPY.PART_GET",
    "WEBSITE.GET.OBJECT",
)
WRITE_OPERATIONS = (
    "REST.PUT.PART",
    "REST.PUT.OBJECT",
    "REST.POST.OBJECT",
    "REST.POST.UPLOAD",
    "REST.POST.UPLOADS",
    "REST.COPY.PART",
)
DELETE_OPERATIONS = (
    "REST.DELETE.OBJECT",
    "REST.DELETE.UPLOAD",
    "REST.POST.MULTI_OBJECT_DELETE",
    "REST.PUT.BUCKET",
    "REST.PATCH.BUCKET",
    "REST.DELETE.BUCKET",
    "S3.EXPIRE.OBJECT",
)
MISC_OPERATIONS = (
    "REST.COPY.NOTIFICATION",
    "REST.COPY.OBJECT",
    "REST.COPY.OBJECT_GET",
    "REST.GET.ACCELERATE",
    "REST.GET.ACL",
    "REST.GET.ANALYTICS",
    "REST.HEAD.TORRENT",
    "REST.GET.BUCKET",
    "REST.GET.BUCKETPOLICY",
    "REST.GET.BUCKETVERSIONS",
    "REST.GET.CORS",
    "REST.GET.ENCRYPTION",
    "REST.GET.INTELLIGENT_TIERING",
    "REST.GET.INVENTORY",
    "REST.GET.LIFECYCLE",
    "REST.GET.LOCATION",
    "REST.GET.LOGGING_STATUS",
    "REST.GET.NOTIFICATION",
    "REST.GET.OBJECT_ATTRIBUTES",
    "REST.GET.OBJECT_LOCK_CONFIGURATION",
    "REST.GET.OBJECT_TAGGING",
    "REST.GET.OWNERSHIP_CONTROLS",
    "REST.GET.POLICY_STATUS",
    "REST.GET.PUBLIC_ACCESS_BLOCK",
    "REST.GET.REPLICATION",
    "REST.GET.REQUEST_PAYMENT",
    "REST.GET.TAGGING",
    "REST.GET.UPLOAD",
    "REST.GET.UPLOADS",
    "REST.GET.VERSIONING",
    "REST.GET.WEBSITE",
    "REST.HEAD.BUCKET",
    "REST.HEAD.OBJECT",
    "REST.OPTIONS.PREFLIGHT",
    "REST.POST.BUCKET",
    "REST.POST.LOCATION",
    "REST.POST.NOTIFICATION",
    "REST.POST.OBJECT_ATTRIBUTES",
    "REST.POST.RESTORE",
    "REST.POST.SELECT",
    "REST.POST.TORRENT",
    "REST.POST.WEBSITE",
    "REST.PUT.BUCKETPOLICY",
    "REST.PUT.LOGGING_STATUS",
    "REST.PUT.METRICS",
    "REST.PUT.NOTIFICATION",
    "REST.PUT.VERSIONING",
    "REST.PUT.WEBSITE",
    "S3.TRANSITION_INT.OBJECT",
    "WEBSITE.HEAD.OBJECT",
    "WEBSITE.INVALIDOPERATION",
)
WEB_OPERATION = "WEBSITE.GET.OBJECT"

# Record classes.
DOWNLOAD = "DOWNLOAD"
UPLOAD = "UPLOAD"
BAD = "BAD"
DELETED = "DELETED"
MISC = "MISC"
BLOCKED = "BLOCKED"
UNKNOWN = "UNKNOWN"

# Columns every parsed record has, whatever its log format.
COMMON_FIELDS = [
    T.StructField("source", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("dtime", T.TimestampType()),
    T.StructField("dtime_local", T.TimestampNTZType()),
    T.StructField("remote_ip", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("bytes_sent", T.LongType()),
    T.StructField("object_size", T.LongType()),
    T.StructField("user_agent", T.StringType()),
]
WEB_FIELDS = [
    T.StructField(name, T.StringType())
    for name in ("ident", "user", "request", "method", "url", "referrer")
]
BUCKET_FIELDS = [
    T.StructField("bucket_owner", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("requester", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("request_uri", T.StringType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("total_time", T.LongType()),
    T.StructField("turn_around_time", T.LongType()),
    T.StructField("referer", T.StringType()),
    T.StructField("version_id", T.StringType()),
    T.StructField("host_id", T.StringType()),
    T.StructField("signature_version", T.StringType()),
    T.StructField("cipher_suite", T.StringType()),
    T.StructField("authentication_type", T.StringType()),
    T.StructField("host_header", T.StringType()),
    T.StructField("tls_version", T.StringType()),
]
COMMON = T.StructType(COMMON_FIELDS)
ACCESS_LOG = T.StructType(COMMON_FIELDS + WEB_FIELDS + BUCKET_FIELDS)

# Surrogate ids are 128-bit digests of the natural key (see functions/ids.py).
DOWNLOADABLE = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("s3key", T.StringType(), False),
        T.StructField("modified", T.TimestampType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("tags", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("sha2_256", T.StringType()),
        T.StructField("sha3_256", T.StringType()),
        T.StructField("present", T.BooleanType()),
    ]
)
USER_AGENTS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("user_agent", T.StringType()),
    ]
)
DOWNLOADS = T.StructType(
    [
        T.StructField("did", T.StringType(), False),
        T.StructField("user_agent_id", T.StringType()),
        T.StructField("remote_ipaddr", T.StringType()),
        T.StructField("dtime", T.TimestampNTZType(), False),
        T.StructField("bytes_sent", T.LongType()),
        T.StructField("summary", T.BooleanType()),
        T.StructField("dt", T.DateType()),
    ]
)
LISTING = T.StructType(
    [
        T.StructField("s3key", T.StringType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("etag", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("storage_class", T.StringType()),
    ]
)
