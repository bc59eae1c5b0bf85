"""Log parsers: a DataFrame with a ``line`` column in, the same rows with record columns out.

A row that is no log line keeps its place, with the reason in ``parse_error``; see ``split_malformed``.
Other input columns, such as the file a line came from, pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake import schemas
from accesslake.functions import text, times

# The two line formats.
COMBINED_PATTERN = r'([(\p{Nd}.):]+) ([^ ]+) ([^ ]+) \[(.*)\] "(.*)" (\p{Nd}+) (\p{Nd}+|-)( "[^"]*")?( "[^"]*")?'
BUCKET_TOKEN_PATTERN = r'"([^"]+)"|\[([^\]]+)\]|([^ ]+)'
BUCKET_MIN_TOKENS = 17
# Token positions of a bucket log.
BUCKET_POSITIONS = {
    "bucket_owner": 0, "bucket": 1, "time": 2, "remote_ip": 3, "requester": 4, "request_id": 5,
    "operation": 6, "key": 7, "request_uri": 8, "http_status": 9, "error_code": 10, "bytes_sent": 11,
    "object_size": 12, "total_time": 13, "turn_around_time": 14, "referer": 15, "user_agent": 16,
    "version_id": 17, "host_id": 18, "signature_version": 19, "cipher_suite": 20,
    "authentication_type": 21, "host_header": 22, "tls_version": 23,
}

# A line holds no line feed, so it can separate what one pass of a pattern finds.
_SEP = "\n"

_FORMATS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_log_format(name: str, parser: Callable[[DataFrame], DataFrame]) -> None:
    """Make a ``DataFrame -> DataFrame`` parser available under a name."""
    _FORMATS[name] = parser


def parse_logs(lines: DataFrame, log_format: str) -> DataFrame:
    """Parse with the named format: ``web``, ``bucket``, these with ``_lenient`` dates, or one registered."""
    if log_format not in _FORMATS:
        raise KeyError(f"no log format {log_format!r}; known: {sorted(_FORMATS)}")
    return lines.transform(_FORMATS[log_format])


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that filters further up read but do not compute again.

    Catalyst moves filters below a projection by copying its expressions into them, which would
    match the line's pattern once per test. It does not do so with the output of a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _finish(fields: DataFrame, columns: list, lenient: bool) -> DataFrame:
    """Add both clocks and the parse error to rows with ``_ok``, ``_date`` (cleaned), ``_raw`` (as written) and ``_status``."""
    dated = fields.withColumn("_zoned", times.with_offset(F.col("_date")))
    timed = _computed_once(dated, "dtime", times.log_instant(F.col("_zoned")))
    wall = times.log_wall_clock(F.col("_zoned"), F.col("dtime"))
    if lenient:
        # only dates that are not written as logs write them are held against other shapes
        other = F.when(F.col("dtime").isNull(), times.lenient_parts(F.substring_index("_raw", "]", 1)))
        parts = _computed_once(timed, "_parts", other)
        walls = _computed_once(parts, "_wall", times.lenient_wall_clock(F.col("_parts")))
        wall = F.coalesce(F.col("_wall"), wall)
        timed = walls.withColumn("_wall", wall).withColumn("dtime", F.coalesce("dtime", times.lenient_instant(F.col("_parts"), F.col("_wall"))))
        wall = F.col("_wall")
    status = text.safe_int(F.col("_status"), "int")
    error = (
        F.when(~F.col("_ok"), F.lit("fields"))
        .when(F.col("dtime").isNull(), F.lit("time"))
        .when((F.col("_status") != "-") & status.isNull(), F.lit("status"))
    )
    derived = {"dtime_local": wall, "http_status": status, "parse_error": error}
    return timed.select(*[derived[c].alias(c) if isinstance(c, str) and c in derived else c for c in columns])


def parse_web_log(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """Combined web log. The pattern is matched once per line and its groups split off.

    ``lenient`` also reads dates of the shapes in ``functions.times``.
    """
    passed = [c for c in lines.columns if c != "line"]
    groups = F.split(
        F.regexp_replace(
            "line", rf"(?d)^{COMBINED_PATTERN}[\s\S]*$", _SEP.join(f"${i}" for i in range(1, 10))
        ),
        _SEP,
    )
    ok = F.size("_g") == 9

    def group(i: int) -> Column:
        return F.when(ok, F.get("_g", F.lit(i - 1)))

    def quoted(i: int) -> Column:
        g = F.nullif(F.get("_g", F.lit(i - 1)), F.lit(""))
        return F.substring(g, F.lit(3), F.length(g) - 3)

    fields = _computed_once(lines, "_g", groups).select(
        *passed,
        "line",
        ok.alias("_ok"),
        group(1).alias("remote_ip"),
        group(2).alias("ident"),
        group(3).alias("user"),
        times.clean_log_date(group(4)).alias("_date"),
        group(4).alias("_raw"),
        group(5).alias("request"),
        text.request_method(group(5)).alias("method"),
        text.request_url(group(5)).alias("url"),
        group(6).alias("_status"),
        text.safe_int(group(7)).alias("bytes_sent"),
        quoted(8).alias("referrer"),
        quoted(9).alias("user_agent"),
    )
    return _finish(
        fields,
        [
            *passed,
            F.lit("web").alias("source"),
            "line",
            "dtime",
            "dtime_local",
            "remote_ip",
            F.when(F.col("_ok"), F.lit(schemas.WEB_OPERATION)).alias("operation"),
            F.when(F.col("_ok"), text.url_path(F.col("url"))).alias("key"),
            "http_status",
            "bytes_sent",
            F.col("bytes_sent").alias("object_size"),
            "user_agent",
            "ident",
            "user",
            "request",
            "method",
            "url",
            "referrer",
            "parse_error",
        ],
        lenient,
    )


def parse_bucket_log(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """Object-store bucket log: the line is cut into tokens once, then read by position.

    A token yields three parts, as quoted, bracketed or bare text; two of them are empty. A field reads
    the part of its own kind, so one that is quoted where it should not be reads as empty.
    """
    passed = [c for c in lines.columns if c != "line"]
    parts = F.split(F.regexp_replace("line", f" *(?:{BUCKET_TOKEN_PATTERN})", _SEP.join(("$1", "$2", "$3", ""))), _SEP)
    ok = F.size("_p") > 3 * BUCKET_MIN_TOKENS

    def part(name: str, kind: int) -> Column:
        return F.get("_p", F.lit(3 * BUCKET_POSITIONS[name] + kind))

    def quoted(name: str) -> Column:
        return part(name, 0).alias(name)

    def bare(name: str) -> Column:
        return part(name, 2).alias(name)

    def number(name: str) -> Column:
        return text.safe_int(part(name, 2)).alias(name)

    fields = _computed_once(lines, "_p", parts).select(
        "*",
        ok.alias("_ok"),
        times.clean_log_date(part("time", 1)).alias("_date"),
        part("time", 1).alias("_raw"),
        part("http_status", 2).alias("_status"),
    )
    return _finish(
        fields,
        [
            *passed,
            F.lit("bucket").alias("source"),
            "line",
            "dtime",
            "dtime_local",
            bare("remote_ip"),
            bare("operation"),
            text.percent_decode(part("key", 2)).alias("key"),
            "http_status",
            number("bytes_sent"),
            number("object_size"),
            quoted("user_agent"),
            bare("bucket_owner"),
            bare("bucket"),
            bare("requester"),
            bare("request_id"),
            quoted("request_uri"),
            bare("error_code"),
            number("total_time"),
            number("turn_around_time"),
            quoted("referer"),
            bare("version_id"),
            bare("host_id"),
            bare("signature_version"),
            bare("cipher_suite"),
            bare("authentication_type"),
            bare("host_header"),
            bare("tls_version"),
            "parse_error",
        ],
        lenient,
    )


register_log_format("web", parse_web_log)
register_log_format("bucket", parse_bucket_log)
register_log_format("web_lenient", partial(parse_web_log, lenient=True))
register_log_format("bucket_lenient", partial(parse_bucket_log, lenient=True))


def good_records(parsed: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Rows that parsed. With ``mode="failfast"`` the first row that did not ends the job.

    A later filter must not drop a malformed row before it is reported. It would be moved below this
    one, but not below a filter that is not deterministic, as one on the partition number counts.
    """
    error = F.col("parse_error")
    if mode == "quarantine":
        keep = error.isNull()
    elif mode == "failfast":
        report = F.concat(F.lit("malformed log line ("), error, F.lit("): "), F.col("line"))
        always = F.spark_partition_id() >= 0
        keep = F.when(error.isNull(), always).otherwise(F.raise_error(report).cast("boolean"))
    else:
        raise ValueError(f"mode is 'quarantine' or 'failfast', not {mode!r}")
    return parsed.filter(keep).drop("parse_error")


def malformed_lines(parsed: DataFrame) -> DataFrame:
    """The error log: raw text and reason of every row that did not parse."""
    return parsed.filter(F.col("parse_error").isNotNull()).select("line", "parse_error")


def unify_logs(*records: DataFrame) -> DataFrame:
    """One table of records from parsers of any format; columns a format lacks are NULL."""
    first, *others = records
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def normalize_keys(records: DataFrame) -> DataFrame:
    """Keys without leading slashes, so that a file reached over both kinds of log has one key.

    Web keys start with a slash and bucket keys do not; without this step they are two files.
    """
    return records.withColumn("key", F.ltrim("key", F.lit("/")))
