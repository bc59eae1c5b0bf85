"""One query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.functions import digests, ids, text, times
from accesslake.operators import catalog as C
from accesslake.operators import classify as K
from accesslake.operators import merge as M
from accesslake.operators import parse as P
from accesslake.operators import reports as R
from accesslake.operators import rollup as A
from accesslake.operators import star as S
from accesslake.plans.summarize import reroll_days
from accesslake.session import scratch_path
from accesslake.sources.logs import archive_lines, scan_logs, stream_logs
from accesslake.streaming import ingest as SI
from accesslake.streaming import live as SL
from accesslake.workload import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared steps -------------------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.good_records(P.parse_bucket_log(I.bucket_lines(spark, sf_dir)))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.classify(_records(spark, sf_dir))


def _downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.downloads_only(_classified(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fact_rows(_downloads(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = I.events(spark, sf_dir).select("k").distinct()
    return keys.select(ids.surrogate_id(F.col("k")).alias("did"), F.col("k").alias("s3key"))


def _agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = I.events(spark, sf_dir).select("ua").distinct()
    return names.select(ids.surrogate_id(F.col("ua")).alias("user_agent_id"), F.col("ua").alias("user_agent"))


def _named(facts: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with key and agent in place of ids."""
    return (
        facts.join(_files(spark, sf_dir), "did")
        .join(_agents(spark, sf_dir), "user_agent_id", "left")
        .drop("did", "user_agent_id")
    )


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- sources and sinks --------------------------------------------------------------------------


@query
def scan_log_lines(spark, sf_dir):
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    lines = scan_logs(spark, I.stage_text(ev, "scan"))
    return lines.select("line", F.regexp_extract("file_path", r"day=(\d{4}-\d\d-\d\d)", 1).alias("day"))


@query
def archive_lines_by_year(spark, sf_dir):
    lines = I.with_order_line(I.orders(spark, sf_dir)).select("line")
    path = scratch_path(spark, "archive")
    archive_lines(K.downloads_only(K.classify(P.good_records(P.parse_web_log(lines)))), path)
    return spark.read.text(path).select(F.col("year").cast("int").alias("year"), F.col("value").alias("line"))


@query
def export_catalog_json(spark, sf_dir):
    exported = R.export_catalog_json(I.catalog(spark, sf_dir))
    names = ("s3key", "etag", "sha2_256", "bytes")
    fields = exported.select(*[F.get_json_object("json", f"$.{c}").alias(c) for c in names])
    return fields.withColumn("bytes", F.col("bytes").cast("bigint"))


# --- parsing ------------------------------------------------------------------------------------


@query
def parse_web_log(spark, sf_dir):
    lines = I.with_web_line(I.spread_events(spark, sf_dir)).select("line")
    return P.good_records(P.parse_web_log(lines)).select(
        "remote_ip", "ident", "user", I.utc("dtime").alias("dtime"), "dtime_local", "request", "method", "url",
        "key", "http_status", "bytes_sent", "referrer", "user_agent", "operation",
    )


@query
def parse_s3_log(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "bucket_owner", "bucket", I.utc("dtime").alias("dtime"), "dtime_local", "remote_ip", "requester", "request_id",
        "operation", "key", "request_uri", "http_status", "bytes_sent", "object_size", "user_agent",
    )


@query
def parse_log_time(spark, sf_dir):
    dirty = F.concat(I.log_time("wall", "-0400"), F.lit('] "GET /x y z 203.0.113.5'))
    dates = I.orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("no date")).otherwise(dirty).alias("raw"),
    )
    cleaned = dates.select("o_orderkey", times.clean_log_date(F.col("raw")).alias("cleaned"))
    zoned = cleaned.withColumn("zoned", times.with_offset(F.col("cleaned")))
    timed = zoned.withColumn("instant", times.log_instant(F.col("zoned")))
    return timed.select(
        "o_orderkey",
        "cleaned",
        I.utc("instant").alias("dtime"),
        times.log_wall_clock(F.col("zoned"), F.col("instant")).alias("dtime_local"),
    )


@query
def parse_lenient_times(spark, sf_dir):
    """Dates in the shape of the logs and in five others; one in seven is none."""
    w, n = F.col("wall"), F.pmod("o_orderkey", F.lit(7))
    shapes = (
        I.log_time("wall", "-0700"), F.concat(F.date_format(w, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250Z")), F.date_format(w, "EEE MMM dd HH:mm:ss yyyy"),
        F.date_format(w, "MMMM d, yyyy h:mm:ss a"), F.concat(F.date_format(w, "M/d/yyyy HH:mm"), F.lit(" +02:00")), F.date_format(w, "yyyyMMdd"),
    )
    date = F.lit("31/Feb/2024 01:02:03")
    for i, shape in enumerate(shapes):
        date = F.when(n == i, shape).otherwise(date)
    number = F.col("o_orderkey").cast("string")
    line = F.concat(F.lit("1.2.3.4 - - ["), date, F.lit('] "GET /'), number, F.lit(' HTTP/1.1" 200 5'))
    parsed = P.parse_logs(I.orders(spark, sf_dir).select(line.alias("line")), "web_lenient")
    return parsed.select(F.ltrim("key", F.lit("/")).alias("number"), I.utc("dtime").alias("dtime"), "dtime_local", "parse_error")


@query
def safe_int(spark, sf_dir):
    return I.events(spark, sf_dir).select(
        "event_id",
        text.safe_int(F.col("bs")).alias("bytes_sent"),
        text.safe_int(F.col("st"), "int").alias("http_status"),
        text.safe_int(F.when(F.col("event_type") == "view", F.col("op")).otherwise(F.col("sz"))).alias("object_size"),
    )


@query
def quarantine_bad_lines(spark, sf_dir):
    line = F.col("line")
    broken = (
        F.when(F.col("event_type") == "error", F.substring_index(line, " ", 9))
        .when(F.col("event_type") == "signup", F.replace(line, F.lit("/2024:"), F.lit("/20x4:")))
        .when(F.col("event_type") == "purchase", F.replace(line, F.lit('HTTP/1.1" '), F.lit('HTTP/1.1" 9" ')))
        .otherwise(line)
    )
    parsed = P.parse_bucket_log(I.with_bucket_line(I.spread_events(spark, sf_dir)).select(broken.alias("line")))
    good = P.good_records(parsed).select("line", F.lit(None).cast("string").alias("parse_error"))
    return good.unionByName(P.malformed_lines(parsed))


@query
def decode_keys(spark, sf_dir):
    def encode(c):
        return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))

    docs = I.spread(I.table(spark, sf_dir, "documents")).select("doc_id", encode(encode(F.col("text"))).alias("raw"))
    return docs.select("doc_id", text.percent_decode(F.col("raw")).alias("key"))


@query
def url_path(spark, sf_dir):
    return I.table(spark, sf_dir, "pages").select("page_id", text.url_path(F.col("url")).alias("path"))


@query
def split_request(spark, sf_dir):
    request = F.when(F.col("page_id") % 5 == 0, F.lit("HEAD")).otherwise(F.concat(F.lit("GET "), "url", F.lit("  HTTP/1.1")))
    pages = I.table(spark, sf_dir, "pages").select("page_id", request.alias("request"))
    return pages.select(
        "page_id",
        text.request_method(F.col("request")).alias("method"),
        text.request_url(F.col("request")).alias("url"),
    )


WIKI_URL = """case event_type when 'view' then concat('/wiki/Page_', cast(user_id as varchar(20)), '&x=1')
  when 'click' then concat('/w/index.php?title=T', cast(user_id as varchar(20)), '&a=/wiki/no')
  when 'signup' then '/index.php?title=' else concat('/', k) end"""


@query
def wikipage(spark, sf_dir):
    urls = I.events(spark, sf_dir).select("event_id", F.expr(WIKI_URL).alias("url"))
    return urls.select("event_id", text.wikipage(F.col("url")).alias("page"))


@query
def is_download(spark, sf_dir):
    url = F.when(F.col("event_type") == "signup", F.lit(None)).when(
        F.col("event_type") == "click", F.concat("k", F.lit("?q=1"))
    ).when(F.col("event_type") == "view", F.lower("k")).otherwise(F.col("k"))
    urls = I.events(spark, sf_dir).select("event_id", url.alias("url"))
    return urls.select("event_id", text.is_download(F.col("url")).alias("is_download"))


@query
def unify_logs(spark, sf_dir):
    web = P.good_records(P.parse_web_log(I.with_web_line(I.spread_events(spark, sf_dir)).select("line")))
    return P.unify_logs(_records(spark, sf_dir), web).select(
        "source", I.utc("dtime").alias("dtime"), "dtime_local", "remote_ip", "operation", "key", "http_status",
        "bytes_sent", "object_size", "user_agent", "request_id", "method",
    )


# --- filters ------------------------------------------------------------------------------------


@query
def nonblank_lines(spark, sf_dir):
    padded = F.when(F.col("event_type") == "signup", F.lit(" \t　 ")).otherwise(
        F.concat(F.lit("\t "), "line", F.lit("  \r"))
    )
    return K.nonblank_lines(I.with_bucket_line(I.spread_events(spark, sf_dir)).select(padded.alias("line")))


@query
def filter_year(spark, sf_dir):
    lines = I.with_order_line(I.orders(spark, sf_dir)).select("line")
    records = P.good_records(P.parse_web_log(lines))
    return K.filter_year(records, 1998).select("remote_ip", "key", "dtime_local", I.utc("dtime").alias("dtime"))


@query
def drop_ignored_keys(spark, sf_dir):
    builders = I.table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    ignored = I.events(spark, sf_dir).join(builders, "user_id").select(F.col("k").alias("key"))
    return K.drop_ignored_keys(_records(spark, sf_dir), ignored).select("request_id", "key")


@query
def classify_records(spark, sf_dir):
    return _classified(spark, sf_dir).select("request_id", "operation", "http_status", "class")


@query
def downloads_only(spark, sf_dir):
    return _downloads(spark, sf_dir).select("request_id", "key", "bytes_sent")


@query
def hashed_under_prefix(spark, sf_dir):
    return C.hashed_under_prefix(I.catalog(spark, sf_dir), "corpora/1").select("s3key", "etag")


# --- de-duplicate and merge ---------------------------------------------------------------------


def _repeated_order_lines(spark, sf_dir):
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", 3).otherwise(1)
    lines = I.with_order_line(I.orders(spark, sf_dir))
    return lines.select(F.explode(F.array_repeat(F.col("line"), copies)).alias("line"))


@query
def dedup_lines(spark, sf_dir):
    return M.dedup_lines(I.repeated_bucket_lines(spark, sf_dir).select("line"))


@query
def merge_logs(spark, sf_dir):
    merged = M.merge_records(_repeated_order_lines(spark, sf_dir), "web", year=1998)
    return merged.select("line", I.utc("dtime").alias("dtime"))


@query
def merge_report(spark, sf_dir):
    report = M.merge_report(_repeated_order_lines(spark, sf_dir), "web", year=1998)
    return report.withColumns({c: I.utc(c) for c in ("earliest", "latest")})


# --- star schema --------------------------------------------------------------------------------


@query
def upsert_catalog(spark, sf_dir):
    existing = _files(spark, sf_dir).filter(F.col("s3key").endswith(".E01"))
    existing = existing.select("s3key", F.lit(0).cast("bigint").alias("bytes"))
    fresh = S.catalog_additions(_downloads(spark, sf_dir), existing)
    return existing.unionByName(fresh.select("s3key", "bytes"))


@query
def upsert_user_agents(spark, sf_dir):
    existing = _agents(spark, sf_dir).filter("user_agent = 'agent (0) x'").select("user_agent")
    fresh = S.agent_additions(_downloads(spark, sf_dir), existing)
    return existing.unionByName(fresh.select("user_agent"))


def _fact_view(named: DataFrame) -> DataFrame:
    return named.select(
        "s3key", "user_agent", F.col("remote_ipaddr").alias("remote_ip"), "dtime", "bytes_sent", "summary"
    )


@query
def load_downloads(spark, sf_dir):
    return _fact_view(_named(_facts(spark, sf_dir), spark, sf_dir))


@query
def load_downloads_by_lookup(spark, sf_dir):
    files = _files(spark, sf_dir).withColumnRenamed("did", "id")
    agents = _agents(spark, sf_dir).withColumnRenamed("user_agent_id", "id")
    facts = S.resolve_facts(_downloads(spark, sf_dir), files, agents)
    return _fact_view(_named(facts, spark, sf_dir))


def _respelled(spark, sf_dir):
    """Downloads whose clicks ask for keys in upper case."""
    click = F.col("operation") == "WEBSITE.GET.OBJECT"
    return _downloads(spark, sf_dir).withColumn("key", F.when(click, F.upper("key")).otherwise(F.col("key")))


@query
def upsert_catalog_collated(spark, sf_dir):
    existing = _files(spark, sf_dir).filter(F.col("s3key").endswith(".E01"))
    existing = existing.select("s3key", F.lit(0).cast("bigint").alias("bytes"))
    fresh = S.catalog_additions(_respelled(spark, sf_dir), existing, collation="UNICODE_CI_AI")
    return existing.unionByName(fresh.select("s3key", "bytes"))


@query
def load_downloads_collated(spark, sf_dir):
    files = _files(spark, sf_dir).withColumnRenamed("did", "id")
    agents = _agents(spark, sf_dir).withColumnRenamed("user_agent_id", "id")
    facts = S.resolve_facts(_respelled(spark, sf_dir), files, agents, collation="UNICODE_CI_AI")
    return _fact_view(_named(facts, spark, sf_dir))


@query
def unify_normalized_keys(spark, sf_dir):
    web = P.good_records(P.parse_web_log(I.with_web_line(I.spread_events(spark, sf_dir)).select("line")))
    both = P.normalize_keys(P.unify_logs(_records(spark, sf_dir), web))
    return both.groupBy("source", "key").agg(F.count(F.lit(1)).alias("n"))


@query
def copy_missing_downloads(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("did"),
        F.col("o_orderpriority").alias("remote_ipaddr"),
        F.col("o_orderdate").alias("dtime"),
        F.col("o_orderkey").alias("bytes_sent"),
        "o_orderstatus",
    )
    files = I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("s3key"), F.col("c_nationkey").cast("bigint").alias("bytes")
    )
    missing = S.missing_facts(orders, files, orders.filter("o_orderstatus <> 'O'"), files)
    return missing.select("key", "remote_ip", F.col("dtime_local").alias("dtime"), "object_size", "bytes_sent")


def _document_digests(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    return docs.select(digests.sha2_256(F.col("text")).alias("sha256"), "doc_id", "lang")


@query
def digest_index_upsert(spark, sf_dir):
    items = _document_digests(spark, sf_dir)
    empty = _empty(spark, "sha256 string, doc_id bigint, note string")
    old = items.filter("lang = 'en'").select("sha256", "doc_id", F.lit("old").alias("note"))
    labelled = I.table(spark, sf_dir, "labels").select("doc_id")
    new = items.join(labelled, "doc_id", "left_semi").select("sha256", "doc_id", F.lit("new").alias("note"))
    return S.upsert(S.upsert(empty, old, "sha256", order="doc_id"), new, "sha256", order="doc_id")


@query
def digest_index_delete(spark, sf_dir):
    items = _document_digests(spark, sf_dir)
    index = items.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    toxic = I.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    return S.delete_keys(index, items.join(toxic, "doc_id", "left_semi"), "sha256")


# --- catalog ------------------------------------------------------------------------------------


def _plan(spark, sf_dir):
    return C.plan_hashing(I.listing(spark, sf_dir), I.catalog(spark, sf_dir))


@query
def plan_hashing(spark, sf_dir):
    return _plan(spark, sf_dir).select("s3key", "action")


@query
def refresh_mtime(spark, sf_dir):
    return C.refresh_mtime(I.catalog(spark, sf_dir), _plan(spark, sf_dir)).select("s3key", "mtime")


@query
def register_objects(spark, sf_dir):
    return C.register_objects(I.listing(spark, sf_dir), I.catalog(spark, sf_dir)).select("s3key", "outcome")


@query
def apply_hashes(spark, sf_dir):
    to_hash = _plan(spark, sf_dir).filter(F.col("action") == C.HASH)
    hashed = to_hash.select(
        "s3key", "etag", "mtime", "bytes",
        digests.sha2_256(F.col("s3key")).alias("sha2_256"), digests.sha2_256(F.col("etag")).alias("sha3_256"),
    )
    return C.apply_hashes(I.catalog(spark, sf_dir), hashed).select(
        "s3key", "etag", "mtime", "bytes", "sha2_256", "sha3_256"
    )


@query
def gc_missing(spark, sf_dir):
    return C.gc_missing(I.listing(spark, sf_dir), I.catalog(spark, sf_dir))


@query
def gc_vanished(spark, sf_dir):
    return C.gc_vanished(I.listing(spark, sf_dir), I.catalog(spark, sf_dir)).select("s3key")


@query
def gc_deletable(spark, sf_dir):
    args = I.listing(spark, sf_dir), I.catalog(spark, sf_dir), I.part_downloads(spark, sf_dir)
    return C.gc_deletable(*args).select("s3key")


@query
def gc_mark_absent(spark, sf_dir):
    args = I.listing(spark, sf_dir), I.catalog(spark, sf_dir), I.part_downloads(spark, sf_dir)
    return C.gc_apply(*args).select("s3key", "present")


@query
def gc_report(spark, sf_dir):
    return C.gc_report(I.listing(spark, sf_dir), I.catalog(spark, sf_dir), I.part_downloads(spark, sf_dir))


@query
def hash_sha2(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    return docs.select("doc_id", digests.sha2_256(F.col("text")).alias("sha2_256"))


# --- counts and roll-ups ------------------------------------------------------------------------


@query
def class_counts(spark, sf_dir):
    return A.class_counts(_classified(spark, sf_dir))


@query
def time_bounds(spark, sf_dir):
    bounds = A.time_bounds(_records(spark, sf_dir))
    return bounds.select(I.utc("earliest").alias("earliest"), I.utc("latest").alias("latest"))


@query
def dates_seen(spark, sf_dir):
    return A.dates_seen(_records(spark, sf_dir)).select(I.day("day").alias("day"))


def _stage_daily_files(rows, label):
    """One file per day, lines in event order."""
    ordered = rows.repartitionByRange("day").sortWithinPartitions("day", "event_id")
    path = scratch_path(rows.sparkSession, label)
    ordered.select("day", "line").write.partitionBy("day").text(path)
    return path


@query
def batch_bounds(spark, sf_dir):
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    blanked = ev.withColumn("line", F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.col("line")))
    lines = scan_logs(spark, _stage_daily_files(blanked, "batches"))
    records = P.good_records(P.parse_bucket_log(K.nonblank_lines(A.number_lines(lines))))
    return A.batch_bounds(records, size=100).select(
        F.regexp_extract("file_path", r"day=(\d{4}-\d\d-\d\d)", 1).alias("day"),
        "processed",
        I.utc("earliest").alias("earliest"),
        I.utc("latest").alias("latest"),
    )


@query
def ingest_counters(spark, sf_dir):
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    lines = scan_logs(spark, _stage_daily_files(ev, "counters"))
    counters = A.ingest_counters(K.classify(P.good_records(P.parse_bucket_log(lines))))
    return counters.withColumns({c: I.utc(c) for c in ("earliest", "latest")})


@query
def daily_rollup(spark, sf_dir):
    named = _named(A.daily_rollup(_facts(spark, sf_dir)), spark, sf_dir)
    return named.select(
        "s3key", F.col("remote_ipaddr").alias("remote_ip"), "user_agent", I.day("dt").alias("dt"), "bytes_sent"
    )


@query
def rollup_savings(spark, sf_dir):
    raw = _facts(spark, sf_dir)
    return A.rollup_savings(raw.unionByName(A.daily_rollup(raw))).withColumn("dt", I.day("dt"))


@query
def rollup_range(spark, sf_dir):
    return _fact_view(_named(A.summarize(_facts(spark, sf_dir), "2024-01-05", "2024-01-20"), spark, sf_dir))


@query
def rollup_compact(spark, sf_dir):
    raw = _facts(spark, sf_dir)
    twice = raw.unionByName(A.daily_rollup(raw, "2024-01-05", "2024-01-10"))
    return _fact_view(_named(A.summarize(twice, "2024-01-05", "2024-01-20", compact=True), spark, sf_dir))


@query
def rollup_bounds(spark, sf_dir):
    bounds = A.rollup_bounds(A.summarize(_facts(spark, sf_dir), "2024-01-01", "2024-01-10"))
    return bounds.select(I.day("first_day").alias("first_day"), I.day("last_day").alias("last_day"))


@query
def year_rollover(spark, sf_dir):
    partly = A.summarize(_facts(spark, sf_dir), "2024-01-05", "2024-01-20")
    return _fact_view(_named(A.year_rollover(partly), spark, sf_dir))


@query
def store_stats(spark, sf_dir):
    return A.store_stats(_files(spark, sf_dir), _facts(spark, sf_dir))


# --- reports ------------------------------------------------------------------------------------


def _download_days(spark, sf_dir):
    return _downloads(spark, sf_dir).select("key", F.to_date("dtime_local").alias("day"), "bytes_sent", "object_size")


@query
def popular_downloads(spark, sf_dir):
    return R.popular_downloads(_download_days(spark, sf_dir), "2024-01-30", k=10)


@query
def downloads_by_size(spark, sf_dir):
    return R.downloads_by_size(_download_days(spark, sf_dir))


@query
def downloads_by_tag(spark, sf_dir):
    tags = I.events(spark, sf_dir).select(
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("request_id"), F.col("props").alias("tags")
    )
    return R.downloads_by_tag(_downloads(spark, sf_dir).join(tags, "request_id"), "k")


# --- streaming ----------------------------------------------------------------------------------


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own, as state partitions are fixed when a stream first runs."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return session


def _stage_days(rows, label):
    return I.stage_text(rows.withColumn("day", F.to_date("ts")), label)


def _landed_facts(spark, landing):
    files = landing.catalog(spark).select(F.col("id").alias("did"), "s3key")
    agents = landing.agents(spark).select(F.col("id").alias("user_agent_id"), "user_agent")
    return _fact_view(landing.facts(spark).join(files, "did").join(agents, "user_agent_id", "left"))


def _run_ingest(spark, source, landing, checkpoint):
    lines = stream_logs(_stream_session(spark), source, max_files_per_trigger=100)
    SI.ingest_stream(lines, landing, checkpoint, "bucket").awaitTermination()


@query
def stream_ingest(spark, sf_dir):
    source = _stage_days(I.with_bucket_line(I.spread_events(spark, sf_dir)), "ingest-in")
    landing = SI.Landing(scratch_path(spark, "landing"))
    _run_ingest(spark, source, landing, scratch_path(spark, "ingest-checkpoint"))
    return _landed_facts(spark, landing)


@query
def stream_resume(spark, sf_dir):
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    source, checkpoint = scratch_path(spark, "resume-in"), scratch_path(spark, "resume-checkpoint")
    landing = SI.Landing(scratch_path(spark, "landing"))
    clicks = F.col("event_type") == "click"
    for part in (ev.filter(clicks), ev.filter(~clicks)):
        part.select("day", "line").hint("rebalance", "day").write.mode("append").partitionBy("day").text(source)
        _run_ingest(spark, source, landing, checkpoint)
    return _landed_facts(spark, landing)


@query
def stream_late_reroll(spark, sf_dir):
    """Purchases and clicks arrive after their days have been rolled up; those days are done again."""
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    source, checkpoint = scratch_path(spark, "late-in"), scratch_path(spark, "late-checkpoint")
    landing, daily = SI.Landing(scratch_path(spark, "landing")), scratch_path(spark, "daily")
    late = F.col("event_type").isin("click", "purchase")
    touched = None
    for part in (ev.filter(~late), ev.filter(late)):
        part.select("day", "line").hint("rebalance", "day").write.mode("append").partitionBy("day").text(source)
        before = landing.records(spark).agg(F.max("batch_id")).first()[0]
        _run_ingest(spark, source, landing, checkpoint)
        landed = landing.downloads(spark)
        if before is not None:
            touched = landed.filter(F.col("batch_id") > before).select("dt")
        reroll_days(landed, daily, touched)
    named = _named(spark.read.parquet(daily), spark, sf_dir)
    return named.select(
        "s3key", F.col("remote_ipaddr").alias("remote_ip"), "user_agent", I.day("dt").alias("dt"), "bytes_sent"
    )


#: Files a micro-batch, so that results are made over several.
BATCH_FILES = 12


@query
def stream_dedup(spark, sf_dir):
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).select("event_id", "ts", "line")
    repeated = ev.drop("line").join(I.repeated_bucket_lines(spark, sf_dir), "event_id")
    lines = stream_logs(_stream_session(spark), _stage_days(repeated, "dedup-in"), BATCH_FILES)
    records = P.good_records(P.parse_bucket_log(lines))
    out = scratch_path(spark, "dedup-out")
    view = SL.dedup_stream(records).select("line", "dtime")
    SL.write_changes(view, out, scratch_path(spark, "dedup-checkpoint"), mode="append").awaitTermination()
    return spark.read.parquet(out).select("line", I.utc("dtime").alias("dtime"))


@query
def stream_daily_rollup(spark, sf_dir):
    source = _stage_days(I.with_bucket_line(I.spread_events(spark, sf_dir)), "sums-in")
    lines = stream_logs(_stream_session(spark), source, BATCH_FILES)
    downloads = K.downloads_only(K.classify(P.good_records(P.parse_bucket_log(lines))))
    out = scratch_path(spark, "sums-out")
    SL.write_changes(SL.daily_sums(downloads), out, scratch_path(spark, "sums-checkpoint")).awaitTermination()
    sums = SL.latest_values(spark, out, ["dt", "key", "remote_ipaddr", "user_agent"], "bytes_sent")
    return sums.select(
        F.col("key").alias("s3key"), F.col("remote_ipaddr").alias("remote_ip"), "user_agent", I.day("dt").alias("dt"),
        "bytes_sent",
    )


@query
def stream_daily_rollup_folded(spark, sf_dir):
    """The view over two runs of the stream; the changes of the first are folded into a base and deleted between them."""
    ev = I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    source, out = scratch_path(spark, "folded-in"), scratch_path(spark, "folded-out")
    checkpoint, keys = scratch_path(spark, "folded-checkpoint"), ["dt", "key", "remote_ipaddr", "user_agent"]
    clicks = F.col("event_type") == "click"
    for part in (ev.filter(clicks), ev.filter(~clicks)):
        part.select("day", "line").hint("rebalance", "day").write.mode("append").partitionBy("day").text(source)
        lines = stream_logs(_stream_session(spark), source, BATCH_FILES)
        downloads = K.downloads_only(K.classify(P.good_records(P.parse_bucket_log(lines))))
        SL.write_changes(SL.daily_sums(downloads), out, checkpoint).awaitTermination()
        if not SL.folded_up_to(spark, out):
            SL.compact_changes(spark, out, keys, "bytes_sent", drop=True)
    return SL.latest_values(spark, out, keys, "bytes_sent").select(
        F.col("key").alias("s3key"), F.col("remote_ipaddr").alias("remote_ip"), "user_agent", I.day("dt").alias("dt"), "bytes_sent"
    )


@query
def stream_class_counts(spark, sf_dir):
    source = _stage_days(I.with_bucket_line(I.spread_events(spark, sf_dir)), "counts-in")
    lines = stream_logs(_stream_session(spark), source)
    classified = K.classify(P.good_records(P.parse_bucket_log(lines)))
    out = scratch_path(spark, "counts-out")
    view = SL.class_counts_stream(classified)
    SL.write_changes(view, out, scratch_path(spark, "counts-checkpoint")).awaitTermination()
    return SL.latest_values(spark, out, ["class"], "n")


