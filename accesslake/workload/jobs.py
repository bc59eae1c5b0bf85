"""Queries that run whole jobs, or read files they have staged from the given tables; each one's SQL is beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from accesslake import schemas
from accesslake.functions import digests
from accesslake.operators import catalog as C
from accesslake.operators import classify as K
from accesslake.operators import hashing as H
from accesslake.operators import rollup as A
from accesslake.operators.parse import register_log_format
from accesslake.plans.consume import consume_logs
from accesslake.plans.corpus import collect_garbage, copy_downloads, hash_listing, hash_results
from accesslake.plans.ingest import ingest_files
from accesslake.plans.merge import MergedLog, merge_logs
from accesslake.plans.publish import publish_landing, stage_publication
from accesslake.plans.store import Store
from accesslake.plans.summarize import roll_over, stage_summary, summarize_store
from accesslake.plans.sync import CatalogSync
from accesslake.session import scratch_path
from accesslake.sources import tables
from accesslake.sources.ledger import delete_files
from accesslake.sources.listing import list_objects as list_files
from accesslake.sources.logs import read_ignored_keys, scan_logs
from accesslake.sources.objects import open_filesystem
from accesslake.sources.seen import SeenLines
from accesslake.streaming.ingest import Landing
from accesslake.workload import inputs as I
from accesslake.workload import oracles as O
from accesslake.workload.queries import Query, _records

JOBS: dict[str, Query] = {}
JOB_SQL: dict[str, str] = {}


def job(sql: str):
    def register(fn: Query) -> Query:
        JOBS[fn.__name__] = fn
        JOB_SQL[fn.__name__] = sql
        return fn

    return register


# --- objects ------------------------------------------------------------------------------------

#: Documents of an object: objects grow in number with the table, not in size.
OBJECT_DOCS = 100
OBJECT = f"doc_id // {OBJECT_DOCS} as object"
OBJECT_BYTES = "cast(sum(strlen(coalesce(text, '')) + 1) as bigint) as bytes"
OBJECT_SHA2 = "sha256(string_agg(coalesce(text, '') || chr(10), '' order by doc_id)) as sha2_256"


def _object_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents")
    number = F.floor(F.col("doc_id") / OBJECT_DOCS).cast("bigint").alias("object")
    return docs.select(number, "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _stage_objects(spark: SparkSession, sf_dir: str) -> str:
    """One file per OBJECT_DOCS ids, with their texts in order of the id, each ended by a newline."""
    path = scratch_path(spark, "objects")
    ordered = _object_texts(spark, sf_dir).repartition("object").sortWithinPartitions("object", "doc_id")
    ordered.select("object", "text").write.partitionBy("object").text(path)
    return path


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, _stage_objects(spark, sf_dir)).filter(F.col("s3key").endswith(".txt"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Object number in place of the key, whose file name differs from run to run."""
    return rows.withColumn("object", F.regexp_extract("s3key", r"^object=(\d+)/", 1).cast("bigint")).drop("s3key")


@job(f"select {OBJECT}, {OBJECT_BYTES} from documents group by 1")
def list_objects(spark, sf_dir):
    return _numbered(_objects(spark, sf_dir)).select("object", "bytes")


@job(f"select {OBJECT}, {OBJECT_BYTES} from documents where cast(doc_id // {OBJECT_DOCS} as varchar) like '1%' group by 1")
def list_objects_under_prefix(spark, sf_dir):
    listed = list_files(spark, _stage_objects(spark, sf_dir), prefix="object=1")
    return _numbered(listed.filter(F.col("s3key").endswith(".txt"))).select("object", "bytes")


@job("select cast(2 as bigint) as n from documents having count(*) > 1")
def list_objects_limited(spark, sf_dir):
    return list_files(spark, _stage_objects(spark, sf_dir), limit=2).agg(F.count_distinct("s3key").alias("n"))


@job(f"select count(distinct doc_id // {OBJECT_DOCS}) as n_objects, true as timed from documents")
def listing_stats(spark, sf_dir):
    stats = A.listing_stats(_objects(spark, sf_dir))
    return stats.select("n_objects", (F.col("earliest") <= F.col("latest")).alias("timed"))


def _write_objects(batches):
    """Write an object for each (uri, content); the same however often a task is run."""
    for batch in batches:
        for uri, content in zip(batch.column("uri").to_pylist(), batch.column("content").to_pylist()):
            system, path, _ = open_filesystem(uri)
            system.create_dir(path.rpartition("/")[0])
            with system.open_output_stream(path) as out:
                out.write(content)
        yield batch.select(["uri"])


@job("select doc_id, cast(strlen(coalesce(text, '')) as bigint) as bytes from documents")
def list_flat_folder(spark, sf_dir):
    """One folder with an object for each document: all tasks share its names."""
    root = scratch_path(spark, "flat")
    docs = I.table(spark, sf_dir, "documents")
    uri = F.concat(F.lit(f"{root}/"), F.col("doc_id").cast("string")).alias("uri")
    rows = docs.select(uri, F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    rows.mapInArrow(_write_objects, "uri string").write.format("noop").mode("overwrite").save()
    return list_files(spark, root).select(F.col("s3key").cast("bigint").alias("doc_id"), "bytes")


@job(f"select {OBJECT}, {OBJECT_BYTES}, {OBJECT_SHA2}, true as same_sha3, cast(null as varchar) as error from documents group by 1")
def hash_objects(spark, sf_dir):
    """SHA3 is held against the digest of the same content as a column."""
    hashed = _numbered(H.hash_objects(_objects(spark, sf_dir)))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: F.concat(x["text"], F.lit("\n")))
    whole = _object_texts(spark, sf_dir).groupBy("object").agg(F.array_join(texts, "").alias("content"))
    twin = whole.select("object", digests.sha3_256(F.col("content")).alias("twin"))
    same = (F.col("sha3_256") == F.col("twin")).alias("same_sha3")
    return hashed.join(twin, "object").select("object", "bytes", "sha2_256", same, "error")


@job(f"select count(distinct doc_id // {OBJECT_DOCS}) as n_objects, {OBJECT_BYTES} from documents")
def hash_throughput(spark, sf_dir):
    return H.hash_throughput(H.hash_objects(_objects(spark, sf_dir))).select("n_objects", "bytes")


@job("""select min(doc_id) as first_id, count(*) as n, cast(case when text is not null then 64 end as integer) as size
    from documents group by text""")
def hash_sha3(spark, sf_dir):
    """Equal texts, and no others, share a digest."""
    hashed = I.table(spark, sf_dir, "documents").select("doc_id", digests.sha3_256(F.col("text")).alias("sha3_256"))
    found = hashed.groupBy("sha3_256").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return found.select("first_id", "n", F.length("sha3_256").alias("size"))


@job(f"select {OBJECT}, {OBJECT_BYTES}, {OBJECT_SHA2}, true as present from documents group by 1")
def job_hash_listing(spark, sf_dir):
    """Part of a listing, then all of it: what is hashed already is not hashed again."""
    store, listing = Store(scratch_path(spark, "store")), _objects(spark, sf_dir)
    hash_listing(spark, store, listing, prefix="object=1")
    hash_listing(spark, store, listing)
    return _numbered(store.catalog(spark)).select("object", "bytes", "sha2_256", "present")


@job(f"select {OBJECT}, {OBJECT_BYTES}, {OBJECT_SHA2}, true as present from documents group by 1")
def job_hash_resumed(spark, sf_dir):
    """A hash job is killed after a slice. The objects it has hashed are gone when the next one runs, which takes their digests
    from the slice and would fail on them otherwise."""
    store, listing = Store(scratch_path(spark, "store"), buckets=16), _objects(spark, sf_dir)
    hash_listing(spark, store, listing, task_bytes=1 << 16, slices=1)
    delete_files(listing.join(hash_results(spark, store).select("s3key"), "s3key"))
    hash_listing(spark, store, listing, task_bytes=1 << 16)
    return _numbered(store.catalog(spark)).select("object", "bytes", "sha2_256", "present")


# --- log files ----------------------------------------------------------------------------------


def _daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.with_bucket_line(I.spread_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))


@job(O.SQL["scan_log_lines"])
def scan_compressed_lines(spark, sf_dir):
    path = scratch_path(spark, "compressed")
    rows = _daily_lines(spark, sf_dir).select("day", "line").hint("rebalance", "day")
    rows.write.partitionBy("day").option("compression", "gzip").text(path)
    return scan_logs(spark, path).select("line", F.regexp_extract("file_path", r"day=(\d{4}-\d\d-\d\d)", 1).alias("day"))


@job(O.SQL["drop_ignored_keys"])
def drop_keys_of_ignore_file(spark, sf_dir):
    """The keys to ignore come from a text file, with blanks around them."""
    builders = I.table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    ignored = I.events(spark, sf_dir).join(builders, "user_id").select("k").distinct()
    path = scratch_path(spark, "ignored")
    ignored.select(F.concat(F.lit("  "), "k", F.lit("\t"))).write.text(path)
    return K.drop_ignored_keys(_records(spark, sf_dir), read_ignored_keys(spark, path)).select("request_id", "key")


@job(f"""with {O.OW} select {O.ORDER_LINE} as line, row_number() over (order by wall, o_orderkey) - 1 as place
    from ow where year(wall) = 1998""")
def job_merge(spark, sf_dir):
    """Lines of the merged files with their place in them; one instant's lines are in the order of their file."""
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", 3).otherwise(1)
    rows = I.with_order_line(I.orders(spark, sf_dir)).withColumn("month", F.date_format("wall", "yyyy-MM"))
    ordered = rows.repartition("month").sortWithinPartitions("month", "o_orderkey")
    source, out = scratch_path(spark, "merge-in"), scratch_path(spark, "merge-out")
    lines = ordered.select("month", F.explode(F.array_repeat(F.col("line"), copies)).alias("line"))
    lines.write.partitionBy("month").text(source)
    merge_logs(spark, source, out, "web", year=1998)
    return _in_place(spark, out)


def _in_place(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a merged log with their place in it: its files are taken in the order of their paths."""
    merged = A.number_lines(scan_logs(spark, folder))
    sizes = merged.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    ahead = W.orderBy("file_path").rowsBetween(W.unboundedPreceding, -1)  # a row per file
    starts = sizes.select("file_path", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    return merged.join(starts, "file_path").select("line", (F.col("start") + F.col("line_index")).alias("place"))


@job(f"""with {O.OW} select {O.ORDER_LINE} as line, row_number() over (order by wall,
      case when o_orderpriority in ('1-URGENT', '2-HIGH') then 0 else 1 end, o_orderkey) - 1 as place from ow where year(wall) = 1998""")
def job_merge_more(spark, sf_dir):
    """Files with some orders are merged, then files with all: lines that are there already come again. The second merge is cut off
    when it has staged its days, and done again."""
    rows = I.with_order_line(I.orders(spark, sf_dir)).withColumn("month", F.date_format("wall", "yyyy-MM"))
    log = MergedLog(scratch_path(spark, "merged"), "web")
    for part in ("o_orderpriority in ('1-URGENT', '2-HIGH')", "true"):
        source = scratch_path(spark, "merge-more-in")
        ordered = rows.filter(part).repartition("month").sortWithinPartitions("month", "o_orderkey")
        ordered.select("month", "line").write.partitionBy("month").text(source)
        if part == "true":
            log.stage(spark, source, year=1998)
        log.merge(spark, source, year=1998)
    return _in_place(spark, f"{log.root}/log")


@job(f"""with {O.EV} select {O.BUCKET_LINE} as line, case when event_type in ('click', 'signup') then 0 else 1 end as run,
    cast(case event_type when 'click' then 2 when 'signup' then 3 else 2 end as bigint) as n from ev""")
def job_dedup_across_runs(spark, sf_dir):
    """Clicks and signups, some twice and three times; then all lines twice, of which only the others are new. The second run is done twice."""
    rows, seen = _daily_lines(spark, sf_dir), SeenLines(scratch_path(spark, "seen"))
    first = F.col("event_type").isin("click", "signup")
    copies = F.when(F.col("event_type") == "signup", 3).otherwise(2)
    each = rows.select("day", "event_type", "line", F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"))
    found = []
    for run, part in enumerate((each.filter(first), each)):
        lines = scan_logs(spark, I.stage_text(part, "seen-in"))
        for _ in range(run + 1):
            new = seen.take(lines, run)
        found.append(new.select("line", F.lit(run).alias("run"), "n"))
        if run == 0:
            seen.compact(spark)
    return found[0].unionByName(found[1])


# --- stores -------------------------------------------------------------------------------------

CLICKED = "event_type = 'click'"


def _ingest(spark: SparkSession, rows: DataFrame, store: Store) -> None:
    ingest_files(spark, scan_logs(spark, I.stage_text(rows, "job-in")), "bucket", store)


def _named_facts(spark: SparkSession, store: Store, names: Store | None = None) -> DataFrame:
    """A store's facts with key and agent, from its own dimensions or another's."""
    names = names or store
    files = names.catalog(spark).select(F.col("id").alias("did"), "s3key")
    agents = names.agents(spark).select(F.col("id").alias("user_agent_id"), "user_agent")
    facts = store.facts(spark).join(files, "did").join(agents, "user_agent_id", "left")
    return facts.select("s3key", "user_agent", F.col("remote_ipaddr").alias("remote_ip"), "dtime", "bytes_sent", "summary")


@job(f"with {O.DL} select {O.FACT} from dl")
def job_ingest(spark, sf_dir):
    store = Store(scratch_path(spark, "store"))
    _ingest(spark, _daily_lines(spark, sf_dir), store)
    return _named_facts(spark, store)


@job(O.SQL["ingest_counters"])
def job_ingest_counters(spark, sf_dir):
    """What an ingest reports, which it counts in its one pass over the lines."""
    path = scratch_path(spark, "counted")
    rows = _daily_lines(spark, sf_dir).select("day", "line")
    rows.repartition("day").write.partitionBy("day").text(path)
    found = ingest_files(spark, scan_logs(spark, path), "bucket", Store(scratch_path(spark, "store")))
    times = [None if t is None else t.replace(tzinfo=None) for t in (found.earliest, found.latest)]
    row = (found.n_objects, found.n_records, found.n_downloads, *times)
    return spark.createDataFrame([row], "n_objects long, n_records long, n_downloads long, earliest timestamp_ntz, latest timestamp_ntz")


@job(f"""with {O.EV} select distinct replace(k, ' ', '_') as s3key from ev where {O.WEBSTATUS} in (200, 206)
    union all select distinct k from ev where op in ('REST.GET.OBJECT', 'WEBSITE.GET.OBJECT') and st in ('200', '206', '-')""")
def job_ingest_normalized(spark, sf_dir):
    """Web logs, then bucket logs, whose keys have no slash in front in the one catalog."""
    store, ev = Store(scratch_path(spark, "store")), I.spread_events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    for lines, name in ((I.with_web_line(ev), "web"), (I.with_bucket_line(ev), "bucket")):
        ingest_files(spark, scan_logs(spark, I.stage_text(lines, "job-in")), name, store, normalize=True)
    return store.catalog(spark).select("s3key")


@job(f"with {O.DL} select upper(k) as s3key, count(*) as n, cast(1 as bigint) as n_ids from dl group by 1")
def job_ingest_collated(spark, sf_dir):
    """Clicks ask for keys in upper case; they are the same files."""
    store, rows = Store(scratch_path(spark, "store")), I.spread_events(spark, sf_dir)
    spelled = rows.withColumn("k", F.when(F.expr(CLICKED), F.upper("k")).otherwise(F.col("k"))).withColumn("day", F.to_date("ts"))
    for part in (f"not {CLICKED}", CLICKED):
        lines = scan_logs(spark, I.stage_text(I.with_bucket_line(spelled).filter(part), "job-in"))
        ingest_files(spark, lines, "bucket", store, collation="UNICODE_CI_AI")
    facts = _named_facts(spark, store).withColumn("s3key", F.upper("s3key"))
    ids = store.facts(spark).join(store.catalog(spark).select(F.col("id").alias("did"), F.upper("s3key").alias("s3key")), "did")
    counted = ids.groupBy("s3key").agg(F.count_distinct("did").alias("n_ids"))
    return facts.groupBy("s3key").agg(F.count(F.lit(1)).alias("n")).join(counted, "s3key")


def parse_tab_log(lines: DataFrame) -> DataFrame:
    """A format of one's own: UTC time, address, key and bytes between tabs; every record is a read."""
    part = F.split("line", "\t")
    time = F.try_to_timestamp(F.concat(part[0], F.lit("Z")), F.lit("yyyy-MM-dd HH:mm:ssX"))
    error = F.when(F.size(part) != 4, "fields").when(time.isNull(), "time")
    size = F.get(part, F.lit(3)).try_cast("bigint")
    return lines.select(
        "*", time.alias("dtime"), I.utc(time).alias("dtime_local"), F.get(part, F.lit(1)).alias("remote_ip"), F.lit("REST.GET.OBJECT").alias("operation"),
        F.get(part, F.lit(2)).alias("key"), F.lit(200).alias("http_status"), size.alias("bytes_sent"), size.alias("object_size"),
        F.lit(None).cast("string").alias("user_agent"), error.alias("parse_error"),
    )


@job(f"""with {O.OW} select path as s3key, cast(null as varchar) as user_agent, ip as remote_ip, wall as dtime, bytes as bytes_sent,
    false as summary from ow where o_orderpriority <> '1-URGENT'""")
def job_ingest_own_format(spark, sf_dir):
    """Logs in a registered third format; some lines lack a field."""
    register_log_format("tab", parse_tab_log)
    lost = F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.concat(F.lit("\t"), F.col("bytes").cast("string")))
    line = F.concat(F.date_format("wall", "yyyy-MM-dd HH:mm:ss"), F.lit("\t"), "ip", F.lit("\t"), "path", lost)
    rows = I.orders(spark, sf_dir).select(F.date_format("wall", "yyyy-MM").alias("day"), line.alias("line"))
    store = Store(scratch_path(spark, "store"))
    ingest_files(spark, scan_logs(spark, I.stage_text(rows, "job-in")), "tab", store)
    return _named_facts(spark, store)


@job(f"""with {O.DL}, first as (select k, object_size, row_number() over (partition by k
      order by case when {CLICKED} then 0 else 1 end, dtime, object_size nulls first) as rn from dl)
    select k as s3key, object_size as bytes from first where rn = 1""")
def job_ingest_twice(spark, sf_dir):
    """The catalog after clicks, then all else: a key's first size stays."""
    store, rows = Store(scratch_path(spark, "store")), _daily_lines(spark, sf_dir)
    _ingest(spark, rows.filter(CLICKED), store)
    _ingest(spark, rows.filter(f"not {CLICKED}"), store)
    return store.catalog(spark).select("s3key", "bytes")


@job(f"with {O.DAILY} select {O.SUMMED} from daily")
def job_summarize(spark, sf_dir):
    """Clicks come after the roll-up of their year; a second one folds them in."""
    store, rows = Store(scratch_path(spark, "store")), _daily_lines(spark, sf_dir)
    _ingest(spark, rows.filter(f"not {CLICKED}"), store)
    summarize_store(spark, store, year=2024)
    _ingest(spark, rows.filter(CLICKED), store)
    summarize_store(spark, store, compact=True)
    return _named_facts(spark, store)


@job(f"with {O.DAILY} select {O.SUMMED} from daily")
def job_roll_over(spark, sf_dir):
    store, target = Store(scratch_path(spark, "store")), Store(scratch_path(spark, "store"))
    _ingest(spark, _daily_lines(spark, sf_dir), store)
    summarize_store(spark, store, "2024-01-05", "2024-01-20")
    roll_over(spark, store, target)
    return _named_facts(spark, target, names=store)


@job(f"""with {O.DL} select {O.FACT} from dl where not {CLICKED}
    union all select k, null, ip, dtime, max(bytes_sent), false from dl s where {CLICKED} and not exists (
      select 1 from dl t where not t.{CLICKED} and t.k = s.k and t.ip = s.ip and t.dtime = s.dtime) group by k, ip, dtime""")
def job_copy_downloads(spark, sf_dir):
    """A store that lacks the clicks gets them from one that has all."""
    source, target = Store(scratch_path(spark, "store")), Store(scratch_path(spark, "store"))
    rows = _daily_lines(spark, sf_dir)
    _ingest(spark, rows, source)
    _ingest(spark, rows.filter(f"not {CLICKED}"), target)
    copy_downloads(spark, source, target)
    return _named_facts(spark, target)


def _log_folder(rows: DataFrame, path: str) -> None:
    """Add log files, some for each day, to a folder."""
    rows.select("day", "line").hint("rebalance", "day").write.mode("append").partitionBy("day").text(path)


def _cut_off(store: Store, name: str) -> None:
    """Put only the first half of a staged change's partitions in place, as a job that is lost in the middle does."""
    spark = SparkSession.active()
    staged = f"{store.journal.path}/change=1/rows"
    days = sorted(n.partition("=")[2] for n in tables.child_names(spark, staged) if n.startswith("dt="))
    half = spark.read.parquet(staged).filter(F.col("dt").isin(days[: len(days) // 2]))
    tables.overwrite_partitions(half.select(*store.facts(spark).columns), f"{store.root}/{name}", "dt")


@job(f"with {O.DL} select {O.FACT} from dl")
def job_consume_once(spark, sf_dir):
    """Logs are consumed while more arrive. Runs are cut off after a commit, before its files are deleted, and while
    staged facts are put in place; each download is one fact, and no file is left."""
    source = scratch_path(spark, "consumed")
    landing, store = Landing(scratch_path(spark, "landing")), Store(scratch_path(spark, "store"))
    rows = _daily_lines(spark, sf_dir)
    _log_folder(rows.filter(CLICKED), source)
    consume_logs(spark, source, landing, "bucket", delete=False)  # cut off: committed, nothing deleted
    _log_folder(rows.filter(f"not {CLICKED}"), source)
    stage_publication(spark, landing, store)
    _cut_off(store, store.facts_table)
    consume_logs(spark, source, landing, "bucket", most=20, batches=1)
    publish_landing(spark, landing, store)
    consume_logs(spark, source, landing, "bucket")
    consume_logs(spark, source, landing, "bucket")
    publish_landing(spark, landing, store)
    left = list_files(spark, source).filter("s3key like '%.txt'").count()
    return _named_facts(spark, store).filter(F.lit(left == 0))


@job(f"with {O.DAILY} select {O.SUMMED} from daily")
def publish_landing_late(spark, sf_dir):
    """Landed batches are published and rolled up, late ones come after; a repeated publication changes nothing."""
    source, landing = scratch_path(spark, "published"), Landing(scratch_path(spark, "landing"))
    store, rows = Store(scratch_path(spark, "store"), buckets=32), _daily_lines(spark, sf_dir)
    for part in (f"not {CLICKED}", CLICKED):
        _log_folder(rows.filter(part), source)
        consume_logs(spark, source, landing, "bucket")
        publish_landing(spark, landing, store)
        publish_landing(spark, landing, store)
        summarize_store(spark, store, year=2024, compact=True)
    return _named_facts(spark, store)


@job(f"with {O.DAILY} select {O.SUMMED} from daily")
def job_summarize_resumed(spark, sf_dir):
    """A roll-up is lost when half of its days have been replaced; the next ingest finishes it before it adds the clicks."""
    store, rows = Store(scratch_path(spark, "store")), _daily_lines(spark, sf_dir)
    _ingest(spark, rows.filter(f"not {CLICKED}"), store)
    stage_summary(spark, store, year=2024)
    _cut_off(store, store.facts_table)
    _ingest(spark, rows.filter(CLICKED), store)
    summarize_store(spark, store, compact=True)
    return _named_facts(spark, store)


@job(f"""with {O.DL}, first as (select k, object_size, row_number() over (partition by k
      order by case when {CLICKED} then 0 else 1 end, dtime, object_size nulls first) as rn from dl)
    select k as s3key, object_size as bytes, ua as user_agent from first
      join (select distinct k as used, ua from dl) on used = k where rn = 1""")
def job_ingest_bucketed(spark, sf_dir):
    """Dimensions in key buckets: clicks, then all else, then the clicks again, whose keys are all known."""
    store, rows = Store(scratch_path(spark, "store"), buckets=64), _daily_lines(spark, sf_dir)
    for part in (CLICKED, f"not {CLICKED}", CLICKED):
        _ingest(spark, rows.filter(part), store)
    names = _named_facts(spark, store).select("s3key", "user_agent").distinct()
    return store.catalog(spark).select("s3key", "bytes").join(names, "s3key")


@job(O.SQL["gc_mark_absent"])
def job_collect_garbage_bucketed(spark, sf_dir):
    """The collection over a catalog in key buckets: changed rows are put, vanished ones deleted, in their buckets."""
    store = Store(scratch_path(spark, "store"), buckets=64)
    items = I.table(spark, sf_dir, "lineitem").filter(I.DOWNLOADED)
    facts = items.select(F.col("l_partkey").cast("string").alias("did"), F.to_date("l_shipdate").alias("dt"))
    store.catalog_buckets.insert(_shaped(I.catalog(spark, sf_dir), schemas.DOWNLOADABLE))
    tables.append_facts(_shaped(facts, schemas.DOWNLOADS), store.facts_path)
    collect_garbage(spark, store, I.listing(spark, sf_dir))
    return store.catalog(spark).select("s3key", "present")


def _synced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Listing and catalog in buckets, read as a later job reads them."""
    sync, listing, catalog = CatalogSync(scratch_path(spark, "sync"), 16), I.listing(spark, sf_dir), I.catalog(spark, sf_dir)
    sync.put_catalog(catalog)
    sync.put_listing(listing)
    known, listed = sync.both(spark, catalog.schema, listing.schema)
    return listed, known


@job(O.SQL["plan_hashing"])
def plan_hashing_bucketed(spark, sf_dir):
    """Plan, registration and differences of bucketed tables: merge joins without a shuffle."""
    return C.plan_hashing(*_synced(spark, sf_dir)).select("s3key", "action")


@job(O.SQL["register_objects"])
def register_objects_bucketed(spark, sf_dir):
    return C.register_objects(*_synced(spark, sf_dir)).select("s3key", "outcome")


@job(O.SQL["gc_missing"])
def gc_missing_bucketed(spark, sf_dir):
    return C.gc_missing(*_synced(spark, sf_dir))


@job(O.SQL["gc_vanished"])
def gc_vanished_bucketed(spark, sf_dir):
    return C.gc_vanished(*_synced(spark, sf_dir)).select("s3key")


def _shaped(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with a table's columns; those they lack are null."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


@job(O.SQL["gc_mark_absent"])
def job_collect_garbage(spark, sf_dir):
    store = Store(scratch_path(spark, "store"))
    items = I.table(spark, sf_dir, "lineitem").filter(I.DOWNLOADED)
    facts = items.select(F.col("l_partkey").cast("string").alias("did"), F.to_date("l_shipdate").alias("dt"))
    tables.write_snapshot(_shaped(I.catalog(spark, sf_dir), schemas.DOWNLOADABLE), store.catalog_path)
    tables.append_facts(_shaped(facts, schemas.DOWNLOADS), store.facts_path)
    collect_garbage(spark, store, I.listing(spark, sf_dir))
    return store.catalog(spark).select("s3key", "present")
