"""Log lines, listings and catalogs derived from the given tables.

The tables hold no logs, so lines are written from their columns. A query then has to read the text
back, while its SQL takes the same values straight from the columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.session import scratch_path

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# One access per event; runs in Spark and in DuckDB alike.
EV = """
select event_id, ts, user_id, event_type, props,
  case event_type when 'view' then 'REST.GET.OBJECT' when 'click' then 'WEBSITE.GET.OBJECT'
    when 'purchase' then 'REST.PUT.OBJECT' when 'signup' then 'REST.HEAD.OBJECT'
    else case when event_id % 2 = 0 then 'REST.DELETE.OBJECT' else 'REST.BOGUS.OP' end end as op,
  case event_id % 11 when 0 then '404' when 1 then '206' when 2 then '-' when 3 then '503'
    when 4 then '304' when 5 then '403' else '200' end as st,
  case when event_id % 7 = 0 then '-' else cast((event_id * 37) % 100000 as varchar(20)) end as bs,
  case when event_id % 13 = 0 then '-' else cast((user_id * 7919) % 5000000 + event_id % 3 as varchar(20)) end as sz,
  concat('10.0.0.', cast(user_id % 50 as varchar(20))) as ip,
  concat('corpora set/f', cast(user_id as varchar(20)),
    case user_id % 3 when 0 then '.E01' when 1 then '.gz' else '.txt' end) as k,
  concat('agent (', cast(user_id % 3 as varchar(20)), ') x') as ua
from {events}
"""

# One web access per order, at a time of day taken from the key, seven hours behind UTC.
OW = """
select o_orderkey, o_custkey, o_orderpriority,
  o_orderdate + (o_orderkey % 86400) * interval '1 second' as wall,
  concat('10.1.', cast(o_custkey % 250 as varchar(20)), '.', cast(o_orderkey % 250 as varchar(20))) as ip,
  concat('/orders/', cast(o_custkey as varchar(20)), '.csv') as path,
  (o_orderkey * 31) % 1000000 as bytes
from {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a table over all cores when its files make fewer splits; big tables stay as scanned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EV, events=table(spark, sf_dir, "events"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OW, orders=spread(table(spark, sf_dir, "orders")))


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events for the queries that write and parse a line for each."""
    return spark.sql(EV, events=spread(table(spark, sf_dir, "events")))


def log_time(c: str, offset: str) -> Column:
    """A zone-less time as logs write it, built from its text, so that no time zone gets in."""
    iso = F.col(c).cast("string")
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(c))
    day, year, clock = F.substring(iso, 9, 2), F.substring(iso, 1, 4), F.substring(iso, 12, 8)
    return F.concat(day, F.lit("/"), month, F.lit("/"), year, F.lit(":"), clock, F.lit(f" {offset}"))


def with_bucket_line(ev: DataFrame) -> DataFrame:
    line = F.concat(
        F.lit("own bkt ["), log_time("ts", "+0000"), F.lit("] "), "ip", F.lit(" - R"), F.col("event_id").cast("string"),
        F.lit(" "), "op", F.lit(" "), F.replace("k", F.lit(" "), F.lit("%2520")), F.lit(' "GET /x HTTP/1.1" '), "st",
        F.lit(" - "), "bs", F.lit(" "), "sz", F.lit(' 1 - "-" "'), "ua", F.lit('" - H - C - d T'),
    )
    return ev.withColumn("line", line)


def with_web_line(ev: DataFrame) -> DataFrame:
    """Signups send no referrer and no agent."""
    tail = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(
        F.concat(F.lit(' "http://ref/" "'), F.col("ua"), F.lit('"'))
    )
    line = F.concat(
        "ip", F.lit(" - bob ["), log_time("ts", "-0700"), F.lit('] "GET /'), F.replace("k", F.lit(" "), F.lit("_")),
        F.lit('?q=1 HTTP/1.1" '), F.when(F.col("st") == "-", F.lit("200")).otherwise(F.col("st")), F.lit(" "), "bs", tail,
    )
    return ev.withColumn("line", line)


def with_order_line(ow: DataFrame) -> DataFrame:
    line = F.concat(
        "ip", F.lit(" - - ["), log_time("wall", "-0700"), F.lit('] "GET '), "path", F.lit(' HTTP/1.1" 200 '),
        F.col("bytes").cast("string"), F.lit(' "-" "o"'),
    )
    return ow.withColumn("line", line)


def bucket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_bucket_line(spread_events(spark, sf_dir)).select("line")


def repeated_bucket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are logged twice, signups three times."""
    copies = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "signup", 3).otherwise(1)
    return with_bucket_line(spread_events(spark, sf_dir)).select(
        "event_id", "line", F.explode(F.array_repeat(F.col("line"), copies)).alias("_copy")
    ).drop("_copy")


REPEATS = "case event_type when 'click' then 2 when 'signup' then 3 else 1 end"


def stage_text(rows: DataFrame, label: str, by: str = "day") -> str:
    """Write (``by``, ``line``) rows as text files, a folder per value with few files each; returns the path."""
    path = scratch_path(rows.sparkSession, label)
    rows.select(by, "line").hint("rebalance", by).write.partitionBy(by).text(path)
    return path


def utc(c: str | Column) -> Column:
    """An instant as the zone-less UTC time, which is how DuckDB holds it."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01").cast("timestamp_ntz"))


def day(c: str) -> Column:
    """A date as text, which every client shows alike."""
    return F.col(c).cast("string")


# Catalog and listing over parts. A part's file is in the catalog; parts of some brands have no
# digests, and the listing has new ETags, new times and new files for some sizes and types.
CATALOG = """
select concat('corpora/', cast(p_partkey as varchar(20))) as s3key,
  cast(p_partkey as varchar(20)) as id,
  concat('"e', cast(p_partkey as varchar(20)), '"') as etag,
  timestamp '2024-01-01 00:00:00' as mtime,
  p_partkey * 10 as bytes,
  case when p_brand in ('Brand#1', 'Brand#2', 'Brand#3') then null else concat('a', cast(p_partkey as varchar(20))) end as sha2_256,
  case when p_brand in ('Brand#1', 'Brand#2', 'Brand#3') then null else concat('b', cast(p_partkey as varchar(20))) end as sha3_256,
  true as present, p_partkey
from {part}
"""
LISTING = """
select concat('corpora/', cast(p_partkey as varchar(20))) as s3key,
  case when p_type = 'PROMO' then concat('"new', cast(p_partkey as varchar(20)), '"') else concat('"e', cast(p_partkey as varchar(20)), '"') end as etag,
  case when p_size < 10 then timestamp '2024-02-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as mtime,
  p_partkey * 10 + case when p_type = 'PROMO' then 1 else 0 end as bytes
from {part} where p_type <> 'ECONOMY'
union all
select concat('corpora/new', cast(p_partkey as varchar(20))), concat('"n', cast(p_partkey as varchar(20)), '"'),
  timestamp '2024-02-02 00:00:00', p_partkey
from {part} where p_type = 'SMALL'
"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CATALOG.replace("timestamp '", "timestamp_ntz '"), part=table(spark, sf_dir, "part"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LISTING.replace("timestamp '", "timestamp_ntz '"), part=table(spark, sf_dir, "part"))


def part_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's file was downloaded when one of its items was returned in the last years."""
    items = table(spark, sf_dir, "lineitem")
    return items.filter(DOWNLOADED).select(F.col("l_partkey").cast("string").alias("did"))


DOWNLOADED = "l_returnflag = 'R' and l_quantity > 48 and l_linestatus = 'O'"
