from datetime import datetime, timedelta

from pyspark.sql import functions as F

from accesslake import schemas
from accesslake.functions.ids import surrogate_id
from accesslake.operators import star as S

DOWNLOADS = (
    "key string, object_size bigint, user_agent string, remote_ip string, dtime timestamp, "
    "dtime_local timestamp_ntz, bytes_sent bigint, line string"
)


def downloads(spark, rows):
    t0 = datetime(2024, 1, 1)
    full = []
    for key, size, agent, minute in rows:
        t = t0 + timedelta(minutes=minute)
        full.append((key, size, agent, "ip", t, t, 1, f"{key}{minute}"))
    return spark.createDataFrame(full, DOWNLOADS)


def test_first_size_wins_even_when_null(spark):
    d = downloads(spark, [("a", 5, "x", 3), ("a", None, "x", 1), ("a", 7, "x", 2), ("b", 9, None, 1), ("b", 8, None, 1), ("c", 1, "x", 0)])
    old = spark.createDataFrame([("c",)], "s3key string")
    got = S.catalog_additions(d, old)
    assert {(r.s3key, r.bytes) for r in got.collect()} == {("a", None), ("b", 8)}
    assert got.columns == schemas.DOWNLOADABLE.fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.DOWNLOADABLE]


def test_null_agents_get_no_row_but_keep_their_fact(spark):
    d = downloads(spark, [("a", 5, None, 1), ("a", 5, "x", 2), ("b", 5, "y", 2)])
    agents = S.agent_additions(d, spark.createDataFrame([("y",)], "user_agent string"))
    assert [r.user_agent for r in agents.collect()] == ["x"]
    facts = S.fact_rows(d)
    assert facts.columns == schemas.DOWNLOADS.fieldNames()
    assert [f.dataType for f in facts.schema] == [f.dataType for f in schemas.DOWNLOADS]
    assert facts.filter("user_agent_id is null").count() == 1 and facts.count() == 3


def test_hashed_ids_equal_looked_up_ids(spark, plan):
    d = downloads(spark, [("a", 5, None, 1), ("a", 6, "x", 2), ("a", 6, "x", 2), ("b", 5, "y", 2)])
    none = spark.createDataFrame([], "s3key string"), spark.createDataFrame([], "user_agent string")
    catalog, agents = S.catalog_additions(d, none[0]), S.agent_additions(d, none[1])
    looked_up = sorted(map(tuple, S.resolve_facts(d, catalog, agents).collect()), key=str)
    assert looked_up == sorted(map(tuple, S.fact_rows(d).collect()), key=str)
    assert "Exchange" not in plan(S.fact_rows(d)) and "Join" not in plan(S.fact_rows(d))


def test_keys_equal_under_a_collation(spark):
    d = downloads(spark, [("F/A.E01", 5, "Bot", 1), ("f/a.e01", 6, "bot", 2), ("f/á.E01", 7, "bot", 3), ("OLD", 1, "b", 1)])
    old = spark.createDataFrame([("9", "old")], "id string, s3key string")
    added = S.catalog_additions(d, old, "UNICODE_CI_AI")
    assert [(r.s3key, r.bytes) for r in added.collect()] == [("F/A.E01", 5)]
    agents = S.agent_additions(d, spark.createDataFrame([], "user_agent string"), "UNICODE_CI_AI")
    assert {r.user_agent for r in agents.collect()} == {"Bot", "b"}
    facts = S.resolve_facts(d, old.unionByName(added.select("id", "s3key")), agents, "UNICODE_CI_AI")
    assert facts.count() == 4 and facts.select("did").distinct().count() == 2


def test_hot_key_lookup_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 40_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
            F.lit("agent").alias("user_agent"), F.sha2(F.col("id").cast("string"), 256).alias("remote_ip"),
            F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("dtime_local"), F.col("id").alias("bytes_sent"),
        )
        catalog = hot.select(surrogate_id(F.col("key")).alias("id"), F.col("key").alias("s3key")).distinct()
        agents = spark.createDataFrame([("1", "agent")], "id string, user_agent string")
        facts = S.resolve_facts(hot, catalog, agents)
        facts.collect()
        text = facts._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text
        assert facts.count() == 40_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_missing_facts(spark):
    files = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, s3key string, bytes bigint")
    schema = "did int, remote_ipaddr string, dtime timestamp_ntz, bytes_sent bigint"
    t, u = datetime(2024, 1, 1), datetime(2024, 1, 2)
    source = spark.createDataFrame(
        [(1, "i", t, 5), (1, "i", t, 5), (1, "i", u, 6), (2, None, t, 7), (2, "j", t, 8), (3, "i", t, 9)], schema
    )
    target = spark.createDataFrame([(2, "j", t, 1), (1, None, t, 1)], schema)
    got = S.missing_facts(source, files, target, files).collect()
    assert {(r.key, r.remote_ip, r.dtime_local, r.object_size, r.bytes_sent) for r in got} == {("a", "i", t, 10, 5), ("a", "i", u, 10, 6)}
    assert len(got) == 2


def test_upsert_and_delete(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    updates = spark.createDataFrame([("b", 20, 1), ("b", 21, 2), ("d", 40, 1)], "k string, v int, seq int")
    got = S.upsert(base, updates, "k", order="seq")
    assert {tuple(r) for r in got.collect()} == {("a", 1), ("b", 21), ("c", 3), ("d", 40)}
    keys = spark.createDataFrame([("a",), ("zz",)], "k string")
    assert {r.k for r in S.delete_keys(got, keys, "k").collect()} == {"b", "c", "d"}
    assert S.upsert(base, base.limit(0), "k").count() == 3
