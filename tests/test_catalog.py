from conftest import SF_SMALL

from chargepulse.plans import fixtures as fx
from chargepulse.plans.registry import queries
from chargepulse.sources.catalog import load_properties, run_named
from chargepulse.streaming.sinks import append_table, create_partitioned_table, overwrite_insert


def test_properties_catalogue_with_continuations():
    text = "# c\nq1=select a, \\\n  b from t \\\n  group by a\n\nq2 : select 1\n"
    assert load_properties(text) == {"q1": "select a, b from t group by a", "q2": "select 1"}


def test_named_sql_leaves_no_view(spark):
    fact = fx.browse_fact(spark, SF_SMALL)
    before = {t.name for t in spark.catalog.listTables()}
    got = run_named(spark, "views_per_day", views={"views": fact})
    assert sum(r.view_count for r in got.collect()) == fact.count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_append_goes_by_name(spark, tmpdir_str):
    append_table(spark.createDataFrame([("p1", "m1")], "phone string, money string"), "t_named", tmpdir_str + "/t")
    append_table(spark.createDataFrame([("m2", "p2")], "money string, phone string"), "t_named")
    assert sorted(map(tuple, spark.table("t_named").select("phone", "money").collect())) == [("p1", "m1"), ("p2", "m2")]


def test_null_user_counts_and_unmatched_regions(spark):
    rows = queries()["browse_region_stats"](spark, SF_SMALL).collect()
    assert any(r.region_province is None for r in rows)
    fact = fx.browse_fact(spark, SF_SMALL)
    stats = queries()["browse_stats"](spark, SF_SMALL)
    assert sum(r.view_count for r in stats.collect()) == fact.count()
    assert sum(r.user_count for r in stats.collect()) == fact.where("user_id is not null").count()


def test_overwrite_keeps_other_partitions_and_append_doubles(spark, tmpdir_str):
    df = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "v int, s string, day string")
    create_partitioned_table(df, "t_over", ["day"], tmpdir_str + "/t_over")
    overwrite_insert(df, "t_over")
    overwrite_insert(spark.createDataFrame([(9, "z", "d2")], "v int, s string, day string"), "t_over")
    assert sorted(map(tuple, spark.table("t_over").collect())) == [(1, "a", "d1"), (9, "z", "d2")]
    append_table(df, "t_app", tmpdir_str + "/t_app")
    append_table(df, "t_app", tmpdir_str + "/t_app")
    assert spark.table("t_app").count() == 4


def test_sql_catalogue_from_properties_file(spark, tmpdir_str):
    from chargepulse.sources.catalog import load_sql_catalogue

    path = tmpdir_str + "/shop.properties"
    with open(path, "w") as f:
        f.write("q_views=select bdp_day, \\\n count(1) view_count \\\n from {views} "
                "\\\n group by bdp_day\n")
    cat = load_sql_catalogue(spark, path)
    fact = fx.browse_fact(spark, SF_SMALL)
    got = run_named(spark, "q_views", catalogue=cat, views={"views": fact})
    assert sum(r.view_count for r in got.collect()) == fact.count()


def test_overwrite_leaves_the_session_and_knows_the_newest_day(spark, tmpdir_str):
    from chargepulse.streaming.sinks import newest_partition

    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    df = spark.createDataFrame([(1, "20240105"), (2, "20240103")], "v int, day string")
    create_partitioned_table(df, "t_newest", ["day"], tmpdir_str + "/t_newest")
    assert newest_partition(spark, "t_newest") is None
    overwrite_insert(df, "t_newest")
    assert newest_partition(spark, "t_newest") == "20240105"
    overwrite_insert(df.where("v = 2").withColumn("v", df.v + 5), "t_newest", tasks=1)
    assert sorted(map(tuple, spark.table("t_newest").collect())) == [(1, "20240105"), (7, "20240103")]
    assert spark.conf.get(key) == before


def test_one_day_of_the_fact_is_read_by_a_range(spark):
    fact = fx.browse_fact(spark, SF_SMALL)
    day = fact.agg({"bdp_day": "max"}).first()[0]
    one = fx.browse_fact(spark, SF_SMALL, day=day)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, fact.where(fact.bdp_day == day).collect()))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, tmpdir_str):
    from chargepulse.sources.catalog import read_table, save_bucketed

    save_bucketed(fx.table(spark, SF_SMALL, "lineitem"), "li_b", "l_orderkey", 4, tmpdir_str + "/li")
    save_bucketed(fx.table(spark, SF_SMALL, "orders"), "o_b", "o_orderkey", 4, tmpdir_str + "/o")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        li, o = read_table(spark, "li_b", ["l_orderkey", "l_suppkey"]), read_table(spark, "o_b", ["o_orderkey", "o_custkey"])
        joined = li.join(o, li.l_orderkey == o.o_orderkey)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == fx.table(spark, SF_SMALL, "lineitem").count()
    finally:
        spark.conf.set(key, before)
    stats = spark.sql("DESCRIBE TABLE EXTENDED o_b").where("col_name = 'Statistics'").first()
    assert "rows" in stats["data_type"]


def test_dimension_lines_that_are_not_used(spark):
    from chargepulse.sources.dims import judge_code_lines, judge_ip_lines

    rows = [("1 A", 0), ("2 B", 1), ("1 C", 2), ("x", 3), ("", 4), (None, 5), ("3 ", 6), ("2 B", 7)]
    lines = spark.createDataFrame(rows, "value string, pos long")
    got = sorted(((r.value or "", r.reason) for r in judge_code_lines(lines, order_col="pos").collect()), key=repr)
    assert got == sorted([("1 A", "replaced"), ("1 C", None), ("2 B", None), ("2 B", "replaced"), ("x", "malformed"),
                          ("", "malformed"), ("", "malformed"), ("3 ", "malformed")], key=repr)
    got = sorted(((r.value or "", r.reason) for r in judge_code_lines(lines).collect()), key=repr)
    assert got == sorted([("1 A", "ambiguous"), ("1 C", "ambiguous"), ("2 B", None), ("2 B", "replaced"), ("x", "malformed"),
                          ("", "malformed"), ("", "malformed"), ("3 ", "malformed")], key=repr)
    ip = spark.createDataFrame([("1.2.3.4|1.2.3.9|a|b|c|d|P",), ("1.2.3|1.2.3.9|a|b|c|d|P",), ("1.2.3.4|x",), (None,)],
                               "value string")
    assert sorted(repr(r.reason) for r in judge_ip_lines(ip).collect()) == ["'bad start'", "'short'", "'short'", "None"]


def test_code_dim_file_last_duplicate_wins(spark, tmpdir_str):
    from chargepulse.sources.dims import read_code_dim

    path = tmpdir_str + "/city.txt"
    with open(path, "w") as f:
        f.write("1 Beijing\n2 Shanghai\n1 Tianjin\nbadline\n3 \n")
    got = {r.code: r.name for r in read_code_dim(spark, path).collect()}
    assert got == {"1": "Tianjin", "2": "Shanghai"}
