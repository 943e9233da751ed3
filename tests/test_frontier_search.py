import datetime as dt

import pytest
from pyspark.sql import functions as F

from bantin.catalogue import SECTIONS, section_catalogue
from bantin.operators import extraction, frontier, search, skew


def test_page_frontier(spark):
    df = spark.createDataFrame(
        [("diendandoanhnghiep", "u", 1, 3), ("vtc", "v", 2, 2), ("vneconomy", "w", 1, 0), ("baodautu", "x", 1, None), ("laodong", "y", 3, 1)],
        "journal string, section_url string, start int, end int",
    )
    got = sorted(tuple(r) for r in frontier.page_frontier(df, cap=2).select("page", "listing_url").collect())
    assert got == [(1, "u/"), (1, "w?trang=1"), (1, "x/p1"), (2, "u/trang-2/"), (2, "w?trang=2"), (2, "x/p2")]
    with pytest.raises(Exception, match="needs a cap"):
        frontier.page_frontier(df).collect()


def pages(spark, rows):
    return spark.createDataFrame(rows, "section string, page int, urls array<string>")


def visited(df):
    return sorted((r.section, r.page) for r in df.collect())


def test_stop_at_repeat(spark):
    rows = [("s", 1, ["a"]), ("s", 2, ["b"]), ("s", 3, ["b"]), ("s", 4, ["c"]), ("t", 1, ["a"]), ("t", 2, []), ("t", 3, ["z"]), ("u", 1, ["a"]), ("u", 3, ["c"]), ("w", 1, None)]
    assert visited(frontier.stop_at_repeat(pages(spark, rows))) == [("s", 1), ("s", 2), ("t", 1), ("u", 1), ("u", 3)]
    assert visited(frontier.stop_at_repeat(pages(spark, rows), gap_ends=True)) == [("s", 1), ("s", 2), ("t", 1), ("u", 1)]
    assert visited(frontier.stop_at_repeat(pages(spark, rows), min_links=2)) == []


def test_stop_rules_by_journal(spark):
    rows = [("a", "vtc", 1, ["x"]), ("a", "vtc", 2, ["x"]), ("b", "dantri", 1, ["x"]), ("b", "dantri", 2, ["x"]), ("c", "baodautu", 1, ["x", "y"]), ("c", "baodautu", 2, ["z"])]
    df = spark.createDataFrame(rows, "section string, journal string, page int, urls array<string>")
    assert visited(frontier.stop_at_repeat(df, journal="journal")) == [("a", 1), ("b", 1), ("b", 2), ("c", 1)]


def test_long_section_is_cut_into_runs(spark):
    df = spark.range(1, 5001).select(
        F.lit("s").alias("section"), F.col("id").alias("page"),
        F.array((F.col("id") - F.when(F.col("id") >= 4001, 1).otherwise(0)).cast("string")).alias("urls"),
    )
    with_prev = frontier.with_previous_page(df)
    assert with_prev.where("coalesce(prev_page, 0) <> page - 1").count() == 0
    assert frontier.stop_at_repeat(df).count() == 4000


def test_stop_across_runs_is_that_of_one_window(spark):
    """Stops at the borders of runs, by every rule, in sections that are longer than a run."""
    rows = spark.range(0, 12_000).select(
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("section"), F.element_at(F.array(F.lit("vtc"), F.lit("baodautu")), (F.col("id") % 2 + 1).cast("int")).alias("journal"),
        (F.expr("id div 4") + F.when((F.col("id") % 4 == 3) & (F.col("id") > 8000), 1).otherwise(0)).alias("page"), F.col("id"),
    )
    n = F.expr("id div 4")
    urls = F.when((F.col("section") == "s0") & n.isin(1000, 2000), F.array((n - 1).cast("string"))).when((F.col("section") == "s1") & (n == 1999), F.array())
    df = rows.withColumn("urls", urls.otherwise(F.array(n.cast("string")))).drop("id")
    for options in ({}, {"journal": "journal"}, {"gap_ends": True}, {"min_links": 2}):
        stops = frontier.stop_at_repeat(df, **options).groupBy("section").agg(F.max("page").alias("p")).collect()
        got = {r.section: r.p for r in stops}
        assert got == {
            "{}": {"s0": 999, "s1": 1998, "s2": 2999, "s3": 3000}, "{'journal': 'journal'}": {"s0": 999, "s2": 2999},
            "{'gap_ends': True}": {"s0": 999, "s1": 1998, "s2": 2999, "s3": 1999}, "{'min_links': 2}": {},
        }[str(options)]


def test_stop_reads_the_listings_twice(spark, tmp_path):
    pages(spark, [("s", 1, ["a"])]).write.parquet(str(tmp_path / "listings"))
    plan = frontier.stop_at_repeat(spark.read.parquet(str(tmp_path / "listings")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "SortMergeJoin" not in plan  # the listings, and the stored stops


def test_unseen_links(spark):
    links = spark.createDataFrame([("u", 2), ("u", 1), ("v", 3), ("w", 4)], "url string, page int")
    seen = spark.createDataFrame([("v",), ("v",)], "url string")
    assert sorted(tuple(r) for r in frontier.unseen_links(links, seen).collect()) == [("u", 1), ("w", 4)]
    only = links.select("url")
    assert sorted(r.url for r in frontier.unseen_links(only, seen).collect()) == ["u", "w"]


def test_sections(spark):
    assert section_catalogue(spark).count() == len(SECTIONS) == 22
    j, u, t = SECTIONS[0]
    df = spark.createDataFrame([("1", j, u, "old"), ("2", "vtc", u, "old")], "id string, journal string, section_url string, type string")
    assert sorted((r.id, r.type) for r in extraction.label_sections(df).collect()) == [("1", t), ("2", None)]


@pytest.mark.parametrize("hot_keys", [2, 5, 5000])
def test_lookup_join_matches_a_plain_join(spark, hot_keys):
    big = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).when(F.col("id") % 2 == 0, "warm").alias("k"),
        "id",
    )
    lookup = big.where("k is not null and k <> 'warm'").groupBy("k").agg(F.max("id").alias("m"), F.count("*").alias("n"))
    plain = big.join(lookup, "k", "left").select("k", "id", "m")
    for counted in (None, "n"):
        got = skew.lookup_join(big, lookup, "k", counted, hot_keys).select("k", "id", "m")
        assert got.exceptAll(plain).count() == 0 and got.count() == 2000


def test_hot_rows_are_spread_and_only_hot_keys_broadcast(spark):
    big = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 100 < 99, "hot").otherwise("cold").alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    df = skew.lookup_join(big, lookup, "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan and "_salt" in plan
    assert {r.v: r["count"] for r in df.groupBy("v").count().collect()} == {1: 3960, None: 40}
    # The hot rows of eight reading tasks arrive in more than one task of the join.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [len(part) for part in skew.lookup_join(big, lookup, "k").rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(1 for n in sizes if n) > 1 and max(sizes) < 3960


def articles(spark):
    rows = [
        ("1", "vtc", "finance", "Gold up", ["gold", "gold", "usd"], dt.datetime(2024, 3, 1, 5)),
        ("2", "vtc", "market", "The gold market", ["gold", "x" * 257], dt.datetime(2024, 3, 1, 9)),
        ("3", "dantri", "finance", "Rice", None, None),
    ]
    return spark.createDataFrame(rows, "id string, journal string, type string, title string, tags array<string>, date timestamp")


def test_terms(spark):
    df = articles(spark)
    assert sorted(tuple(r) for r in search.terms(df, "tags", ignore_above=256).collect()) == [("gold", 2), ("usd", 1)]
    assert [tuple(r) for r in search.terms(df, "journal", 1).collect()] == [("vtc", 2)]


def test_histogram_match_latest(spark):
    df = articles(spark)
    assert [(r.bucket, r.n) for r in search.date_histogram(df).collect()] == [(dt.datetime(2024, 3, 1), 2)]
    ids = lambda d: [r.id for r in d.orderBy("id").collect()]
    assert ids(search.match(df, "title", ["GOLD", "rice"])) == ["1", "2", "3"]
    assert ids(search.match(df, "title", ["gold", "market"], "and")) == ["2"]
    assert ids(search.match(df, "tags", ["usd"])) == ["1"]
    assert [r.id for r in search.latest(df, 1, journal="vtc").collect()] == ["2"]
    assert [r.id for r in search.latest(df, 5, type_="finance").collect()] == ["1", "3"]
    assert sorted((r.journal, r.id) for r in search.latest_per(df, "journal", 1).collect()) == [("dantri", "3"), ("vtc", "2")]


def test_trend(spark):
    rows = [("2024-03", ["a", "a", "b"]), ("2024-03", ["a"]), ("2024-04", ["c"]), ("2024-04", [])]
    df = spark.createDataFrame(rows, "year_month string, filtered_keywords array<string>")
    assert sorted(tuple(r) for r in search.keyword_trend(df).collect()) == [("2024-03", "a", 2), ("2024-03", "b", 1), ("2024-04", "c", 1)]
    assert sorted(tuple(r) for r in search.keyword_trend(df, k=1).collect()) == [("2024-03", "a", 2, 1), ("2024-04", "c", 1, 1)]
