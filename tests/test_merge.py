import json

import pytest
from pyspark.sql import functions as F

from bantin.operators import merge as M
from bantin.sources.tables import DocumentTable
from bantin.sources.workspace import new_folder

TARGET = "id string, title string, tags array<string>"


def docs(spark, *rows, schema=TARGET):
    return spark.createDataFrame(list(rows), schema)


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def target(spark):
    return docs(spark, ("a", "A", ["x", "x", "y"]), ("b", "B", None), ("z", "Z", ["q"]))


def updates(spark):
    return docs(spark, ("a", None, ["y", "n", "n", "", None]), ("b", "B2", ["m"]), ("c", "C", ["r", "r"]))


def test_merge_sets_unsets_and_adds(spark):
    got = as_dict(M.upsert_merge(target(spark), updates(spark)))
    assert got == {
        "a": (None, ["x", "x", "y", "n"]), "b": ("B2", ["m"]), "c": ("C", ["r"]), "z": ("Z", ["q"]),
    }


def test_merge_twice_is_merge_once(spark):
    once = M.upsert_merge(target(spark), updates(spark))
    assert as_dict(M.upsert_merge(once, updates(spark))) == as_dict(once)


def test_one_pass_merge_gives_the_same(spark):
    new = updates(spark).withColumn("views", F.lit(1))
    for unset in (True, False):
        usual = M.upsert_merge(target(spark), new, unset_nulls=unset, rewrite=False)
        one_pass = M.upsert_merge(target(spark), new, unset_nulls=unset)
        assert one_pass.columns == usual.columns and as_dict(one_pass) == as_dict(usual)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_each_side_is_read_at_most_twice(spark, tmp_path):
    target(spark).write.parquet(f"{tmp_path}/stored")
    docs(spark, ("a", 1, "A", ["x"]), ("a", 2, "B", None), schema=FOLD).write.parquet(f"{tmp_path}/updates")
    stored, given = spark.read.parquet(f"{tmp_path}/stored"), spark.read.parquet(f"{tmp_path}/updates")
    assert scans(M.upsert_merge(stored, given.drop("n"))) == 2  # one each
    # One scan of the updates has been run for the aggregate that is stored; left are one more, and two of the aggregate.
    folded = M.fold_updates(given, "id", ["n"])
    assert scans(folded) == 3 and [(r.title, r.tags) for r in folded.collect()] == [("B", None)]


def test_null_key_is_a_key(spark):
    changes = docs(spark, (None, 1, "A", ["x"]), (None, 2, "B", None), (None, 3, "C", ["y"]), schema=FOLD)
    assert [(r.id, r.title, r.tags) for r in M.fold_updates(changes, "id", ["n"]).collect()] == [(None, "C", ["y"])]


def test_null_as_missing(spark):
    got = as_dict(M.upsert_merge(target(spark), updates(spark), unset_nulls=False))
    assert got["a"] == ("A", ["x", "x", "y", "n"])


def test_null_list_unsets_and_empty_list_does_nothing(spark):
    change = docs(spark, ("a", "A", None), ("z", "Z", []), ("n", "N", []))
    got = as_dict(M.upsert_merge(target(spark), change))
    assert got["a"] == ("A", None) and got["z"] == ("Z", ["q"]) and got["n"] == ("N", None)


def test_new_and_missing_columns(spark):
    change = spark.createDataFrame([("a", 7), ("n", 8)], "id string, views int")
    got = M.upsert_merge(target(spark), change)
    assert got.columns == ["id", "title", "tags", "views"]
    assert as_dict(got)["a"] == ("A", ["x", "x", "y"], 7)
    assert as_dict(got)["z"] == ("Z", ["q"], None)
    assert as_dict(got)["n"] == (None, None, 8)


def test_falsy_items_by_type(spark):
    t = spark.createDataFrame([("a", [1])], "id string, ns array<int>")
    u = spark.createDataFrame([("a", [0, 2, None, 1])], "id string, ns array<int>")
    assert as_dict(M.upsert_merge(t, u)) == {"a": ([1, 2],)}


def test_replace_and_shallow(spark):
    replaced = as_dict(M.upsert_replace(target(spark), updates(spark)))
    assert replaced["a"] == (None, ["y", "n", "n", "", None])
    shallow = as_dict(M.upsert_shallow(target(spark), updates(spark)))
    assert shallow["a"] == ("A", ["y", "n", "n", "", None])
    assert shallow["z"] == ("Z", ["q"]) and shallow["c"] == ("C", ["r", "r"])
    assert as_dict(M.upsert_replace(target(spark), updates(spark), keep_none=True)) == replaced
    with pytest.raises(ValueError):
        M.upsert_replace(target(spark), updates(spark), merge=True, keep_none=True)


def test_composite_key(spark):
    schema = "id string, shard int, title string"
    t = docs(spark, ("a", 1, "A1"), ("a", 2, "A2"), schema=schema)
    u = docs(spark, ("a", 2, "new"), ("a", 3, "A3"), schema=schema)
    got = sorted(tuple(r) for r in M.upsert_merge(t, u, ["id", "shard"]).collect())
    assert got == [("a", 1, "A1"), ("a", 2, "new"), ("a", 3, "A3")]


def test_classify(spark):
    row = M.classify_update(updates(spark)).where("id = 'a'").first()
    assert row.unset == ["title"] and row.set.title is None and row.add_to_set.tags == ["y", "n", "n"]


FOLD = "id string, n int, title string, tags array<string>"


def sequential(spark, base, batch):
    """The updates applied one by one, in order."""
    for row in sorted(batch, key=lambda r: r[1]):
        merged = M.upsert_merge(base, docs(spark, row, schema=FOLD).drop("n"), rewrite=True)
        base = docs(spark, *[tuple(r) for r in merged.collect()])
    return as_dict(base)


def test_fold_equals_one_by_one(spark):
    batch = [
        ("a", 1, "t1", ["n", "y"]), ("a", 2, None, None), ("a", 3, "t3", ["k", ""]), ("a", 4, "t4", []),
        ("b", 5, "u1", ["m", "m"]), ("b", 6, "u2", ["o", "m"]),
        ("z", 7, "v", ["w"]), ("z", 8, "v2", None),
        ("new", 9, "x", ["p"]), ("new", 10, None, ["", "q"]),
    ]
    folded = M.fold_updates(docs(spark, *batch, schema=FOLD), "id", ["n"]).drop("n")
    assert as_dict(M.upsert_merge(target(spark), folded)) == sequential(spark, target(spark), batch)


def test_fold_with_null_as_missing(spark):
    batch = [("a", 1, "t1", ["n"]), ("a", 2, None, None), ("a", 3, None, ["k"])]
    folded = M.fold_updates(docs(spark, *batch, schema=FOLD), "id", ["n"], unset_nulls=False).drop("n")
    got = as_dict(M.upsert_merge(target(spark), folded, unset_nulls=False))
    assert got["a"] == ("t1", ["x", "x", "y", "n", "k"])


def test_fold_of_one_hot_key(spark):
    batch = spark.range(3000).select(
        F.when(F.col("id") < 2500, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("int").alias("n"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
        F.when(F.col("id") != 1200, F.array(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))).alias("tags"),
    )
    folded = M.fold_updates(batch, "id", ["n"])
    hot = folded.where("id = 'hot'").first()
    assert folded.count() == 501 and hot.title == "t2499" and hot[M.CLEARED] == ["tags"]
    assert hot.tags == [f"g{i % 7}" for i in range(1201, 1208)]


def test_keep_last(spark):
    copies = docs(spark, ("a", 1, "old", None), ("a", 3, "last", ["x"]), ("a", 2, "mid", None), schema=FOLD)
    assert as_dict(M.keep_last(copies, "id", ["n"])) == {"a": (3, "last", ["x"])}


def test_document_table(spark):
    table = DocumentTable(spark, new_folder(spark, "t"), "id", ["n"])
    table.upsert(docs(spark, ("a", 1, "A", ["x"]), ("b", 1, "B", None), schema=FOLD), 0)
    table.upsert(docs(spark, ("a", 1, None, ["y"]), schema=FOLD), 1)
    # The same batch again, as after a failure: it replaces itself.
    table.upsert(docs(spark, ("a", 1, "A2", ["y"]), schema=FOLD), 1)
    assert as_dict(table.read().drop("n")) == {"a": ("A2", ["x", "y"]), "b": ("B", None)}
    table.upsert(docs(spark, ("c", 1, "C", []), ("b", 1, "B", ["k"]), schema=FOLD), 2)
    assert as_dict(table.read().drop("n")) == {"a": ("A2", ["x", "y"]), "b": ("B", ["k"]), "c": ("C", None)}
    assert as_dict(table.read(0).drop("n")) == {"a": ("A", ["x"]), "b": ("B", None)}


def test_replaced_lists_are_set_whole(spark):
    changes = docs(spark, ("a", 1, "A", ["p", "", "p"]), ("a", 2, "B", ["q", "q"]), schema=FOLD)
    folded = M.fold_updates(changes, "id", ["n"], replace=["tags"])
    assert [(r.title, r.tags) for r in folded.collect()] == [("B", ["q", "q"])]
    stored = docs(spark, ("a", 0, "0", ["z"]), schema=FOLD)
    assert as_dict(M.upsert_merge(stored, folded, replace=["tags"]).drop("n")) == {"a": ("B", ["q", "q"])}


def test_record_files_do_not_grow_with_the_table(spark, monkeypatch):
    from bantin.plans import merges

    folders, read = [], merges.read_records
    monkeypatch.setattr(merges, "_RECORDS_A_FILE", 20)
    monkeypatch.setattr(merges, "read_records", lambda s, path: folders.append(path) or read(s, path))
    n = merges.load_records(spark, "/root/testdata/sf0.01").count()
    sizes = [len(json.loads(r.value)) for r in spark.read.text(folders[0], wholetext=True).collect()]
    assert sum(sizes) == n and max(sizes) <= 20


def test_whole_updates_are_shuffled_once(spark):
    """Long fields go through one shuffle, and the items of a list never take them along."""
    rows = [("a", "old", ["x"], ["long"], 1), ("a", "new", None, ["longer"], 2), ("a", "new", ["y", "x"], ["longest"], 3), (None, "n", ["z"], None, 1)]
    updates = spark.createDataFrame(rows, "id string, title string, tags array<string>, content array<string>, at int")
    folded = M.fold_updates(updates, "id", ["at"], replace=["content"])
    got = {r.id: (r.title, r.tags, r.content, r.at) for r in folded.collect()}
    assert got == {"a": ("new", ["y", "x"], ["longest"], 3), None: ("n", ["z"], None, 1)}
    plan = folded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # One reduction of whole updates, straight from them; a scan of stored rows has no content.
    assert sum("partial_max(struct(" in line and "content" in line for line in plan.splitlines()) == 1
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert not any("content" in line for line in scans)
