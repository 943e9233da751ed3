"""Record arrays cut at any byte, and the set of seen URLs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from bantin.sources import arrays, files
from bantin.sources.seen import SeenSet


def records(rng, n):
    text = lambda: "".join(rng.choice(['a', '"', "\\", "{", "}", "[", "]", ",", "é", "\n", " ", ":"]) for _ in range(rng.randrange(12)))
    return [{"id": i, "t": text(), "about": {text() + "k": text(), "list": [{"x": text()}, [], {}, [text()]]}} for i in range(n)]


@pytest.mark.parametrize("range_bytes, block", [(1, 1), (61, 3), (300, 5), (1000, 1000), (1 << 20, 1 << 20)])
def test_arrays_cut_at_any_byte(spark, tmp_path, range_bytes, block):
    rng = random.Random(range_bytes)
    made = records(rng, 1 if range_bytes == 1 else 30)
    (tmp_path / "a.json").write_text(" \n" + json.dumps(made[::2], ensure_ascii=False, indent=rng.choice([None, 1])) + "\n")
    (tmp_path / "b.json").write_text("\r\n".join(json.dumps(r) for r in made[1::2]))
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text('[1, "{", null, {"id": -1}, [2]]')
    lines = [r.value for r in arrays.record_lines(spark, str(tmp_path), range_bytes, block).collect()]
    got = [json.loads(x) for x in lines]
    want = [*made, {"id": -1}, [2]]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    made = [{"id": i, "about": {"journal": f"j{i % 3}", "n": i}} for i in range(3000)]
    (tmp_path / "one.json").write_text(json.dumps(made))
    lines = arrays.record_lines(spark, str(tmp_path), 4_000)
    per_task = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 3000 and len(per_task) > 10 and max(per_task) < 600
    flat = files.load_records(spark, str(tmp_path / "one.json"))
    assert sorted(flat.columns) == ["about.journal", "about.n", "id"] and flat.count() == 3000


def links(spark, *rows):
    return spark.createDataFrame(rows, "url string, page int")


def test_seen_set_over_crawls(spark, tmp_path):
    seen = SeenSet(spark, str(tmp_path / "seen"), expected=100)
    assert sorted(tuple(r) for r in seen.unseen(links(spark, ("u", 2), ("u", 1), ("v", 3))).collect()) == [("u", 1), ("v", 3)]
    seen.add(links(spark, ("u", 1), ("v", 3), (None, 1)))
    seen.add(links(spark, ("w", 1)))
    seen.add(links(spark, ("w", 1)))
    found = seen.unseen(links(spark, ("u", 1), ("x", 4), ("w", 1), ("y", 2), ("x", 3)))
    assert sorted(tuple(r) for r in found.collect()) == [("x", 3), ("y", 2)]
    assert sorted(r.url for r in seen.urls().distinct().collect()) == ["u", "v", "w"]


def test_answers_stay_as_crawls_go_on(spark, tmp_path):
    """Answers looked at together, after all crawls, are those of their time."""
    seen, found = SeenSet(spark, str(tmp_path / "seen"), expected=1_000), []
    for crawl in range(3):
        own = links(spark, *[(f"u{i}", crawl) for i in range(10 * crawl, 10 * crawl + 15)])
        found.append(seen.unseen(own))
        seen.add(own)
    together = found[0].unionByName(found[1]).unionByName(found[2])
    assert sorted((r.page, r["count"]) for r in together.groupBy("page").count().collect()) == [(0, 15), (1, 10), (2, 10)]


@pytest.mark.parametrize("expected, most", [(20_000, 0.05), (24, 1.01)])
def test_filter_knows_all_and_little_else(spark, tmp_path, expected, most):
    """Filters of two crawls, merged; one far too small is wrong more often but loses no link."""
    name = F.concat(F.lit("https://a.example/"), F.col("id").cast("string")).alias("url")
    seen = SeenSet(spark, str(tmp_path / "seen"), expected=expected)
    seen.add(spark.range(0, 10_000).select(name))
    seen.add(spark.range(5_000, 20_000).select(name))
    known = seen.marked(spark.range(0, 20_000).select(name))
    assert known.where("maybe_seen").count() == 20_000
    new = spark.range(20_000, 30_000).select(name)
    assert seen.marked(new).where("maybe_seen").count() <= most * 10_000
    asked = spark.range(15_000, 30_000).select(name)
    assert seen.unseen(asked).exceptAll(new).count() == 0 and seen.unseen(asked).count() == 10_000
    seen.rebuild(20_000)
    assert seen.marked(new).where("maybe_seen").count() <= 500 and seen.unseen(asked).count() == 10_000
    assert seen.filter_rows().groupBy("block").count().where("count > 1").isEmpty()


def test_only_unsure_links_meet_the_table(spark, tmp_path):
    name = F.concat(F.lit("u"), F.col("id").cast("string")).alias("url")
    seen = SeenSet(spark, str(tmp_path / "seen"), expected=5_000)
    seen.add(spark.range(1000).select(name))
    plan = seen.told_apart(spark.range(900, 3000).select(name))._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("LeftAnti") :]
    assert "maybe_seen" in join and plan.count("LeftAnti") == 1
