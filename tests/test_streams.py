import json
import time

import pytest

from bantin.operators import merge
from bantin.sources import tables
from bantin.sources.files import read_collection
from bantin.sources.workspace import new_folder, shared_dir
from bantin.streaming import fold, jobs


def message(id_, journal="vtc", **more):
    body = {"id": id_, "journal": journal, "type": "finance", "title": f"t{id_}", "content": ["a, b"], "tags": ["k"], "date": "27/03/2024 14:24", **more}
    return json.dumps({"value": json.dumps(body), "topic": journal})


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def test_index_stream_recovers_from_its_checkpoint(spark, tmp_path):
    inbox = tmp_path / "in"
    target, checkpoint = str(tmp_path / "news"), jobs.checkpoint_path(str(tmp_path / "cp"), "vtc", "news")
    write(inbox, "1.json", message("1"), json.dumps({"value": "{broken", "topic": "vtc"}))
    run = lambda: jobs.start_index_stream(jobs.read_article_stream(spark, path=str(inbox)), target, checkpoint).awaitTermination()
    run()
    write(inbox, "2.json", message("2", "dantri", date="2024-03-27 14:24"))
    run()
    run()
    got = sorted((r.id, r.journal, str(r.date), r.content) for r in spark.read.parquet(target).collect())
    assert got == [("1", "vtc", "2024-03-27 14:24:00", ["a, b"]), ("2", "dantri", "None", ["a, b"])]
    batch = spark.read.schema("value string, topic string").json(str(inbox))
    assert [r.raw for r in jobs.quarantine(batch).collect()] == ["{broken"]
    assert [r.raw for r in spark.read.parquet(target + "_rejected").collect()] == ["{broken"]


def test_document_stream_folds_and_replays(spark, tmp_path):
    inbox = tmp_path / "in"
    table = tables.DocumentTable(spark, str(tmp_path / "docs"), "id", ["crawled", jobs.ARRIVAL])
    checkpoint = jobs.checkpoint_path(str(tmp_path / "cp"), "vtc", "docs")
    write(inbox, "1.json", message("1", tags=["k", "m"], title="zzz"), message("2"), message("1", tags=["k", "m"], content=["p", "", "p", "q"]))
    run = lambda: jobs.start_document_stream(jobs.read_article_stream(spark, path=str(inbox)), table, checkpoint, None).awaitTermination()
    run()
    first = {r.id: (r.title, r.tags, r.content) for r in table.read().collect()}
    assert first == {"1": ("t1", ["k", "m"], ["p", "", "p", "q"]), "2": ("t2", ["k"], ["a, b"])}
    write(inbox, "2.json", message("1", title="new", tags=["z", "k"], content=["r"]), json.dumps({"value": "{broken", "topic": "vtc"}))
    run()
    got = {r.id: (r.title, r.tags, r.content) for r in table.read().collect()}
    assert got == {"1": ("new", ["k", "m", "z"], ["r"]), "2": ("t2", ["k"], ["a, b"])}
    assert [r.raw for r in spark.read.parquet(table.path + "_rejected").collect()] == ["{broken"]
    # A batch that runs again is merged to no effect.
    again = jobs.store_records(jobs.with_arrival(spark.read.schema("value string, topic string").json(str(inbox / "2.json"))))
    table.upsert(again, 1)
    assert {r.id: (r.title, r.tags, r.content) for r in table.read().collect()} == got


def documents(spark, path, **options):
    return tables.DocumentTable(spark, str(path), "id", ["at"], replace=(), **options)


def update(spark, *rows):
    return spark.createDataFrame(rows, "id string, at int, title string, tags array<string>")


def contents(table, version=None):
    return {r.id: (r.title, r.tags) for r in table.read(version).collect()}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = documents(spark, tmp_path / "t", buckets=16)
    assert table.state() is None
    with pytest.raises(ValueError):
        table.read()
    assert table.upsert(update(spark, *[(str(i), 0, f"t{i}", ["a"]) for i in range(100)])) == 0
    before = table.state()
    assert len(before.held) == 16 and set(before.held.values()) == {0}
    assert table.upsert(update(spark, ("7", 1, "new", ["b", "a"]), ("7", 0, "old", []))) == 1
    after = table.state()
    changed = [b for b in after.held if after.held[b] != before.held[b]]
    assert len(changed) == 1 and after.held[changed[0]] == 1
    folders = [p for p in (tmp_path / "t" / "rows").rglob("store_version=1") if p.is_dir()]
    assert [p.parent.name for p in folders] == [f"store_bucket={changed[0]}"]
    got = contents(table)
    assert len(got) == 100 and got["7"] == ("new", ["a", "b"]) and got["8"] == ("t8", ["a"])
    assert contents(table, 0)["7"] == ("t7", ["a"])
    assert table.upsert(update(spark).where("false"), note="nothing") == 2 and contents(table) == got and table.state().note == "nothing"


def test_a_batch_without_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    table = documents(spark, tmp_path / "t", buckets=4)
    table.upsert(update(spark, *[(str(i), 0, "t", ["a"]) for i in range(20)]))
    before = contents(table)
    lost = update(spark, ("1", 1, "half", ["x"]), ("new", 1, "half", []))
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda state: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.upsert(lost)
    assert contents(table) == before and table.vacuum() == 0  # what may still be written stays
    for _ in range(2):  # run again, and once more
        table.upsert(lost)
        assert contents(table) == {**before, "1": ("half", ["a", "x"]), "new": ("half", None)}


def test_rebucket_and_vacuum(spark, tmp_path):
    table = documents(spark, tmp_path / "t", buckets=2)
    for n in range(3):
        table.upsert(update(spark, *[(str(i), n, f"t{n}", [f"a{n}"]) for i in range(10 * (n + 1))]))
    want = contents(table)
    table.rebucket(7)
    assert contents(table) == want and table.state().buckets == 7 and len(table.state().held) <= 7
    table.upsert(update(spark, ("new", 9, "x", None), ("1", 9, None, None)))
    want.update({"new": ("x", None), "1": (None, None)})
    assert table.vacuum(keep=2) > 0 and contents(table) == want and contents(table, 3)["1"] == ("t2", ["a0", "a1", "a2"])
    with pytest.raises(ValueError):
        table.read(2)
    assert table.vacuum() > 0 and contents(table) == want and table.vacuum() == 0
    # Opened anew, by another writer, with another number of buckets in mind.
    other = documents(spark, tmp_path / "t", buckets=3)
    other.upsert(update(spark, ("1", 10, "back", ["z"])))
    want["1"] = ("back", ["z"])
    assert contents(other) == want


def test_new_columns_and_whole_documents(spark, tmp_path):
    table = tables.DocumentTable(spark, str(tmp_path / "t"), "id", ["at"], buckets=3, whole=True)
    table.upsert(spark.createDataFrame([("1", 0, "a"), ("2", 0, "b")], "id string, at int, title string"))
    table.upsert(spark.createDataFrame([("2", 1, "c", "en"), ("2", 0, "old", "de")], "id string, at int, title string, lang string"))
    assert sorted(tuple(r) for r in table.read().select("id", "at", "title", "lang").collect()) == [("1", 0, "a", None), ("2", 1, "c", "en")]


@pytest.mark.parametrize("unset_nulls", [True, False])
def test_folded_batches_are_the_plain_ones(spark, tmp_path, unset_nulls):
    """Batches with each key once: folded where they are, met with the stored documents in one shuffle; documents without a key stay apart."""
    batches = [
        [("1", 0, "a", ["x", "", "x", None]), ("2", 0, "b", None), ("3", 0, None, []), (None, 0, "n", ["p"])],
        [("1", 1, None, ["y", "x", "y"]), ("2", 1, "c", ["k", "k"]), ("4", 1, "d", ["z", "z"]), (None, 1, "m", ["q"])],
        [("1", 2, "e", None), ("3", 2, "f", ["g"]), ("5", 2, None, None), (None, 2, "o", None)],
    ]
    plain = documents(spark, tmp_path / "plain", buckets=4, unset_nulls=unset_nulls)
    folded = documents(spark, tmp_path / "folded", buckets=4, unset_nulls=unset_nulls)
    shown = lambda table: sorted(map(repr, table.read().collect()))
    for batch in batches:
        plain.upsert(update(spark, *batch))
        folded.upsert(update(spark, *batch), folded=True)
        assert shown(folded) == shown(plain) and folded.state()[:3] == plain.state()[:3]
        assert folded.read().columns == plain.read().columns
    assert folded.upsert(update(spark).where("false"), folded=True) == 3 and shown(folded) == shown(plain)
    wider = spark.createDataFrame([("1", 9, "de"), ("7", 9, "en")], "id string, at int, lang string")
    for table in (plain, folded):
        table.upsert(wider, folded=table is folded)
    assert shown(folded) == shown(plain)


def test_a_folded_batch_is_shuffled_once(spark, tmp_path, monkeypatch):
    table, plans = documents(spark, tmp_path / "t"), []
    table.upsert(update(spark, *[(str(i), 0, "t", ["a"]) for i in range(50)]))
    wrote = tables.DocumentTable._write

    def write(self, rows, buckets, version):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        wrote(self, rows, buckets, version)

    monkeypatch.setattr(tables.DocumentTable, "_write", write)
    monkeypatch.setattr(tables, "materialise", lambda rows: pytest.fail("stored again"))
    table.upsert(update(spark, *[(str(i), 1, "u", ["b"]) for i in range(40, 90)]), folded=True)
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]
    assert len(contents(table)) == 90 and contents(table)["45"] == ("u", ["a", "b"])


def test_a_new_checkpoint_keeps_the_documents(spark, tmp_path):
    table = tables.DocumentTable(spark, str(tmp_path / "docs"), "id", ["crawled", jobs.ARRIVAL])
    for run, lines in enumerate([[message("1", tags=["a"]), json.dumps({"value": "{one", "topic": "vtc"})], [message("2"), message("1", tags=["b"]), json.dumps({"value": "{two", "topic": "vtc"})]]):
        write(tmp_path / f"in{run}", "1.json", *lines)
        stream = jobs.read_article_stream(spark, path=str(tmp_path / f"in{run}"))
        jobs.start_document_stream(stream, table, str(tmp_path / f"cp{run}"), None).awaitTermination()
    assert {r.id: r.tags for r in table.read().collect()} == {"1": ["a", "b"], "2": ["k"]}
    assert sorted(r.raw for r in spark.read.parquet(table.path + "_rejected").collect()) == ["{one", "{two"]


EXPORTED = "_id string, title string, type string, journal string, attract string, author string, date string, content array<string>, tags array<string>, crawled string"


def store(spark, *rows):
    made = [(i, t, "x", "vtc", None, None, "01/03/2024 10:00", ["p"], [], at) for i, t, at in rows]
    return spark.createDataFrame(made, EXPORTED).selectExpr("* except (crawled)", "cast(crawled as timestamp) as crawled")


def test_export_takes_late_and_equal_rows(spark, tmp_path):
    root = str(tmp_path / "export")
    shown = lambda: {r.id: r.title for r in jobs.read_export(spark, root)[1].collect()}
    assert jobs.read_export(spark, root) == (0, None, None)
    there = [("1", "a", "2024-03-01 10:00:00"), ("2", "b", "2024-03-01 12:00:00")]
    assert jobs.run_export(store(spark, *there), root) and shown() == {"1": "a", "2": "b"}
    assert str(jobs.read_export(spark, root)[2]) == "2024-03-01 12:00:00"
    assert not jobs.run_export(store(spark, *there), root)
    # Equal to the end of the last window, and late by less than the overlap; an older version of 2 is not taken.
    there += [("3", "equal", "2024-03-01 12:00:00"), ("4", "late", "2024-03-01 11:30:00"), ("2", "older", "2024-03-01 11:45:00"), ("5", "very late", "2024-03-01 01:00:00")]
    assert jobs.run_export(store(spark, *there), root) and shown() == {"1": "a", "2": "b", "3": "equal", "4": "late"}
    assert jobs.run_export(store(spark, *there), root, overlap=None) and shown()["5"] == "very late"
    # A window that is closed: what is after it waits.
    there += [("6", "new", "2024-03-02 10:00:00"), ("1", "newer", "2024-03-02 09:00:00")]
    assert jobs.run_export(store(spark, *there), root, until="2024-03-02 09:00:00") and shown()["1"] == "newer" and "6" not in shown()
    assert jobs.run_export(store(spark, *there), root) and shown()["6"] == "new"
    runs, index, until = jobs.read_export(spark, root)
    assert (runs, index.count(), str(until)) == (5, 6, "2024-03-02 10:00:00")


def test_rows_that_arrive_while_a_run_reads(spark, tmp_path):
    """The end of the window is read first: a row that comes after that is taken by the next run."""
    root, folder = str(tmp_path / "export"), str(tmp_path / "store")
    store(spark, ("1", "a", "2024-03-01 10:00:00")).write.parquet(folder)
    assert jobs.run_export(spark.read.parquet(folder), root, until="2024-03-01 10:00:00")
    store(spark, ("2", "b", "2024-03-01 09:59:00"), ("3", "c", "2024-03-01 10:00:00"), ("4", "d", "2024-03-01 10:01:00")).write.mode("append").parquet(folder)
    assert jobs.run_export(spark.read.parquet(folder), root)
    assert sorted(r.id for r in jobs.read_export(spark, root)[1].collect()) == ["1", "2", "3", "4"]


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, fold.STATE_STORE)
    yield
    spark.conf.set(name, before)


def test_fold_stream_is_the_batch_fold(spark, tmp_path, rocksdb):
    """Batches of a file each, with a stop and a new start in the middle."""
    schema = "id string, at int, title string, tags array<string>, body array<string>"
    ups = [
        ("1", 1, "a", ["x", "", "y"], ["p"]), ("1", 0, "z", ["first"], ["q"]), ("2", 2, None, None, None), ("3", 3, "c", [], []),
        ("1", 4, None, ["x", "w", "w"], ["r", "r"]), ("2", 5, "t", [""], ["s"]), ("1", 6, "n", None, None), ("1", 7, "m", ["k", None], ["u"]), ("2", 8, "v", ["h"], None),
    ]
    out = tables.DocumentTable(spark, str(tmp_path / "docs"), "id", ["at"], replace=("body",), whole=True)

    def run(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        folded = fold.fold_stream(stream, "id", ["at"], replace=("body",))
        writer = folded.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).foreachBatch(lambda b, epoch: out.upsert(b) and None).start().awaitTermination()

    for rows in (ups[:3], ups[3:6], ups[6:]):
        run(rows, "q")
    got = {r.id: (r.at, r.title, r.tags, r.body) for r in out.read().collect()}
    batch = merge.fold_updates(spark.createDataFrame(ups, schema), "id", ["at"], replace=("body",))
    empty = spark.createDataFrame([], schema)
    want = {r.id: (r.at, r.title, r.tags, r.body) for r in merge.upsert_merge(empty, batch, "id", replace=("body",)).collect()}
    assert got == want
    assert got["1"] == (7, "m", ["k"], ["u"]) and got["2"] == (8, "v", ["h"], None)


@pytest.mark.parametrize("unset_nulls", [True, False])
def test_state_holds_what_an_update_may_leave(spark, tmp_path, rocksdb, monkeypatch, unset_nulls):
    schema, states, out = "id string, at int, title string, tags array<string>, body array<string>", [], {}
    made = fold._Fold.__init__
    monkeypatch.setattr(fold._Fold, "__init__", lambda self, *args: states.append(args[3].names) or made(self, *args))
    ups = [("1", 0, "a", ["x"], ["p"]), ("2", 0, "b", ["y"], ["q"]), ("1", 1, None, ["z"], None), ("2", 1, "c", None, ["r"]), ("1", 2, "d", ["x", "w"], ["s"])]
    for run in (ups[:2], ups[2:4], ups[4:]):
        spark.createDataFrame(run, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        folded = fold.fold_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), "id", ["at"], unset_nulls, replace=("body",))
        writer = folded.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        writer.foreachBatch(lambda b, epoch: out.update({(r.id, r.at): (r.title, r.tags, r.body) for r in b.collect()})).start().awaitTermination()
    assert states == [["tags", "at"] if unset_nulls else ["title", "tags", "body", "at"]] * 3
    kept = unset_nulls is False
    assert out == {
        ("1", 0): ("a", ["x"], ["p"]), ("2", 0): ("b", ["y"], ["q"]), ("1", 1): ("a" if kept else None, ["x", "z"], ["p"] if kept else None),
        ("2", 1): ("c", ["y"] if kept else None, ["r"]), ("1", 2): ("d", ["x", "z", "w"], ["s"]),
    }


def test_idle_keys_are_forgotten_and_merged_below(spark, tmp_path, rocksdb):
    schema = "id string, at int, tags array<string>"
    out, seen = tables.DocumentTable(spark, str(tmp_path / "docs"), "id", ["at"]), []
    send = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    def write(batch, epoch):
        rows = [tuple(r) for r in batch.collect()]
        if rows:
            out.upsert(spark.createDataFrame(rows, batch.schema))
            seen.extend(rows)

    send(("1", 0, ["a"]))
    folded = fold.fold_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), "id", ["at"], idle_ms=1)
    query = folded.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="100 milliseconds").foreachBatch(write).start()
    try:
        for wanted, row in ((1, ("2", 1, ["b"])), (2, ("1", 2, ["c"])), (3, None)):
            until = time.time() + 60
            while len(seen) < wanted and time.time() < until:
                time.sleep(0.2)
            time.sleep(1)  # several batches without data, in which the timers run out
            if row:
                send(row)
    finally:
        query.stop()
    assert seen == [("1", ["a"], 0), ("2", ["b"], 1), ("1", ["c"], 2)]
    assert {r.id: r.tags for r in out.read().collect()} == {"1": ["a", "c"], "2": ["b"]}
    queue = spark.readStream.schema("value string, topic string, partition int, offset long").json(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        jobs.start_folded_stream(queue.drop("offset"), out, str(tmp_path / "x"))
    with pytest.raises(ValueError):
        jobs.start_folded_stream(queue, out, str(tmp_path / "x"), None, idle_ms=1)


def test_fan_out(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, "1.json", message("1"), message("2", "dantri"), message("3", "laodong"))
    stream = jobs.read_article_stream(spark, path=str(inbox))
    assert set(jobs.split_by_journal(stream, ["vtc", "dantri"])) == {"vtc", "dantri"}
    jobs.start_fan_out(stream, ["vtc", "dantri", "nosuch"], str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.id for r in read_collection(spark, str(tmp_path / "out" / "news")).collect()) == ["1", "2"]


def test_republished_articles_pass_once(spark, tmp_path):
    inbox = tmp_path / "in"
    row = lambda i, t: json.dumps({"id": i, "crawled": t})
    write(inbox, "1.json", row("a", "2024-01-01T00:00:00Z"), row("b", "2024-01-01T00:10:00Z"), row("a", "2024-01-01T00:20:00Z"))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = spark.readStream.schema("id string, crawled timestamp").json(str(inbox))
        writer = jobs.drop_republished(stream).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()

    run()
    write(inbox, "2.json", row("a", "2024-01-01T01:00:00Z"), row("c", "2024-01-01T01:00:00Z"))
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_incremental_export(spark):
    schema = "_id string, title string, type string, journal string, attract string, author string, date string, content array<string>, tags array<string>, crawled timestamp"
    rows = [
        ("1", "old", "x", "vtc", None, None, "01/03/2024 10:00", ["p"], [], "2024-03-01 10:00:00"),
        ("2", "new", "x", "vtc", None, None, "02/03/2024 10:00", ["p"], [], "2024-03-02 10:00:00"),
        ("2", "newer", "x", "vtc", None, None, "02/03/2024 11:00", ["p"], [], "2024-03-02 11:00:00"),
    ]
    stored = spark.createDataFrame([r[:9] for r in rows], schema.rsplit(",", 1)[0])
    stored = spark.createDataFrame(rows, schema.replace("crawled timestamp", "crawled string")).selectExpr(
        *[c for c in stored.columns], "cast(crawled as timestamp) as crawled"
    )
    first = jobs.incremental_export(stored, None, "2024-03-01 12:00:00")
    assert [(r.id, r.title, str(r.date)) for r in first.collect()] == [("2", "newer", "2024-03-02 00:00:00")]
    again = jobs.incremental_export(stored, first, "2024-03-01 12:00:00")
    assert again.count() == 1
    assert str(jobs.next_watermark(stored, "2024-03-01 12:00:00").first().since) == "2024-03-02 11:00:00"


def test_tables_and_routing(spark, tmp_path):
    df = spark.createDataFrame([("1", "vtc", 1, "a"), ("1", "vtc", 2, "b"), ("2", "dantri", 1, "c")], "id string, journal string, crawled int, title string")
    path = str(tmp_path / "t")
    tables.write_append(df, path, mode="error")
    with pytest.raises(Exception, match="already exists"):
        tables.write_append(df, path, mode="error")
    tables.write_append(df, path)
    assert read_collection(spark, path, "vtc").count() == 4
    files = str(tmp_path / "f")
    tables.write_article_files(df, files)
    assert sorted((r.id, r.title) for r in spark.read.json(files).collect()) == [("1", "b"), ("2", "c")]
    used = []
    assert tables.route(df, store=lambda d: used.append("store"), files=lambda d: used.append("files")) == "store"
    assert tables.route(df, queue=lambda d: used.append("queue"), store=lambda d: used.append("store")) == "queue"
    assert used == ["store", "queue"]
    with pytest.raises(ValueError):
        tables.route(df)


def test_shared_dir(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_in_many_files_is_streamed(spark, tmp_path, files):
    from bantin.plans import streams

    texts = [(i, f"title {i}\nline", "en", "web") for i in range(12)]
    table = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string").repartition(files)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    if files == 1:  # a table may be a single file as well
        part = next((tmp_path / "documents.parquet").glob("part-*"))
        (tmp_path / "one").mkdir()
        (tmp_path / "one" / "documents.parquet").write_bytes(part.read_bytes())
    folder = str(tmp_path / "one" if files == 1 else tmp_path)
    assert streams.index_stream(spark, folder).count() == 11  # document 0 is broken
    assert tuple(streams.stream_rejects(spark, folder).first()) == (11, 1, 1)
