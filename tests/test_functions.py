import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from bantin.functions import documents as D
from bantin.functions import text as TX
from bantin.functions import urls as U
from bantin.operators import envelope as E
from bantin.operators import filters, lookup, nested
from bantin.operators.keywords import candidate_phrases
from bantin.operators.search import match, terms
from bantin.sources import connectors as C
from bantin.sources.files import load_records, read_articles_json, result_name, split_csv_payload


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr.alias("r")).first().r


@pytest.mark.parametrize("text, expected", [
    ("  a b ", "a b"), ("a", "a"), ("Ngân hàng tốt".encode().decode("latin-1"), "Ngân hàng tốt"),
    ("donâ€™t", "don’t"), ("Ngân hàng tốt", "Ngân hàng tốt"), ("Ã alone", "Ã alone"), ("", ""), (None, None),
])
def test_clean_text(spark, text, expected):
    assert one(spark, text, TX.clean_text("v")) == expected


@pytest.mark.parametrize("text, expected", [
    ("[a, b]", ["a", "b"]), ("[]", [""]), ("[Hello, world]", ["Hello", "world"]), ("[[a], b]]", ["[a]", "b]"]), ("a", ["a"]), (None, None),
])
def test_split_list_string(spark, text, expected):
    assert one(spark, text, D.split_list_string("v")) == expected


@pytest.mark.parametrize("text, expected", [
    ('[{"url":"u","title":"t, =x"}]', [("u", "t, =x")]), ("[{url=u, title=t}, {url=v, title=}]", [("u", "t"), ("v", "")]), ("junk", None), (None, None),
])
def test_image_list(spark, text, expected):
    got = one(spark, text, D.parse_image_list("v"))
    assert (got and [tuple(x) for x in got]) == expected


def test_maps(spark):
    m = {"a": "1", "b": None}
    assert one(spark, m, D.drop_null_entries("v"), "map<string,string>") == {"a": "1"}
    assert one(spark, m, D.keep_keys("v", ["b", "c"]), "map<string,string>") == {"b": None}
    assert one(spark, m, D.keep_keys("v", None), "map<string,string>") == m
    assert one(spark, m, D.keep_keys("v", []), "map<string,string>") == {}
    numbers = spark.createDataFrame([({"a": 1.0}, {"a": 2.0, "z": 9.0})], "x map<string,double>, y map<string,double>")
    assert numbers.select(D.add_maps("x", "y").alias("r")).first().r == {"a": 3.0}
    with pytest.raises(Exception, match="key missing"):
        numbers.select(D.add_maps("y", "x")).collect()


def test_words(spark):
    assert one(spark, "The Café, l'été 3x. naïve", TX.tokens("v")) == ["the", "café", "l", "été", "3x", "naïve"]
    words = ["a", "b", "the", "c"]
    assert one(spark, words, TX.word_runs("v", (2, 3), ["the"]), "array<string>") == ["a b", "b the c"]
    assert one(spark, ["x"], TX.word_runs("v"), "array<string>") == []
    counted = one(spark, ["b", "a", "b"], TX.count_values("v"), "array<string>")
    assert [tuple(x) for x in counted] == [("a", 1), ("b", 2)]
    assert one(spark, [], TX.count_values("v"), "array<string>") == []
    assert one(spark, ["was", "up"], TX.lemmatise("v", {"was": "be"}), "array<string>") == ["be", "up"]
    assert one(spark, ["was", "up"], TX.remove_words("v", ["up"]), "array<string>") == ["was"]


@pytest.mark.parametrize("journal, url, key", [
    ("vtc", "https://x/s/a-1.2.html", "vtc_a-1"), ("vtc", "https://x/s/", "vtc_"), ("vtc", "https://x/s/a?q=1", "vtc_a?q=1"),
    ("saigontimes", "https://x/s.a/b/", "saigontimes_b"), ("nhipcaudautu", "https://x/a.b/3/", "nhipcaudautu_3"),
    ("nhipcaudautu", "https://x/a.b/", "nhipcaudautu_a.b"),
])
def test_article_key(spark, journal, url, key):
    df = spark.createDataFrame([(journal, url)], "j string, u string")
    assert df.select(U.article_key("j", "u").alias("k")).first().k == key


def test_messages(spark):
    good = '{"id":"1","journal":"vtc","content":["a, b","[x]",null],"tags":[],"extra":1}'
    messages = spark.createDataFrame([(good,), ('{"id":"2", "con',), ("[]",), (None,)], "value string")
    decoded = E.decode_payload(messages)
    first = E.good_messages(decoded).where("id = '1'").first()
    assert (first.content, first.tags, first.title) == (["a, b", "[x]", None], [], None)
    assert [r[0] for r in decoded.where("_corrupt_record is not null").select("_corrupt_record").collect()][0].startswith('{"id":"2"')
    back = E.decode_payload(E.encode_messages(spark.createDataFrame([first.asDict()], E.good_messages(decoded).schema)).drop("key"))
    assert back.drop("_corrupt_record").first().asDict(recursive=True) == first.asDict(recursive=True)


def test_project_and_required(spark):
    df = spark.createDataFrame([("1", None, "x"), ("2", "j", "y")], "id string, journal string, title string")
    assert [r.id for r in filters.with_required_columns(df, ["id", "journal"]).collect()] == ["2"]
    assert [r.id for r in filters.without_required_columns(df, ["id", "journal"]).collect()] == ["1"]


def test_flatten(spark):
    df = spark.createDataFrame(
        [Row(a=Row(b=1, c=Row(d="x")), docs=[Row(k=1, m="first"), Row(k=2, m=None)], tags=[], ns=[1, 2])],
        "a struct<b:int,c:struct<d:string>>, docs array<struct<k:int,m:string>>, tags array<string>, ns array<int>",
    )
    flat = nested.flatten(df)
    assert flat.columns == ["a.b", "a.c.d", "docs.k", "docs.m", "tags", "ns"]
    assert tuple(flat.first()) == (1, "x", 2, "first", None, [1, 2])
    structs = df.select("a")
    assert nested.unflatten(nested.flatten(structs)).collect() == structs.collect()


def test_compact_json(spark):
    df = spark.createDataFrame(
        [Row(a=None, s=Row(x=None, y=1), l=["p", None], m={"k": None, "v": "w"}, d=[Row(q=None, r={"z": None})])],
        "a string, s struct<x:int,y:int>, l array<string>, m map<string,string>, d array<struct<q:int,r:map<string,string>>>",
    )
    assert nested.compact_json(df).first().doc == '{"s":{"y":1},"l":["p",null],"m":{"v":"w"},"d":[{"r":{}}]}'


def test_csv_payload(spark):
    df = spark.createDataFrame([("1,x;y,0.5",), ("2",)], "value string")
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("id int, tags array<string>, score double")
    assert [tuple(r) for r in split_csv_payload(df, schema).collect()] == [(1, ["x", "y"], 0.5), (2, None, None)]


def test_find(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, n int")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(lookup.find(df)) == ids(lookup.find(df, [])) == ["a", "b", "c"]
    assert ids(lookup.find(df, ["a", "b", "zz"], F.col("n") > 1)) == ["b"]
    assert ids(lookup.find(df, ["a"], F.col("id") == "b", condition_names_key=True)) == ["b"]
    assert lookup.find(df, ["a"], projection=["n"]).columns == ["id", "n"]
    assert ids(lookup.find(df, df.where("n = 1").union(df.where("n = 1")))) == ["a"]
    assert ids(lookup.find_one(df, None, F.col("n") > 0)) == ["a"]
    assert ids(lookup.delete_by_keys(df, ["a"])) == ["b", "c"]
    assert ids(lookup.delete_by_keys(df, [])) == ["a", "b", "c"]
    assert ids(lookup.delete_where(df, F.col("n") > 1)) == ["a", "c"]
    many = [str(i) for i in range(2000)] + ["b"]
    assert ids(lookup.find(df, many)) == ["b"]


def test_json_files(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": "1",\n "journal": "vtc", "content": ["p"], "unknown": 3}')
    (tmp_path / "two.json").write_text('{"id": "2"}')
    got = read_articles_json(spark, f"{tmp_path}/*.json").orderBy("id").collect()
    assert [(r.id, r.journal, r.content) for r in got] == [("1", "vtc", ["p"]), ("2", None, None)]
    folder = tmp_path / "records"
    folder.mkdir()
    (folder / "news.json").write_text('[{"a": {"b": 1}, "c": [{"d": 1}, {"d": 2}]},\n {"a": {"b": 3}, "c": []}]')
    flat = load_records(spark, str(folder))
    assert sorted(map(tuple, flat.select("`a.b`", "`c.d`").collect())) == [(1, 2), (3, None)]
    assert result_name("news.json", "_keywords") == "news_keywords.json"


def test_connector_options():
    assert C.kafka_source_options(["a", "b"], "h:1") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "failOnDataLoss": "false", "startingOffsets": "earliest",
    }
    assert "startingOffsets" not in C.kafka_source_options("a", "h:1", None)
    assert C.elasticsearch_options("h", "news", upsert_by="id")["es.write.operation"] == "upsert"
    assert "es.mapping.id" not in C.elasticsearch_options("h", "news")
    assert C.mongodb_upsert_options("u", "d", "c", ["_id"])["upsertDocument"] == "true"
    assert C.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_keyword_filter(spark):
    kws = [("gold price", 0.5), ("gold rate", 0.51), ("asean", 0.9), ("Asean", 0.9), ("x", None)]
    got = one(spark, kws, filters.keyword_filter("v"), "array<struct<keyword:string,score:double>>")
    assert got == ["gold rate", "Asean"]
    assert one(spark, None, filters.keyword_filter("v"), "array<struct<keyword:string,score:double>>") is None


def test_words_of_any_script(spark):
    df = spark.createDataFrame([("Thị trường chứng khoán 2024",), ("the stock market",)], "text string")
    words = [r.w for r in df.select(TX.tokens("text").alias("w")).collect()]
    assert words == [["thị", "trường", "chứng", "khoán", "2024"], ["the", "stock", "market"]]
    count = lambda *ws: match(df, "text", list(ws), "and").count()
    assert (count("thị"), count("2024"), count("Trường", "khoán"), count("th"), count("mark")) == (1, 1, 1, 0, 0)
    assert {r.phrase for r in candidate_phrases(df.withColumn("doc_id", F.lit(1)), lengths=(2,)).collect()} >= {"stock market", "thị trường"}


def test_terms_count_long_values(spark):
    df = spark.createDataFrame([("x" * 300,), ("a",), (None,)], "tag string")
    assert sorted(r.n for r in terms(df, "tag").collect()) == [1, 1]
    assert [r.tag for r in terms(df, "tag", ignore_above=256).collect()] == ["a"]
