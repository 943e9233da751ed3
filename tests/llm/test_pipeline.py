"""The pipeline stage by stage against brute force, and as a whole."""

import pytest
from test_decontamination import brute as contaminated
from test_jaccard_join import brute as grouped
from test_jaccard_join import near_copies
from test_line_dedup import brute as deduped
from test_toxicity import corpus

import corpus_pipeline as P
from bantin.llm import toxicity as T

LINE = "a line that several documents of the corpus share"
ITEM = "one two three four five six seven eight nine ten eleven"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t + (f"\n{LINE}" if i % 7 == 0 else ""), x) for i, t, x in corpus(3, 200)]
    rows += [(1000 + i, t, None) for i, (_, t) in enumerate(near_copies(6, 15, 5))]
    rows += [(2000 + i, f"start {i} {ITEM} end", None) for i in range(3)] + [(3000, None, 0), (3001, "", None), (3002, "x y", None), (3002, "x y", None), (None, "no id", None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, x) for i, _, x in rows if x is not None], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, "never seen words")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    expected = {}

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = T.train(*T.labelled_sample(docs, labels, T.F.lit(True)))
    before = pairs(docs)
    expected["toxicity"] = [d for d in before if model.scores([d[1] or ""])[0] < 0.5]
    assert 0 < len(expected["toxicity"]) < len(before)

    for name, stage in P.STAGES[:-1]:
        before = pairs(docs)
        if name == "line dedup":
            expected[name] = [(d, t) for d, t, _, _ in deduped(before)]
        elif name == "n-gram Jaccard join":
            first = {d for d, _, c in grouped(before, 5, 80) if d == c}
            expected[name] = [d for d in before if d[0] in first]
        elif name == "benchmark decontamination":
            clean = {d for d, *_, hit in contaminated(before, [(1, ITEM), (2, "never seen words")]) if not hit}
            expected[name] = [d for d in before if d[0] in clean]
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        path = f"{folder}/{name.replace(' ', '_')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert sorted(pairs(docs), key=repr) == sorted(expected[name], key=repr), name

    packed = P.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted({r.doc_id for r in packed}, key=repr) == sorted({d for d, _ in pairs(docs)}, key=repr)
    whole = P.run(spark, folder).collect()
    assert sorted((repr(r.doc_id), r.piece, r.ids_crc32) for r in whole) == sorted((repr(r.doc_id), r.piece, r.ids_crc32) for r in packed)
