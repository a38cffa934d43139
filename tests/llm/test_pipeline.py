import re

import corpus_pipeline
from helpers import SCHEMA, awkward
from test_decontam import ITEM_SCHEMA
from test_langid import corpus
from test_linededup import brute as line_brute
from test_simhash import brute_components


def test_stages_against_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in corpus(spark, 80).collect()]
    header = "the header that many documents repeat"
    rows = [(d, f"{header}\n{t}" if d % 3 == 0 else t, lang, s, n) for d, t, lang, s, n in rows]
    item = "which of the seven mills was not turning on that day by the river and from whom was it bought"
    rows += [(200, rows[1][1] + " " + item, "en", "en1.example.en", 0), (201, "@@ ## $$ 12", "en", "x", 0), (202, rows[5][1], rows[5][2], "y", 0), (202, rows[5][1], rows[5][2], "y", 0)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], ITEM_SCHEMA).write.parquet(f"{sf}/benchmark.parquet")
    docs, states = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        states.append(sorted(tuple(r) for r in docs.collect()))
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    one, two, three, four, five = states
    assert {r[0] for r in rows} - {r[0] for r in one} == {201}
    want = {(d, t) for d, _, _, t in line_brute([(r[0], r[1]) for r in one])}
    assert {(r[0], r[1]) for r in two} == want and all(r[4] == len(r[1]) for r in two)
    firsts = {d for d, _, c in brute_components([(r[0], r[1]) for r in two]) if d == c}
    assert sorted(r[0] for r in three) == sorted(firsts)
    assert {r[0] for r in three} - {r[0] for r in four} == {200}
    assert sum(p[5] for p in five) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) + 1 for r in four)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect()) == five


def test_rows_that_repeat_an_id_leave_the_smallest_text(spark):
    rows = [(1, "b text of its own", "en", "s", 1), (1, "a text of its own", "en", "s", 2), (1, "a text of its own", "de", "s", 2), (2, "something else to read", "en", "s", 3), (None, "b text of its own", "en", "s", 1), (None, None, None, None, None), (3, None, "en", "s", 4), (3, "", "en", "s", 4)]
    for parts in (1, 4):
        out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(parts), "")
        assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "a text of its own", "de", "s", 2), rows[3], rows[4], rows[5], rows[6]], key=repr)


def test_awkward_rows_go_through_all_stages(spark, tmp_path):
    """Null ids and texts, empty and very long texts, repeated rows, more columns under other spellings of names used within; and an empty table."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "D", "fp", "component_id", "_id", "gone", "shard"]
    for sf, docs in ((f"{tmp_path}/a", awkward(spark)), (f"{tmp_path}/b", awkward(spark).limit(0))):
        docs = docs.selectExpr("*", "1 AS D", "2 AS fp", "3 AS component_id", "4 AS _id", "5 AS gone", "6 AS shard")
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, "an item that no document holds at all in any of its lines"), (None, None)], ITEM_SCHEMA).write.parquet(f"{sf}/benchmark.parquet")
        before = docs
        for name, stage in corpus_pipeline.STAGES[1:-1]:  # the classifier may reject any of these few rows
            after = stage(spark, before, sf)
            assert after.columns == names and after.dtypes == docs.dtypes
            path = f"{sf}/{name}"
            after.write.parquet(path)
            before = spark.read.parquet(path)
        assert corpus_pipeline.STAGES[0][1](spark, docs, sf).columns == names
        kept = sorted((r.doc_id for r in before.collect()), key=repr)
        assert kept == ([0, 1, 4, None, None] if docs.count() else [])
        packed = corpus_pipeline.STAGES[-1][1](spark, before, sf).collect()
        assert {p.doc_id for p in packed} == set(kept)
        assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "piece", "bin_id", "slot", "start_token", "n_tokens", "source", "cluster"]
