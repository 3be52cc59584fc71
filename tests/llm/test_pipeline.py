"""The stages on hand-made rows, and the entry points."""

from collections import Counter

import corpus_pipeline
from tests.llm.conftest import SCHEMA

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_columns_and_handle_odd_rows(spark, odd):
    docs = odd.select(DOCUMENT)
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, "")
        assert out.columns == DOCUMENT, name
        assert out.count() > 0
    pieces = corpus_pipeline.pack_windows(spark, docs, "")
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_on_nothing(spark, none):
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, none.select(DOCUMENT), "").count() == 0


def test_near_duplicates_leave_one_of_each_group(spark, odd):
    docs = odd.select(DOCUMENT)
    kept = stage("simhash near-dedup")(spark, docs, "")
    again = stage("simhash near-dedup")(spark, kept, "")
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, again.collect()))
    texts = Counter(r.text for r in kept.collect())
    assert max(texts.values()) == 1


def test_line_stage_changes_text_and_count(spark):
    body = "one line\ntwo lines\nthree lines"
    docs = spark.createDataFrame([(1, body, "en", "a", len(body)), (2, "own\n" + body, "en", "a", 0), (3, "x", "en", "a", None)], ", ".join(SCHEMA.split(", ")[:5]))
    got = {r.doc_id: (r.text, r.n_chars) for r in stage("line dedup")(spark, docs, "").collect()}
    assert got == {1: (body, len(body)), 2: ("own", 3), 3: ("x", None)}


def test_language_stage_drops_noise(spark):
    noise = "".join(chr(0x4E00 + i * 7 % 9000) for i in range(400))
    docs = spark.createDataFrame([(i, "the thing is of the other kind " * 5 + str(i), "en", "a", 1) for i in range(30)] + [(99, noise, None, None, 1), (100, None, "en", "a", 0)], ", ".join(SCHEMA.split(", ")[:5]))
    assert {r.doc_id for r in stage("language id")(spark, docs, "").collect()} == set(range(30))


def test_mixing_stage_repeats_documents(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "en", "ab"[i % 10 == 0], 20) for i in range(200)], ", ".join(SCHEMA.split(", ")[:5]))
    got = Counter(r.source for r in stage("mixing")(spark, docs, "").collect())
    assert max(got.values()) > 20 and sum(got.values()) > 0


def test_entry_points_hold_all_ten():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert "op3_line_dedup" in __spark_entry__.oracle_sql()


def test_line_dedup_equals_its_sql(spark):
    import __spark_entry__
    from tests.compare import connect, difference

    folder = "/root/testdata/sf0.001"
    found = __spark_entry__.queries()["op3_line_dedup"](spark, folder).toArrow()
    assert difference(found, connect(folder).sql(__spark_entry__.oracle_sql()["op3_line_dedup"]).to_arrow_table()) == ""
