"""The corpus pipeline stage by stage, and the registered queries against their SQL."""

import pytest
from tests.checking import connect, differences
from tests.llm.odd import odd_documents
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_rules import plain

import __spark_entry__ as entry
import corpus_pipeline
from acctrisk.llm import queries
from acctrisk.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "language", "near duplicates", "packing"]


def test_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    first, second, third, last = (f for _, f in corpus_pipeline.STAGES)
    ruled = first(spark, docs, SF_DIR).cache()
    kept = {r.doc_id for r in ruled.collect()}
    assert ruled.columns == docs.columns and 0 < len(kept) < len(texts)
    for i, text in texts.items():
        n, _, _, _, repeats = plain(text)
        if n < 10 or 100 * repeats > 20 * n:
            assert i not in kept
        elif labels.get(i) == 1:
            assert i in kept
    spoken = second(spark, ruled, SF_DIR).cache()
    assert {r.doc_id for r in spoken.collect()} == kept  # all are in a known language
    single = third(spark, spoken, SF_DIR).cache()
    want = {c for _, _, c in groups([(i, texts[i]) for i in sorted(kept)])}
    assert {r.doc_id for r in single.collect()} == want and single.count() == len(want)
    assert single.columns == docs.columns
    whole = sorted(map(tuple, last(spark, single, SF_DIR).collect()))
    assert {r[0] for r in whole} == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == whole


def test_odd_rows_pass_every_stage(spark, frame):
    docs = odd_documents(frame)
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        assert kept.count() <= docs.count()
    assert corpus_pipeline.STAGES[3][1](spark, docs, SF_DIR).count() >= docs.count()


def test_empty_documents_pass_every_stage(spark, frame):
    docs = odd_documents(frame).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    mine = queries.QUERIES[name](spark, "/root/testdata/sf0.01").toArrow()
    con = connect("/root/testdata/sf0.01")
    assert differences(mine, con.sql(queries.ORACLE_SQL[name]).to_arrow_table()) == ""


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_near_duplicates_lose_no_text_with_null_or_equal_ids(spark, frame):
    def words(name, change=None):
        return " ".join(f"{name}{i}" if i != change else "changed" for i in range(100))

    rows = [(None, words("a")), (None, words("b")), (None, words("b", 50)), (None, words("c")),
            (7, words("c", 99)), (1, words("d")), (1, words("e")), (1, words("e")),
            (2, words("f")), (3, words("f", 99)), (3, words("g")), (4, ""), (4, ""), (4, " "),
            (4, None), (None, ""), (None, None)]
    docs = frame("doc_id long, text string, lang string", *[(*r, "x") for r in rows])
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    for one in (words("b"), words("b", 50)):
        want = [(None, words("a")), (None, one), (7, words("c", 99)), (1, words("d")),
                (1, words("e")), (2, words("f")), (3, words("g")), (4, ""), (4, " "), (4, None),
                (None, ""), (None, None)]
        if got == sorted(want, key=repr):
            return
    raise AssertionError(got)
