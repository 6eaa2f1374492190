import corpus_pipeline as pipeline
from hiremill.session import materialize
from tests.llm.helpers import EDGES, words
from tests.llm.test_jaccard import brute as jaccard_brute
from tests.llm.test_line_dedup import brute as lines_brute

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), f"test-{name}")
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS and docs.schema["n_chars"].dataType.simpleString() == "bigint"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in kept["language_id"])
    assert before == after  # all have a language
    before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in kept["quality"])
    assert all(d in after for d in before if labels.get(d) == 1) and sum(labels.get(d) == 0 for d in before - after) > 0
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in kept["line_dedup"])
    assert after == {d: t for d, t in lines_brute(list(before.items())).items() if t and t.strip(" \t\r\n")}
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in kept["near_duplicates"])
    assert set(after) == {d for d, (_, c) in jaccard_brute(list(before.items())).items() if d == c}
    before, pieces = kept["packing"]
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_edges(spark):
    docs = spark.createDataFrame([(d, t, "en", None, None, "x") for d, t in EDGES], "doc_id long, text string, lang string, source string, n_chars long, found string")
    for _, stage in pipeline.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.filter("false"), SF).count() == 0


def test_near_duplicates_keep_one_of_a_repeated_row(spark):
    docs = spark.createDataFrame([(d, t, "en", None, None) for d, t in EDGES], "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in pipeline.near_duplicates(spark, docs, SF).collect()]
    assert sorted(got) == [900, 901, 902, 903, 904, 905, 906]


def test_near_duplicates_keep_every_class_whatever_the_ids(spark):
    a, b, c, d, e = (words(10_000, 60, i) for i in range(5))
    rows = [
        (None, a), (None, b), (None, b), (None, None), (None, ""),  # missing ids: two texts, one of them twice
        (1, c), (7, c + " more"), (7, d), (7, d.upper()),  # a repeated id: near another row, and a class of its own
        (None, e), (9, e + " more"),  # an id goes before none
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.text and r.text.lower()) for r in pipeline.near_duplicates(spark, docs.repartition(5), SF).collect()}
    assert got == {(None, a), (None, b), (None, None), (None, ""), (1, c), (7, d), (9, e + " more")}
    assert pipeline.near_duplicates(spark, docs.repartition(5), SF).count() == len(got)
