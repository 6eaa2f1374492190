"""Ids of 64 bits stay what they are beside a missing one."""

import pytest

from hiremill.llm import language, line_dedup, minhash, packing, quality, segmentation, sharding, toxicity
from hiremill.llm.jaccard import jaccard_components
from tests.llm.helpers import words

BIG = 9_007_199_254_740_993
IDS = [None, BIG, BIG + 2, BIG + 4]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, words(300, 30 + 3 * at, at), "en", "s") for at, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


OPERATORS = {
    "encode": lambda docs: segmentation.encode_documents(docs),
    "decode": lambda docs: segmentation.decode_documents(segmentation.encode_documents(docs)),
    "sharding": lambda docs: sharding.shard_documents(docs, 4),
    "quality": lambda docs: docs.select("doc_id", quality.quality_column(None)("text").alias("score")),
    "lines": lambda docs: line_dedup.dedup_lines(docs),
    "packing": lambda docs: packing.pack_documents(docs),
    "toxicity": lambda docs: toxicity.score_toxicity(docs, None),
    "jaccard": lambda docs: jaccard_components(docs),
    "language": lambda docs: language.identify_language(docs, None),
    "minhash": lambda docs: minhash.minhash_components(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_are_kept(docs, name):
    rows = OPERATORS[name](docs).collect()
    assert {r.doc_id for r in rows} == set(IDS)
    if name in ("jaccard", "minhash"):
        assert {r.component_id for r in rows} == set(IDS)
