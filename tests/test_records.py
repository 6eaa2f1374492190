import json

import pytest

from hiremill.sources.files import parse_records

GOOD = {"source_id": "1", "job_title": "t", "company": "c", "description": "d"}
TEXT = json.dumps(GOOD)


@pytest.mark.parametrize(
    "text, error",
    [
        (TEXT, None),
        (f" \n{TEXT}\n", None),
        (json.dumps(GOOD | {"company": None}), None),
        (json.dumps(GOOD | {"company": "{not nested"}), None),
        (f"{TEXT} garbage", "not a JSON object"),
        (TEXT + TEXT, "not a JSON object"),
        (f"{TEXT},{TEXT}", "not a JSON object"),
        (f"{TEXT}]", "not a JSON object"),
        (f"{TEXT}}}", "not a JSON object"),
        (TEXT.replace('"t"', '"\t"'), "not a JSON object"),
        ("[1]", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "not a JSON object"),
        (json.dumps({k: v for k, v in GOOD.items() if k != "company"}), "missing company"),
        (json.dumps(GOOD | {"description": {"a": 1}}), "nested description"),
        (json.dumps(GOOD | {"job_title": [1]}), "nested job_title"),
    ],
)
def test_a_record_is_one_whole_flat_object(spark, text, error):
    row = parse_records(spark.createDataFrame([("k", text)], "doc_key string, value string")).first()
    assert row.load_error == error
    assert (row.source_id == "1") == (error is None)
