import pytest

from propensity.llm import pii_boost as I

FORMATS = ("(269) 555-3296", "(269)555-3296", "269-555-3296", "269.555.3296")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(k, f"Reach us: +1 (3{k % 90 + 10}) 555-{1000 + k} or by mail a{k}@b.example. Visa 411111111111111{k % 10}.")
            for k in range(200)]
    rows += [(1000 + k, f"Please call {p} today.") for k, p in enumerate(FORMATS)]
    rows += [(2000, "Part A-269-555-3296-17 and order 11/269-555-3296 are in stock."), (2001, "Dial +1 (269) 555-3296 10.1.2.3 now.")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_numbers_without_prefix_are_found_beside_those_with_one(mixed):
    got = {r["doc_id"]: r["text"] for r in I.redacted(mixed).where("doc_id >= 1000").collect()}
    assert [got[1000 + k] for k in range(len(FORMATS))] == ["Please call [PHONE] today."] * len(FORMATS)
    assert got[2000] == "Part A-269-555-3296-17 and order 11/269-555-3296 are in stock."
    assert got[2001] == "Dial [PHONE] [IP] now."


def test_a_part_of_a_base_phone_is_no_counter_example(mixed):
    spans = I.related(I.candidates(mixed)).where("start is not null and kind = 'phone' and doc_id < 1000").collect()
    assert len(spans) >= 200
    assert all(s["base"] == 1 or s["nested"] for s in spans)
