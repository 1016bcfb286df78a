"""Every operator on nulls, empty and very long texts, repeated rows, clashing
columns and empty tables: no crash, a row for every row, the defined result."""

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, empty_docs, rows, spaced
from tidemark.llm import (decontaminate, language_id, lz_fingerprint, minhash_dedup, mixing, passages, pii, run_index,
                          token_files, toxicity)


def _labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def _items(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string, pos int, fp long")


OPERATORS = {
    "toxicity": lambda s, d: toxicity.classified(d, _labels(s, [(i, 0, i % 2) for i in range(1, 13)])),
    "passages": lambda s, d: passages.near_passages(d),
    "language_id": lambda s, d: language_id.predict(d, language_id.train(d)),
    "decontaminate": lambda s, d: decontaminate.contaminated_words(d, _items(s, [(1, "one two", 0, 0), (2, None, 0, 0), (None, "", 0, 0)])),
    "run_index": lambda s, d: run_index.without_repeats(d),
    "token_files": lambda s, d: token_files.token_files(d),
    "pii": lambda s, d: pii.personal_data(d),
    "lz_fingerprint": lambda s, d: lz_fingerprint.compared_with_next(d),
    "minhash_dedup": lambda s, d: minhash_dedup.near_duplicates(d),
    "mixing": lambda s, d: mixing.mix(d),
}


@pytest.fixture(scope="module")
def results(spark):
    return {name: f(spark, edge_docs(spark)).toPandas() for name, f in OPERATORS.items()}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(results, name):
    want = sorted(str(r[0]) for r in rows())
    got = results[name]["doc_id"]
    assert sorted("None" if x != x or x is None else str(int(x)) for x in got) == want


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, empty_docs(spark)).count() == 0


def _row(results, name, doc_id):
    df = results[name]
    return df[df["doc_id"] == doc_id].iloc[0]


def test_toxicity_of_empty_texts(results):
    assert _row(results, "toxicity", 1)["score"] == _row(results, "toxicity", 2)["score"]
    assert results["toxicity"]["score"].between(0, 1).all()


def test_passages_of_short_and_equal_texts(results):
    assert _row(results, "passages", 2)["spans"] == ""
    assert _row(results, "passages", 6)["spans"] == "0:30000" and _row(results, "passages", 7)["class_id"] == 6
    assert _row(results, "passages", 12)["spans"] == "0:80" and _row(results, "passages", 13)["spans"] == "40:120"


def test_language_without_letters(results):
    for doc_id in (1, 2, 3, 10):
        r = _row(results, "language_id", doc_id)
        assert r["lang_pred"] == "und" and r["score"] == 0
    assert _row(results, "language_id", 4)["lang_pred"] == "en"


def test_contamination_by_a_short_item(results):
    for doc_id in (4, 5):
        r = _row(results, "decontaminate", doc_id)
        assert r["n_hit"] == 2 and list(r["items"]) == ["1"] and r["contaminated"]
    assert _row(results, "decontaminate", 1)["n_words"] == 0 and not _row(results, "decontaminate", 8)["contaminated"]


def test_repeats_of_empty_and_repeated_rows(results):
    assert _row(results, "run_index", 1)["n_bytes"] == 0
    assert _row(results, "run_index", 6)["n_removed"] == _row(results, "run_index", 6)["n_bytes"]
    assert bytes(_row(results, "run_index", 11)["kept"]) == b"" and bytes(_row(results, "run_index", 9)["kept"]) == b""


def test_tokens_of_empty_texts(results):
    assert _row(results, "token_files", 1)["n_tokens"] == 1 == _row(results, "token_files", 2)["n_tokens"]


def test_no_personal_data_in_empty_text(results):
    assert _row(results, "pii", 1)["spans"] == "" == _row(results, "pii", 2)["spans"]


def test_fingerprints_of_equal_texts(results):
    a, b = _row(results, "lz_fingerprint", 6), _row(results, "lz_fingerprint", 7)
    assert a["fingerprint"] == b["fingerprint"] and b["near_next"] == 1.0
    assert _row(results, "lz_fingerprint", 1)["fingerprint"] == "ffff" * lz_fingerprint.HASHES


def test_components_of_empty_and_equal_sets(results):
    for doc_id in (1, 2, 3):
        r = _row(results, "minhash_dedup", doc_id)
        assert r["n_shingles"] == 0 and r["component_id"] == doc_id and r["kept"]
    assert _row(results, "minhash_dedup", 5)["component_id"] == 4 and _row(results, "minhash_dedup", 7)["component_id"] == 6
    df = results["minhash_dedup"]
    assert df[df["doc_id"].isna()]["component_id"].isna().all() and df[df["doc_id"].isna()]["kept"].all()


def test_mix_of_empty_texts(results):
    df = results["mixing"]
    assert (df["taken"] <= 3 * df["size"]).all() and _row(results, "mixing", 1)["taken"] == 0
    assert df["size"].sum() == sum(len(spaced(r[1])) for r in rows())


def test_one_row_table(spark):
    one = edge_docs(spark).where(F.col("doc_id") == 4)
    for name, f in OPERATORS.items():
        assert f(spark, one).count() == 1, name
