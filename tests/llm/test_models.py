"""Learned operators: held-out accuracy and the algorithms' own identities."""

import itertools

import numpy as np

from tests.llm.cases import words
from tidemark.llm import language_id, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_documents(spark):
    got = queries.op1_toxicity(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    bad, good = held[held["toxic"] == 1]["score"], held[held["toxic"] == 0]["score"]
    assert np.mean([b > g for b, g in itertools.product(bad, good)]) > 0.85
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()


def test_toxicity_sees_no_label_of_a_held_out_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", (toxicity.held_out().cast("int") + labels["toxic"]) % 2)
    a, b = (toxicity.classified(docs, x).select("doc_id", "score").toPandas().set_index("doc_id")["score"] for x in (labels, flipped))
    assert a.to_dict() == b.to_dict()


def test_toxicity_with_one_label_only(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity.classified(docs, labels).collect()] == [0, 0]


def test_language_on_held_out_documents(spark):
    got = queries.op3_language_id(spark, SF).toPandas().merge(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98 and got["score"].between(0, 1).all()


def test_forward_sums_all_segmentations():
    own = language_id.pieces(language_id.VOCABULARY)
    rng = np.random.default_rng(0)
    probs = rng.random((own.size, 2))
    probs[0] = 0
    probs /= probs.sum(axis=0)

    def brute(word):
        total = np.zeros(2)
        for mask in range(1 << (len(word) - 1)):
            cuts = [0, *(i + 1 for i in range(len(word) - 1) if mask >> i & 1), len(word)]
            value = np.ones(2)
            for a, b in itertools.pairwise(cuts):
                piece = own.ids.get(word[a:b], 0)
                value = value * (probs[piece] if piece else language_id.UNKNOWN if b == a + 1 else 0)
            total += value
        return np.log(total)

    some = ["▁the", "▁über", "▁qzxж", "▁ing", "▁a"]
    assert np.allclose([brute(w) for w in some], language_id.word_scores(some, probs, own))


def test_expected_counts_agree_with_the_forward_sum():
    """The derivative of a word's log score in a piece's log probability is its expected count."""
    own = language_id.pieces(language_id.VOCABULARY)
    probs = np.full((own.size, 1), 1.0 / own.size)
    probs[0] = 0
    word = "▁there"
    counts = language_id._expected([word], np.ones((1, 1)), probs, own)[:, 0]
    for piece in ("▁the", "re", "▁there"):
        i = own.ids[piece]
        near = probs.copy()
        near[i] *= 1.0001
        change = language_id.word_scores([word], near, own) - language_id.word_scores([word], probs, own)
        assert abs(change[0, 0] / np.log(1.0001) - counts[i]) < 1e-3


def test_words_of_a_run():
    assert language_id.words_of("Don't2go") == ["▁don", "▁t", "▁go"] and language_id.words_of("12.5") == []
    assert [len(w) for w in language_id.words_of("a" * 150)] == [65, 65, 23]


def test_grams_do_not_cross_texts():
    both = np.frombuffer(b"abcdefg", np.uint8)
    split = {int(s) for slots, _ in toxicity.gram_slots(both, np.array([0, 4, 7])) for s in slots}
    apart = {int(s) for part in (b"abcd", b"efg") for slots, _ in toxicity.gram_slots(np.frombuffer(part, np.uint8), np.array([0, len(part)])) for s in slots}
    assert split == apart and len(words(3)) == 3
