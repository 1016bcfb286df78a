"""Token counts against the library on whole texts."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import edge_docs, empty_docs, rows, small_docs
from tidemark.llm import flat
from tidemark.llm import token_counts as tc

ODD = [None, "", " ", "\n", "\n\n a", "a▁ b", " ▁ x", "<s></s><unk><0x0A>", "ab,cd ;\r\n\r", "».", "…] (“é”", "日本 語\t語", "a b　c",
       "\U0001F600 \U0001D7D8", "\0", "  two  spaces  "]


def _table(own, tokens):
    return tc.Table(tokens, own.encode(tokens) if tokens else np.zeros(0))


def _counted(texts, table):
    own = tc.pieces(tc.VOCABULARY)
    out = [tc._counted(own, table, d, o) for _, _, d, o in flat.text_slices(tc._spaced(pa.array(texts, pa.string())))]
    return np.concatenate(out).tolist() if out else []


def _whole(texts):
    return [tc.pieces(tc.VOCABULARY).whole(t or "") for t in texts]


def test_the_vocabulary_allows_the_cuts():
    assert tc.pieces(tc.VOCABULARY).cuttable


@pytest.mark.parametrize("chunk", [1 << 20, 64, 5])
def test_odd_texts_in_blocks_of_any_size(monkeypatch, chunk):
    monkeypatch.setattr(flat, "CHUNK_BYTES", chunk)
    own = tc.pieces(tc.VOCABULARY)
    for known in ([], [b" a", b" ", b" two", b",", b" x", b"ab"]):
        assert _counted(ODD * 3, _table(own, known)) == _whole(ODD * 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab é\n ▁.,;\"0日\t\r»…")) | st.characters(exclude_categories=["Cs"]), max_size=40)))
def test_any_texts(texts):
    own = tc.pieces(tc.VOCABULARY)
    assert _counted(texts, _table(own, [b" a", b"a", b".", b" b", b"  "])) == _whole(texts)


def test_equal_hashes_of_other_bytes_are_no_hits():
    own = tc.pieces(tc.VOCABULARY)
    table = _table(own, [b" one", b" two"])
    data = np.frombuffer(b" abc", np.uint8)
    forged = table.hashes[:1]  # the hash of " one" for other bytes
    assert table.find(data, forged, np.array([0]), np.array([4])).tolist() == [-1]


def test_long_runs():
    for t in (" " * 200_000, "x" * 200_000, "\n" * 100_000, "ab " * 100_000, "日" * 50_000):
        assert _counted([t], _table(tc.pieces(tc.VOCABULARY), [])) == _whole([t])


def test_the_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tc, "KEPT", 2)
    texts = [f"word{i} and number{i}" for i in range(50)]
    assert _counted(texts, _table(tc.pieces(tc.VOCABULARY), [])) == _whole(texts)


@pytest.mark.parametrize("sample", [tc.SAMPLE_BYTES, 20_000])
def test_whole_table_whatever_the_sample(spark, monkeypatch, sample):
    monkeypatch.setattr(tc, "SAMPLE_BYTES", sample)
    docs = small_docs(spark)
    got = {r["doc_id"]: r for r in tc.token_counts(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        n = tc.pieces(tc.VOCABULARY).whole(t)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len(t.encode()), n > 4096)


def test_edge_rows(spark):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_bytes"]) for r in tc.token_counts(edge_docs(spark)).collect())
    assert got == sorted((str(r[0]), _whole([r[1]])[0], len((r[1] or "").encode())) for r in rows())
    assert tc.token_counts(empty_docs(spark)).count() == 0


def test_a_vocabulary_whose_pieces_span_cuts(spark, monkeypatch):
    own = tc.pieces(tc.VOCABULARY)
    monkeypatch.setattr(own, "cuttable", False)
    assert tc.frequent(small_docs(spark)).lengths.tolist() == []
