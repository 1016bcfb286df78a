"""The pipeline's stages: columns, order, and that each decision takes effect."""

from collections import Counter

import corpus_pipeline
from tests.llm.cases import SMALL, small_docs
from tidemark.llm import decontaminate, minhash_dedup, mixing, toxicity


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]


def test_stages_one_by_one(spark, tmp_path):
    docs, ids = small_docs(spark), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < 4:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        ids[name] = Counter(r[0] for r in docs.select("doc_id").collect())
        was = {r[0] for r in before.select("doc_id").collect()}
        if name == "toxicity":
            scored = toxicity.classified(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert set(ids[name]) == {r[0] for r in scored.where("predicted = 0").select("doc_id").collect()}
        if name == "near_dedup":
            kept = minhash_dedup.near_duplicates(before).where("kept").select("doc_id").collect()
            assert set(ids[name]) == {r[0] for r in kept} and len(kept) < len(was)
        if name == "decontamination":
            hit = decontaminate.contaminated_words(before, spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("contaminated")
            assert set(ids[name]) == was - {r[0] for r in hit.select("doc_id").collect()}
        if name == "mixing":
            want = {r["doc_id"]: r["copies"] for r in mixing.mix(before).where("taken > 0").collect()}
            assert ids[name] == want
    assert ids["token_output"] == ids["mixing"] and set(docs.columns) == {"doc_id", "start", "n_tokens", "ids_crc32"}


def test_clashing_columns_pass_through(spark):
    names = ("score", "predicted", "held_out", "gone_id", "size", "copies", "mix_copies", "nth", "doc", "copy")
    docs = small_docs(spark).limit(60)
    for n in names:
        docs = docs.withColumn(n, docs["doc_id"] + 7)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert all(r[n] == r["doc_id"] + 7 for r in out.collect() for n in names)


def _docs(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def _left(spark, stage, docs):
    return sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, SMALL).collect()), key=str)


def test_clean_rows_without_id_stay(spark, tmp_path):
    docs = _docs(spark, tmp_path, [(None, "a few words of its own"), (None, "and another text entirely"), (None, None), (None, None), (3, "")])
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.drop_contaminated):
        assert stage(spark, docs, SMALL).count() == 5


def test_copies_with_null_and_repeated_ids_go(spark, tmp_path):
    text, other = "one and the same text of more than five words", "a text that shares its id with a copy of others"
    docs = _docs(spark, tmp_path, [(1, text), (1, text), (None, text), (None, text), (2, text), (2, other)])
    assert _left(spark, corpus_pipeline.drop_near_duplicates, docs) == [(1, text), (2, other)]
    nulls = _docs(spark, tmp_path / "n", [(None, text), (None, text), (None, other)])
    assert _left(spark, corpus_pipeline.drop_near_duplicates, nulls) == sorted([(None, text), (None, other)], key=str)


def test_contaminated_rows_go_and_no_others(spark, tmp_path):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    clean = "a clean text with words that no benchmark item has in a row at all"
    docs = _docs(spark, tmp_path, [(None, item), (None, f"x {item} y"), (5, item), (5, clean), (None, clean), (6, None)])
    assert _left(spark, corpus_pipeline.drop_contaminated, docs) == sorted([(5, clean), (None, clean), (6, None)], key=str)
