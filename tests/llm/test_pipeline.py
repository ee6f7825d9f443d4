import corpus_pipeline
from corpus_pipeline import STAGES, run


def test_stages_return_the_columns_of_documents(spark, odd_documents, clashing):
    for docs in (odd_documents, clashing(odd_documents)):
        for _, stage in STAGES[:-1]:
            kept = stage(spark, docs, "")
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()


def test_stages_take_effect(spark, odd_documents, odd_rows):
    effects = {
        name: {(r["doc_id"], r["text"]) for r in stage(spark, odd_documents, "").collect()}
        for name, stage in STAGES[:-1]
    }
    before = {(r[0], r[1]) for r in odd_rows}
    assert all(after != before for after in effects.values())
    assert {k for k, _ in effects["line dedup"]} == {k for k, _ in before}
    assert {k for k, _ in effects["substring dedup"]} == {k for k, _ in before}


def test_counts_follow_texts(spark, odd_documents):
    for place in (1, 3):
        kept = STAGES[place][1](spark, odd_documents, "").collect()
        assert all(
            r["n_chars"] == (None if r["text"] is None else len(r["text"]))
            for r in kept
        )


def test_run(spark, sf_dir, no_documents, tmp_path):
    pieces = run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(pieces.columns)
    assert pieces.count() > 5
    empty = str(tmp_path / "empty")
    no_documents.write.parquet(f"{empty}/documents.parquet")
    assert run(spark, empty).collect() == []
    assert corpus_pipeline.ORACLE_SQL is None
