import __spark_entry__ as entry
import corpus_pipeline


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [x for x, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mix_sources", "byte_bpe"]
    from indicata.session import scratch_path
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_small).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
    assert before > counts[0] == counts[1] >= counts[2] and counts[3] == counts[4] > 0
    assert docs.where("NOT round_trip OR size(ids) <> n_tokens").count() == 0


def test_stages_on_no_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, sf_small).count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert all(sum(x.startswith(f"op{n}_") for x in names) == 1 for n in range(1, 11)) and "pipeline" in names
    assert "op1_exact_top_k" in entry.oracle_sql() and "op6_mix_sources" in entry.oracle_sql()
