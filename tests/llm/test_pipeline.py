"""Each stage on its own input, and the whole run."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from patrona.llm import byte_bpe
from patrona.llm.minhash_forest import near_duplicates
from patrona.llm.mixing import mix_sources

from .conftest import LONG, SF_DIR


def test_stages_keep_columns_and_run(spark, some_docs):
    docs, columns = some_docs, some_docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns, name
        sizes.append(docs.count())
        if name == "near_dedup":
            kept = near_duplicates(before, shingle_words=4).where("kept").select("doc_id")
            assert sorted(docs.select("doc_id").collect()) == sorted(kept.collect())
        if name == "secret_scan":
            assert docs.where(F.col("text").rlike("AKIA[A-Z0-9]{16}")).count() == 0
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "source_mix":
            assert sizes[-1] == mix_sources(before).agg(F.sum("copies")).first()[0]
    assert sizes[0] >= sizes[1] > sizes[2] == sizes[3]
    want = byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                     public_tokenizers.PATTERN)
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_edge_rows_pass_every_stage(spark, edge_docs, no_docs):
    """Nulls, ties, repeated and very long rows: what each stage keeps of them, by id."""
    def ids(docs):
        return sorted((r["doc_id"] for r in docs.select("doc_id").collect()), key=lambda i: (i is None, i or 0))
    stages = dict(corpus_pipeline.STAGES)
    every = ids(edge_docs)
    no_letter = {1, 2, 3, 13}
    assert set(ids(stages["language_id"](spark, edge_docs, SF_DIR))) <= set(every) - no_letter
    # 6 is a copy of 5 and 8 a near copy of 7; the repeated row of 11 is no copy of another document; null ids stay.
    assert ids(stages["near_dedup"](spark, edge_docs, SF_DIR)) == [i for i in every if i not in (6, 8)]
    clean = stages["secret_scan"](spark, edge_docs, SF_DIR)
    assert ids(clean) == every and clean.where("doc_id = 9").first()["n_chars"] == len(LONG)
    mixed = ids(stages["source_mix"](spark, edge_docs, SF_DIR))
    assert set(mixed) <= set(every) - {1, 2, 3} and max(mixed.count(i) for i in mixed if i) <= 6
    assert ids(stages["byte_bpe"](spark, edge_docs, SF_DIR)) == every
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_DIR).count() == 0, name
