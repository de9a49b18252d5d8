import public_tokenizers

import corpus_pipeline
from sparkloom.llm.editmatch import normalised

from odd_tables import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, odd_docs, no_docs, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [normalised(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        last, seen = seen, spark.read.parquet(path)
        if name != "encode":
            assert seen.columns == docs.columns
        ids = {r["doc_id"] for r in seen.select("doc_id").collect()}
        before = {r["doc_id"]: r["text"] for r in last.select("doc_id", "text").collect()}
        if name == "quality":
            good = {i for i, q in labels.items() if q == 1}
            assert len(good & ids) >= 0.97 * len(good) and len(ids & (set(labels) - good)) <= 0.2 * (len(labels) - len(good))
        if name == "decontaminate":
            assert ids == {i for i, t in before.items() if not any(x in normalised(t) for x in items)}
        if name == "pii":
            after = {r["doc_id"]: r for r in seen.collect()}
            changed = [i for i, t in before.items() if after[i]["text"] != t]
            assert ids == set(before) and changed and all("@mail" not in after[i]["text"] for i in ids)
            assert all(r["n_chars"] == len(r["text"]) for r in after.values() if before[r["doc_id"]] != r["text"])
        if name == "encode":
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            assert all(r["ids"] == library.encode(before[r["doc_id"]]) and r["round_trip"] for r in seen.collect())


def test_stages_on_odd_input(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, SF)
            if name != "encode":
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
