from collections import Counter

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from claimloom.llm import mixing, omh, packing, suffix, tokens, toxicity
from claimloom.session import table

DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = table(spark, DIR, "documents")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "mixing":
            copies = mixing.mixed(before, table(spark, DIR, "labels").select("doc_id", mixing.label_domains().alias("domain")))
            want = Counter({r.doc_id: r.n for r in copies.groupBy("doc_id").agg(F.sum("copies").alias("n")).collect() if r.n})
            assert Counter(r.doc_id for r in docs.collect()) == want and len(want) > 0.8 * before.count()  # most documents stay
        if name == "packing":
            plain = Tokenizer.from_file(tokens.default_file())
            ids = {r.doc_id: len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before.select("doc_id", "text").distinct().collect()}
            assert sum(r.length for r in docs.collect()) == sum(ids[r.doc_id] for r in before.collect())
        else:
            assert docs.columns == before.columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
        if name == "toxicity":
            model = toxicity.fit(before, table(spark, DIR, "labels"))
            want = {r.doc_id for r in toxicity.score(before, model).where("predicted = 0").collect()}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "minhash_near_dedup":
            rows = omh.near_duplicates(before).collect()
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in rows if r.kept} and docs.count() < before.count()
        if name == "suffix_array_dedup":
            gone = {r.doc_id for r in suffix.repeated_passages(before).where("not kept").collect()}
            was, now = ({r.doc_id: r.text for r in d.collect()} for d in (before, docs))
            assert gone and {d for d in was if was[d] != now[d]} == gone and all(len(now[d]) < len(was[d]) for d in gone)
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert docs.where(f"offset + length > {packing.CAPACITY}").isEmpty()
