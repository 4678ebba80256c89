import random
import zlib

import numpy as np
import pytest

from claimloom.llm import packing, tokens


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    words = ["the", "Üben", "x's", "12", "foo-bar", "naïve", "日本", "\n\n", "  "]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 40, 300, 900])))) for i in range(150)]
    return rows + [(500, None), (501, ""), (3, rows[3][1]), (None, "null id"), (502, "<|endoftext|>")]


def test_every_id_lies_in_one_piece(spark, corpus):
    docs = spark.createDataFrame([(d, t, 0) for d, t in corpus], "doc_id long, text string, offset int")
    out = packing.pack(docs).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_file())
    want = {}
    for d, t in corpus:
        want.setdefault((d, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (0,)), []).append(1)
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    for (d, ids), copies in want.items():
        pieces = sorted(by_doc[d], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids) * len(copies)
        for r in pieces:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_whatever_the_parallelism_when_rows_are_read(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(6)
    out = packing.pack(docs)
    total = sum(r.length for r in out.collect())
    keys = ["spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for values in (("1", "1g", "1"), ("3", "2k", "40")):
            for k, v in zip(keys, values):
                spark.conf.set(k, v)
            rows = out.select("*").collect()
            assert sum(r.length for r in rows) == total and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_linear_program_fills_sequences():
    rng = np.random.default_rng(1)
    counts = np.zeros(257, dtype=np.int64)
    np.add.at(counts, rng.integers(1, 256, 40_000), 1)
    patterns, uses = packing.solve_patterns(counts, 256)
    assert ((patterns @ np.arange(256)) == 256).all()
    assert ((uses @ patterns) <= counts[:256]).all()
    assert (uses @ patterns @ np.arange(256)) > 0.97 * (counts * np.arange(257)).sum()


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ids_equal_the_tokenizer(spark):
    import pyarrow as pa

    rng = random.Random(1)
    parts = ["'s", "'", "ll", "'re", " ", "  ", "\n", "\t", "a", "Bc", "é", "1", "23", "!", "$$", "\r\n", "½", "\x1c", "\x85", "_", "t"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(5000)] + ["", None, "a — b", "<|endoftext|>x"]
    source = tokens.TokenIds(tokens.default_file())
    want = [e.ids for e in source.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = []
    for lo, hi, ids, at in source.ids(pa.array(texts)):
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(hi - lo)]
    assert got == want


def test_a_worker_gives_memory_back_after_each_batch(monkeypatch):
    import pyarrow as pa

    given = []

    class Pool:
        def release_unused(self):
            given.append(1)

    class Arrow:
        default_memory_pool = Pool

        def __getattr__(self, name):
            return getattr(pa, name)

    monkeypatch.setattr(packing, "pa", Arrow())
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", "three"])], names=["doc_id", "text"])
    out = list(packing._pieces(tokens.default_file(), 8, 0)(iter([rows, rows])))
    assert len(given) == 2 and sum(b.num_rows for b in out) == 4
    source = tokens.worker(tokens.default_file())
    assert source.keys.nbytes + source.entry.nbytes <= 26 << 20 and len(source.keys) >= 2 * tokens._MOST
