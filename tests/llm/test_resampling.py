import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from claimloom.llm import resampling as R

ROWS = [
    (1, "The cat, the Cat and THE dog! " * 8),
    (2, "ÄÖ äö İstanbul ſtraße 12 a_b c-d " * 5),
    (3, ""),
    (4, None),
    (5, "one two three"),
    (6, "word " * 5000),
    (6, "word " * 5000),
    (None, "a line without any id " * 6),
    (8, "\x00\x1f\x7f~{|}^_`@[]\\"),
    (9, "tie " * 20),
] + [(100 + i, " ".join(f"w{(i * j) % 37}" for j in range(1, 15 + i % 30))) for i in range(150)]
TARGET = [(1, "the dog and the w3 w5"), (2, None), (3, "w3 w3 w3 Ärger")]


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest, buckets, least, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, longest)[1])
    t = Counter(bucket(f) for _, x in target for f in features(x, longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        n, fs = features(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(f)] for f in fs)
        out.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for k, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_equals_a_plain_loop_and_sql(spark, monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 20)
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t in ROWS], "doc_id long, text string, weight double, rank string").repartition(5)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = sorted((tuple(r) for r in R.resample(docs, target, percent=30).collect()), key=str)
    assert got == brute(ROWS, TARGET, 1, R.BUCKETS, 20, 30)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 1 + sum(r[4] is not None for r in got)))
    con = duckdb.connect()
    for name, rows in (("documents", ROWS), ("benchmark", TARGET)):
        con.execute(f"create table {name}({'doc_id' if name == 'documents' else 'item_id'} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", rows)
    assert sorted((tuple(r) for r in R.resample(docs, target).collect()), key=str) == sorted(con.execute(R.ORACLE).fetchall(), key=str)


def test_longer_runs_and_dropped_tries(spark):
    docs, target = spark.createDataFrame(ROWS, "doc_id long, text string"), spark.createDataFrame(TARGET, "item_id long, text string")
    for longest in (2, 4):
        got = sorted((tuple(r) for r in R.resample(docs, target, longest=longest, buckets=97, percent=50).collect()), key=str)
        assert got == brute(ROWS, TARGET, longest, 97, 20, 50)
    small = R.bucket_totals(docs, 3, 97, nodes=3)
    assert (small == R.bucket_totals(docs, 3, 97)).all()
    gains = np.arange(97) - 50
    assert sorted(map(str, R.weigh(docs, gains, 3, nodes=3).collect())) == sorted(map(str, R.weigh(docs, gains, 3).collect()))


def test_blocks_of_a_long_text():
    text = "ab c déf ".encode() * 50
    whole = next(R.word_blocks(text))
    assert [w for block in R.word_blocks(text, 7) for w in block] == whole and len(list(R.word_blocks(text, 7))) > 20
    for longest in (1, 2, 3, 5):
        whole_trie, block_trie = R.Trie(longest), R.Trie(longest, block=1)
        ((n, at_once),) = whole_trie.runs(text)
        parts = list(block_trie.runs(text))
        assert sum(new for new, _ in parts) == n == 150 and len(parts) > 20
        assert Counter(block_trie.crc[x] for _, found in parts for x in found) == Counter(whole_trie.crc[x] for x in at_once)


def test_no_rows(spark):
    none, target = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(TARGET, "item_id long, text string")
    assert R.resample(none, target).count() == 0
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted((tuple(r) for r in R.resample(docs, none).collect()), key=str)
    assert got == brute(ROWS, [], 1, R.BUCKETS, 20, 10)
