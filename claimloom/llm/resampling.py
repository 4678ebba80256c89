"""Importance resampling towards a target corpus, with hashed word features counted in partition-local tries.

A feature is a run of 1 to `longest` words. Each partition keeps a trie of the words it has met: a node is a run; it
holds its count so far and its CRC-32 state, from which a child goes on without hashing its parent's words again. A
trie is turned into totals a bucket and dropped when it has too many nodes, so memory is bounded however many runs
there are. Spark sums the totals of all partitions: `buckets` numbers a corpus, which is all the driver sees. They
give every bucket a gain, the logarithm of the ratio of the smoothed shares. A second pass walks tries whose nodes
carry their gains and sums them for each document.

Documents are drawn without replacement by the highest sums of weight and Gumbel noise from a hash of the id. The
order is made by range partitions and the numbers of rows in those before, never in one task.

A null text holds no feature. A null id is hashed as an empty one and comes first among ties. Repeated rows are drawn
one by one. An empty table gives no row; an empty target gives gains from the smoothing alone. Texts of any length are
read in blocks. Other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
#: Nodes of a trie before it is dropped, bytes of a text that are read at once, rows of a range partition.
NODES, BLOCK, PART_ROWS = 1 << 19, 1 << 20, 200_000

#: A-Z lower-cased; what is neither letter, digit nor beyond ASCII parts words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def word_blocks(text: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    flat, at = text.translate(_TABLE), 0
    while at < len(flat):
        end = flat.find(b" ", at + block)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


class Trie:
    """Runs of words met so far, with their CRC states, counts and gains."""

    def __init__(self, longest: int, gains: np.ndarray | None = None, buckets: int = BUCKETS, block: int = BLOCK):
        self.longest, self.gains, self.buckets, self.block = longest, gains, buckets, block
        self.clear()

    def clear(self) -> None:
        self.crc: list[int] = []
        self.gain: list[int] = []
        self.counts = np.zeros(1024, dtype=np.int64)
        self.first, self.deeper = _Heads(self), _Children(self)

    def add(self, crc: int) -> int:
        self.crc.append(crc)
        if self.gains is not None:
            self.gain.append(int(self.gains[crc % self.buckets]))
        return len(self.crc) - 1

    def walk(self, words: list[bytes], carried: int = 0) -> Iterator[list[int]]:
        """The nodes of the runs of 1, 2, ... words; runs that end within the first `carried` words are left out."""
        nodes = [self.first[w] for w in words]
        yield nodes[carried:]
        for d in range(1, self.longest):
            nodes = [self.deeper[k] for k in zip(nodes, words[d:])]
            yield nodes[max(carried - d, 0) :]

    def runs(self, text: bytes) -> Iterator[tuple[int, list[int]]]:
        """For every block: how many new words it has, and the nodes of all runs that end in it."""
        tail: list[bytes] = []
        for words in word_blocks(text, self.block):
            both = tail + words
            yield len(words), [n for nodes in self.walk(both, len(tail)) for n in nodes]
            tail = both[max(len(both) - self.longest + 1, 0) :] if self.longest > 1 else []

    def count(self, nodes: list[int]) -> None:
        if len(self.crc) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(len(self.crc), dtype=np.int64)])
        if nodes:
            found = np.bincount(nodes)
            self.counts[: len(found)] += found

    def totals(self) -> np.ndarray:
        """The counts of the nodes, by bucket."""
        out = np.zeros(self.buckets, dtype=np.int64)
        if self.crc:
            np.add.at(out, np.array(self.crc, dtype=np.int64) % self.buckets, self.counts[: len(self.crc)])
        return out


class _Heads(dict):
    """word -> node at the root."""

    def __init__(self, trie: Trie):
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        self[word] = node = self.trie.add(zlib.crc32(word))
        return node


class _Children(dict):
    """(node, next word) -> node; the parent's CRC state goes on over a space and the word."""

    def __init__(self, trie: Trie):
        self.trie = trie

    def __missing__(self, key: tuple[int, bytes]) -> int:
        self[key] = node = self.trie.add(zlib.crc32(key[1], zlib.crc32(b" ", self.trie.crc[key[0]])))
        return node


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    values = batch.column(column).cast(pa.binary())
    for i in range(len(values)):
        yield values[i].as_py() or b""


def bucket_totals(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, nodes: int = NODES) -> np.ndarray:
    """Features of all texts (column text) by bucket: a row a bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total = Trie(longest, buckets=buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in _texts(batch, 0):
                for _, found in trie.runs(text):
                    trie.count(found)
                if len(trie.crc) > nodes:
                    total += trie.totals()
                    trie.clear()
        total += trie.totals()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much larger a bucket's smoothed share is in the target."""
    n, s, t = len(source), source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, nodes: int = NODES) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(longest, gains, len(gains))
        for batch in batches:
            rows = []
            for text in _texts(batch, 1):
                words = features = weight = 0
                for new, found in trie.runs(text):
                    words, features = words + new, features + len(found)
                    weight += sum(map(trie.gain.__getitem__, found))
                rows.append((words, features, weight))
                if len(trie.crc) > nodes:
                    trie.clear()
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandths of Gumbel noise, from the first 32 bits of the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def with_rank(rows: DataFrame, order: list[Column], count: int) -> DataFrame:
    """rows with their place from 1 in the whole order: range partitions, sorted, after the rows of those before."""
    parts = max(1, math.ceil(count / PART_ROWS))
    near = cut(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = near.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # A row a partition.
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return near.withColumn("_part", part).join(before, "_part").withColumn("rank", place + F.col("_before") + 1).drop("_part", "_at", "_before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS, seed: str = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of docs; rank is null where the row is not drawn.

    docs: doc_id, text; target: text. Of the rows with at least `least_words` words, `percent` in a hundred are drawn.
    """
    gains = bucket_gains(bucket_totals(docs, longest, buckets), bucket_totals(target, longest, buckets))
    scored = weigh(docs, gains, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = cut(scored)
    count = scored.where(F.col("n_words") >= least_words).count()
    ranked = with_rank(scored.where(F.col("n_words") >= least_words), [F.desc("score"), F.asc_nulls_first("doc_id")], count)
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= percent * count // 100, F.col("rank")))
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    final = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(*final).union(short.select(*final))


#: CRC-32 by half bytes over the hexadecimal digits of each different word.
_CRC = """
half AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 1, 2, 3, 4], lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(16)) AS i))),
vocabulary AS (SELECT DISTINCT f FROM (SELECT f FROM source_words UNION ALL SELECT f FROM target_words)),
digits AS (SELECT f, hex(encode(f)) AS h FROM vocabulary),
buckets AS (SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, len(h) + 1), lambda p: ascii(substr(h, CASE WHEN p % 2 = 1 THEN p + 1 ELSE p - 1 END, 1))::BIGINT),
  lambda c, x: xor(c >> 4, t[(xor(c, x - CASE WHEN x > 57 THEN 55 ELSE 48 END) & 15) + 1])), 4294967295) % {BUCKETS} AS bucket FROM digits, half)"""

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
source_words AS (SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS f FROM d),
target_words AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS f FROM benchmark),
{_CRC.replace("{BUCKETS}", str(BUCKETS))},
s AS (SELECT bucket, count(*) AS s FROM source_words JOIN buckets USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM source_words) AS s_all, (SELECT count(*) FROM target_words) AS t_all),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {BUCKETS}) / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain FROM s FULL JOIN t USING (bucket), totals),
weights AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS weight FROM source_words JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || left(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN weights USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER (PARTITION BY n_features >= {LEAST_WORDS}) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND place <= {PERCENT} * n // 100 THEN place END::BIGINT AS rank FROM ranked
"""
