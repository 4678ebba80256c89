"""Merkle manifest of a table: a tree a group, a tree over the groups, and a proof for every row.

Leaves are digests of whole rows, made by Spark; from there on only (group, order, digest) move. They become a
range-sorted RDD, kept by a reliable checkpoint, so its partitions stay as they are whoever is lost. A group that
runs over several partitions gets its offset in each from the numbers of rows in those before: only the first and
the last group of a partition can, so two numbers a partition are all the driver sees.

With the offsets each partition builds every subtree whose leaves it holds. What it cannot finish are ragged nodes,
a few a level at either end. They are shuffled by the coordinate (group, index) of an ancestor some levels higher,
where they meet and build on; each such hop multiplies the covered leaves by FAN, so a group of nodes is bounded by
the partitions below one ancestor, and two or three hops reach the top of any tree. The roots of the groups are the
leaves of one more tree, made the same way. On the way back the siblings met in the hops are joined to the ragged
nodes, brought to their partitions, and each partition returns its rows' proofs.

A run of `arity` nodes becomes the digest of their hexadecimal digests in a row; the last run of a level may be shorter.
Rows of one group with the same order value are put in the order of their digests. Null groups and order values come
first. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.session import checkpoint_dir, cut

ARITY = 2
#: Rows of a range partition; how many times as many leaves a hop's ancestor covers.
PART_ROWS, FAN = 50_000, 1024
PATH = "array<struct<left: string, right: string>>"
Step = tuple[str, str]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(leaves: int, arity: int) -> int:
    """Levels above the leaves."""
    up = 0
    while leaves > 1:
        leaves, up = -(-leaves // arity), up + 1
    return up


def width(leaves: int, level: int, arity: int) -> int:
    """Nodes at a level."""
    return -(-leaves // arity**level)


class Built(NamedTuple):
    """Nodes by (level, index), and of these the ones whose parent could not be built."""

    nodes: dict[tuple[int, int], str]
    tops: list[tuple[int, int]]


def build(given: dict[tuple[int, int], str], leaves: int, arity: int, until: int) -> Built:
    """All nodes up to level `until` that follow from the given ones in a tree over so many leaves."""
    nodes, tops = dict(given), []
    by_level: dict[int, set[int]] = {}
    for level, i in given:
        by_level.setdefault(level, set()).add(i)
    for level in range(min(by_level, default=0), until + 1):
        here, size = by_level.get(level, set()), width(leaves, level, arity)
        if level == until or size == 1:
            tops += [(level, i) for i in here]
            continue
        for parent in {i // arity for i in here}:
            run = range(parent * arity, min(parent * arity + arity, size))
            if all(i in here for i in run):
                nodes[level + 1, parent] = digest(*[nodes[level, i] for i in run])
                by_level.setdefault(level + 1, set()).add(parent)
            else:
                tops += [(level, i) for i in run if i in here]
    return Built(nodes, tops)


def climb(nodes: dict[tuple[int, int], str], level: int, i: int, stop: dict | set, leaves: int, arity: int) -> tuple[list[Step], tuple[int, int]]:
    """Siblings left and right of each node on the way from (level, i) to the first that `stop` holds."""
    path = []
    while (level, i) not in stop:
        first, end = i // arity * arity, min(i // arity * arity + arity, width(leaves, level, arity))
        path.append(("".join(nodes[level, j] for j in range(first, i)), "".join(nodes[level, j] for j in range(i + 1, end))))
        level, i = level + 1, i // arity
    return path, (level, i)


def leaf_digest(*columns: str) -> Column:
    """The digest of a row: each column as `-` if null, else the number of its UTF-8 bytes, a colon and the bytes."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


class Extent(NamedTuple):
    """A group's part of a partition: place of its first row here, rows here, rows in all."""

    offset: int
    here: int
    leaves: int


def _runs(rows: Iterable) -> Iterator[tuple[str | None, list]]:
    """Rows that stand sorted by group, a list a group."""
    group, found = None, []
    for r in rows:
        if found and r[0] != group:
            yield group, found
            found = []
        group = r[0]
        found.append(r)
    if found:
        yield group, found


def _edges(pid: int, rows: Iterable) -> Iterator[tuple[int, list[tuple[str | None, int]]]]:
    """Rows of the first and the last group of a partition."""
    counts: list[tuple[str | None, int]] = []
    for r in rows:
        if counts and counts[-1][0] == r[0]:
            counts[-1] = (r[0], counts[-1][1] + 1)
        else:
            counts = [*counts[:1], (r[0], 1)]
    if counts:
        yield pid, counts


def extents(edges: list[tuple[int, list[tuple[str | None, int]]]]) -> dict[int, dict[str | None, Extent]]:
    """Offsets and totals of the groups at the edges of partitions."""
    total: dict[str | None, int] = {}
    before: dict[tuple[int, str | None], int] = {}
    for pid, counts in sorted(edges, key=lambda e: e[0]):
        for group, n in counts:
            before[pid, group] = total.get(group, 0)
            total[group] = total.get(group, 0) + n
    return {pid: {group: Extent(before[pid, group], n, total[group]) for group, n in counts} for pid, counts in edges}


def _local(own: dict[str | None, Extent], group: str | None, rows: list, arity: int) -> tuple[Extent, Built]:
    e = own.get(group) or Extent(0, len(rows), len(rows))
    leaves = {(0, e.offset + i): r[2] for i, r in enumerate(rows)}
    return e, build(leaves, e.leaves, arity, height(e.leaves, arity))


class Ragged(NamedTuple):
    """A node whose parent is not built yet, and the partition that it came from (-1: made in a hop)."""

    pid: int
    group: str | None
    leaves: int
    level: int
    index: int
    digest: str


def hop(nodes: RDD, to: int, arity: int) -> RDD:
    """Pairs (ragged node, its ancestor at level `to` or the root of its group, path between them).

    Nodes meet at the coordinate of that ancestor. Together they hold every leaf below it, so it is always complete.
    """

    def finish(item: tuple) -> Iterator[tuple[Ragged, Ragged, list[Step]]]:
        met = [Ragged(*n) for n in item[1]]
        leaves = met[0].leaves
        made = build({(n.level, n.index): n.digest for n in met}, leaves, arity, max(to, max(n.level for n in met)))
        stop = set(made.tops)
        for n in met:
            path, (level, i) = climb(made.nodes, n.level, n.index, stop, leaves, arity)
            yield n, Ragged(-1, n.group, leaves, level, i, made.nodes[level, i]), path

    return nodes.map(lambda n: ((n[1], n[4] // arity ** max(to - n[3], 0)), tuple(n))).groupByKey(nodes.getNumPartitions()).flatMap(finish)


class Forest:
    """Trees over sorted rows (group, order, digest, further columns), a tree a group."""

    def __init__(self, rows: DataFrame, arity: int = ARITY, part_rows: int = PART_ROWS):
        self.spark, self.schema, self.arity, self.part_rows = rows.sparkSession, rows.schema, arity, part_rows
        checkpoint_dir(self.spark)
        order = [F.asc_nulls_first(c) for c in rows.columns[:3]]
        parts = max(1, math.ceil(rows.count() / part_rows))
        self.rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).checkpoint().rdd
        edges = self.rows.mapPartitionsWithIndex(_edges).collect()  # two groups a partition
        self.heights = [height(e.leaves, arity) for own in extents(edges).values() for e in own.values()]
        self.extents = self.spark.sparkContext.broadcast(extents(edges))

    def ragged(self) -> RDD:
        """What partitions cannot build on, and roots of groups that they hold whole."""
        arity, known = self.arity, self.extents

        def run(pid: int, rows: Iterable) -> Iterator[Ragged]:
            own = known.value.get(pid, {})
            for group, found in _runs(rows):
                e, made = _local(own, group, found, arity)
                yield from (Ragged(pid, group, e.leaves, level, i, made.nodes[level, i]) for level, i in made.tops)

        return self.rows.mapPartitionsWithIndex(run)

    def paths(self) -> DataFrame:
        """pid, group, level, index of every ragged node, the root of its group and its path there."""
        group = self.schema[0].dataType
        node = [("leaves", T.LongType()), ("level", T.IntegerType()), ("index", T.LongType()), ("digest", T.StringType())]
        pair = T.StructType([T.StructField(n, k) for n, k in [("pid", T.IntegerType()), ("group", group), *node, *[(f"up_{n}", k) for n, k in node], ("path", _STEPS)]])
        start, step = int(math.log(self.part_rows, self.arity)), max(1, int(math.log(FAN, self.arity)))
        nodes, found, to = self.ragged(), None, start + step
        while True:
            met = hop(nodes, to, self.arity).map(lambda x: (*x[0], *x[1][2:], x[2]))
            up = cut(self.spark.createDataFrame(met, pair, verifySchema=False))
            if found is None:
                found = up
            else:
                low, high = found.alias("low"), up.alias("high")
                on = F.col("low.group").eqNullSafe(F.col("high.group")) & (F.col("low.up_level") == F.col("high.level")) & (F.col("low.up_index") == F.col("high.index"))
                own = [f"low.{c}" for c in ("pid", "group", "leaves", "level", "index", "digest")]
                found = low.join(high, on).select(*own, *[f"high.up_{n}" for n, _ in node], F.concat("low.path", "high.path").alias("path"))
            if to >= max(self.heights):
                return found.select("pid", "group", "level", "index", F.col("up_digest").alias("subroot"), "path")
            nodes = up.select(F.lit(-1), "group", *[f"up_{n}" for n, _ in node]).distinct().rdd.map(tuple)
            to += step

    def proofs(self, paths: DataFrame) -> DataFrame:
        """Each row with what its ragged node has: its own path first, then the node's columns from subroot on."""
        arity, known, parts = self.arity, self.extents, self.rows.getNumPartitions()
        further = paths.columns[4:]
        at = further.index("path")
        sent = paths.rdd.map(tuple).keyBy(lambda r: r[0]).partitionBy(parts, lambda pid: pid).values()

        def run(pid: int, both: Iterable) -> Iterator[tuple]:
            own = known.value.get(pid, {})
            for rows, nodes in both:
                above = {(r[1], r[2], r[3]): [list(map(tuple, v)) if i == at else v for i, v in enumerate(r[4:])] for r in nodes}
                for group, found in _runs(rows):
                    e, made = _local(own, group, found, arity)
                    stop = set(made.tops)
                    for i, r in enumerate(found):
                        path, top = climb(made.nodes, 0, e.offset + i, stop, e.leaves, arity)
                        rest = above[group, *top]
                        yield (*r, *[path + v if j == at else v for j, v in enumerate(rest)])

        schema = T.StructType([*self.schema.fields, *paths.schema.fields[4:]])
        # One list a partition on either side: rows stay where they were sorted, only the nodes' rows move.
        rows, spare = self.rows.glom(), sent.getNumPartitions() - parts
        if spare > 0:  # a session may deal to more partitions than were asked for
            rows = rows.union(self.spark.sparkContext.parallelize([[]] * spare, spare))
        return self.spark.createDataFrame(rows.zip(sent.glom()).mapPartitionsWithIndex(run), schema, verifySchema=False)


_STEPS = T.ArrayType(T.StructType().add("left", T.StringType()).add("right", T.StringType()))


def prove(rows: DataFrame, arity: int = ARITY, part_rows: int = PART_ROWS) -> DataFrame:
    """rows (group, order, digest, further columns) with subroot, path to the root of all, and that root.

    path: the siblings' digests left and right of the node, a step a level. fold() leads a digest along it.
    """
    rows = cut(rows)
    if rows.isEmpty():
        return rows.select("*", F.lit(None).cast("string").alias("subroot"), F.lit(None).cast(PATH).alias("path"), F.lit(None).cast("string").alias("root"))
    forest = Forest(rows, arity, part_rows)
    low = cut(forest.paths())
    roots = low.select(F.lit(0).alias("all"), F.col("group").alias("name"), F.col("subroot").alias("digest")).distinct()
    above = Forest(cut(roots), arity, part_rows)
    high = cut(above.proofs(above.paths()).select("name", F.col("path").alias("rest"), F.col("subroot").alias("root")))
    both = low.join(high, low["group"].eqNullSafe(high["name"])).select("pid", "group", "level", "index", "subroot", F.concat("path", "rest").alias("path"), "root")
    return forest.proofs(both)


def manifest(docs: DataFrame, arity: int = ARITY, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and the proof (path) of every row of docs.

    docs: doc_id, source, lang, n_chars, text. folded_root is that of the row as it reads in a copy where n_chars is one
    more wherever 7 divides the CRC-32 of the id's digits: it must differ from the root there, unless n_chars is null.
    """
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = docs.select(*columns).withColumn("_more", F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    rows = docs.select("lang", "doc_id", leaf_digest(*columns).alias("leaf"), leaf_digest("doc_id", "source", "lang", "_more", "text").alias("read"))
    out = prove(rows, arity, part_rows)
    out = out.withColumn("folded_root", fold(F.col("read"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "path")


def _encoded(*columns: str) -> str:
    return " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns)


#: CRC-32 by half bytes over the hexadecimal digits of the id's digits, then the trees and the way up, level by level.
ORACLE = f"""
WITH RECURSIVE half AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 1, 2, 3, 4], lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(16)) AS i))),
digits AS (SELECT row_number() OVER () AS r, *, hex(encode(doc_id::VARCHAR)) AS h FROM documents),
d AS (SELECT r, doc_id, source, lang, n_chars, text, n_chars + CASE WHEN xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, len(h) + 1), lambda p: ascii(substr(h, CASE WHEN p % 2 = 1 THEN p + 1 ELSE p - 1 END, 1))::BIGINT),
  lambda c, x: xor(c >> 4, t[(xor(c, x - CASE WHEN x > 57 THEN 55 ELSE 48 END) & 15) + 1])), 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS more FROM digits, half),
leaves AS (SELECT r, doc_id, lang, sha256({_encoded("doc_id", "source", "lang", "n_chars", "text")}) AS leaf, sha256({_encoded("doc_id", "source", "lang", "more", "text")}) AS read FROM d),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
tree AS (SELECT 0 AS level, lang, i, n, leaf AS h FROM placed
  UNION ALL SELECT level + 1, lang, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY level, lang, i // 2, n),
roots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
upper AS (SELECT 0 AS level, i, n, h FROM roots
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, i // 2, n),
climb AS (SELECT r, lang, 0 AS level, i, n, read AS folded, '' AS siblings FROM placed
  UNION ALL SELECT c.r, c.lang, c.level + 1, c.i // 2, (c.n + 1) // 2, sha256(CASE WHEN c.i % 2 = 0 THEN c.folded || coalesce(s.h, '') ELSE s.h || c.folded END), c.siblings || coalesce(s.h, '')
  FROM climb c LEFT JOIN tree s ON s.level = c.level AND s.lang IS NOT DISTINCT FROM c.lang AND s.i = xor(c.i, 1) WHERE c.n > 1),
rest AS (SELECT c.r, 0 AS level, t.i, t.n, c.folded, c.siblings FROM climb c JOIN roots t ON t.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
  UNION ALL SELECT c.r, c.level + 1, c.i // 2, (c.n + 1) // 2, sha256(CASE WHEN c.i % 2 = 0 THEN c.folded || coalesce(s.h, '') ELSE s.h || c.folded END), c.siblings || coalesce(s.h, '')
  FROM rest c LEFT JOIN upper s ON s.level = c.level AND s.i = xor(c.i, 1) WHERE c.n > 1)
SELECT p.doc_id, p.leaf, t.h AS subroot, u.h AS root, sha256(e.siblings) AS proof_sha256, e.folded AS folded_root, e.folded = u.h AS verified
FROM placed p JOIN roots t ON t.lang IS NOT DISTINCT FROM p.lang JOIN rest e ON e.r = p.r AND e.n = 1 JOIN upper u ON u.n = 1
"""
