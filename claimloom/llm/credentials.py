r"""Secrets in texts, with weak parts of credentials reported only where they are linked.

Three kinds are secrets by their form alone and always reported: assigned values, access key ids and long runs of
hexadecimal digits. Others are too common to report: names of users and accounts, hosts and urls, long runs of mixed
characters. They become credentials where parts complement each other: an identifier and a secret, and the
endpoint where both are used.

Parts are found in each whole text. Those of texts that can link at all are joined as intervals: a scope (a paragraph;
blank lines part them) is laid out in bins of `reach` characters, the parts that touch a bin are summed up as the least
start and greatest end of each role, and a weak part looks at the bins that its surroundings touch. In a bin, these
two numbers decide exactly whether any part of a role is within reach, so no pair of parts is ever made, however
many there are. A weak identifier or secret is reported if a strong part of the other role is within reach, or parts of
both other roles; a weak endpoint if both an identifier and a secret are.

Weak parts that overlap a part found before (in the order of KINDS) are none. Positions are code points, ends
exclusive. A null text is empty; repeated rows and null ids are kept as they are. An empty table gives no row. Texts of
any length are read whole: every pattern takes linear time. Other columns are never read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut

#: Characters between two parts that still belong together.
REACH = 200
#: In the order in which spans with one start are listed.
KINDS = ["assign", "access", "hex", "user", "endpoint", "key"]
STRONG = KINDS[:3]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "user": "identifier", "endpoint": "endpoint", "key": "secret"}

# The patterns of the three strong kinds.
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api_?key"]
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS = {
    "assign": rf"(?:{'|'.join(ASSIGN_WORDS)}){_VALUE}([A-Za-z0-9+/_.=-]+)",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]+)",
    "user": rf"(?:username|user|login|account|client_id|access_key_id){_VALUE}([A-Za-z0-9@._-]+)",
    "endpoint": rf"((?:https?|ftp|sftp|s3|jdbc:[A-Za-z]+|postgres|postgresql|mysql|redis|mongodb|amqp)://[A-Za-z0-9][A-Za-z0-9._:/-]*|(?:host|server|endpoint){_VALUE}[A-Za-z0-9][A-Za-z0-9.-]*)",
    "key": r"([A-Za-z0-9+/_=-]+)",
}
#: Letters of these match in either case.
EITHER_CASE = {"assign", "user", "endpoint"}
#: Characters that the value of a match has at least.
LEAST = {"assign": 6, "access": 20, "hex": 24, "user": 3, "endpoint": 8, "key": 20}

_RE = {k: re.compile(p, re.ASCII | (re.IGNORECASE if k in EITHER_CASE else 0)) for k, p in PATTERNS.items()}
# A run of one class is as long as it can be, so the least length may stand in the pattern and spares short matches.
_RE |= {"access": re.compile(r"(AKIA[A-Z0-9]{16,})"), "hex": re.compile(r"([0-9a-f]{24,})"), "key": re.compile(r"([A-Za-z0-9+/_=-]{20,})")}
_BREAK = re.compile(r"\n[\x20\t\r]*\n")
_NEEDS = {"assign": ["passw", "secret", "token", "apikey", "api_key"], "user": ["user", "login", "account", "client_id", "access_key_id"], "endpoint": ["://", "host", "server", "endpoint"]}
PART = "struct<start: long, place: int, end: long, scope: long>"
Part = tuple[int, int, int]


def _found(kind: str, text: str, low: str) -> Iterator[tuple[int, int]]:
    if kind in _NEEDS and not any(word in low for word in _NEEDS[kind]):
        return
    for m in _RE[kind].finditer(text):
        value = m[1]
        if len(value) < LEAST[kind] or kind == "key" and not (re.search("[A-Z]", value) and re.search("[a-z]", value) and re.search("[0-9]", value)):
            continue
        yield m.start(), m.end()


def parts_of(text: str) -> tuple[list[Part], list[Part]]:
    """(start, place in KINDS, end) of strong parts, and of weak ones if the text holds an identifier at all."""
    low = text.lower()
    strong = sorted((a, KINDS.index(kind), b) for kind in STRONG for a, b in _found(kind, text, low))
    if not any(KINDS[p] == "access" for _, p, _ in strong) and not any(word in low for word in _NEEDS["user"]):
        return strong, []
    weak: list[Part] = []
    for kind in KINDS[3:]:
        taken = sorted((a, b) for a, _, b in strong + weak)
        starts, ends, most = [a for a, _ in taken], [], 0
        for _, b in taken:
            ends.append(most := max(most, b))
        for a, b in _found(kind, text, low):
            before = bisect_right(starts, b - 1)
            if not before or ends[before - 1] <= a:
                weak.append((a, KINDS.index(kind), b))
    roles = {ROLES[KINDS[p]] for _, p, _ in strong + weak}
    return strong, weak if {"identifier", "secret"} <= roles else []


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, strong and weak parts with their scopes, of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    part = pa.list_(pa.struct([("start", pa.int64()), ("place", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for value in batch.column(1):
                text = value.as_py() or ""
                both = parts_of(text)
                breaks = [m.end() for m in _BREAK.finditer(text)] if both[1] else []
                for rows, found in zip(out, both):
                    rows.append([{"start": a, "place": p, "end": b, "scope": bisect_right(breaks, a)} for a, p, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], part), pa.array(out[1], part)], names=["doc_id", "strong", "weak"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, strong array<{PART}>, weak array<{PART}>")


def _bins(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last))


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts (uid, scope, place, start, end) that complementary parts are within reach of."""
    of = {role: [i for i, kind in enumerate(KINDS) if ROLES[kind] == role] for role in ("identifier", "secret", "endpoint")}
    of |= {f"strong_{role}": [i for i in of[role] if KINDS[i] in STRONG] for role in ("identifier", "secret")}
    touched = parts.withColumn("bin", _bins(F.floor(F.col("start") / reach), F.floor(F.col("end") / reach)))
    least = [F.min(F.when(F.col("place").isin(places), F.col("start"))).alias(f"{role}_from") for role, places in of.items()]
    most = [F.max(F.when(F.col("place").isin(places), F.col("end"))).alias(f"{role}_to") for role, places in of.items()]
    summed = touched.groupBy("uid", "scope", "bin").agg(*least, *most)
    weak = parts.where(F.col("place") >= len(STRONG))
    looking = weak.withColumn("bin", _bins(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach)))
    near = {role: F.max(F.coalesce((F.col(f"{role}_from") <= F.col("end") + reach) & (F.col(f"{role}_to") >= F.col("start") - reach), F.lit(False))).alias(role) for role in of}
    met = looking.join(summed, ["uid", "scope", "bin"]).groupBy("uid", "scope", "place", "start", "end").agg(*near.values())
    kind = {role: F.col("place").isin(places) for role, places in of.items()}
    ok = (
        F.when(kind["identifier"], F.col("strong_secret") | F.col("secret") & F.col("endpoint"))
        .when(kind["secret"], F.col("strong_identifier") | F.col("identifier") & F.col("endpoint"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return met.where(ok).select("uid", "scope", "place", "start", "end")


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["place"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of docs (doc_id, text).

    spans: kind:start:end of the strong parts and the linked weak ones, by start, then in the order of KINDS.
    """
    rows = cut(find_parts(docs).withColumn("uid", F.monotonically_increasing_id()))
    places = F.transform("strong", lambda s: s["place"])
    counts = [(F.size("strong") - F.size(F.array_remove(places, i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(STRONG)]
    base = F.sha2(_listed(F.col("strong")), 256).alias("base_sha256")
    can = rows.where(F.size("weak") > 0)
    parts = can.select("uid", F.explode(F.concat("strong", "weak")).alias("p")).select("uid", "p.*")
    extra = linked(parts, reach).groupBy("uid").agg(F.collect_list(F.struct("start", "place", "end", "scope")).alias("extra"))
    none = F.array().cast(f"array<{PART}>")
    more = can.join(extra, "uid", "left").withColumn("all", F.array_sort(F.concat("strong", F.coalesce("extra", none))))
    rest = rows.where(F.size("weak") == 0).withColumn("all", F.col("strong"))
    return more.select("doc_id", *counts, base, _listed(F.col("all")).alias("spans")).union(rest.select("doc_id", *counts, base, _listed(F.col("all")).alias("spans")))


def _sql_pattern(kind: str) -> str:
    """The pattern behind the shortest stretch of anything, its groups: 1 that stretch, 2 the match, 3 the value."""
    pattern = PATTERNS[kind]
    if kind in EITHER_CASE:  # spelled out, as other letters fold to these as well
        pattern = re.sub(r"(\[[^]]*\]|\\x20)|([a-z])", lambda m: m[1] or f"[{m[2]}{m[2].upper()}]", pattern)
    return f"(?s)(.*?)({pattern})".replace("'", "''")


def _sql_matches(kind: str) -> str:
    pattern = _sql_pattern(kind)
    mixed = " AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[0-9]')" if kind == "key" else ""
    return f"""(SELECT r, {KINDS.index(kind)} AS place, (upto - length(m))::BIGINT AS a, upto::BIGINT AS b FROM (
  SELECT r, m, v, sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i) AS upto FROM (
    SELECT r, unnest(regexp_extract_all(text, '{pattern}', 1)) AS p, unnest(regexp_extract_all(text, '{pattern}', 2)) AS m, unnest(regexp_extract_all(text, '{pattern}', 3)) AS v,
      unnest(range(len(regexp_extract_all(text, '{pattern}', 1)))) AS i FROM d)) WHERE length(v) >= {LEAST[kind]}{mixed})"""


def _sql_free(kind: str, *taken: str) -> str:
    return f"SELECT * FROM {_sql_matches(kind)} w WHERE NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(f'SELECT * FROM {t}' for t in taken)}) t WHERE t.r = w.r AND t.a < w.b AND t.b > w.a)"


_NEAR = f"t.r = w.r AND t.scope = w.scope AND t.a <= w.b + {REACH} AND t.b >= w.a - {REACH}"
_PLACES = {role: ", ".join(str(KINDS.index(k)) for k, r in ROLES.items() if r == role) for role in ("identifier", "secret", "endpoint")}

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM {_sql_matches(k)}' for k in STRONG)}),
users AS MATERIALIZED ({_sql_free("user", "base")}),
endpoints AS MATERIALIZED ({_sql_free("endpoint", "base", "users")}),
keys AS MATERIALIZED ({_sql_free("key", "base", "users", "endpoints")}),
parts AS MATERIALIZED (SELECT p.*, len(regexp_extract_all(left(text, a), '\\n[\\x20\\t\\r]*\\n')) AS scope FROM (SELECT * FROM base UNION ALL SELECT * FROM users UNION ALL SELECT * FROM endpoints UNION ALL SELECT * FROM keys) p JOIN d USING (r)),
near AS (SELECT w.r, w.place, w.a, w.b, bool_or(t.place IN ({_PLACES["identifier"]})) AS identifier, bool_or(t.place IN ({_PLACES["secret"]})) AS secret, bool_or(t.place IN ({_PLACES["endpoint"]})) AS endpoint,
  bool_or(t.place = 1) AS strong_identifier, bool_or(t.place IN (0, 2)) AS strong_secret FROM parts w JOIN parts t ON {_NEAR} WHERE w.place >= 3 GROUP BY w.r, w.place, w.a, w.b),
spans AS (SELECT r, place, a, b FROM base UNION ALL SELECT r, place, a, b FROM near WHERE CASE WHEN place = 3 THEN strong_secret OR secret AND endpoint WHEN place = 5 THEN strong_identifier OR identifier AND endpoint ELSE identifier AND secret END),
named AS (SELECT *, ({KINDS!r})[place + 1] || ':' || a || ':' || b AS span FROM spans)
SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY a, place) FILTER (place < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, place), '') AS spans
FROM d LEFT JOIN named USING (r) GROUP BY r, doc_id
"""
