import zlib

import duckdb
import pytest

from claimloom.llm import hosts, sharding


def test_byte_shards(spark):
    rows = [(i, None if i % 50 == 0 else f"text {i} " * (i % 40), "k") for i in range(2000)]
    rows += [(5000 + i, "one copy of many", "k") for i in range(900)] + [(7, rows[7][1], "k")]
    out = sharding.byte_shards(spark.createDataFrame(rows, "doc_id long, text string, key string")).collect()
    assert len(out) == len(rows)
    total = {}
    slots = {}
    text = {(r[0]): r[1] for r in rows}
    where = {}
    for r in out:
        t = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 8, zlib.crc32(t), "bytes", None)
        total[r.shard] = total.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert sorted(total) == list(range(24))
    assert max(total.values()) - min(total.values()) <= 0.05 * sum(total.values()) / 24 + 2 * max(r.size for r in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in where.values()) <= 23


def test_byte_shards_equal_sql(spark):
    rows = [(i, None if i % 9 == 0 else f"täxt {i % 40} " * (i % 60)) for i in range(300)] + [(None, "no id"), (4, ""), (4, ""), (5, "x" * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    order = lambda rs: sorted(map(str, rs))
    assert order(tuple(r) for r in sharding.byte_shards(df).collect()) == order(con.execute(sharding.ORACLE).fetchall())


def test_no_rows(spark):
    assert sharding.byte_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert hosts.judge(pages, spark.createDataFrame([], "page_id long, good boolean")).count() == 0


@pytest.fixture(scope="module")
def pages():
    urls = [None, "", "no scheme", "http://A.Example.COM", "http://www.example.com/en/x?y", "http://example.com/en/", "https://x.net/es/1#f", "http://x.net/de/2", "ftp://com/", "http://xcom/"]
    rows = [(i, u) for i, u in enumerate(urls)]
    for i in range(400):
        rows.append((100 + i, f"http://h{i % 7}.d{i % 3}.{'org' if i % 5 else 'net'}/q/{i}"))
    return rows


def test_rules_and_hosts(spark, pages):
    df = spark.createDataFrame([(i, u, "x") for i, u in pages], "page_id long, url string, rule string")
    got = {r.page_id: r for r in hosts.judge(df, spark.createDataFrame([], "page_id long, good boolean")).collect()}
    assert [got[i].rule for i in range(10)] == [None, None, None, None, "www.example.com/en/", "example.com/en/", "net/es/", None, "com/", None]
    assert (got[3].host, got[3].path) == ("a.example.com", "") and (got[0].host, got[2].host, got[4].path) == ("", "", "/en/x")
    assert got[4].verdict == "allow" and got[5].verdict == "block" and len(got) == len(pages)


def test_domains_by_a_list_of_suffixes(spark):
    df = spark.createDataFrame([(1, "http://a.b.co.uk/x"), (2, "http://b.co.uk"), (3, "http://x.y.org"), (4, "http://co.uk"), (5, None)], "page_id long, url string")
    got = {r.page_id: (r.domain, r.suffix) for r in hosts.with_host(df, ("co.uk", "uk")).collect()}
    assert got == {1: ("b.co.uk", "co.uk"), 2: ("b.co.uk", "co.uk"), 3: ("y.org", "org"), 4: ("co.uk", "co.uk"), 5: ("", "")}


def test_reputation_equals_sql(spark, pages):
    labels = [(i, int(i % 7 != 2), int(i % 11 == 0)) for i in range(0, 400, 2)] + [(3, None, 1), (None, 1, 0)]
    p = spark.createDataFrame(pages, "page_id long, url string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in hosts.judge(p, hosts.outcomes_by_document(p, lab)).select("page_id", "verdict").collect())
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", pages)
    con.execute("create table labels(doc_id bigint, quality int, toxic int)")
    con.executemany("insert into labels values (?, ?, ?)", labels)
    want = sorted(con.execute(f"select page_id, verdict from ({hosts.ORACLE})").fetchall())
    assert got == want and len({v for _, v in want}) == 2
