import json

from pyspark.sql import functions as F

from claimloom.functions import text
from claimloom.sources import pages
from claimloom.streaming import events

DIR = "/root/testdata/sf0.001"


def test_cached_pages(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"page-{i}.json").write_text(json.dumps({"offset": 2 * i, "records": [{"key": f"k{2 * i + j}", "year": 1990 + j} for j in range(2)]}))
    pages.register(spark)
    df = spark.read.format("cached_pages").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 3 and sorted(r.position for r in df.collect()) == list(range(6))
    own = pages.read_cached(spark, str(tmp_path))
    assert sorted((r.position, r.key, json.loads(r.record)["year"]) for r in own.collect()) == sorted((r.position, r.key, json.loads(r.record)["year"]) for r in df.collect())
    assert pages.complete(df, "key", 6).first().complete and not pages.complete(df, "key", 7).first().complete
    assert pages.foreign(df, F.get_json_object("record", "$.year") == "1990").count() == 3
    assert pages.year_slices(1950, 1970, 1972) == [(1950, 1959), (1960, 1969), (1970, 1970), (1971, 1971), (1972, 1972), (1973, None), (None, None)]
    other = df.select("key", F.lit("late").alias("note"))
    assert {r.note for r in pages.channels(df.limit(2), other, key="key").collect()} == {None, "late"}


def test_files(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"line": "a", "alias": "b", "checked": "2020"}, {"line": "a"}]))
    good, bad = pages.corrections(spark, str(tmp_path / "c.json"), "line string, alias string, checked string", ["line", "alias", "checked"])
    assert good.count() == 1 and bad.first().lacking == "alias,checked"
    pages.write_tsv(spark.createDataFrame([("a\tb", 1)], "x string, n int"), str(tmp_path / "t"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).first().x == "a b"
    spark.range(3).write.parquet(str(tmp_path / "old"))
    assert pages.previous_snapshot(spark, str(tmp_path / "old"), {"id": "bigint", "name": "string"}).where("name is null").count() == 3
    assert not pages.replace_if_complete(spark.range(9), str(tmp_path / "old"), False) and spark.read.parquet(str(tmp_path / "old")).count() == 3


def test_text(spark):
    rows = [("The Ünïcode & Co (film), Vol. 3",), (None,), ("ﾀﾞ × 2",)]
    df = spark.createDataFrame(rows, "t string").select("t", text.fold_key("t").alias("k"))
    assert [r.k for r in df.collect()] == ["unicodeandco", None, "タx"]
    assert text.fold("ﾀﾞ × 2", False) == "タx2" and text.fold("Kōkō wo Shōjo, Bd. 4") == "kokooshojo" and text.fold("Die Stadt 12") == "diestadt"
    assert text.strip_accents("Été が й") == "Ete が й" and text.fold_numbers("Ⅱ ½ x²") == "II 1/2 x2"
    assert text.clean_value("[[A|b]] <ref>x</ref>{{nihongo|T}} ''c''<br>d") == "b T c d"
    assert text.numbers_in("1, 3-5, 7.5, 3") == [1, 3, 4, 5, 7.5]
    assert text.numbers_in("1.5-5") == [1.5, 2, 3, 4, 5] and text.numbers_in("1.5–3.5") == [1.5, 2.5, 3.5] and text.numbers_in("2-4.5") == [2, 3, 4, 4.5] and text.numbers_in("1-900") == [1]
    assert text.split_fields("a|b {{c|d}}|[[e|f]]") == ["a", "b {{c|d}}", "[[e|f]]"] and [t["body"] for t in text.templates("{{ab|1}} {{x|{{ab}}}}", "AB")] == ["ab|1"]


def test_templates(spark):
    df = spark.createDataFrame([(1, "x {{Book|Title = A {{b|c}} |isbn=1|isbn=2}} y {{open"), (2, None)], "id int, t string")
    spark.udtf.register("extract_templates", text.ExtractTemplates)
    df.createOrReplaceTempView("wiki")
    got = spark.sql("select id, e.* from wiki, lateral extract_templates(t) e").collect()
    assert [(r.id, r.start, r.name, r.fields) for r in got] == [(1, 2, "Book", {"title": "A {{b|c}}", "isbn": "2"})]


def test_marc(spark):
    xml = '<record><leader>L</leader><controlfield tag="001">7</controlfield><datafield tag="020" ind1=" " ind2=" "><subfield code="a">978</subfield><subfield code="q">pbk</subfield></datafield></record>'
    r = spark.createDataFrame([(xml,)], "x string").select(text.marc_record(F.col("x")).alias("r"))
    row = r.select(F.col("r.leader"), F.col("r.cf")["001"].alias("id"), text.subfields(F.col("r"), "020", "a").alias("isbn")).first()
    assert tuple(row) == ("L", "7", ["978"])


def test_stream_equals_batch(spark, tmp_path):
    batch = spark.read.parquet(f"{DIR}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = events.tumbling(stream, late="60 days").writeStream.outputMode("complete").format("memory").queryName("tumbled").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {(r.start, r.event_type): r.n for r in events.tumbling(batch).collect()}
    assert {(r.start, r.event_type): r.n for r in spark.sql("select * from tumbled").collect()} == want
    assert sum(r.n for r in events.sessions(batch).collect()) == batch.count()
    q = events.append_claims(events.once(stream, "60 days"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.select("event_id").distinct().count()
