"""Markup as queries: pages are written from columns, parsed again, and the SQL says what the columns were."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import keys, text, wiki
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows

BASE = """SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size, '9784' || lpad(CAST(p_partkey * 3 AS VARCHAR(12)), 8, '0') AS b1, '9780' || lpad(CAST(p_partkey * 7 AS VARCHAR(12)), 8, '0') AS b2, '2' || lpad(CAST(p_partkey % 999 AS VARCHAR(9)), 3, '0') AS year,
 lpad(CAST(p_size % 12 + 1 AS VARCHAR(2)), 2, '0') AS mon, lpad(CAST(p_size % 28 + 1 AS VARCHAR(2)), 2, '0') AS dom FROM {part}"""
BASE = BASE.replace("'2' || lpad(CAST(p_partkey % 999 AS VARCHAR(9)), 3, '0') AS year", "'' || (1990 + p_partkey % 30) AS year")
_CHECK = "(10 - list_sum(list_transform(range(1, 13), lambda k: substr({0}, k, 1)::INT * CASE WHEN k % 2 = 1 THEN 1 ELSE 3 END)) % 10)::INT % 10"
_B = f"WITH b AS (SELECT *, b1 || {_CHECK.format('b1')} AS jp, b2 || {_CHECK.format('b2')} AS en FROM ({plain(BASE)}))"


def _base(spark, sf_dir):
    b = rows(spark, sf_dir, BASE, part="p_partkey")
    return b.withColumns({"jp": F.concat("b1", keys.isbn13_check(F.col("b1")).cast("string")), "en": F.concat("b2", keys.isbn13_check(F.col("b2")).cast("string"))})


def _text(*parts):
    return F.concat(*[F.lit(p[1:]) if p.startswith("=") else F.col(p).cast("string") for p in parts])


@query(f"""{_B} SELECT id, CASE WHEN id % 5 = 0 THEN 'SP' ELSE size::VARCHAR END AS number, name || ' days' AS title, CASE WHEN id % 3 > 0 THEN year || '-' || mon || '-' || dom END AS original_date, CASE WHEN id % 4 > 0 THEN jp END AS original_isbn, CASE WHEN id % 7 = 0 THEN year || '-' || mon END AS licensed_date, CASE WHEN id % 2 = 0 THEN en END AS licensed_isbn,
size || '.0 ' || (size + 1) || '.0 ' || (size + 2) || '.0' AS chapters, id % 3 = 0 AND id % 4 = 0 AND id % 7 > 0 AND id % 2 > 0 AS announced FROM b""")
def volume_templates(spark, sf_dir):
    """Volume templates with nested templates, links and references as records."""
    t = F.concat(
        _text("=Lead {{Graphic novel list/header|x=1}} text\n{{Graphic novel list\n| VolumeNumber = "), F.when(F.col("id") % 5 == 0, F.lit("SP")).otherwise(_text("=0", "size")), _text("=\n| LicensedTitle = [[", "brand", "=|", "name", "= days]]\n| OriginalRelDate = "),
        F.when(F.col("id") % 3 > 0, _text("year", "=-", "mon", "=-", "dom", "=<ref>{{cite|a=1}}</ref>")).otherwise("—"), F.lit("\n| OriginalISBN = "), F.when(F.col("id") % 4 > 0, F.col("jp")).otherwise("TBA"), F.lit("\n| LicensedRelDate = "), F.when(F.col("id") % 7 == 0, _text("year", "=-", "mon")).otherwise(""),
        F.lit("\n| LicensedISBN = "), F.when(F.col("id") % 2 == 0, F.col("en")).otherwise(""), _text("=\n| ChapterList = Chapters ", "size", "=–"), (F.col("size") + 2).cast("string"), F.lit("\n}} tail {{open"),
    )
    v = _base(spark, sf_dir).select("id", F.explode(wiki.volumes_of(t)).alias("v"))
    chapters = F.array_join(F.transform("v.chapters", lambda x: F.format_string("%.1f", x)), " ")
    return v.select("id", "v.number", "v.title", "v.original_date", "v.original_isbn", "v.licensed_date", "v.licensed_isbn", chapters.alias("chapters"), "v.announced")


@query(f"""{_B} SELECT id, size::VARCHAR AS number, 'JP' AS market, jp AS isbn, year || '-' || mon || '-' || dom AS day FROM b UNION ALL SELECT id, size::VARCHAR, 'EN', en, CASE WHEN id % 2 = 0 THEN '2020-01-05' END FROM b WHERE id % 3 > 0""")
def wiki_tables(spark, sf_dir):
    """Table rows with spans, their ISBNs telling the market, repeated rows dropped."""
    row = F.concat(_text("=\n|-\n| rowspan=2 | ", "size", "= || ", "name", "= || ", "year", "=-", "mon", "=-", "dom", "= || ISBN ", "jp"), F.when(F.col("id") % 2 == 0, F.lit(" || 2020-01-05")).otherwise(""), F.when(F.col("id") % 3 > 0, _text("= || ", "en")).otherwise(""))
    t = F.concat(F.lit("x {| class=a\n! Nr !! Titel"), row, row, F.lit("\n|-\n| none || ISBN 9784000000001\n|} y"))
    return _base(spark, sf_dir).select("id", F.explode(wiki.rows_of(t)).alias("r")).select("id", "r.*")


@query(f"""{_B} SELECT id, array_to_string(list_concat(list_concat(range(size, size + 3), [1, 2]), [size + 10, size + 11]), ' ') AS numbers, 3::BIGINT AS entries, 'br' AS last_mark, CASE id % 4 WHEN 0 THEN 'bare' WHEN 1 THEN 'padded' WHEN 2 THEN 'ordinal day' ELSE 'label mission' END AS shape, CASE id % 4 WHEN 1 THEN size % 10 ELSE size END::INTEGER AS number FROM b""")
def counted_lists(spark, sf_dir):
    """Lists that number their items by counting, entries of a cell, and the shapes of numbered runs."""
    b = _base(spark, sf_dir)
    t = F.concat(_text("=<ol start=\"", "size", "=\"><li>a<li>b<li>c</ol> {{Numbered list|x|y|style=z}}\n#<li value=\""), (F.col("size") + 10).cast("string"), F.lit("\"> p\n# q"))
    cell = wiki.entries_of(_text("=one ", "name", "=<br>two<br/>three"))
    entry = F.when(F.col("id") % 4 == 0, F.col("size").cast("string")).when(F.col("id") % 4 == 1, F.concat(F.lit("0"), (F.col("size") % 10).cast("string"), F.lit(" Sample"))).when(F.col("id") % 4 == 2, F.concat(F.col("size").cast("string"), F.lit("th days"))).otherwise(_text("=\"Mission:", "size", "=\""))
    out = b.select("id", F.array_join(wiki.counted(t), " ").alias("numbers"), cell.alias("c"), wiki.run_shape(entry).alias("s"))
    return out.select("id", "numbers", F.size("c").cast("bigint").alias("entries"), F.element_at("c", -1)["mark"].alias("last_mark"), "s.shape", "s.number")


@query(f"""{_B} SELECT id, name, brand || '|' || kind AS genres, 'Ann Lee|' || brand AS author, CASE WHEN id % 2 = 0 THEN kind || ' House' ELSE brand END AS publisher, CASE WHEN id % 3 = 0 THEN 'Viz ' || kind WHEN id % 3 = 1 THEN 'UK ' || brand ELSE kind END AS publisher_en, year || '-' || mon || '-' || dom AS first,
CASE WHEN id % 4 = 0 THEN (year::INT + 2) || '' END AS last, CASE WHEN id % 4 = 0 THEN 'ended' ELSE 'ongoing' END AS status, size::INTEGER AS volumes, 'List of ' || name || ' volumes' AS volume_list, name || ' (manga)' AS main_article, true AS named_back FROM b""")
def infoboxes(spark, sf_dir):
    """Facts of a page's infobox, its publishers by status and region, the lead's link to the work."""
    publisher = F.when(F.col("id") % 2 == 0, _text("brand", "= (former)<br />", "kind", "= House <small>(current)</small>")).otherwise(_text("=[[X|", "brand", "=]]"))
    english = F.when(F.col("id") % 3 == 0, _text("={{English manga publisher|UK=", "brand", "=|NA=[[Viz ", "kind", "=]]}}")).when(F.col("id") % 3 == 1, _text("={{English manga publisher|UK=UK ", "brand", "=|AUS=x}}")).otherwise(F.col("kind"))
    t = F.concat(
        _text("=''[[Weekly|Weekly X]]'' and ''[[", "name", "= (manga)|", "name", "=]]'' is\n{{Infobox animanga/Header|name = ", "name", "=|genre = {{ubl|[[", "brand", "=]]|", "kind", "=}}}}\n{{Infobox animanga/Print|author=Ann Lee<br>", "brand", "=|publisher = "), publisher, F.lit("|publisher_en = "), english,
        _text("=|first = ", "year", "=-", "mon", "=-", "dom", "=|last = "), F.when(F.col("id") % 4 == 0, (F.col("year").cast("int") + 2).cast("string")).otherwise(""), _text("=|volumes = ", "size", "= (list)|volume_list = List of ", "name", "= volumes}}"),
    )
    b = _base(spark, sf_dir).withColumn("t", t)
    out = b.select("id", F.col("name").alias("work"), F.get(wiki.facts_of("t"), F.lit(0)).alias("f"), wiki.lead_links("t", "name").alias("main_article"))
    back = F.contains(keys.compact_key(F.col("f.name")), keys.compact_key(F.col("work"))) | (F.col("f.volume_list") == F.concat(F.lit("List of "), "work", F.lit(" volumes")))
    return out.select("id", *[F.col(f"f.{c}").alias(c) for c in ("name", "genres", "author", "publisher", "publisher_en", "first", "last", "status", "volumes", "volume_list")], "main_article", back.alias("named_back"))


@query(f"""{_B} SELECT id, 'Book' AS template, name || ' ' || kind AS value, '2' AS isbn, (9 + length(name) + 1)::INTEGER AS start, 'A ' || name AS cleaned FROM b""")
def template_fields(spark, sf_dir):
    """Templates by name, their fields (the last of equal ones stays), values as plain text."""
    t = _text("=x {{no}} ", "name", "= {{Book|Title = {{nihongo|", "name", "= ", "kind", "=}} |isbn=1|isbn=2|note=[[a|b]]}} y {{open")
    b = _base(spark, sf_dir).withColumn("t", t)

    @F.udf("array<struct<start:int,name:string,title:string,isbn:string>>", useArrow=True)
    def books(s):
        return [(x["offset"], text.split_fields(x["body"])[0].strip(), text.clean_value(text.field_map(x["body"])["title"]), text.field_map(x["body"])["isbn"]) for x in text.templates(s, "book")]

    found = b.select("id", "name", F.explode(books("t")).alias("x"), text.plain_value(_text("='''A''' [[B|", "name", "=]]<ref name=x/> <!-- c -->")).alias("cleaned"))
    return found.select("id", F.col("x.name").alias("template"), F.col("x.title").alias("value"), F.col("x.isbn").alias("isbn"), F.col("x.start").alias("start"), "cleaned")


_XML_SQL = f"""{_B} SELECT id, {{leader}} AS leader, '' || id AS control, jp || '|' || en AS isbns, name AS title, CASE WHEN id % 2 = 0 THEN size::VARCHAR END AS number, {{origin}} AS origin FROM b"""


@query(_XML_SQL.format(leader="'00000nam'", origin="CASE WHEN id % 3 = 0 THEN 'kor' END"))
def marc_records(spark, sf_dir):
    """MARC records from XML: leader, control number, repeated subfields, title and number."""
    x = F.concat(
        _text("=<record><leader>00000nam</leader><controlfield tag=\"001\">", "id", "=</controlfield><datafield tag=\"020\" ind1=\" \" ind2=\" \"><subfield code=\"a\">", "jp", "=</subfield></datafield><datafield tag=\"020\" ind1=\" \" ind2=\" \"><subfield code=\"a\">", "en", "=</subfield></datafield>"),
        F.when(F.col("id") % 3 == 0, F.lit('<datafield tag="041" ind1="1" ind2=" "><subfield code="h">kor</subfield></datafield>')).otherwise(""),
        _text("=<datafield tag=\"245\" ind1=\" \" ind2=\" \"><subfield code=\"a\">", "name", "=</subfield>"), F.when(F.col("id") % 2 == 0, _text("=<subfield code=\"n\">", "size", "=</subfield>")).otherwise(""), F.lit("</datafield></record>"),
    )
    r = _base(spark, sf_dir).select("id", text.marc_record(x).alias("r"))
    sub = lambda tag, code: text.subfields(F.col("r"), tag, code)
    return r.select("id", F.col("r.leader").alias("leader"), F.try_element_at("r.cf", F.lit("001")).alias("control"), F.array_join(sub("020", "a"), "|").alias("isbns"), F.get(sub("245", "a"), F.lit(0)).alias("title"), F.get(sub("245", "n"), F.lit(0)).alias("number"), F.get(sub("041", "h"), F.lit(0)).alias("origin"))


@query(_XML_SQL.format(leader="'00000cam'", origin="CASE WHEN id % 3 = 0 THEN 'chi' END"))
def unimarc_records(spark, sf_dir):
    """UNIMARC records from XML, by their own tags."""
    x = F.concat(
        _text("=<record><leader>00000cam</leader><controlfield tag=\"001\">", "id", "=</controlfield><datafield tag=\"010\" ind1=\" \" ind2=\" \"><subfield code=\"a\">", "jp", "=</subfield></datafield><datafield tag=\"010\" ind1=\" \" ind2=\" \"><subfield code=\"a\">", "en", "=</subfield></datafield>"),
        F.when(F.col("id") % 3 == 0, F.lit('<datafield tag="101" ind1="1" ind2=" "><subfield code="c">chi</subfield></datafield>')).otherwise(""),
        _text("=<datafield tag=\"200\" ind1=\" \" ind2=\" \"><subfield code=\"a\">", "name", "=</subfield>"), F.when(F.col("id") % 2 == 0, _text("=<subfield code=\"h\">", "size", "=</subfield>")).otherwise(""), F.lit("</datafield></record>"),
    )
    r = _base(spark, sf_dir).select("id", text.marc_record(x).alias("r"))
    sub = lambda tag, code: text.subfields(F.col("r"), tag, code)
    return r.select("id", F.col("r.leader").alias("leader"), F.try_element_at("r.cf", F.lit("001")).alias("control"), F.array_join(sub("010", "a"), "|").alias("isbns"), F.get(sub("200", "a"), F.lit(0)).alias("title"), F.get(sub("200", "h"), F.lit(0)).alias("number"), F.get(sub("101", "c"), F.lit(0)).alias("origin"))


@query(f"""{_B} SELECT id, jp, CASE id % 5 WHEN 0 THEN 'JP' WHEN 1 THEN 'EN' WHEN 2 THEN 'FR' WHEN 3 THEN 'KR' END AS market, id % 2 = 0 AS whole FROM b""")
def isbn_markets(spark, sf_dir):
    """The market of an ISBN's registration group, the longest prefix first; malformed ISBNs are null."""
    b = _base(spark, sf_dir)
    i = F.when(F.col("id") % 5 == 0, F.col("jp")).when(F.col("id") % 5 == 1, F.lit("9798000000000")).when(F.col("id") % 5 == 2, F.lit("9791090000000")).when(F.col("id") % 5 == 3, F.lit("9788990000000")).otherwise("9785000000000")
    shown = F.when(F.col("id") % 2 == 0, F.concat_ws("-", F.substring("jp", 1, 3), F.substring("jp", 4, 10))).otherwise(F.substring("jp", 1, 12))
    return b.select("id", "jp", wiki.market_of(i).alias("market"), keys.isbn13_valid(shown).alias("whole"))


