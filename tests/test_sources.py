import gzip
import hashlib
import io
import zipfile
import xml.etree.ElementTree as ET

from litloom.sources import files, grid, jats, pubmed, spl

PUBMED = b"""<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><Journal><ISSN IssnType="Print">1</ISSN><JournalIssue CitedMedium="Print"><Volume>3</Volume>
<PubDate><MedlineDate>1999 Spring-Summer</MedlineDate></PubDate></JournalIssue><ISOAbbreviation>J. X.</ISOAbbreviation></Journal><ArticleTitle>A <i>b</i><sub>2</sub> c</ArticleTitle>
<ELocationID EIdType="doi">10.1/e</ELocationID><Abstract><AbstractText Label="AIM" NlmCategory="OBJECTIVE">aa <b>bb</b> cc</AbstractText><AbstractText> </AbstractText><AbstractText>dd</AbstractText></Abstract>
<AuthorList><Author><AffiliationInfo><Affiliation>NIH, Bethesda</Affiliation></AffiliationInfo></Author></AuthorList><GrantList><Grant><Agency>CDC HHS</Agency></Grant></GrantList>
<PublicationTypeList><PublicationType UI="D1">Review</PublicationType></PublicationTypeList></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D9" MajorTopicYN="Y">Heart</DescriptorName><QualifierName UI="Q1">physiology</QualifierName></MeshHeading></MeshHeadingList>
<KeywordList Owner="NOTNLM"><Keyword MajorTopicYN="N">k1</Keyword></KeywordList><KeywordList><Keyword>k2</Keyword></KeywordList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">8</ArticleId><ArticleId IdType="pmc">PMC1</ArticleId><ArticleId IdType="mid">M</ArticleId></ArticleIdList><ReferenceList><Reference><ArticleIdList><ArticleId IdType="pubmed">99</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>"""


def test_pubmed(spark):
    whole = PUBMED + b"</PubmedArticleSet>"
    rows = list(pubmed.articles(gzip.compress(whole)))
    a = rows[0]
    assert (a["pmid"], a["pmc"], a["doi"], a["other_ids"]) == ("8", "PMC1", "10.1/e", {"mid": "M"})
    assert (a["title"], a["abstract"]) == ("A b2 c", "AIM: aa bb cc dd")
    assert (a["year"], a["publication_date"]["date_str"], a["journal"]) == (1999, "1999 Spring-Summer", "J. X.")
    assert a["mesh_terms"][0]["major_topic"] and a["mesh_terms"][0]["qualifiers"][0]["name"] == "physiology"
    assert a["keywords_flat"] == ["k1"] and a["affiliations"] == ["NIH, Bethesda"]
    assert len(list(pubmed.articles(PUBMED + b"<broken"))) == 1 and list(pubmed.articles(b"")) == []
    df = spark.createDataFrame([("p", bytearray(whole)), ("q", bytearray(b"no xml"))], "path string, content binary")
    got = pubmed.read(df).collect()
    assert len(got) == 1 and got[0].abstract_structured[0].label == "AIM"


JATS = b"""<article article-type="Research-Article" xmlns:xlink="x"><front><journal-meta><journal-title>J</journal-title><issn pub-type="epub">2</issn></journal-meta><article-meta>
<article-id pub-id-type="pmid">5</article-id><article-id pub-id-type="pmc">PMC5</article-id><title-group><article-title>On  <i>x</i></article-title></title-group>
<pub-date pub-type="ppub"><year>2019</year></pub-date><pub-date pub-type="epub"><day>3</day><month>2</month><year>2020</year></pub-date>
<permissions><license license-type="open-access" xlink:href="http://cc/by/4.0"><p>CC BY</p></license></permissions><kwd-group><kwd>k</kwd></kwd-group><kwd-group kwd-group-type="mesh"><kwd>m</kwd></kwd-group>
<abstract><sec><title>Aim</title><p>to see</p></sec></abstract></article-meta></front>
<body><p>Lead H<sub>2</sub>O</p><sec sec-type="materials|methods"><title>How</title><p>did</p><sec><p>inner</p></sec></sec><sec><title>Case notes</title><p>z</p></sec>
<sec><table-wrap id="t1"><label>Table 1</label><caption><title>T</title><p>c</p></caption><table><tr><th rowspan="2">a</th><th colspan="2">b|</th></tr><tr><td>1</td><td>2</td></tr></table></table-wrap></sec></body>
<floats-group><table-wrap id="t1"/><table-wrap><table><tr><td>q</td></tr></table></table-wrap></floats-group></article>"""


def test_jats(spark):
    a = jats.parse(JATS)
    assert (a["document_id"], a["title"], a["article_type"], a["license"], a["publication_date"]) == ("pmid_5", "On x", "research-article", "cc-by", "2020-02-03")
    assert [(s["type"], s["id"], s["content"]) for s in a["sections"]] == [("introduction", "intro", "Lead H 2 O"), ("methods", "sec1", "did"), ("case_report", "sec2", "z")]
    assert a["abstract"] == "Aim: to see" and a["keywords"] == ["k"] and a["mesh_terms"] == ["m"]
    assert [(t["id"], t["location"]) for t in a["tables"]] == [("t1", "inline"), ("table-float-2", "floating")]
    assert a["tables"][0]["content"] == "| a | b\\| |  |\n| :--- | :--- | :--- |\n| a | 1 | 2 |"
    bare = jats.parse(b"<article/>", "PMC9")
    assert (bare["document_id"], bare["title"], bare["has_full_text"], bare["skip_reason"]) == ("pmcid_PMC9", "Untitled PMC9", False, None)
    wrapped = jats.parse(b"<pmc-articleset>" + JATS + b"</pmc-articleset>")
    assert wrapped["document_id"] == "pmid_5" and len(wrapped["sections"]) == 3
    assert jats.parse(b"<article/>")["skip_reason"] == "no identifier" and jats.parse(b"<")["skip_reason"].startswith("parse error")
    closed = JATS.replace(b"license-type=\"open-access\"", b"license-type=\"cc-by-nc\"")
    assert jats.parse(closed)["skip_reason"] == "non-commercial license" and jats.parse(closed, need_commercial=False)["license"] == "cc-by-nc"
    df = spark.createDataFrame([("a/x.nxml.gz", bytearray(gzip.compress(JATS))), ("b", bytearray(b""))], "path string, content binary")
    got = {r.document_id: r for r in jats.read(df).collect()}
    assert got["pmid_5"].sections[0].type == "introduction" and got[None].skip_reason


SPL = b"""<document xmlns="urn:hl7-org:v3"><code code="34391-3" displayName="x"/><title>T</title><setId root="s-1"/><representedOrganization><name>Maker</name></representedOrganization>
<component><structuredBody><component><section><code code="34071-1"/><title>W</title><text>one <content>two</content></text><excerpt><highlight><text>%s</text></highlight></excerpt>
<component><section><title>Sub</title><text>child</text></section></component></section></component><component><section><code code="43685-7"/><text>more<table><tr><td>h</td></tr><tr><td>v</td></tr></table></text></section></component>
<component><section><subject><manufacturedProduct><manufacturedProduct><name>Drug</name><ingredient classCode="ACTIB"><ingredientSubstance><name>act</name></ingredientSubstance></ingredient><ingredient classCode="IACT"><name>no</name></ingredient></manufacturedProduct></manufacturedProduct></subject></section></component></structuredBody></component></document>""" % (b"h" * 60)


def test_jats_places_and_notes():
    aff = lambda code, name: f"<aff><country country='{code}'>{name}</country></aff>" if code else f"<aff><country>{name}</country></aff>"
    make = lambda inner: ET.fromstring(f"<article><front><article-meta>{inner}</article-meta></front></article>")
    told = lambda inner: jats.country_of(r := make(inner), r.find(".//article-meta"))
    assert told(f"<contrib-group><contrib>{aff('de', 'Germany')}</contrib></contrib-group><corresp><country country='fr'>France</country></corresp>") == ("FR", "France")
    assert told(f"<contrib-group>{aff('', 'Peru')}</contrib-group>") == ("", "Peru")
    assert told(f"<contrib-group>{aff('', 'Peru')}</contrib-group>{aff('', 'x')}{aff('us', 'USA')}") == ("US", "USA")
    assert told("") == ("", "")
    wrap = ET.fromstring("<table-wrap><caption><p>c<fn>no</fn></p></caption><table-wrap-foot><fn>a</fn><p>a</p><p>b</p></table-wrap-foot></table-wrap>")
    assert jats.footnotes(wrap) == ["a", "b"] and jats.footnotes(ET.fromstring("<table-wrap><fn>x</fn></table-wrap>")) == []
    ids = jats._ids(ET.fromstring("<m><article-id pub-id-type='other'>NIHMS7</article-id><article-id pub-id-type='nihms_id'>8</article-id></m>"))
    assert ids["nihms_id"] == "8"
    licence = lambda attr, words: jats.license_of(ET.fromstring(f"<m><permissions><license {attr}>{words}</license></permissions></m>"))
    assert [licence("license-type='cc-by-nc'", ""), licence("href='http://x/by-nd/4.0'", "cc by"), licence("", "in the Public Domain"), licence("", "all rights")] == ["cc-by-nc", "cc-by-nd", "cc0", "unknown"]


def test_spl_fallbacks():
    body = lambda inner, head="": f"<document xmlns='urn:hl7-org:v3'><code code='34391-3'/><title>The title</title>{head}{inner}</document>".encode()
    a = spl.parse(body("<section><code code='34071-1'/><text>x</text></section>"), "stem-1")
    assert (a["set_id"], a["drug_name"], a["active_ingredients"]) == ("stem-1", "The title", [])
    own = lambda inner: {s["key"]: s for s in spl.parse(body(inner))["sections"]}
    table = "<table><tr><td>h</td></tr><tr><td>v</td></tr></table>"
    deep = f"<section><code code='34071-1'/><text>x{table}</text><component><section><text>y</text><component><section><text>{table}</text></section></component></section></component></section>"
    assert len(own(deep)["warnings"]["tables"]) == 1
    twice = f"<section><code code='34071-1'/><text>a{table}</text></section><section><code code='34071-1'/><text>b{table}</text></section>"
    assert [t["type"] for t in own(twice)["warnings"]["tables"]] == ["table_0", "table_0"] and own(twice)["warnings"]["text"].count("\n\n") == 1
    elsewhere = f"<section><code code='0'/><text>z</text><excerpt><highlight><text>{'h' * 60}</text></highlight></excerpt></section>"
    assert own(elsewhere) == {}
    kinds = "".join(f"<ingredient classCode='{c}'><ingredientSubstance><name>{c}</name></ingredientSubstance></ingredient>" for c in ("ACTIB", "ACTIM", "ACTIR", "ACTIB"))
    assert spl.parse(body("", kinds))["active_ingredients"] == ["ACTIB", "ACTIB"]


def test_spl(spark):
    a = spl.parse(SPL)
    assert (a["status"], a["set_id"], a["drug_name"], a["active_ingredients"], a["manufacturer"]) == ("ok", "s-1", "Drug", ["act"], "Maker")
    own = {s["key"]: s for s in a["sections"]}
    assert own["warnings"]["text"].startswith("one  two\n\nSub: child\n\nmore") and own["warnings"]["has_tables"] and own["highlights"]["text"] == "h" * 60
    assert spl.parse(SPL.replace(b"34391-3", b"1"))["status"] == "non_rx" and spl.parse(b"<")["status"] == "parse_error"
    df = spark.createDataFrame([("p", bytearray(SPL))], "path string, content binary")
    assert spl.read(df).first().sections[0].key == "warnings"


def test_grids():
    rows = grid.grid(ET.fromstring("<table><tr><th rowspan='3'>r</th><th>h</th></tr><tr><td colspan='x'>1</td></tr><tr/></table>"))
    assert rows == [["r", "h"], ["r", "1"], ["r"]]
    assert grid.row_by_row(rows) == "Row 1: r: r, h: 1\nRow 2: r: r" and grid.markdown([]) == "" and grid.row_by_row(rows[:1]) == ""
    assert grid.markdown([["a"], ["b", "c"]], caption="C", footnotes=["f"]) == "**C**\n\n| a |  |\n| --- | --- |\n| b | c |\n\nf"


def _zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, c in members.items():
            z.writestr(n, c)
    return out.getvalue()


def test_files(spark, tmp_path):
    nested, plain = _zip({"prescription/1.zip": _zip({"A-1.xml": b"<a/>", "x.txt": b""})}), _zip({"B.XML": b"<b/>", "2.zip": b""})
    df = spark.createDataFrame([("n", bytearray(nested)), ("p", bytearray(plain)), ("bad", bytearray(b"zip"))], "path string, content binary")
    assert {(r.path, r.archive_id, bytes(r.content)) for r in files.unzipped(df).collect()} == {("n", "a-1", b"<a/>"), ("p", "b", b"<b/>")}
    body = b"data"
    (tmp_path / "x.gz").write_bytes(body)
    sums = spark.createDataFrame([("a.md5", bytearray(b"MD5(a)= " + hashlib.md5(body).hexdigest().upper().encode())), ("b.md5", bytearray(b"none"))], "path string, content binary")
    got = files.verified(spark.createDataFrame([(p, bytearray(body)) for p in "abc"], "path string, content binary"), sums)
    assert {r.path: r.valid for r in got.collect()} == {"a": True, "b": False, "c": False}
    assert files.listing(spark, str(tmp_path), "*.gz").count() == 1 and files.listing(spark, str(tmp_path), "*.gz", "2999-01-01T00:00:00").count() == 0
    assert files.daily_names(spark, "2026-02-02", "2026-02-01").count() == 0
    listed = spark.createDataFrame([("s3://b/dm_spl_daily_update_02022026.zip",), ("other",)], "path string")
    assert [r.path for r in files.published(files.daily_names(spark, "2026-02-01", "2026-02-03"), listed).collect()] == ["s3://b/dm_spl_daily_update_02022026.zip"]
    from pyspark.sql import functions as F

    times = spark.createDataFrame([("20260102030405.123",), ("x",), (None,)], "t string").select(files.modified(F.col("t")).cast("string").alias("t")).collect()
    assert [r.t for r in times] == ["2026-01-02 03:04:05", None, None]


def test_boxed_tables():
    from litloom.sources.xmltext import text_without

    cells = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td/></tr></table>"
    root = ET.fromstring(
        f"<r><table-wrap><caption><title>C</title></caption>{cells}<table-wrap-foot><fn>n<p>m</p></fn></table-wrap-foot></table-wrap>"
        f"<table-wrap><caption><p>D</p></caption><alternatives><graphic/>{cells}</alternatives></table-wrap><table-wrap><caption>E</caption><graphic/></table-wrap>{'<table-wrap/>' * 20}</r>"
    )
    got = grid.boxed_tables(root)
    assert len(got) == 15 and [t["is_image_only"] for t in got[:4]] == [False, False, True, False]
    assert got[0]["markdown"] == "**C**\n\n| a | b |\n| --- | --- |\n| 1 |  |\n\nFootnotes: n m; m" and got[0]["row_by_row"] == "Table: C. Row 1: a: 1\n\nFootnotes: n m; m"
    assert got[1]["markdown"].startswith("**D**\n\n| a") and got[2]["markdown"] == "**E** (Image-based table)" and got[3]["markdown"] == ""
    assert text_without(ET.fromstring("<s>a <x>no</x> b<y> c<x>no</x></y></s>"), {"x"}) == "a b c"
