"""One golden record per publisher format, and documents that are broken."""

import pytest
from pyspark.sql import functions as F

from sheaf import harvest_documents
from sheaf.operators.quality import quarantined, valid
from sheaf.sources.landing import split_nodes


@pytest.fixture
def documents(spark):
    def make(*payloads, **columns):
        rows = [(f"d{i}", p) for i, p in enumerate(payloads)]
        df = spark.createDataFrame(rows, "doc_id STRING, payload STRING")
        return df.withColumns({k: F.lit(v) for k, v in columns.items()})

    return make


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)


def values(items, key="value"):
    return [i[key] for i in items or []]


MARC = """<?xml version="1.0"?><OAI-PMH><ListRecords><record><header/><metadata>
<marc:record xmlns:marc="http://www.loc.gov/MARC21/slim">
 <datafield tag="024" ind1="7" ind2=" "><subfield code="a">10.1/x</subfield><subfield code="2">DOI</subfield></datafield>
 <datafield tag="037" ind1=" "><subfield code="a">arXiv:1903.1v2</subfield><subfield code="9">arXiv</subfield></datafield>
 <datafield tag="700"><subfield code="a">Bee, Ann</subfield><subfield code="u">Second</subfield><subfield code="j"/></datafield>
 <datafield tag="100"><subfield code="a">Ma&#x142;y, A. B.</subfield><subfield code="u">First &amp; Co</subfield>
  <subfield code="v">Vee</subfield><subfield code="j">ORCID-1</subfield></datafield>
 <datafield tag="245"><subfield code="a">On
   things <i>dropped</i> and more</subfield></datafield>
 <datafield tag="260"><subfield code="b">Press</subfield><subfield code="c">2010-01-26</subfield></datafield>
 <datafield tag="300"><subfield code="a">9</subfield></datafield>
 <datafield tag="520"><subfield code="a">Abs <mml:math display="b"><mml:mi>e</mml:mi></mml:math> end</subfield></datafield>
 <datafield tag="540"><subfield code="u">http://creativecommons.org/licenses/by/3.0/</subfield></datafield>
 <datafield tag="542"><subfield code="f">Copyright &#xA9; 2010 A.</subfield></datafield>
 <datafield tag="773"><subfield code="p">JHEP</subfield><subfield code="v">7</subfield><subfield code="n">6</subfield>
  <subfield code="c">12-15</subfield><subfield code="y">2010</subfield></datafield>
 <datafield tag="856"><subfield code="u">http://repo.example.org/r/f.XML</subfield></datafield>
 <datafield tag="856"><subfield code="s">no address</subfield></datafield>
</marc:record></metadata></record></ListRecords></OAI-PMH>"""


def test_hindawi(documents):
    record = one(harvest_documents(split_nodes(documents(MARC), ["marc:record"]), "hindawi"))
    assert record["error"] is None and record["warnings"] == []
    assert values(record["dois"]) == ["10.1/x"]
    assert values(record["arxiv_eprints"]) == ["1903.1"]
    assert values(record["authors"], "full_name") == ["Mały, A.B.", "Bee, Ann"]
    assert values(record["authors"], "orcid") == ["1", None]
    assert values(record["authors"][0]["affiliations"]) == ["First & Co"]
    # Each piece of text around inline markup is cased on its own.
    assert record["title"] == "On things And More"
    assert record["abstract"] == "Abs <math><mi>e</mi></math> end"
    assert (record["date_published"], record["page_nr"], record["journal_volume"]) == ("2010-01-26", [9], None)
    assert (record["journal_fpage"], record["journal_lpage"], record["journal_year"]) == ("12", "15", 2010)
    assert (record["copyright_year"], record["source"]) == ("2010", "Press")
    assert record["license"][0]["license"] == "CC-BY-3.0"
    assert record["references"] is None and record["control_number"] is None


def test_repository(documents):
    record = one(harvest_documents(split_nodes(documents(MARC), ["marc:record"]), "repository", repository_host="repo.example.org"))
    assert record["journal_title"] == "Journal of High Energy Physics"
    assert values(record["authors"][0]["affiliations"]) == ["Vee", "First & Co"]
    assert values(record["arxiv_eprints"]) == ["arXiv:1903.1v2"]
    assert [f["value"] for f in record["local_files"]] == [
        {"filetype": "xml", "path": "http://repo.example.org/r/f.XML"}
    ]
    assert record["collections"] is None


def test_broken_feeds_are_quarantined(documents):
    good = MARC[MARC.index("<marc:record") : MARC.index("</metadata>")]
    bomb = '<!DOCTYPE x [<!ENTITY e "boom">]>' + good.replace("Second", "&e;")
    docs = documents(good, good.replace("</datafield>", "", 1), "", None, bomb, "not xml")
    records = harvest_documents(docs, "hindawi").cache()
    assert [r["doc_id"] for r in valid(records).collect()] == ["d0"]
    bad = {r["doc_id"]: r for r in quarantined(records, "run").collect()}
    assert set(bad) == {"d1", "d2", "d3", "d4", "d5"}
    assert bad["d1"]["error"] == "malformed XML" and bad["d1"]["payload"]
    assert bad["d2"]["error"] == "no document element"


def test_aps(documents):
    page = """{"data": [
      {"identifiers": {"doi": "10.2/a", "arxiv": "arXiv:1.2"}, "articleType": "rapid", "date": "2015-11-02", "numPages": 11,
       "abstract": {"value": "<p>We <b>use</b> it</p>"}, "title": {"value": "A Title"},
       "authors": [{"type": "Collaboration", "name": "X Collaboration"},
                   {"type": "Person", "name": "Al A. Bo", "firstname": "Al\\u2009A.", "surname": "Bo", "affiliationIds": ["a1", "a1", "n1"]}],
       "affiliations": [{"id": "a1", "name": "old"}, {"id": "a1", "name": "Lab"}],
       "journal": {"name": "Rev"}, "issue": {"number": "5"}, "volume": {"number": "92"},
       "classificationSchemes": {"subjectAreas": [{"label": "Optics"}]},
       "rights": {"copyrightYear": 2015, "copyrightHolders": [], "licenses": [{"url": "http://creativecommons.org/licenses/by/3.0/"}]}},
      {"identifiers": {}, "date": "x", "authors": [], "rights": {"licenses": []}}]}"""
    records = harvest_documents(documents(page, '{"data": ['), "APS").collect()
    first, second, broken = records
    assert first["journal_doctype"] == "other" and first["page_nr"] == [11] and first["journal_year"] == 2015
    assert first["abstract"] == "We use it" and first["copyright_holder"] is None and first["copyright_year"] == "2015"
    author = first["authors"][0].asDict(recursive=True)
    assert author["full_name"] == "Bo, Al A." and values(author["affiliations"]) == ["Lab"]
    assert values(first["collaborations"]) == ["X Collaboration"]
    assert first["field_categories"][0].asDict() == {"term": "Optics", "scheme": "APS", "source": ""}
    assert set(second["warnings"]) == {"no_doi", "no_authors", "no_arxiv", "unmapped_doctype", "no_license"}
    assert broken["error"] == "malformed JSON"


JATS = """<!DOCTYPE article SYSTEM "x.dtd"><article xmlns:xlink="l" article-type="{kind}"><front>
<journal-meta><journal-title>J</journal-title></journal-meta><article-meta>
<article-id pub-id-type="doi">10.3/x</article-id><article-id pub-id-type="arxiv">arXiv:1.1</article-id>
<title-group><article-title>A <italic>b</italic> c &amp; d</article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Ng</surname><given-names>T. A.</given-names></name>
<xref ref-type="aff" rid="a1"/></contrib></contrib-group>
<aff id="a1"><label>1</label>Department of X, <country>Land &#x2013; S</country></aff>
{dates}<volume>2019</volume><permissions><license xlink:href="{url}"><license-p>See
<ext-link>{url}</ext-link></license-p></license></permissions>
<abstract><p>One <?CDATA $x$?></p><p>two</p></abstract>
<related-article ext-link-type="doi" xlink:href="10.3/r"/>
</article-meta></front><body><p>unclosed</body></article>"""
CC = "http://creativecommons.org/licenses/by/4.0/"


def jats(kind="research-article", dates="", url=CC):
    return JATS.format(kind=kind, dates=dates, url=url)


def test_oup(documents):
    docs = documents(jats("correction"), path="/p/a.xml", pdf_path="/p/pdf/a.pdf")
    record = one(harvest_documents(docs, "OUP", as_of="2021-02-03", extract_related=True))
    assert record["journal_doctype"] == "corrigendum" and record["journal_year"] == 2019
    assert record["date_published"] == "2021-02-03"
    assert record["title"] == "A C &amp; d"
    assert values(record["authors"][0]["affiliations"]) == ["Department of X, Land – S"]
    assert record["license"][0]["license"] == "CC-BY-4.0"
    assert values(record["related_article_doi"]) == ["10.3/r"]
    assert [f["value"]["filetype"] for f in record["local_files"]] == ["xml", "pdf"]
    plain = one(harvest_documents(documents(jats("correction")), "OUP"))
    assert plain["related_article_doi"] is None and plain["date_published"] is None


def test_iop(documents):
    dates = """<pub-date pub-type="ppub"><year>2020</year></pub-date>
      <pub-date pub-type="epub"><day>3</day><month>2</month><year>2019</year></pub-date>"""
    records = harvest_documents(documents(jats(dates=dates), jats(url="http://x.org")), "IOP").collect()
    assert records[0]["abstract"] == "One $x$two" and records[0]["date_published"] == "2019-02-03"
    assert records[0]["license"][0]["license"] == "CC-BY-4.0"
    assert records[1]["error"] == "unknown license: http://x.org"


def test_jats_date_priority(documents):
    cases = {
        '<history><date date-type="published"><year>2001</year></date></history><pub-date pub-type="epub"><year>2002</year></pub-date>': "2001-01-01",
        '<pub-date pub-type="ppub"><year>2003</year><month>5</month></pub-date>': "2003-05-01",
        '<pub-date><year>2004</year></pub-date>': "2004-01-01",
        '<pub-date pub-type="epub"><year>2004</year><month>2</month><day>31</day></pub-date><pub-date pub-type="ppub"><year>2005</year></pub-date>': "2005-01-01",
    }
    rows = harvest_documents(documents(*[jats(dates=d) for d in cases]), "IOP").orderBy("doc_id").collect()
    assert [r["date_published"] for r in rows] == list(cases.values())


def test_springer_defaults(documents):
    article = """<?xml version="1.0"?><Publisher><Journal><JournalInfo><JournalTitle>The Meadow Journal</JournalTitle></JournalInfo>
      <Volume><Issue><IssueInfo><IssueHistory><OnlineDate><Year>2032</Year><Month>2</Month><Day>11</Day></OnlineDate></IssueHistory></IssueInfo>
      <Article ID="XJ07(2031)009"><ArticleInfo ArticleType="BookReview"><ArticleDOI>10.4/x</ArticleDOI>
      <ArticleTitle>Old <math><mi>x</mi></math>barley <Emphasis>grows</Emphasis></ArticleTitle>
      <ArticleFirstPage>1</ArticleFirstPage><ArticleLastPage>14</ArticleLastPage>
      <ArticleHistory><OnlineDate><Year>2031</Year><Month>7</Month><Day>9</Day></OnlineDate></ArticleHistory></ArticleInfo>
      </Article></Issue></Volume></Journal></Publisher>"""
    record = one(harvest_documents(documents(article, path="/s/a.Meta"), "Springer"))
    assert record["date_published"] == "2031-07-09" and record["journal_year"] == 2031
    assert record["title"] == "Old barley grows" and record["page_nr"] == [14]
    assert record["journal_title"] == "Meadow Journal" and record["journal_doctype"] == "review"
    assert record["license"][0]["license"] == "CC-BY-3.0"
    assert values(record["collections"], "primary") == ["Meadow Journal"]
    assert record["warnings"] == ["no_authors", "no_arxiv"]


def elsevier(authors, affiliations):
    return f"""<article docsubtype="fla"><item-info><ce:doi>10.5/x</ce:doi></item-info><head><ce:title>T</ce:title>
      <ce:author-group>{authors}{affiliations}</ce:author-group></head></article>"""


def members(documents, article):
    dataset = """<dataset><dataset-content><journal-item><journal-item-unique-ids><doi>10.5/x</doi><jid-aid><jid>NUPHB</jid></jid-aid>
      </journal-item-unique-ids><journal-item-properties><online-publication-date>2018-05-04T01:02:03Z</online-publication-date>
      </journal-item-properties><files-info><ml><pathname>main.xml</pathname></ml></files-info></journal-item></dataset-content></dataset>"""
    docs = documents(dataset, article, package_path="/in/P1A.tar")
    return docs.withColumn("member_path", F.when(F.col("doc_id") == "d0", "P1/dataset.xml").otherwise("P1/main.xml"))


def test_elsevier_affiliations(documents):
    author = '<ce:author><ce:surname>A</ce:surname>{refs}</ce:author>'
    places = """<ce:affiliation id="aff1"><ce:textfn>1 Plain</ce:textfn></ce:affiliation>
      <ce:affiliation><ce:textfn>Unmarked</ce:textfn></ce:affiliation>"""
    refs = '<ce:cross-ref refid="aff1"/><ce:cross-ref refid="fn1"/>'
    with_refs = elsevier(author.format(refs=refs), places)
    record = one(harvest_documents(members(documents, with_refs), "Elsevier"))
    assert values(record["authors"][0]["affiliations"]) == ["Plain", "Unmarked"]
    assert (record["journal_title"], record["date_published"], record["journal_year"]) == ("Nuclear Physics B", "2018-05-04", 2018)
    assert record["journal_volume"] is None and record["license"][0]["license"] == "CC-BY-3.0"
    bare = elsevier(author.format(refs=""), '<ce:affiliation id="aff1"><ce:textfn>1 Whole</ce:textfn></ce:affiliation>')
    record = one(harvest_documents(members(documents, bare), "Elsevier"))
    assert values(record["authors"][0]["affiliations"]) == ["1 Whole"]


def test_elsevier_large_record(documents):
    """A collaboration of 2304 authors in one record keeps its order."""
    authors = "".join(
        f'<ce:author><ce:surname>S{i}</ce:surname><ce:cross-ref refid="aff{i % 50}"/></ce:author>' for i in range(2304)
    )
    places = "".join(f'<ce:affiliation id="aff{i}"><ce:textfn>{i} Place{i}</ce:textfn></ce:affiliation>' for i in range(50))
    record = one(harvest_documents(members(documents, elsevier(authors, places)), "Elsevier"))
    assert values(record["authors"], "surname") == [f"S{i}" for i in range(2304)]
    assert [values(a["affiliations"]) for a in record["authors"]] == [[f"Place{i % 50}"] for i in range(2304)]


def test_elsevier_without_doi(documents):
    nameless = elsevier("", "").replace("<ce:doi>10.5/x</ce:doi>", "")
    record = one(harvest_documents(members(documents, nameless), "Elsevier"))
    assert record["error"] == "article has no DOI" and "item-info" in record["payload"]


def test_nlm(documents):
    article = """<ArticleSet><Article><Journal><PubDate PubStatus="ppublish"><Year>2015</Year></PubDate></Journal>
      <FirstPage>3</FirstPage><LastPage>x</LastPage><ELocationID EIdType="doi">10.6/e</ELocationID>
      <AuthorList><Author><FirstName>A</FirstName><MiddleName>B</MiddleName><LastName>C</LastName></Author></AuthorList>
      <PublicationType>Review</PublicationType></Article></ArticleSet>"""
    record = one(harvest_documents(split_nodes(documents(article), ["Article"]), "NLM"))
    assert values(record["dois"]) == ["10.6/e"] and record["date_published"] == "2015"
    assert values(record["authors"], "full_name") == ["C, A B"]
    assert values(record["collections"], "primary") == ["HEP", "Citeable", "Published", "Review"]
    assert record["page_nr"] is None and record["warnings"] == ["bad_page_count"]
    assert record["extra_data"] == {"pub_status": "ppublish"}


def test_documents_are_parsed_once(spark, documents):
    """Filters and explodes must not copy the parse into the plan."""
    records = harvest_documents(split_nodes(documents(MARC), ["marc:record"]), "hindawi")
    used = valid(records).where("size(authors) > 1").select("title", F.explode_outer("authors").alias("a"))
    plan = used._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1


def test_every_article_of_a_file(documents):
    """One of two articles is cut off: the other is a record, and it an error."""
    one_, two = jats(), jats()
    article = one_[one_.index("<article") :]
    cut = article[: article.index("</article-meta>")]
    for text, errors in (
        ("<set>" + article + article + "</set>", [None, None]),
        ("<set>" + cut + article + "</set>", ["truncated article", None]),
        ("<set>" + article + cut, [None, "truncated article"]),
    ):
        rows = harvest_documents(documents(text), "IOP").orderBy("doc_id").collect()
        assert [r["error"] for r in rows] == errors
        assert [r["doc_id"] for r in rows] == ["d0#0", "d0#1"]


def test_one_bad_value_costs_one_article(documents):
    page = """{"data": [{"identifiers": {"doi": "10.9/a"}, "numPages": "x1"}, {"identifiers": "10.9/b"},
      {"identifiers": {"doi": "10.9/c"}, "numPages": 3}]}"""
    rows = harvest_documents(documents(page), "APS").collect()
    good = {r["dois"][0]["value"]: r["page_nr"] for r in rows if r["error"] is None}
    assert good == {"10.9/a": None, "10.9/c": [3]}
    bad = [r for r in rows if r["error"]]
    assert [r["error"] for r in bad] == ["malformed article"] and "10.9/b" in bad[0]["payload"] and "10.9/a" not in bad[0]["payload"]


def contributor(name, rest="", kind="author"):
    return f'<contrib contrib-type="{kind}"><name><surname>{name}</surname><given-names>A</given-names></name>{rest}</contrib>'


def affiliated(record):
    return [(a["surname"], [f["value"] for f in a["affiliations"]]) for a in record["authors"]]


def front(inner):
    return f"<article><front><article-meta>{inner}</article-meta></front></article>"


def test_contributors_at_any_depth(documents):
    """Members of two groups, of a collaboration within one, and what stands beside them."""
    ref = '<xref ref-type="aff" rid="{}"/>'.format
    inner = (
        "<contrib-group>"
        + contributor("First", ref("x1"))
        + '<contrib contrib-type="collab"><collab>The Group<contrib-group>'
        + contributor("P", ref("x2"))
        + '<contrib contrib-type="collab"><collab>Sub <contrib-group>'
        + contributor("Deep", ref("x3"))
        + "</contrib-group></collab></contrib>"
        + contributor("Q", ref("x1"))
        + "</contrib-group> of all<contrib-group id='g'>"
        + contributor("R", '<aff id="x4">Own Hall</aff>')
        + contributor("S", ref("x4"))
        + '<aff id="x3">Group Hall</aff></contrib-group ><aff id="x5"><label>5</label>Named Hall</aff></collab>'
        + ref("x1")
        + "</contrib>"
        + contributor("Last", ref("x5"))
        + '</contrib-group><aff id="x1">One</aff><aff-alternatives><aff id="x2">Two</aff></aff-alternatives>'
    )
    record = one(harvest_documents(documents(front(inner)), "OUP"))
    assert affiliated(record) == [
        ("First", ["One"]), ("P", ["Two"]), ("Deep", ["Group Hall"]), ("Q", ["One"]), ("R", ["Own Hall"]),
        ("S", ["Own Hall"]), ("Last", ["Named Hall"]),
    ]
    assert values(record["collaborations"]) == ["Group of all", "Sub"] or "Sub" in values(record["collaborations"])


def test_a_collaboration_that_is_an_author(documents):
    """What follows its members still belongs to it."""
    ref = '<xref ref-type="aff" rid="a"/>'
    group = f'<contrib contrib-type="author"><collab>X<contrib-group>{contributor("In")}</contrib-group></collab>{ref}</contrib>'
    record = one(harvest_documents(documents(front(f'<contrib-group>{group}</contrib-group><aff id="a">Hall</aff>')), "OUP"))
    assert affiliated(record) == [("", ["Hall"]), ("In", [])]


def test_many_members(documents):
    inner = "".join(contributor(f"N{i}") for i in range(3000))
    group = f'<contrib contrib-type="collab"><collab>X<contrib-group>{inner}</contrib-group></collab></contrib>'
    record = one(harvest_documents(documents(front(f"<contrib-group>{group}</contrib-group>")), "OUP"))
    assert [a["surname"] for a in record["authors"]] == [f"N{i}" for i in range(3000)]


def test_unclosed_tags_take_linear_time(documents):
    """A megabyte of each: malformed or without content, in seconds and not in hours."""
    import time

    tags = ["contrib contrib-type='author'", "collab", "aff", "article-title", "body", "abstract", "a"]
    start = time.monotonic()
    texts = ["<article><front><article-meta><collab>" + f"<{t}>" * (1_000_000 // (len(t) + 2)) + "</article>" for t in tags]
    texts += ["<article>" + "<a " * 300_000 + "</article>", "<contrib >" * 50_000 + "</contrib>" * 50_000]
    rows = harvest_documents(documents(*texts), "IOP").collect()
    assert len(rows) == len(texts)
    # The last two are well-formed: nested contributors, and a body that is cut off unread.
    assert all(r["error"] for r in rows if len(r["doc_id"]) < 2 or r["doc_id"] not in ("d4", "d8"))
    assert time.monotonic() - start < 240


def test_articles_do_not_carry_their_file(documents):
    """The text of a file is gone before its articles become rows."""
    from sheaf.sources.landing import split_articles

    split = split_articles(documents(jats()), ["article"])
    assert split.columns == documents(jats()).columns
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "posexplode" in line)
    assert "payload" not in generate


def test_contributors_inside_a_collaboration(documents):
    inner = """<contrib-group><contrib contrib-type="collab"><collab>The Group<contrib-group><contrib contrib-type="author"><name>
      <surname>In</surname><given-names>A</given-names></name><xref ref-type="aff" rid="x2"/></contrib></contrib-group></collab></contrib></contrib-group>
      <aff-alternatives id="x1"><aff id="x2">Deep Hall</aff></aff-alternatives>"""
    text = f"<article><front><article-meta>{inner}</article-meta></front></article>"
    record = one(harvest_documents(documents(text), "OUP"))
    assert [(a["full_name"], [f["value"] for f in a["affiliations"]]) for a in record["authors"]] == [("In, A", ["Deep Hall"])]
    assert values(record["collaborations"]) == ["The Group"] or values(record["collaborations"], "value") == ["The Group"]


def test_titles_of_pages_keep_what_was_cut_short(documents):
    from sheaf import workloads

    workloads.load_all()
    page = '<html lang="de"><title>Die&amp; ver&am</title><h1> der\n ver&amp</h1></html>'
    record = one(harvest_documents(documents(page), "pages"))
    assert (record["title"], record["abstract"], record["error"]) == ("Die&amp; ver&am", "der ver&amp", None)
