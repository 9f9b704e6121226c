"""Literal vectors for the field functions."""

from pyspark.sql import functions as F

from sheaf import dims
from sheaf.functions import arrays, dates, ids, licenses, names, text, urls, xml
from sheaf.operators.ranges import range_as_string

X = "x"


def test_dates(evaluate):
    vectors = {
        "2013-05-09T05:16:48Z": ("2013-05-09", 2013),
        "1973": ("1973", 1973),
        "1916 Mar 4": ("1916-03-04", 1916),
        "2014-2": ("2014-02", 2014),
        "2012-5-55": ("2012-05", 2012),
        "2012 Feb": ("2012-02", 2012),
        "1 May 1992": ("1992-05-01", 1992),
        "5-2022": ("2022-05-01", 2022),
        "5-222HH": ("5-222HH", 0),
        "today": ("today", 0),
        "1988/05/26": ("1988-05-26", 1988),
        "1 May 92": ("1992-05-01", 1992),
        "1 May 12": ("2012-05-01", 2012),
        "2012-02-30": ("2012-02", 2012),
        "2012-13-01": ("2012", 2012),
        "26/05/1988": ("1988-05-26", 1988),
        "Thu, 03 Jan 1765 10:02:13 +0000": ("1765-01-03", 1765),
        "": ("", 0),
        "2012\n": ("2012\n", 0),
    }
    assert evaluate(vectors, dates.format_date(F.col(X))) == [v[0] for v in vectors.values()]
    assert evaluate(vectors, dates.format_year(F.col(X))) == [v[1] for v in vectors.values()]


def test_pad_date(evaluate):
    given = ["2010", "2010-7", "2010-07-09", "2010-02-31", "soon"]
    assert evaluate(given, dates.pad_iso_date(F.col(X))) == [
        "2010-01-01", "2010-07-01", "2010-07-09", None, None,
    ]


def test_strftime_before_1900(evaluate):
    early = F.to_timestamp(F.col(X))
    got = evaluate(["1765-01-03 10:02:13"], dates.strftime(early, "%a, %d %b %Y %H:%M:%S +0000"))
    assert got == ["Thu, 03 Jan 1765 10:02:13 +0000"]


def test_split_fullname(evaluate):
    def split(value, switch=False):
        row = evaluate([value], names.split_fullname(F.col(X), switch))[0]
        return row["surname"], row["given_names"]

    assert split("Ruud, Tove Linnea") == ("Ruud", "Tove Linnea")
    assert split("Ruud Berg, Tove Linnea") == ("Ruud Berg", "Tove Linnea")
    assert split("Ruud Berg Tove Linnea", switch=True) == ("Ruud", "Berg Tove Linnea")
    assert split("Tove Linnea Ruud") == ("Ruud", "Tove Linnea")
    assert split("Tove Linnea Ruud Berg") == ("Berg", "Tove Linnea Ruud")
    assert split("Tove Linnea, Ruud Berg", switch=True) == ("Ruud Berg", "Tove Linnea")
    assert split("") == ("", "")
    assert split(None) == ("", "")


def test_collapse_initials(evaluate):
    given = ["K. P. Virtanen", "T.-A. B. C", "None"]
    assert evaluate(given, names.collapse_initials(F.col(X))) == ["K.P. Virtanen", "T.A.B. C", "None"]


def test_domain_and_numbers(evaluate):
    assert evaluate(["http://www.example.com/77/page"], urls.parse_domain(F.col(X))) == [
        "http://www.example.com/"
    ]
    assert evaluate(["27 sheets", "no sheets"], text.has_numbers(F.col(X))) == [True, False]


def test_ranges(evaluate):
    vectors = {
        "11,12,13": "11-13",
        "11,12,15": "11-12, 15",
        "4,19,25": "4, 19, 25",
        "4,5,19,77,78": "4-5, 19, 77-78",
        "90,91,100": "90-91, 100",
        "9,1,2,1": "9, 1-2, 1",
    }
    got = evaluate(vectors, range_as_string(F.split(F.col(X), ",")))
    assert got == list(vectors.values())


def test_collaboration(evaluate):
    given = [" Mika Salo for the Kestrel Collaboration ", " Mika Salo for the development of ovens ", "The HERON collaborations"]
    rows = evaluate(given, text.collaboration_and_author(F.col(X)))
    assert [(r["collaboration"], r["author"]) for r in rows] == [
        ("Kestrel", "Mika Salo"),
        (given[1], None),
        ("HERON", None),
    ]


def test_journal_section(evaluate):
    rows = evaluate(["Physics Letters B", "", "Annals Section A"], text.journal_and_section(F.col(X)))
    assert [(r["journal_title"], r["section"]) for r in rows] == [
        ("Physics Letters", "B"), ("", ""), ("Annals", "A"),
    ]


def test_languages(evaluate):
    given = ["English", "cn", "Fre", "FRENCH", "o'hara-mix"]
    assert evaluate(given, text.language_name(F.col(X))) == [None, "Chinese", "French", "French", "O'Hara-Mix"]


def test_titles(evaluate):
    given = ["THE QCD AND LHC-PHYSICS OF jets", "THE QCD AND THE MUON", "a <sub>2</sub> B", " plain   words "]
    assert evaluate(given, text.clean_title(F.col(X))) == [
        "THE QCD AND LHC-PHYSICS OF jets", "The QCD and the Muon", "a $_{2}$ B", "Plain Words",
    ]


def test_markup(evaluate):
    given = ['<p class="a">x &lt; y &amp; z < 3 <mml>k</mml> <math display="block"><mi a="b">p</mi></math></p>']
    assert evaluate(given, text.clean_abstract(F.col(X))) == [
        "x &lt; y &amp; z &lt; 3 k <math><mi>p</mi></math>"
    ]
    assert evaluate(["<LABEL>1</LABEL> A  <b>B</b>"], text.clean_affiliation(F.col(X))) == ["A B"]
    assert evaluate(["a<i>b</i>", "<mi>x</mi><minor>y</minor>"], text.remove_tags(F.col(X), keep=["mi"])) == [
        "ab", "<mi>x</mi>y",
    ]
    assert evaluate(["a<i>b</i><b>c</b>"], text.remove_tags(F.col(X), which=["i"])) == ["ab<b>c</b>"]


def test_licenses(evaluate):
    def by_url(url):
        return [tuple(e) for e in evaluate([url], licenses.license_by_url(F.col(X)))[0]]

    url = "http://creativecommons.org/licenses/by/3.0/"
    assert by_url(url) == [("CC-BY-3.0", url)]
    assert by_url("http://example.org") == [("", "http://example.org")]
    assert by_url("") == [] and by_url(None) == []
    by_text = evaluate(["creative commons attribution 2.0", "no such", ""], licenses.license_by_text(F.col(X)))
    assert [[e["license"] for e in entries] for entries in by_text] == [["CC-BY-2.0"], [], []]
    cc_by = evaluate([url, "http://x.org/by/3.0"], licenses.cc_by_license(F.col(X)))
    assert cc_by[0]["license"] == "CC-BY-3.0" and cc_by[1] is None


def test_canonical_url(evaluate):
    vectors = {
        "HTTP://Example.COM:?b=2&a=1#top": "http://example.com/?a=1&b=2",
        "http://e.org/a b/%7Ex%2Fy?q=a+b&q=&z": "http://e.org/a%20b/~x%2Fy?q=&q=a+b&z=",
        "http://e.org/é?x=é": "http://e.org/%C3%A9?x=%C3%A9",
        "/only/path": "/only/path",
    }
    assert evaluate(vectors, urls.canonical_url(F.col(X))) == list(vectors.values())


def test_identifiers(evaluate):
    assert evaluate(["arXiv:1.2v3", "ARXIV:1.2"], ids.clean_arxiv(F.col(X), "versioned")) == ["1.2", "1.2"]
    assert evaluate(["arXiv:1.2v3"], ids.clean_arxiv(F.col(X), "prefix")) == ["1.2v3"]
    assert evaluate(["ORCID-0000", ""], ids.clean_orcid(F.col(X), "dashed")) == ["0000", None]
    assert evaluate(["10", "x"], ids.page_count(F.lit("3"), F.col(X))) == [8, None]
    assert [tuple(r) for r in evaluate(["1-5-6", "7"], ids.page_range(F.col(X)))] == [("1", "5-6"), ("7", "")]


def test_reducers(evaluate):
    split = F.split(F.col(X), ",")
    assert evaluate([",,b,c", ""], arrays.first_nonempty(split)) == ["b", None]
    assert evaluate([""], arrays.first_nonempty(split, "d")) == ["d"]
    assert evaluate(["a,b"], arrays.join_all(split)) == ["a b"]
    wrapped = evaluate(["a"], arrays.classification_numbers(split))[0]
    assert wrapped[0].asDict() == {"standard": "PACS", "classification_number": "a"}


def test_xml_helpers(evaluate):
    assert evaluate(["a<![CDATA[<b> & c]]>d"], xml._inline_cdata(F.col(X))) == ["a&lt;b&gt; &amp; cd"]
    given = ["&#x142;&#233;&#38;&#x3c;&#xZZ;&#55296;&#x1F600;"]
    assert evaluate(given, xml.decode_char_refs(F.col(X))) == ["łé&amp;&lt;&#xZZ;&#55296;😀"]
    assert evaluate(["A <i>b <u>c</u></i> D<br/>E"], xml.direct_text(F.col(X))) == [["A ", " D", "E"]]
    assert evaluate(["A <i>b</i> &amp;lt;"], xml.plain_text(F.col(X))) == ["A b &lt;"]


def test_dimension_sizes():
    sizes = {
        "APS_DOCTYPES": 12, "JATS_DOCTYPES": 6, "ELSEVIER_DOCTYPES": 36, "SPRINGER_DOCTYPES": 20,
        "ELSEVIER_JOURNALS": 2, "LICENSES": 3, "LICENSE_TEXTS": 4, "JOURNAL_FULL_NAMES": 10,
        "LANGUAGES": 38, "COMMON_ACRONYMS": 64, "MATHML_ELEMENTS": 31, "CONFERENCE_WORDS": 32,
        "THESIS_WORDS": 21, "SPRINGER_FOLDERS": 2,
    }
    for name, size in sizes.items():
        assert len(set(getattr(dims, name))) == size, name


def test_text_around_many_references_is_kept(evaluate):
    given = ["a; &#65;b; &#x0000000041;c &#66 d &#;", "\u0001&#67;", "&#12345678;&#x;"]
    expected = ["a; Ab; Ac &#66 d &#;", "\u0001C", "&#12345678;&#x;"]
    assert evaluate(given, xml.decode_char_refs(F.col(X))) == expected


def test_pieces_begin_with_opening_tags(evaluate):
    given = ["<?xml?><a-b/><a x='1'>1</a> <ab>2</ab>\n<a>3", "no", "\u0001<a>1</a><ab\n>2</ab>", ""]
    expected = [["<a x='1'>1</a> ", "<ab>2</ab>\n", "<a>3"], [], ["<a>1</a>", "<ab\n>2</ab>"], []]
    assert evaluate(given, xml.pieces(F.col(X), ["a", "ab"])) == expected
    whole = ["<a x='1'>1</a> ", "<ab>2</a></ab></a>", "<a>3</ab>", "<ac></a>", "x<a></a>"]
    expected = ["<a x='1'>1</a>", "<ab>2</a></ab>", None, None, None]
    assert evaluate(whole, xml.whole_element(F.col(X), ["a", "ab"])) == expected


def test_siblings_that_are_closed_with_space_or_marked(evaluate):
    given = [
        "<g><c><n/><g ><c>x</c ><k/></g></c></g>",
        "<g><c>1</c><c>2</c></g>",
        "<g><c><c/><g><c>\u0001</c></g></c></g>",
        "<g><c><g><c>x</g></c></g>",
    ]
    expected = ["<g><c><n/></c><k/><c>x</c></g>", given[1], given[2], given[3]]
    assert evaluate(given, xml.siblings(F.col(X), "c", "g")) == expected


def test_white_space_of_any_kind(evaluate):
    given = ["a b", " a  b ", "a  b\n", "é é", "", None]
    assert evaluate(given, text.clean_whitespace(F.col(X))) == ["a b", "a b", "a b", "é é", "", None]
    given = [" a b ", "a b", "é ", " ", "", None]
    assert evaluate(given, text.strip(F.col(X))) == ["a b", "a b", "é", "", "", None]


def test_files_are_split_once(spark):
    from sheaf.parsers.common import with_lineage
    from sheaf.sources.landing import split_articles

    files = with_lineage(spark.range(1).select(F.col("id").cast("string").alias("doc_id"), F.uuid().alias("payload")))
    split = split_articles(files, ["article", "simple-article"])
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    # A filter that is inferred for the explode would split the text again.
    assert "Filter" not in plan
    # Neither does a look-ahead at each character split texts without the mark.
    assert "regexp_replace" in plan


def test_lists_are_made_once(spark):
    """What is left of a list is asked of the list as made, and markup is looked at where there is some."""
    from sheaf.functions.arrays import empty_to_null

    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "x ARRAY<STRING>")
    made = df.select(empty_to_null(F.transform("x", lambda v: F.reverse(v))).alias("r"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1
    assert sorted(str(row["r"]) for row in made.collect()) == ["None", "None", "['a', 'b']"]
    titles = ["A  <sub>1</sub> <i>b</i>", "x & y", "Plain  One", "ALL CERN SUSY THINGS", None, " \u2009 "]
    got = [r["t"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i INT, t STRING")
           .orderBy("i").select(text.clean_title(F.col("t")).alias("t")).collect()]
    assert got == ["A $_{1}$ b", "X &amp; y", "Plain One", "All CERN SUSY Things", None, ""]
