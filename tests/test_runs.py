"""Sources, sinks, runs and streams on files of the test's own."""

import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

import sheaf
from sheaf.operators.children import explode_affiliations, explode_authors
from sheaf.operators.ranges import adjacent_ranges, integer_ranges
from sheaf.plans.harvest import harvest, harvest_documents, in_window, next_from_date
from sheaf.plans.normalise import normalise, take_first
from sheaf.sources import landing, manifest, packages, sinks
from sheaf.streaming import stream_harvest


def marc(number, title="A Title"):
    return (
        '<record><metadata><marc:record xmlns:marc="m"><marc:controlfield tag="001">'
        f'{number}</marc:controlfield><marc:datafield tag="024" ind1="7"><marc:subfield code="a">10.1/{number}</marc:subfield>'
        '<marc:subfield code="2">DOI</marc:subfield></marc:datafield><marc:datafield tag="245">'
        f'<marc:subfield code="a">{title}</marc:subfield></marc:datafield></marc:record></metadata></record>'
    )


def feed(*numbers):
    return f"<?xml version='1.0'?><OAI-PMH><ListRecords>{''.join(map(marc, numbers))}</ListRecords></OAI-PMH>"


def test_feed_is_split_across_tasks(spark, tmp_path):
    """A single feed file is read by several tasks and no record is lost."""
    (tmp_path / "feed.xml").write_text(feed(*range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = landing.read_feed(spark, str(tmp_path), "marc:record")
        assert records.rdd.getNumPartitions() > 2
        got = sheaf.harvest_documents(records, "hindawi").select("control_number").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(int(r[0]) for r in got) == list(range(500))


def test_harvest_run(spark, tmp_path):
    inbox, results = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.xml").write_text(feed(1, 2))
    (inbox / "b.xml").write_text(feed(3).replace("</marc:datafield>", "", 1))
    entry = sheaf.harvest(spark, "hindawi", str(inbox), results, run_id="r1").first()
    assert (entry["n_records"], entry["n_errors"], entry["status"]) == (2, 1, "success")
    sheaf.harvest(spark, "hindawi", str(inbox), results, run_id="r1")
    assert sorted(r["control_number"] for r in sinks.read_records(spark, results).collect()) == ["1", "2"]
    bad = sinks.read_quarantine(spark, results).collect()
    assert [(b["run_id"], b["error"]) for b in bad] == [("r1", "malformed XML")]
    assert sinks.read_runs(spark, results).count() == 1
    # Nothing has landed since tomorrow, and everything had by then.
    late = sheaf.harvest(spark, "hindawi", str(inbox), results, run_id="r2", from_date="2999-01-01").first()
    assert late["n_records"] == 0
    assert next_from_date(sinks.read_runs(spark, results), "hindawi") == str(entry["started_at"].date())
    assert next_from_date(sinks.read_runs(spark, results), "hindawi", "2020-01-01") == "2020-01-01"
    assert next_from_date(sinks.read_runs(spark, results), "IOP") is None


def test_stream_takes_files_once(spark, tmp_path):
    inbox, results, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    inbox.mkdir()

    def run():
        stream_harvest(spark, "hindawi", str(inbox), results, checkpoint, "s").awaitTermination()
        return sorted(r["control_number"] for r in sinks.read_records(spark, results).collect())

    (inbox / "a.xml").write_text(feed(1, 2))
    (inbox / "bad.xml").write_text(feed(9).replace("</marc:datafield>", "", 1))
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    (inbox / "b.xml").write_text(feed(3))
    assert run() == ["1", "2", "3"]
    assert sinks.read_quarantine(spark, results).count() == 1
    assert sinks.read_runs(spark, results).agg(F.sum("n_records")).first()[0] == 3


def iop_article(number):
    return f"""<article article-type="research-article"><front><article-meta><article-id pub-id-type="doi">10.2/{number}</article-id>
      <pub-date><year>2020</year></pub-date></article-meta></front></article>"""


@pytest.fixture
def archives(tmp_path):
    folder = tmp_path / "packages"
    folder.mkdir()
    with zipfile.ZipFile(folder / "one.zip", "w") as z:
        z.writestr("d/a.xml", iop_article(1))
        z.writestr("d/a.pdf", "%PDF")
        z.writestr("d/.hidden.xml", "x")
        z.writestr("../evil.xml", "x")
    with tarfile.open(folder / "two.tar", "w") as t:
        data = iop_article(2).encode()
        info = tarfile.TarInfo("e/b.xml")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    (folder / "broken.zip").write_bytes(b"no archive")
    (folder / ".three.zip").write_bytes(b"hidden")
    (folder / "go.xml").write_text("control")
    return folder


def test_unpack(spark, archives):
    read = packages.read_packages(spark, str(archives))
    members = packages.unpack(read, (".xml",)).cache()
    rows = packages.documents(members).collect()
    ok = [r for r in rows if r["landing_error"] is None]
    assert sorted(r["member_path"] for r in ok) == ["d/.hidden.xml", "d/a.xml", "e/b.xml"]
    errors = {r["landing_error"].split(":")[0] for r in rows if r["payload"] is None}
    assert errors == {"unsafe member name", "unreadable package"}
    assert packages.unpack(read).count() == 6


def test_archives_are_opened_by_the_tasks(spark, tmp_path):
    """Whatever their names are; the driver gets no list of new ones, and no content is read for the listing."""
    folder = tmp_path / "in"
    folder.mkdir()
    names = ["a b.zip", "c%20d.zip", "é+#&.zip", "sub/e.zip"]
    for name in names:
        (folder / name).parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(folder / name, "w") as z:
            z.writestr("m.xml", name)
    for where in (str(folder), f"file://{folder}"):
        landed = landing.list_packages(spark, where).where(F.col("path").contains("a b")).select("path")
        new = packages.read_packages(spark, where, landed)
        assert "content" not in new.columns
        plan = new._jdf.queryExecution().optimizedPlan().toString()
        assert "content" not in plan.split("Join")[0]
        rows = packages.documents(packages.unpack(new, (".xml",))).collect()
        assert sorted(r["payload"] for r in rows) == sorted(names[1:])
        assert all(r["landing_error"] is None for r in rows)
    assert not packages.can_open("viewfs://store/in")


def test_archives_in_a_store_of_spark(spark, tmp_path, monkeypatch):
    """Where tasks cannot open paths, Spark's reader hands on the content: the same members."""
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as z:
            z.writestr("m.xml", str(i))
    monkeypatch.setattr(packages, "can_open", lambda path: False)
    listed = landing.list_packages(spark, str(tmp_path))
    landed = listed.where(F.col("path").endswith("1.zip")).select("path")
    read = packages.read_packages(spark, str(tmp_path), landed)
    assert sorted(r["payload"] for r in packages.documents(packages.unpack(read)).collect()) == ["0", "2"]


def test_documents_are_dealt_by_bytes(spark):
    docs = spark.range(10).selectExpr("id", "string(id) payload")
    assert "RebalancePartitions" in landing.spread(docs)._jdf.queryExecution().optimizedPlan().toString()


def test_a_manifest_is_parsed_once(spark):
    """One parse each of manifest elements, issue entries and articles."""
    from sheaf.plans.harvest import harvest_documents

    docs = spark.createDataFrame(
        [("/in/P.zip", "P/dataset.xml", "<dataset/>")], "package_path STRING, member_path STRING, payload STRING"
    ).withColumns({"doc_id": F.col("member_path"), "landing_error": F.lit(None).cast("string")})
    plan = harvest_documents(docs, "Elsevier")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 3


def test_skip_existing(spark, archives):
    listed = landing.list_packages(spark, str(archives))
    assert listed.count() == 3
    landed = listed.where(F.col("path").contains("one")).select("path")
    new = packages.read_packages(spark, str(archives), landed).select("path")
    assert sorted(r[0].split("/")[-1] for r in new.collect()) == ["broken.zip", "two.tar"]
    assert packages.read_packages(spark, str(archives), landed, force=True).count() == 3
    flags = {r["path"].split("/")[-1]: r["missing"] for r in landing.all_and_missing(listed, landed).collect()}
    assert flags == {"one.zip": False, "two.tar": True, "broken.zip": True}


def test_package_harvest(spark, archives, tmp_path):
    entry = sheaf.harvest(spark, "IOP", str(archives), str(tmp_path / "out"), run_id="p").first()
    assert (entry["n_records"], entry["n_errors"]) == (2, 2)
    bad = {r["error"].split(":")[0] for r in sinks.read_quarantine(spark, str(tmp_path / "out")).collect()}
    assert bad == {"unsafe member name", "unreadable package"}
    records = sinks.read_records(spark, str(tmp_path / "out")).orderBy("path").collect()
    files = {f["value"]["filetype"]: f["value"]["path"].split("/packages/")[1] for f in records[0]["local_files"]}
    assert files == {"xml": "one.zip/d/a.xml", "pdf": "one.zip/d/a.pdf"}


def test_package_stream(spark, archives, tmp_path):
    results = str(tmp_path / "out")
    stream_harvest(spark, "IOP", str(archives), results, str(tmp_path / "cp"), "ps").awaitTermination()
    assert sinks.read_records(spark, results).count() == 2


def test_manifest_package_harvest(spark, tmp_path):
    """Packages with a manifest, as a run and as a stream."""
    folder = tmp_path / "els"
    folder.mkdir()
    gone = "<journal-item><journal-item-unique-ids><doi>10.5/gone</doi></journal-item-unique-ids></journal-item>"
    dataset = "<dataset>" + gone + """<journal-item><journal-item-unique-ids><doi>10.5/x</doi><jid-aid><jid>PLB</jid></jid-aid>
      </journal-item-unique-ids><files-info><ml><pathname>a.xml</pathname></ml><web-pdf><pathname>a/main.pdf</pathname></web-pdf>
      </files-info></journal-item></dataset>"""
    article = "<article docsubtype='fla'><item-info><ce:doi>10.5/x</ce:doi></item-info><head><ce:title>T</ce:title></head></article>"
    with zipfile.ZipFile(folder / "vtex1.zip", "w") as z:
        z.writestr("vtex1/dataset.xml", dataset)
        z.writestr("vtex1/a.xml", article)
        z.writestr("vtex1/b.xml", article.replace("10.5/x", "10.5/unlisted"))
    results = str(tmp_path / "out")
    entry = sheaf.harvest(spark, "Elsevier", str(folder), results, run_id="e", as_of="2020-01-01").first()
    assert (entry["n_records"], entry["n_errors"]) == (1, 2)
    stream_harvest(spark, "Elsevier", str(folder), results, str(tmp_path / "cp"), "es", as_of="2020-01-01").awaitTermination()
    for record in sinks.read_records(spark, results).collect():
        assert (record["journal_title"], record["date_published"]) == ("Physics Letters B", "2020-01-01")
        paths = {f["value"]["filetype"]: f["value"]["path"] for f in record["local_files"]}
        assert paths == {"xml": "vtex1/a.xml", "pdf": "vtex1/a/main.pdf", "pdfa": "vtex1/a/main_a-2b.pdf"}
    assert {r["error"] for r in sinks.read_quarantine(spark, results).collect()} == {
        "DOI not in manifest", "item without article file",
    }


def test_routes(spark):
    members = spark.createDataFrame(
        [("/in/x.xml.zip", "a/b.xml"), ("/in/x.pdf.zip", "a/b.pdf"), ("/in/x.xml.zip", "a/b.xml.Meta"), ("/in/y.zip", "a/c.xml.scoap")],
        "package_path STRING, member_path STRING",
    ).withColumns({"path": F.concat_ws("/", "package_path", "member_path"), "landing_error": F.lit(None).cast("string")})
    oup = landing.route_oup(members).collect()
    assert [(r["member_path"], r["pdfa_path"]) for r in oup] == [("a/b.xml", "/in/x.xml.zip/a/archival/b.pdf")]
    springer = {r["member_path"]: r["pdfa_path"] for r in landing.route_springer(members).collect()}
    assert springer == {
        "a/b.xml.Meta": "/in/x.xml.zip/a/BodyRef/PDF/b.pdf",
        "a/c.xml.scoap": "/in/y.zip/a/BodyRef/PDF/c.pdf",
    }


def test_manifest_keeps_each_issue(spark):
    """Every manifest and issue of a package counts; copies do not multiply."""
    def dataset(*issues):
        parts = "".join(
            f"<journal-issue><journal-issue-properties><volume-issue-number><vol-first>{v}</vol-first><suppl>C</suppl></volume-issue-number>"
            f"</journal-issue-properties><files-info><ml><pathname>{f}</pathname></ml></files-info></journal-issue>" for v, f in issues
        )
        items = "".join(
            f"<journal-item><journal-item-unique-ids><doi>10.5/{v}</doi><jid-aid><jid>PLB</jid></jid-aid></journal-item-unique-ids></journal-item>"
            for v, _ in issues
        )
        return f"<dataset>{parts}{items}</dataset>"

    def issue(*dois):
        return "<issue>" + "".join(f"<include-item><doi>{d}</doi></include-item>" for d in dois) + "</issue>"

    rows = [
        ("/in/P.zip", "P/1/dataset.xml", dataset((1, "i1.xml"), (2, "i2.xml"))),
        ("/in/P.zip", "P/2/dataset.xml", dataset((3, "i3.xml"))),
        ("/in/P.zip", "P/i1.xml", issue("10.5/1", "10.5/1", "10.5/gone")),
        ("/in/P.zip", "P/i2.xml", issue("10.5/2", "10.5/1")),
        ("/in/P.zip", "P/i3.xml", issue("10.5/3")),
    ]
    docs = spark.createDataFrame(rows, "package_path STRING, member_path STRING, payload STRING")
    listed = manifest.build_manifest(docs, as_of="2020-01-01").collect()
    assert sorted((r["doi"], r["volume"]) for r in listed) == [("10.5/1", "1 C"), ("10.5/2", "2 C"), ("10.5/3", "3 C")]
    orphans = manifest.listed_articles(docs).where("not is_item").collect()
    assert [(r["doi"], r["volume"], r["problem"]) for r in orphans] == [("10.5/gone", "1 C", "issue lists a DOI without item")]
    problems = sorted((r["doi"], r["error"].split()[0]) for r in manifest.manifest_problems(docs).collect())
    assert problems == [("10.5/1", "item"), ("10.5/2", "item"), ("10.5/3", "item"), ("10.5/gone", "issue")]


def brute_ranges(values):
    runs = []
    for v in sorted(set(values)):
        if runs and runs[-1][1] + 1 == v:
            runs[-1][1] = v
        else:
            runs.append([v, v])
    return [tuple(r) for r in runs]


def test_integer_ranges_across_buckets(spark):
    """A hot key whose runs span many buckets gives the brute-force result."""
    values = [v for v in range(-40, 400) if v % 37 and not 100 < v < 103] * 2
    df = spark.createDataFrame([("hot", v) for v in values] + [("cold", 5)], "k STRING, v INT")
    got = integer_ranges(df, ["k"], "v", width=8).collect()
    assert sorted((r["lo"], r["hi"]) for r in got if r["k"] == "hot") == brute_ranges(values)
    assert [(r["lo"], r["hi"]) for r in got if r["k"] == "cold"] == [(5, 5)]


def test_adjacent_ranges_follow_positions(spark):
    data = [7, 8, 9, 1, 2, 10, 11]
    df = spark.createDataFrame(list(enumerate(data)), "pos INT, v INT")
    got = sorted((r["first_position"], r["lo"], r["hi"]) for r in adjacent_ranges(df, [], "pos", "v", width=2).collect())
    assert got == [(0, 7, 9), (3, 1, 2), (5, 10, 11)]


def test_windows_and_children(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2020-01-01 23:59:00', 'a', 's'), (TIMESTAMP '2020-01-02 00:00:00', 'b', 't') AS t(at, j, s)")
    assert in_window(df, "at", "2020-01-01", "2020-01-01").count() == 1
    assert in_window(df, "at", journals=["b"], journal="j", sets=["s"], set_name="s").count() == 0
    docs = spark.createDataFrame([("d", marc(1).replace('tag="245"', 'tag="100"'))], "doc_id STRING, payload STRING")
    docs = landing.split_nodes(docs, ["marc:record"])
    records = sheaf.harvest_documents(docs, "hindawi")
    authors = explode_authors(records).collect()
    assert [(a["seq"], a["full_name"]) for a in authors] == [(0, "Title, A")]
    assert explode_affiliations(records).count() == 0


def test_own_source_and_rules(spark):
    def parse(documents):
        return documents.select(
            F.lit("own").alias("spider"), "doc_id", F.lit(None).cast("string").alias("error"), F.col("payload").alias("title")
        )

    sheaf.register_source(sheaf.SourceSpec("own", parse, rules={"title": take_first(F.upper)}))
    docs = spark.createDataFrame([("d", "some title")], "doc_id STRING, payload STRING")
    assert sheaf.harvest_documents(docs, "own").first()["title"] == "SOME TITLE"
    assert normalise(parse(docs)).first()["title"] == "Some Title"
    assert "own" in sheaf.sources()
    with pytest.raises(KeyError):
        sheaf.source("absent")


def test_json_sink(spark, tmp_path):
    docs = landing.split_nodes(
        spark.createDataFrame([("d", feed(1, 2))], "doc_id STRING, payload STRING"), ["marc:record"]
    )
    records = sheaf.harvest_documents(docs, "hindawi").drop("payload")
    assert sinks.write_json(records, str(tmp_path / "json")) == 2
    lines = [json.loads(l) for f in (tmp_path / "json" / "spider=hindawi").glob("*.json") for l in f.read_text().splitlines()]
    assert sorted(l["control_number"] for l in lines) == ["1", "2"]


def test_cut_off_feed_records_are_errors(spark, tmp_path):
    record = '<marc:record><controlfield tag="001">{}</controlfield><datafield tag="245"><subfield code="a">T</subfield></datafield>'
    whole, cut = record + "</marc:record>", record
    text = "\ufeff \n<?xml version='1.0'?><collection>" + cut.format(1) + whole.format(2) + whole.format(3) + cut.format(4)
    (tmp_path / "feed.xml").write_text(text)
    rows = landing.read_feed(spark, str(tmp_path), "marc:record").collect()
    assert sorted((r["payload"].split("001\">")[1][0], r["landing_error"]) for r in rows) == [
        ("1", "truncated record"), ("2", None), ("3", None), ("4", "truncated record"),
    ]
    records = harvest_documents(landing.read_feed(spark, str(tmp_path), "marc:record"), "hindawi").collect()
    assert sorted(str(r["error"]) for r in records) == ["None", "None", "truncated record", "truncated record"]


def test_bare_tags_of_feeds(spark, tmp_path):
    text = "<?xml version='1.0'?><ArticleSet><Article><ArticleTitle>A</ArticleTitle></Article><Article><ArticleTitle>B</ArticleTitle></ArticleSet>"
    (tmp_path / "feed.xml").write_text(text)
    rows = landing.read_feed(spark, str(tmp_path), "Article", bare=True).collect()
    assert sorted((r["payload"][:31], r["landing_error"]) for r in rows) == [
        ("<Article><ArticleTitle>A</Artic", None), ("<Article><ArticleTitle>B</Artic", "truncated record"),
    ]


def _land_packages(folder, names):
    import zipfile

    article = (
        "<article><front><article-meta><article-id pub-id-type='doi'>10.1088/{}</article-id><permissions>"
        "<license href='http://creativecommons.org/licenses/by/3.0/'/></permissions></article-meta></front></article>"
    )
    for name in names:
        with zipfile.ZipFile(folder / f"{name}.zip", "w") as archive:
            archive.writestr(f"{name}/{name}.xml", article.format(name))


def test_packages_are_taken_once(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    _land_packages(inbox, ["a", "b"])
    counts = lambda entry: entry.first()["n_records"]
    assert counts(harvest(spark, "IOP", str(inbox), root, "007")) == 2
    assert counts(harvest(spark, "IOP", str(inbox), root, "2")) == 0
    _land_packages(inbox, ["c"])
    assert counts(harvest(spark, "IOP", str(inbox), root, "3", incremental=True)) == 1
    assert counts(harvest(spark, "IOP", str(inbox), root, "4", force=True)) == 3
    assert counts(harvest(spark, "IOP", str(inbox), root, "5", force=True, from_date="2999-01-01")) == 0
    with pytest.raises(ValueError):
        harvest(spark, "IOP", str(inbox), root, "6", journals=["X"])
    dois = sinks.read_dois(spark, root)
    assert {r["doi"] for r in dois.where("run_id = '007'").collect()} == {"10.1088/a", "10.1088/b"}
    assert {r["run_id"] for r in sinks.read_runs(spark, root).collect()} == {"007", "2", "3", "4", "5"}


def test_errors_of_a_run_are_kept(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "bad.zip").write_bytes(b"no archive")
    _land_packages(inbox, ["a"])
    harvest(spark, "IOP", str(inbox), root, "r", stages=[(1, lambda df: df.withColumn("extra", F.lit(1)))])
    harvest(spark, "IOP", str(inbox), root, "s", force=True)
    errors = sinks.read_errors(spark, root).where("run_id = 'r'").collect()
    assert [(r["stage"], r["error"].split(":")[0]) for r in errors] == [("landing", "unreadable package")]
    assert sinks.read_records(spark, root).where("run_id = 'r'").select("extra").first()["extra"] == 1


def test_pages_by_date_journal_and_set(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    article = lambda i, day, journal, area: {
        "identifiers": {"doi": f"10.9/{i}"}, "date": day, "journal": {"name": journal},
        "classificationSchemes": {"subjectAreas": [{"id": "x", "label": area}]},
    }
    data = [article(1, "2020-01-01", "J", "S"), article(2, "2020-02-01", "J", "T"), article(3, "2020-02-01", "K", "S")]
    (inbox / "page.json").write_text(json.dumps({"data": data}))
    for number, (options, n) in enumerate(
        [({}, 3), ({"published": ("2020-01-15", None)}, 2), ({"journals": ["J"]}, 2), ({"sets": ["S"]}, 2),
         ({"published": (None, "2020-01-31"), "sets": ["S"], "journals": ["J"]}, 1)]
    ):
        entry = harvest(spark, "APS", str(inbox), str(tmp_path / f"out{number}"), "r", **options)
        assert entry.first()["n_records"] == n


def test_ranges_over_three_levels(spark):
    from sheaf.operators.ranges import integer_ranges

    spans = [(-70, 300), (302, 302), (1000, 1063), (4096, 5000), (5002, 5003)]
    rows = [("k", v) for lo, hi in spans for v in range(lo, hi + 1)]
    df = spark.createDataFrame(rows, "k STRING, v BIGINT")
    for keys in (["k"], []):
        for width in (4, 8, 64):
            got = sorted((r["lo"], r["hi"]) for r in integer_ranges(df, keys, "v", width).collect())
            assert got == spans


def test_only_runs_at_an_edge_are_stitched(spark, monkeypatch):
    """What is whole within a bucket is not sorted with the others; every bit of a bucket and NULL are kept."""
    from sheaf.operators import ranges

    seen, stitch = [], ranges._stitch

    def counted(runs, *rest):
        seen.append(runs.count())
        return stitch(runs, *rest)

    monkeypatch.setattr(ranges, "_stitch", counted)
    values = [v for v in range(-640, 6400) if v % 3] + list(range(7000, 7300)) + [7999, 8000, 8063, 8064]
    df = spark.createDataFrame([("k", v) for v in [*values, *values[::2], None]], "k STRING, v BIGINT")
    got = sorted((r["lo"], r["hi"]) for r in ranges.integer_ranges(df, ["k"], "v", 64).collect() if r["lo"] is not None)
    assert got == brute_ranges(values)
    assert ranges.integer_ranges(df, ["k"], "v", 64).where("lo IS NULL AND hi IS NULL").count() == 1
    assert seen[0] < len(got) / 8


def test_look_up_does_not_shuffle_the_facts(spark):
    from sheaf import dims
    from sheaf.operators.lookups import translate_codes

    df = spark.range(10).selectExpr("CAST(id AS STRING) AS lang")
    plan = translate_codes(df, dims.as_table(spark, dims.LANGUAGES), "lang", "name")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
