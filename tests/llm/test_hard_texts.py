"""Very long and malformed texts, and tables with odd columns: nothing crashes and nothing takes quadratic time."""

import random
import resource
import time

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from sheaf.llm import fingerprints, html_text, line_dedup, pii, secrets, sentencepiece

SF = "/root/testdata/sf0.001"


def seconds(work, *args):
    start = time.process_time()
    work(*args)
    return time.process_time() - start


@pytest.mark.parametrize(
    "part", ["token and ", "secret", "auth=", "password: x ", "auth" + "a1" * 30 + "\n", "deadbeef01234567 token ", "AKIA"]
)
def test_secrets_in_a_megabyte(part):
    assert seconds(secrets.find, part * (1_000_000 // len(part))) < 120


@pytest.mark.parametrize(
    "part", ["<a ", "<", "<!", "<?", "<!--", "<a '", '<a "x', "<div>", "<div>x", "<p><b>", "</x>", "<b></x>", "<li>", "&amp", "<script>", "<p"]
)
def test_pages_of_a_megabyte(part):
    page = part * (1_000_000 // len(part))
    assert seconds(html_text.main_text, page, {}) < 60
    assert seconds(html_text.main_text, page + ">" + page.replace("<", "</"), {}) < 90


def test_nested_elements_keep_what_is_around_them():
    title, body, end = ("word%d " % i * 20 for i in range(3))
    page = f"<article><header><h1>{title}</h1></header>" + "<div>" * 100_000 + f"<p>{body}</p>" + "</div>" * 100_000
    page += f"<aside><div><p>Not this</p></div></aside><p>{end}</p></article><footer>F</footer>"
    assert html_text.main_text(page, {}) == "\n\n".join(t.strip() for t in (title, body, end))


def test_long_runs_of_zeros_in_an_address():
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}1.{zeros}.2.255") == [(0, len(zeros) * 2 + 8, "ip")]
    assert pii.base_spans(f"{zeros}1.{zeros}.2.256") == []


def test_digits_in_little_memory():
    """The field's arrays for 200,000 digits, each a token: well below what objects would take."""
    rng = random.Random(3)
    text = " ".join(rng.choices("0123456789", k=100_000))
    weights = {("card", "bias"): -1.0, ("phone", "digits=8"): 0.5}
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pii.Field(weights).find(text)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) < 300_000


def test_decoding_by_arrays_is_that_by_tables():
    rng = random.Random(5)
    features = ["bias", "solid", "blanks", "shape=9", "digits=2", "digits=8", "shut", "shape=9-9"]
    weights = {(k, f): rng.uniform(-2, 2) for k in pii.KINDS for f in features}
    weights |= {("after " + a, b): rng.uniform(-1, 1) for a in ("O", *pii.KINDS) for b in pii.KINDS}
    model = pii.Field(weights)
    for _ in range(300):
        text = "".join(rng.choice(["12", "3", "4567", " ", "-", ".", "ab", "@", "+49", "\n"]) for _ in range(rng.randint(1, 40)))
        for tokens in pii.islands(text):
            segments = model.segments(text, tokens)
            got = model.decode(text, tokens)
            assert [s[:3] for s in got] == (model.best(len(tokens), segments) if segments else [])
            sure = {(i, j, k): p for i, j, k, p in model.marginals(len(tokens), segments)} if segments else {}
            assert all(abs(sure[s[:3]] - s[3]) < 1e-9 for s in got)


def test_fingerprints_of_documents_with_text_ids(spark):
    df = spark.createDataFrame([("a", "x y z"), ("7", "b"), (None, None), ("a", "x y z")], "doc_id STRING, text STRING")
    rows = fingerprints.edited_fingerprints(df).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["7", "None", "a", "a"]
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == "a"}) == 1


def test_lines_of_white_space_are_blank(spark):
    df = spark.createDataFrame([(1, "same long line here"), (2, "same long line here\n\t\t\n\u00a0\x1c")], "doc_id BIGINT, text STRING")
    kept = line_dedup.without_lines(df, line_dedup.duplicate_lines(df)).collect()
    assert [(r["doc_id"], r["text"]) for r in kept] == [(1, "same long line here")]


CLASHING = "__lines __kept __doc __mark __text __hits __items __id score hits items n_words row own ids n_pieces restored mark lines kept".split()


@pytest.mark.parametrize("number", range(5))
def test_stages_keep_columns_of_any_name(spark, number):
    """Nulls, repeated rows, empty and very long texts, with columns of all names that operators use inside."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40")
    odd = spark.createDataFrame(
        [(900, None, None, None, None), (901, "", "en", "s", 0), (901, "", "en", "s", 0), (None, "some text", "en", "s", 9),
         (902, "long words of a text. " * 20_000, "en", "s", 440_000)],
        docs.schema,
    )
    docs = docs.unionByName(odd)
    plain_rows = corpus_pipeline.STAGES[number][1](spark, docs, SF)
    more = docs.withColumns({c: F.lit(c) for c in CLASHING})
    rows = corpus_pipeline.STAGES[number][1](spark, more, SF)
    assert len(set(rows.columns)) == len(rows.columns)
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, rows.select("doc_id", "text").collect())) == sorted(map(key, plain_rows.select("doc_id", "text").collect()))
    if number < 4:
        assert rows.columns == more.columns
        first = rows.first()
        assert all(first[c] == c for c in CLASHING)


def test_round_trips_are_what_encode_and_decode_give(spark):
    import public_tokenizers

    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(8)
    texts = [None, "", " ", "  a  b ", "a b", "▁x", "x▁ y", "é 漢 😀 word, word. word\nline", "ab " * 5000]
    texts += ["".join(rng.choices("ab é.\n 漢", k=rng.randint(1, 60))) for _ in range(200)]
    own = sentencepiece.pieces(model)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    for r in sentencepiece.round_trip(df, model).collect():
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == (own.encode(text) if text else [])
        assert r["restored"] == ((own.decode(r["ids"]) if text else "") == text)
