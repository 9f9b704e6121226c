"""Terms of the lexicon are neither crowded out nor lost by their spelling."""

import random

from sheaf.llm import toxicity


def test_copies_of_one_text_do_not_crowd_out_terms(spark):
    rng = random.Random(51)
    plain = ["river", "stone", "light", "music", "table", "green", "window", "paper"]
    word = lambda: "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=10))
    copy = " ".join(word() for _ in range(700))
    texts = [(copy, 1)] * 150
    texts += [(" ".join([*rng.choices(plain, k=20), "gruntface", *rng.choices(plain, k=5)]), 1) for _ in range(60)]
    texts += [(" ".join(rng.choices(plain, k=30)), 0) for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id BIGINT, toxic INT")
    model = toxicity.fit(docs, labels)
    assert model.lexicon.match("gruntface")
    assert model.score("river gruntface stone") > model.score("river stone")


def test_misspelled_stems_and_short_terms_are_met():
    lexicon = toxicity.Lexicon(frozenset({"scum", "moron", "stupid", "worthless"}), frozenset({"idio", "grunt"}), frozenset({"snot"}))
    assert lexicon.match("idjotic") == ("idio", 1) and lexicon.match("scvm") == ("scum", 1)
    assert lexicon.match("grnted") == ("grunt", 1) and lexicon.match("river") is None
    assert toxicity.Lexicon(frozenset(), lexicon.stems, benign=frozenset({"idjotic"})).match("idjotic") is None
    for text, term in (("m0ron", "moron"), ("st*pid", "stupid"), ("worthle$s", "worthless"), ("id1otic", "idio")):
        assert [(h["term"], h["edits"]) for h in toxicity.hits(f"a {text} b", lexicon)] == [(term, 1)], text
    assert [h["edits"] for h in toxicity.hits("moron|stupid", lexicon)] == [0, 0]
