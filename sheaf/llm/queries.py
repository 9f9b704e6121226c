"""The registered queries of this subpackage, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import (
    collocations,
    decontaminate,
    fingerprints,
    html_text,
    jaccard,
    line_dedup,
    packing,
    pii,
    repair,
    secrets,
    sentencepiece,
    tokens,
    toxicity,
)
from sheaf.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

_JACCARD_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({_ASCII_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], chr(10)) AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON r.root = e.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM w JOIN r ON r.id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

_BENCHMARK_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT doc_id, dw.k, i, item FROM dw JOIN bw ON dw.k = bw.k AND dw.s = bw.s),
p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_COLLOCATIONS_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_ASCII_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
f AS (SELECT lang, s, k, count(*) AS a
      FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k))
      GROUP BY lang, s, k HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, s, a, string_split(s, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, s, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, len(w))) AS k FROM c)),
scored AS (SELECT cut.lang, cut.s, cut.a, cut.k, x.a AS l, y.a AS r, (2000000::HUGEINT * cut.a) // (x.a + y.a) AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.s = first JOIN f y ON y.lang = cut.lang AND y.s = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
held AS (SELECT lang, s, max(a) AS longer
         FROM (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS s
               FROM (SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE len(w) > m))
         GROUP BY lang, s),
ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.s) AS rank, b.s AS phrase, b.a, l, r, score
           FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.s = b.s WHERE h.longer IS NULL OR 100::HUGEINT * h.longer < 80::HUGEINT * b.a)
SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def n_of(spans: Column, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("bigint")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    base = of_kinds(found, ["assign", "access", "hex"])
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(n_of(found, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(found).alias("spans"),
        n_of(found, "novel").alias("n_novel"),
    )


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = tokens.token_counts(table(spark, sf_dir, "documents"), str(path))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op10_decontaminate", _BENCHMARK_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), hit).alias("contaminated"),
    )


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.extract(pages, html_text.learn(pages))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = F.col("found")
    base = F.filter(found, lambda s: s["base"])
    return pii.scan(documents, pii.fit(documents)).select(
        "doc_id",
        *(n_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(found).alias("spans"),
        (F.size(found) - F.size(base)).cast("bigint").alias("n_added"),
    )


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(documents, toxicity.fit(documents, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


@query("op11_collocations", _COLLOCATIONS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_texts(table(spark, sf_dir, "documents"), path, 1)


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repaired(conversations, repair.damaged(conversations))


@query("op4_jaccard_join", _JACCARD_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    documents = table(spark, sf_dir, "documents")
    return sentencepiece.round_trip(documents, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "restored"
    )


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that keeps lines, with what is left of it."""
    documents = table(spark, sf_dir, "documents")
    dropped = line_dedup.duplicate_lines(documents)
    return line_dedup.without_lines(documents, dropped, n_chars="n_chars")
