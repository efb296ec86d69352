"""The registered queries of this subpackage: thin digests of its operators' outputs."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspark.llm import (
    collocations,
    decontamination,
    kmeans_tree,
    language_id,
    main_text,
    ngram_join,
    packing,
    periodic_runs,
    personal_data,
    suffix_tree,
    token_counts,
    token_files,
    tool_calls,
    tool_messages,
)
from clearspark.llm.tokenizer_files import vocabulary
from clearspark.session import fresh_folder, landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_token_files(spark, folder):
    """Each document as the index finds it in the shard files."""
    docs = table(spark, folder, "documents")
    path = fresh_folder(spark, "token-files")
    token_files.write(docs, path, vocabulary("byte_bpe_50k.json"), end_id=0)
    rows = landed(token_files.records(spark, path), "token-records")
    indexed = landed(token_files.index(rows), "token-index")
    found = token_files.located(indexed, rows, docs.select(F.col("doc_id").cast("string").alias("key")))
    return token_files.with_starts(found, rows).select(
        F.col("key").cast("bigint").alias("doc_id"), "start", "n_tokens", "ids_crc32"
    )


@query
def op2_tool_calls(spark, folder):
    """Each tool call of the conversations, linked to its result, with its level and canonical message."""
    messages = tool_messages.tool_messages(table(spark, folder, "conversations"))
    linked = tool_calls.link(messages, tool_messages.SCHEMAS)
    return linked.select(
        F.col("conv").alias("conv_id"),
        "turn",
        "position",
        F.col("id").alias("call_id"),
        "name",
        "level",
        "status",
        F.array_join("faults", "; ").alias("faults"),
        "result_turn",
        "results",
        F.sha2("message", 256).alias("message_sha256"),
    )


@query
def op3_personal_data(spark, folder):
    """The personal data in each document and the terms that reveal it."""
    found = personal_data.find(table(spark, folder, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@query
def op4_token_counts(spark, folder):
    """Bytes and tokens of each document."""
    return token_counts.count_tokens(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def id_remainder(parts: int):
    """crc32 of the doc_id as text, modulo `parts`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


@query
def op5_language_id(spark, folder):
    """The language of each document, learned from four fifths of them."""
    docs = table(spark, folder, "documents")
    held = id_remainder(5) == 0
    model = language_id.fit(docs.filter(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return language_id.identify(rows, model, keep=["doc_id", "held_out"])


@query
def op6_ngram_join(spark, folder):
    """Each document's number of four-word shingles and its group of near copies."""
    return ngram_join.near_duplicates(table(spark, folder, "documents"), width=4, percent=85)


@query
def op7_packing(spark, folder):
    """Each piece of each document and its place in a sequence."""
    return packing.pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1)


@query
def op8_kmeans_tree(spark, folder):
    """The 20 nearest vectors of every twentieth one by inner product."""
    return kmeans_tree.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op9_decontamination(spark, folder):
    """Each benchmark item that a document holds, with the scores of its best passage."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontamination.with_leaks(docs, items, keep=["doc_id"])
    leak = found.select("doc_id", F.explode("leaks").alias("leak"))
    return leak.select("doc_id", "leak.item_id", "leak.overlap", "leak.score", "leak.question", "leak.answer")


@query
def op10_suffix_tree(spark, folder):
    """Each document's score under a suffix tree and under single-token counts."""
    docs = table(spark, folder, "documents")
    held = id_remainder(7) == 2
    model = suffix_tree.fit(docs.filter(~held))
    return suffix_tree.score(docs.withColumn("held_out", held), model, keep=["doc_id", "held_out"], trained=~F.col("held_out"))


@query
def op11_collocations(spark, folder):
    """Each language's first 2000 phrases by how much more often their parts meet than they stand apart."""
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op12_main_text(spark, folder):
    """The main text of each page."""
    pages = table(spark, folder, "pages")
    return main_text.extract(pages, main_text.fit(pages), keep=["page_id", "url"])


def repeating(doc_id, text):
    """Where h = crc32(doc_id) is a multiple of 10, the words from a = h//10 % n on repeat their first p ones; a null id's text stays."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        # Bound once a row, as are the words: lambdas evaluate what they close over for each item.
        return F.get(F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda own: F.array_join(F.transform(words, lambda word, i: F.when(
            i >= own["a"], F.get(words, (own["a"] + (i - own["a"]) % own["p"]).cast("int"))).otherwise(word)), " ")), 0)

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    altered = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), 0)
    return F.when((h % 10 == 0) & text.isNotNull(), altered).otherwise(text)


@query
def op13_periodic_runs(spark, folder):
    """The runs of each document's words, the longest one, and the text that they collapse to."""
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find(docs, keep=["doc_id"])
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(ranked)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES["op6_ngram_join"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
    FROM split),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM grams a JOIN grams b ON a.t = b.t AND a.doc_id <> b.doc_id
    GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (
    SELECT doc_id, doc_id AS root FROM sets
    UNION
    SELECT links.y, reached.root FROM reached JOIN links ON links.x = reached.doc_id)
SELECT sets.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM sets JOIN reached USING (doc_id) GROUP BY sets.doc_id, g
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, 1 AS s, unnest(w) AS g FROM words
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
counts AS MATERIALIZED (SELECT lang, s, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cuts AS MATERIALIZED (
    SELECT lang, g, f AS a, k, array_to_string(string_split(g, ' ')[1:k], ' ') AS front, array_to_string(string_split(g, ' ')[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, s)) AS k FROM counts WHERE s > 1)),
scored AS (
    SELECT cuts.*, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.g = front JOIN counts y ON y.lang = cuts.lang AND y.g = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
within AS (
    SELECT lang, part, max(f) AS longer
    FROM (SELECT lang, f, string_split(g, ' ') AS w, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM counts WHERE s = 3)
    GROUP BY ALL),
kept AS (
    SELECT best.lang, g AS phrase, a, l, r, score
    FROM best LEFT JOIN within ON within.lang = best.lang AND part = g
    WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
