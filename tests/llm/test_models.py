"""Language identification and suffix tree scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clearspark.llm import language_id, suffix_tree
from clearspark.llm.backoff import framed
from clearspark.llm.queries import QUERIES, id_remainder
from tests.llm.cases import empty_table, odd_rows, odd_table, words

FOLDER = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = QUERIES["op5_language_id"](spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first()
    assert held[0] > 0.98 and held[1] < 0.02
    assert found.filter("score < 0 OR score > 1").count() == 0


def test_gibberish_is_rejected(spark):
    model = language_id.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    _, _, rejected = model.predict(["xq zvkj wqpx kkzzq jxqz vvwqk zzxkq qqjjx " * 4, "The thing that was in the other and of it is"])
    assert rejected.tolist() == [True, False]


def test_chances_of_next_characters_sum_to_one(spark):
    model = language_id.fit(spark.read.parquet(f"{FOLDER}/documents.parquet")).model
    alphabet = [g for g in range(32, 0x250)]
    for start in ("", "t", "the", "entre"):
        total = np.zeros(model.logs.shape[1])
        for c in alphabet:
            own = [np.array([ord(x) for x in start] + ([c] if c != 32 else []), np.uint32)]
            symbols, places, within = framed(own, 32)
            listed = model.places(symbols, places, within)[len(start)]
            total += np.where(listed > -30, 10**listed, 0)
        # Characters of no language share one unknown's chance, counted here once for each.
        assert (total > 0.999).all()


def test_odd_texts_have_a_defined_language(spark):
    rows = odd_table(spark)
    model = language_id.fit(rows)
    found = language_id.identify(rows, model, keep=["doc_id", "text", "n"]).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1 and (lettered or (r.rejected and r.score == 0))


def test_no_labels_no_language(spark):
    model = language_id.fit(empty_table(spark))
    found = language_id.identify(odd_table(spark), model, keep=["doc_id"]).collect()
    assert {(r.lang_pred, r.rejected) for r in found} == {("und", True)}
    assert language_id.identify(empty_table(spark), model, into=("a", "b", "c")).count() == 0


def test_kept_columns_stay_out_of_python_and_texts_are_scored_once(spark):
    rows = odd_table(spark)
    model = language_id.fit(rows)
    found = language_id.identify(rows, model).filter("NOT rejected").withColumn("other", F.coalesce("lang", "lang_pred"))
    assert found.columns == [*rows.columns, "lang_pred", "score", "rejected", "other"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    every = [r.asDict() for r in rows.collect()]
    names, _, rejected = model.predict([r["text"] for r in every])
    wanted = [(str(r["doc_id"]), str(r["text"]), n) for r, n, x in zip(every, names, rejected.tolist(), strict=True) if not x]
    assert sorted((str(r.doc_id), str(r.text), r.lang_pred) for r in found.collect()) == sorted(wanted)


def test_texts_become_strings_in_bounded_stretches():
    texts = ["é" * 50_000, None, "", "a" * 600_000] * 20
    parts = [p.to_pylist() for p in language_id._stretches(pa.array(texts))]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= language_id.SLICE for p in parts)
    assert not list(language_id._stretches(pa.array([], pa.string())))


def plain_scores(rows, held):
    counts = Counter(w for r in rows if not held(r) for w in [*words(r[1]), b""])
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own = [*words(r[1]), b""]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        yield r[0], len(own), sum(counts[w] > 0 for w in own), total, base


def test_base_scores_match_plain_counts(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    held = lambda r: zlib.crc32(str(r[0]).encode()) % 7 == 2
    found = {r.doc_id: r for r in QUERIES["op10_suffix_tree"](spark, FOLDER).collect()}
    for key, n, known, total, base in plain_scores(rows, held):
        r = found[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and abs(r.base_score - base) < 1e-6 * abs(base)
        assert math.isfinite(r.score) and r.score < 0


def test_rare_words_are_joined(spark):
    docs = odd_table(spark)
    model = suffix_tree.fit(docs, frequent=3, often=3)
    found = suffix_tree.score(docs, model, keep=["doc_id"]).collect()
    expected = sorted((r[0] or -1, r[1], r[2], round(r[4], 6)) for r in plain_scores(odd_rows(), lambda r: False))
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected


def test_tree_chances_sum_to_one(spark):
    model = suffix_tree.fit(spark.read.parquet(f"{FOLDER}/documents.parquet")).tree
    for start in (b"", b"t", b"th", b"zz", b"entre"):
        total = 0.0
        for c in range(256):
            own = [np.frombuffer(start + (bytes([c]) if c != 32 else b""), np.uint8)]
            symbols, places, within = framed(own, 32)
            total += 10 ** model.places(symbols, places, within)[len(start), 0]
        assert 0.99 < total <= 1.0 + 1e-4


def test_tree_knows_the_language_better_than_chance(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = suffix_tree.fit(docs.filter(id_remainder(7) != 2))
    text = docs.filter(id_remainder(7) == 2).filter("length(text) > 500").first().text
    shuffled = "".join(np.random.default_rng(0).permutation(list(text)))
    pair = spark.createDataFrame([(0, text), (1, shuffled)], "doc_id long, text string")
    a, b = (r.score / max(len(t), 1) for r, t in zip(sorted(suffix_tree.score(pair, model, ["doc_id"]).collect()), (text, shuffled), strict=True))
    assert a > b + 0.2


def plain_states(texts):
    """The suffix-closed contexts that pass the divergence test, over texts of one word."""
    nexts = {}
    for text, n in Counter(texts).items():
        padded = b" " * 6 + text.encode() + b" "
        for i in range(6, len(padded)):
            for k in range(7):
                nexts.setdefault(padded[i - k : i], Counter())[padded[i]] += n
    total = {c: sum(own.values()) for c, own in nexts.items()}
    kept = {b""}
    for c, own in nexts.items():
        if c and total[c] >= suffix_tree.WEIGHT:
            gain = sum(n * math.log((n / total[c]) / (nexts[c[1:]][b] / total[c[1:]])) for b, n in own.items())
            if gain > 0.5 * len(own) * math.log(total[c]):
                kept |= {c[i:] for i in range(len(c))}
    return kept


def test_all_contexts_that_pass_are_kept_and_scored(spark):
    rng = np.random.default_rng(4)
    listed = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (30_000, 6))]
    docs = spark.createDataFrame([(w,) for w in listed], "text string").crossJoin(spark.range(14).select("id"))
    expected = plain_states(listed * 14)
    assert len(expected) > 150_000 / suffix_tree.DEPTH
    for frequent in (1 << 19, 1000):
        model = suffix_tree.fit(docs, frequent=frequent, often=frequent)
        assert len(model.tree.contexts) == len(expected)
        found = suffix_tree.score(docs.filter("id = 0").limit(2000), model, ["text"]).collect()
        assert len(found) == 2000
        ends = (14 * len(listed) + 1) / (28 * len(listed) + 2)
        whole = model.tree.words([np.frombuffer(r.text.encode(), np.uint8) for r in found], 32)[:, 0] + math.log10(ends * (1 - ends))
        assert np.allclose([r.score for r in found], whole, atol=1e-4)


def test_shuffled_words_score_lower(spark):
    rng = np.random.default_rng(1)
    follows = {"red": "ox", "ox": "sees", "sees": "old", "old": "mill", "mill": "by", "by": "red"}
    texts, word = [], "red"
    for _ in range(300):
        own = []
        for _ in range(20):
            own.append(word)
            word = follows[word] if rng.random() < 0.9 else rng.choice(list(follows))
        texts.append(" ".join(own))
    model = suffix_tree.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    pairs = [(i, t) for k, text in enumerate(texts[:20]) for i, t in ((2 * k, text), (2 * k + 1, " ".join(rng.permutation(text.split()))))]
    for spaced in (" ", " \n"):
        rows = [(i, t.replace(" ", spaced)) for i, t in pairs]
        found = dict((r.doc_id, r.score) for r in suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect())
        assert all(found[2 * k] > found[2 * k + 1] + 1 for k in range(20))


def test_scores_without_training_rows(spark):
    model = suffix_tree.fit(empty_table(spark))
    found = suffix_tree.score(odd_table(spark), model, keep=["doc_id"]).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in found} == {(0, 0, 0.0)}


def test_slots_hold_every_key():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 50_000):
        keys = np.unique(rng.integers(0, 1 << 56, n).astype(np.uint64))
        values = rng.normal(size=len(keys)).astype(np.float32)
        slots = suffix_tree.Slots(keys, values)
        order = rng.permutation(len(keys))
        assert (slots.of(keys[order]) == values[order]).all()
        other = np.setdiff1d(rng.integers(0, 1 << 56, 500).astype(np.uint64), keys)
        assert np.isnan(slots.of(other)).all()
    assert np.isnan(suffix_tree.Slots(np.array([5], np.uint64), np.array([1], np.float32)).of(np.array([0], np.uint64))).all()
