"""Token files, token counts and packing against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clearspark.llm import packing, pretokens, token_counts, token_files
from clearspark.llm.tokenizer_files import vocabulary
from clearspark.session import fresh_folder, landed
from tests.llm.cases import empty_table, odd_rows, odd_table, prose

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_gives_the_librarys_ids(path):
    texts = [r[1] or "" for r in odd_rows()]
    pieces = ["'", "s", "re", "ll", " ", "  ", "\n", "1", "23", "!!", "é", "É", "a", "B", "<|", "—", "½", "ª", "́", "Ω"]
    rng = np.random.default_rng(3)
    texts += ["".join(rng.choice(pieces, rng.integers(0, 20))) for _ in range(2000)]
    found = pretokens.Encoder(path, bits=8, arena=64).encode(texts)
    expected = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for text, own, e in zip(texts, found, expected, strict=True):
        assert own.tolist() == e.ids, text


def test_proved_whole_tokens_encode_to_one(spark):
    whole = pretokens.proved_whole(WORDS)
    cut = pretokens.Cut(["the"], True)
    assert cut.hashes[0] in whole and (np.diff(whole.astype(object)) > 0).all()


def test_token_counts(spark):
    found = token_counts.count_tokens(odd_table(spark), WORDS).collect()
    expected = [(r[0], len((r[1] or "").encode()), len(library_ids(WORDS, r[1]))) for r in odd_rows()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found), key=key) == sorted(expected, key=key)
    assert any(r.over_limit for r in found) and not all(r.over_limit for r in found)
    assert token_counts.count_tokens(empty_table(spark), WORDS).count() == 0


def stored(spark, docs, **options):
    path = fresh_folder(spark, "test-tokens")
    token_files.write(docs, path, BYTES, **options)
    rows = landed(token_files.records(spark, path, with_ids=True), "test-records")
    return path, rows, landed(token_files.index(rows, bucket_keys=4), "test-index")


def test_files_hold_the_ids_in_key_order(spark):
    path, rows, _ = stored(spark, odd_table(spark), shards=3)
    found = sorted(token_files.with_starts(rows, rows).collect(), key=lambda r: r.start)
    keys = [None if r.key is None else int(r.key) for r in found]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    at = 0
    texts = defaultdict(list)
    for r in odd_rows():
        texts[r[0]].append(library_ids(BYTES, r[1]) + [0])
    for r, key in zip(found, keys, strict=True):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(bytes(r.ids)))
        texts[key].remove(ids)
        at += len(ids)
    assert not any(texts.values())


def test_index_finds_every_key_and_no_other(spark):
    _, rows, indexed = stored(spark, odd_table(spark), shards=3)
    keys = spark.createDataFrame([(None,), ("3",), ("7",), ("12",), ("999",), ("3",)], "key string")
    found = token_files.located(indexed, rows, keys).collect()
    assert sorted((r.key or "") for r in found) == ["", "12", "3", "3", "7", "7", "7"]
    assert token_files.lookup(indexed, keys.filter("key = '999'")).count() == 0


def test_perfect_hash_is_a_permutation():
    for n in (1, 2, 5, 100, 2000):
        slots = pretokens.mixed(np.arange(1, n + 1, dtype=np.uint64))
        displaced, own = token_files.perfect(slots)
        assert sorted(own.tolist()) == list(range(n))
        step = displaced[(slots % np.uint64(len(displaced))).astype(int)].astype(np.int64)
        again = np.where(step < 0, -step - 1, token_files.place(slots, np.maximum(step, 0), n))
        assert (again == own).all()


def test_token_files_of_an_empty_table(spark):
    _, rows, indexed = stored(spark, empty_table(spark))
    assert rows.count() == 0 and indexed.count() == 0
    assert token_files.lookup(indexed, spark.createDataFrame([("1",)], "key string")).count() == 0
    with pytest.raises(ValueError):
        token_files.write(empty_table(spark), "unused", BYTES, end_id=200)


def test_packing_keeps_every_id_once(spark):
    found = packing.pack(odd_table(spark), BYTES, group=8, with_ids=True).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    expected = defaultdict(list)
    for r in odd_rows():
        expected[r[0]].append(library_ids(BYTES, r[1]) + [1])
    for key, texts in expected.items():
        if len(texts) == 1:
            joined = b"".join(p[2] for p in sorted(docs[key]))
            assert np.frombuffer(joined, "<u4").tolist() == texts[0]
        assert sum(p[1] for p in docs[key]) == sum(map(len, texts))
    assert packing.pack(empty_table(spark), BYTES).count() == 0


def test_packing_pads_little(spark):
    docs = spark.createDataFrame([(i, prose(i, 20 + 37 * i % 900)) for i in range(600)], "doc_id long, text string")
    found = packing.pack(docs, BYTES)
    tokens, sequences = found.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert tokens / (2048 * sequences) > 0.98


def test_differencing_balances():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 512, 1000).tolist()
    windows = packing.windows_of(sizes, 2048)
    assert sorted(i for w in windows for i in w) == list(range(1000))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) <= 2048 and max(sums) - min(sums) < 40
    assert packing.windows_of([], 10) == [] and len(packing.windows_of([6, 6, 6], 10)) == 3
