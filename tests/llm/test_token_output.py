import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemill.llm.token_output import (
    PieceEncoder,
    build_index,
    lookup,
    perfect_hash,
    read_ids,
    scan_shards,
    slots_of,
    token_output,
    write_shards,
)

FILE = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(FILE)
ENCODER = PieceEncoder(FILE)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB'st ré́İΣ  \n\t\r\x0b\x1c\x85  12.,<|>Σς漢", max_size=30))
def test_pieces_between_blanks_encode_alone(text):
    assert ENCODER.apart
    assert np.frombuffer(next(ENCODER.encode([text])), ENCODER.width).tolist() == ids_of(text)


def test_special_strings_are_left_to_the_library():
    text = "a <|endoftext|> b<|startoftext|>c"
    assert np.frombuffer(next(ENCODER.encode([text])), ENCODER.width).tolist() == ids_of(text)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 2500])
def test_perfect_hash_is_minimal_and_perfect(n):
    hashes = np.random.default_rng(n).integers(0, 1 << 63, n, np.int64).view(np.uint64)
    assert sorted(slots_of(hashes, perfect_hash(hashes), n).tolist()) == list(range(n))


@pytest.fixture(scope="module")
def many(spark):
    docs = [(i * 37 % 5003 - 100, f"text number {i} " + "x y " * (i % 40)) for i in range(5003)]
    return docs, spark.createDataFrame(docs, "doc_id long, text string").repartition(7)


def test_shards_index_and_keyed_access(spark, many, tmp_path):
    docs, df = many
    path = str(tmp_path / "shards")
    write_shards(df, path, FILE, shard_bytes=60_000)
    places = scan_shards(spark, path).cache()
    assert places.select("shard").distinct().count() > 3
    keys = [r["doc_id"] for r in places.orderBy("shard", "offset").collect()]
    assert keys == sorted(d for d, _ in docs)
    index = build_index(places).cache()
    assert index.count() > 1
    found = {r["doc_id"]: (r["shard"], r["offset"]) for r in lookup(index, df).collect()}
    assert found == {r["doc_id"]: (r["shard"], r["offset"]) for r in places.collect()}
    texts = dict(docs)
    asked = spark.createDataFrame([(5,), (-100,), (4902,), (None,), (5,), (10**9,)], "doc_id long")
    got = {r["doc_id"]: r["ids"] for r in read_ids(spark, path, index, asked).collect()}
    assert got == {k: ids_of(texts[k]) + [2] for k in (5, -100, 4902)}


def test_unknown_keys_are_refused(spark, many, tmp_path):
    _, df = many
    path = str(tmp_path / "shards")
    write_shards(df, path, FILE)
    index = build_index(scan_shards(spark, path))
    strangers = spark.range(1_000_000, 1_020_000).withColumnRenamed("id", "doc_id")
    assert lookup(index, strangers).count() == 0


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    got = sorted(map(tuple, token_output(spark, odd_docs, FILE).collect()), key=lambda r: r[1])
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1] or ""), r[1] or ""))
    start, want = 0, []
    for doc_id, text, *_ in ordered:
        ids = [*ids_of(text), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_output(spark, no_docs, FILE).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aBK\u212aJ\u030c\u0307İ'st-_9$ \n\x00\x7f€é", max_size=12), max_size=6))
def test_texts_of_a_chunk_keep_apart(texts):
    assert [np.frombuffer(raw, ENCODER.width).tolist() for raw in ENCODER.encode(texts)] == [ids_of(t) for t in texts]


def test_full_memory_changes_no_ids(monkeypatch):
    texts = [f"Word{i}x, word{i % 7} it's été{i} {i}.5" for i in range(400)] * 2
    monkeypatch.setattr(PieceEncoder, "HELD_BYTES", 2000)
    monkeypatch.setattr(PieceEncoder, "CHUNK", 1000)
    small = PieceEncoder(FILE)
    assert [np.frombuffer(raw, small.width).tolist() for raw in small.encode(texts)] == [ids_of(t) for t in texts]
    assert 16 * len(small.hashes) + 2 * small.held <= 2000


def test_rows_without_id_or_of_one_id_make_many_shards(spark, tmp_path):
    rows = [(None, f"none {i}") for i in range(900)] + [(7, f"seven {i} " * (i % 5)) for i in range(900)] + [(9, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = str(tmp_path / "shards")
    write_shards(docs, path, FILE, shard_bytes=1500)
    places = scan_shards(spark, path).orderBy("shard", "offset").collect()
    assert len(places) == len(rows) and len({r["shard"] for r in places}) > 10
    assert [r["doc_id"] for r in places] == [None] * 900 + [7] * 900 + [9]
    assert [r["flags"] for r in places] == [1] * 900 + [0] + [2] * 899 + [0]


def test_files_of_few_records_keep_the_order(spark, monkeypatch, tmp_path):
    from tidemill.llm import token_output as module

    monkeypatch.setattr(module, "RECORDS_PER_FILE", 10)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(95)], "doc_id long, text string").repartition(4)
    done = token_output(spark, docs, FILE).orderBy("start").collect()
    assert [r["doc_id"] for r in done] == list(range(95))
    assert [r["start"] for r in done] == [0, *np.cumsum([r["n_tokens"] for r in done])[:-1].tolist()]


def test_query_equals_the_library(spark):
    from tidemill.llm.token_output import op9_token_output

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    start, want = 0, []
    for doc_id, text in sorted(docs):
        ids = [*ids_of(text), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op9_token_output(spark, sf_dir).collect())) == want
