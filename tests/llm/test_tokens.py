import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverlake.llm import byte_bpe, pfor_ids

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
ODD = [
    None,
    "",
    " ",
    "\n\n  x\t\t",
    "it's I'LL we'd nbsp \x1c\x85 end  ",
    "naïve café   line 日本語 \U0001f600\U0001f600 ١٢٣ ½",
    "<|endoftext|> plain",
    "a" * 3000 + "!" * 2000 + " " * 500,
    "ab" * 700 + "\x00\x01",
    "same",
    "same",
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_merge_against_the_library(library):
    ranks = library._mergeable_ranks
    one = tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    letters = "abcdefgh éüñ日!?1 the ing tion "
    for _ in range(300):
        piece = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40))).encode()
        assert byte_bpe.merge(piece, ranks) == one.encode_ordinary(piece.decode())


def test_many_pieces_at_once(library):
    with open(RANKS, "rb") as file:
        codec = byte_bpe.Codec(file.read(), public_tokenizers.PATTERN)
    rng = random.Random(3)
    for n in (2, 3, 4, 7, 8, 9, 33, 64):
        pieces = [
            "".join(rng.choice("abehinorst éñ日-") for _ in range(rng.randint(max(2, n - 5), n))).encode()
            for _ in range(200)
        ]
        many = byte_bpe.merge_many(pieces, codec.single, codec.pairs)
        for piece, ids in zip(pieces, many, strict=True):
            if piece not in codec.ranks:
                assert np.frombuffer(ids, np.uint32).tolist() == byte_bpe.merge(piece, codec.ranks)


def test_encode_and_decode(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, ids string")
    shared = byte_bpe.share_ranks(spark, RANKS)
    rows = byte_bpe.decode(byte_bpe.encode(docs, shared), shared).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        assert row.ids == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_query_against_the_library(spark, library):
    import hashlib

    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = byte_bpe.op4_byte_bpe(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_blocks():
    rng = np.random.default_rng(2)
    for n in (1, 7, 4096):
        for high in (1, 2, 300, 50257, 1 << 32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            ids[rng.integers(0, n)] = high - 1
            assert (pfor_ids.unpack_block(memoryview(pfor_ids.pack_block(ids)), n) == ids).all()


def test_outliers_are_exceptions():
    ids = np.full(4096, 100, np.uint32)
    ids[:4000] = np.arange(4000) % 8 + 100
    ids[5] = 50_000
    assert len(pfor_ids.pack_block(ids)) < 4096 * 4 / 8 + 100


@pytest.mark.parametrize("width", range(33))
def test_blocks_of_every_width(width):
    rng = np.random.default_rng(width)
    top = (1 << width) - 1
    ids = rng.integers(0, top + 1, 333, dtype=np.uint64).astype(np.uint32)
    ids[:3] = top, 0, 2**32 - 1 if width == 32 else top
    assert (pfor_ids.unpack_block(memoryview(pfor_ids.pack_block(ids, 100)), 333) == ids).all()
    ids[5] = 2**32 - 1  # an exception
    assert (pfor_ids.unpack_block(memoryview(pfor_ids.pack_block(ids)), 333) == ids).all()


def test_repeated_rows_are_dealt_out(spark, tmp_path):
    """Rows that repeat an id and a text, most of all rows, are written by several tasks."""
    docs = spark.createDataFrame([(7, "the same text")] * 900 + [(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    pfor_ids.write_ids(docs.repartition(4), str(tmp_path / "ids"), JSON)
    parts = spark.read.parquet(str(tmp_path / "ids")).groupBy("part").agg(F.sum("n_docs").alias("n")).collect()
    assert sum(r["n"] for r in parts) == 1200 and max(r["n"] for r in parts) < 600
    rows = pfor_ids.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted([7] * 900 + list(range(300)))


def test_file_is_read_by_place():
    ids = np.arange(20_000, dtype=np.uint32)
    file = pfor_ids.IdFile(pfor_ids.pack_file([3, None], [15_000, 5_000], ids))
    assert file.doc_ids == [3, None]
    assert (file.read(4090, 9000) == ids[4090:13090]).all()


def test_words_are_encoded_like_whole_texts():
    with open(JSON, "rb") as file:
        tokens = pfor_ids.Tokens(file.read(), most=50)
    rng = random.Random(4)
    for _ in range(30):
        texts = ["".join(rng.choice(["a", "the", "é", ",", " ", " ", "\n", "\t", "B2", "'s"]) for _ in range(60)) for _ in range(20)]
        texts += ["".join(rng.choice(["ab", "\n", " c", " d,", " 12"]) for _ in range(60)) for _ in range(20)]
        assert tokens.encode(texts) == tokens.whole(texts)
    assert tokens.encode(["a ", " ", "", " a"]) == tokens.whole(["a ", " ", "", " a"])


def test_ids_written_and_read(spark, tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    docs = spark.createDataFrame(
        [(None if i == 3 else i % 9, t, i) for i, t in enumerate(ODD)], "doc_id long, text string, part int"
    )
    pfor_ids.write_ids(docs, str(tmp_path / "ids"), JSON, ids_per_file=50)
    rows = pfor_ids.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    wanted = sorted(
        (-1 if i == 3 else i % 9, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
        for i, t in enumerate(ODD)
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in rows) == wanted
    at = 0
    for row in rows:
        assert row.start == at
        at += len(row.ids)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)


def test_id_query_against_the_library(spark):
    tokenizer = Tokenizer.from_file(JSON)
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in pfor_ids.op9_pfor_ids(spark, SMALL).collect()}
    assert set(rows) == set(texts)
    at = 0
    for doc_id in sorted(texts):
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        assert rows[doc_id].start == at
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_added_tokens_as_in_the_library(spark, tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "a <|endoftext b", "plain text", None]
    texts += [t for t in ODD if t]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in pfor_ids.op9_pfor_ids(spark, str(tmp_path)).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (rows[i].start, rows[i].n_tokens) == (at, len(ids))
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_columns_with_the_names_of_results(spark):
    ranks = byte_bpe.share_ranks(spark, RANKS)
    docs = spark.createDataFrame([(1, "a b", "x", 3), (2, None, "y", 4)], "doc_id int, text string, IDS string, Decoded int")
    both = byte_bpe.encode(docs, ranks, bytes_col="decoded")
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    assert [bytes(r.decoded) for r in both.orderBy("doc_id").collect()] == [b"a b", b""]
    again = byte_bpe.decode(both.withColumnRenamed("decoded", "DECODED"), ranks)
    assert again.columns == ["doc_id", "text", "ids", "decoded"]
    nulls = byte_bpe.decode(spark.createDataFrame([(None,), ([],), ([64, 65],)], "ids array<int>"), ranks)
    assert [bytes(r.decoded) for r in nulls.collect()][:2] == [b"", b""]


def test_decoding_many_ids_in_pieces(monkeypatch):
    with open(RANKS, "rb") as file:
        codec = byte_bpe.Codec(file.read(), byte_bpe.public_tokenizers.PATTERN)
    texts = [t or "" for t in ODD] + ["é" * 3000, "", "x y z"]
    ids = [np.frombuffer(p, np.uint32) for p in codec.encode(texts)]
    ends = np.cumsum([len(x) for x in ids])
    for together in (1, 7, 1 << 20):
        monkeypatch.setattr(byte_bpe, "TOGETHER", together)
        assert codec.decode(np.concatenate(ids), ends).to_pylist() == [t.encode() for t in texts]


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    pfor_ids.write_ids(docs, str(tmp_path / "none"), JSON)
    assert pfor_ids.read_ids(spark, str(tmp_path / "none")).count() == 0
    assert byte_bpe.encode(docs, byte_bpe.share_ranks(spark, RANKS)).count() == 0
