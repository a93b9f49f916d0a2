import hashlib
import random

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from silverlake.llm import chunk_dedup, ngram_join
from silverlake.llm.components import components

SMALL = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "ba", "ko", "ri", "nu"]) + str(rng.randint(0, 400)) for _ in range(n))


def changed(rng, text, n):
    out = text.split(" ")
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def texts():
    """Ordinary texts, many near copies of one, texts that share a passage, copies and odd ones."""
    rng = random.Random(5)
    base, passage = prose(rng, 150), prose(rng, 60)
    out = [prose(rng, rng.randint(3, 200)) for _ in range(60)]
    out += [changed(rng, base, rng.randint(1, 9)) for _ in range(90)] + [base]
    out += [prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40) for _ in range(50)]
    out += [out[3]] * 4 + [out[7].upper(), out[7].replace(" ", "\n\t ")]
    out += [None, "", "", " \n\x0b ", "one", "one", "ONE two", "one two", "a b c d e", "x\x1cy z w v u", "a  b c d e"]
    return out


# ---------------------------------------------------------------- exact copies


def chunk_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, kept int, recipe string")


def test_chunks_make_up_the_text(spark, texts):
    long = "x" * 9000 + "\n" + prose(random.Random(1), 3000) + "\U0001f600é\n" * 900
    docs = spark.createDataFrame([(t,) for t in [*texts, long]], "text string").where("text is not null")
    cut = docs.select("text", F.regexp_extract_all("text", F.lit(chunk_dedup.CHUNK), F.lit(0)).alias("chunks"))
    for row in cut.collect():
        assert "".join(row.chunks) == row.text
        assert all(len(c) <= chunk_dedup.MAX_CHUNK for c in row.chunks)


def weak(text):
    return F.pmod(F.length(text), F.lit(2)).cast("string").cast("binary")


@pytest.mark.parametrize("digest", [chunk_dedup.sha256, weak])
def test_decisions(spark, texts, digest):
    shared = prose(random.Random(2), 2500)
    rows = [*enumerate(texts), (None, "one"), (3, texts[3]), (900, shared + "!"), (901, shared + "?"), (902, shared + "!")]
    docs = chunk_rows(spark, [(d, t, 0, "") for d, t in rows])
    found = chunk_dedup.decisions(docs, digest=digest).collect()
    same = {}
    for d, t in rows:
        same.setdefault(t or "", []).append(d)
    assert len(found) == len(rows)
    text_of = {hashlib.sha256(t.encode()).hexdigest(): t for t in same}
    for row in found:
        ids = same[text_of[row.text_sha256]]
        assert row.group_size == len(ids)
        assert row.keep_id == max((d for d in ids if d is not None), default=None)
        assert not row.kept or row.doc_id == row.keep_id
    assert sum(r.kept for r in found) == len(same)


def test_deduplicate_keeps_columns_and_one_row(spark):
    docs = chunk_rows(spark, [(1, "a", 5, "r"), (2, "a", 6, "s"), (2, "a", 7, "t"), (None, "b", 8, "u"), (3, None, 9, "v")])
    kept = chunk_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "b"), (2, "a"), (3, "")]


def test_no_documents(spark):
    none = chunk_rows(spark, [])
    assert chunk_dedup.decisions(none).count() == 0
    assert chunk_dedup.deduplicate(none).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0
    assert ngram_join.keep_one(none).count() == 0


# ---------------------------------------------------------------- near copies


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(110)] + [(k, k + 1) for k in range(300, 340)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def classes(rows):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=lambda r: (str(r[0]), r[1:2]))


def test_near_duplicates(spark, texts):
    rows = [*enumerate(texts), (None, "lonely words of no other kind at all"), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit(1)).withColumn("n", F.lit("x"))
    assert classes(ngram_join.near_duplicates(docs).collect()) == brute.near_duplicates(rows)


def test_clusters_alone_give_the_same(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "COLUMNS", 50)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(ngram_join.near_duplicates(docs).collect()) == brute.near_duplicates(rows)


def test_pairs_alone_give_the_same(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 10**6)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(ngram_join.near_duplicates(docs).collect()) == brute.near_duplicates(rows)


def test_heavy_shingles_are_counted_apart(spark, texts, monkeypatch):
    """Every shingle of two or more sets of a chunk takes the way of the heavy ones."""
    from pyspark.cloudpickle import register_pickle_by_value, unregister_pickle_by_value

    monkeypatch.setattr(ngram_join, "HEAVY", 2)
    monkeypatch.setattr(ngram_join, "SHARD", 500)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    register_pickle_by_value(ngram_join)  # so that the workers see the changed numbers
    try:
        found = ngram_join.near_duplicates(docs).collect()
    finally:
        unregister_pickle_by_value(ngram_join)
    assert classes(found) == brute.near_duplicates(rows)


def test_totals_of_heavy_shingles_go_where_they_are_needed(monkeypatch):
    """A bucket gets the totals of heavy shingles that its own sets hold, however many others there are."""
    monkeypatch.setattr(ngram_join, "HEAVY", 4)
    rng, buckets = random.Random(9), 50
    groups = [prose(rng, 12) for _ in range(60)]  # sixty passages, of five texts each
    texts = [f"{passage} own{k} {prose(rng, 5)}" for passage in groups for k in range(5)]
    n = len(texts)
    blobs = list(ngram_join.send(list(range(n)), [0] * n, texts, 5, buckets))
    held = {}  # the buckets of each heavy shingle
    for bucket, blob in blobs:
        if blob[:1] == ngram_join.OCCURS:
            for key in ngram_join.grow(blob[1:])["key"].tolist():
                held.setdefault(key, set()).add(bucket)
    assert len(held) >= 60 * 7
    sent = {}
    for shard in range(buckets):
        mine = [b for s, b in blobs if s == shard and b[:1] != ngram_join.OCCURS]
        for bucket, blob in ngram_join.shared(mine, buckets):
            if blob[:1] == ngram_join.HOT:
                part = ngram_join.grow(blob[1:])
                assert (part["often"] == 5).all()
                for key in part["key"].tolist():
                    sent.setdefault(key, set()).add(bucket)
    assert sent == held
    assert sum(map(len, sent.values())) <= 5 * len(held) < buckets * len(held)


def test_keep_one(spark, texts):
    rows = [*enumerate(texts), (3, texts[3])]
    docs = spark.createDataFrame([(d, t, d) for d, t in rows], "doc_id long, text string, join_key int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = {c for _, _, c in brute.near_duplicates(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert classes(ngram_join.op1_ngram_join(spark, SMALL).collect()) == brute.near_duplicates(rows)


def test_block_links_are_a_forest():
    rows = pd.DataFrame({"name": [1, 2, 3], "n": [4, 4, 4], "shingles": [np.arange(4)] * 3, "distance": [0.0] * 3})
    assert len(ngram_join.block_links(rows, rows, 75, 0.25)) == 2
