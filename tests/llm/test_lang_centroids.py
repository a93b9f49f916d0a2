import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlake.llm import lang_centroids as lang

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def plain_runs(text):
    """Counts by the number of a run, one run at a time."""
    if text is None or not any(c.isalpha() for c in text):
        return Counter()
    low = text.lower().encode()
    low = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in low)
    data = b" " + b" ".join(w for w in low.split(b" ") if w) + b" "
    found = Counter()
    for n in lang.RUNS:
        for i in range(len(data) - n + 1):
            code = int.from_bytes(data[i : i + n], "big") + (n << 24)
            found[(code * 2654435761 % 2**32) >> (32 - int(math.log2(lang.DIMS)))] += 1
    return found


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return lang.fit(docs.where(~lang.held_out(F.col("doc_id"))))


@pytest.mark.parametrize("text", ["a", "The  End!", "Él & ÉL", "x1y22z", "ß" * 3, "", "12 .", None, "a" * 70, "日本語 text\n\n"])
def test_runs(text):
    at, times = lang.runs(text)
    assert dict(zip(at.tolist(), times.tolist(), strict=True)) == plain_runs(text)


def test_runs_of_slices(monkeypatch):
    text = "Über die Brücke, and then some; " * 9
    whole = lang.runs(text)
    for size in (3, 7, 64):
        monkeypatch.setattr(lang, "SLICE", size)
        assert all((a == b).all() for a, b in zip(lang.runs(text), whole, strict=True))


def test_document_frequencies(docs):
    frequencies, total = lang.document_frequencies(docs.repartition(3))
    expected, texts = np.zeros(lang.DIMS), 0
    for row in docs.collect():
        found = plain_runs(row["text"])
        expected[list(found)] += 1
        texts += bool(found)
    assert (frequencies == expected).all() and total == texts


def test_predictions_against_plain_python(docs, model):
    """Every text against every centroid, weights and cosines summed one by one."""
    centroids = [(r["lang"], np.frombuffer(r["vector"], np.float32), r["radius"]) for r in model.centroids.collect()]
    assert Counter(c[0] for c in centroids).keys() == {"de", "en", "es", "fr"}
    assert max(Counter(c[0] for c in centroids).values()) > 1
    for row in lang.predict(docs, model).limit(60).collect():
        found = plain_runs(row["text"])
        size = math.sqrt(sum((n * model.idf[r]) ** 2 for r, n in found.items()))
        near = [(sum(n * model.idf[r] * float(v[r]) for r, n in found.items()) / size, name, radius) for name, v, radius in centroids]
        best = max(near)
        assert row["lang_pred"] == best[1]
        assert row["similarity"] == pytest.approx(best[0], abs=1e-6)
        assert row["rejected"] == (1 - best[0] > best[2]) or 1 - best[0] == pytest.approx(best[2], abs=1e-6)


def test_clusters():
    """Three well-parted bunches: each gets a centroid, and every vector is nearest to its own."""
    rng = np.random.default_rng(1)
    vectors = np.concatenate([np.eye(lang.DIMS, dtype=np.float32)[[i] * 20] for i in (5, 900, 7000)])
    vectors[:, :50] += rng.random((60, 50), dtype=np.float32) * 0.02
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, member = lang.cluster(vectors)
    bunch = defaultdict(set)
    for i, c in enumerate(member):
        bunch[i // 20].add(int(c))
    assert not bunch[0] & bunch[1] and not bunch[1] & bunch[2] and not bunch[0] & bunch[2]
    assert (member == (vectors @ centres.T).argmax(axis=1)).all()
    one, members = lang.cluster(vectors[:1])
    assert len(one) == 1 and list(members) == [0]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = lang.op12_lang_centroids(spark, sf_dir).join(known, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 1000 and len(held) > 200
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_blocks_of_languages(docs, model, monkeypatch):
    """Languages compared in several passes give what one pass gives."""
    at_once = lang.predict(docs, model, keep_text=False).orderBy("doc_id").collect()
    monkeypatch.setattr(lang, "BLOCK", 1)
    assert lang.predict(docs, model, keep_text=False).orderBy("doc_id").collect() == at_once


def test_far_texts_are_rejected(spark, model):
    texts = ["Zzxqj kkvvw wwqq zzjj xxkk " * 9, "Привет, как дела? " * 9, "The anst of the ertion and the with the other there."]
    rows = lang.predict(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA), model).orderBy("doc_id").collect()
    assert [r["rejected"] for r in rows] == [True, True, False]
    assert rows[2]["lang_pred"] == "en"


def test_odd_rows(spark, model):
    rows = [(1, None, "en"), (2, "", "en"), (3, "1 2 3 … !", None), (None, "the and of", None), (5, "é " * 800_000, "fr"), (1, "the and of", "en")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("Rejected", F.lit("x")).withColumn("LANG_PRED", F.lit(1)).withColumn("idf", F.lit(2))
    found = lang.predict(frame, model).collect()
    assert [r["lang_pred"] for r in found[:3]] == ["und"] * 3 and all(r["similarity"] == 0 and r["rejected"] for r in found[:3])
    assert found[3][4:] == found[5][4:] and len(found) == 6 and found[4]["lang_pred"] in ("fr", "es", "en", "de")
    assert [r["idf"] for r in found] == [2] * 6


def test_nothing_to_learn(spark, tmp_path):
    frame = spark.createDataFrame([(1, "Some text", None), (2, None, "en"), (3, "77", "de")], SCHEMA)
    model = lang.fit(frame)
    assert model.languages == 0
    assert [r["lang_pred"] for r in lang.predict(frame, model).collect()] == ["und"] * 3
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert lang.op12_lang_centroids(spark, str(tmp_path)).collect() == []


def test_sample_is_bounded(spark, monkeypatch):
    """A text in a third of all rows counts once, a rare language is there, and a large one is cut to size."""
    monkeypatch.setattr(lang, "SAMPLE", 20)
    rows = [(i, f"word{i} {'abcdefgh'[i % 8]}", "en") for i in range(500)] + [(i, "same text", "en") for i in range(500)]
    rows += [(7, "rare", "xx")] + [(8, "only this", "yy")] * 400 + [(9, "…", "zz")]
    found = Counter(r["lang"] for r in lang.sample(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found["xx"] == found["yy"] == 1 and 10 <= found["en"] <= 20 and "zz" not in found
