import sys
from pathlib import Path

import brute
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry
import corpus_pipeline
from silverlake.llm import byte_bpe, mixing, ordinal_toxicity, registry
from workloads import registry as others

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_stages_against_plain_python(spark, whole):
    """What each stage keeps, worked out from the documents its predecessor kept."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(whole, labels))
    toxic = {r.doc_id for r in ordinal_toxicity.score(whole, model).where("toxic").collect()}
    docs = {r.doc_id: r for r in whole.collect() if r.doc_id not in toxic}
    last = {}
    for d, r in docs.items():
        last[r.text] = max(d, last.get(r.text, d))
    docs = {d: docs[d] for d in last.values()}
    groups = brute.near_duplicates([(d, r.text) for d, r in docs.items()])
    docs = {d: docs[d] for d, _, component in groups if d == component}
    kept = spark.createDataFrame(list(docs.values()), whole.schema)
    copies = {r.doc_id: r.copies for r in mixing.decisions(kept).collect()}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in found) == sorted(d for d, n in copies.items() for _ in range(n))
    for row in found:
        assert row.decoded == docs[row.doc_id].text
        assert row.ids == library.encode_ordinary(row.decoded)
        assert row.n_tokens == len(row.ids)


def test_stages_return_the_columns_of_documents(spark, whole):
    few = whole.limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, few, SMALL).dtypes == whole.dtypes


def test_empty_documents(spark, whole):
    none = whole.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0


def test_odd_documents(spark, tmp_path):
    """Nulls in every column, repeated rows, very long and empty texts, and columns with names that the stages use."""
    rows = [
        (1, None, None, None, None), (1, None, None, None, None), (None, "no id here", "en", "a", 10),
        (2, "", "en", "a", 0), (3, "same words in both of these", "en", "a", 27), (4, "same words in both of these", "de", None, 27),
        (5, "long " * 60_000, "en", "b", 300_000), (6, "x" * 200_000, "en", "b", 1), (7, " \n\t", "en", "b", 3),
    ] + [(8, "one row many times over again", "en", "c", 29)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("key", "Row_Number", "kept", "ids", "copies", "Toxic", "n_shingles"):
        docs = docs.withColumn(name, F.lit(name))
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes
        found = [(r.doc_id, r.text) for r in out.collect()]
        assert set(found) <= texts and found
    exact = [(r.doc_id, r.text) for r in corpus_pipeline.drop_copies(spark, docs, str(tmp_path)).collect()]
    # Null and empty texts are equal, of equal texts the largest id stays, and repeated rows are one.
    assert sorted(exact, key=str) == sorted(
        [(2, ""), (None, "no id here"), (4, rows[5][1]), (5, rows[6][1]), (6, rows[7][1]), (7, " \n\t"), (8, rows[9][1])], key=str
    )
    near = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()]
    assert sorted(d for d, t in near if t and t.split() and d) == [3, 5, 6, 8]
    for row in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert (row.doc_id, row.decoded) in {(d, t or "") for d, t in texts} and row.n_tokens == len(row.ids)


def test_registered():
    names = entry.queries().keys()
    assert names == others.QUERIES.keys() | registry.QUERIES.keys() | {"pipeline"}
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert entry.oracle_sql().keys() == others.SQL.keys() | registry.SQL.keys()


@pytest.mark.parametrize("name", list(registry.SQL))
def test_sql(spark, name):
    oracle = pytest.importorskip("oracle")
    found = oracle.difference(registry.QUERIES[name](spark, SMALL), oracle.connect(SMALL), registry.SQL[name])
    assert found == ""
