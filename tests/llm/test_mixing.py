import brute
import pytest
from pyspark.sql import functions as F

from silverlake.llm import mixing


def level_by_level(sizes, most=3):
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        out = {s: most * sizes[s] if s in full else weight[s] * rest / weights if weights else 0 for s in order}
        above = {s for s in order if s not in full and out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 5, None: 40, "z": 0}, {"x": 3}, {"a": 7, "b": 7}, {"a": 0, None: 0}])
def test_targets(spark, sizes):
    rows = [(s, n - n // 2) for s, n in sizes.items()] + [(s, n // 2) for s, n in sizes.items()]
    found = mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()
    assert {r.source: r.source_size for r in found} == sizes
    wanted = level_by_level(sizes)
    assert {r.source: r.target for r in found} == pytest.approx(wanted)


def documents(spark):
    rows = [(i, "w " * (i % 17), "s" + str(i % 5) if i % 11 else None, i) for i in range(3000)]
    rows += [(None, "a b", "s1", 1), (5, None, "s2", 2), (5, "", "s2", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_rate int")


def test_mix_and_decisions_agree(spark):
    docs = documents(spark)
    rows = mixing.decisions(docs).collect()
    assert len(rows) == docs.count()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {}
    for r in mixed.collect():
        copies[r.doc_id, r.mix_rate] = copies.get((r.doc_id, r.mix_rate), 0) + 1
    assert sum(copies.values()) == sum(r.copies for r in rows)
    assert max(copies.values()) <= 3
    taken, target = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        target[r.source] = r.target
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.1)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.decisions(docs.repartition(7)).collect()))


def test_words_are_counted_alike(spark):
    texts = [None, "", " ", "a\tb\nc\x0bd\x0ce\rf g", "x\x1cy\x85z w", "é  ü "]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = {r.doc_id: r.size for r in mixing.sizes(docs, "doc_id", "text", "source").collect()}
    assert found == {i: brute.count_words(t) for i, t in enumerate(texts)}


def test_nothing_to_mix(spark):
    none = documents(spark).where(F.lit(False))
    assert mixing.decisions(none).count() == 0
    assert mixing.mix(none).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.copies for r in mixing.decisions(empty).collect()] == [0, 0]
    assert mixing.mix(empty).count() == 0
