import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlake.llm import elias_fano, ordinal_toxicity, pstable_ann, pu_quality, trie_lm, url_trees

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


def read(spark, name, folder=SMALL):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- quality


def test_quality_of_held_out_documents(spark):
    rows = pu_quality.op2_pu_quality(spark, LARGE).join(read(spark, "labels", LARGE), "doc_id").toPandas()
    rows = rows[rows["held_out"]]
    good, bad = (rows["score"][rows["quality"] == q].to_numpy() for q in (1, 0))
    assert np.mean([(good > x).mean() for x in bad]) > 0.98
    assert (good >= 0.5).mean() > 0.97
    assert (bad >= 0.5).mean() < 0.15


def test_quality_ignores_held_out_labels(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    fold = pu_quality.held_out(F.col("doc_id"))
    other = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (pu_quality.learn(docs, x) for x in (labels, other))
    assert (one.weights == two.weights).all()
    assert one.bias == two.bias


def test_quality_fold_and_odd_texts(spark):
    rows = [(1, None, 0.0), (1, "", 1.0), (None, "x" * 100_000, 2.0), (4, "ok then\x00", 3.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(4, 1), (1, None), (None, 0)], "doc_id long, quality int")
    found = pu_quality.score(docs, pu_quality.learn(docs, labels)).collect()
    assert len(found) == 4
    for row in found:
        assert 0 <= row.score <= 1
        assert row.predicted == int(row.score >= 0.5)
        text = "" if row.doc_id is None else str(row.doc_id)
        assert row.held_out == (zlib.crc32(text.encode()) % 3 == 1)
    none = docs.where(F.lit(False))
    assert pu_quality.score(none, pu_quality.learn(none, labels.where(F.lit(False)))).count() == 0


def plain_measures(text):
    """The measures one by one, over characters and words of the UTF-8 bytes."""
    data = (text or "").encode()
    words, size = data.split(), max(len(data), 1)
    share = lambda test: sum(map(test, data)) / size
    among = lambda chars: share(lambda b: b in chars)
    count = Counter(words)
    n = max(len(words), 1)
    return [
        share(lambda b: 65 <= b <= 90), share(lambda b: 97 <= b <= 122), share(lambda b: b >= 128),
        share(lambda b: 48 <= b <= 57), among(b" \t"), among(b"\n\r"), among(b".,;:?'\"-()"),
        among(b"!*&%$#@~^_=+<>/\\[]{}`"), among(b"|"),
        math.log(1 + len(words)), sum(len(w) for w in words) / n, len(count) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, max(count.values(), default=0) / n,
        sum(w[-1] in b"!*&%$#@~^_=+<>|" for w in words) / n, len(words) / (data.count(b"\n") + 1),
    ]


def test_measures_against_plain_python(spark):
    texts = [None, "", " ", "A b! b! | 9\n\né {x}", "!!! a* b_\r\n", "w " * 3000]
    texts += [r.text for r in read(spark, "documents").limit(60).collect()]
    for text in texts:
        assert pu_quality.measures(text) == pytest.approx(plain_measures(text))


@pytest.mark.parametrize("prior", [0.3, 0.95])
def test_gradient_of_the_risk(prior):
    """Against differences of the risk itself, where it is unbiased and where its second part is reversed."""
    rng = np.random.default_rng(3)
    width = len(pu_quality.MEASURES)
    good, all_ = (rng.integers(0, pu_quality.BINS, (n, width)) for n in (40, 90))
    weights = rng.normal(0, 0.4, width * pu_quality.BINS + 1)

    def parts(w):
        f = [w[:-1][x + np.arange(width) * pu_quality.BINS].sum(axis=1) + w[-1] for x in (good, all_)]
        p, u = (1 / (1 + np.exp(-x)) for x in f)  # l(-f); l(f) is one less it
        return prior * (1 - p).mean(), u.mean() - prior * p.mean()

    first, second = parts(weights)
    found = pu_quality.gradient(pu_quality.sums(weights, good), pu_quality.sums(weights, all_), prior)
    for k in [*rng.choice(len(weights), 40), len(weights) - 1]:
        by = np.zeros_like(weights)
        by[k] = 1e-5
        up, down = parts(weights + by), parts(weights - by)
        slope = [(a - b) / 2e-5 for a, b in zip(up, down, strict=True)]
        assert found[k] == pytest.approx(sum(slope) if second >= 0 else -slope[1], abs=1e-7)


def test_sums_of_all_rows_are_those_of_one_place(spark):
    rng = np.random.default_rng(4)
    bins = rng.integers(0, pu_quality.BINS, (500, len(pu_quality.MEASURES)))
    good = rng.random(500) < 0.2
    rows = [(bool(g), bytearray(b.astype(np.uint8).tobytes())) for g, b in zip(good, bins, strict=True)]
    data = spark.createDataFrame(rows, "good boolean, bins binary").repartition(7)
    weights = rng.normal(0, 1, len(pu_quality.MEASURES) * pu_quality.BINS + 1)
    found = pu_quality._sums_of_all(data, weights)
    for one, side in zip(found, (bins[good], bins), strict=True):
        assert one.tolist() == pu_quality.sums(weights, side).tolist()


def test_quality_where_all_rows_are_labelled(spark):
    """The unlabelled side is all training rows, so a table without unlabelled rows is learned as well."""
    labels = read(spark, "labels", MIDDLE)
    docs = read(spark, "documents", MIDDLE).join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = pu_quality.score(docs, pu_quality.learn(docs, labels)).join(labels, "doc_id").toPandas()
    assert rows["score"].nunique() > 0.5 * len(rows)
    good, bad = (rows["score"][rows["quality"] == q].to_numpy() for q in (1, 0))
    assert np.mean([(good > x).mean() for x in bad]) > 0.95


def test_quality_of_one_id_many_times(spark):
    """No more rows than the bound are collected, whatever an id's number of rows."""
    docs = read(spark, "documents").limit(100).select("doc_id", "text")
    many = docs.unionByName(docs.limit(1).crossJoin(spark.range(3000)).drop("id"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    labels = labels.unionByName(labels.limit(3).withColumn("quality", F.lit(0)))
    model = pu_quality.learn(many, labels, most=50)
    assert np.isfinite(model.weights).all()
    assert pu_quality.score(many, model).count() == 3100


def test_risk_stays_non_negative():
    rng = np.random.default_rng(1)
    good = rng.normal(1, 1, (300, len(pu_quality.MEASURES)))
    mixed = np.concatenate([rng.normal(1, 1, (300, good.shape[1])), rng.normal(-1, 1, (100, good.shape[1]))])
    model = pu_quality.fit(good, mixed, 0.75)
    assert (model.score(mixed[:300]) >= 0.5).mean() > 0.9
    assert (model.score(mixed[300:]) >= 0.5).mean() < 0.2


# ---------------------------------------------------------------- language model


def counts_of(texts):
    single, pair, triple, first = Counter(), Counter(), Counter(), Counter()
    for text in texts:
        row = ["<s>", *brute.words(text), "</s>"]
        single.update(row)
        pair.update(zip(row, row[1:]))
        triple.update(zip(row, row[1:], row[2:]))
        first.update(zip(row, row[1:]))
    return single, pair, triple


def base(texts, text):
    count = Counter(w for t in texts for w in [*brute.words(t), None])
    n, v = sum(count.values()), len(count)
    return sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*brute.words(text), None])


def test_model_against_dictionaries(spark):
    rng = random.Random(3)
    phrase = "the quick brown fox jumps over the lazy dog"
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(80)]
    texts += [f"{rng.choice('xyz')} {phrase} {rng.choice('abc')}" for _ in range(9)] + [None, "", "A\x0bB\tc\x1cd"]
    new = [*texts, phrase, "never seen words", "the THE the", "a " * 5000]
    model = trie_lm.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), shards=5)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(new)], "i int, text string, score string")
    for row in trie_lm.score(docs, model).collect():
        assert row.score == pytest.approx(whole_score(texts, new[row.i]), rel=1e-3)
        assert row.base_score == pytest.approx(base(texts, new[row.i]), rel=1e-9)
        assert row.n_tokens == len(brute.words(new[row.i])) + 1


def whole_score(texts, text):
    """The smoothing with all pairs and triples, over plain dictionaries."""
    single, pair, triple = counts_of(texts)
    after2, after3 = Counter(a for a, _ in pair), Counter((a, b) for a, b, _ in triple)
    n, v, d = sum(c for w, c in single.items() if w != "<s>"), len(single) - 1, trie_lm.DISCOUNT

    def p1(w):
        return max(single[w] - d, 0) / n + d * v / (v + 1) / n

    def p2(a, w):
        return (max(pair[a, w] - d, 0) + d * after2[a] * p1(w)) / single[a] if single[a] else p1(w)

    def p3(a, b, w):
        c = pair[a, b]
        return (max(triple[a, b, w] - d, 0) + d * after3[a, b] * p2(b, w)) / c if c else p2(b, w)

    row = ["<s>", *brute.words(text), "</s>"]
    three = math.log10(p2(*row[:2])) + sum(math.log10(p3(*row[k - 2 : k + 1])) for k in range(2, len(row)))
    one = sum(math.log10(p1(w)) for w in row[1:])
    return max(three, one) + math.log10(1 + 10 ** -abs(three - one)) - math.log10(2)


def test_query_knows_phrases_seen_once(spark, tmp_path):
    rng = random.Random(5)
    texts = {i: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(30)) for i in range(60)}
    held = [i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2]
    train = [texts[i] for i in texts if i not in held]
    texts[held[0]] = train[0]
    texts[held[1]] = " ".join(train[1].split()[5:20])
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in trie_lm.op3_trie_lm(spark, str(tmp_path)).collect():
        assert row.score == pytest.approx(whole_score(train, texts[row.doc_id]), rel=1e-3)


def test_words_have_one_hash_wherever_they_are(monkeypatch):
    """In any text, behind any other, short or longer than what is hashed at once; other words have others."""
    rng = random.Random(8)
    words = [bytes(rng.choice(b"abc\xc3\x89") for _ in range(rng.randint(1, 9))).decode("latin1") for _ in range(400)]
    words += ["x" * 5000, "x" * 5001, "y" * 4096, "a", "aa", "aaa"]
    for piece in (trie_lm.PIECE, 4096, 100):
        monkeypatch.setattr(trie_lm, "PIECE", piece)
        seen = {}
        for _ in range(3):
            rng.shuffle(words)
            texts = [" \x0b".join(words[:200]) + "\n", None, "", "\t " + "\r".join(words[200:])]
            sequence, counts = trie_lm.sequences(texts)
            assert counts.tolist() == [len(brute.words(t)) for t in texts] and len(sequence) == counts.sum() + 12
            found, at = sequence.tolist(), 0
            for text, n in zip(texts, counts.tolist(), strict=True):
                row = found[at : at + n + 3]
                assert (row[0], row[-2], row[-1]) == (trie_lm.START, trie_lm.END, trie_lm.PAD)
                for word, value in zip(brute.words(text), row[1:-2], strict=True):
                    assert seen.setdefault(word, value) == value
                at += n + 3
        assert len(set(seen.values())) == len(seen) and len({v >> 32 for v in seen.values()}) == len(seen)


def test_order_of_two_numbers():
    rng = np.random.default_rng(2)
    first = rng.integers(0, 40, 5000).astype(np.uint64) * trie_lm.MIX
    second = rng.integers(0, 2**32, 5000).astype(np.uint64)
    order = trie_lm.ordered(first, second)
    assert (order == np.lexsort((second, first))).all()
    assert len(trie_lm.ordered(first[:0], second[:0])) == 0


def test_model_with_odd_rows(spark):
    """A null id, columns whose names differ from the results' in their case only, repeated rows."""
    rows = [(None, "a b c", 1), (3, "a b c", 1), (3, "a b c", 2), (4, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE int")
    found = trie_lm.score(docs, trie_lm.train(docs)).collect()
    assert [r.n_tokens for r in found] == [4, 4, 4, 1] and len({r.score for r in found[:3]}) == 1
    assert found[0].asDict().keys() == {"doc_id", "text", *trie_lm.ADDED}


def test_model_without_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = trie_lm.train(none)
    assert trie_lm.score(none, model).count() == 0
    row = trie_lm.score(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_language_model_query(spark):
    texts = dict(read(spark, "documents").select("doc_id", "text").collect())
    train = [t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    count = Counter(w for t in train for w in [*brute.words(t), None])
    n, v = sum(count.values()), len(count)
    rows = trie_lm.op3_trie_lm(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        tokens = [*brute.words(texts[row.doc_id]), None]
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
        assert (row.n_tokens, row.train_tokens) == (len(tokens), n)
        assert row.n_known == sum(count[w] > 0 for w in tokens)
        assert row.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, below in ((0, 10), (1, 1), (5, 100), (3000, 500), (5000, 3), (20000, 1 << 55), (2000, (1 << 64) - 1)):
        values = np.sort(rng.integers(0, below, n, dtype=np.uint64))
        buffer = np.frombuffer(elias_fano.pack(elias_fano.encode(values, below)), np.uint8)
        found = elias_fano.EliasFano(elias_fano.unpack(buffer))
        assert (found.access(np.arange(n)) == values).all()
        wanted = np.concatenate([values, rng.integers(0, below, 500, dtype=np.uint64)])
        if n:
            assert (found.successor(wanted) == np.searchsorted(values, wanted)).all()
        assert ((found.find(wanted) >= 0) == np.isin(wanted, values)).all()


# ---------------------------------------------------------------- URLs


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    after = rest[end:]
    cut = min([after.index(c) for c in "?#" if c in after], default=len(after))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, after[:cut]


def url_rule(host, path):
    fits = [
        r
        for r in url_trees.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_urls_against_plain_rules(spark):
    odd = [
        None, "", "no scheme/at/all", "http://", "HTTP://WWW.Example.ORG/es/1?a=b", "http://org/x", "http://borg/x",
        "http://a.org", "http://a.org?x=/y", "http://a.com/de/#f", "http://É.com/fr/", "x://y://z.com/fr/q",
        "http://a.example.org/en/12", "http://a.example.org/en/2", "http://a.net/\n/b",
    ]
    urls = odd + [r.url for r in read(spark, "pages", MIDDLE).collect()]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = url_trees.verdicts(pages).collect()
    assert len(rows) == len(urls)
    for row in rows:
        host, path = url_parts(urls[row.page_id])
        rule = url_rule(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule and rule.text)
        assert row.verdict == (rule.verdict if rule else "block" if row.score >= 0.5 else "allow")


def test_url_trees_learn(spark):
    rows = url_trees.lexical(url_trees.by_rules(url_trees.parts(read(spark, "pages", LARGE))))
    fold = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(4)) == 0
    known = rows.where("marked is not null")
    judged = url_trees.train(known.where(~fold)).judge(known.where(fold))
    right = (F.col("score") >= 0.5) == (F.col("marked") == "block")
    assert judged.agg(F.avg(right.cast("int"))).first()[0] > 0.95


def test_lexical_features_against_plain_python(spark):
    urls = ["", "http://a.b-c.org/x1//y?k=1&l=&=z#f", "x://É.com", "no scheme", "http://a.com/" + "ab1-" * 4000, "h://host/p?a=b?c=d"]
    urls += [r.url for r in read(spark, "pages").limit(80).collect()]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    for row in url_trees.lexical(url_trees.parts(pages)).collect():
        url, (host, path) = urls[row.page_id], url_parts(urls[row.page_id])
        count = Counter(url)
        entropy = -sum(c / len(url) * math.log2(c / len(url)) for c in count.values())
        plain = {
            "length": len(url), "host_length": len(host), "path_length": len(path),
            "depth": sum(1 for x in path.split("/") if x), "labels": sum(1 for x in host.split(".") if x),
            "digits": sum(c in "0123456789" for c in url) / max(len(url), 1), "hyphens": url.count("-"),
            "parameters": len(re.findall(r"[?&][^?&=#]+=", url)), "entropy": entropy,
        }
        assert plain == {k: pytest.approx(row[k]) for k in plain}
        names = host.split(".")
        assert (row.tld, row.domain) == (names[-1], ".".join(names[-2:]))
        assert row.segment == (path[1:].split("/")[0] if path.startswith("/") else "")


def test_a_row_is_left_out_of_its_own_rates(spark):
    """With all of its fold: rates are those of labelled URLs in other folds."""
    hosts = [(f"{'abc'[i % 3]}.{'org' if i % 2 else 'net'}", int(i % 5 < 2)) for i in range(60)]
    pages = [(i, f"http://{host}/s{i % 7}", "block" if y else "allow") for i, (host, y) in enumerate(hosts)]
    given = spark.createDataFrame(pages, "page_id int, url string, marked string")
    marked = url_trees.lexical(url_trees.parts(given)).join(given.drop("url"), "page_id")
    trees = url_trees.train(marked)
    folds = {r.page_id: r.fold for r in marked.select("page_id", url_trees.fold().alias("fold")).collect()}
    prior = sum(y for _, y in hosts) / len(hosts)
    assert len(set(folds.values())) > 2
    for learning in (True, False):
        for row in trees.features(marked, learning).collect():
            same = [k for k, (host, _) in enumerate(hosts) if host[-3:] == hosts[row.page_id][0][-3:]]
            others = [hosts[k][1] for k in same if not learning or folds[k] != folds[row.page_id]]
            expected = (sum(others) + url_trees.SMOOTH * prior) / (len(others) + url_trees.SMOOTH)
            assert row.tld_rate == pytest.approx(expected)


def test_urls_of_hosts_left_out(spark):
    """Trained without any URL of a third of the hosts, and measured on these hosts' labelled URLs."""
    rows = url_trees.lexical(url_trees.by_rules(url_trees.parts(read(spark, "pages", LARGE)))).where("marked is not null")
    fold = F.pmod(F.xxhash64("host", F.lit(2)), F.lit(3)) == 0
    judged = url_trees.train(rows.where(~fold)).judge(rows.where(fold))
    right = (F.col("score") >= 0.5) == (F.col("marked") == "block")
    assert judged.agg(F.avg(right.cast("int"))).first()[0] > 0.9


def test_urls_of_one_kind_or_none(spark):
    one = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_trees.verdicts(one).collect()} == {"allow"}
    assert url_trees.verdicts(one.where(F.lit(False))).count() == 0


def test_url_query_is_whole(spark):
    assert url_trees.op5_url_trees(spark, SMALL).count() == read(spark, "pages").count()


# ---------------------------------------------------------------- toxicity


def test_toxicity_of_documents_left_out(spark):
    docs, labels = read(spark, "documents", LARGE), read(spark, "labels", LARGE)
    english = docs.where("lang = 'en'")
    model = ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(english, labels.where("doc_id % 2 = 0")))
    rows = ordinal_toxicity.score(english, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "y"), "doc_id")
    rows = rows.toPandas()
    toxic = rows["y"] == 1
    assert rows["toxic"][toxic].mean() > 0.9
    assert rows["toxic"][~toxic].mean() < 0.01
    assert (np.diff(model.thresholds) > 0).all()


def test_regression_recovers_grades():
    rng = np.random.default_rng(2)
    n, width = 3000, 12
    x = rng.random((n, width)) < 0.2
    score = x @ np.linspace(-2, 3, width) + rng.logistic(size=n)
    grade = np.searchsorted([1.0, 3.0], score)
    owner, at = np.nonzero(x)
    weights, thresholds = ordinal_toxicity.regress(owner, at, np.ones(len(at)), grade, width)
    assert np.abs(weights - np.linspace(-2, 3, width)).max() < 0.5
    assert np.abs(thresholds - [1, 3]).max() < 0.3


def test_toxicity_rows_and_odd_texts(spark):
    words = ["fine", "good", "plain", "text", "here"]
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(words, k=20)) + " foul vile" * (i % 4 == 0), i) for i in range(200)]
    rows += [(None, None, 0), (7, "", 0), (7, "FOUL, vile! foul " * 9000, 0), (500, "foul vile", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)] + [(160, None), (None, 1)], "doc_id long, toxic int")
    model = ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(docs, labels))
    found = ordinal_toxicity.score(docs, model).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.toxic == ("foul" in (row.text or "").lower())
        assert 0 <= row.severity <= ordinal_toxicity.GRADES
    kept = ordinal_toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum("foul" not in (t or "").lower() for _, t, _ in rows)


def test_features_and_association_against_plain_python(spark):
    texts = [(i, f"{'vile ' * (i % 4)}word{i % 3} Ünd x_{i % 2}, don't", int(i % 4 > 1)) for i in range(60)] + [(99, None, 0)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id int, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id int, toxic int")
    found = ordinal_toxicity.choose_features(ordinal_toxicity.labelled_sample(docs, labels), 8)
    words = {i: set(re.findall(r"\w+", (t or "").lower())) for i, t, _ in texts}
    assert all(set(ordinal_toxicity.features(t)) == words[i] for i, t, _ in texts)
    toxic, clean = (sum(y == k for *_, y in texts) for k in (1, 0))
    scores = {}
    for word in set().union(*words.values()):
        a, b = (sum(word in words[i] for i, _, y in texts if y == k) for k in (1, 0))
        n = toxic + clean
        chi = n * (a * clean - b * toxic) ** 2 / (toxic * clean * (a + b) * (n - a - b + 1))
        scores[word] = chi, math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
    best = sorted(scores, key=lambda w: (-scores[w][0], w.encode()))[:8]
    assert [w for w, _ in found] == best
    assert [odds for _, odds in found] == pytest.approx([scores[w][1] for w in best])


def test_labels_that_differ_and_ids_that_repeat(spark):
    """An id labelled both ways is toxic, an id is one row of the sample, and the bound holds for rows."""
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, None), (None, "d")] + [(4, "e")] * 500, "doc_id int, text string")
    marks = [(1, 0), (1, 1), (2, 0), (3, 1), (None, 1), (4, 0), (4, None), (2, 7)]
    labels = spark.createDataFrame(marks, "doc_id int, toxic int")
    rows = ordinal_toxicity.labelled_sample(docs, labels).orderBy("doc_id").collect()
    assert [(r.doc_id, r.toxic) for r in rows] == [(1, 1), (2, 0), (3, 1), (4, 0)]
    assert rows[0].text in ("a", "b") and rows[2].text == ""
    again = ordinal_toxicity.labelled_sample(docs.repartition(5), labels).orderBy("doc_id").collect()
    assert again == rows
    assert ordinal_toxicity.labelled_sample(docs, labels, most=2).count() == 2


def test_toxicity_columns_that_differ_in_case(spark):
    docs = spark.createDataFrame([(1, "x", 5, "y")], "doc_id int, text string, Severity int, TOXIC string")
    none = spark.createDataFrame([], "doc_id int, toxic int")
    found = ordinal_toxicity.score(docs, ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(docs, none)))
    assert found.columns == ["doc_id", "text", "severity", "p_toxic", "grade", "toxic"] and found.count() == 1


def test_no_toxic_labels(spark):
    docs = spark.createDataFrame([(1, "foul"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    model = ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(docs, labels))
    assert [(r.severity, r.toxic) for r in ordinal_toxicity.score(docs, model).collect()] == [(0.0, False)] * 2
    none = docs.where(F.lit(False))
    assert ordinal_toxicity.keep_clean(none, labels.where(F.lit(False))).count() == 0


def test_few_toxic_labels(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(8)) + " vile" * (i % 4 == 1) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(docs, labels))
    assert len(model.thresholds)
    assert all(r.toxic for r in ordinal_toxicity.score(docs, model).collect() if "vile" in r.text)
    kept = ordinal_toxicity.keep_clean(docs, labels).collect()
    assert kept and not any("vile" in r.text for r in kept)
    empty = ordinal_toxicity.fit(ordinal_toxicity.labelled_sample(docs.withColumn("text", F.lit("")), labels))
    assert len(empty.thresholds)


def test_toxicity_query_is_whole(spark):
    assert ordinal_toxicity.op6_ordinal_toxicity(spark, SMALL).count() == read(spark, "documents").count()


# ---------------------------------------------------------------- neighbours


def neighbours(rows, query_id, point, k):
    best = {}
    for i, v in rows:
        if i != query_id:
            d = math.sqrt(sum((a - b) ** 2 for a, b in zip(v, point)))
            best[i] = min(d, best.get(i, d))
    return sorted((d, i) for i, d in best.items())[:k]


@pytest.mark.parametrize("folder", [SMALL, LARGE])
def test_recall_against_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in read(spark, "embeddings", folder).collect()]
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    found = {}
    for r in pstable_ann.op7_pstable_ann(spark, folder).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for query_id, near in found.items():
        near.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in near] == list(range(1, 11))
        d = np.sqrt(((x - x[ids == query_id][0]) ** 2).sum(axis=1))
        place = dict(zip(ids.tolist(), d.tolist()))
        assert all(r.score == pytest.approx(place[r.vec_id], abs=1e-12) for r in near)
        assert [(r.score, r.vec_id) for r in near] == sorted((r.score, r.vec_id) for r in near)
        best = [i for i in ids[np.lexsort((ids, d))].tolist() if i != query_id][:10]
        hits += len({r.vec_id for r in near} & set(best))
    assert hits / (10 * len(found)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, i / 10, 2.0]) for i in range(1, 9)]
    copies = [(i, [1.0, 0.5, 2.0]) for i in range(40, 10, -1)]
    bad = [(50, None), (51, [0.0, 0.0, 0.0]), (52, [nan, 1.0, 1.0]), (53, [inf, 1.0, 1.0]), (54, [None, 1.0, 1.0]),
           (55, [1.0]), (None, [1.0, 1.0, 1.0]), (3, [1.0, 0.3, 2.0])]
    vectors = spark.createDataFrame([(i, v, 0) for i, v in good + copies + bad], "vec_id long, embedding array<double>, rank int")
    rows = pstable_ann.search(vectors, vectors.where("vec_id is null or vec_id in (5, 20, 51, 52)"), recall=1.0).collect()
    assert {r.query_id for r in rows} == {5, 20}
    for query_id in (5, 20):
        near = sorted((r for r in rows if r.query_id == query_id), key=lambda r: r["rank"])
        wanted = neighbours(good + copies, query_id, dict(good + copies)[query_id], 10)
        assert [(pytest.approx(d), i) for d, i in wanted] == [(r.score, r.vec_id) for r in near]


def test_few_or_no_vectors(spark):
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in pstable_ann.search(two, two.where("vec_id = 1"), recall=1.0).collect()] == [(1, 2)]
    none = two.where(F.lit(False))
    assert pstable_ann.search(none, none).count() == 0
    assert pstable_ann.search(two, none).count() == 0


def test_large_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(pstable_ann, "GROUP", 20)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 0.05 + 1).tolist()) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = pstable_ann.search(vectors, vectors.where("vec_id < 30"), recall=0.97).collect()
    assert len(found) == 300
    hits = 0
    for query_id in range(30):
        wanted = {i for _, i in neighbours(rows, query_id, rows[query_id][1], 10)}
        hits += len(wanted & {r.vec_id for r in found if r.query_id == query_id})
    assert hits >= 270


def test_recall_on_two_densities(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(4000, 16)) * np.where(rng.random(4000) < 0.45, 5.0, 1.0)[:, None]
    vectors = spark.createDataFrame(list(enumerate(points.tolist())), "vec_id long, embedding array<double>").repartition(4)
    hits = Counter()
    for r in pstable_ann.search(vectors, vectors.where("vec_id < 200")).collect():
        d = ((points - points[r.query_id]) ** 2).sum(axis=1)
        hits[r.query_id] += r.vec_id in np.argsort(d)[1:11]
    assert sum(hits.values()) / 2000 > 0.95


def test_all_rows_where_no_tables_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(pstable_ann, "TABLES", (2,))
    monkeypatch.setattr(pstable_ann, "GROUP", 40)
    rng = np.random.default_rng(7)
    spread = rng.choice([1.0, 30.0], 300)
    rows = [(i, (rng.normal(size=24) * spread[i]).tolist()) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(pstable_ann, "_visit_ranks", lambda t, s, x, q=None: np.full((2, len(s), len(x)) if q is None else (2, len(x)), 729))
    found = pstable_ann.search(vectors, vectors.where("vec_id < 60")).collect()
    assert len(found) == 600
    for r in found:
        wanted = neighbours(rows, r.query_id, rows[r.query_id][1], 10)
        assert r.vec_id == wanted[r["rank"] - 1][1]
