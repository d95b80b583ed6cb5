"""Language identification and the ordinal classifier against plain recomputations, and the bounds of what they are fitted on."""

import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpora import clashing, edge_rows, random_texts, table
from inkmill.llm import language, ordinal

M32 = (1 << 32) - 1


def plain_vector(text):
    """bin -> logarithm of its count, letter by letter."""
    letters = [x for c in text for x in ("σ" if c == "Σ" else c.lower())]
    clean = re.sub(" +", " ", " " + "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in letters) + " ")
    counts = Counter()
    for i in range(len(clean) - 1):
        two = ((ord(clean[i]) * 0x9E3779B1 & M32) ^ ord(clean[i + 1])) * 0x85EBCA6B & M32
        counts[two >> 32 - language.BITS] += 1
        if i + 2 < len(clean):
            counts[((two ^ ord(clean[i + 2])) * 0xC2B2AE35 & M32) >> 32 - language.BITS] += 1
    return {k: math.log1p(n) for k, n in counts.items()}


TEXTS = ["", "a", "  ", "abc。abc", "ΑΣ ΣΑ Σ", "İstanbul ﬁn Ǆ", "हिन्दी में लिखा", "🙂 héllo\t\n\nwörld 12 x", "x" * 50] + random_texts(20, 5)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, language.PIECE])
def test_vector(piece):
    for text in TEXTS:
        got, want = language.vector(text, piece), plain_vector(text)
        assert set(np.flatnonzero(got).tolist()) == set(want)
        assert all(abs(got[k] - x) < 1e-5 for k, x in want.items())


def spoken(lang, r):
    """A text whose words look alike within a language."""
    made = random.Random(lang)
    words = ["".join(made.choices({"aa": "abcdeo", "bb": "nopqrsta", "cc": "uvwxyzei"}[lang], k=made.randint(2, 7))) for _ in range(80)]
    return " ".join(r.choices(words, k=r.randint(3, 120)))


def unit(x):
    return x / max(np.linalg.norm(x), 1e-12)


def plain_model(texts, langs):
    """The same model in doubles, one vector after another."""
    logs = np.zeros((len(texts), language.DIMENSIONS))
    for i, t in enumerate(texts):
        for k, x in plain_vector(t).items():
            logs[i, k] = x
    idf = np.array([math.log((1 + len(texts)) / (1 + sum(logs[:, k] > 0))) + 1 for k in range(language.DIMENSIONS)])
    model = {}
    for name in sorted(set(langs)):
        x = [unit(v * idf) for v, n in zip(logs, langs) if n == name]
        sizes = [max(int((v > 0).sum()), 1) for v, n in zip(logs, langs) if n == name]
        mean = sum(x) / len(x)
        centres = [max(x, key=lambda v: float(v @ mean))]
        while len(centres) < language.CLUSTERS:
            centres.append(min(x, key=lambda v: max(float(v @ c) for c in centres)))
        for _ in range(12):
            own = [max(range(len(centres)), key=lambda j: float(v @ centres[j])) for v in x]
            groups = [[v for v, j in zip(x, own) if j == k] for k in range(len(centres))]
            centres = [unit(sum(g) / len(g)) if g else c for g, c in zip(groups, centres)]
        mean = unit(mean)

        def floor(c, x=x, sizes=sizes, mean=mean):
            like = sorted(range(len(x)), key=lambda i: abs(math.log2(sizes[i]) - c))[: language.NEAREST]
            return language.REJECT * float(np.quantile([float(x[i] @ mean) * math.sqrt(min(1, 2**c / sizes[i])) for i in like], language.LOW))

        model[name] = centres, mean, floor
    return idf, model


def test_language_against_a_plain_model(spark):
    r = random.Random(8)
    found = [(i, spoken(lang, r), lang, "s", 1) for i, lang in enumerate(["aa", "bb", "cc"] * 70)]
    found += [(1000, "漢字仮名交じり文" * 20, None, "s", 1), (1001, "x q z j k " * 9, None, "s", 1), (1002, "aa", None, "s", 1)]
    docs = table(spark, found)
    got = {x["doc_id"]: x for x in language.predict(docs, language.fit(docs)).collect()}
    train = [(t, lang) for i, t, lang, *_ in found if lang and zlib.crc32(str(i).encode()) % 3 != 1]
    # the order of the sample is that of hashes; ties in the clustering aside it doesn't matter
    idf, model = plain_model(*zip(*sorted(train)))
    for i, text, *_ in found:
        v = np.zeros(language.DIMENSIONS)
        for k, x in plain_vector(text).items():
            v[k] = x
        x = unit(v * idf)
        score, name = max((max(float(x @ c) for c in centres), n) for n, (centres, _, _) in model.items())
        assert got[i]["lang_pred"] == name and abs(got[i]["score"] - min(max(score, 0), 1)) < 1e-4
        near = float(x @ model[name][1])
        bound = model[name][2](int(math.log2(max(int((v > 0).sum()), 1))))
        assert abs(near - bound) < 1e-5 or got[i]["rejected"] == (near < bound)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ALL", 60)
    r = random.Random(9)
    docs = table(spark, [(i, spoken(("aa", "bb", "cc")[i % 3], r), f"l{i % 12}", "s", 1) for i in range(600)])
    seen = []
    monkeypatch.setattr(language, "fit_vectors", lambda langs, logs: seen.extend(langs))
    language.fit(docs)
    assert Counter(seen) == {f"l{i}": 5 for i in range(12)}


def plain_features(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    if not words:
        return {ordinal.DIMENSIONS}
    edges = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    bins = [xxhash.xxh32_intdigest(w.strip(edges).lower().encode()) % ordinal.DIMENSIONS for w in words]
    n, found = len(words), set(bins)
    symbols = sum(any(c in "#*$%&|<>" for c in w) for w in words)
    capitals = sum(len(w.strip(edges)) > 1 and w.strip(edges).isupper() for w in words)
    tenth = lambda x: min(10 * x // n, 9)
    again = tenth(n - len(found)) if n >= 20 else 10
    return found | {ordinal.DIMENSIONS + 1 + tenth(symbols) + (symbols > 0), ordinal.DIMENSIONS + 14 + tenth(capitals), ordinal.DIMENSIONS + 26 + again}


def sigmoid(x):
    return 1 / (1 + math.exp(-max(min(x, 40), -40)))


def graded_texts(n):
    r = random.Random(4)
    words = {0: "foul vile HATE mob".split(), 1: "spam buy $$$ cheap".split(), 2: "study result method measured".split()}
    both = [f"common{i}" for i in range(60)]
    return [(i, " ".join(r.choices(words[i % 3], k=r.randint(1, 4)) + r.choices(both, k=r.randint(5, 40)))) for i in range(n)]


def test_features():
    for text in [*TEXTS, *(r[1] or "" for r in edge_rows()), *(t for _, t in graded_texts(30))]:
        assert set(ordinal.features(text.encode()).tolist()) == plain_features(text)


def test_ordinal_against_plain_loss(spark):
    """The fit is a minimum of the penalised loss, computed one document at a time; scores and tails follow from the weights."""
    texts = graded_texts(300)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 2), int(i % 3 == 0)) for i, _ in texts], "doc_id long, quality int, toxic int")
    model = ordinal.fit(docs, labels)
    feats, grades = {i: plain_features(t) for i, t in texts}, {i: i % 3 for i, _ in texts}
    often = Counter(x for f in feats.values() for x in f)

    def loss(weights, thresholds):
        total = 0.0
        for i, f in feats.items():
            s = sum(weights.get(x, 0.0) for x in f if often[x] >= ordinal.MIN_DOCS)
            tails = [1.0, *(sigmoid(s - t) for t in thresholds), 0.0]
            total -= math.log(max(tails[grades[i]] - tails[grades[i] + 1], 1e-12))
        return total / len(feats) + ordinal.PENALTY * sum(map(abs, weights.values()))

    fitted = {int(k): float(model.weights[k]) for k in np.flatnonzero(model.weights)}
    assert all(often[k] >= ordinal.MIN_DOCS for k in fitted)
    thresholds = model.thresholds.tolist()
    least = loss(fitted, thresholds)
    assert least < 0.5 * loss({}, thresholds)
    r = random.Random(1)
    for k in r.sample(sorted(often), 40) + sorted(fitted, key=lambda k: -abs(fitted[k]))[:10]:
        if often[k] >= ordinal.MIN_DOCS:
            for step in (-0.05, 0.05):
                assert loss(fitted | {k: fitted.get(k, 0.0) + step}, thresholds) > least - 2e-5
    for step in (-0.05, 0.05):  # the thresholds, which have no penalty, take plain steps and stop a little short of the minimum
        assert loss(fitted, [thresholds[0] + step, thresholds[1]]) > 0.99 * least
        assert loss(fitted, [thresholds[0], thresholds[1] + step]) > 0.99 * least
    for row in ordinal.score(docs, model).collect():
        s = sum(fitted.get(x, 0.0) for x in feats[row["doc_id"]])
        tails = [sigmoid(s - t) for t in thresholds]
        assert abs(row["tail_prob"] - tails[1]) < 1e-6 and abs(row["expected_grade"] - sum(tails)) < 1e-6
        assert row["selected"] == (row["tail_prob"] >= ordinal.SELECT)


def test_rows_that_are_fitted(spark):
    """One text an id, however many rows it has, and no more features than the bound."""
    found = [(1, "same text", "en", "s", 1)] * 500 + [(1, f"other {i}", "en", "s", 1) for i in range(50)] + [(i, f"w{i} a b c d", "en", "s", 1) for i in range(2, 40)]
    docs = clashing(spark, found)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    rows = ordinal.training_rows(docs, labels).collect()
    assert len(rows) == 39 == len({r["mark"] for r in rows})
    few = ordinal.training_rows(docs, labels, n_features=100).collect()
    assert 0 < len(few) < 39 and sum(r["n"] for r in few) <= 100
    first = {r["mark"] for r in sorted(rows, key=lambda r: r["mark"])[: len(few)]}
    assert {r["mark"] for r in few} == first
    names = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    named = labels.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    assert ordinal.score(names, ordinal.fit(names, named)).where("doc_id = 'd7'").count() == 1
