"""Near-dedup at a Jaccard similarity against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest

from corpora import clashing, edge_rows, random_texts, rows, table
from inkmill.llm import common, jaccard, simhash


def brute_sets(texts, k=5):
    out = []
    for t in texts:
        w = (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def brute_kept(found, least=Fraction(4, 5), k=5):
    """How many groups there are, and the smallest id of each."""
    sets, root = brute_sets([r[1] for r in found], k), list(range(len(found)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a == sets[j] or both and both >= least * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(found):
        groups.setdefault(find(i), []).append(r[0])
    return sorted((min((d is None, d or 0) for d in g) for g in groups.values()))


def near_texts(seed, n=40):
    """Texts with copies that have one to nine words changed, so similarities on both sides of 0.8."""
    r, out = random.Random(seed), []
    for i in range(n):
        words = [f"w{r.randrange(10**6)}" for _ in range(r.choice((30, 120, 400)))]
        out.append(" ".join(words))
        for _ in range(r.randrange(4)):
            for _ in range(r.randrange(1, 10)):
                words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
            out.append("\n".join(words))
    return out


@pytest.mark.parametrize("chunk, crowd", [(jaccard.CHUNK, simhash.CHUNK), (700, 3)])
@pytest.mark.parametrize("found", [edge_rows(), rows(random_texts(120, 3)), rows(near_texts(4))])
def test_dedup(spark, monkeypatch, found, chunk, crowd):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    if crowd == 3:  # blocks count as crowded from three fingerprints on
        monkeypatch.setattr(simhash, "CHUNK", crowd)
        monkeypatch.setattr(simhash, "SAMPLED", 1)
        monkeypatch.setattr(simhash, "ALL_PAIRS", 2)
    docs = clashing(spark, found)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == brute_kept(found)


def test_other_parameters_and_no_rows(spark):
    found = rows(near_texts(6, 15))
    got = simhash.near_dedup(table(spark, found), shingle=3, similarity=0.6)
    assert sorted((False, r["doc_id"]) for r in got.collect()) == brute_kept(found, Fraction(3, 5), 3)
    assert simhash.near_dedup(table(spark, found).limit(0)).count() == 0


def test_sets_of_small_pieces(monkeypatch):
    text = (" ".join(f"W{i * i % 1009}" for i in range(500)) + " \n").encode()
    want, real = jaccard.shingle_set(text, 5), common.word_pieces
    assert len(want) == len(brute_sets([text.decode()])[0])
    for size in (1, 7, 64):
        monkeypatch.setattr(jaccard, "word_pieces", lambda d, size=size: real(d, size))
        assert (jaccard.shingle_set(text, 5) == want).all()


def test_wide_fingerprints():
    r = np.random.default_rng(3)
    for n in (1, 2, 9, 239, 240, 241, 700):
        h = r.integers(0, 1 << 64, n, dtype=np.uint64)
        got = simhash.wide_fingerprint(h)
        assert len(got) == simhash.WIDE and int(got[0]) == sum(1 << k for k in range(64) if 2 * sum(int(x) >> k & 1 for x in h) > n)
        assert (got == simhash.wide_fingerprint(r.permutation(h))).all()
    assert not simhash.wide_fingerprint(np.zeros(0, np.uint64)).any()


@pytest.mark.parametrize("n", [1000, 1 << 18, 1 << 26])
def test_pairs_at_the_threshold_meet(n):
    """Of pairs at exactly 0.8 hardly any shares no block, or is too far apart in the first 64 bits."""
    r = np.random.default_rng(7)
    blocks, lost = simhash.wide_blocks(n, 0.8), 0
    for _ in range(600):
        k = int(r.integers(1, 40))
        h = r.integers(0, 1 << 64, 10 * k, dtype=np.uint64)
        a, b = (simhash.wide_fingerprint(x) for x in (h[: 9 * k], h[k:]))
        differ = np.unpackbits((a ^ b).view(np.uint8), bitorder="little")
        lost += differ[blocks].any(axis=1).all() or int(a[0] ^ b[0]).bit_count() > simhash.wide_distance(0.8)
    assert lost <= 12


def test_repeated_rows_and_ids(spark):
    """Rows that agree in id and text count once, also where others of their group go."""
    words = [f"w{i}" for i in range(100)]
    near = " ".join(["x", *words[1:]])
    found = [(1, " ".join(words), "en", "s", 1)] * 3 + [(2, near, "en", "s", 1)] * 2 + [(1, "quite another text", "en", "s", 1), (None, near, None, None, None), (3, None, "en", "s", 1), (4, "", "en", "s", 1)]
    got = simhash.near_dedup(clashing(spark, found)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == [(1, "quite another text"), (1, " ".join(words)), (3, "")]


def test_pipeline_drops_copies_beyond_four_bits(spark):
    cp = pytest.importorskip("corpus_pipeline")
    words = [f"w{i}" for i in range(200)]
    changed = [f"x{i}" if i in (40, 90, 150) else w for i, w in enumerate(words)]
    texts = [" ".join(words), " ".join(changed)]
    a, b = brute_sets(texts)
    assert 0.8 <= len(a & b) / len(a | b) < 0.9
    x, y = (simhash.fingerprint(t.encode()) for t in texts)
    assert (x ^ y).bit_count() > simhash.DISTANCE
    assert [r["doc_id"] for r in cp.drop_near_copies(spark, table(spark, rows(texts)), "").collect()] == [0]
