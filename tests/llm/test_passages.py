"""Repeated windows (substring dedup, sparse suffix arrays) against brute force."""

import hashlib
import re
from itertools import groupby

import numpy as np
import pytest

from corpora import clashing, edge_rows, listed, random_texts, rows, table
from inkmill.llm import repeats, substring_dedup, suffix_array


def brute(found, n):
    """(doc_id, words, removed, hash of what is left, shared) of each row; equal rows are one document."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in found})
    order = []
    for key, members in groupby(docs, key=lambda d: d[:2]):  # documents of one id come in the order of a hash; none of our tests depends on it
        order += list(members)
    words = {d: re.findall(rb"[^\x20\x09-\x0D]+", d[2].encode()) for d in order}
    count, first = {}, {}
    for d in order:
        for i in range(len(words[d]) - n + 1):
            w = tuple(words[d][i : i + n])
            count[w] = count.get(w, 0) + 1
            first.setdefault(w, (d, i))
    out = []
    for r in found:
        d = (r[0] is None, r[0] or 0, r[1] or "")
        w = words[d]
        gone, shared = [False] * len(w), [False] * len(w)
        for i in range(len(w) - n + 1):
            window = tuple(w[i : i + n])
            if first[window] != (d, i):
                gone[i : i + n] = [True] * n
            if count[window] > 1:
                shared[i : i + n] = [True] * n
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(left).hexdigest(), sum(shared)))
    return sorted(out, key=repr)


CORPORA = [rows(random_texts(80, 11)), rows(random_texts(60, 12, vocabulary=4)), [r for r in edge_rows() if r[1] not in ("another text with the same id", "no id here")], [(1, "p " + "a b c d e " * 9, "en", "s", 1)] * 3]


@pytest.mark.parametrize("found", CORPORA)
@pytest.mark.parametrize("n", [20, 14])
def test_removed_words(spark, found, n):
    got = substring_dedup.remove_repeats(table(spark, found), window=n)
    assert listed(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted((r[:4] for r in brute(found, n)), key=repr)


@pytest.mark.parametrize("found", CORPORA)
@pytest.mark.parametrize("n", [50, 12])
@pytest.mark.parametrize("hot", [4096, 6, 0])
def test_shared_passages(spark, found, n, hot):
    """Whichever anchors go the way of the most frequent ones: none, some, all."""
    got = suffix_array.shared_passages(clashing(spark, found).repartition(3), window=n, hot=hot)
    assert listed(got, "doc_id", "n_words", "n_removed", "n_shared") == sorted(((r[0], r[1], r[2], r[4]) for r in brute(found, n)), key=repr)
    for r in got.collect():
        assert sum(s["length"] for s in r["spans"]) == r["n_removed"] and all(s["length"] >= n for s in r["spans"])


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "4")
    yield
    spark.conf.unset(key)


def test_many_batches_and_runs(spark, small_batches, monkeypatch):
    """Runs of a few documents, batches of four rows, several shares."""
    for module, name, value in ((repeats, "RUN_WORDS", 300), (suffix_array, "RUN", 40), (repeats, "SHARE_BYTES", 500)):
        monkeypatch.setattr(module, name, value)
    found = rows(random_texts(90, 13, vocabulary=12))
    want = brute(found, 14)
    got = substring_dedup.remove_repeats(table(spark, found), window=14)
    assert listed(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted((r[:4] for r in want), key=repr)
    for hot in (4096, 9):
        got = suffix_array.shared_passages(table(spark, found), window=14, hot=hot)
        assert listed(got, "doc_id", "n_words", "n_removed", "n_shared") == sorted(((r[0], r[1], r[2], r[4]) for r in want), key=repr)


def test_shares_are_even():
    """Also those of minimisers, whose hashes are the least of many."""
    r = np.random.default_rng(2)
    s = suffix_array.scheme()
    grams = s.anchors(r.integers(0, 1 << 63, 40_000, dtype=np.uint64))[1]
    sizes = np.bincount(repeats.share_of(grams, 8).astype(int), minlength=8)
    assert sizes.max() < 1.3 * sizes.mean()


def test_two_orders_of_suffixes():
    """Windows around equal beginnings, by the two orders and pair by pair."""
    r = np.random.default_rng(5)
    reach, n = 3, 60
    head = r.integers(1, 3, (2, n)).astype(np.uint64)
    sides = []
    for _ in range(2):
        words = r.integers(1, 3, (n, reach))
        words[np.arange(reach) >= r.integers(0, reach + 1, n)[:, None]] = 0
        sides.append(words)
    left, right = (np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(n, reach, 8)[:, :, : suffix_array.WORD_BYTES]).reshape(n, -1) for x in sides)
    earlier, elsewhere = suffix_array.matches(head[0], head[1], left, right, reach)
    for o in range(reach + 1):
        window = lambda i: (*head[:, i], *sides[0][i, :o], *sides[1][i, : reach - o])  # noqa: E731, B023
        seen = [window(i) for i in range(n)]
        for i in range(n):
            whole = 0 not in seen[i]
            assert elsewhere[i, o] == (whole and seen.count(seen[i]) > 1) and earlier[i, o] == (whole and seen[i] in seen[:i])


def test_ids_must_be_integers(spark):
    docs = spark.createDataFrame([("a", "text")], "doc_id string, text string")
    for operator in (substring_dedup.remove_repeats, suffix_array.shared_passages):
        with pytest.raises(TypeError):
            operator(docs)


def test_ids_of_several_documents(spark):
    p = " ".join(f"w{i}" for i in range(25))
    found = [(1, p, "e", "s", 1), (1, p, "e", "s", 1), (1, "x " + p, "e", "s", 1), (None, p + " y", "e", "s", 1), (None, "z " + p, "e", "s", 1), (2, p, "e", "s", 1)]
    got = listed(substring_dedup.remove_repeats(clashing(spark, found)), "doc_id", "n_words", "n_removed")
    assert [r for r in got if r[0] == 2] == [(2, 25, 25)] and [r[2] for r in got if r[0] is None] == [25, 25]
    one = [r for r in got if r[0] == 1]
    assert one in ([(1, 25, 0), (1, 25, 0), (1, 26, 25)], [(1, 25, 25), (1, 25, 25), (1, 26, 0)])
    empty = clashing(spark, found).limit(0)
    assert substring_dedup.remove_repeats(empty).count() == 0 and suffix_array.shared_passages(empty).count() == 0


def test_kept_text(spark):
    p = " ".join(f"w{i}" for i in range(30))
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.remove_repeats(table(spark, rows([p, "a " + p + "\nb", p, "c"]))).collect()}
    assert got == {0: None, 1: "a b", 2: "", 3: None}


def test_every_two_positions_share_an_anchor():
    s = substring_dedup.scheme()
    assert s.gram + s.period - 1 == s.length == 20
    at = set(s.anchors(np.arange(200, dtype=np.uint64))[0].tolist())
    for i in range(60):
        for j in range(60):
            assert any(i + k in at and j + k in at for k in range(s.period))


def test_equal_windows_keep_a_suffix_at_the_same_place():
    s = suffix_array.scheme()
    r = np.random.default_rng(1)
    passage = r.integers(0, 1 << 63, 50, dtype=np.uint64)
    places = []
    for before in (0, 13, 40):
        words = np.concatenate([r.integers(0, 1 << 63, before, dtype=np.uint64), passage, r.integers(0, 1 << 63, 30, dtype=np.uint64)])
        places.append({p - before for p in s.anchors(words)[0].tolist() if 0 <= p - before <= 25})
    assert places[0] & places[1] & places[2]


def test_packing_of_columns():
    a, b = np.array([1, 300, 1 << 30], np.uint32), np.array([7, 1 << 40, 3], np.uint64)
    x, y = repeats.load(repeats.dump(a, b), 4, 8)
    assert x.tolist() == a.tolist() and y.tolist() == b.tolist()
    assert [len(z) for z in repeats.load(repeats.dump(a[:0], b[:0]), 4, 8)] == [0, 0]
