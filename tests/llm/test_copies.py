"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpora import clashing, edge_rows, listed, random_texts, rows, table
from inkmill.llm import common, components, exact_dedup, simhash


def brute_exact(found):
    groups = defaultdict(list)
    for r in found:
        groups[re.sub("[\x20\x09-\x0d]", "", r[1] or "")].append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        kept = False
        for r in members:
            first = not kept and (r[0], len(r[1] or "")) == (best[0], len(best[1] or ""))
            kept = kept or first
            out.append((r[0], best[0], len(members), first, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("found", [edge_rows(), rows(random_texts(120, 1)), rows(["x", "x ", " x"] * 20)])
def test_exact_groups(spark, found):
    assert listed(exact_dedup.groups(table(spark, found)), *EXACT) == brute_exact(found)


def test_exact_with_collisions_at_every_level(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_BYTES", 8)
    found = rows(random_texts(40, 2))
    few = lambda c: F.pmod(F.xxhash64(c), F.lit(7))  # noqa: E731  seven hashes for all blocks
    monkeypatch.setattr(exact_dedup, "_pair_hash", lambda p: F.pmod(F.xxhash64(p["a"]["h"], p["a"]["r"], p["b"]["h"], p["b"]["r"]), F.lit(5)))
    assert listed(exact_dedup.groups(table(spark, found), hashed=few), *EXACT) == brute_exact(found)


def test_exact_dedup_keeps_all_columns(spark):
    found = edge_rows()
    docs = clashing(spark, found)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    want = sorted((r[0] for r in brute_exact(found) if r[3]), key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want
    assert exact_dedup.dedup(docs.limit(0)).count() == 0 and exact_dedup.groups(docs.limit(0)).count() == 0


def brute_fingerprint(text):
    words = [w.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    a, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprints_of_pieces():
    for t in ("", "A b C d e", "x", "Éa ÉA É a b", " ".join(f"W{i}" for i in range(300))):
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t)
    text = " ".join(f"w{i * i % 1009}" for i in range(3000)).encode()
    whole = simhash.fingerprint(text)
    pieces = [w for p in common.word_pieces(text, 50) for w in p]
    assert pieces == text.split() and whole == brute_fingerprint(text.decode())


def test_fingerprint_is_the_same_in_small_pieces(monkeypatch):
    text = (" ".join(f"w{i * i % 1009}" for i in range(500)) + " \n").encode()
    want = simhash.fingerprint(text)
    real = common.word_pieces
    for size in (1, 7, 64):
        monkeypatch.setattr(simhash, "word_pieces", lambda d, size=size: real(d, size))
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("found", [edge_rows(), rows(random_texts(150, 3))])
def test_near_groups(spark, found):
    ids, fps = [r[0] for r in found], [brute_fingerprint(r[1]) for r in found]
    got = simhash.near_groups(simhash.fingerprints(table(spark, found))).select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("f"), "component_id")
    assert listed(got) == sorted(((d, f"{f:016x}", c) for d, f, c in zip(ids, fps, brute_components(ids, fps))), key=repr)


@pytest.mark.parametrize("all_pairs, chunk, finer", [(16, 4096, 8), (4, 4096, 8), (2, 8, 8), (2, 8, 5), (2, 4, 6)])
def test_crowds_of_near_copies(spark, monkeypatch, all_pairs, chunk, finer):
    """Fingerprints around a few centres, up to 6 bits off, and chains of steps of 4 bits, in every way of searching a group."""
    monkeypatch.setattr(simhash, "ALL_PAIRS", all_pairs)
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "FINER", finer)
    r = np.random.default_rng(5)
    fps = set()
    for centre in r.integers(0, 1 << 64, 3, dtype=np.uint64).tolist():
        for _ in range(120):
            fps.add(centre ^ sum(1 << int(k) for k in r.choice(64, r.integers(0, 7), replace=False)))
        step = centre
        for k in range(0, 64, 5):
            step ^= 0b11110 << k & (1 << 64) - 1
            fps.add(step)
    fps = sorted(fps)
    prints = spark.createDataFrame([(i, simhash._signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long").repartition(5)
    got = dict(listed(simhash.near_groups(prints), "doc_id", "component_id"))
    assert [got[i] for i in range(len(fps))] == brute_components(list(range(len(fps))), fps)


@pytest.mark.parametrize("n", [10, 10**7, 10**9, 10**11])
def test_every_close_pair_shares_a_table(n):
    masks = [m & (1 << 64) - 1 for m in simhash.block_masks(n)]
    r = np.random.default_rng(n % 97)
    for _ in range(300):
        flipped = sum(1 << int(k) for k in r.choice(64, 4, replace=False))
        assert any(flipped & m == 0 for m in masks)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(1000 + i, 1000) for i in range(1, 300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = dict(listed(components.components(spark.createDataFrame(chain, "x long, y long"))))
    assert set(got) == {x for p in chain for x in p}
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in range(1000, 1300)) and got[5001] == 5000
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0
