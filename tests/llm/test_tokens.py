"""Token ids, directly addressable codes, token files and packing: exact round trips."""

import random
import zlib

import numpy as np
import pytest

from corpora import clashing, edge_rows, random_texts, rows, table
from inkmill.llm import codes, packing, token_output
from inkmill.llm.tokens import BYTE_BPE, WORD_BPE, Encoder, vocabulary

ALPHABET = list("abK  \n\t\r\x0b\x0c.,'’!?1²٣é́İẞΣς 　\x1c\x85​😀中€") + ["'s", "'ll", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "AB", "n't"]


def direct(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_ids_are_those_of_the_library(name):
    r, want, encode = random.Random(4), direct(name), Encoder(vocabulary(name))
    texts = ["".join(r.choices(ALPHABET, k=r.randint(0, 20))) for _ in range(4000)] + random_texts(50, 5) + [x[1] or "" for x in edge_rows()]
    for t in texts:
        assert np.frombuffer(encode(t.encode()), "<u4").tolist() == want(t), repr(t)
    encode = Encoder(vocabulary(name), size=5)
    for t in texts[-60:]:
        assert np.frombuffer(encode(t.encode()), "<u4").tolist() == want(t)
    many = " ".join(random_texts(4000, 6))
    assert len(many) > 1 << 20 and np.frombuffer(encode(many.encode()), "<u4").tolist() == want(many)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (511, 300), (512, 70_000), (5000, 1 << 20), (3000, 1 << 40), (2000, 200)])
def test_codes(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64)
    segment = codes.Segment(codes.encode(ids))
    assert len(segment) == n and segment.ids().tolist() == ids.tolist()
    assert [segment[i] for i in range(0, n, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        segment[n]
    with pytest.raises(ValueError):
        codes.Segment(b"nope" + bytes(20))


def test_token_files(spark, tmp_path):
    found, want = edge_rows(), direct(BYTE_BPE)
    docs, path = clashing(spark, found).repartition(4), str(tmp_path / "tokens")
    token_output.write_tokens(docs, path, segment_ids=300)
    got = token_output.read_documents(spark, path).orderBy("start").collect()
    order = sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    stream = []
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    for r, row in zip(got, order):
        ids = want(row[1]) + [2]
        assert (r["start"], r["n_tokens"]) == (len(stream), len(ids)) and np.frombuffer(r["ids"], "<u4").tolist() == ids
        stream += ids
    assert token_output.segments(spark, path).count() > 3
    for at in (0, 299, 300, len(stream) // 2, len(stream) - 1):
        assert token_output.token_at(spark, path, at) == stream[at]
    for at in (-1, len(stream)):
        with pytest.raises(IndexError):
            token_output.token_at(spark, path, at)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = token_output.segment_of(spark, path, 300)[0]._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert all(x in pushed for x in ("EqualTo(part,", "LessThanOrEqual(before,", "GreaterThan(before,"))
    token_output.write_tokens(docs.limit(0), str(tmp_path / "none"))
    assert token_output.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_one_id_fills_no_partition(spark, tmp_path):
    """Rows that are all alike are dealt out too."""
    docs = spark.createDataFrame([(None, "one two three")] * 400, "doc_id string, text string").repartition(3)
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # so few rows would be put together again
    spark.conf.set(key, "false")
    token_output.write_tokens(docs, str(tmp_path / "t"))
    spark.conf.unset(key)
    parts = spark.read.parquet(str(tmp_path / "t" / "parts")).collect()
    assert len(parts) > 2 and max(p["n_tokens"] for p in parts) < 0.6 * sum(p["n_tokens"] for p in parts)
    got = token_output.read_documents(spark, str(tmp_path / "t")).collect()
    assert sorted(r["start"] for r in got) == list(range(0, 400 * got[0]["n_tokens"], got[0]["n_tokens"])) and {r["doc_id"] for r in got} == {None}


def test_ids_of_any_type(spark, tmp_path):
    docs = spark.createDataFrame([("b", "x y"), ("a", "z")], "doc_id string, text string")
    token_output.write_tokens(docs, str(tmp_path / "t"))
    assert [r["doc_id"] for r in token_output.read_documents(spark, str(tmp_path / "t")).orderBy("start").collect()] == ["a", "b"]
    assert sorted({r["doc_id"] for r in packing.pack(docs).collect()}) == ["a", "b"]


def checked_pieces(found, pieces, size=2048):
    want = direct(WORD_BPE)
    left = {}
    for r in found:
        ids = tuple(want(r[1]) + [1])
        left[(r[0], ids)] = left.get((r[0], ids), 0) + 1
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for members in sequences.values():
        members.sort(key=lambda p: p["offset"])
        total = 0
        for p in members:
            assert p["offset"] == total and p["length"] > 0 and len(p["ids"]) == 4 * p["length"]
            total += p["length"]
        assert total == size or total & (total - 1) == 0 and total < size  # no padding at all
    for (doc_id, ids), copies in left.items():
        mine = [p for p in pieces if p["doc_id"] == doc_id and p["doc_tokens"] == len(ids) and p["ids"] == np.array(ids, "<u4")[p["start"] : p["start"] + p["length"]].tobytes()]
        covered = np.zeros(len(ids), int)
        for p in mine:
            covered[p["start"] : p["start"] + p["length"]] += 1
        assert (covered >= copies).all()
    assert sum(p["length"] for p in pieces) == sum(len(ids) * n for (_, ids), n in left.items())


@pytest.mark.parametrize("found, partitions, group", [(edge_rows(), 1, 1 << 20), (rows(random_texts(200, 7)), 3, 3000), (rows(["a b"] * 50), 2, 1 << 20)])
def test_packing(spark, found, partitions, group):
    pieces = packing.pack(clashing(spark, found).repartition(partitions), group_ids=group).collect()
    checked_pieces(found, pieces)
    assert packing.pack(clashing(spark, found).limit(0)).count() == 0


def test_balance():
    r = random.Random(8)
    items = [(i, 0, r.randint(1, 2047)) for i in range(400)]
    full, left = packing.balance(items)
    assert all(sum(x[2] for x in s) == 2048 for s in full) and sum(x[2] for x in left) < 2048
    costs = [sum(packing.cost(x[2]) for x in s) for s in full]
    assert max(costs) <= packing.cost(2048)
    # first fit, the other way of filling as few sequences, spreads the costs more
    items = [(i, 0, r.randint(20, 700)) for i in range(1200)]
    costs = [sum(packing.cost(x[2]) for x in s) for s in packing.balance(items)[0]]
    room, fitted = [], []
    for x in sorted(items, key=lambda x: -x[2]):
        k = next((i for i, free in enumerate(room) if free >= x[2]), len(room))
        if k == len(room):
            room.append(2048)
            fitted.append(0.0)
        room[k] -= x[2]
        fitted[k] += packing.cost(x[2])
    assert np.std(costs) < 0.1 * np.std([c for c, free in zip(fitted, room) if free < 100])
    assert packing.balance([(0, 0, 5)]) == ([], [(0, 0, 5)]) and packing.remainder([]) == []
    assert [sum(x[2] for x in s) for s in packing.remainder([(0, 0, 700), (1, 0, 300)])] == [512, 256, 128, 64, 32, 8]


def test_queries_give_the_digests(spark, tmp_path):
    found = rows(random_texts(30, 9))
    path = tmp_path / "sf"
    table(spark, found).write.parquet(str(path / "documents.parquet"))
    one, two = direct(BYTE_BPE), direct(WORD_BPE)
    start = 0
    for r, row in zip(sorted(map(tuple, token_output.op4_token_output(spark, str(path)).collect())), found):
        ids = np.array(one(row[1]) + [2], "<u4")
        assert r == (row[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    for r in packing.op8_packing(spark, str(path)).collect():
        ids = np.array(two(found[r["doc_id"]][1]) + [1], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) and r["doc_tokens"] == len(ids)
