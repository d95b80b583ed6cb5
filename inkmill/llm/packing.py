"""Cost-balanced packing of documents into sequences.

The cost of a piece of n ids in a sequence is LINEAR * n + QUADRATIC * n * n, as attention is within a document. A document
longer than a sequence first fills whole sequences of its own. What is left of the documents is packed by
descending length: as many sequences are opened as the ids fill, and each piece goes to the one of lowest cost
that still has room for it. A piece that fits nowhere is cut to fill the gaps that are left, cheapest sequence first.
So every sequence is full. What doesn't fill one is carried on, and at the end of a partition it goes, cut by
the binary digits of its length, into sequences of a power of two, which need no padding either.

Each partition of the input is packed where it lies, about a million ids at a time (plus the longest document):
no shuffle, bounded memory, and a repeated task gives the same sequences. A sequence's id is made of the partition's
number and a count.

Edge cases: null counts as the empty text and has the end id alone; rows with the same id are documents of their own;
null ids are kept; ids may be of any type; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import map_in_arrow
from .common import table
from .tokens import TABLE, WORD_BPE, encoder, vocabulary

SEQUENCE = 2048
END_ID = 1
LINEAR = 1.0
#: A document of SEQUENCE ids costs twice as much as its ids alone.
QUADRATIC = 1.0 / SEQUENCE
GROUP_IDS = 1 << 20


def cost(n: float) -> float:
    return LINEAR * n + QUADRATIC * n * n


def balance(items: list[tuple[int, int, int]], size: int = SEQUENCE) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """items: (document, start, length), lengths below size. Full sequences, as lists of pieces (document, start, length) that
    follow each other in them, and the pieces that are left, less than size ids in all."""
    n_open = sum(x[2] for x in items) // size
    if not n_open:
        return [], items
    room, costs = np.full(n_open, size), np.zeros(n_open)
    placed: list[list[tuple[int, int, int]]] = [[] for _ in range(n_open)]
    late = []
    for item in sorted(items, key=lambda x: (-x[2], x[0], x[1])):
        fits = np.where(room >= item[2], costs, np.inf)
        k = int(fits.argmin())
        if fits[k] == np.inf:
            late.append(item)
            continue
        placed[k].append(item)
        room[k] -= item[2]
        costs[k] += cost(item[2])
    late.reverse()
    for k in np.argsort(costs, kind="stable").tolist():
        while room[k]:
            doc, start, length = late.pop()
            take = min(length, int(room[k]))
            placed[k].append((doc, start, take))
            room[k] -= take
            if take < length:
                late.append((doc, start + take, length - take))
    return placed, late


def remainder(items: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """items cut into sequences whose lengths are different powers of two."""
    todo, out = items[::-1], []
    total = sum(x[2] for x in items)
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            left, pieces = 1 << bit, []
            while left:
                doc, start, length = todo.pop()
                take = min(length, left)
                pieces.append((doc, start, take))
                left -= take
                if take < length:
                    todo.append((doc, start + take, length - take))
            out.append(pieces)
    return out


def pack(docs: DataFrame, vocab: str | None = None, end_id: int = END_ID, size: int = SEQUENCE, group_ids: int = GROUP_IDS, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE) -> DataFrame:
    """One row a piece: doc_id, start, length, ids (u32, little-endian), doc_tokens, sequence_id, offset. table_size: of the encoder's table; it changes
    time and memory, not the result."""
    vocab = vocab or vocabulary(WORD_BPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab, table_size)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        held: dict[int, tuple[int | None, bytes]] = {}  # document number -> id, ids
        items: list[tuple[int, int, int]] = []
        n = total = 0
        id_type = None

        def rows(sequences: list[list[tuple[int, int, int]]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            for at in range(0, len(sequences), 1024):
                found = []
                for pieces in sequences[at : at + 1024]:
                    offset = 0
                    for doc, start, length in pieces:
                        doc_id, ids = held[doc]
                        found.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, sequence, offset))
                        offset += length
                    sequence += 1
                names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
                kinds = [pa.binary() if x == "ids" else id_type if x == "doc_id" else pa.int64() for x in names]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], list(names))

        def settle() -> list[list[tuple[int, int, int]]]:
            nonlocal items
            own = [[(d, s + k * size, size)] for d, s, m in items for k in range(m // size)]
            full, items = balance([(d, s + m // size * size, m % size) for d, s, m in items if m % size], size)
            return own + full

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = (encode(text.as_buffer().to_pybytes()) if text.is_valid else b"") + end
                held[n] = (doc_id, ids)
                items.append((n, 0, len(ids) // 4))
                n += 1
                total += len(ids) // 4
                if total >= group_ids:
                    yield from rows(settle())
                    held = {d: held[d] for d, _, _ in items}
                    total = sum(x[2] for x in items)
        yield from rows(settle())
        yield from rows(remainder(items))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return map_in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), table_size=2 * TABLE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
