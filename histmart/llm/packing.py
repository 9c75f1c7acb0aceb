r"""Harmonic packing of tokenised documents into training sequences.

A piece of length l belongs to the reciprocal-capacity class k with
capacity/(k+1) < l <= capacity/k, and a class's bin (a sequence) takes exactly
k pieces. Documents may be cut, so lengths are made to fit: what is left of a
document stays whole if it lies at most ``SLACK`` tokens below a class's
largest length; otherwise a piece of the next smaller class's largest length
is cut off. Beyond class ``DENSE`` only the classes of powers of two are used.

Every input partition is a worker: it fills its own bins, holds at most one
open bin per class (a few dozen sequences) and never exchanges rows, so the
whole job has no shuffle and no skew. Pieces left in unfilled bins at a
worker's end are laid end to end, cut at the capacity: one partly filled
sequence per worker. Sequence ids join the worker's number and a counter; a
retried task gives the same rows, since it reads the same input partition
(give a table read from files or a staged one).

Tokens: the byte-level vocabulary read from ``tokenizer`` (a tiktoken rank
file; its ids equal those of the same vocabulary's ``tokenizers`` file, which
the tests compare), then ``end_id``. Defined cases: a NULL text is empty and
has only the end id; repeated rows are packed each; an empty table gives no
piece; input columns other than the key are left out.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import prepare, text_or_empty, trimmed

CAPACITY = 2048
END_ID = 1
SLACK = 8
DENSE = 32
SPECIAL = {"<|endoftext|>": 50256}  # Fixed value: the special token of byte_bpe_50k.

PIECE_SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def classes(capacity: int = CAPACITY, dense: int = DENSE) -> list[tuple[int, int]]:
    """(largest length, pieces per bin) of each class, by length."""
    ks = list(range(1, min(dense, capacity) + 1))
    k = 2 * ks[-1]
    while k <= capacity:
        ks.append(k)
        k *= 2
    by_length = {capacity // k: k for k in sorted(ks)}
    by_length.setdefault(1, capacity)
    return sorted(by_length.items())


def cuts(n: int, table: list[tuple[int, int]], slack: int = SLACK) -> list[tuple[int, int]]:
    """Cut n tokens: (length, class index) per piece, in order."""
    largest = [x for x, _ in table]
    out = []
    while n > 0:
        i = bisect_left(largest, n)
        if i == len(largest):
            i -= 1
            take = largest[i]
        elif largest[i] - n <= slack:
            take = n
        else:
            i -= 1
            take = largest[i]
        out.append((take, i))
        n -= take
    return out


def load_encoding(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


class Worker:
    """Open bins of one input partition."""

    def __init__(self, number: int, capacity: int, slack: int, dense: int):
        self.capacity, self.slack = capacity, slack
        self.table = classes(capacity, dense)
        self.open: list[list] = [[] for _ in self.table]
        self.next_id = number << 32

    def _close(self, pieces: list) -> Iterator[tuple]:
        offset, self.next_id = 0, self.next_id + 1
        for key, start, ids, total in pieces:
            yield key, start, len(ids), ids.tobytes(), total, self.next_id - 1, offset
            offset += len(ids)

    def add(self, key, ids) -> Iterator[tuple]:
        at = 0
        for length, i in cuts(len(ids), self.table, self.slack):
            # a copy: a view would keep the whole document in memory while the bin is open
            self.open[i].append((key, at, ids[at:at + length].copy(), len(ids)))
            at += length
            if len(self.open[i]) == self.table[i][1]:
                full, self.open[i] = self.open[i], []
                yield from self._close(full)

    def finish(self) -> Iterator[tuple]:
        room, pieces = self.capacity, []
        for key, start, ids, total in (p for pieces in reversed(self.open) for p in pieces):
            while len(ids):
                head = ids[:room]
                pieces.append((key, start, head, total))
                start, ids, room = start + len(head), ids[room:], room - len(head)
                if room == 0:
                    yield from self._close(pieces)
                    room, pieces = self.capacity, []
        if pieces:
            yield from self._close(pieces)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK, dense: int = DENSE) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    prepare(docs.sparkSession)
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import public_tokenizers
        from pyspark import TaskContext

        enc = load_encoding(tokenizer or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        worker = Worker(TaskContext.get().partitionId(), capacity, slack, dense)
        names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        key_type = None

        def batch(found):
            kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

        for b in batches:
            key_type = b.schema.field("key").type
            found = []
            for k, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                ids = enc.encode_to_numpy(t, allowed_special="all")
                found.extend(worker.add(k, np.append(ids, np.array([end_id], ids.dtype)).astype("<u4", copy=False)))
                if len(found) >= 4000:
                    yield batch(found)
                    found = []
            if found:
                yield batch(found)
        rest = list(worker.finish())  # at most the open bins
        if rest:
            yield batch(rest)

    out = rows.mapInArrow(trimmed(run), f"key {kind.simpleString()}, {PIECE_SCHEMA}")
    return out.withColumnRenamed("key", key)


def op2_query(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                             "doc_tokens", "sequence_id", "offset")
