r"""Exact deduplication by owners that hold compressed radix (Patricia) tries of whole texts.

* ``gathered``: each task inserts its texts into a trie of their full bytes,
  so copies within a task cost one row. Rows become a reference to a terminal
  node of their task; the terminals (text, row count, best row) are written
  beside them.
* ``owned``: the terminals are dealt by (byte length, content hash), so equal
  texts meet in one owner, whatever else the hash lets meet there. The owner
  inserts the full byte strings into its own trie. Terminal nodes hold the
  best identifier and the sums of their copies: texts are equal when they end
  in one node, never because hashes agree.
* Spill by subtree: a trie over ``TRIE_BYTES`` hands its heaviest subtrees
  out and frees them. In ``gathered`` a handed-out terminal is finished (a
  later copy begins another one). An owner marks the subtree's node, sends
  every text that reaches it on, and the next round deals these out anew by
  (length, hash) over as many owners as their bytes need; equal texts go on
  together, since all of them pass the same node. A trie's last terminal is
  never handed out, so every round finishes some texts.
* A row learns its group over its task's terminal. A group as large as a third
  of all rows sends an owner one row per task, and its rows' join is dealt by
  (task, terminal).

The best row has the largest key (``keep="largest"``) or the smallest one;
of rows with the same key the first. The text is compared after ``normalise``
(none by default).

Defined cases: a NULL text is empty, and all empty texts are copies; repeated
rows are copies of their own, one stays; NULL keys come last; ``keep_id`` of a
group of NULL keys only is NULL; an empty table gives an empty result; very
long texts are whole byte strings. Input columns named ``keep_id``,
``group_size``, ``kept`` or ``text_sha256`` are replaced by the result's in
``deduplicate`` and left as they are by ``keep_one``; any other names may stand
in the input, as columns go through by their position.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage, text_or_empty, trimmed

TRIE_BYTES = 96 << 20  # texts and nodes of a trie; an executor holds one for each of its cores
OWNER_BYTES = 64 << 20  # texts dealt to one owner
NODE_BYTES = 800  # of memory for a terminal, besides its text
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


class Node:
    """An edge ``text[start:end]`` and what is below it; ``at`` is the terminal's number, or -1."""

    __slots__ = ("text", "start", "end", "below", "at", "gone")

    def __init__(self, text: bytes, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.below: dict[int, Node] = {}
        self.at = -1
        self.gone = False


def common_length(a: bytes, at: int, b: bytes, start: int, end: int) -> int:
    """Length of the longest common prefix of ``a[at:]`` and ``b[start:end]``, by halving."""
    low, high = 0, min(len(a) - at, end - start)
    if a[at:at + high] == b[start:start + high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[at + low:at + middle] == b[start + low:start + middle]:
            low = middle
        else:
            high = middle
    return low


class Trie:
    """Byte strings by their whole bytes; ``numbers`` are given by ``insert`` in order of first appearance."""

    def __init__(self):
        self.root = Node(b"", 0, 0)
        self.bytes = 0
        self.terminals = 0

    def insert(self, s: bytes, number: int) -> tuple[int, bool]:
        """(the terminal's number, whether it is new); -1 where the path leads into a subtree handed out."""
        node, at = self.root, 0
        while True:
            if node.gone:
                return -1, False
            if at == len(s):
                if node.at >= 0:
                    return node.at, False
                return self._end(node, s, number)
            child = node.below.get(s[at])
            if child is None:
                child = node.below[s[at]] = Node(s, at, len(s))
                return self._end(child, s, number)
            n = common_length(s, at, child.text, child.start, child.end)
            if n < child.end - child.start:
                middle = Node(s[at:at + n], 0, n)  # bytes of its own: an inner edge may outlive the texts below
                child.start += n
                middle.below[child.text[child.start]] = child
                node.below[s[at]] = child = middle
            node, at = child, at + n

    def _end(self, node: Node, s: bytes, number: int) -> tuple[int, bool]:
        node.at = number
        self.bytes += len(s) + NODE_BYTES
        self.terminals += 1
        return number, True

    @staticmethod
    def numbers(node: Node) -> Iterator[int]:
        """Terminals at or below a node."""
        todo = [node]
        while todo:
            node = todo.pop()
            if node.at >= 0:
                yield node.at
            todo += node.below.values()

    def hand_out(self, most: int, size: Callable[[int], int], mark: bool) -> list[int]:
        """Free heavy subtrees until at most ``most`` bytes are left (or one terminal): their terminals' numbers.

        With ``mark``, a freed node stays as a sign that leads later texts out; without, it is forgotten.
        """
        out: list[int] = []
        while self.bytes > most and self.terminals > 1:
            node = self.root
            while True:  # down the heaviest edges, to a subtree that leaves something behind
                weights = {k: sum(size(n) + NODE_BYTES for n in self.numbers(c)) for k, c in node.below.items() if not c.gone}
                key = max(weights, key=weights.__getitem__)
                inside = list(self.numbers(node.below[key]))
                if len(inside) < self.terminals and (self.bytes - weights[key] <= most or len(inside) == 1 or weights[key] <= self.bytes // 2):
                    break
                node = node.below[key]
            if mark:
                gone = node.below[key]
                gone.gone, gone.at, gone.below = True, -1, {}
                # a copy of the edge: the freed texts are no longer referred to
                gone.text, gone.start, gone.end = gone.text[gone.start:gone.end], 0, gone.end - gone.start
            else:
                del node.below[key]
            self.terminals -= len(inside)
            self.bytes -= weights[key]
            out += inside
        return out


class Group:
    """What a terminal node knows: its text, best key and row, rows, and the terminals that it stands for."""

    __slots__ = ("text", "key", "row", "rows", "members")

    def __init__(self, text: bytes, key, row: int, rows: int, members):
        self.text, self.key, self.row, self.rows, self.members = text, key, row, rows, members


def better(keep: str) -> Callable:
    """Whether the first of two (key, row) is to be kept: by key, NULL last, then by row."""
    def decide(key, row, other, other_row) -> bool:
        if key is None or other is None or key == other:
            return (other is None and key is not None) or ((key is None) == (other is None) and row < other_row)
        return key > other if keep == "largest" else key < other
    return decide


def _terminal_schema(kind: str) -> str:
    return f"members array<bigint>, length bigint, hash bigint, best {kind}, best_row bigint, n bigint, text binary, sha string"


def _terminals(groups: list[Group], key_type, finished: bool):
    """Rows of terminals. Finished ones carry the digest of their text, others the text."""
    import pyarrow as pa
    import xxhash

    texts = [g.text for g in groups]
    return [
        pa.array([g.members for g in groups], pa.list_(pa.int64())), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts], pa.int64()),
        pa.array([g.key for g in groups], key_type), pa.array([g.row for g in groups], pa.int64()),
        pa.array([g.rows for g in groups], pa.int64()), pa.array([None] * len(groups) if finished else texts, pa.binary()),
        pa.array([hashlib.sha256(t).hexdigest() for t in texts] if finished else [None] * len(groups), pa.string())]


TERMINAL_NAMES = ["members", "length", "hash", "best", "best_row", "n", "text", "sha"]


def _in_batches(groups: Iterator[Group]) -> Iterator[list[Group]]:
    """Lists of bounded rows and bytes."""
    some, size = [], 0
    for g in groups:
        some.append(g)
        size += len(g.text)
        if len(some) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def gathered(rows: DataFrame, carry: list[str], keep: str, trie_bytes: int) -> DataFrame:
    """Of rows (``carry`` columns, key, text): rows (carry, row, term) with their task's terminal, and the terminals
    (term NULL; columns of ``_terminal_schema``)."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        first = better(keep)
        row = number = TaskContext.get().partitionId() << 33
        trie, groups = Trie(), {}
        names = [*carry, "row", "term", *TERMINAL_NAMES]
        kinds = key_type = None

        def terminals(gone):
            for some in _in_batches(gone):
                nothing = [pa.nulls(len(some), t) for t in (*kinds, pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays(nothing + _terminals(some, key_type, False), names)

        for b in batches:
            kinds, key_type = [b.schema.field(c).type for c in carry], b.schema.field("key").type
            first_row, terms = row, []
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                term, new = trie.insert(text, number)
                if new:
                    groups[term] = Group(text, key, row, 1, [term])
                    number += 1
                else:
                    g = groups[term]
                    g.rows += 1
                    if first(key, row, g.key, g.row):
                        g.key, g.row = key, row
                terms.append(term)
                row += 1
            ends = [pa.nulls(b.num_rows, a.type) for a in _terminals([], key_type, False)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array(range(first_row, row), pa.int64()),
                                              pa.array(terms, pa.int64()), *ends], names)
            if trie.bytes > trie_bytes:
                gone = trie.hand_out(trie_bytes // 2, lambda n: len(groups[n].text), mark=False)
                yield from terminals(groups.pop(n) for n in gone)
        yield from terminals(iter(groups.values()))

    columns = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in carry)
    return rows.mapInArrow(trimmed(run), f"{columns}row bigint, term bigint, {_terminal_schema(kind)}")


def owned(terminals: DataFrame, keep: str, owners: int, trie_bytes: int, turn: int) -> DataFrame:
    """One round of owners: finished groups (``sha`` set) and terminals of subtrees handed out (``text`` set)."""
    kind = terminals.schema["best"].dataType.simpleString()

    def run(batches) -> Iterator:
        import pyarrow as pa

        first = better(keep)
        trie, groups, number, key_type = Trie(), {}, 0, None

        def rows(some, finished):
            return pa.RecordBatch.from_arrays(_terminals(some, key_type, finished), TERMINAL_NAMES)

        for b in batches:
            key_type = b.schema.field("best").type
            passed = []
            for members, key, row, n, text in zip(*(b.column(c).to_pylist() for c in ("members", "best", "best_row", "n", "text"))):
                at, new = trie.insert(text, number)
                if at < 0:
                    passed.append(Group(text, key, row, n, members))
                elif new:
                    groups[at] = Group(text, key, row, n, array("q", members))
                    number += 1
                else:
                    g = groups[at]
                    g.rows += n
                    g.members.extend(members)
                    if first(key, row, g.key, g.row):
                        g.key, g.row = key, row
            if trie.bytes > trie_bytes:
                gone = trie.hand_out(trie_bytes // 2, lambda n: len(groups[n].text), mark=True)
                passed += [groups.pop(n) for n in gone]
            for some in _in_batches(iter(passed)):
                yield rows(some, False)
        for some in _in_batches(iter(groups.values())):
            yield rows(some, True)

    dealt = terminals.repartition(owners, F.xxhash64("length", "hash", F.lit(turn)))
    return dealt.select("members", "best", "best_row", "n", "text").mapInArrow(trimmed(run), _terminal_schema(kind))


def groups_of(rows: DataFrame, carry: list[str], keep: str, trie_bytes: int, owner_bytes: int) -> DataFrame:
    """Of rows (``carry`` columns, key, text: binary, not NULL): carry, row (its number), best, best_row, n (rows of the text), sha."""
    written = stage(gathered(rows, carry, keep, trie_bytes), "exact-terms")
    left, finished = written.filter("term IS NULL").select(*TERMINAL_NAMES), []
    while (size := left.agg(F.sum("length")).first()[0]) is not None:
        done = stage(owned(left, keep, 1 + size // owner_bytes, trie_bytes, len(finished)), "exact-groups")
        finished.append(done.filter("sha IS NOT NULL"))
        left = done.filter("sha IS NULL")
    groups = reduce(DataFrame.unionByName, finished or [left])
    groups = groups.select(F.explode("members").alias("term"), "best", "best_row", "n", "sha")
    return written.filter("term IS NOT NULL").select(*carry, "row", "term").join(groups, "term").drop("term")


def _grouped(docs: DataFrame, columns: list[str], key: str, text: str, keep: str, normalise) -> DataFrame:
    """The ``columns`` as c0, c1, ..., and what ``groups_of`` adds."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    prepare(docs.sparkSession)
    whole = text_or_empty(f"`{text}`")
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    rows = docs.select(*carried, F.col(f"`{key}`").alias("key"), (normalise(whole) if normalise else whole).cast("binary").alias("text"))
    return groups_of(rows, [f"c{i}" for i in range(len(columns))], keep, TRIE_BYTES, OWNER_BYTES)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest",
                normalise: Callable[[Column], Column] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Per row: its ``columns`` (default all), keep_id (the key of the row that stays), group_size, kept and text_sha256."""
    columns = [c for c in columns or docs.columns if c not in ADDED]
    return _grouped(docs, columns, key, text, keep, normalise).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], F.col("best").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best_row")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest",
             normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The row that stays of each group of equal texts, with the input columns."""
    return _grouped(docs, docs.columns, key, text, keep, normalise).filter("row = best_row").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op12_query(docs: DataFrame) -> DataFrame:
    return deduplicate(docs, columns=["doc_id"])


ORACLE = """
WITH rows AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM rows
"""
