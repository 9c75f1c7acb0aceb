r"""N-gram Jaccard self-join by MinHash with Bayesian candidate pruning.

Documents are sets of five-word shingles (words between ASCII white space; a
shorter text is one shingle). Two sets are linked at Jaccard similarity 0.8 or
more; classes are the connected components of the links.

* Documents of equal shingle sets form one node, so copies cost one row each.
* Candidates share all MinHash values of one of ``BANDS`` bands of ``ROWS``
  values: a pair at the threshold is missed with probability 2e-6. No bucket
  is written as its pairs: each member meets the bucket's pivot, the node
  that comes first in one seeded order of all nodes, so a family meets few
  pivots over all bands. Then every bucket is finished: its members that
  the pivots left in different groups are compared with one another inside
  tasks, blocks of up to ``SIGNATURES`` members at a time, and only the pairs
  alive that join two groups leave the task.
* Pruning: a candidate pair's MinHash values are compared ``STEP`` at a time;
  after each step the pair is dropped when the posterior probability (uniform
  prior) that its similarity reaches the threshold is below ``TOLERANCE``.
* The pairs alive join nodes into groups, a little wider than classes: two
  similar nodes that share a bucket and are not pruned lie in one group.
* Groups are verified whole on exact shingle sets: blocks of up to ``BLOCK``
  nodes meet one another and themselves, one meeting a task (groups of one
  block share tasks), where a product of incidence matrices gives all
  intersections. All links are counted there; what leaves the task is a
  spanning forest for the classes and one count per node. So the time, and for
  groups over a block the texts sent, grow with the square of a group.

``n_links`` counts the other documents linked to the document: those of equal
shingle set and those of every set at the threshold. Joins on hot keys are
split by adaptive execution; bucket pivots are pre-aggregated.

Defined cases: NULL and wordless texts are linked to nothing; repeated rows
are documents of their own; the representative of a class is its row of least
(id, row number), NULL ids first; an empty table gives an empty result; input
columns named ``class_id``, ``n_links`` or ``representative`` are replaced in
the classes and left as they are by ``keep_one``. Any other names may stand in
the input: columns go through the operator by their position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import bitmap, marked, may_hold, prepare, scratch, stage, trimmed, trimmed_group
from histmart.llm.graph import components, starred
from histmart.llm.shingles import MinHasher, WordHasher, shingle_set

SHINGLE = 5
SIMILAR = (4, 5)  # the threshold as a fraction
BANDS, ROWS = 25, 4
STEP = 20
TOLERANCE = 1e-6
BLOCK = 512
SIGNATURES = 2048  # members of a bucket in a block
CELL_ROWS = 512  # nodes of small groups that share a task
ADDED = ("class_id", "n_links", "representative")


def least_matches(threshold: float, compared: int, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values of ``compared`` at which P(similarity >= threshold) is still ``tolerance``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at t equals P(Binomial(n + 1, t) <= m).
    """
    tail = 0.0
    for m in range(compared + 1):
        tail += comb(compared + 1, m) * threshold ** m * (1 - threshold) ** (compared + 1 - m)
        if tail >= tolerance:
            return m
    return compared


def signed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Input rows plus _llm_row, _llm_n (shingles), _llm_set (128-bit hash of the set) and _llm_sig; NULL without words."""
    fields = docs.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        hasher, minhash = WordHasher(), MinHasher(BANDS * ROWS)
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            n, ids, sigs = [], [], []
            for t in b.column(text).to_pylist():
                s = shingle_set(hasher(t), SHINGLE) if t else ()
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(minhash(s).tobytes() if len(s) else None)
            rows = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in fields] + [rows, pa.array(n, pa.int32()), pa.array(ids, pa.binary()), pa.array(sigs, pa.binary())],
                [f.name for f in fields] + ["_llm_row", "_llm_n", "_llm_set", "_llm_sig"])

    return docs.mapInArrow(trimmed(run), f"{schema}, _llm_row long, _llm_n int, _llm_set binary, _llm_sig binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """(key, id): one row per node and band; the key is a hash of the band's number and values."""
    width = 4 * ROWS
    return nodes.select("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substr("sig", i * width + 1, F.lit(width))))).alias("key"))


def _buckets(bands: DataFrame) -> DataFrame:
    """(key, pivot) of the buckets with two members or more; the pivot is the node of least hash, one order for all bands."""
    first = F.min(F.struct(F.xxhash64("id").alias("hash"), "id"))
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members"), first["id"].alias("pivot"))
    return buckets.filter("members > 1").select("key", "pivot")


def candidates(bands: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """(id, pivot): each node with the different pivots of its buckets."""
    return bands.join(_buckets(bands) if buckets is None else buckets, "key").filter("id <> pivot").select("id", "pivot").distinct()


def _pruned(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that can reach the threshold: first by size, then by comparing MinHash values step by step."""
    num, den = SIMILAR
    steps = list(range(STEP, BANDS * ROWS + 1, STEP))
    least = [least_matches(num / den, s) for s in steps]
    # signatures of nodes in a pair alone are shuffled
    rows = may_hold(rows, "_llm_row", stage(bitmap(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id"), "near-bitmap"))
    end = lambda x: rows.select(F.col("_llm_row").alias(x), F.col("_llm_n").alias(f"n_{x}"), F.col("_llm_sig").alias(f"sig_{x}"))
    joined = (pairs.join(end("a"), "a").join(end("b"), "b")
              .filter(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, BANDS * ROWS)
                    for c in ("sig_a", "sig_b"))
            left = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int32)
            for end, fewest in zip(steps, least):
                matches[left] += (x[left, end - STEP:end] == y[left, end - STEP:end]).sum(axis=1, dtype=np.int32)
                left = left[matches[left] >= fewest]
            index = pa.array(left)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(index), batch.column("b").take(index)], ["a", "b"])

    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(trimmed(run), "a long, b long")


def alive_forest(sigs: np.ndarray, sizes: np.ndarray, parts: list, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of ``left`` and ``right`` (indexes) in different parts that are not pruned, a forest over the parts."""
    num, den = SIMILAR
    steps = range(STEP, sigs.shape[1] + 1, STEP)
    least = [least_matches(num / den, s) for s in steps]
    _, part = np.unique(np.asarray(parts), return_inverse=True)
    inner = left is right
    out = []
    for at, i in enumerate(left):
        j = right[at + 1:] if inner else right
        n = sizes[j]
        j = j[(part[j] != part[i]) & (np.minimum(n, sizes[i]) * den >= np.maximum(n, sizes[i]) * num)]
        matches = np.zeros(len(j), dtype=np.int32)
        for end, fewest in zip(steps, least):
            if not len(j):
                break
            matches += (sigs[j, end - STEP:end] == sigs[i, end - STEP:end]).sum(axis=1, dtype=np.int32)
            j, matches = j[matches >= fewest], matches[matches >= fewest]
        if len(j):
            fresh, first = np.unique(part[j], return_index=True)
            out += [(int(i), int(j[k])) for k in first]
            part[np.isin(part, fresh)] = part[i]
    return out


def _meetings(rows: DataFrame, group: str, block: int) -> DataFrame:
    """``rows`` with size (of their group) sent to meetings (cell, meeting, side): blocks of a group meet pairwise
    (sides 0 and 1) and each by itself (side 2). Groups of one block share cells."""
    small = rows.filter(F.col("size") <= block).count()
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    met = met.withColumn("meeting", F.xxhash64(F.col(group), low, high)).withColumn("side", side)
    cell = F.when(F.col("blocks") == 1, F.pmod(F.col("meeting"), F.lit(max(1, -(-small // CELL_ROWS))))).otherwise(F.col("meeting"))
    return met.withColumn("cell", cell)


def _sides(table) -> Iterator:
    """(rows, left, right) of each meeting of a cell, left and right being the same within one block."""
    meeting, side = (table.column(c).to_numpy() for c in ("meeting", "side"))
    order = np.argsort(meeting, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(meeting[order])) + 1):
        one = np.flatnonzero(side[rows] == 2)
        left, right = (one, one) if len(one) else (np.flatnonzero(side[rows] == 0), np.flatnonzero(side[rows] == 1))
        if len(left) and len(right):
            yield rows, left, right


def _finished(bands: DataFrame, buckets: DataFrame, groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (a, b) alive between members of a bucket that its pivot left in different ``groups`` (id, component)."""
    # the pivot has met every member
    members = bands.join(buckets, "key").filter("id <> pivot").select("key", "id").join(groups, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("part"))
    mixed = members.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("size")).filter(
        "low <> high").select("key", "size")
    members = stage(members.join(mixed, "key"), "near-mixed")
    rows = may_hold(rows, "_llm_row", stage(bitmap(members, "id"), "near-bitmap"))
    met = _meetings(members, "key", SIGNATURES).select("cell", "meeting", "side", "id", "part").join(
        rows.select(F.col("_llm_row").alias("id"), F.col("_llm_n").alias("n"), F.col("_llm_sig").alias("sig")), "id")

    def run(table):
        import pyarrow as pa

        ids, part, n = (table.column(c).to_numpy() for c in ("id", "part", "n"))
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(table.num_rows, BANDS * ROWS)
        a, b = [], []
        for at, left, right in _sides(table):
            for i, j in alive_forest(sigs[at], n[at].astype(np.int64), part[at], left, right):
                a.append(ids[at[i]])
                b.append(ids[at[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("cell").applyInArrow(trimmed_group(run), "a long, b long").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the sets ``left`` and ``right`` (indexes; rows and columns) are different ones and at the threshold.

    Intersections of all sets come from products of 0/1 incidence matrices, a few thousand shingles at a time.
    """
    num, den = SIMILAR
    size = np.array([len(x) for x in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    count = np.diff(np.concatenate((start, [len(values)])))
    column = np.repeat(np.cumsum(count > 1) - 1, count)
    shared = np.repeat(count > 1, count)
    column, owner = column[shared], owner[shared]
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        inside = (column >= at) & (column < at + 4096)
        x = np.zeros((len(sets), 4096), dtype=np.float32)
        x[owner[inside], column[inside] - at] = 1
        both += x[left] @ x[right].T
    near = both * den >= (size[left][:, None] + size[right][None, :] - both) * num
    return near & (left[:, None] != right[None, :])


def forest(near: np.ndarray, parts: list, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links in ``near`` that join different parts, a forest over them."""
    _, part = np.unique(np.asarray(parts), return_inverse=True)
    out = []
    for row, i in enumerate(left):
        j = right[near[row]]
        fresh, first = np.unique(part[j], return_index=True)
        out += [(int(i), int(j[k])) for p, k in zip(fresh, first) if p != part[i]]
        part[np.isin(part, fresh)] = part[i]
    return out


def linked(sets: list[np.ndarray], parts: list, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` (indexes into ``sets``) that join different parts, a forest over them."""
    return forest(similar(sets, left, right), parts, left, right)


def _met(cells: DataFrame) -> DataFrame:
    """All links of meetings (cell, meeting, side, id, copies, text), in two kinds of rows (a, b, n): with b, the
    links of a spanning forest; without, the number n of documents linked to those of set a in this meeting."""

    def run(table):
        import pyarrow as pa

        hasher = WordHasher()
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy().astype(np.float64)
        text = table.column("text")
        a, b, n = [], [], []

        def count(at, degree):
            some = np.flatnonzero(degree)
            a.extend(ids[at[some]].tolist())
            b.extend([None] * len(some))
            n.extend(np.rint(degree[some]).astype(np.int64).tolist())

        for rows, left, right in _sides(table):
            sets = [shingle_set(hasher(text[int(i)].as_py()), SHINGLE) for i in rows]
            near = similar(sets, left, right)
            found = forest(near, np.arange(len(sets)), left, right)
            a += [int(ids[rows[i]]) for i, _ in found]
            b += [int(ids[rows[j]]) for _, j in found]
            n += [None] * len(found)
            count(rows[left], near @ copies[rows[right]])
            if left is not right:
                count(rows[right], near.T @ copies[rows[left]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return cells.groupBy("cell").applyInArrow(trimmed_group(run), "a long, b long, n long")


def links(rows: DataFrame, heads: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Over the head rows (``heads``: id = _llm_row of one row per shingle set, and its copies): verified links
    (a, b) that connect every class, and (id, degree): the documents of other sets linked to those of a set."""
    head_rows = may_hold(rows, "_llm_row", stage(bitmap(heads, "id"), "near-bitmap"))
    nodes = head_rows.select(F.col("_llm_row").alias("id"), F.col("_llm_sig").alias("sig")).join(heads.select("id"), "id")
    bands = stage(_bands(nodes), "near-bands")
    buckets = stage(_buckets(bands), "near-buckets")
    # most bands are alone in their bucket: those are not shuffled to the pivots
    bands = stage(may_hold(bands, "key", stage(bitmap(buckets, "key"), "near-bitmap")), "near-shared")
    pairs = stage(candidates(bands, buckets).select(F.col("id").alias("a"), F.col("pivot").alias("b")), "near-pairs")
    alive = _pruned(pairs, rows).select(F.col("a").alias("id"), F.col("b").alias("pivot"))
    alive = stage(starred(alive), "near-alive")
    groups = components(alive)
    more = stage(_finished(bands, buckets, groups, rows), "near-finished")
    groups = components(alive.unionByName(more)).withColumnRenamed("component", "group")
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    placed = stage(groups.join(sizes, "group").join(heads.select("id", "copies"), "id"), "near-groups")
    met = _meetings(placed, "group", BLOCK).select("cell", "meeting", "side", "id", "copies")
    texts = rows.select(F.col("_llm_row").alias("id"), F.col(text).cast("string").alias("text"))
    texts = may_hold(texts, "id", stage(bitmap(placed, "id"), "near-bitmap"))  # texts of grouped nodes alone are shuffled
    found = stage(_met(met.join(texts, "id")), "near-links")
    return (found.filter("b IS NOT NULL").select("a", "b"),
            found.filter("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("degree")))


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The signed rows, input columns under the names c0, c1, ..., and (_llm_set, _llm_head, _llm_degree): of each shingle
    set the key and row that represent its class, and its links."""
    spark = docs.sparkSession
    prepare(spark)
    key, text = (f"c{docs.columns.index(c)}" for c in (key, text))
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    rows = stage(signed(rows, text), "near-signed")
    with scratch(spark):
        named = rows.filter(F.col("_llm_set").isNotNull())
        head = F.min(F.struct(F.col(key).alias("key"), F.col("_llm_row").alias("row")))
        # one row per shingle set: its copies, and the row that stands for it
        heads = stage(named.groupBy("_llm_set").agg(F.count(F.lit(1)).alias("copies"), head.alias("head"))
                      .withColumn("id", F.col("head.row")), "near-heads")
        found, degree = links(rows, heads, text)
        placed = (heads.join(components(found), "id", "left").join(degree, "id", "left")
                  .withColumn("component", F.coalesce("component", "id")))
        first = placed.groupBy("component").agg(F.min("head").alias("first"))
        classes = stage(placed.join(first, "component").select(
            "_llm_set", F.col("first").alias("_llm_head"),
            (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("_llm_degree")), "near-classes", keep=True)
    return rows, classes


def _classified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The input columns under the names c0, c1, ..., then _llm_class, _llm_links and _llm_stays."""
    rows, classes = _classes(docs, key, text)
    key, head = f"c{docs.columns.index(key)}", F.col("_llm_head")
    return rows.join(classes, "_llm_set", "left").select(
        *[f"c{i}" for i in range(len(docs.columns))],
        F.when(head.isNull(), F.col(key)).otherwise(head["key"]).alias("_llm_class"),
        F.coalesce("_llm_degree", F.lit(0)).cast("long").alias("_llm_links"),
        F.coalesce(head["row"] == F.col("_llm_row"), F.lit(True)).alias("_llm_stays"))


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Input columns plus class_id (the id of the class's representative), n_links and representative."""
    keep = [(f"c{i}", c) for i, c in enumerate(docs.columns) if c not in ADDED]
    return _classified(docs, key, text).select(
        *[F.col(x).alias(c) for x, c in keep],
        *[F.col(x).alias(c) for x, c in zip(("_llm_class", "_llm_links", "_llm_stays"), ADDED)])


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The representative row of each class, with the input columns."""
    rows, classes = _classes(docs, key, text)
    # rows are numbered, so those that go are a list of numbers; most rows that stay are told by a bitmap of it and are
    # not shuffled with their texts
    gone = stage(rows.select("_llm_row", "_llm_set").join(classes, "_llm_set").filter(
        F.col("_llm_row") != F.col("_llm_head.row")).select("_llm_row"), "near-gone")
    seen = marked(rows, "_llm_row", stage(bitmap(gone, "_llm_row"), "near-bitmap"))
    left = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    doubtful = seen.filter("_may").join(gone, "_llm_row", "left_anti")
    return seen.filter("NOT _may").select(*left).unionByName(doubtful.select(*left))


def op6_query(docs: DataFrame) -> DataFrame:
    return classify(docs.select("doc_id", "text")).select("doc_id", "class_id", "n_links")
