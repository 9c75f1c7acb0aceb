"""Outer-array JSON files read by many tasks.

A file that holds one array has no line ends to split at. Here it is read as
text with the comma as separator, which Spark splits at any byte range, and the
commas between elements are told from those inside them:

* Within a range the unescaped quotes before a comma say whether it lies inside
  a string, and brackets outside strings how deep. Both are running sums over
  the bytes of an Arrow batch, taken for either state in which the range may
  begin, so a range's counts need no other range.
* A range is then one row: its quotes and its two changes of depth. A running
  sum over a file's ranges gives the state in which each begins.
* A comma outside strings at depth 1 ends an element. Elements that lie within a
  range are cut there, in the task that reads it; only the first and the last of
  a range, which may lie across ranges, are shuffled and put together.

The running sums go along with the rows as a task reads them, batch by batch,
so no task sorts or holds a range; memory is bounded by an Arrow batch and by an
element. Files are read three times: for the ranges, of which a row for each and
counts of the states in it are written, for the elements across ranges, and for
the others, which no shuffle moves.

Defined cases: a file whose outermost value is no array is one row; an empty
array and an empty file give none; an element that is no valid JSON of the
schema has NULL fields; a compressed file is one range.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histmart.session import shared_path

SPACE = " \t\n\r"
MARK = "\ufeff"  # byte order mark
STATES = 1 << 16  # counts of states that a task holds


def array_pieces(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(file, key, block, piece) and the partition columns: the text between commas. The key is the file's in a few bytes, as
    every piece brings it to the tasks' Python."""
    text = spark.read.option("lineSep", ",").text(path)
    parts = [c for c in text.columns if c != "value"]
    file = F.col("_metadata.file_path")
    return text.select(file.alias("_file"), F.xxhash64(file).alias("_key"), F.col("_metadata.file_block_start").alias("_block"),
                       F.col("value").alias("_piece"), *parts), parts


def _runs(batch) -> list[tuple[int, int, tuple]]:
    """(from, to, range) of the rows of a batch that lie in one range."""
    file, block = batch.column("_key").to_numpy(), batch.column("_block").to_numpy()
    edges = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1).tolist(), len(block)]
    return [(a, z, (int(file[a]), int(block[a]))) for a, z in zip(edges, edges[1:])]


def _bytes(pieces) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array end to end, and where each string ends in them."""
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_string(pieces.type) else np.int32
    offsets = np.frombuffer(pieces.buffers()[1], kind)[pieces.offset:pieces.offset + len(pieces) + 1].astype(np.int64)
    data = pieces.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return text, offsets[1:] - offsets[0]


# What a byte is: 2 a quote, 3 a backslash, 1 and -1 a bracket that opens and one that closes.
_KINDS = np.zeros(256, dtype=np.int8)
_KINDS[[ord(c) for c in '"\\[{]}']] = [2, 3, 1, 1, -1, -1]


def _states(text: np.ndarray, ends: np.ndarray, odd: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """After each piece (ending at ``ends``): the unescaped quotes so far as 0 or 1, ``odd`` before the first, and the change
    of depth by brackets that an even and that an odd number of quotes precede."""
    kinds = _KINDS[text]
    at = np.flatnonzero(kinds)
    kind = kinds[at]
    if (kind == 3).any():
        # the first of the backslashes in a row before each byte; a piece begins with none
        first = np.zeros(len(text) + 1, dtype=np.int64)
        plain = np.flatnonzero(kinds != 3)
        first[plain + 1] = plain + 1
        first[ends[:-1]] = ends[:-1]
        before = at - np.maximum.accumulate(first)[at]
        keep = (before % 2 == 0) & (kind != 3)
        at, kind = at[keep], kind[keep]
    quote = kind == 2
    odds = (np.cumsum(quote) + odd) & 1
    step = np.where(quote, 0, kind).astype(np.int64)
    found = np.searchsorted(at, ends)
    sums = (np.concatenate(([start], x))[found] for start, x in ((odd, odds), (0, np.cumsum(step * (1 - odds))), (0, np.cumsum(step * odds))))
    return tuple(sums)


def _state_counts(pieces: DataFrame) -> DataFrame:
    """Of every range (_key, _block) the states after its pieces, for a range that begins outside a string (0) and for one that
    begins inside (1): _odd (quotes so far, as 0 or 1), _depth0 and _depth1 (change of depth), and how many pieces have it
    (n). In one more row without n the state after the last piece, and the code of the first character (``first``).
    ``pieces`` as they are read: a range's rows in order, one range after the other."""
    names = ["_key", "_block", "_odd", "_depth0", "_depth1", "n", "first"]

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 7
        last, state, first, counts = None, (0, 0, 0), 0, Counter()

        def rows(whole):
            out = [(*last, *s, n, None) for s, n in counts.items()] + ([(*last, *state, None, first)] if whole else [])
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for b in batches:
            for a, z, at in _runs(b) if b.num_rows else ():
                text, ends = _bytes(b.column("_piece").slice(a, z - a))
                if at != last:
                    if last is not None:
                        yield rows(True)
                    begun = text[:ends[0]].tobytes().decode("utf-8", "replace").lstrip(SPACE + MARK)
                    last, state, first = at, (0, 0, 0), ord(begun[0]) if begun else 0
                odd, depth0, depth1 = _states(text, ends, state[0])
                low0, low1 = depth0.min(), depth1.min()
                wide = depth1.max() - low1 + 1
                each, n = np.unique(((depth0 - low0) * wide + depth1 - low1) * 2 + odd, return_counts=True)
                both = each // 2
                counts.update(dict(zip(zip((each % 2).tolist(), (both // wide + low0 + state[1]).tolist(), (both % wide + low1 + state[2]).tolist()),
                                       n.tolist())))
                state = (int(odd[-1]), state[1] + int(depth0[-1]), state[2] + int(depth1[-1]))
                if len(counts) > STATES:
                    yield rows(False)
        if last is not None:
            yield rows(True)

    return pieces.select("_key", "_block", "_piece").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def array_ranges(pieces: DataFrame, spark: SparkSession) -> DataFrame:
    """(_key, _block, odd, depth, array, before), one row per range: whether it begins inside a string, at which depth,
    whether the file holds an array, and how many elements end in earlier ranges. A written table, made from counts of the
    states in each range."""
    state = ["_key", "_block", "_odd", "_depth0", "_depth1"]
    at = shared_path(spark, "array-states")
    states = _state_counts(pieces)
    states.write.parquet(at)
    states = spark.read.schema(states.schema).parquet(at)
    totals = states.filter("n IS NULL").select("_key", "_block", F.col("_odd").alias("quotes"), F.col("_depth0").alias("change0"),
                                               F.col("_depth1").alias("change1"), "first")
    states = states.filter("n IS NOT NULL")
    blocks = Window.partitionBy("_key").orderBy("_block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begun = totals.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).withColumn(
        "change", F.when(F.col("odd") == 0, F.col("change0")).otherwise(F.col("change1"))).select(
        "_key", "_block", "odd", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth"),
        (F.first("first").over(whole) == ord("[")).alias("array"))
    outside = F.col("array") & ((F.col("odd") + F.col("_odd")) % 2 == 0)
    depth = F.col("depth") + F.when(F.col("odd") == 0, F.col("_depth0")).otherwise(F.col("_depth1"))
    ends = states.select(*state, "n").join(begun, ["_key", "_block"]).groupBy("_key", "_block", "odd", "depth", "array").agg(
        F.sum(F.when(outside & (depth == 1), F.col("n")).otherwise(0)).alias("ends"))
    to = shared_path(spark, "array-ranges")
    ends.select("_key", "_block", "odd", "depth", "array", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("before")).write.parquet(to)
    return spark.read.parquet(to)


def _cut(placed: DataFrame, kept: list[str], whole: bool) -> DataFrame:
    """(kept, _element, _closed, text): the elements that lie within a range (``whole``), or the part of its first and of its last
    one in each range; _closed if the array ends in or before it. ``placed``: pieces with the state in which their range
    begins, as they are read."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*kept).schema.fields)

    def run(batches):
        import pyarrow as pa

        last, state, element, first, row, held, closed = None, (0, 0), 0, True, None, [], False

        def fragment():
            text = pa.array([b",".join(held)], pa.binary()).view(pa.string())
            return pa.RecordBatch.from_arrays([*row, pa.array([element], pa.int64()), pa.array([closed]), text], [*kept, "_element", "_closed", "text"])

        for b in batches:
            for a, z, at in _runs(b) if b.num_rows else ():
                if at != last:
                    if held and not whole:
                        yield fragment()
                    last, state, element = at, tuple(int(b.column(c)[a].as_py()) for c in ("odd", "depth")), int(b.column("before")[a].as_py())
                    first, held, closed = True, [], False
                    row = [b.column(c).slice(a, 1) for c in kept]
                text, ends = _bytes(b.column("_piece").slice(a, z - a))
                odd, change, _ = _states(text, ends, state[0])
                depth = state[1] + change
                state = (int(odd[-1]), int(depth[-1]))
                outside = (odd == 0) & b.column("array")[a].as_py()
                over, shut = np.flatnonzero(outside & (depth == 1)), outside & (depth <= 0)
                if not len(over):
                    held.append(_joined(text, ends, np.ones(len(ends) - 1, dtype=bool))[0].tobytes())
                    closed = closed or bool(shut.any())
                    continue
                # the last piece's comma is left out whether its element goes on or not: fragments are joined by commas
                comma = np.ones(len(ends) - 1, dtype=bool)
                comma[over[over < len(comma)]] = False
                joined, edges = _joined(text, ends, comma)
                cuts = np.concatenate(([0], edges[over]))
                held.append(joined[:cuts[1]].tobytes())
                closed = closed or bool(shut[:over[0] + 1].any())
                if first:  # it may have begun in an earlier range
                    if not whole:
                        yield fragment()
                elif whole:
                    yield fragment()
                first = False
                n = len(over) - 1
                if n and whole:
                    data = pa.py_buffer(joined[cuts[1]:cuts[-1]].tobytes())
                    texts = pa.StringArray.from_buffers(n, pa.py_buffer((cuts[1:] - cuts[1]).astype(np.int32).tobytes()), data)
                    shuts = np.diff(np.cumsum(shut)[over]) > 0
                    yield pa.RecordBatch.from_arrays([*(pa.repeat(r[0], n) for r in row), pa.array(element + 1 + np.arange(n)), pa.array(shuts), texts],
                                                     [*kept, "_element", "_closed", "text"])
                element += len(over)
                held, closed = ([joined[cuts[-1]:].tobytes()], bool(shut[over[-1] + 1:].any())) if over[-1] + 1 < len(ends) else ([], False)
        if held and not whole:
            yield fragment()

    return placed.mapInArrow(run, fields + ", _element long, _closed boolean, text string")


def _joined(text: np.ndarray, ends: np.ndarray, comma: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``text`` (ending at ``ends``) with a comma after those marked, of all but the last, and where each ends,
    its comma left out."""
    after = ends[:-1][comma]
    edges = ends + np.concatenate(([0], np.cumsum(comma)))
    return np.insert(text, after, ord(",")), edges


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _element, text) and partition columns: the elements of the outer array of each file, in order from 0."""
    pieces, parts = array_pieces(spark, path)
    placed = pieces.join(F.broadcast(array_ranges(pieces, spark)), ["_key", "_block"]).select(  # a row per range
        "_key", "_block", "_piece", "odd", "depth", "before", "array")
    kept = ["_key", "_block", "array"]
    across = _cut(placed, kept, False).groupBy("_key", "_element", "array").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_block", "text"))), lambda p: p["text"]), ",").alias("text"),
        F.bool_or("_closed").alias("_closed"))
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"), *parts)  # reads no file
    elements = _cut(placed, kept, True).drop("_block").unionByName(across).join(
        F.broadcast(files.withColumn("_key", F.xxhash64("_file"))), "_key")  # a row per file
    opened = F.when(F.col("array") & (F.col("_element") == 0), F.regexp_replace("text", rf"\A[\s{MARK}]*\[", "")).otherwise(F.col("text"))
    text = F.trim(F.when(F.col("_closed"), F.regexp_replace(opened, r"\]\s*\z", "")).otherwise(opened), F.lit(SPACE + MARK))
    return elements.select("_file", "_element", text.alias("text"), *parts).filter("text <> ''")


def read_large_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files holding one outer array each, however large: a row per element with the fields of ``schema``, then the
    partition columns of the folder. ``raw.read_json_array`` reads a file in one task instead."""
    elements = array_elements(spark, path)
    parts = elements.columns[3:]
    return elements.select(F.from_json("text", schema).alias("row"), *parts).select("row.*", *parts)
