r"""Benchmark decontamination with an FM-index per training shard.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of characters
from U+0080. A benchmark item's windows are its runs of ``WINDOW`` words, or
the whole item if it is shorter. Each task gathers its documents into shards
of at most ``SHARD_WORDS`` words and indexes each shard:

* the alphabet is the benchmark's words; every other word is a barrier that
  no window can cross, and stretches between barriers shorter than the
  shortest window can hold none and are left out (exact, not a sample);
* the suffix array comes from prefix doubling, the Burrows-Wheeler transform
  goes into a wavelet matrix (the wavelet tree with one bit vector per level)
  with rank counts, and suffix positions divisible by ``SAMPLE`` are kept;
* all windows are searched backward at once through the ranks, their
  occurrences located by walking to the next sampled position, and the word
  ranges of a document merged into spans to remove.

The benchmark reaches the executors in blocks of at most ``BLOCK_BYTES`` of
text (counted first); several blocks mean several passes over the rows, each
merging its ranges into those found before, so no document is ever shuffled.

Defined cases: a NULL or wordless text has no hit; items without words have no
window; repeated rows are treated alike, equal items of different ids are all
reported; an empty table of either kind gives no hit; an input column named
``contamination`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage, trimmed

WINDOW = 10
SHARD_BYTES = 24 << 20
SAMPLE = 8
BLOCK_BYTES = 16 << 20

# Fixed value: bytes of words after lower-casing; every other byte separates.
_KEEP = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80 else 0x20 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = ("struct<n_words:bigint,n_hit:bigint,items:array<bigint>,ranges:array<struct<start:bigint,length:bigint>>,"
          "spans:array<struct<start:int,length:int>>>")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_KEEP).split()


class Phrases:
    """The windows of a block of benchmark items, by length, over the block's vocabulary (ids from 1)."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i:i + window]), set()).update(() if item is None else (item,))
        self.items = [sorted(v) for v in found.values()]
        lengths = np.array([len(k) for k in found], dtype=np.int64)
        self.groups = [(int(n), np.flatnonzero(lengths == n)) for n in np.unique(lengths)]
        keys = list(found)
        self.patterns = [np.array([keys[i] for i in members], dtype=np.int64) for _, members in self.groups]
        self.shortest = int(lengths.min()) if len(lengths) else 0


class FMIndex:
    """Counts and places of word sequences in ``text`` (array of ids from 0)."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        n = len(text)
        self.sample = sample
        order = self._suffix_order(text)  # of the text with its end mark, which sorts first
        shifted = np.append(text + 1, 0)
        bwt = shifted[order - 1]
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(bwt, minlength=int(shifted.max()) + 1))))
        self.levels = max(1, int(shifted.max()).bit_length())
        self.ranks, self.zeros, self.bits = [], [], []
        row = bwt
        for level in reversed(range(self.levels)):
            bit = (row >> level) & 1
            self.ranks.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(int(n + 1 - bit.sum()))
            self.bits.append(bit.astype(bool))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        marked = order % sample == 0
        self.marked, self.mark_rank = marked, np.concatenate(([0], np.cumsum(marked, dtype=np.int32)))
        self.kept = order[marked]

    @staticmethod
    def _suffix_order(text: np.ndarray) -> np.ndarray:
        rank = np.append(np.unique(text, return_inverse=True)[1] + 1, 0).astype(np.int64)
        width = 1
        while True:
            after = np.zeros_like(rank)
            after[:-width] = rank[width:] + 1
            key = rank * (len(rank) + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = np.empty_like(rank)
            rank[order] = new
            if new[-1] == len(rank) - 1:
                return order
            width *= 2
            if width >= len(rank):
                return order

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each row, through the wavelet matrix."""
        start = np.zeros_like(at)
        for level, ranks, zeros in zip(reversed(range(self.levels)), self.ranks, self.zeros):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = ranks[start], ranks[at]
            start, at = np.where(one, zeros + a, start - a), np.where(one, zeros + b, at - b)
        return at - start

    def symbol_at(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for bits, ranks, zeros in zip(self.bits, self.ranks, self.zeros):
            one = bits[at]
            symbol = symbol * 2 + one
            a = ranks[at]
            at = np.where(one, zeros + a, at - a)
        return symbol

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long patterns (rows): first row and row after the last of each."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.marked), dtype=np.int64)
        top = len(self.counts) - 2
        for column in reversed(range(patterns.shape[1])):
            symbol = patterns[:, column] + 1
            known = symbol <= top
            symbol = np.where(known, symbol, 0)
            low = self.counts[symbol] + self.rank(symbol, low)
            high = np.where(known, self.counts[symbol] + self.rank(symbol, high), low)
            high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back through the text to a sampled suffix."""
        steps, found = np.zeros_like(rows), np.full_like(rows, -1)
        left = np.arange(len(rows))
        while len(left):
            at = rows[left]
            here = self.marked[at]
            found[left[here]] = self.kept[self.mark_rank[at[here]]] + steps[left[here]]
            left, at = left[~here], at[~here]
            symbol = self.symbol_at(at)
            rows[left] = self.counts[symbol] + self.rank(symbol, at)
            steps[left] += 1
        return found


def _stretches(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of known words of at least ``shortest``, each ended by a barrier: (ids, place of each in the shard)."""
    known = np.concatenate(([0], (ids > 0).astype(np.int8), [0]))
    edge = np.flatnonzero(np.diff(known))
    start, end = edge[::2], edge[1::2]
    long = end - start >= shortest
    mask = np.zeros(len(ids) + 1, dtype=np.int32)
    np.add.at(mask, start[long], 1)
    np.add.at(mask, end[long] + 1, -1)  # the barrier after the run (each document ends with one)
    place = np.flatnonzero(np.cumsum(mask)[:-1])
    return ids[place], place


def find(ids: np.ndarray, phrases: Phrases, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of the windows in a shard: (place, length, window)."""
    none = np.zeros(0, dtype=np.int64)
    text, place = _stretches(ids, phrases.shortest) if phrases.items else (none, none)
    if not len(text):
        return none, none, none
    index = FMIndex(text, sample)
    out = []
    for (length, members), patterns in zip(phrases.groups, phrases.patterns):
        low, high = index.search(patterns)
        n = high - low
        if n.sum():
            first = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            at = index.locate(first + np.arange(n.sum()))
            out.append((place[at], np.full(len(at), length), np.repeat(members, n)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (none, none, none)


def _char_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as (start, length) in code points, from the first word's start to the last one's end."""
    words = list(_WORD.finditer(text))
    return [(words[s].start(), words[s + n - 1].end() - words[s].start()) for s, n in ranges]


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e - s) for s, e in out]


def search_shard(texts: list[str | None], phrases: Phrases, before: list | None = None) -> list[dict]:
    """The contamination record of each text of a shard; ``before`` has those of earlier blocks."""
    get, parts, counts = phrases.vocabulary.get, [], []
    for t in texts:
        w = words_of(t) if t else []
        counts.append(len(w))
        parts.append(np.array([get(x, 0) for x in w] + [0], dtype=np.int64))
    ids = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1])) if parts else ids
    place, length, window = find(ids, phrases)
    doc = np.searchsorted(starts, place, side="right") - 1
    ranges: dict[int, list] = {}
    items: dict[int, set] = {}
    for d, p, n, w in zip(doc.tolist(), (place - starts[doc]).tolist(), length.tolist(), window.tolist()):
        ranges.setdefault(d, []).append((p, p + n))
        items.setdefault(d, set()).update(phrases.items[w])
    out = []
    for i, t in enumerate(texts):
        r, it = ranges.get(i, []), items.get(i, set())
        if before is not None and before[i] is not None:
            r = r + [(x["start"], x["start"] + x["length"]) for x in before[i]["ranges"]]
            it = it | set(before[i]["items"])
        m = _merge(r)
        out.append({"n_words": counts[i], "n_hit": sum(n for _, n in m), "items": sorted(it),
                    "ranges": [{"start": s, "length": n} for s, n in m],
                    "spans": [{"start": s, "length": n} for s, n in _char_spans(t, m)] if m else []})
    return out


def _pass(docs: DataFrame, shared, text: str, window: int) -> DataFrame:
    """One block of items (broadcast, at most about BLOCK_BYTES) against every document."""
    fields = [f for f in docs.schema.fields if f.name != "contamination"]
    seen = "contamination" in docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", contamination {SCHEMA}"

    def run(batches) -> Iterator:
        import pyarrow as pa

        phrases = Phrases(shared.value, window)
        kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                          ("ranges", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                          ("spans", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))])

        def flush(held):
            texts = [t for b in held for t in b.column(text).to_pylist()]
            before = [r for b in held for r in b.column("contamination").to_pylist()] if seen else None
            found = pa.array(search_shard(texts, phrases, before), kind)
            at = 0
            for b in held:
                cols = [b.column(f.name) for f in fields] + [found.slice(at, b.num_rows)]
                at += b.num_rows
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields] + ["contamination"])

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= SHARD_BYTES:  # bounds the words of a shard, its index and the rows held
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return docs.mapInArrow(trimmed(run), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Input columns plus ``contamination``: n_words, n_hit, items, word ranges and code-point spans to remove.

    Items with a NULL id count for hits and spans; only the list of items leaves them out."""
    spark = docs.sparkSession
    prepare(spark)
    items = (benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))
             .filter(F.col("text").isNotNull()).distinct())
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = docs.drop("contamination")
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in part.collect()])
        out = _pass(out, shared, text, window)
        if b < blocks - 1:  # one block is alive at a time
            out = stage(out, "contamination")
            shared.destroy()
    return out


def without_spans(text: Column, spans: Column) -> Column:
    """The text with its spans cut out, last first."""
    return F.aggregate(
        F.reverse(F.array_sort(spans)), text,
        lambda t, s: F.concat(F.substr(t, F.lit(1), s["start"]), F.substr(t, s["start"] + s["length"] + 1)))


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Apply ``contamination`` to the text and drop it."""
    clean = F.when(F.col("contamination.n_hit") > 0, without_spans(F.col(text), F.col("contamination.spans")))
    return found.withColumn(text, F.coalesce(clean, F.col(text))).drop("contamination")


def op5_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = decontaminate(docs.select("doc_id", "text"), benchmark)
    c = F.col("contamination")
    ids = F.array_sort(F.transform(c["items"], lambda x: x.cast("string")))
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                        F.size(c["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"))
