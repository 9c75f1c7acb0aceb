r"""Source divergence audit: which sources of a language differ from it and from one another, and by which terms.

A term is a run of ASCII letters (A-Z lower-cased) and characters beyond
ASCII. Each language keeps the terms that stand in ``MIN_DOCS`` of its
documents. Smoothed shares of the kept terms are compared by
f = (p - q)^2 / (p + q), in integers (``share`` and ``gap``).

* ``term_counts``: each task joins its texts to shards (Arrow buffers of about
  ``SHARD_BYTES``). The starts of the words in a shard's bytes are its
  pointers; ``sorted_runs`` sorts them by multikey quicksort, a slice of
  pointers at a time, eight bytes being one key. An equal run is a term; its
  pointers, which stay in the order of the text, give its documents and its
  counts by group. Spark sums the shards' rows by (lang, source, term).
* Pairs of sources: of the V kept terms of a language most have no count in a
  given source. The sum over all V terms is taken as that of two sources
  without any term, plus what each one's own terms change (by a histogram of
  their counts), plus what the terms in both change, from a join on
  (lang, term). That join holds a row per pair of sources with a common term,
  and the result one per pair; both are asked for by the contract's result.

All sums are pre-aggregated; no window is wider than one source's rows, and
that of the terms keeps ten rows a task before its shuffle. Counts are exact at
any size (decimal products).

Defined cases: NULL lang, source and text are ''; a row is a document, repeated
ones too; groups without a term give pairs (all values 0 where the language
keeps no term) and no terms; an empty table gives an empty result; ties are
ordered by the item's bytes; very long texts are shards of their own. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage, text_or_empty, trimmed

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000  # Fixed value: shares are integers of this unit.
SHARD_BYTES = 8 << 20
BATCH_ROWS = 50_000  # of a shard's counts sent at once
SLICE = 1 << 12  # pointers sorted at once, below which a slice is not split by a pivot


def _letters() -> np.ndarray:
    """Byte to byte: letters of a term, lower-cased, stay; all others are 0."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    keep = np.zeros(256, dtype=bool)
    keep[0x80:] = keep[ord("A"):ord("Z") + 1] = keep[ord("a"):ord("z") + 1] = True
    return np.where(keep, table, 0).astype(np.uint8)


def word_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words in bytes where 0 separates (and ends) them."""
    inside = np.concatenate(([False], data != 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2] - edge[::2]


class Slices:
    """Pointers to words of one buffer, and their bytes as keys of eight."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
        # a key begins at every byte: overlapping views of the buffer
        self.eight = np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))
        self.last = len(data)
        self.starts, self.lengths = starts, lengths
        shift = np.array([8 * (8 - n) for n in range(1, 9)], dtype=np.uint64)
        self.mask = np.concatenate((np.zeros(1, np.uint64), ~np.uint64(0) << shift))

    def keys(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Bytes depth to depth + 7 of the words ``at``, zeros after their end."""
        left = np.clip(self.lengths[at] - depth, 0, 8)
        place = np.minimum(self.starts[at] + depth, self.last)
        return self.eight[place].astype(np.uint64) & self.mask[left]


def sorted_runs(words: Slices) -> tuple[np.ndarray, np.ndarray]:
    """All words in byte order, equal ones in the order of the text, and where each run of equal words begins.

    Multikey quicksort: a slice is split by a pivot key into smaller, equal and larger ones; the equal ones go on
    with the next eight bytes, unless the word has ended there. Short slices are sorted whole, key after key.
    """
    everything = np.arange(len(words.starts))
    order, heads, done = [everything[:0]], [everything[:0]], 0
    todo: list[tuple] = [(everything, words.keys(everything, 0), 0)]
    while todo:
        at, keys, depth = todo.pop()
        if keys is None:  # a finished run
            head = np.zeros(1, dtype=np.int64)
        elif len(at) <= SLICE:
            at, head = _sorted_slice(words, at, keys, depth)
        else:
            sample = keys[::max(1, len(keys) // 101)]
            pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
            low, high = keys < pivot, keys > pivot
            same = at[~(low | high)]
            go_on = pivot & np.uint64(255) != 0  # eight letters; with fewer the words have ended
            todo += [(at[high], keys[high], depth), (same, words.keys(same, depth + 8) if go_on else None, depth + 8),
                     (at[low], keys[low], depth)]
            continue
        order.append(at)
        heads.append(head + done)
        done += len(at)
    return np.concatenate(order), np.concatenate(heads)


def _sorted_slice(words: Slices, at: np.ndarray, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A short slice: sorted by its keys, then each run of equal keys by the next eight bytes until all words have ended."""
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    head = np.concatenate((np.ones(min(1, len(at)), dtype=bool), keys[1:] != keys[:-1]))
    unfinished = np.flatnonzero(keys & np.uint64(255))
    while len(unfinished):
        depth += 8
        run = np.cumsum(head)[unfinished]
        keys = words.keys(at[unfinished], depth)
        order = np.lexsort((keys, run))  # stable; a run keeps its places
        keys, at[unfinished] = keys[order], at[unfinished][order]
        head[unfinished[1:]] |= (keys[1:] != keys[:-1]) & (run[1:] == run[:-1])
        unfinished = unfinished[(keys & np.uint64(255)) != 0]
    return at, np.flatnonzero(head)


def _shard_counts(texts, groups: np.ndarray):
    """Of Arrow strings that each end in a separator, and their groups' numbers: (terms, run, group, count, documents),
    one row per term and group, as Arrow strings and arrays."""
    import pyarrow as pa

    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    letters = _letters()[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]]
    starts, lengths = word_starts(letters)
    order, heads = sorted_runs(Slices(letters, starts, lengths))
    doc = np.searchsorted(offsets - offsets[0], starts[order], side="right") - 1
    run = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    # a document's pointers of one run stand together: first by (run, document), then by (run, group)
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(run)), dtype=bool), (run[1:] != run[:-1]) | (doc[1:] != doc[:-1]))))
    times = np.diff(np.append(cut, len(run)))
    many = int(groups.max(initial=0)) + 1
    key, inverse = np.unique(run[cut] * many + groups[doc[cut]], return_inverse=True)
    count = np.bincount(inverse, weights=times, minlength=len(key)).astype(np.int64)
    docs = np.bincount(inverse, minlength=len(key)).astype(np.int64)
    first, length = starts[order[heads]], lengths[order[heads]]
    ends = np.concatenate(([0], np.cumsum(length)))
    place = np.arange(ends[-1]) + np.repeat(first - ends[:-1], length)
    terms = pa.StringArray.from_buffers(len(heads), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(letters[place]))
    return terms, key // many, key % many, count, docs


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in the group, and the documents that hold it."""
    prepare(docs.sparkSession)
    rows = docs.select(_named(lang).alias("lang"), _named(source).alias("source"),
                       F.concat(_named(text), F.lit(" ")).alias("text"))

    def run(batches) -> Iterator:
        import pyarrow as pa

        def counted(shard):
            names = pa.Table.from_batches(shard).select(["lang", "source"]).combine_chunks()
            both = pa.StructArray.from_arrays([names.column(c).combine_chunks() for c in ("lang", "source")], ["lang", "source"])
            seen: dict = {}
            number = np.array([seen.setdefault((x["lang"], x["source"]), len(seen)) for x in both.to_pylist()])
            terms, of_term, of_group, count, docs = _shard_counts(pa.concat_arrays([b.column("text") for b in shard]), number)
            names = [pa.array([g[i] for g in seen], pa.string()) for i in range(2)]
            for at in range(0, len(count), BATCH_ROWS):
                part = slice(at, at + BATCH_ROWS)
                group = pa.array(of_group[part])
                yield pa.RecordBatch.from_arrays(
                    [*(x.take(group) for x in names), terms.take(pa.array(of_term[part])), pa.array(count[part]), pa.array(docs[part])],
                    ["lang", "source", "term", "n", "docs"])

        shard, size = [], 0
        for b in batches:
            shard.append(b)
            size += b.column("text").nbytes
            if size >= shard_bytes:
                yield from counted(shard)
                shard, size = [], 0
        if size:
            yield from counted(shard)

    parts = rows.mapInArrow(trimmed(run), "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(column: str) -> Column:
    return text_or_empty(f"`{column}`")


def share(count: str | int, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact."""
    wide = lambda x: f"cast({x} AS decimal(19, 0))"
    return F.expr(f"1 + (cast({SCALE} AS decimal(10, 0)) * ({wide(count)} + 2)) div ({wide(total)} + 2 * {wide(terms)})")


def gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of shares, which are at most SCALE + 1."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


class Audit:
    """Kept terms of every language and what the groups (lang, source) hold of them.

    ``groups``: lang, source, total (occurrences of kept terms), terms (kept in the language) and lang_total;
    ``known``: lang, source, term, n (above 0), p, q: the shares in the group and in the language, and p0, the share
    of a term that the group does not hold.
    """

    def __init__(self, docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS):
        prepare(docs.sparkSession)
        counts = stage(term_counts(docs, lang, source, text), "audit-counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(
            F.col("docs") >= min_docs).drop("docs")
        known = stage(counts.drop("docs").join(kept, ["lang", "term"]), "audit-known")
        totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        by_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(
            known.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang")
        groups = docs.select(_named(lang).alias("lang"), _named(source).alias("source")).distinct()
        self.groups = stage(groups.join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")]), "audit-groups")
        self.known = stage(known.join(self.groups, ["lang", "source"]).select(
            "lang", "source", "term", "n", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"),
            share(0, "total", "terms").alias("p0")), "audit-shares")

    def terms(self, top: int = TOP) -> DataFrame:
        """(lang, source, item, value, rank): each group's terms with the largest gap above the language's share."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return self.known.filter("p > q").select("lang", "source", F.col("term").alias("item"), gap("p", "q").alias("value")).withColumn(
            "rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    def pairs(self) -> DataFrame:
        """(lang, source, item, value, rank): the gap between the group and each other source of its language, over all kept terms."""
        ends = self.groups.select("lang", "source", "terms", F.when(F.col("terms") > 0, share(0, "total", "terms")).alias("p0"))
        other = ends.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
        pairs = ends.join(other, "lang").filter("source < item")
        # (terms without a count in either, then what one source's own terms change, then the terms in both)
        none = pairs.filter("terms > 0").select("lang", "source", "item", (F.col("terms") * gap("p0", "q0")).alias("value"))
        alike = self.known.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("m"))
        one = alike.join(other, "lang").filter("source <> item").select(
            "lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"),
            (F.col("m") * (gap("p", "q0") - gap("p0", "q0"))).alias("value"))
        right = self.known.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
        both = self.known.drop("q").join(right, ["lang", "term"]).filter("source < item").select(
            "lang", "source", "item", (gap("p", "q") - gap("p", "q0") - gap("p0", "q") + gap("p0", "q0")).alias("value"))
        empty = pairs.filter("terms = 0").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
        parts = [x.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")) for x in (one, both)]
        half = none.unionByName(empty).unionByName(parts[0]).unionByName(parts[1]).groupBy("lang", "source", "item").agg(
            F.sum("value").alias("value"))
        whole = half.select("lang", "value", F.explode(F.array(
            F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x")).select(
            "lang", "x.source", "x.item", "value")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return whole.withColumn("rank", F.row_number().over(order))


def op13_query(docs: DataFrame) -> DataFrame:
    found = Audit(docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return found.pairs().withColumn("part", F.lit("pair")).select(*columns).unionByName(
        found.terms().withColumn("part", F.lit("term")).select(*columns))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
counted AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term),
grid AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
         FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k ON k.lang = g.lang
         LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n,
                  1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p,
                  1 + (1000000000::HUGEINT * (lang_n + 2)) // (sum(lang_n) OVER w + 2 * count(*) OVER w) AS q
           FROM grid WINDOW w AS (PARTITION BY lang, source)),
sources AS (SELECT DISTINCT lang, source FROM docs),
gaps AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(g.value, 0)::BIGINT AS value
          FROM sources a JOIN sources b ON b.lang = a.lang AND b.source <> a.source
          LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10
"""
