r"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

Vocabulary A is byte-level BPE over space + text, B piece BPE over the text
(to which it adds a space); special tokens' strings in a text are plain text.
Where tokens of both end at the same byte, a group ends; all A and B tokens of
a group are linked. The count of an id pair is the number of documents that
hold it linked.

* ``chunks``: each task cuts its documents into chunks of about
  ``CHUNK_TOKENS`` A tokens, each a row of a staged table, and works on whole
  Arrow columns: lists are flattened with the indices of their parents, byte
  ends are sums segmented by them, an Acero hash join of both sides on
  (document, end) finds the common ends, segmented sums of these number the
  groups, and a join on the group, after ``group_by`` has collapsed equal ids,
  gives the linked pairs. A chunk keeps each of its pairs once, with the
  number of its documents that hold it; documents refer to pairs by place.
* ``counted``: Spark merges the chunks' partial counts by (a, b), takes each
  A id's highest, and joins both back to the chunks' pairs: a pair that every
  third document holds is one row per chunk there, never one per document.
  The table of the highest counts is broadcast, having at most as many rows as
  A's vocabulary; no other table is.
* ``aligned``: a chunk meets its pairs' counts, and its documents are summed
  from arrays.

A group's pairs are joined in slices of at most ``JOINED`` pairs of different
ids, so one group is bounded by the product of the ids that it holds.

Defined cases: NULL and empty texts, and texts whose joined tokens differ from
space + text in either vocabulary (B normalises), have no tokens: zeros and an
empty digest; repeated rows are documents of their own; NULL keys pass through;
an empty table gives an empty result; other columns are left out. Chunks
depend on the order in which a task reads its rows, which the staged table
fixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage, trimmed, trimmed_group
from histmart.llm.packing import load_encoding

CHUNK_TOKENS = 1 << 19
BATCH_CHARS = 1 << 20  # characters tokenised and aligned at once
JOINED = 1 << 21
SPACE = "▁"  # Fixed value: B's mark for a space, U+2581.


class Vocabularies:
    """Both tokenizers and the bytes of every id, as Arrow arrays."""

    def __init__(self, ranks: str | None = None, pieces: str | None = None):
        import public_tokenizers
        import pyarrow as pa
        import sentencepiece

        self.a = load_encoding(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces or public_tokenizers.path("piece_bpe_32k.model"))
        of_a = [b""] * (self.a.max_token_value + 1)
        for token in self.a.token_byte_values():
            of_a[self.a.encode_single_token(token)] = token
        of_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(SPACE, " ").encode()
                for i, x in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]
        self.bytes = [pa.array(x, pa.binary()) for x in (of_a, of_b)]
        self.lengths = [np.array([len(t) for t in x], dtype=np.int64) for x in (of_a, of_b)]

    def encode(self, texts: list[str]):
        """Two Arrow lists of ids, of texts that are not empty; [] on both sides where the bytes do not agree."""
        import pyarrow as pa
        import pyarrow.compute as pc

        a = [self.a.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        b = [np.array(x, dtype=np.int32) for x in self.b.encode(texts, num_threads=1)]
        wanted = pa.array([b" " + t.encode() for t in texts], pa.binary())
        both, good = [_lists(a), _lists(b)], np.ones(len(texts), dtype=bool)
        for ids, spelt in zip(both, self.bytes):
            joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, spelt.take(ids.values)), b"")
            good &= pc.equal(joined, wanted).to_numpy(zero_copy_only=False)
        if not good.all():
            both = [_lists([x if ok else x[:0] for x, ok in zip(side, good)]) for side in (a, b)]
        return both


def _lists(arrays: list[np.ndarray]):
    import pyarrow as pa
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _ends(ids, lengths: np.ndarray):
    """(flattened ids, their documents, the byte where each ends in its document)."""
    import pyarrow.compute as pc
    values, parent = (f(ids).to_numpy() for f in (pc.list_flatten, pc.list_parent_indices))
    total = np.concatenate(([0], np.cumsum(lengths[values])))
    return values, parent, total[1:] - total[ids.offsets.to_numpy()[parent]]


def align(a, b, lengths: list[np.ndarray]):
    """Of Arrow lists of ids per document: links (doc, a, b, times) as a table, the groups' documents, and the groups of
    every A and B token. Times: how many token occurrences of the two ids share a group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sides, tables = [], []
    for ids, size in zip((a, b), lengths):
        values, doc, end = _ends(ids, size)
        sides.append((values, doc))
        tables.append(pa.table({"doc": doc, "end": end, "at": np.arange(len(doc))}))
    common = tables[0].join(tables[1], ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    group = []
    for (values, _), at in zip(sides, ("at", "at_b")):
        last = np.zeros(len(values), dtype=np.int64)
        last[common[at].to_numpy()] = 1
        group.append(np.cumsum(last) - last)  # ends before this token; documents end at common ends
    groups = common.num_rows
    of_doc = np.empty(groups, dtype=np.int64)
    of_doc[group[0]] = sides[0][1]
    # equal ids of a group once, with their number
    once = [pa.table({"g": g, "id": values}).group_by(["g", "id"], use_threads=False).aggregate([([], "count_all")])
            for g, (values, _) in zip(group, sides)]
    ids = [np.bincount(t["g"].to_numpy(), minlength=groups) for t in once]
    slices = np.cumsum(ids[0] * ids[1]) // JOINED if groups else np.empty(0, np.int64)
    found = []
    for k in np.unique(slices):
        low, high = np.searchsorted(slices, k), np.searchsorted(slices, k, side="right")
        left, right = ((t if len(np.unique(slices)) == 1 else t.filter(pc.and_(pc.greater_equal(t["g"], low), pc.less(t["g"], high))))
                       .rename_columns(["g", name, f"n_{name}"]) for t, name in zip(once, "ab"))
        pairs = left.join(right, "g", join_type="inner", use_threads=False)
        found.append(pa.table({
            "doc": of_doc[pairs["g"].to_numpy()], "a": pairs["a"], "b": pairs["b"], "times": pc.multiply(pairs["n_a"], pairs["n_b"]),
        }).group_by(["doc", "a", "b"], use_threads=False).aggregate([("times", "sum")]))
    if not found:
        return pa.table({"doc": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()),
                         "times": pa.array([], pa.int64())}), of_doc, group
    links = pa.concat_tables(found).select(["doc", "a", "b", "times_sum"]).rename_columns(["doc", "a", "b", "times"])
    if len(found) > 1:
        links = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "a", "b", "times"])
    return links, of_doc, group


def spelt_groups(a, b, of_doc: np.ndarray, group: list[np.ndarray]):
    """Per document ``a1,a2|b1;a3|b2,b3``: the ids of its groups, in order."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sides = []
    for ids, g in zip((a, b), group):
        offsets = np.searchsorted(g, np.arange(len(of_doc) + 1)).astype(np.int32)
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pc.list_flatten(ids).cast(pa.string())), ","))
    both = pc.binary_join_element_wise(*sides, "|")
    offsets = np.searchsorted(of_doc, np.arange(len(a) + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), both), ";")


def _chunk_schema(kind: str) -> str:
    return (f"chunk bigint, keys array<{kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, digests array<string>, "
            "pairs array<int>, places array<int>, times array<bigint>, a array<int>, b array<int>, docs array<bigint>")


class Chunk:
    """Aligned documents of a chunk, and its pairs by place."""

    def __init__(self, number: int):
        self.number, self.tokens = number, 0
        self.keys: list = []
        self.columns: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "digests", "pairs", "links")}

    def add(self, keys: list, texts: list, vocabularies: Vocabularies) -> None:
        import pyarrow.compute as pc

        whole = [i for i, t in enumerate(texts) if t]
        a, b = vocabularies.encode([texts[i] for i in whole])
        links, of_doc, group = align(a, b, vocabularies.lengths)
        at = np.array(whole, dtype=np.int64)
        n = len(texts)

        def spread(values):
            out = np.zeros(n, dtype=np.int64)
            out[at] = values
            return out

        digests = [""] * n
        for i, ids, s in zip(whole, pc.list_value_length(a).to_pylist(), spelt_groups(a, b, of_doc, group).to_pylist()):
            if ids:
                digests[i] = hashlib.sha256(s.encode()).hexdigest()
        links = links.sort_by("doc")
        doc = links["doc"].to_numpy()
        c = self.columns
        for name, values in (("n_a", pc.list_value_length(a)), ("n_b", pc.list_value_length(b)), ("n_groups", np.bincount(of_doc, minlength=len(at))),
                             ("pairs", np.bincount(doc, minlength=len(at)))):
            c[name].append(spread(np.asarray(values)))
        c["digests"] += digests
        c["links"].append(links.select(["a", "b", "times"]))
        self.keys += keys
        self.tokens += len(group[0])

    def row(self, key_type):
        """One Arrow row (columns of ``_chunk_schema``)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        c = self.columns
        links = pa.concat_tables(c["links"]).combine_chunks()
        pair = np.asarray(links["a"]).astype(np.int64) << 32 | np.asarray(links["b"]).astype(np.int64)
        coded = pc.dictionary_encode(pa.array(pair))
        places = coded.indices
        partial = pa.table({"place": places}).group_by("place", use_threads=False).aggregate([([], "count_all")]).sort_by("place")
        pair = coded.dictionary.to_numpy()
        lists = [np.concatenate(c[x]) for x in ("n_a", "n_b", "n_groups")] + [c["digests"], np.concatenate(c["pairs"]).astype(np.int32), places,
                 links["times"].combine_chunks(), (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32), partial["count_all"].combine_chunks()]
        names = ["n_a", "n_b", "n_groups", "digests", "pairs", "places", "times", "a", "b", "docs"]

        def one(values, kind=None):
            values = pa.array(values, kind) if not isinstance(values, pa.Array) else values
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        return pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), one(self.keys, key_type), *map(one, lists)], ["chunk", "keys", *names])


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None, pieces: str | None = None,
           chunk_tokens: int = CHUNK_TOKENS, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """One row per chunk: its documents' columns, their pairs' places and times end to end, and the pairs (a, b, docs)."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches) -> Iterator:
        from pyspark import TaskContext

        vocabularies = Vocabularies(ranks, pieces)
        number = TaskContext.get().partitionId() << 32
        chunk, key_type = Chunk(number), None
        for batch in batches:
            key_type = batch.schema.field("key").type
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(keys):
                end, chars = at, 0
                while end < len(keys) and (end == at or chars + len(texts[end] or "") <= batch_chars):
                    chars += len(texts[end] or "")
                    end += 1
                chunk.add(keys[at:end], texts[at:end], vocabularies)
                at = end
                if chunk.tokens >= chunk_tokens:
                    yield chunk.row(key_type)
                    number += 1
                    chunk = Chunk(number)
        if chunk.keys:
            yield chunk.row(key_type)

    return rows.mapInArrow(trimmed(run), _chunk_schema(kind))


def pair_counts(parts: DataFrame) -> DataFrame:
    """(a, b, n): in how many documents each id pair is linked; of partial counts (a, b, docs)."""
    return parts.groupBy("a", "b").agg(F.sum("docs").alias("n"))


def _parts(written: DataFrame) -> DataFrame:
    """(chunk, place, a, b, docs): the chunks' pairs."""
    return written.select("chunk", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("place", "x")).select("chunk", "place", "x.a", "x.b", "x.docs")


def counted(written: DataFrame) -> DataFrame:
    """(chunk, place, n, best): the corpus-wide count of each chunk's pairs, and whether it is its A id's highest."""
    parts = _parts(written)
    counts = stage(pair_counts(parts), "align-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most one row per id of A's vocabulary
    counts = counts.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    return parts.select("chunk", "place", "a", "b").join(counts.hint("merge"), ["a", "b"]).select("chunk", "place", "n", "best")


def document_sums(left, right):
    """Per document of the chunks in ``left`` what its pairs amount to; ``right`` has the chunk's pairs by place."""
    import pyarrow as pa
    import pyarrow.compute as pc

    most = int(pc.max(right["place"]).as_py() or 0) + 1 if right.num_rows else 0
    n, best = np.zeros(most, dtype=np.int64), np.zeros(most, dtype=np.int64)
    place = right["place"].to_numpy()
    n[place], best[place] = right["n"].to_numpy(), right["best"].to_numpy().astype(np.int64)
    out = []
    for row in left.to_batches(max_chunksize=1):  # one chunk
        of = lambda c: row.column(c).flatten()
        sizes, places, times = (np.asarray(of(c)) for c in ("pairs", "places", "times"))
        doc = np.repeat(np.arange(len(sizes)), sizes)

        def total(values):
            sums = np.zeros(len(sizes), dtype=np.int64)
            np.add.at(sums, doc, values)
            return pa.array(sums)

        out.append(pa.table([of("keys"), of("n_a"), of("n_b"), of("n_groups"), total(times), total(times * best[places]),
                             total(times * n[places]), of("digests")],
                            ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
    return pa.concat_tables(out)


def aligned(written: DataFrame, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    kind = written.schema["keys"].dataType.elementType.simpleString()
    left = written.select("chunk", "keys", "n_a", "n_b", "n_groups", "digests", "pairs", "places", "times")
    counts = counts.select(F.col("chunk").alias("of_chunk"), "place", "n", "best")
    out = left.groupBy("chunk").cogroup(counts.groupBy("of_chunk")).applyInArrow(
        trimmed_group(document_sums), f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("key", key)


def counts_and_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None,
                         pieces: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The id pairs (a, b, n) of the corpus, and the aligned documents."""
    prepare(docs.sparkSession)
    written = stage(chunks(docs, key, text, ranks, pieces), "align-chunks", group_rows=1)  # a chunk has some 20 MB in memory
    return pair_counts(_parts(written)), aligned(written, counted(written), key)


def op11_query(docs: DataFrame) -> DataFrame:
    return counts_and_documents(docs)[1]
