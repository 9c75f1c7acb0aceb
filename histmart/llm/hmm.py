r"""Hidden Markov language model trained by distributed Baum-Welch.

A word with ``OWN`` training tokens or more is a class of its own, so the
emission table grows with the frequent vocabulary (by at most one class per
``OWN`` tokens); the others are hashed into ``BUCKETS`` classes. The model
(transitions, start and one emission row per class) is broadcast. Inside its
class a word has the share (c + 1) / (N_b + V_b + 1) from exact corpus counts,
an unseen word 1 / (N_b + V_b + 1). A text's probability is that of its words and its end in this model:
the scaled forward recursion over the whole text, times the in-bucket shares.

* ``encode``: each task cuts its documents into chunks (rows of a staged
  table) of about ``CHUNK_TOKENS`` tokens: the chunk's words (as 64-bit
  hashes: at ten billion words two or three pairs would share one), their
  training counts, and each token as a number into the chunk's words. The
  training sequences of each slice are a column of their own, the held-out
  tokens another, so a pass reads what it trains on.
* ``count_words``: partial sums by word. Words of their own are found first:
  their counts are in the model, which every task holds; the others' counts
  (below ``OWN``, so no word is hot) are joined to the chunk's words and go
  back to the chunk where they differ from its own.
* ``train``: expected counts are summed inside each task, then per class by
  Spark; only the sums, one row per class, reach the driver. One sweep re-estimates
  after each of ``SLICES`` disjoint slices of the corpus, then ``PASSES``
  passes use all training tokens. Training sequences are at most
  ``SEQUENCE`` tokens long (a longer text is several), scoring is not cut.
* ``score``: every chunk meets its words' counts and is scored.

The table of own classes is bounded: beyond ``MOST_OWN`` words the training
tokens that a class of its own takes are doubled until it is not exceeded, and
words below that stay in their buckets, with exact counts there.

Defined cases: a NULL text is empty (one token, its end); a NULL id is not
held out; repeated rows are scored each and count as often as they stand; an
empty table gives an empty result; other columns are left out. Chunks depend
on the order in which a task reads its rows, which the staged table fixes.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage, text_or_empty, trimmed, trimmed_group

STATES = 8
BUCKETS = 1 << 15
OWN = 1 << 12  # training tokens from which a word is a class of its own
MOST_OWN = 1 << 18  # such classes, which the driver and every task hold
CHUNK_TOKENS = 1 << 20
TASK_CHUNKS = 8  # chunks that a training task sums, where there are more than two tasks a core
SEQUENCE = 512
SLICES = 8
PASSES = 2
PRIOR_TOKENS = 1000.0
SEED = 11
HELD_OUT_MOD, HELD_OUT = 7, 2  # Fixed values of the split.
CHUNK_COLUMNS = "chunk bigint, lengths array<int>, held array<boolean>, words array<bigint>, counts array<int>"
HELD = "tokens_held"


def words_of(text: str) -> list[bytes]:
    """Words between space and U+0009 to U+000D (what bytes.split separates), A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def held_out(key) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % HELD_OUT_MOD == HELD_OUT


def word_hash(word: bytes) -> int:
    """Signed 64-bit hash; the end of a text (the empty word) is 0."""
    import xxhash
    return (xxhash.xxh64_intdigest(word) or 1) - (1 << 63) or 1 if word else 0


def buckets_of(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket 0 is the end of a text."""
    return np.where(hashes == 0, 0, 1 + np.mod(hashes, buckets - 1)).astype(np.int32)


def classes_of(hashes: np.ndarray, model: Model) -> np.ndarray:
    """The class of each word: its bucket, or its own class behind the buckets."""
    buckets = len(model.emit) - len(model.own)
    out = buckets_of(hashes, buckets)
    if len(model.own):
        at = np.minimum(np.searchsorted(model.own, hashes), len(model.own) - 1)
        out = np.where(model.own[at] == hashes, buckets + at, out).astype(np.int32)
    return out


def squeezed(tokens: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as compressed byte planes (the upper ones are mostly zero)."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def slice_columns(chunks: DataFrame) -> list[str]:
    """The token columns of the slices of a chunk table, in order."""
    return [c for c in chunks.columns if c.startswith("tokens_") and c != HELD]


def _slice_of(lengths: np.ndarray, held: np.ndarray, slices: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The slice that each token of a chunk is trained in (-1: held out), and the lengths of the training sequences."""
    begin, length = _sequences(lengths, held, longest)
    return _spread(np.arange(len(begin)) % slices, begin, length, int(lengths.sum())), length


def _spread(values: np.ndarray, begin: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """n numbers: each value over its stretch, -1 elsewhere."""
    out = np.full(n, -1, dtype=np.int16)
    ends = np.cumsum(length)
    out[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)] = np.repeat(values, length)
    return out


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_tokens: int = CHUNK_TOKENS,
           slices: int = SLICES, sequence: int = SEQUENCE) -> DataFrame:
    """Chunk rows: the ids, token counts and held-out flags of its documents, and their tokens by slice."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(text).alias("text"))
    columns = [*(f"tokens_{i}" for i in range(slices)), HELD]

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        number = count(TaskContext.get().partitionId() << 32)
        key_type = None

        def fresh():
            return [], [], [], defaultdict(count().__next__)

        def flush(keys, held, parts, index):
            lengths = [len(p) for p in parts]
            tokens = np.concatenate(parts)
            training = np.repeat(~np.array(held, dtype=bool), lengths)
            counts = np.bincount(tokens[training], minlength=len(index))
            hashes = np.fromiter(map(word_hash, index), dtype=np.int64, count=len(index))
            at, _ = _slice_of(np.array(lengths, dtype=np.int64), np.array(held, dtype=bool), slices, sequence)
            return pa.RecordBatch.from_arrays([
                pa.array([keys], pa.list_(key_type)), pa.array([next(number)], pa.int64()),
                pa.array([lengths], pa.list_(pa.int32())), pa.array([held], pa.list_(pa.bool_())),
                pa.array([hashes], pa.list_(pa.int64())), pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                *(pa.array([squeezed(tokens[at == i])], pa.binary()) for i in [*range(slices), -1]),
            ], ["keys", "chunk", "lengths", "held", "words", "counts", *columns])

        keys, held, parts, index = fresh()
        size = 0
        for b in batches:
            key_type = b.schema.field("key").type
            for k, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                w = words_of(t)
                w.append(b"")
                parts.append(np.fromiter(map(index.__getitem__, w), dtype=np.int64, count=len(w)))
                keys.append(k)
                held.append(held_out(k))
                size += len(w)
                if size >= chunk_tokens:
                    yield flush(keys, held, parts, index)
                    keys, held, parts, index = fresh()
                    size = 0
        if keys:
            yield flush(keys, held, parts, index)

    return rows.mapInArrow(trimmed(run), f"keys array<{kind}>, {CHUNK_COLUMNS}, " + ", ".join(f"{c} binary" for c in columns))


def _placed(chunks: DataFrame) -> DataFrame:
    """(chunk, place, word, n): the words of each chunk and their training counts there."""
    return chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x")).select(
        "chunk", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))


def count_words(chunks: DataFrame) -> DataFrame:
    """(word, c): training tokens of each word in the corpus; 0 where it is in held-out documents alone."""
    return _placed(chunks).groupBy("word").agg(F.sum("n").alias("c"))


def _returned(chunks: DataFrame, counted: DataFrame, model: Model) -> DataFrame:
    """(of_chunk, code): the corpus counts of the chunks' words that differ from their chunk's, as place * model.least + c.

    Words of their own and the end are left out: their counts are in the model. The others' counts are below ``least``.
    """
    spark = chunks.sparkSession
    code = (F.col("place").cast("long") * model.least + F.col("n")).alias("code")
    rows, rare = _placed(chunks).filter("word <> 0"), counted.filter("c > 0 and word <> 0")
    if len(model.own):
        mine = F.broadcast(spark.createDataFrame([(int(w),) for w in model.own], "word long"))  # at most MOST_OWN rows
        rows, rare = rows.join(mine, "word", "left_anti"), rare.join(mine, "word", "left_anti")
    n = F.pmod("code", F.lit(model.least))
    return rows.select(F.col("chunk").alias("of_chunk"), "word", code).join(rare, "word").filter(F.col("c") != n).select(
        "of_chunk", (F.col("code") - n + F.col("c")).alias("code"))


def _classed(chunks: DataFrame, model) -> DataFrame:
    """The chunks with ``classes`` in place of ``words`` (of the broadcast model)."""
    keep = [c for c in chunks.columns if c != "words"]

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            words = b.column("words")
            classes = pa.ListArray.from_arrays(words.offsets, pa.array(classes_of(words.values.to_numpy(), model.value)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), classes], [*keep, "classes"])

    fields = ", ".join(f"{c} {chunks.schema[c].dataType.simpleString()}" for c in keep)
    return chunks.select(*keep, "words").mapInArrow(trimmed(run), f"{fields}, classes array<int>")


@dataclass
class Model:
    start: np.ndarray       # (states,)
    step: np.ndarray        # (states, states): from, to
    emit: np.ndarray        # (classes, states): buckets, then words of their own
    tokens: np.ndarray      # (classes,) training tokens
    types: np.ndarray       # (classes,) distinct training words
    own: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))  # sorted hashes of the last classes
    least: int = OWN        # training tokens of a word from which it is one of them

    @property
    def prior(self) -> np.ndarray:
        p = self.tokens + self.types + 1.0
        return p / p.sum()


def initial(tokens: np.ndarray, types: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """Emissions near the corpus's with seeded noise, and states that like to stay."""
    rng = np.random.default_rng(seed)
    m = Model(np.full(states, 1 / states), np.full((states, states), 0.05 / max(1, states - 1)), np.empty(0), tokens, types)
    np.fill_diagonal(m.step, 0.95 if states > 1 else 1.0)
    emit = m.prior[:, None] * rng.uniform(0.5, 1.5, (len(tokens), states))
    m.emit = emit / emit.sum(axis=0)
    return m


def _by_time(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the sequences (longest first) and how many are still running at each time."""
    order = np.argsort(-lengths, kind="stable")
    running = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
    return order, running


def log_likelihoods(obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of each sequence of buckets: scaled forward recursion, all sequences side by side."""
    order, running = _by_time(lengths)
    first = starts[order]
    emit, step = model.emit, model.step
    total = np.zeros(len(lengths))
    alpha = np.empty((0, len(model.start)))
    for t, n in enumerate(running.tolist()):
        b = emit[obs[first[:n] + t]]
        alpha = model.start * b if t == 0 else (alpha[:n] @ step) * b
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(lengths))
    out[order] = total
    return out


def expected_counts(obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: Model):
    """E-step: (start, transition, emission) expected counts of the sequences."""
    k = len(model.start)
    order, running = _by_time(lengths)
    first = starts[order]
    emit, step = model.emit.astype(np.float32), model.step.astype(np.float32)
    ends = np.concatenate(([0], np.cumsum(running)))
    seen = np.concatenate([obs[first[:n] + t] for t, n in enumerate(running.tolist())])
    b = emit[seen]
    alpha = np.empty((len(seen), k), dtype=np.float32)
    scale = np.empty(len(seen), dtype=np.float32)
    for t, n in enumerate(running.tolist()):
        s = slice(ends[t], ends[t + 1])
        a = model.start.astype(np.float32) * b[s] if t == 0 else (alpha[ends[t - 1]:ends[t - 1] + n] @ step) * b[s]
        c = a @ np.ones(k, dtype=np.float32)
        alpha[s] = a / c[:, None]
        scale[s] = c
    moves = np.zeros((k, k))
    beta = np.ones((0, k), dtype=np.float32)
    for t in reversed(range(len(running))):
        n, s = int(running[t]), slice(ends[t], ends[t + 1])
        here = np.ones((n, k), dtype=np.float32)
        if len(beta):
            m = len(beta)
            nxt = slice(ends[t + 1], ends[t + 2])
            w = b[nxt] * beta / scale[nxt, None]
            moves += alpha[ends[t]:ends[t] + m].T @ w
            here[:m] = w @ step.T
        beta = here
        alpha[s] *= here  # alpha turns into the state posteriors
    moves *= step
    counts = np.stack([np.bincount(seen, weights=alpha[:, j], minlength=len(emit)) for j in range(k)], axis=1)
    return alpha[:int(running[0])].sum(axis=0, dtype=np.float64), moves, counts


def updated(model: Model, start: np.ndarray, moves: np.ndarray, counts: np.ndarray, prior_tokens: float = PRIOR_TOKENS) -> Model:
    """M-step with a small prior, so that every bucket can be emitted and every state left."""
    emit = counts + prior_tokens * model.prior[:, None]
    moves, start = moves + 1.0, start + 1.0
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), model.tokens, model.types, model.own, model.least)


def _sequences(lengths: np.ndarray, held: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the training sequences of a chunk."""
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[~held]
    lengths = lengths[~held]
    pieces = -(-lengths // longest)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(starts, pieces) + nth * longest
    return begin, np.minimum(longest, np.repeat(starts + lengths, pieces) - begin)


def _estimate(spark: SparkSession, chunks: DataFrame, model: Model, part: int | None, longest: int) -> Model:
    """One Baum-Welch step over slice ``part`` of the training sequences, or over all of them."""
    every = slice_columns(chunks)
    read = every if part is None else [every[part]]
    shared, k = spark.sparkContext.broadcast(model), len(model.start)
    columns = ", ".join(f"g{i} float" for i in range(k))

    def run(batches) -> Iterator:
        import pyarrow as pa

        m, sums = shared.value, None
        for b in batches:
            for row in (b.slice(i, 1) for i in range(b.num_rows)):
                of = lambda c: row.column(c).flatten().to_numpy(zero_copy_only=False)  # noqa: B023, E731
                _, length = _sequences(of("lengths").astype(np.int64), of("held"), longest)
                length = np.concatenate([length[i::len(every)] for i, c in enumerate(every) if c in read])
                if len(length):
                    tokens = np.concatenate([unsqueezed(row.column(c)[0].as_py()) for c in read])
                    found = expected_counts(classes_of(of("words"), m)[tokens], np.cumsum(length) - length, length, m)
                    sums = found if sums is None else tuple(a + x for a, x in zip(sums, found))
        if sums is not None:
            start, moves, counts = sums
            used = np.flatnonzero(counts.any(axis=1))
            # rows -1: start, -2 - i: transitions from state i
            ids = np.concatenate(([-1], -2 - np.arange(k), used))
            values = np.concatenate((start[None], moves, counts[used]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32())] + [pa.array(values[:, i], pa.float32()) for i in range(k)],
                                             ["row"] + [f"g{i}" for i in range(k)])

    sums = (chunks.select("lengths", "held", "words", *read).mapInArrow(trimmed(run), f"row int, {columns}")
            .groupBy("row").agg(*[F.sum(F.col(f"g{i}").cast("double")).alias(f"g{i}") for i in range(k)]))
    rows = sums.toPandas()  # at most classes + states + 1 rows
    shared.destroy()
    if rows.empty:
        return model
    ids, values = rows["row"].to_numpy(), rows[[f"g{i}" for i in range(k)]].to_numpy()
    start, moves, counts = np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)
    counts[ids[ids >= 0]] = values[ids >= 0]
    moves[-2 - ids[ids < -1]] = values[ids < -1]
    start[:] = values[ids == -1].sum(axis=0)
    return updated(model, start, moves, counts)


def least_own(counted: DataFrame, own: int = OWN, most: int | None = None) -> int:
    """The training tokens that make a word a class of its own: ``own``, doubled until at most ``most`` words have them."""
    steps = counted.filter((F.col("word") != 0) & (F.col("c") >= own)).groupBy(
        F.floor(F.log2(F.col("c") / own)).alias("step")).count().collect()  # a row for each power of two
    while sum(r["count"] for r in steps) > (MOST_OWN if most is None else most):
        own *= 2
        steps = [r for r in steps if r["step"] > min(x["step"] for x in steps)]
    return own


def train(chunks: DataFrame, counted: DataFrame, states: int = STATES, buckets: int = BUCKETS,
          passes: int = PASSES, sequence: int = SEQUENCE, seed: int = SEED, own: int = OWN) -> Model:
    """The model after one sweep over the chunks' slices and ``passes`` passes over all training tokens."""
    spark = chunks.sparkSession
    own = least_own(counted, own)
    words = counted.filter((F.col("word") != 0) & (F.col("c") >= own)).toPandas().sort_values("word")  # at most MOST_OWN rows
    bucket = F.when(F.col("word") == 0, 0).otherwise(F.pmod("word", F.lit(buckets - 1)) + 1).cast("int").alias("bucket")
    totals = counted.filter("c > 0").filter((F.col("word") == 0) | (F.col("c") < own)).groupBy(bucket).agg(
        F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types")).toPandas()  # at most ``buckets`` rows
    tokens, types = np.zeros(buckets), np.zeros(buckets)
    tokens[totals["bucket"]] = totals["tokens"]
    types[totals["bucket"]] = totals["types"]
    model = initial(np.concatenate((tokens, words["c"])), np.concatenate((types, np.ones(len(words)))), states, seed)
    model.own, model.least = words["word"].to_numpy(dtype=np.int64), own
    # tasks of some chunks each: every task sends one row per class
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-chunks.count() // TASK_CHUNKS))
    chunks = chunks.coalesce(tasks)
    for part in [*range(len(slice_columns(chunks))), *[None] * passes]:
        model = _estimate(spark, chunks, model, part, sequence)
    return model


def score(chunks: DataFrame, counted: DataFrame, model: Model, key: str = "doc_id", sequence: int = SEQUENCE) -> DataFrame:
    """Per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    kind = chunks.schema["keys"].dataType.elementType.simpleString()
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    slices = slice_columns(chunks)

    def run(left, right):
        import pyarrow as pa

        m = shared.value
        types = pa.schema([("key", left.schema.field("keys").type.value_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                           ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        place, elsewhere = np.divmod(right.column("code").to_numpy(), m.least)
        n, v = m.tokens.sum(), m.types.sum()
        share = m.tokens + m.types + 1.0
        buckets = len(m.emit) - len(m.own)
        out = []
        for row in left.to_batches(max_chunksize=1):  # one chunk
            of = lambda c: row.column(c).flatten().to_numpy(zero_copy_only=False)  # noqa: B023, E731
            lengths, held = of("lengths").astype(np.int64), of("held")
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            classes = of("classes")
            by_place = of("counts").astype(np.float64)
            by_place[place] = elsewhere
            # words of their own, and the end, which is a bucket of its own
            by_place = np.where((classes >= buckets) | (classes == 0), m.tokens[classes], by_place)
            at, _ = _slice_of(lengths, held, len(slices), sequence)
            tokens = np.empty(len(at), dtype=np.int64)
            for i, c in enumerate([*slices, HELD]):
                tokens[at == (i if c != HELD else -1)] = unsqueezed(row.column(c)[0].as_py())
            obs = classes[tokens]
            c = by_place[tokens]
            logs = np.add.reduceat(np.log10(by_place + 1)[tokens], starts)
            inside = logs - np.add.reduceat(np.log10(share)[obs], starts)
            out.append(pa.table([
                row.column("keys").flatten().cast(types.field("key").type), pa.array(held, pa.bool_()), pa.array(lengths),
                pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)), pa.array(np.full(len(lengths), int(n))),
                pa.array(logs - lengths * np.log10(n + v + 1)),
                pa.array(inside + log_likelihoods(obs, starts, lengths, m))], schema=types))
        return pa.concat_tables(out) if out else types.empty_table()

    left, back = _classed(chunks, shared), _returned(chunks, counted, model)
    out = left.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(
        trimmed_group(run), f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("key", key)


def model_and_scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """Train on the documents that are not held out and score all."""
    prepare(docs.sparkSession)
    chunks = stage(encode(docs, key, text), "hmm-chunks")
    counted = stage(count_words(chunks), "hmm-counts")
    model = train(chunks, counted)
    return model, score(chunks, counted, model, key)


def op3_query(docs: DataFrame) -> DataFrame:
    return model_and_scores(docs)[1]
