"""Operator 11 against a plain walk over the bytes of both tokenizers."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from histmart.llm import alignment
from llm.llm_helpers import prose

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters():
    """The byte-level alphabet: printable characters stand for themselves, the others for those from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


LETTERS = byte_letters()


def both(text):
    """[(id, bytes)] of both tokenizers; ([], []) where the joined bytes differ."""
    if not text:
        return [], []
    whole = (" " + text).encode()
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and B.is_byte(i) else p.replace("▁", " ").encode()))
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def groups_of(text):
    """[(A ids, B ids)] of a text."""
    a, b = both(text)
    ends = []
    for side in (a, b):
        at, found = 0, []
        for i, t in side:
            at += len(t)
            found.append((at, i))
        ends.append(found)
    common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    out, low = [], 0
    for high in common:
        out.append(tuple([i for e, i in side if low < e <= high] for side in ends))
        low = high
    return out


def brute(rows):
    links = []
    for _, text in rows:
        links.append(Counter((x, y) for xs, ys in groups_of(text) for x in xs for y in ys))
    count = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (key, text), c in zip(rows, links):
        g = groups_of(text)
        said = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        out.append((key, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr), count


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = ["", None, " ", "  two  spaces ", "tab\tand\nnewline\r\n", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ mark", "中文字 \U0001f600 é é ﬁ", "x" * 3000,
         "=" * 700, "a", "12345678901234567890", "ab" * 500, " nbsp　wide", "naïve café — “quotes”", "\x00\x01", "Don't DON'T", "​ zero width"]


@pytest.mark.parametrize("chunk_tokens,batch_chars,joined", [(alignment.CHUNK_TOKENS, alignment.BATCH_CHARS, alignment.JOINED), (300, 500, 5)])
def test_alignment_equals_brute_force(spark, edge, none, tiny_docs, monkeypatch, chunk_tokens, batch_chars, joined):
    """Also with chunks of a few documents and joins of a few pairs."""
    monkeypatch.setattr(alignment, "JOINED", joined)
    made = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + [prose(3, 60), prose(4, 60), prose(3, 60)])], "doc_id long, text string").repartition(3)
    for docs in (made, edge.select("doc_id", "text").filter("length(text) < 20000 OR text IS NULL"), tiny_docs.select("doc_id", "text")):
        rows, count = brute([tuple(r) for r in docs.collect()])
        written = alignment.stage(alignment.chunks(docs, chunk_tokens=chunk_tokens, batch_chars=batch_chars), "test-chunks")
        out = alignment.aligned(written, alignment.counted(written))
        assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=repr) == rows
        assert {(r["a"], r["b"]): r["n"] for r in alignment.pair_counts(alignment._parts(written)).collect()} == count
    if joined == 5:
        assert written.count() > 3


def test_alignment_edges(edge, none):
    out = alignment.op11_query(edge)
    assert out.columns == COLUMNS and out.count() == edge.count()
    assert all(r["n_a"] == 0 and r["groups_sha256"] == "" for r in out.collect() if r["doc_id"] in (4, 5))
    assert alignment.op11_query(none).count() == 0


def test_token_bytes():
    v = alignment.Vocabularies()
    size = A.get_vocab_size()
    special = {i for i in range(size) if A.id_to_token(i).startswith("<|")}
    said = v.bytes[0].to_pylist()
    assert all(said[i] == bytes(LETTERS[c] for c in A.id_to_token(i)) for i in range(size) if i not in special and i < len(said))
    assert v.bytes[1][B.piece_to_id("<0x0A>")].as_py() == b"\n" and v.bytes[1][B.piece_to_id("▁the")].as_py() == b" the"


def test_sums_in_a_worker_that_has_not_loaded_compute(monkeypatch):
    """A fresh Python worker knows pyarrow alone; compute is a module of its own."""
    import pyarrow as pa
    monkeypatch.delattr(pa, "compute", raising=False)
    one = lambda v, t: pa.array([v], pa.list_(t))
    left = pa.table({"keys": one([7, 8], pa.int64()), "n_a": one([2, 0], pa.int64()), "n_b": one([1, 0], pa.int64()),
                     "n_groups": one([1, 0], pa.int64()), "digests": one(["x", ""], pa.string()), "pairs": one([2, 0], pa.int64()),
                     "places": one([0, 1], pa.int64()), "times": one([1, 2], pa.int64())})
    right = pa.table({"place": pa.array([0, 1]), "n": pa.array([5, 3]), "best": pa.array([True, False])})
    got = alignment.document_sums(left, right).to_pylist()
    assert [(r["key"], r["n_links"], r["n_best"], r["count_sum"]) for r in got] == [(7, 3, 1, 11), (8, 0, 0, 0)]


def test_chunks_are_written_and_read_one_at_a_time(spark, monkeypatch, tiny_docs):
    """A chunk has some 20 MB in memory, so a row group, which the writer and the reader hold whole, has one."""
    import pyarrow.dataset as ds
    found, stage = {}, alignment.stage

    def recorded(df, name, *args, **kwargs):
        out = stage(df, name, *args, **kwargs)
        found[name] = [f.removeprefix("file://") for f in out.inputFiles()]
        return out

    monkeypatch.setattr(alignment, "stage", recorded)
    chunks = alignment.chunks
    monkeypatch.setattr(alignment, "chunks", lambda *args, **kwargs: chunks(*args, **kwargs, chunk_tokens=2_000, batch_chars=10_000))
    alignment.op11_query(tiny_docs.coalesce(1))
    parts = [(f.metadata.num_row_groups, f.metadata.num_rows) for f in ds.dataset(found["align-chunks"]).get_fragments()]
    assert sum(n for _, n in parts) > 5 and all(groups == rows for groups, rows in parts)
