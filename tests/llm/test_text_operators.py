"""Operators 2, 3, 5 and 7 against brute force, and the pipeline."""

import datetime as dt
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from histmart.llm import decontaminate, hmm, nearjoin, packing, pii, quality
from llm.llm_helpers import prose


# --- 2: packing ---

def check_pieces(rows, texts, capacity=packing.CAPACITY):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: np.array(tok.encode(v or "", add_special_tokens=False).ids + [1], "<u4") for k, v in texts.items()}
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        k = r["doc_id"]
        assert r["start"] == at[k] and r["doc_tokens"] == len(ids[k]) and r["length"] > 0
        at[k] += r["length"]
        assert zlib.crc32(ids[k][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert at == Counter({k: len(v) for k, v in ids.items()})
    end = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == end[r["sequence_id"]]
        end[r["sequence_id"]] += r["length"]
    assert max(end.values(), default=0) <= capacity
    return sum(at.values()), len(end)


def test_packing_exact(tiny_docs):
    rows = packing.op2_query(tiny_docs).collect()
    tokens, sequences = check_pieces(rows, {r["doc_id"]: r["text"] for r in tiny_docs.collect()})
    assert tokens / (sequences * packing.CAPACITY) > 0.95


def test_packing_edges(spark, edge, none):
    rows = packing.op2_query(edge).collect()
    assert sum(r["start"] == 0 for r in rows) == edge.count()  # every row, repeated ones too
    assert packing.op2_query(none).count() == 0
    odd = spark.createDataFrame([(1, "<|endoftext|> x"), (2, "\U0001f600" * 300), (3, "a" * 9000), (4, None)], "doc_id long, text string")
    check_pieces(packing.op2_query(odd).collect(), {r["doc_id"]: r["text"] for r in odd.collect()})


def test_classes_and_cuts():
    table = packing.classes()
    assert all(n * k <= packing.CAPACITY for n, k in table) and table[-1] == (2048, 1)
    for n in range(1, 5000, 7):
        parts = packing.cuts(n, table)
        assert sum(x for x, _ in parts) == n and all(x <= table[i][0] for x, i in parts)


def test_full_bins_hold_the_class_count():
    worker = packing.Worker(0, 2048, 8, 32)
    out = [p for d in range(50) for p in worker.add(d, np.arange(1020, dtype="<u4"))]
    assert Counter(Counter(p[5] for p in out).values()) == {2: 25}  # two documents of just under half each


# --- 3: language model ---

def brute_forward(model, obs):
    alpha, total = model.start * model.emit[obs[0]], 0.0
    for i, o in enumerate(obs):
        if i:
            alpha = (alpha @ model.step) * model.emit[o]
        total += math.log10(alpha.sum())
        alpha = alpha / alpha.sum()
    return total


def brute_paths(model, obs):
    """Sum over all state paths."""
    paths = {(): 1.0}
    for i, o in enumerate(obs):
        paths = {(*p, s): v * (model.start[s] if i == 0 else model.step[p[-1], s]) * model.emit[o, s]
                 for p, v in paths.items() for s in range(len(model.start))}
    return paths


def small_model(states=3, buckets=5, seed=2):
    rng = np.random.default_rng(seed)
    m = hmm.initial(rng.integers(1, 20, buckets).astype(float), np.ones(buckets), states, seed)
    m.step = rng.dirichlet(np.ones(states), states)
    m.start = rng.dirichlet(np.ones(states))
    return m


def test_forward_and_counts_equal_all_paths():
    m, rng = small_model(), np.random.default_rng(0)
    lengths = np.array([1, 4, 2, 6])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    obs = rng.integers(0, 5, lengths.sum())
    start, moves, counts = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    logs = []
    for s, n in zip(starts, lengths):
        o = obs[s:s + n]
        paths = brute_paths(m, o)
        z = sum(paths.values())
        logs.append(math.log10(z))
        for p, v in paths.items():
            start[p[0]] += v / z
            for i in range(n):
                counts[o[i], p[i]] += v / z
                if i:
                    moves[p[i - 1], p[i]] += v / z
    assert np.allclose(hmm.log_likelihoods(obs, starts, lengths, m), logs)
    got = hmm.expected_counts(obs, starts, lengths, m)
    for a, b in zip(got, (start, moves, counts)):
        assert np.allclose(a, b, atol=1e-4)


def test_training_raises_likelihood():
    rng = np.random.default_rng(1)
    obs = np.concatenate([rng.integers(0, 3, 50) if i % 2 else rng.integers(3, 6, 50) for i in range(60)])
    starts, lengths = np.arange(0, 3000, 50), np.full(60, 50)
    m = hmm.initial(np.bincount(obs, minlength=6).astype(float), np.ones(6), 2, 1)
    likelihood = []
    for _ in range(6):
        likelihood.append(hmm.log_likelihoods(obs, starts, lengths, m).sum())
        m = hmm.updated(m, *hmm.expected_counts(obs, starts, lengths, m), prior_tokens=1e-3)
    assert all(b > a - 0.5 for a, b in zip(likelihood, likelihood[1:])) and likelihood[-1] > likelihood[0] + 100


def test_language_model_scores(tiny_docs):
    model, scored = hmm.model_and_scores(tiny_docs)
    rows = {r["doc_id"]: r for r in scored.collect()}
    tokens, counts = {}, Counter()
    for r in tiny_docs.collect():
        low = r["text"].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        tokens[r["doc_id"]] = re.findall(r"[^\x20\x09-\x0D]+", low) + [""]
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            counts.update(tokens[r["doc_id"]])
    n, v = sum(counts.values()), len(counts)
    assert model.emit.sum(axis=0) == pytest.approx(np.ones(hmm.STATES))
    for k, words in tokens.items():
        r = rows[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        if len(words) < 200:
            obs = hmm.buckets_of(np.array([hmm.word_hash(w.encode()) for w in words]))
            inside = sum(math.log10((counts[w] + 1) / (model.tokens[b] + model.types[b] + 1)) for w, b in zip(words, obs))
            assert r["score"] == pytest.approx(brute_forward(model, obs) + inside)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_edges(spark, edge, none):
    rows = hmm.op3_query(edge).collect()
    assert len(rows) == edge.count() and all(math.isfinite(r["score"]) for r in rows)
    assert hmm.op3_query(none).count() == 0
    only = spark.createDataFrame([(5, "a b")], "doc_id long, text string")
    assert zlib.crc32(b"5") % 7 != 2 and hmm.op3_query(only).collect()[0]["n_known"] == 3


# --- 5: decontamination ---

WORD5 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_contamination(texts, items, window=10):
    found = {}
    for i, t in items:
        w = WORD5.findall((t or "").translate(LOW))
        for j in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[j:j + window]), set()).add(i)
    out = []
    for t in texts:
        w, hit, ids = WORD5.findall((t or "").translate(LOW)), set(), set()
        for n in {len(k) for k in found}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in found:
                    hit |= set(range(j, j + n))
                    ids |= found[tuple(w[j:j + n])]
        out.append((len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_fm_index_search(seed):
    r = random.Random(seed)
    letters = "abéD"[:r.randint(1, 4)]
    texts = [None if r.random() < 0.1 else " ".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(r.randint(0, 9))]
    items = [(i, " ".join(r.choice(letters) for _ in range(r.randint(0, 14)))) for i in range(r.randint(0, 6))]
    window = r.randint(1, 7)
    got = decontaminate.search_shard(texts, decontaminate.Phrases(items, window))
    assert [(x["n_words"], x["n_hit"], x["items"]) for x in got] == brute_contamination(texts, items, window)


def test_fm_index_locates_every_occurrence():
    r = np.random.default_rng(3)
    text = r.integers(0, 3, 400)
    index = decontaminate.FMIndex(text, sample=5)
    patterns = np.array([[a, b, c] for a in range(4) for b in range(3) for c in range(3)])
    for p, low, high in zip(patterns, *index.search(patterns)):
        want = [i for i in range(398) if (text[i:i + 3] == p).all()]
        assert sorted(index.locate(np.arange(low, high))) == want


def test_decontaminate_query_blocks_and_edges(spark, tiny_docs, edge, none):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").unionByName(spark.createDataFrame(
        [(900, "one"), (901, None), (902, "..."), (None, "two"), (903, "one"), (903, "one")], "item_id long, text string"))
    items = [(r["item_id"], r["text"]) for r in bench.collect() if r["item_id"] is not None]
    docs = tiny_docs.select("doc_id", "text")
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], brute_contamination([r["text"] for r in rows], items)))
    for block in (decontaminate.BLOCK_BYTES, 3000):
        got = decontaminate.decontaminate(docs, bench, block_bytes=block).collect()
        assert {r["doc_id"]: (r["contamination"]["n_words"], r["contamination"]["n_hit"], sorted(set(r["contamination"]["items"]))) for r in got} == want
    assert sum(n > 0 for _, n, _ in want.values()) > 0
    out = decontaminate.decontaminate(edge, bench)
    assert out.count() == edge.count() and set(out.columns) == set(edge.columns)
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert decontaminate.decontaminate(edge, bench.limit(0)).filter("contamination.n_hit > 0").count() == 0


def test_spans_are_cut_out(spark):
    passage = prose(7, 14)
    docs = spark.createDataFrame([(1, f"Before. {passage.upper()}! After {passage}"), (2, passage), (3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(decontaminate.decontaminate(docs, bench)).collect()}
    assert got == {1: "Before. ! After ", 2: "", 3: "clean"}


# --- 7: pseudonyms ---

SAMPLE = ("mail Bob.Smith+1@ex.com IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 ssn 123-45-6789 on 2024-02-29 or 29.02.2024 "
          "ip 1.2.3.4 card 4111 1111 1111 1111 phone +1 (555) 123-4567 token = \"AB12cd34ef56ab78\" end")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4099])
def test_permutation(size):
    image = [pii.permute(i, size, "k", "t") for i in range(size)]
    assert sorted(image) == list(range(size))
    assert [pii.permute(x, size, "k", "t", back=True) for x in image] == list(range(size))
    if size > 90:
        assert image != [pii.permute(i, size, "other", "t") for i in range(size)]


def test_formats_survive_and_restore():
    text, found = pii.rewrite(SAMPLE, "k")
    assert [k for k, _, _ in found] == ["email", "iban", "iban", "ssn", "date", "date", "ip", "card", "phone", "secret"]
    assert [k for k, _, _ in pii.rewrite(text, "k")[1]] == [k for k, _, _ in found]  # outputs validate again
    assert pii.rewrite(text, "k", back=True)[0] == SAMPLE
    for k, s, n in found:
        assert text[s:s + n] not in SAMPLE or k == "iban"
    days = [text[s:s + n] for k, s, n in found if k == "date"]
    assert days[0] == "-".join(reversed(days[1].split(".")))  # equal dates stay linked across formats


@pytest.mark.parametrize("clean", ["4111 1111 1111 1112", "1234567890123456", "300.1.1.1", "2023-02-30", "000-12-3456", "a @ b", "v1.2.3",
                                   "DE88 3704 0044 0532 0130 00", "token economy", "", "plain words 12 and 2024"])
def test_invalid_values_are_left_alone(clean):
    assert pii.rewrite(clean, "k") == (clean, [])


def test_regions_change_nothing():
    r = random.Random(4)
    pieces = SAMPLE.split() + ["word"] * 200
    for _ in range(60):
        text = " ".join(r.choice(pieces) for _ in range(400))
        whole, at = [], 0
        while m := pii.PATTERN.search(text, at):  # plain scan of the whole text
            kind = next(k for k in pii.KINDS if m.group(k) is not None)
            new, end = pii.pseudonym(kind, m.group(kind), "k"), m.end(kind)
            at = m.end()
            if new is None:
                at = m.start() + 1
                while at < end and text[at].isalnum():
                    at += 1
            else:
                whole.append((kind, new))
        out, found = pii.rewrite(text, "k")
        assert [(k, out[s:s + n]) for k, s, n in found] == whole


def test_pseudonyms_query(spark, tiny_docs, edge, none):
    rows = {r["doc_id"]: r for r in pii.op7_query(tiny_docs).collect()}
    for r in tiny_docs.collect():
        assert rows[r["doc_id"]]["text"] == pii.rewrite(r["text"], pii.KEY)[0]
    back = pii.restore(pii.pseudonymise(tiny_docs)).select("doc_id", "text")
    assert back.exceptAll(tiny_docs.select("doc_id", "text")).count() == 0
    out = pii.pseudonymise(edge)
    assert out.count() == edge.count() and set(out.columns) == set(edge.columns)
    assert out.filter("doc_id = 4").collect()[0]["text"] is None
    assert pii.pseudonymise(none).count() == 0


# --- pipeline ---

def test_pipeline_equals_brute_force(spark, tiny_docs):
    """Every stage again from single-text functions and brute force, on all documents of the small table."""
    kept = {r["doc_id"] for r in quality.op1_query(tiny_docs).filter("kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in tiny_docs.collect() if r["doc_id"] in kept}
    sets = {}
    for k, t in texts.items():
        w = t.encode().split()
        sets[k] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    group = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    texts = {k: t for k, t in texts.items() if group[k] == k}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    for k, t in texts.items():
        r = decontaminate.search_shard([t], decontaminate.Phrases(bench))[0]
        assert (r["n_words"], r["n_hit"], r["items"]) == brute_contamination([t], bench)[0]
        for s in reversed(r["spans"]):
            t = t[:s["start"]] + t[s["start"] + s["length"]:]
        texts[k] = pii.rewrite(t, pii.KEY)[0]
    rows = [dict(r.asDict(), ids_crc32=zlib.crc32(r["ids"])) for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()]
    check_pieces(rows, texts)


def test_pipeline_stages_on_edge_rows(spark, edge, none):
    replaced = {"quality", "pii", "contamination", "class_id", "n_links", "representative"}  # names the operators use
    docs = edge
    for _, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, "/root/testdata/sf0.001")
        assert set(docs.columns) >= set(edge.columns) - replaced
    assert docs.count() > 0 and corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
    for _, fn in corpus_pipeline.STAGES:
        assert fn(spark, none, "/root/testdata/sf0.001").count() == 0


def test_pipeline_keeps_the_columns(spark, tiny_docs):
    docs = tiny_docs
    for _, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == tiny_docs.columns and docs.dtypes == tiny_docs.dtypes
    assert docs.filter("n_chars <> length(text)").count() == 0


def test_near_duplicates_stage_keeps_one(spark):
    a = prose(11, 100)
    docs = spark.createDataFrame([(5, a), (3, a), (3, a), (9, a + " tail"), (4, prose(12, 100)), (None, None)], "doc_id long, text string")
    left = nearjoin.keep_one(docs)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([3, 4, None])


# --- findings of the second review ---

def test_frequent_words_have_classes_of_their_own(tiny_docs):
    """The model keeps its full size, and the table grows by the words with enough training tokens."""
    assert hmm.BUCKETS >= 32768 and hmm.SLICES >= 8
    chunks = hmm.stage(hmm.encode(tiny_docs, slices=2), "test-chunks")
    counted = hmm.stage(hmm.count_words(chunks), "test-counts")
    frequent = {r["word"]: r["c"] for r in counted.filter("word <> 0 and c >= 50").collect()}
    model = hmm.train(chunks, counted, buckets=64, passes=1, own=50)
    assert len(frequent) > 5 and len(model.emit) == 64 + len(frequent) and list(model.own) == sorted(frequent)
    words = np.array([*frequent, 0, 12345], dtype=np.int64)
    classes = hmm.classes_of(words, model)
    assert len(set(classes[:-2])) == len(frequent) and classes[-2] == 0 and 0 < classes[-1] < 64
    assert [model.tokens[c] for c in classes[:-2]] == [frequent[w] for w in words[:-2]] and (model.types[64:] == 1).all()
    assert model.tokens.sum() == counted.groupBy().sum("c").first()[0]
    assert all(math.isfinite(r["score"]) for r in hmm.score(chunks, counted, model).collect())


def test_classes_of_their_own_are_bounded(spark, tiny_docs, monkeypatch):
    """Beyond the bound fewer words have a class; all scores of the base stay, as counts are exact inside buckets."""
    counted = spark.createDataFrame([(0, 900)] + [(i, i) for i in range(1, 101)], "word long, c long")
    for most in (91, 81, 61, 21, 0):
        least = hmm.least_own(counted, 10, most)
        assert sum(i >= least for i in range(1, 101)) <= most and (least == 10 or sum(i >= least // 2 for i in range(1, 101)) > most)
    chunks = hmm.stage(hmm.encode(tiny_docs, chunk_tokens=5000), "test-chunks")
    counted = hmm.stage(hmm.count_words(chunks), "test-counts")
    out = []
    for most in (1 << 18, 3):
        monkeypatch.setattr(hmm, "MOST_OWN", most)
        model = hmm.train(chunks, counted, buckets=64, passes=1, own=20)
        assert len(model.own) <= most
        out.append({r["doc_id"]: (r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in hmm.score(chunks, counted, model).collect()})
    assert out[0] == out[1]


@pytest.mark.parametrize("kind, value", [
    ("phone", "555-123-4567"), ("phone", "555.123.4567"), ("phone", "+14155550123"), ("phone", "1-555-123-4567"), ("phone", "+1 4155550123"),
    ("date", "25/12/2020"), ("date", "2020/12/25"), ("date", "25-12-2020"), ("date", "12-25-2020"), ("date", "12/25/2020"),
    ("iban", "ES91 2100 0418 4502 0005 1332"), ("iban", "BE68 5390 0754 7034"), ("iban", "AT61 1904 3002 3457 3201"),
    ("card", "4111 1111 1111 1111"), ("card", "4111111111111111"),
    ("secret", "sk-live_AB12cd34ef56ab78"), ("secret", "a" * 150 + "7" + "b" * 1000), ("secret", "x" * 2000 + "9" * 5000)])
@pytest.mark.parametrize("before, after", [("see ", " paid to you"), ("x - ", " for us, 3 of them."), ("-", "."), (".", " END")])
def test_common_shapes_in_running_text(kind, value, before, after):
    if kind == "secret":
        before = "token: "
    if kind not in ("secret", "card") and before in "-.":
        before = "see "  # a hyphen or full stop may join other kinds to what stands before
    text = "words of text " + before + value + after
    out, found = pii.rewrite(text, "k")
    assert [k for k, _, _ in found] == [kind]
    start, n = found[0][1:]
    assert n == len(value) and start == text.index(value) and out[start:start + n] != value
    assert out[:start] + out[start + n:] == text[:start] + text[start + n:]
    assert pii.rewrite(out, "k", back=True)[0] == text


def test_items_without_id_are_found(spark):
    passage = prose(7, 14)
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (5, "elsewhere")], "item_id long, text string")
    got = {r["doc_id"]: r["contamination"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert (got[1]["n_hit"], got[1]["items"], got[2]["n_hit"]) == (14, [], 0)


@pytest.mark.parametrize("clean", ["table 100 200 3000 rows", "000 000 0000", "120.000.0000", "1-100-200-3000"])
def test_digits_outside_the_numbering_plan_are_no_telephone_number(clean):
    assert pii.rewrite(clean, "k") == (clean, [])


def test_telephone_numbers_stay_linked_across_formats():
    digits = lambda s: "".join(c for c in s if c.isdigit())[-10:]
    for forms in (("555-123-4567", "+1 (555) 123-4567", "(555) 123 4567", "555.123.4567"), ("+1 (017) 555-7713", "(017) 555-7713", "+10175557713")):
        out = [pii.rewrite(f"call {f} now", "k")[0] for f in forms]
        assert len({digits(x) for x in out}) == 1 and digits(out[0]) != digits(forms[0])
        assert [pii.rewrite(x, "k", back=True)[0] for x in out] == [f"call {f} now" for f in forms]


def plain_finds(text):
    """(kind, value) by splitting and counting characters, without the operator's pattern."""
    out = []
    for token in text.split():
        token = token.strip(",;:!?\"'")
        at = token.rstrip(".")
        if at.count("@") == 1 and "." in at.split("@")[1] and all(c.isalnum() or c in "._%+-@" for c in at) and at.isascii():
            out.append(("email", at.split("@")[0]))
        parts = at.split(".")
        if len(parts) == 4 and all(x.isdigit() and x.isascii() and len(x) < 4 and int(x) < 256 and str(int(x)) == x for x in parts):
            out.append(("ip", at))
        if len(at) == 10 and at[4] == at[7] == "-" and at.replace("-", "").isdigit() and at.isascii():
            try:
                dt.date.fromisoformat(at)
                out += [("date", at)] * (1900 <= int(at[:4]) < 2100)
            except ValueError:
                pass
        if len(at) == 11 and at[3] == at[6] == "-" and at.replace("-", "").isdigit() and int(at[:3]) not in (0, 666) and int(at[:3]) < 900 \
                and at[4:6] != "00" and at[7:] != "0000":
            out.append(("ssn", at))
    words = text.split(" ")
    for x, y, z in zip(words, words[1:], words[2:]):
        if x[:1] == "+" and x[1:].isdigit() and len(y) == 5 and y[0] + y[4] == "()" and y[1:4].isdigit() and len(z) >= 8 and z[3] == "-" \
                and (z[:3] + z[4:8]).isdigit() and not z[8:9].isdigit():
            out.append(("phone", f"{x} {y} {z[:8]}"))
    for i in range(len(words) - 3):
        if all(len(w) == 4 and w.isdigit() for w in words[i:i + 3]) and len(w := words[i + 3].rstrip(".,;")) == 4 and w.isdigit():
            total = sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate("".join(words[i:i + 3]) + w))
            if total % 10 == 0:
                out.append(("card", " ".join(words[i:i + 3] + [w])))
    return out


def test_an_independent_finder_finds_nothing_more(tiny_docs):
    """What plain splitting finds in the documents is found by the operator, as the same kind and value."""
    seen = Counter()
    for r in tiny_docs.collect():
        text = r["text"] or ""
        want = Counter(plain_finds(text))
        if want:
            out, found = pii.rewrite(text, "k")
            back = pii.rewrite(out, "k", back=True)
            got = Counter((k, back[0][s:s + n]) for k, s, n in back[1])
            assert back[0] == text and [k for k, _, _ in found] == [k for k, _, _ in back[1]]
            assert not want - got, (want - got, text[:200])
            seen.update(k for k, _ in want)
    assert len(seen) >= 3 and sum(seen.values()) >= 5


def test_benchmark_blocks_are_alive_one_at_a_time(spark, tiny_docs, monkeypatch):
    """Blocks are written pass by pass, and their broadcasts destroyed but for the last one's."""
    from pyspark.core.broadcast import Broadcast
    alive, most = [], []
    make, destroy = type(spark.sparkContext).broadcast, Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: (alive.append(1), most.append(len(alive)), make(self, v))[2])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (alive.pop(), destroy(self, *a))[1])
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = tiny_docs.select("doc_id", "text")
    one = decontaminate.decontaminate(docs, bench)
    whole = sorted(map(repr, one.collect()))
    alive.clear()
    most.clear()
    many = decontaminate.decontaminate(docs, bench, block_bytes=4000)
    assert sorted(map(repr, many.collect())) == whole and len(most) > 2 and max(most) == 1
