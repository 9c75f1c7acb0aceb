"""Operators 1, 9 and 10: brute force, edge cases and plans without Python."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from histmart.llm import chat, quality, queries, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_measures_match_brute_force(spark, edge, tiny_docs):
    extra = spark.createDataFrame([(100, "a b c a b c a b c"), (101, "a a a a"), (102, "x\nx\n\n \nx y\nx"), (103, "#*$%&|<>! a|b"),
                                   (104, "a b c d a b c"), (105, "a\x0bb\x0cc\rd")], "doc_id long, text string")
    for docs in (edge.select("doc_id", "text"), tiny_docs.select("doc_id", "text"), extra):
        for r in quality.op1_query(docs).join(docs.withColumnRenamed("doc_id", "d").distinct(),
                                              F.col("d").eqNullSafe(F.col("doc_id"))).collect():
            got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            if r["doc_id"] is not None:
                assert got == brute_base(r["text"])
                assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
                assert not (r["base_failed"] and r["kept"])


def test_fences_follow_the_group(spark):
    plain = "word other thing here there " * 3 + " ".join(f"w{i}" for i in range(60))
    rows = [(i, plain.replace("w1", f"v{i}"), "en", "a") for i in range(250)]
    rows += [(1000 + i, " ".join(f"w{j}x{i}#" if j % 2 else f"w{j}" for j in range(80)), "en", "b") for i in range(250)]
    rows += [(2000, " ".join(f"w{j}#" for j in range(80)), "en", "a"), (2001, " ".join(f"w{j}##" for j in range(80)), "en", "b")]
    got = {r["doc_id"]: r["kept"] for r in quality.op1_query(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(250)) and all(got[1000 + i] for i in range(250))  # half the words marked is usual in b
    assert not got[2000] and not got[2001]


def test_sketches_merge_exactly(spark, tiny_docs):
    whole = quality.sketches(quality.with_measures(tiny_docs))
    parts = [quality.sketches(quality.with_measures(tiny_docs.filter(F.col("doc_id") % 3 == k))) for k in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)


def test_quality_edges(edge, none):
    out = quality.judge(edge)
    assert out.count() == edge.count() and set(out.columns) == set(edge.columns)
    assert quality.keep_good(none).count() == 0 and quality.judge(none).count() == 0
    assert {r["doc_id"] for r in out.filter("quality.kept").collect()} >= {1, 2, 3, 8}


@pytest.mark.parametrize("bucket_bytes", [20_000, 1 << 24])
def test_shards(edge, none, bucket_bytes):
    out = sharding.external_shuffle(edge, bucket_bytes=bucket_bytes).cache()
    assert set(out.columns) == set(edge.columns)
    rows = out.select("doc_id", "text", "shard", "slot").collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, rows)) == sorted(map(key, edge.collect()))
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert sharding.external_shuffle(none).count() == 0


def test_shuffle_repeats_and_mixes(tiny_docs):
    a = sharding.op9_query(tiny_docs).select("doc_id", "shard", "slot").collect()
    assert a == sharding.op9_query(tiny_docs).select("doc_id", "shard", "slot").collect()
    order = [r["doc_id"] for r in sorted(a, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(x + 1 == y for x, y in zip(order, order[1:])) < len(order) / 10


def test_shuffle_places_are_uniform(spark):
    """Every row number lands in every eighth of the order about equally often over seeds."""
    df = spark.range(64).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    counts = Counter()
    for seed in range(12):
        for r in sharding.external_shuffle(df, seed=seed * 1000, bucket_bytes=40).collect():
            counts[(r["doc_id"] // 8, r["shard"])] += 1
    assert len(counts) == 64 and max(counts.values()) < 4 * 12


def test_write_shards(tiny_docs, tmp_dir):
    sharding.write_shards(sharding.external_shuffle(tiny_docs), f"{tmp_dir}/shards")
    back = tiny_docs.sparkSession.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == tiny_docs.count() and back.select("shard").distinct().count() == 8


TURNS = [
    (1, 0, "system", "be <|end|> kind"), (1, 1, "user", "a\\b <|turn|>"), (1, 2, "assistant", "<\\|x<|text|>\n"), (1, 3, "user", "?"),
    (1, 4, "assistant", ""), (2, 0, "user", None), (2, 1, "user", "only"), (3, 0, "assistant", "first"), (3, 1, None, "x"),
    (4, None, "user", "u"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (None, 0, "assistant", "null id \U0001f600"),
    (5, 0, "we<|text|>ird", "\\"), (5, 1, "assistant", "\\\\<|"),
]


def brute_chat(turns):
    convs = {}
    for c, t, r, x in turns:
        convs.setdefault(c, []).append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    out = {}
    for c, rows in convs.items():
        rows = [(r[1], x[1]) for _, r, x in sorted(rows)]
        whole = "".join(f"{r}\n{x}\n" for r, x in rows)
        loss = "".join(x for r, x in rows if r == "assistant")
        out[c] = (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_digests(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.op10_query(df).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got == brute_chat(TURNS + [(-7, 0, "user", said), (-7, 1, "assistant", said)])


def test_chat_examples(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    rows = chat.expand(df.filter("conv_id = 1")).orderBy("example").collect()
    assert [r["example"] for r in rows] == [2, 4] and [r["closing"] for r in rows] == [False, True]
    assert rows[1]["formatted"].startswith(rows[0]["formatted"])  # the context holds all preceding turns
    assert rows[0]["formatted"][rows[0]["loss_start"]:][:rows[0]["loss_chars"]] == "<\\\\|x<\\|text|>\n"
    assert rows[1]["loss_chars"] == 0
    assert chat.expand(df.filter("false")).count() == 0
    tail = chat.expand(df.filter("conv_id = 2")).collect()
    assert [(r["example"], r["closing"], r["loss_chars"]) for r in tail] == [(2, True, 0)]


@pytest.mark.parametrize("name", ["op1_adaptive_quality", "op10_prefix_target"])
def test_sql_twin(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    df = queries.QUERIES[name](spark, d)
    res = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, res))


@pytest.mark.parametrize("name", ["op1_adaptive_quality", "op9_external_shuffle", "op10_prefix_target"])
def test_native_plans_have_no_python(spark, name, capsys):
    queries.QUERIES[name](spark, "/root/testdata/sf0.001").explain("formatted")
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", capsys.readouterr().out.replace("LocalTableScan", ""))
