"""Operator 13: the pointer sort against sorted(), the audit against brute force and SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from histmart.llm import sourceaudit
from llm.llm_helpers import prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abABz é中\U0001f6001.-"), max_size=200), st.sampled_from([1, 3, 4096]))
def test_runs_are_sorted(text, limit):
    data = sourceaudit._letters()[np.frombuffer(text.encode(), np.uint8)]
    starts, lengths = sourceaudit.word_starts(data)
    kept, sourceaudit.SLICE = sourceaudit.SLICE, limit
    try:
        order, heads = sourceaudit.sorted_runs(sourceaudit.Slices(data, starts, lengths))
    finally:
        sourceaudit.SLICE = kept
    words = [bytes(data[s:s + n]) for s, n in zip(starts, lengths)]
    assert words == [w.encode() for w in terms_of(text)]
    assert order.tolist() == sorted(range(len(words)), key=lambda i: words[i])  # sorted() is stable
    runs = [words[i] for i in order]
    assert heads.tolist() == [i for i in range(len(runs)) if i == 0 or runs[i] != runs[i - 1]]


def brute(rows, min_docs=10):
    """(lang, source, part, item, value, rank) of rows (lang, source, text), in the plainest way."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = terms_of(text)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in counts:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1000000000 * (count[t] + 2) // (total + 2 * v) for t in kept}

        mine = shares(counts[lang, source])
        whole = shares(sum((c for (x, _), c in counts.items() if x == lang), Counter()))
        f = lambda p, q: (p - q) * (p - q) // (p + q)
        pair = [(s, sum(f(mine[t], other) for t, other in shares(c).items())) for (x, s), c in counts.items() if x == lang and s != source]
        term = [(t, f(mine[t], whole[t])) for t in kept if counts[lang, source][t] and mine[t] > whole[t]]
        for part, found, most in (("pair", pair, None), ("term", term, 10)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def found(docs):
    return sorted(tuple(r) for r in sourceaudit.op13_query(docs).collect())


def test_audit_equals_brute_force(spark, edge, none, tiny_docs):
    r = random.Random(7)
    words = prose(3, 400).split()
    rows = [(r.choice(["en", "de", None]), f"s{min(r.randrange(9), r.randrange(9))}",
             " ".join(r.choices(words[:r.choice([20, 60, 400])], k=r.randrange(60))) + r.choice(["", "ÉTÉ 中文", "It's x9y"])) for _ in range(400)]
    rows += [("fr", "only", "one two"), ("it", "a", "uno"), ("it", "b", None), ("", None, None)]
    made = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    for docs in (made, tiny_docs, edge, made.limit(0), none):
        assert found(docs) == brute([tuple(x) for x in docs.select("lang", "source", "text").collect()])


def test_common_terms_of_repeated_rows(spark):
    """Repeated rows are documents, so ten copies keep their terms; nine do not."""
    rows = [("en", "a", "Alpha beta")] * 10 + [("en", "b", "gamma")] * 9 + [("en", "c", "alpha alpha")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert found(docs) == brute(rows)
    assert {x[3] for x in found(docs) if x[2] == "term"} == {"alpha", "beta"}


@pytest.mark.parametrize("shard_bytes", [1, 1 << 24])
def test_counts_do_not_depend_on_shards(spark, tiny_docs, shard_bytes):
    got = sourceaudit.term_counts(tiny_docs, shard_bytes=shard_bytes)
    n, docs = defaultdict(int), defaultdict(int)
    for r in tiny_docs.collect():
        for t, k in Counter(terms_of(r["text"])).items():
            n[r["lang"], r["source"], t] += k
            docs[r["lang"], r["source"], t] += 1
    assert {tuple(x)[:3]: tuple(x)[3:] for x in got.collect()} == {k: (n[k], docs[k]) for k in n}


def test_shares_are_exact_for_large_counts(spark):
    big = 9_000_000_000_000_000
    df = spark.createDataFrame([(big, big + 5, 3)], "n long, total long, terms long")
    p = df.select(sourceaudit.share("n", "total", "terms").alias("p"), sourceaudit.share(0, "total", "terms").alias("p0")).first()
    assert tuple(p) == (1 + 1000000000 * (big + 2) // (big + 5 + 6), 1)
    assert df.select(sourceaudit.gap("1000000001L", "1L").alias("f")).first()["f"] == 1000000000 ** 2 // 1000000002
    assert df.select(F.lit(1)).count() == 1
