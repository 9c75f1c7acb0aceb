"""Operator 12: tries against a dictionary, owners against brute force and SQL."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from histmart.llm import exactdup
from llm.llm_helpers import prose

STRINGS = st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)) | st.binary(max_size=40), max_size=60)


@settings(max_examples=200, deadline=None)
@given(STRINGS)
def test_trie_numbers_strings(strings):
    trie, seen = exactdup.Trie(), {}
    for i, s in enumerate(strings):
        at, new = trie.insert(s, i)
        assert new == (s not in seen) and at == seen.setdefault(s, i)
    assert sorted(trie.numbers(trie.root)) == sorted(seen.values()) and trie.terminals == len(seen)


@settings(max_examples=200, deadline=None)
@given(STRINGS, st.lists(st.integers(0, 59), max_size=4), st.booleans())
def test_handed_out_subtrees(strings, spills, mark):
    """What leaves is never found inside again (marked), what stays is; the last terminal stays."""
    trie, inside, out = exactdup.Trie(), {}, set()
    text = {}
    for i, s in enumerate(strings):
        at, new = trie.insert(s, i)
        if at < 0:
            assert mark and s not in inside
            out.add(s)
            continue
        assert not (mark and s in out)
        assert new == (s not in inside) and at == inside.setdefault(s, i)
        text[at] = s
        if i in spills:
            before = trie.terminals
            gone = trie.hand_out(trie.bytes // 2, lambda n: len(text[n]), mark)
            assert len(set(gone)) == len(gone) and trie.terminals == before - len(gone) >= min(before, 1)
            for n in gone:
                out.add(text[n])
                del inside[text[n]]
    assert sorted(trie.numbers(trie.root)) == sorted(inside.values())


def brute(rows, keep="largest"):
    """Sorted (key, keep_id, group_size, sha) and the number of rows kept in each group."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for text, keys in groups.items():
        named = [k for k in keys if k is not None]
        best = (max if keep == "largest" else min)(named) if named else None
        out += [(k, best, len(keys), hashlib.sha256(text.encode()).hexdigest()) for k in keys]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("trie_bytes,owner_bytes,keep", [(exactdup.TRIE_BYTES, exactdup.OWNER_BYTES, "smallest"), (20_000, 40_000, "largest")])
def test_groups_equal_brute_force(spark, edge, none, tiny_docs, monkeypatch, trie_bytes, owner_bytes, keep):
    """Small tries: subtrees are handed out in the tasks and, over several rounds, by owners."""
    monkeypatch.setattr(exactdup, "TRIE_BYTES", trie_bytes)
    monkeypatch.setattr(exactdup, "OWNER_BYTES", owner_bytes)
    rounds = []
    owned = exactdup.owned
    monkeypatch.setattr(exactdup, "owned", lambda *a: rounds.append(a) or owned(*a))
    same = prose(5, 40)
    hot = spark.createDataFrame([(i, same if i % 3 == 0 else f"{same} {i % 70}") for i in range(300)], "doc_id long, text string").repartition(7)
    for docs in (edge, tiny_docs, hot):
        docs = docs.select("doc_id", "text").cache()
        got = exactdup.deduplicate(docs, keep=keep, columns=["doc_id"])
        rows, groups = brute([tuple(r) for r in docs.collect()], keep)
        found = got.collect()
        assert sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "text_sha256")) for r in found), key=repr) == rows
        kept = [r for r in found if r["kept"]]
        assert len(kept) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len(rounds) == 3 if trie_bytes > 20_000 else len(rounds) > 3
    assert exactdup.deduplicate(none).count() == 0


def test_columns_and_normalising(spark, edge):
    out = exactdup.deduplicate(edge, normalise=F.lower)
    assert out.columns == [*edge.columns, *exactdup.ADDED] and out.count() == edge.count()
    left = exactdup.keep_one(edge)
    assert left.columns == edge.columns and left.dtypes == edge.dtypes
    rows, groups = brute([(r["doc_id"], r["text"]) for r in edge.collect()])
    assert left.count() == groups
    odd = spark.createDataFrame([(1, "A b", "x", "y"), (2, "a B", "z", "w"), (3, "a c", "u", "v")], "doc_id long, text string, keep_id string, term string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["term"]) for r in exactdup.deduplicate(odd, normalise=F.lower).collect()}
    assert got == {1: (2, 2, False, "y"), 2: (2, 2, True, "w"), 3: (3, 1, True, "v")}
    assert [r["keep_id"] for r in exactdup.keep_one(odd, normalise=F.lower, keep="smallest").orderBy("doc_id").collect()] == ["x", "u"]
    with pytest.raises(ValueError):
        exactdup.deduplicate(odd, keep="first")


def test_equal_hashes_are_not_equal_texts(spark, monkeypatch):
    """Texts whose content hashes and lengths agree meet in one owner and stay apart there."""
    terminals = exactdup._terminals

    def colliding(*a):
        import pyarrow as pa
        columns = terminals(*a)
        columns[2] = pa.array([1] * len(columns[2]), pa.int64())
        return columns
    monkeypatch.setattr(exactdup, "_terminals", colliding)
    docs = spark.createDataFrame([(i, f"text {i % 5}") for i in range(50)], "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in exactdup.deduplicate(docs).collect()}
    assert got == {(i, 45 + i % 5, 10) for i in range(50)}
