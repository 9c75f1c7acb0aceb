"""Operators 4, 6 and 8 against brute force."""

import os
import random
from collections import defaultdict
from math import comb

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from histmart.llm import common, graph, nearjoin, passages, urlgraph
from histmart.llm.shingles import MinHasher
from llm.llm_helpers import prose


# --- 4: URL trust ---

def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    fits = [(h + p, v) for v, h, p in urlgraph.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict


URLS = ["http://a.org/x", "https://EXAMPLE.org/en/12?q", "http://www.example.org/es/", "http://notexample.org/es/", "http://x.com/fr/a", "http://x.com/de/a",
        "http://x.com/en/a", "http://org/", "http://a.org", "http://a.org?x=/fr/", None, "nourl", "://", "http://x.com#/de/", "ftp://Y.COM/de/", "http://a.org/x",
        "http://u.net/a\nb?c", "mailto:x@a.org", "http:///de/"]


def brute_propagate(seeds, edges):
    trust, distrust = {h: s[0] for h, s in seeds.items()}, {h: s[1] for h, s in seeds.items()}
    out, into = defaultdict(float), defaultdict(float)
    for (a, b), w in edges.items():
        out[a] += w
        into[b] += w
    d = urlgraph.DAMPING
    base_t, base_d = ({h: (1 - d) * x for h, x in v.items()} for v in (trust, distrust))
    t, x = dict(base_t), dict(base_d)
    for _ in range(urlgraph.ITERATIONS):
        nt, nx = defaultdict(float, base_t), defaultdict(float, base_d)
        for (a, b), w in edges.items():
            nt[b] += d * t.get(a, 0) * w / out[a]
            nx[a] += d * x.get(b, 0) * w / into[b]
        t, x = nt, nx
    return t, x


def test_rules(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    for r in urlgraph.op4_query(df).collect():
        host, path, rule, verdict = brute_rule(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)


def test_propagation_matches_brute_force(spark):
    rnd = random.Random(5)
    hosts = [f"h{i}.net" for i in range(12)] + ["good.org", "bad.com", "m.h1.net", "h2.com"]
    rows = []
    for i in range(120):
        h = rnd.choice(hosts)
        path = "/de/" if h.endswith("com") else "/p"
        links = " ".join(rnd.choice(('<a href="http://%s/x">', "<A HREF='//%s'>", "<a href=https://%s?q>", '<a href="/local/%s">')) % rnd.choice(hosts)
                         for _ in range(rnd.randint(0, 4)))
        rows.append((i, f"http://{h}{path}", rnd.choice([links, links, None])))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seeds, edges = {}, defaultdict(float)
    import re
    for _, url, html in rows:
        host, _, _, verdict = brute_rule(url)
        s = seeds.setdefault(host, [0.0, 0.0])
        s[0] += verdict == "allow"
        s[1] += verdict == "block"
        for m in re.findall(r"(?i)href=[\"']?(?:https?:)?//([^/?#\"'\s>]+)", html or ""):
            if m != host:
                edges[(host, m)] += 1
    for h in seeds:
        parent = h.split(".", 1)[1]
        if parent in seeds:
            edges[(h, parent)] += 1
            edges[(parent, h)] += 1
    t, x = brute_propagate(seeds, edges)
    for r in urlgraph.judge(df).collect():
        assert r["trust"] == pytest.approx(t[r["host"]]) and r["distrust"] == pytest.approx(x[r["host"]])
        if r["rule"] is None:
            share = x[r["host"]] / (t[r["host"]] + x[r["host"]]) if t[r["host"]] + x[r["host"]] else 0
            assert r["verdict"] == ("block" if share > urlgraph.THRESHOLD else "allow")


def test_url_edges(spark):
    df = spark.createDataFrame([(1, None, None, "r", "v", "h"), (1, None, None, "r", "v", "h"), (None, "http://q.org/", "", None, None, None)],
                               "page_id long, url string, html string, rule string, verdict string, host string")
    out = urlgraph.judge(df)
    assert out.count() == 3 and out.columns.count("rule") == 1
    assert urlgraph.judge(df.limit(0)).count() == 0


# --- 6: Jaccard join ---

def brute_classes(texts):
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().split()
        n = min(5, len(w))
        sets[k] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
    group = {k: k for k in sets}
    near = defaultdict(set)
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    return group, near


def family_texts():
    """Families of near copies at all distances about the threshold, chains, copies and short texts."""
    r = random.Random(8)
    texts, n = {}, 0
    for f in range(12):
        base = prose(100 + f, r.choice((40, 80, 150))).split()
        for _ in range(r.randint(1, 12)):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"edit{n}"
            texts[n] = " ".join(w)
            n += 1
            if r.random() < 0.3:
                base = w  # chains: each a step further
    for t in (None, "", "a", "a", "a b", "a b c d", "a b c d e", "b a", " a b "):
        texts[n] = t
        n += 1
    return texts


@pytest.mark.parametrize("block", [nearjoin.BLOCK, 4])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nearjoin, "BLOCK", block)  # 4: every family is verified block by block
    texts = family_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    group, near = brute_classes(texts)
    rows = {r["doc_id"]: r for r in nearjoin.op6_query(df).collect()}
    assert {k: r["class_id"] for k, r in rows.items()} == group
    for k, r in rows.items():
        assert (r["n_links"] > 0) == bool(near[k]) and r["n_links"] <= len(near[k])


def test_large_family_makes_few_pairs(spark):
    """A family of near copies of one base, pairwise often below the threshold, ends in one class."""
    r = random.Random(3)
    base = prose(77, 120).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        w = list(base)
        for _ in range(2):
            w[r.randrange(len(w))] = f"e{i}"
        rows.append((i, " ".join(w)))
    out = nearjoin.op6_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    group, _ = brute_classes(dict(rows))
    assert {x["doc_id"]: x["class_id"] for x in out} == group and sum(x["n_links"] for x in out) < 20 * len(out)


def test_family_meets_few_pivots(spark):
    """2,000 near copies of one text: at most six candidate pairs a node over all bands, and near a forest of edges."""
    r = random.Random(4)
    base = prose(78, 150).split()
    rows = []
    for i in range(2000):
        w = list(base)
        w[r.randrange(len(w))] = f"e{i}"
        rows.append((i, " ".join(w)))
    signed = nearjoin.signed(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    nodes = signed.selectExpr("_llm_row AS id", "_llm_sig AS sig")
    met = nearjoin.candidates(nearjoin._bands(nodes)).cache()
    assert met.count() <= 6 * len(rows)
    edges = graph.starred(met)
    assert edges.count() <= 1.2 * len(rows)
    assert (graph.components(edges).select("component").distinct().count()
            == graph.components(met.toDF("a", "b")).select("component").distinct().count())


def test_names_of_input_columns_are_free(spark):
    a, b = prose(13, 60), prose(14, 60)
    names = ["doc_id", "text", "head", "_llm_row", "_llm_set", "component", "id", "key", "c0", "c1", "class_id"]
    rows = [(i, t, *[f"{n}{i}" for n in names[2:]]) for i, t in enumerate((a, a, b))]
    docs = spark.createDataFrame(rows, names)
    assert nearjoin.keep_one(docs).columns == names
    assert sorted(map(tuple, nearjoin.keep_one(docs).collect())) == [rows[0], rows[2]]
    out = {r["doc_id"]: r for r in nearjoin.classify(docs).collect()}
    assert [out[i]["class_id"] for i in range(3)] == [0, 0, 2] and out[1]["head"] == "head1"


def test_staged_tables_go_with_their_block_alone(spark):
    first, second = (spark.createDataFrame([(i, prose(i, 30))], "doc_id long, text string") for i in (1, 2))
    kept = nearjoin.keep_one(first)
    with common.scratch(spark):
        inner = nearjoin.keep_one(second)
        paths = inner.inputFiles()
        assert inner.count() == 1
    assert kept.count() == 1  # what another result reads is still there
    assert paths and not any(os.path.exists(p.removeprefix("file://")) for p in paths)


@pytest.mark.parametrize("seed", range(15))
def test_linked_is_a_forest_over_all_links(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = []
    for _ in range(int(r.integers(2, 25))):
        s = base.copy()
        s[r.integers(0, 60, int(r.integers(0, 9)))] = r.integers(0, 1 << 62)
        sets.append(np.unique(s))
    everyone = np.arange(len(sets))
    near = {(i, j) for i in everyone for j in everyone if i < j
            and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))}
    found = nearjoin.linked(sets, list(range(len(sets))), everyone, everyone)
    assert all((min(e), max(e)) in near for e in found)

    def classes(edges):
        group = {int(i): int(i) for i in everyone}
        for a, b in edges:
            low, high = sorted((group[a], group[b]))
            group = {k: low if g == high else g for k, g in group.items()}
        return group
    assert classes(found) == classes(near) and len(found) == len(sets) - len(set(classes(near).values()))


def test_near_edges(edge, none):
    out = nearjoin.classify(edge)
    assert out.count() == edge.count() and set(out.columns) == set(edge.columns)
    rows = out.collect()
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert sum(r["representative"] for r in rows if r["doc_id"] in (1, 2)) == 1
    assert all(r["class_id"] == r["doc_id"] and r["representative"] for r in rows if r["doc_id"] in (4, 5, 6))
    assert nearjoin.classify(none).count() == 0


@pytest.mark.parametrize("compared", [20, 40, 60, 80, 100])
def test_posterior_bound(compared):
    least = nearjoin.least_matches(0.8, compared)
    grid = np.linspace(0, 1, 200_001)

    def upper(m):  # posterior by numerical integration
        f = grid ** m * (1 - grid) ** (compared - m) * comb(compared, m)
        return f[grid >= 0.8].sum() / f.sum()
    assert upper(least) >= nearjoin.TOLERANCE * 0.99 and (least == 0 or upper(least - 1) < nearjoin.TOLERANCE * 1.01)


def test_minhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    m = MinHasher(400)
    a, b = rng.integers(0, 1 << 63, 3000).astype(np.uint64), rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    b[:2000] = a[:2000]
    assert abs((m(a) == m(b)).mean() - 0.5) < 0.08


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(25)] + [(500, i) for i in range(501, 560)]
    group = {x: x for e in edges for x in e}
    for a, b in edges:
        low, high = sorted((group[a], group[b]))
        group = {k: low if g == high else g for k, g in group.items()}
    df = spark.createDataFrame(edges, "a long, b long")
    assert {x["id"]: x["component"] for x in graph.components(df).collect()} == group
    assert graph.components(df.limit(0)).count() == 0


# --- 8: passages ---

segment = st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 9))


@settings(max_examples=200, deadline=None)
@given(st.lists(segment, min_size=1, max_size=9, unique=True))
def test_best_chain_is_optimal(segs):
    """The first chain's score equals the best over all ordered subsets."""
    def score(chain):
        total = chain[0][2]
        for (p, q, n), (p1, q1, n1) in zip(chain, chain[1:]):
            total += n1 - passages.GAP_COST * (p1 - p - n + q1 - q - n)
        return total

    best, stack = 0.0, [[s] for s in segs]
    while stack:
        c = stack.pop()
        best = max(best, score(c))
        p, q, n = c[-1]
        stack += [c + [s] for s in segs if s[0] >= p + n and s[1] >= q + n]
    out = passages.chains(sorted(segs))
    assert sorted(s for c in out for s in c) == sorted(segs)
    assert score(out[0]) == pytest.approx(best)


@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
@settings(max_examples=200, deadline=None)
def test_common_subsequence(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert passages.common_subsequence(a, b) == t[-1][-1]


@pytest.mark.parametrize("n", [0, 5, 8, 12, 23, 24, 60, 400])
def test_minimisers_cover_every_window(n):
    h = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    at = passages.minimisers(h)
    runs = max(0, n - passages.K + 1)
    assert all(((at >= i) & (at < i + passages.SPAN)).any() for i in range(max(0, runs - passages.SPAN + 1)))
    assert (len(at) > 0) == (runs > 0)


def test_planted_passages(spark):
    r = random.Random(6)
    passage = prose(900, 70).split()
    fuzzy = list(passage)
    for i in (12, 30, 55):
        fuzzy[i] = "changed"
    del fuzzy[40]
    docs, place = {}, {}
    for i in range(40):
        w = prose(1000 + i, r.randint(30, 200)).split()
        if i % 4 == 0:
            at = r.randrange(len(w))
            body = fuzzy if i % 8 else passage
            w[at:at] = body
            place[i] = (at, at + len(body))
        docs[i] = " ".join(w)
    docs[50] = docs[51] = prose(2000, 90)
    docs[52] = docs[53] = prose(2001, 20)  # copies, but short
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    rows = passages.op8_query(df).collect()
    assert {r["doc_id"] for r in rows} | {r["other_id"] for r in rows} == set(place) | {50, 51}
    pairs = defaultdict(list)
    for x in rows:
        pairs[x["doc_id"]].append((x["start"], x["start"] + x["length"]))
        pairs[x["other_id"]].append((x["other_start"], x["other_start"] + x["other_length"]))
    for k, (s, e) in place.items():
        assert any(abs(a - s) <= 4 and abs(b - e) <= 4 for a, b in pairs[k])


def test_passage_edges(edge, none):
    rows = passages.op8_query(edge).collect()
    assert {(r["doc_id"], r["other_id"]) for r in rows} >= {(2, 1)}
    assert all(r["length"] >= passages.MIN_WORDS for r in rows)
    assert passages.op8_query(none).count() == 0


# --- findings of the second review ---

def slots(seed, common, unique):
    """A family: texts of ``common`` lines out of a pool that many share, and words of their own."""
    r = random.Random(seed)
    pool = [prose(5000 + i, 12) for i in range(10)]
    texts = {}
    for i in range(60):
        body = r.sample(pool, common)
        texts[i] = " ".join(body) + " " + prose(7000 + i, unique)
    return texts


def test_pair_with_a_third_text_as_pivot_is_found(spark, monkeypatch):
    """One bucket holds all texts, so its only pivot is unlike most similar pairs."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(nearjoin, "SIGNATURES", 8)  # the bucket has several blocks
    monkeypatch.setattr(nearjoin, "_bands", lambda nodes: nodes.select("id", F.lit(1).cast("long").alias("key")))
    texts = slots(1, 6, 30)
    for i in range(5):
        texts[100 + i] = texts[7 * i] + " end of one"
        texts[200 + i] = texts[7 * i] + " end of another"
    rows = nearjoin.op6_query(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == brute_classes(texts)[0]


@pytest.mark.parametrize("block", [nearjoin.BLOCK, 4])
def test_every_link_is_counted(spark, monkeypatch, block):
    """n_links is the number of other documents at the threshold, copies each counted."""
    monkeypatch.setattr(nearjoin, "BLOCK", block)
    base = prose(31, 100)
    texts = {i: f"{base} end{i}" for i in range(30)} | {40 + i: base + " end3" for i in range(5)} | family_copies()
    near = brute_classes(texts)[1]
    rows = nearjoin.op6_query(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == {k: len(near[k]) for k in texts}


def family_copies():
    return {1000 + k: t for k, t in family_texts().items()}


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    """Hosts whose only mass is distrust, up to 30 links away, are blocked."""
    rows = [(i, f"http://h{i}.net/p", f'<a href="http://h{i + 1}.net/">') for i in range(29)]
    rows += [(29, "http://h29.net/p", '<a href="http://bad.com/">'), (30, "http://bad.com/de/", None), (31, "http://far.net/", None)]
    out = urlgraph.op4_query(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["verdict"] for r in out} == {i: "block" for i in range(31)} | {31: "allow"}


def test_page_columns_of_any_name(spark):
    names = ["page_id", "url", "html", "host_verdict", "fit", "c0", "sender", "trust"]
    rows = [(1, "http://a.org/x", None, "p", "q", "r", "s", "t"), (2, "http://x.net/", '<a href="http://a.org/">', "u", "v", "w", "x", "y")]
    out = {r["page_id"]: r for r in urlgraph.judge(spark.createDataFrame(rows, ", ".join(f"{n} string" if i else f"{n} long" for i, n in enumerate(names)))).collect()}
    assert (out[1]["verdict"], out[1]["host_verdict"], out[2]["fit"], out[2]["c0"], out[2]["sender"]) == ("allow", "p", "v", "w", "x")
    assert isinstance(out[1]["trust"], float)


def test_passage_of_sentences_frequent_elsewhere(spark):
    """Two sentences of 30 words, each in 40 other texts, put together in two documents: 60 equal words in a row."""
    one, two = prose(501, 30), prose(502, 30)
    docs = [(i, f"{prose(600 + i, 60)} {one if i % 2 else two} {prose(800 + i, 40)}") for i in range(80)]
    docs += [(900, f"{prose(990, 50)} {one} {two} {prose(991, 50)}"), (901, f"{prose(992, 30)} {one} {two} {prose(993, 70)}")]
    rows = passages.op8_query(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {frozenset((r["doc_id"], r["other_id"])) for r in rows} == {frozenset((900, 901))}
    assert all(58 <= r["length"] <= 64 for r in rows)


def test_repeated_rows_with_one_id_are_copies(spark):
    a = prose(71, 80)
    rows = passages.op8_query(spark.createDataFrame([(5, a), (5, a), (7, a), (8, prose(72, 80))], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["other_id"], r["length"]) for r in rows) == [(5, 5, 80), (7, 5, 80)]


def edited(words, equality, mixed, r):
    """A copy in which about ``1 - equality`` of the words are substituted (or also deleted and inserted)."""
    out = []
    for i, w in enumerate(words):
        if r.random() < 1 - equality:
            kind = r.choice("sid") if mixed else "s"
            out += {"s": [f"x{r.random()}"], "i": [f"y{r.random()}", w], "d": []}[kind]
        else:
            out.append(w)
    return out


def recall(words, equality, mixed, pairs=60, seed=1):
    """Share of planted pairs of which at least half of the passage is found, by the functions that the tasks run."""
    from histmart.llm.shingles import WordHasher
    hasher, found = WordHasher(), 0
    r = random.Random(seed)
    for i in range(pairs):
        body = prose(10_000 + 7 * i + seed, words).split()
        texts, at = [], []
        for k, part in enumerate((body, edited(body, equality, mixed, r))):
            before = prose(50_000 + 2 * i + k, r.randint(20, 80)).split()
            at.append(len(before))
            texts.append(before + part + prose(90_000 + 2 * i + k, 60).split())
        seeds = [passages.seeds_of(hasher(" ".join(t))) for t in texts]
        first = {}
        for s, p in zip(*map(np.ndarray.tolist, seeds[0])):
            first.setdefault(s, p)
        points = set()
        for s, p in zip(*map(np.ndarray.tolist, seeds[1])):
            if s in first:
                q = first[s]
                points |= {(p >> 8, q >> 8), ((p >> 8) + (p & 255), (q >> 8) + (q & 255))}
        covered = 0
        for c in passages.chains(passages.segments(sorted(points))) if len(points) > 1 else []:
            if c[-1][0] + c[-1][2] - c[0][0] >= passages.LEAST:
                for start, length, *_ in passages.align(texts[1], texts[0], c):
                    covered = max(covered, min(start + length, at[1] + words) - max(start, at[1]))
        found += covered * 2 >= words
    return found / pairs


@pytest.mark.parametrize("words, equality, mixed, least", [
    (60, 1.0, False, 1.0), (60, 0.95, False, 0.9), (100, 0.95, True, 0.9), (100, 0.9, False, 0.9), (100, 0.9, True, 0.85), (300, 0.9, True, 0.9)])
def test_recall_of_fuzzy_passages(words, equality, mixed, least):
    assert recall(words, equality, mixed) >= least


@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
@settings(max_examples=200, deadline=None)
def test_extension_has_the_best_score(a, b):
    def lcs(x, y):
        t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, u in enumerate(x):
            for j, v in enumerate(y):
                t[i + 1][j + 1] = t[i][j] + 1 if u == v else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]
    best = max((3 * lcs(a[:i], b[:j]) - i - j for i in range(len(a) + 1) for j in range(len(b) + 1) if abs(i - j) <= passages.SLACK), default=0)
    i, j, n = passages._extend(a, b)
    assert n == lcs(a[:i], b[:j]) and 3 * n - i - j == max(best, 0)


@pytest.mark.parametrize("hot", [passages.HOT, 1])
def test_texts_that_share_more_with_one_another_than_with_the_pivot(spark, monkeypatch, hot):
    """Two texts share five stretches of 14 words, each of which stands in other texts of its own, with three odd words
    between any two: no text but these two has 50 of the words."""
    monkeypatch.setattr(passages, "HOT", hot)  # 1: counted block by block
    parts = [prose(1500 + i, 14) for i in range(5)]
    docs = [(100 * i + n, f"{prose(2000 + 100 * i + n, 40)} {p} {prose(3000 + 100 * i + n, 40)}") for i, p in enumerate(parts) for n in range(20)]
    docs += [(9000 + k, " ".join([prose(4000 + k, 50)] + [f"{p} {prose(5000 + 10 * k + i, 3)}" for i, p in enumerate(parts)] + [prose(6000 + k, 50)]))
             for k in range(2)]
    rows = passages.op8_query(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {frozenset((r["doc_id"], r["other_id"])) for r in rows} == {frozenset((9000, 9001))}
    assert max(r["length"] for r in rows) >= 70


def test_links_of_a_large_group_grow_with_its_texts_not_their_pairs(spark):
    """A hundred texts share five stretches of 14 words in a row; each stretch stands in more texts of its own, of which one
    is the pivot: all of the hundred are linked, by a few rows each instead of one for every two of them."""
    parts = [prose(1500 + i, 14) for i in range(5)]
    docs = [(1000 * i + n, f"{prose(20_000 + 1000 * i + n, 30)} {p} {prose(30_000 + 1000 * i + n, 30)}") for i, p in enumerate(parts) for n in range(300)]
    texts = range(9000, 9100)
    docs += [(k, f"{prose(40_000 + k, 40)} {' '.join(parts)} {prose(60_000 + k, 40)}") for k in texts]
    rows = passages.op8_query(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {x for r in rows for x in (r["doc_id"], r["other_id"])} == set(texts)
    group = {k: k for k in texts}
    for r in rows:
        low, high = sorted((group[r["doc_id"]], group[r["other_id"]]))
        group = {k: low if g == high else g for k, g in group.items()}
    assert len(set(group.values())) == 1
    assert len(rows) <= 10 * len(texts)


@pytest.mark.parametrize("hot", [passages.HOT, 1])
def test_texts_that_share_a_passage_beside_the_ones_with_the_pivot(spark, monkeypatch, hot):
    """Two texts have passages of their own with the texts that hold all their seeds, and between these one with one another: two
    stretches of 28 words with eight odd words between them, which those texts hold in the other order, far apart."""
    monkeypatch.setattr(passages, "HOT", hot)
    parts, mine = [prose(1500 + i, 28) for i in range(2)], [[prose(1600 + 10 * k + i, 60) for i in range(2)] for k in range(2)]
    docs = [(n, " ".join([prose(2000 + n, 30), *mine[0], *mine[1], prose(3000 + n, 30), parts[1], prose(3500 + n, 30), parts[0]])) for n in range(30)]
    docs += [(9000 + k, " ".join([prose(4000 + k, 80), mine[k][0], parts[0], prose(5000 + k, 8), parts[1], mine[k][1], prose(6000 + k, 80)]))
             for k in range(2)]
    rows = passages.op8_query(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    mutual = [r["length"] for r in rows if {r["doc_id"], r["other_id"]} == {9000, 9001}]
    assert mutual and max(mutual) >= 60
    assert {r["doc_id"] for r in rows if r["other_id"] < 30} >= {9000, 9001}


def test_a_link_covers_both_seeds():
    from histmart.llm.shingles import WordHasher
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    left, right = a[:30] + b + a[30:], a[:30] + ["odd"] * 40 + a[30:]
    runs = [passages.first_runs(WordHasher()(" ".join(x))) for x in (left, right)]
    words = [[w.encode() for w in x] for x in (left, right)]
    assert not passages.linked(*words, *runs, (0, 95), (0, 75))
    same = [passages.first_runs(WordHasher()(" ".join(a)))] * 2
    assert passages.linked([w.encode() for w in a], [w.encode() for w in a], *same, (3, 50), (3, 50))


def test_pairs_that_join_no_two_classes_are_not_compared():
    looked = []

    def link(i, j):
        looked.append((i, j))
        return (i, j) != (1, 4)

    held = np.array([True, True, False, False, False])
    pairs = [(0, 2), (1, 2), (0, 1), (1, 4), (2, 4), (3, 4), (0, 3)]
    assert [x[:2] for x in passages.forest(held, pairs, link)] == [(0, 2), (2, 4), (3, 4)]
    assert looked == [(0, 2), (1, 4), (2, 4), (3, 4)]


@given(st.integers(0, 10 ** 6), st.integers(50, 90))
@settings(max_examples=100, deadline=None)
def test_texts_with_a_passage_share_the_fewest_pairs_of_words(seed, n):
    """A passage of which four in five words match, the others missing on either side at separate places."""
    r = random.Random(seed)
    same = n - n // 5
    spare = sorted(r.sample(range(1, same), 2 * (n - same)) if 2 * (n - same) < same else [])
    a, b = list(range(same)), list(range(same))
    for k, i in enumerate(reversed(spare)):
        (a if k % 2 else b).insert(i, 1000 + k)
    sets = [passages.word_pairs(np.array(x, dtype=np.uint64)) for x in (a, b)]
    fewest = passages.fewest_pairs(np.array([n, n]))
    assert [x.tolist() for x in passages.near_sets(sets, np.array([0]), np.array([1]), fewest)] == [[0], [1]]


def test_bands_alone_in_their_bucket_do_not_go_to_the_pivots(spark, monkeypatch):
    staged, stage = {}, nearjoin.stage

    def recorded(df, name, keep=False):
        out = stage(df, name, keep)
        if name in ("near-bands", "near-shared"):
            staged[name] = out.count()
        return out

    monkeypatch.setattr(nearjoin, "stage", recorded)
    a = prose(7000, 200)
    docs = [(i, prose(7001 + i, 60)) for i in range(40)] + [(50, a), (51, a + " more")]
    rows = nearjoin.op6_query(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows if r["n_links"]} == {50: 50, 51: 50}
    assert staged["near-bands"] == 42 * nearjoin.BANDS and 2 <= staged["near-shared"] <= 2 * nearjoin.BANDS
