import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import graph, line_dedup, queries, simhash, suffix_array, suffix_dedup
from tests.compare import connect, same


@pytest.mark.parametrize("short", [0, 1 << 17])
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120))
@settings(max_examples=200, deadline=None)
def test_suffix_array(short, values):
    suffix_array.SHORT, before = short, suffix_array.SHORT
    try:
        text = np.array([*values, 0], dtype=np.uint16)
        order = suffix_array.suffix_array(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        prefixes = suffix_array.permuted_prefixes(text, order, 9)
        for a, b in zip(order.tolist(), order[1:].tolist()):
            assert prefixes[b] == next((k for k in range(9) if text[a + k] != text[b + k]), 9)
    finally:
        suffix_array.SHORT = before


@pytest.mark.parametrize("names", [300, 70_000])
def test_suffix_array_of_many_letters(names):
    """Buckets of one and of many, over several levels."""
    rng = np.random.default_rng(names)
    text = np.append(np.tile(rng.integers(1, names, 3_000), 5), 0).astype(np.int32)
    order = suffix_array.suffix_array(text)
    follow = np.empty(len(text), dtype=np.int64)
    follow[order] = np.arange(len(text))
    pairs = list(zip(text[order[1:]].tolist(), follow[(order[1:] + 1) % len(text)].tolist()))
    assert pairs == sorted(pairs) and sorted(order.tolist()) == list(range(len(text))) and order[0] == len(text) - 1


def removed(rows, length=50):
    """What must go, by brute force."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        if doc_id is not None:
            for k in range(len(data) - length + 1):
                w = data[k : k + length]
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if doc_id is not None and first[data[k : k + length]] < doc_id:
                mask[k : k + length] = b"\1" * length
        runs = sum(mask[k] and not (k and mask[k - 1]) for k in range(len(mask)))
        out.append((doc_id, len(data), sum(mask), runs, hashlib.sha256(bytes(x for x, m in zip(data, mask) if not m)).hexdigest()))
    return Counter(out)


def test_op3(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, queries.op3_suffix_dedup(spark, sf_dir).collect())) == removed([tuple(r) for r in docs])


@pytest.mark.parametrize("hot,block,shard", [(1_000, 1 << 20, 1 << 20), (2, 300, 200), (1_000, 100, 1 << 20)])
def test_suffix_dedup_odd_rows(odd_docs, odd_rows, no_docs, monkeypatch, hot, block, shard):
    for name, value in (("HOT", hot), ("BLOCK", block), ("SHARD", shard)):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = suffix_dedup.remove_repeats(odd_docs).collect()
    rows = Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got)
    assert rows == removed([(r[0], r[1]) for r in odd_rows])
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("hot", [1_000, 1])
def test_one_id_with_null_empty_and_repeated_text(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(8)
    text = "".join(rng.choices("abcdef ", k=300))
    docs = [(1, text), (2, text + " tail"), (2, None), (2, ""), (2, text), (2, text), (None, text), (None, None), (3, "x" + text[40:200] + "y" + text[100:]), (4, text[:120] + "z" + text[60:])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == removed(docs)


def around(phrases, n, seed):
    """n documents, each phrase in its own surroundings in every one."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60))
    return [(k, word() + "".join(p + word() for p in phrases)) for k in range(n)]


def kinds(spark, docs, column):
    anchors = suffix_dedup.shared_anchors(spark.createDataFrame(docs, "doc_id long, text string"), 50)
    return sum(len(r[0]) for r in anchors.select(column).collect())


def test_kinds_that_fit_a_shard_are_sorted(spark):
    """1,500 surroundings of one phrase: no string goes by itself, as all fit one suffix array."""
    docs = around(["The whole of one phrase that stands in every text."[:45]], 1_500, 3)
    docs += [(2_000 + k, t[20:140]) for k, t in docs[:20]]
    assert kinds(spark, docs, "hot") == 0 < kinds(spark, docs, "open")
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == removed(docs)


def test_short_phrases_open_nothing(spark):
    """Sixteen bytes in common, which chance gives texts, are no reason to sort what stands around them."""
    phrases = [f"phrase no. {k:05}" for k in range(40)]
    assert kinds(spark, around(phrases, 8, 4), "open") == 0


def test_one_letter_many_times(spark):
    docs = [(k, "a" * (40 + 10 * k) + ("b" if k % 2 else "")) for k in range(8)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == removed(docs)


def fingerprint(text):
    words = bytes((text or "").encode().translate(simhash.LOWER)).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(rows):
    """(doc_id, fingerprint, component) by comparing all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                label[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    return Counter((d, f"{fps[i]:016x}", min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def test_op5(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.op5_golay_simhash(spark, sf_dir).collect())) == linked(docs)


def test_simhash_odd_rows(odd_docs, odd_rows, no_docs):
    assert Counter(map(tuple, simhash.near_duplicates(odd_docs).collect())) == linked([(r[0], r[1]) for r in odd_rows])
    assert simhash.near_duplicates(no_docs).count() == 0


def test_links_within_a_cloud(spark):
    """Many fingerprints around a few centres: components as by all pairs."""
    rng = random.Random(3)
    fps = {0, 1 << 63}
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(60):
            f = c
            for b in rng.sample(range(64), rng.randrange(7)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for i, f in enumerate(fps):
        for g in fps[:i]:
            if (f ^ g).bit_count() <= 3:
                label[root(f)] = root(g)
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(sign(f),) for f in fps], "fp long")
    got = {r.fp: r.label for r in simhash.labelled(df).collect()}
    groups = lambda m: sorted(sorted(x for x in m if m[x] == v) for v in set(m.values()))
    assert groups(got) == groups({sign(f): sign(root(f)) for f in fps})


def test_keep_one(odd_docs, odd_rows, no_docs):
    kept = simhash.keep_one(odd_docs)
    groups = {c for _, _, c in linked([(r[0], r[1]) for r in odd_rows])}
    got = kept.select("doc_id", "text").collect()
    assert kept.columns == odd_docs.columns and {r.doc_id for r in got} == groups and len(got) == len({fingerprint(r.text) for r in got})
    assert simhash.keep_one(no_docs).count() == 0


@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
@settings(max_examples=4, deadline=None)
def test_components(spark, edges):
    label = {}

    def root(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    got = {r.node: r.label for r in graph.components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}


def test_op9(spark, sf_dir):
    same(queries.op9_line_dedup(spark, sf_dir), connect(sf_dir), line_dedup.oracle(queries.SITES))


def test_line_dedup_odd_rows(odd_docs, odd_rows, no_docs):
    sites = 4
    spread, first = defaultdict(set), {}
    key = lambda d, t, p: (d is not None, d or 0, xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63, p)
    for d, t, _, s, _ in odd_rows:
        for p, line in enumerate(t.split("\n") if t is not None else []):
            if x := line.strip(" "):
                spread[x] |= {s} - {None}
                first[x] = min(first.get(x, key(d, t, p)), key(d, t, p))
    want = Counter()
    for d, t, *_ in odd_rows:
        parts = t.split("\n") if t is not None else []
        keep = [x for p, x in enumerate(parts) if not x.strip(" ") or len(spread[x.strip(" ")]) < sites or first[x.strip(" ")] == key(d, t, p)]
        want[d, None if t is None else "\n".join(keep), len(parts), len(parts) - len(keep)] += 1
    got = line_dedup.remove_boilerplate(odd_docs, sites)
    assert set(odd_docs.columns) == set(got.columns)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == want
    assert line_dedup.remove_boilerplate(no_docs, sites).count() == 0


def test_lines_far_over_the_threshold_and_near_it(spark):
    rows = [(k, f"everywhere\nown line {k}\n{'near' if k < 10 else 'rest'}\n{'under' if k < 9 else 'x' + str(k)}", f"s{k}") for k in range(3_000)]
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), 10)
    texts = {r.doc_id: r.text.split("\n") for r in got.where("doc_id < 40").collect()}
    assert "everywhere" in texts[0] and "near" in texts[0] and "under" in texts[0]
    assert texts[5] == ["own line 5", "under"] and texts[20] == ["own line 20", "x20"] and "rest" in texts[10]
