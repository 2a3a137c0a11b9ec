import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from contrail.llm import ann, decontamination, langid, queries, sharding, url_filter
from tests.compare import connect, same


@pytest.mark.parametrize("name", ["op2_url_filter", "op6_decontamination"])
def test_like_sql(spark, sf_dir, name):
    same(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name])


def test_urls(spark):
    rows = {
        None: ("", "", None), "": ("", "", None), "example.org/es/": ("", "", None), "a://": ("", "", None),
        "http://Shop.EXAMPLE.org/es/x?y#z": ("shop.example.org", "/es/x", "example.org/es/"), "http://example.org/en/123": ("example.org", "/en/123", "example.org/en/1"),
        "http://example.org/en/223": ("example.org", "/en/223", "org/"), "http://org/": ("org", "/", "org/"), "http://borg/": ("borg", "/", None), "http://x.org?q": ("x.org", "", None),
        "http://x.com/de/#f": ("x.com", "/de/", "com/de/"), "http://x.com/fr/://y.org/": ("x.com", "/fr/://y.org/", "com/fr/"), "http://É.org/": ("É.org", "/", "org/"), "x\ny://h.org/a\nb?": ("h.org", "/a\nb", "org/"),
    }
    pages = spark.createDataFrame([(k, u, "clash", "clash") for k, u in enumerate(rows)], "page_id long, url string, host string, rule string")
    weights = url_filter.fit(spark, url_filter.labelled_urls())
    got = {r.page_id: r for r in url_filter.judge(pages, weights, queries.RULES_ALLOW, queries.RULES_BLOCK).collect()}
    for k, want in enumerate(rows.values()):
        assert (got[k].host, got[k].path, got[k].rule) == want
        assert got[k].verdict == ("block" if want[2] in queries.RULES_BLOCK else "allow" if want[2] else "block" if got[k].log_odds >= 0 else "allow")
    assert url_filter.judge(pages.limit(0), weights, ["org/"], []).count() == 0
    assert url_filter.fit(spark, url_filter.labelled_urls()) == url_filter.plain_weights(url_filter.labelled_urls())


def test_held_out_names():
    """Of names that were not learned nearly all wanted ones pass, and most unwanted ones don't."""
    names = url_filter.labelled_names()
    names = [names[k] for k in np.random.default_rng(1).permutation(len(names))]
    right, n = Counter(), Counter()
    for fold in range(5):
        weights = url_filter.plain_weights(url_filter.placed([x for k, x in enumerate(names) if k % 5 != fold]))
        for name, label in names[fold::5]:
            f = url_filter.plain_features(f"https://www.{name}.example.net/en/120.html")
            right[label] += (weights[url_filter.DIMS] + sum(weights[i] for i in f) / math.sqrt(len(f)) >= 0) == bool(label)
            n[label] += 1
    assert right[0] >= 0.95 * n[0] and right[1] >= 0.55 * n[1]


def test_many_rules(spark):
    """As by trying every rule on every url."""
    rng = np.random.default_rng(6)
    names = ["org", "a.org", "b.a.org", "net", "x.net", "xa.org"]
    rules = {f"{rng.choice(names)}/{''.join(rng.choice(list('ab/'), rng.integers(0, 4)))}" for _ in range(60)} | {f"host{k}.org/" for k in range(3_000)}
    rows = [(f"{rng.choice(['', 'w.', 'b.'])}{rng.choice([*names, 'host7.org'])}", "/" * int(rng.integers(0, 2)) + "".join(rng.choice(list("ab/"), rng.integers(0, 6)))) for _ in range(200)] + [("", "")]
    df = spark.createDataFrame(rows, "h string, p string").select("h", "p", url_filter.matching_rule(F.col("h"), F.col("p"), rules).alias("r"))
    for h, p, r in df.collect():
        fits = [x for x in rules if (h == x.partition("/")[0] or h.endswith("." + x.partition("/")[0])) and p.startswith("/" + x.partition("/")[2])]
        assert r == min(fits, key=lambda x: (-len(x), x), default=None)


def test_long_and_repeated_urls(spark):
    weights = url_filter.fit(spark, url_filter.labelled_urls())
    long = "https://grand-casino.example.net/" + "slots-jackpot/" * 5_000
    got = url_filter.judge(spark.createDataFrame([(1, long), (1, long), (2, "http://" + "a." * 3_000 + "org/")], "page_id long, url string"), weights, ["org/"], []).collect()
    assert [(r.page_id, r.verdict, r.rule) for r in sorted(got)] == [(1, "block", None)] * 2 + [(2, "allow", "org/")]


def test_unseen_urls(spark):
    names = {"mega-casino-bonus": "block", "pills-discount": "block", "free-poker-bets": "block", "university": "allow", "painting": "allow", "mountain-club": "allow"}
    pages = spark.createDataFrame([(k, f"https://{n}.example.net/it/99") for k, n in enumerate(names)], "page_id long, url string")
    got = url_filter.judge(pages, url_filter.fit(spark, url_filter.labelled_urls()), [], []).orderBy("page_id").collect()
    assert [r.verdict for r in got] == list(names.values())


def test_op4(spark, sf_dir):
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op4_hash_tree(spark, sf_dir).collect()
    slots = defaultdict(list)
    for r in rows:
        text = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 8, zlib.crc32(text), "key") and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert len(rows) == len(docs) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def drawn(key, node):
    """The shard of a key, by XXH64 of the key's eight bytes and then of the child's name, each seeded with the hash before."""
    while node.children:
        def cost(child):
            seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            u = ((xxhash.xxh64_intdigest(child.name.encode(), seed) >> 12) + 0.5) / 2**52
            return -math.log(u) / child.weight

        node = min(node.children, key=cost)
    return node.shard


def test_shards_by_hand(spark):
    ids = [None, 0, 1, -5, 2**62, *range(1000, 3000, 7)]
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
    for n in (1, 5, 24, 26):
        got = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.assign(docs, n).collect()}
        assert got == {i: (drawn(i, sharding.topology(n)), drawn(i, sharding.topology(n + 1))) for i in ids}


def test_sharding_odd_rows(odd_docs, odd_rows, no_docs):
    rows = sharding.assign(odd_docs, 24, spread=4).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r[0], len((r[1] or "").encode()) + 8) for r in odd_rows)
    assert all(len({r.shard for r in rows if r.doc_id == d}) == 1 for d in {r.doc_id for r in rows})
    assert sharding.assign(no_docs).count() == 0


def test_growth_moves_rows_only_into_the_new_shard(spark):
    key = F.col("id")
    at = spark.range(40_000).select(*[sharding.descend(key, sharding.topology(n)).alias(f"s{n}") for n in (24, 25, 26)]).collect()
    assert all(r.s25 in (r.s24, 24) and r.s26 in (r.s25, 25) for r in at)
    for n in (24, 25, 26):
        c = Counter(r[f"s{n}"] for r in at)
        assert len(c) == n and max(c.values()) < 1.2 * 40_000 / n and min(c.values()) > 0.8 * 40_000 / n


def test_changed_weights_stay_in_their_subtree(spark):
    def tree(w):
        leaves = lambda a, x: tuple(sharding.Node(f"s{a + k}", x if k == 0 else 1.0, a + k) for k in range(2))
        return sharding.Node("r", 1.0, children=(sharding.Node("a", 2.0, children=leaves(0, w)), sharding.Node("b", 2.0, children=leaves(2, 1.0))))

    at = spark.range(5_000).select(sharding.descend(F.col("id"), tree(1.0)).alias("x"), sharding.descend(F.col("id"), tree(3.0)).alias("y")).collect()
    assert any(r.x != r.y for r in at) and all(r.x == r.y or (r.x, r.y) == (1, 0) for r in at)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item"), (10, "Short ITEM"), (3, ""), (4, None), (None, "nameless words"), (5, "a a a a a a a a a a a a a a")]


def brute(text, window=13):
    docs = decontamination.words(text)
    hit, ids = set(), set()
    for i, t in ITEMS:
        w = decontamination.words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for p in range(len(docs) - n + 1):
                if docs[p : p + n] == w[k : k + n]:
                    hit |= set(range(p, p + n))
                    ids |= {str(i)} - {"None"}
    return len(docs), len(hit), sorted(ids)


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_decontamination(spark, most):
    texts = [None, "", "...", "say SHORT, item! and nameless words", "x " + ITEMS[0][1].upper().replace(" ", "--") + " y", "a " * 40, "one two three four five six seven eight nine ten eleven twelve", "é short item é", "shortitem short items", "short item"]
    docs = spark.createDataFrame([(k, t, "clash", "clash") for k, t in enumerate(texts)], "doc_id long, text string, n_words string, spans string")
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, n_hit string")
    got = {r.doc_id: r for r in decontamination.scan(docs, items, most_bytes=most).collect()}
    for k, t in enumerate(texts):
        assert (got[k].n_words, got[k].n_hit, got[k].item_ids) == brute(t)
    assert [texts[3][s.start : s.end] for s in got[3].spans] == ["SHORT, item", "nameless words"]
    assert decontamination.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0 and decontamination.scan(docs.limit(0), items).count() == 0


def test_op8(spark, sf_dir):
    docs = {r[0]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()}
    rows = queries.op8_language_id(spark, sf_dir).collect()
    assert len(rows) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and docs[r.doc_id].text and any(map(str.isalpha, docs[r.doc_id].text))]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_language_odd_rows(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    model = langid.train(odd_docs)
    got = langid.identify(odd_docs, model)
    assert set(got.columns) == set(odd_docs.columns) and got.count() == len(odd_rows)
    none = got.where("text is null or trim(text) = '' or text = ' \n\t'").collect()
    assert none and all(r.lang_pred == "und" and r.score == 0 for r in none)
    assert langid.identify(no_docs, model).count() == 0
    empty = langid.train(no_docs)
    assert {r.lang_pred for r in langid.identify(odd_docs, empty).collect()} == {"und"}
    texts = [t for _, t, *_ in odd_rows]
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "BLOCK", 1000)  # long texts in many blocks
    cut = model.predict(texts)
    assert whole[0] == cut[0] and np.allclose(whole[1], cut[1], atol=1e-3)


def counted(text):
    """{bucket: n} of a text's n-grams, each hashed by itself."""
    padded = [32, 32, *[ord(c.lower()) if c.isalpha() else 32 for c in text], 32, 32]
    out = Counter()
    for n in langid.SIZES:
        for p in range(len(padded) - n + 1):
            g = padded[p : p + n]
            if (n == 1 and g[0] == 32) or any(g[k] == 32 == g[k + 1] for k in range(n - 1)):
                continue
            h = 0
            for c, f in zip(g, langid.FACTORS):
                h = (h + c * f) & 0xFFFFFFFF
            out[(((h ^ h >> 15) * (langid.SIZE_FACTOR + 2 * n)) & 0xFFFFFFFF) >> 17] += 1
    return out


def test_training_by_hand(spark):
    """Counts, smoothing and priors; rows without language or text, repeated rows and texts without letters."""
    rows = [("en", "The cat"), ("en", "the cat"), ("en", "the cat"), ("de", "Die Katze, ja!"), ("fr", "..."), (None, "nothing"), ("en", None), ("de", "")]
    model = langid.train(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    assert model.languages == ["de", "en", "fr"]
    known = [(x, t) for x, t in rows if x and t is not None]
    for k, lang in enumerate(model.languages):
        total = sum((counted(t) for x, t in known if x == lang), Counter())
        whole = sum(total.values()) + 0.5 * langid.DIMS
        want = np.log([(total[b] + 0.5) / whole for b in range(langid.DIMS)])
        assert np.allclose(model.matrix[k, : langid.DIMS], want, atol=1e-5) and model.matrix[k, langid.DIMS] == 0
        assert math.isclose(model.priors[k], math.log(sum(x == lang for x, _ in known) / len(known)))


def test_naive_bayes_by_hand():
    """Scores of a text are sums over its n-grams, each looked up by itself."""
    model = langid.Model(["a", "b"], np.vstack([np.append(np.random.default_rng(k).normal(size=langid.DIMS), 0) for k in (0, 1)]).astype(np.float32), np.zeros(2))
    text = "Ab, c"
    padded = np.array([32, 32, *[ord(c.lower()) if c.isalpha() else 32 for c in text], 32, 32], dtype=np.uint32)
    want = np.zeros(2)
    for n in langid.SIZES:
        for p in range(len(padded) - n + 1):
            g = padded[p : p + n]
            if (n == 1 and g[0] == 32) or any(g[k] == 32 == g[k + 1] for k in range(n - 1)):
                continue
            h = 0
            for c, f in zip(g.tolist(), langid.FACTORS):
                h = (h + c * f) & 0xFFFFFFFF
            h = ((h ^ h >> 15) * (langid.SIZE_FACTOR + 2 * n)) & 0xFFFFFFFF
            want += model.matrix[:, h >> 17]
    lang, score = model.predict([text])
    assert lang == ["ab"[int(want.argmax())]] and math.isclose(score[0], 1 / (1 + math.exp(-abs(want[0] - want[1]))), rel_tol=1e-4)


def exact(rows, k=5):
    """{query id: [(id, score)]} by brute force; rows: (id, vector)."""
    fine = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all() and any(v)]
    out = {}
    for q, x in fine:
        if q % 50 == 0:
            near = [(float((v * x).sum() / np.sqrt((v * v).sum() * (x * x).sum())), i) for i, v in fine if i != q and len(v) == len(x)]
            out[q] = sorted(near, key=lambda p: (-p[0], p[1]))[:k]
    return out


def test_op10(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, got = exact(rows), defaultdict(list)
    for r in queries.op10_collision_counting(spark, sf_dir).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(s >= want[q][-1][0] - 1e-12 for q, v in got.items() for s, _ in v)
    assert hits >= 0.9 * 5 * len(want)
    known = {q: dict((i, s) for s, i in exact(rows, 10**6)[q]) for q in list(want)[:3]}
    assert all(math.isclose(s, known[q][i], abs_tol=1e-12) for q in known for s, i in got[q])


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_few_vectors_are_verified(n):
    """Less than a tenth of a block for each query, with 0.9 of the true neighbours and more, on vectors without any clusters and with some."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(n, 64))
    vectors[: n // 10] = vectors[0] + rng.normal(size=(n // 10, 64)) * 0.4
    asked = np.arange(0, n, n // 50)
    hits = verified = 0
    for a in range(0, n, ann.BLOCK):
        block = ann.Block(np.arange(a, min(a + ann.BLOCK, n)), vectors[a : a + ann.BLOCK], 128, 11)
        units = block.units
        for q, near, _ in block.search(ann.Vectors(asked, vectors[asked]), 5):
            cos = units @ (vectors[q] / np.linalg.norm(vectors[q]))
            cos[block.ids == q] = -2
            hits += len(set(near) & set(block.ids[np.argsort(-cos)[:5]]))
        verified += block.verified
    blocks = -(-n // ann.BLOCK)
    assert hits >= 0.9 * 5 * len(asked) * blocks and verified < 0.1 * n * len(asked)


def test_blocks_and_slices_meet(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERIES", 3)
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(600)] + [(7, rng.normal(size=8).tolist()), *[(8, [1.0] * 8)] * 50]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, block=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = {}
    for q, near in exact(rows, 10**6).items():
        best = {}
        for s, i in near:
            best.setdefault(i, s)
        want[q] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:5]
    assert set(got) == set(want)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_search_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=4).tolist()) for k in range(1, 40)] + [(50, [1.0, 2.0, 3.0, 4.0]), (100, [1.0, 2.0, 3.0, 4.0]), (61, [2.0, 4.0, 6.0, 8.0]), (62, [1.0, 2.0, 3.0, 4.0])]
    rows += [(63, None), (64, []), (65, [0.0] * 4), (66, [1.0, None, 1.0, 1.0]), (67, [1.0, float("nan"), 1.0, 1.0]), (68, [float("inf")] * 4), (69, [1.0, 1.0]), (150, [1.0, 0.0]), (200, [0.0] * 4), (None, [1.0] * 4), (70, [1e200] * 4)]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "vec_id long, embedding array<double>, score string, rank string").repartition(3)
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == {50, 100, 150} and got[150] == [69]
    assert got[50][:3] == [61, 62, 100] and got[100][:3] == [50, 61, 62] and len(got[50]) == 5
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
