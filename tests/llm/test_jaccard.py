import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from contrail.llm import common, decontamination, graph, jaccard, tokens
from tests.llm.conftest import prose


def least_of_groups(rows):
    """The least id of each component, by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        words = bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode()).split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 9 * len(a & b) >= 4 * (len(a) + len(b)):
                label[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return {min((d for d in g if d is not None), default=None) for g in groups.values()}


def changed(rng, text, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = f"other{rng.randrange(1000)}"
    return " ".join(words)


@pytest.fixture
def near_copies():
    """Copies on both sides of the threshold, in chains too, and a passage that many other texts share."""
    rng = random.Random(9)
    passage, rows = prose(rng, 60), []
    for size in (5, 12, 40, 100, 250, 600):
        base = prose(rng, size)
        rows += [base, *[changed(rng, base, rng.randint(0, max(1, size // 30))) for _ in range(8)]]
        rows += [base + " " + prose(rng, max(1, size // k)) for k in (3, 4, 5, 8)]
    base = prose(rng, 120)  # many around a threshold to one text, few of them alike
    rows += [base, *[changed(rng, base, 4 + k % 4) for k in range(60)]]
    rows += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(40)] + ["x", "X", "", " \n", None, "one two", "One  two three"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("picked,block", [((1, 4), 1 << 19), ((1,), 300), ((), 1 << 19)])
def test_stage_finds_every_near_copy(spark, near_copies, monkeypatch, picked, block):
    monkeypatch.setattr(jaccard, "PICKED", picked)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(3)
    got = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got) == sorted(least_of_groups(near_copies))


def test_rolled_shingles_are_those_of_the_words(near_copies):
    texts = [t or "" for _, t in near_copies]
    hashes, bounds = jaccard.rolled(pa.array(texts), 5)
    of = {}
    for text, found in zip(texts, np.split(hashes, bounds[1:-1])):
        words = text.lower().split()
        want = [" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []
        assert len(want) == len(found) and all(of.setdefault(w, h) == h for w, h in zip(want, found.tolist()))
    assert len(set(of.values())) == len(of)


def test_band_keys_reach_four_fifths():
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(200):
        common = rng.integers(1 << 63, size=80, dtype=np.uint64)
        a, b = (np.concatenate((common, rng.integers(1 << 63, size=10, dtype=np.uint64))) for _ in range(2))
        keys = jaccard.band_keys(np.concatenate((a, b)), np.array([0, 90, 180]))
        found += (keys[0] == keys[1]).any()
    assert found == 200


def test_keep_one_odd_rows(odd_docs, odd_rows, no_docs):
    got = jaccard.keep_one(odd_docs)
    assert got.columns == odd_docs.columns and {r.doc_id for r in got.collect()} == least_of_groups([(r[0], r[1]) for r in odd_rows])
    assert jaccard.keep_one(no_docs).count() == 0


def test_rounds_are_one_statement_each(spark, monkeypatch):
    """a round was two statements, and the first had what stands below the edges several times in its plan."""
    plans, write = {}, graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and write(df, name))
    ran = spark._jsparkSession.sharedState().statusStore().executionsCount
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = ran()
    left = spark.range(0, 8, 2).selectExpr("id as a", "id as k")
    found = graph.components(left.join(spark.range(8).selectExpr("id - 1 as k", "id as b"), "k"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert ran() - before == 3  # the edges, a round, and one that changes nothing
    assert "Range" in plans["edges"] and "Range" not in plans["stars"]
    assert sorted(map(tuple, found.collect())) == [(k, k - k % 2) for k in range(8)]


def test_written_tables_ease_the_driver(spark, monkeypatch):
    """what compilers had freed stayed with the driver's process."""
    said = common.eased(spark)
    assert said is None or "Trim native heap" in said
    eased = []
    monkeypatch.setattr(common, "eased", eased.append)
    assert common.written(spark.range(3), "three").count() == 3 and eased == [spark]


def test_tasks_begin_without_others_vocabularies(monkeypatch):
    encoders, matchers = {"a": 1}, {"b": 2}
    monkeypatch.setattr(tokens, "_ENCODERS", encoders)
    monkeypatch.setattr(decontamination, "_MATCHERS", matchers)
    common.lean("contrail.llm.tokens")
    assert encoders and not matchers
    common.lean()
    assert not encoders


def test_keys_are_never_sent_out(spark):
    """F1: Spark sizes the keys of a text as one, so keys of many texts were sent out by way of the driver, which failed over 0.6 GB."""
    sketched = common.written(spark.createDataFrame([(t, t * 7, [t % 3, t]) for t in range(9)], "t long, fp long, bands array<long>"), "sketches")
    for df in (jaccard.golay_pairs(sketched), jaccard.members(sketched)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [key" in plan and "BroadcastHashJoin [key" not in plan
    assert sorted(map(tuple, jaccard.members(sketched).collect())) == sorted((t % 3, t) for t in range(9))


def test_firsts_are_never_sent_out(spark):
    """they are rows of a written table that takes several times its files' size in memory."""
    texts = spark.createDataFrame([(t, f"a b c d e f g h i j k l m n o p q r s {t}") for t in range(4)], "t long, text string")
    pairs = jaccard.rare_pairs(texts.select("t", "t").toDF("t", "label"), texts)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [s" in plan and "BroadcastHashJoin [s" not in plan
    assert pairs.distinct().count() == 6
