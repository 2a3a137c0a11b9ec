import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contrail.llm import token_files
from contrail.llm import tokens
from contrail.llm.packing import Bins, cut, pack
from contrail.llm.queries import op1_harmonic_packing, op7_token_files, vocabulary as path
from contrail.llm.tokens import Encoder

TOOL = Tokenizer.from_file(path())
ENCODER = Encoder(path())


def ids(text):
    return TOOL.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet=st.sampled_from(list("aB é'sß\n\t.,-!19x \u00a0\x1c日")), max_size=40))
@settings(max_examples=400, deadline=None)
def test_encoder_is_the_library(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids(text)


@given(st.text(max_size=30))
@settings(max_examples=200, deadline=None)
def test_encoder_on_any_text(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids(text)


SIGNS = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "é", "漢", "1", "٣", "½", "!", "-", "a", "B", "😀", "\u0301", "\x1c", "\x85", "<|endoftext|>", "\u200b", "'S", "Ⅷ"]


def by_column(tool, texts):
    out = []
    for first, found, ends in tool.column(pa.array(texts, pa.string())):
        assert first == len(out)
        out += [x.tolist() for x in np.split(found, ends[:-1])]
    return out


@pytest.mark.parametrize("block", [16, 4 << 20])
@given(st.lists(st.none() | st.lists(st.sampled_from(SIGNS), max_size=30).map("".join), max_size=20))
@settings(max_examples=150, deadline=None)
def test_columns_are_the_library(block, texts):
    tokens.BLOCK, before = block, tokens.BLOCK
    try:
        assert by_column(ENCODER, texts) == [ids(x) for x in texts]
    finally:
        tokens.BLOCK = before


def test_added_tokens_are_the_library():
    text = "a <|endoftext|> b"
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids(text) == [64, 220, 50256, 275]
    plain = Tokenizer.from_file(path())
    plain.encode_special_tokens = True
    assert np.frombuffer(Encoder(path(), special_as_text=True).encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_a_full_cache_forgets():
    small = Encoder(path(), keep=4)
    for text in ("a b c d e f g", "h i j k l", "a b c d e f g", "a b", "h"):
        assert by_column(small, [text, text]) == [ids(text)] * 2


@pytest.mark.parametrize("capacity", [1, 64, 2048])
def test_cuts_cover_once(capacity):
    for n in [*range(1, 2 * capacity + 2), 9999]:
        pieces = list(cut(n, capacity, 128))
        assert sum(x for _, x, _ in pieces) == n and [s for s, _, _ in pieces] == list(np.cumsum([0] + [x for _, x, _ in pieces])[:-1])
        # a piece's class is that of its length, and little is missing to its share
        assert all(capacity // x == i and (capacity // i - x) * 128 <= capacity // i for _, x, i in pieces)


def test_bins_hold_as_many_pieces_as_their_class():
    bins = Bins(2048, 0)
    rng = np.random.default_rng(3)
    rows = [r for n in rng.integers(1, 6000, 3000).tolist() for s, x, i in cut(n, 2048, 128) for r in bins.add((n, s, x, n, bytes(4 * x)), i)]
    full, kinds, lengths = Counter(), {}, Counter()
    for r in rows:
        full[r[4]] += 1
        kinds[r[4]] = r[6]
        lengths[r[4]] += r[2]
    assert all(n == kinds[k] for k, n in full.items()) and len(set(kinds.values())) > 20
    assert all(2048 - n <= 2048 / 128 + kinds[k] for k, n in lengths.items())
    assert sum(2048 - n for n in lengths.values()) < 2048 * len(lengths) / 200
    assert {r[6] for r in bins.rest()} <= {0}


def check_packing(rows, texts, capacity, end):
    """rows: (doc_id, start, length, doc_tokens, sequence_id, offset, ids). Multisets, as ids may repeat."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r[0], r[3]].append(r)
        sequences[r[4]].append((r[5], r[2]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    want = Counter()
    for doc_id, text in texts:
        for k in ids(text) + [end]:
            want[doc_id, k] += 1
    got = Counter()
    for r in rows:
        for k in np.frombuffer(r[6], "<u4").tolist():
            got[r[0], k] += 1
    assert got == want


def test_packing_odd_rows(odd_docs, odd_rows, vocabulary):
    rows = [tuple(r[c] for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")) for r in pack(odd_docs, vocabulary, 64).collect()]
    check_packing(rows, [(r[0], r[1]) for r in odd_rows], 64, 1)


def test_packing_nothing(no_docs, vocabulary):
    assert pack(no_docs, vocabulary).count() == 0
    with pytest.raises(ValueError):
        pack(no_docs, vocabulary, 100)


def test_op1(spark, sf_dir):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = op1_harmonic_packing(spark, sf_dir).collect()
    for doc_id, text in docs.items():
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        found = ids(text) + [1]
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1]) and sum(r.length for r in own) == len(found) == own[0].doc_tokens
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(found[r.start : r.start + r.length], "<u4").tobytes())
    ends = Counter()
    for r in rows:
        ends[r.sequence_id] += r.length
    assert sum(2048 - n for n in ends.values() if n & (n - 1)) < 0.005 * sum(ends.values())
    assert len(rows) < 3.5 * len(docs)


def check_files(rows, texts):
    start = 0
    for r, (doc_id, text) in zip(rows, texts):
        found = ids(text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(found), zlib.crc32(np.array(found, "<u4").tobytes()))
        start += len(found)


def test_op7(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    rows = op7_token_files(spark, sf_dir).orderBy("start").collect()
    assert len(rows) == len(docs)
    check_files(rows, docs)


def test_token_files(spark, odd_docs, odd_rows, vocabulary, tmp_path):
    path = f"file://{tmp_path}/tokens"
    manifest = token_files.write(odd_docs, vocabulary, path, length=16).collect()
    rows = token_files.read_documents(spark, path).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r[0], len(ids(r[1])) + 1) for r in odd_rows)
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)
    for m in manifest:
        reader = token_files.Reader(m.path)
        assert len(reader) == m.n_sequences
        all_ids = np.concatenate([reader.sequence(k)[0][reader.sequence(k)[1].to_numpy(zero_copy_only=False)] for k in range(len(reader))])
        assert len(all_ids) == m.n_tokens
        view, _ = reader.sequence(len(reader) - 1)
        assert len(view) == 16 and not view.flags.owndata
        assert pa.types.is_fixed_size_list(reader.batches[0].schema.field("ids").type)
    assert not list(tmp_path.rglob("*.part"))


def test_token_files_of_nothing(spark, no_docs, vocabulary):
    assert token_files.round_trip(no_docs, vocabulary).count() == 0


def test_long_document_over_batches(tmp_path):
    data = np.arange(10_000) % 50_000
    with pa.OSFile(str(tmp_path / "x"), "wb") as sink:
        w = token_files.Writer(sink, 8, False, per_batch=4)
        w.add(7, data[:5].astype(np.uint16))
        w.add(8, data.astype(np.uint16))
        w.add(None, data[:3].astype(np.uint16))
        w.close()
    got = list(token_files.Reader(str(tmp_path / "x")).documents())
    assert [g[:3] for g in got] == [(7, 0, 5), (8, 5, 10_000), (None, 10_005, 3)]
    assert got[1][3] == zlib.crc32(data.astype("<u4").tobytes())
