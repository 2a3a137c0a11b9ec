"""SimHash near-duplicates at 3 or fewer of 64 bits, found by Golay-code keys.

A fingerprint falls into three segments of at most 23 bits. Every 23-bit word lies within 3 bits of exactly one
codeword of the binary Golay code; the codewords within 4 bits of a word are one or six, and words that differ
in one bit share at least the codeword nearest to either. Three errors over three segments leave either
  A  one segment whole and a second with one error at most, or
  B  one error in each.
A: keys of the whole segment with the second one's codeword. B: keys of the first two segments' codewords, the parities
of all three, which must all differ, and one half of the third, which must be whole. One side of a pair brings the
nearest codeword, the other all within 4 bits; an error flips a segment's parity, so parity says which side brings which.
Pairs that share a key are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import bounded, folded, lean, written
from contrail.llm.graph import components

LIMIT = 3
#: (shift, bits) of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GENERATOR = 0xC75
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42, block: int = 1 << 16) -> bytes:
    """Eight bytes, most significant first. Long texts are hashed in blocks of shingles."""
    from xxhash import xxh64_digest

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), block):
        hashes = b"".join([xxh64_digest(joined[a:b], seed) for a, b in zip(starts[k : k + block], ends[k : k + block])])
        ones += np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(starts)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, fp): t is the text's hash, fp the 64 bits as a signed long. Null texts and texts without words: 0."""

    def run(batches):
        for batch in batches:
            found = b"".join([fingerprint(x.as_py(), shingle) for x in batch.column(2)])
            yield pa.record_batch({"doc_id": batch.column(0), "t": batch.column(1), "fp": pa.array(np.frombuffer(found, dtype=">i8").astype(np.int64))})

    text = docs[text_col]
    return bounded(docs).select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text")).mapInArrow(run, "doc_id long, t long, fp long")


class Golay:
    """near[s]: what to xor to a word's 12 leading bits for the codewords within 4 bits, by syndrome, nearest first; n_near[s] of them count."""

    def __init__(self):
        codewords = [m << 11 | self._mod(m << 11) for m in range(1 << 12)]
        sevens = [c for c in codewords if c.bit_count() == 7]
        bits = [1 << k for k in range(23)]
        patterns = [0, *bits, *(a | b for i, a in enumerate(bits) for b in bits[:i]), *(a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j])]
        self.near, self.n_near = np.zeros((1 << 11, 6), dtype=np.int64), np.ones(1 << 11, dtype=np.int64)
        for e in patterns:
            s = self._mod(e)
            self.near[s] = e >> 11
            if e.bit_count() == 3:
                self.near[s, 1:] = [(e ^ c) >> 11 for c in sevens if c & e == e]
                self.n_near[s] = 6
        self.by_byte = [np.array([self._mod(b << shift) for b in range(256)], dtype=np.int64) for shift in (0, 8, 16)]

    @staticmethod
    def _mod(v: int) -> int:
        for k in range(22, 10, -1):
            if v >> k & 1:
                v ^= GENERATOR << k - 11
        return v

    def indices(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The 12-bit indices of the codewords within 4 bits of each 23-bit word, six columns, nearest first, and how many count."""
        s = self.by_byte[0][words & 255] ^ self.by_byte[1][words >> 8 & 255] ^ self.by_byte[2][words >> 16]
        return (words >> 11)[:, None] ^ self.near[s], self.n_near[s]


_GOLAY: list[Golay] = []


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, index): the keys of each fingerprint; index: this side brings the nearest codeword."""
    if not _GOLAY:
        _GOLAY.append(Golay())
    u = fps.astype(np.int64).view(np.uint64)
    segs = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    found = [_GOLAY[0].indices(s) for s in segs]
    odd = [np.bitwise_count(s).astype(np.int64) & 1 for s in segs]
    six, rows = np.arange(6), np.arange(len(fps))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(3):
        for j in range(3):
            if i == j:
                continue
            tag = (i * 3 + j) << 58
            idx, n = found[j]
            # even: all codewords within 4 bits; odd: the nearest
            r, c = np.nonzero(six < np.where(odd[j] == 0, n, 1)[:, None])
            out.append((r, tag | segs[i][r] << 12 | idx[r, c], c == 0))
    (a, na), (b, nb) = found[0], found[1]
    parity = odd[0] << 2 | odd[1] << 1 | odd[2]
    for half, (at, n) in enumerate(((10, 11), (0, 10))):
        exact = segs[2] >> at & (1 << n) - 1
        tag = 3 * 3 << 58 | half << 57
        one = rows[odd[0] == 1]
        out.append((one, tag | parity[one] << 35 | a[one, 0] << 23 | b[one, 0] << 11 | exact[one], np.ones(len(one), dtype=bool)))
        r, c, d = np.nonzero((six < np.where(odd[0] == 0, na, 0)[:, None])[:, :, None] & (six < nb[:, None])[:, None, :])
        out.append((r, tag | (parity[r] ^ 7) << 35 | a[r, c] << 23 | b[r, d] << 11 | exact[r], np.zeros(len(r), dtype=bool)))
    return tuple(np.concatenate(x) for x in zip(*out))


def keyed(fps: DataFrame) -> DataFrame:
    def run(batches):
        lean()
        for batch in batches:
            for part in (batch.slice(k, 2000) for k in range(0, batch.num_rows, 2000)):
                fp = part.column(0).to_numpy()
                row, key, index = keys(fp)
                yield pa.record_batch({"key": pa.array(key), "fp": pa.array(fp[row]), "index": pa.array(index)})

    return fps.select("fp").mapInArrow(run, "key long, fp long, index boolean")


def far(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def linked(fps: DataFrame) -> DataFrame:
    """(fp, label) of the distinct fingerprints in fps that have a link: label is one for all that links join.

    First every member of a key is held against the key's least fingerprint; that joins nearly all of a group without
    its pairs. Only keys that still hold several components have pairs made, between components, of fingerprints that agree in a quarter.
    """
    of_key = Window.partitionBy("key")
    shared = keyed(fps).select(
        "*", F.min(F.when(F.col("index"), F.col("fp"))).over(of_key).alias("pivot"), F.min("fp").over(of_key).alias("lo"), F.max("fp").over(of_key).alias("hi")
    )
    shared = written(shared.where("pivot is not null and lo <> hi").select("key", "fp", "index", "pivot"), "keys")
    first = components(shared.where((F.col("fp") != F.col("pivot")) & (far("fp", "pivot") <= LIMIT)), "fp", "pivot")
    labels = written(first, "labels")
    known = shared.select("key", "fp", "index").join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    mixed = known.select("*", F.min("label").over(of_key).alias("lo"), F.max("label").over(of_key).alias("hi")).where("lo <> hi")
    mixed = written(mixed.select("key", "fp", "index", "label"), "mixed")
    # of two fingerprints within three bits one of four quarters is equal: pairs are made within quarters of a key only
    quarters = F.posexplode(F.array(*[F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF)) for q in range(4)])).alias("q", "bits")
    mixed = mixed.select("key", "fp", "index", "label", quarters)
    x, y = mixed.where("index").alias("x"), mixed.alias("y")
    equal = (F.col("x.key") == F.col("y.key")) & (F.col("x.q") == F.col("y.q")) & (F.col("x.bits") == F.col("y.bits"))
    pairs = x.hint("merge").join(y.hint("merge"), equal).where((F.col("x.label") != F.col("y.label")) & (far("x.fp", "y.fp") <= LIMIT))
    second = written(components(pairs.select(F.col("x.label").alias("a"), F.col("y.label").alias("b"))), "joined")
    # labels of the second round are over those of the first, or over fingerprints that had no link before
    one = labels.select(F.col("node").alias("fp"), F.col("label").alias("l")).join(second.withColumnRenamed("node", "l"), "l", "left").select("fp", F.coalesce("label", "l").alias("label"))
    two = second.join(labels, "node", "left_anti").select(F.col("node").alias("fp"), "label")
    return one.unionByName(two)


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (the smallest doc_id that links of 3 or fewer
    differing bits reach, the row's own included).

    Repeated rows and null ids keep a row each; null ids count only where all of a component are null, which is null
    then. Texts without words have fingerprint zero, linked like any other. Other columns are not read; no rows, no rows.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    of = labelled(fps)
    smallest = of.groupBy("label").agg(F.min("least").alias("component_id"))
    reach = of.join(smallest, "label").select("fp", "component_id")
    return rows.join(reach, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def labelled(fps: DataFrame) -> DataFrame:
    """fps, which are distinct, with the label of each one's component."""
    labels = written(linked(fps), "linked")
    return fps.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def keep_one(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near-duplicates: that of the least id (nulls last, then the least hash of the text)."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "t")).alias("least"))
    return chosen(docs, labelled(fps).groupBy("label").agg(F.min("least").alias("least")), id_col, text_col)


def chosen(docs: DataFrame, least: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that the structs least name by doc_id and t, each once."""
    kept = least.select(F.col("least.doc_id").alias("doc_id"), F.col("least.t").alias("t")).distinct()
    keyed = docs.select(folded(docs).alias("row"), docs[id_col].cast("long").alias("i"), F.xxhash64(docs[text_col]).alias("u"))
    stays = keyed.join(kept, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("u") == F.col("t")), "left_semi").dropDuplicates(["i", "u"])
    return stays.select(*[F.col("row")[c].alias(c) for c in docs.columns])
