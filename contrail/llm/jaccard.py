"""Near-duplicates by the Jaccard similarity of their word shingles, beyond the reach of SimHash's three bits.

Texts of similarity 4/5 differ in about ten of 64 fingerprint bits, so Golay keys, which find three, settle the closest
copies only. For the rest each text has keys of a second kind: the least of its shingles under `ROWS` orders, for BANDS sets
of orders. Two texts of similarity s have a key in common but with probability (1 - s^ROWS)^BANDS: 3 in a million at 4/5.
What shares a key is verified exactly: a text is held against one text of a key first, then against a few, which joins nearly all of a
group without its pairs. Texts of keys that still hold several groups are held against those that share one of their rarest shingles,
which no pair of similarity 4/5 escapes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm import simhash
from contrail.llm.common import bounded, dropped, lean, written
from contrail.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 32, 5
#: Bytes of text that are sketched at a time; a longer text is a block of its own.
BLOCK = 1 << 19
#: Odd numbers: the base of the rolling hash, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
ORDERS = np.random.default_rng(7).integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: How many texts of a key the others are held against, by round.
PICKED = (1, 4)

_POWERS: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, n at least; those that a block needs are kept."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = [np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(max(n, BLOCK * 2), x, dtype=np.uint64))), dtype=np.uint64) for x in (BASE, UNBASE)]
    if n <= BLOCK * 2:
        _POWERS[:] = made
    return made[0], made[1]


_LOWER = np.frombuffer(simhash.LOWER, dtype=np.uint8)
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def rolled(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the shingles of all texts in their order, repeats included; where each text's begin and end). Texts hold no null."""
    ended = pc.binary_join_element_wise(texts.cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    n = len(texts)
    offsets = np.frombuffer(ended.buffers()[1], dtype=np.int64)[ended.offset : ended.offset + n + 1]
    data = np.frombuffer(ended.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    blank = _BLANK[data]
    before = np.concatenate(([True], blank[:-1]))
    keep = ~(blank & before)  # one blank after each word
    data = _LOWER[data[keep]]
    space = blank[keep]
    data[space] = 32
    ends = np.flatnonzero(space)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    # words of each text: places of texts' ends among the kept bytes
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    limits = np.searchsorted(starts, kept_before[offsets - offsets[0]])
    first, last = limits[:-1], limits[1:] - 1
    count = np.where(last >= first, np.maximum(last - first + 2 - width, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(count)))
    at = np.repeat(first - bounds[:-1], count) + np.arange(bounds[-1])
    upto = np.minimum(at + width - 1, np.repeat(last, count))
    up, down = powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])))
    a, b = starts[at], ends[upto]
    return mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)), bounds


def band_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of BANDS keys for each text; texts without shingles have keys of their own kind, all alike."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, BANDS), dtype=np.uint64)
    if len(some):
        begin = bounds[:-1][some]
        for band in range(BANDS):
            key = np.full(len(some), band + 1, dtype=np.uint64)
            for row in range(ROWS):
                key = mixed(key * np.uint64(BASE) ^ np.minimum.reduceat(hashes * ORDERS[band * ROWS + row], begin))
            out[some, band] = key
    return out.view(np.int64)


def fingerprints_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SimHash of each text from the hashes of its shingles, repeats included; 0 for a text that has none."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    if len(some):
        begin, n = bounds[:-1][some], np.diff(bounds)[some]
        fp = np.zeros(len(some), dtype=np.uint64)
        for k in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(k) & np.uint64(1)).astype(np.int32), begin)
            fp |= (2 * ones > n).astype(np.uint64) << np.uint64(k)
        out[some] = fp.view(np.int64)
    return out


def blocks(texts: pa.Array):
    """Slices of at most BLOCK bytes, or of one text."""
    ends = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).cumsum()
    row, n = 0, len(texts)
    while row < n:
        high = max(int(np.searchsorted(ends, (ends[row - 1] if row else 0) + BLOCK, side="right")), row + 1)
        yield row, high
        row = high


def sketches(docs: DataFrame, text_col: str) -> DataFrame:
    """(t, fp, bands) of each distinct text: its hash, its fingerprint and its band keys."""

    def run(batches):
        lean()
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                part = batch.slice(a, b - a)
                hashes, bounds = rolled(pc.fill_null(part.column(1), ""), SHINGLE)
                bands = pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * BANDS, BANDS, dtype=np.int32), band_keys(hashes, bounds).ravel())
                yield pa.record_batch({"t": part.column(0), "fp": fingerprints_of(hashes, bounds), "bands": bands})

    each = bounded(docs).select(F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text")).mapInArrow(run, "t long, fp long, bands array<long>")
    return written(each.groupBy("t").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")), "sketches")


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingles' hashes, ascending. A text of fewer words is one shingle; one without words has none."""
    from xxhash import xxh64_digest

    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    joined = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    found = b"".join([xxh64_digest(joined[a:b]) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())])
    return np.unique(np.frombuffer(found, dtype=">i8").astype(np.int64))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """4/5 or more; two texts without words are alike."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts that are alike."""
    both = pairs.join(texts.select(F.col("t").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("t").alias("b"), F.col("text").alias("y")), "b")

    def run(batches):
        lean()
        last, held = None, None
        for batch in batches:
            for part in (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                same = []
                for b, x, y in zip(part.column(1).to_pylist(), part.column(2), part.column(3)):
                    if b != last:
                        last, held = b, shingles(y.as_py())
                    same.append(alike(shingles(x.as_py()), held))
                at = pa.array(np.flatnonzero(same))
                yield pa.record_batch({"a": part.column(0).take(at), "b": part.column(1).take(at)})

    return written(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "alike")


def rare_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): texts of members (t, label) with different labels that may be alike, by a shingle that both have.

    All shingles have one order: those that one label alone has come first, then by the number of texts that have them. Two sets of
    similarity 4/5 share one of their first n - ceil(4 n / 5) + 1 shingles, n being either's size, and its place bounds how many they can share.
    """

    def run(batches):
        lean()
        for batch in batches:
            for part in (batch.slice(k, 200) for k in range(0, batch.num_rows, 200)):
                sets = [shingles(x.as_py()) for x in part.column(2)]
                sizes = [len(x) for x in sets]
                yield pa.record_batch({
                    "t": np.repeat(part.column(0).to_numpy(), sizes), "label": np.repeat(part.column(1).to_numpy(), sizes), "s": np.concatenate(sets),
                    "n": np.repeat(np.array(sizes, dtype=np.int64), sizes),
                })

    each = written(members.join(texts, "t").select("t", "label", "text").mapInArrow(run, "t long, label long, s long, n long"), "shingles")
    several = each.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("df")).where("lo <> hi").select("s", "df")
    own = Window.partitionBy("t")  # a text's own shingles
    placed = each.join(several, "s").withColumn("c", F.count("*").over(own)).withColumn("rest", F.col("c") - F.row_number().over(own.orderBy("df", "s")))
    first = written(placed.where(F.col("n") - F.col("rest") <= F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1).select("s", "t", "label", "n", "rest"), "firsts")
    x, y = first.alias("x"), first.alias("y")
    may = (F.col("x.t") < F.col("y.t")) & (F.col("x.label") != F.col("y.label")) & (9 * (F.least("x.rest", "y.rest") + 1) >= 4 * (F.col("x.n") + F.col("y.n")))
    return x.hint("merge").join(y.hint("merge"), (F.col("x.s") == F.col("y.s")) & may).select(F.col("x.t").alias("a"), F.col("y.t").alias("b"))


def golay_pairs(sketched: DataFrame) -> DataFrame:
    """(a, b): texts within three bits of the least text of one of their Golay keys, one pair for each fingerprint."""
    fps = sketched.groupBy("fp").agg(F.min("t").alias("t"))
    keyed = simhash.keyed(fps)
    first = keyed.where("index").groupBy("key").agg(F.min("fp").alias("pivot"))
    # Spark sizes keys as if each fingerprint had one, and would send them all out; so it does with what explode gives
    near = keyed.select("key", "fp").hint("merge").join(first.hint("merge"), "key").where((F.col("fp") != F.col("pivot")) & (simhash.far("fp", "pivot") <= simhash.LIMIT))
    near = near.groupBy("fp").agg(F.min("pivot").alias("pivot"))
    pairs = near.join(fps, "fp").select(F.col("t").alias("a"), F.col("pivot").alias("fp")).join(fps, "fp").select("a", F.col("t").alias("b"))
    same = sketched.select(F.col("t").alias("a"), "fp").join(fps, "fp").select("a", F.col("t").alias("b")).where("a <> b")
    return pairs.unionByName(same)


def joined(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """(t, label) of all texts that have a link, after found, pairs (a, b) of texts, is added to what labels has."""
    if labels is None:
        return written(components(found), "labels").select(F.col("node").alias("t"), "label")
    ends = [labels.select(F.col("t").alias(c), F.col("label").alias(f"l{c}")) for c in "ab"]
    between = found.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("la", "a").alias("x"), F.coalesce("lb", "b").alias("y"))
    moved = components(between, "x", "y")
    before = labels.select("t", F.col("label").alias("node")).join(moved, "node", "left").select("t", F.coalesce("label", "node").alias("label"))
    new = moved.join(labels.select(F.col("t").alias("node")), "node", "left_anti").select(F.col("node").alias("t"), "label")
    out = written(before.unionByName(new), "labels")
    dropped(moved)
    return out


def members(sketched: DataFrame) -> DataFrame:
    """(key, t): the texts of each band key that several have."""
    keys = sketched.select("t", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select("key")
    return keys.hint("merge").join(shared.hint("merge"), "key").distinct()


def linked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(t, label) of the texts, as hashes, that have a link: label is one for all that links join."""
    sketched = sketches(docs, text_col)
    left = written(members(sketched), "members")
    pairs = written(golay_pairs(sketched).distinct(), "pairs")
    wanted = left.select("t").unionByName(pairs.select(F.col("a").alias("t"))).unionByName(pairs.select(F.col("b").alias("t"))).distinct()
    each = docs.select(F.xxhash64(text_col).alias("t"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = written(each.join(wanted, "t", "left_semi").groupBy("t").agg(F.first("text").alias("text")), "texts")
    tried, labels = pairs, joined(None, verified(pairs, texts))
    for n in (*PICKED, None):
        known = left.select("key", "t").join(labels, "t", "left").withColumn("label", F.coalesce("label", "t"))
        chance = F.pmod(F.xxhash64("t", F.lit(n or 0)), F.lit(1 << 40))
        several = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), F.min(F.struct(chance.alias("h"), "t")).alias("first"))
        several = several.where("lo <> hi").select("key", "n", F.col("first.t").alias("first"))
        # the texts that the others of their key are held against
        picked = (F.col("t") == F.col("first")) | (chance < F.lit(float((n or 0) << 40)) / F.col("n"))
        now = written(known.join(several, "key").select("key", "t", "label", picked.alias("picked")), "mixed")
        dropped(left)
        if now.isEmpty():
            break
        if n is None:
            pairs = rare_pairs(now.select("t", "label").distinct(), texts)
        else:
            x, y = now.alias("x"), now.where("picked").alias("y")
            # of two picked texts of a key one is held against the other
            once = (F.col("x.label") != F.col("y.label")) & (~F.col("x.picked") | (F.col("x.t") < F.col("y.t")))
            pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & once).select(F.least("x.t", "y.t").alias("a"), F.greatest("x.t", "y.t").alias("b"), F.col("x.t").alias("member"))
        if n == 1:  # most groups are joined by one pair for each text
            pairs = pairs.groupBy("member").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
        pairs = written(pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        labels = joined(labels, verified(pairs, texts))
        left = now
    return labels


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near-duplicates: that of the least id (nulls last, then the least hash of the text).

    Texts are linked if 4/5 or more of their distinct five-word shingles are common to both. Texts of fewer words are one shingle; null texts
    and texts without words are alike. Repeated rows are copies; null ids are kept where a component has no other; other columns
    stay as they are; no rows, no rows.
    """
    labels = linked(docs, text_col)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("t"))
    texts = rows.groupBy("t").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "t")).alias("least"))
    of = texts.join(labels, "t", "left").withColumn("label", F.coalesce("label", "t"))
    return simhash.chosen(docs, of.groupBy("label").agg(F.min("least").alias("least")), id_col, text_col)
