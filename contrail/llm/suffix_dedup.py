"""Removal of byte strings that an earlier document has, by suffix arrays of shards.

Every string of `length` bytes holds an anchor: its ANCHOR bytes with the least hash, the leftmost if several. Equal strings
have equal anchors, so the stretch of strings that share an anchor goes to the shard of that anchor's hash, and equal strings
meet there wherever they stand. Only anchors that two documents have can matter; the others are left out first. Equal stretches
count as one: all but that of the least document are settled, already in the batch they are read with where it is there too.
The first of each kind are sent where an anchor has several kinds: each shard sorts their suffixes by induced sorting; suffixes
with a common prefix of `length` bytes are neighbours in that order, and the least document among them says what goes.
The strings of anchors of very many kinds are counted by their own hashes instead, so no shard grows with a phrase that stands everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import bounded, dropped, written
from contrail.llm.suffix_array import permuted_prefixes, suffix_array

ANCHOR = 20
#: Strings that are handled at a time; places within fit into PLACE bits.
BLOCK, PLACE = 1 << 20, np.uint64((1 << 21) - 1)
#: Bytes of one shard's suffix array.
SHARD = 1 << 20
#: Of anchors of more kinds of stretches each string goes by its own hash: those whose stretches, of length 50, don't fit a shard of their own.
HOT = SHARD // (2 * 50 - ANCHOR)
#: Odd multipliers of the hash.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def hashes(data: bytes, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from each place on."""
    count = len(data) - n + 1
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = eights[:count] * MIX_A
    for k in [*range(8, n - 7, 8), *([n - 8] if n % 8 else [])]:
        h ^= h >> np.uint64(29)
        h ^= eights[k : k + count]
        h *= MIX_A
    h ^= h >> np.uint64(32)
    h *= MIX_B
    h ^= h >> np.uint64(29)
    return h


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    out, size = values, 1
    while size * 2 <= width:
        out, size = np.minimum(out[:-size], out[size:]), size * 2
    n = len(values) - width + 1
    return np.minimum(out[:n], out[width - size : width - size + n]) if size < width else out


def window_hashes(data: bytes, at: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from each given place on."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = np.full(len(at), n, dtype=np.uint64)
    for k in [*range(0, n - 7, 8), *([n - 8] if n % 8 else [])]:
        h = (h ^ eights[at + k]) * MIX_B
        h ^= h >> np.uint64(31)
    return h


def blocks(texts: list[bytes], length: int):
    """(data, ends, docs, starts): runs of whole texts, or parts of a long one that overlap by a string less a byte. ends are the ends in data,
    docs which of texts they are, starts what to take from a place in data for the place in the text."""
    run: list[int] = []
    size = 0

    def joined():
        ends = np.cumsum([len(texts[d]) for d in run])
        return b"".join([texts[d] for d in run]), ends, np.array(run), np.concatenate(([0], ends[:-1]))

    for d, text in enumerate(texts):
        if len(text) < length:
            continue
        if len(text) > BLOCK:
            for at in range(0, len(text) - length + 1, BLOCK):
                part = text[at : at + BLOCK + length - 1]
                yield part, np.array([len(part)]), np.array([d]), np.array([-at])
            continue
        if size + len(text) > BLOCK:
            yield joined()
            run, size = [], 0
        run.append(d)
        size += len(text)
    if run:
        yield joined()


def stretches(data: bytes, ends: np.ndarray, length: int):
    """(first, last, anchor, hash, whole, k) arrays: strings of the k-th text that start at first to last in data share the anchor at that
    place; whole is a hash of all bytes of the stretch and of the anchor's place in it. A stretch is shorter than two strings."""
    h = hashes(data, ANCHOR)
    m = least(h & ~PLACE | np.arange(len(h), dtype=np.uint64), length - ANCHOR + 1)
    crosses = np.zeros(len(m) + 2, dtype=bool)  # strings over a text's end, and what stands before the first and after the last
    crosses[[0, -1]] = True
    for k in range(1, length):
        at = ends - k + 1
        crosses[at[at <= len(m)]] = True
    differs = np.concatenate(([True], m[1:] != m[:-1], [True]))
    inside = ~crosses[1:-1]
    first = np.flatnonzero(inside & (crosses[:-2] | differs[:-1]))
    last = np.flatnonzero(inside & (crosses[2:] | differs[1:]))
    anchor = (m[first] & PLACE).astype(np.int64)
    whole = window_hashes(data, first, length) * MIX_A ^ window_hashes(data, last, length)
    whole ^= ((last - first) << 8 | anchor - first).astype(np.uint64) * MIX_B
    return first, last, anchor, h[anchor].view(np.int64), whole.view(np.int64), np.searchsorted(ends, first, side="right")


def with_text(whole: np.ndarray, k: np.ndarray) -> np.ndarray:
    """One number for a hash and the text it belongs to."""
    return whole.view(np.uint64) ^ (k.astype(np.uint64) + np.uint64(1)) * MIX_B


def as_bytes(texts: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null texts are empty."""
    return pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()


def shared_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, settled, open, hot): whole hashes of each document's stretches that matter. settled: a document of a smaller id has the
    same stretch; open: the first of its kind, of an anchor with several kinds; hot: those of the open ones whose anchor has very many."""

    def run(batches):
        for batch in batches:
            for part in (batch.slice(k, 2000) for k in range(0, batch.num_rows, 2000)):
                found, whole, of = [], [], []
                ids = part.column(0).to_numpy()
                for data, ends, docs_, _ in blocks(as_bytes(part.column(1)), length):
                    *_, h, w, k = stretches(data, ends, length)
                    found.append(h)
                    whole.append(w)
                    of.append(ids[docs_[k]])
                if not sum(map(len, found)):
                    continue
                h, w, d = np.concatenate(found), np.concatenate(whole), np.concatenate(of)
                by = np.lexsort((d, w))
                h, w, d = h[by], w[by], d[by]
                new = np.concatenate(([True], w[1:] != w[:-1]))
                kind = np.flatnonzero(new)
                least = np.repeat(d[kind], np.diff(np.append(kind, len(d))))
                # what a document read with it settles needs no partner: a row for each document, dealt out evenly
                later = np.flatnonzero(d > least)
                later = later[np.argsort(d[later], kind="stable")]
                cut = np.flatnonzero(np.concatenate(([True], d[later][1:] != d[later][:-1]))) if len(later) else later
                whose = d[later][cut]
                known = pa.ListArray.from_arrays(np.append(cut, len(later)).astype(np.int32), w[later])
                first = np.flatnonzero(new | (d == least) & np.append(False, d[1:] != d[:-1]))
                none = pa.nulls(len(first), pa.list_(pa.int64()))
                yield pa.record_batch({"h": h[first], "whole": w[first], "doc_id": d[first], "known": none})
                yield pa.record_batch({
                    "h": hashes(whose.tobytes(), 8)[::8].view(np.int64) if len(whose) else whose, "whole": pa.nulls(len(whose), pa.int64()),
                    "doc_id": whose, "known": known,
                })

    w, same = Window.partitionBy("h"), Window.partitionBy("h", "whole")
    own = F.when(F.col("whole").isNotNull(), F.col("doc_id"))
    found = docs.select("doc_id", "text").mapInArrow(run, "h long, whole long, doc_id long, known array<long>")
    found = found.select(
        "doc_id", "h", "whole", "known", F.min(own).over(w).alias("lo"), F.max(own).over(w).alias("hi"), F.min("whole").over(w).alias("first"),
        F.max("whole").over(w).alias("last"),
    )
    found = found.where("known is not null or lo <> hi").withColumn("least", F.min(own).over(same))
    settled = F.col("whole").isNotNull() & (F.col("least") < F.col("doc_id"))
    found = found.select(
        "doc_id", "h", "whole", "known", settled.alias("settled"), (F.col("first") != F.col("last")).alias("several"),
    ).where("known is not null or settled or several")
    found = found.withColumn("n", F.sum(F.when(F.col("whole").isNotNull() & ~F.col("settled"), 1).otherwise(0)).over(w))
    open_ = F.col("whole").isNotNull() & ~F.col("settled")
    lists = {"settled": F.col("settled"), "open": open_ & (F.col("n") <= HOT), "hot": open_ & (F.col("n") > HOT)}
    grouped = found.groupBy("doc_id").agg(F.flatten(F.collect_list("known")).alias("known"), *[F.collect_set(F.when(c, F.col("whole"))).alias(n) for n, c in lists.items()])
    return grouped.select("doc_id", F.concat("known", "settled").alias("settled"), "open", "hot")


def shared_stretches(docs: DataFrame, anchors: DataFrame, length: int) -> DataFrame:
    """(doc_id, t, at, key, part) of every open stretch: its place and bytes; strings has the hashes of a hot one's strings instead of
    bytes; and one row for each document with settled ones: at and key are null, starts and ends are the places [start, end) of their strings."""

    def run(batches):
        for batch in batches:
            for piece in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                rows: list[tuple] = []
                ids, hashes_ = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                lists = []
                for column in (piece.column(n) for n in (3, 4, 5)):
                    ends = np.asarray(column.offsets)
                    lists.append((column.values.to_numpy()[ends[0] : ends[-1]], np.repeat(np.arange(len(column)), np.diff(ends))))
                lists = [with_text(*x) for x in lists]
                places: dict[int, list] = {}
                for data, ends, docs_, starts in blocks(as_bytes(piece.column(2)), length):
                    first, last, _, h, whole, k = stretches(data, ends, length)
                    d, key = docs_[k], with_text(whole, docs_[k])
                    known = np.flatnonzero(np.isin(key, lists[0]))
                    cut = np.flatnonzero(np.concatenate(([True], np.diff(k[known]) != 0))) if len(known) else known
                    for x in np.split(known, cut[1:]) if len(known) else ():
                        off = starts[k[x[0]]]
                        places.setdefault(int(d[x[0]]), []).append((first[x] - off, last[x] + 1 - off))
                    for x in np.flatnonzero(np.isin(key, lists[1])).tolist():
                        a, i = int(first[x]), int(d[x])
                        rows.append((ids[i], hashes_[i], a - int(starts[k[x]]), int(h[x]), data[a : int(last[x]) + length], None, None, None))
                    for x in np.flatnonzero(np.isin(key, lists[2])).tolist():
                        i = int(d[x])
                        strings = window_hashes(data, np.arange(first[x], last[x] + 1), length).view(np.int64)
                        rows.append((ids[i], hashes_[i], int(first[x] - starts[k[x]]), None, None, strings, None, None))
                for i, found in places.items():
                    rows.append((ids[i], hashes_[i], None, None, None, None, *(np.concatenate(x) for x in zip(*found))))
                if rows:
                    yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), STRETCH.types)], schema=STRETCH)

    joined = docs.join(anchors, "doc_id").select("doc_id", "t", "text", "settled", "open", "hot")
    return joined.mapInArrow(run, "doc_id long, t long, at int, key long, part binary, strings array<long>, starts array<int>, ends array<int>")


STRETCH = pa.schema([
    ("doc_id", pa.int64()), ("t", pa.int64()), ("at", pa.int32()), ("key", pa.int64()), ("part", pa.binary()), ("strings", pa.list_(pa.int64())),
    ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
])


def counted(stretches: DataFrame) -> DataFrame:
    """(doc_id, t, a, b): places [a, b) of the strings of hot stretches that one of a document of a smaller id has too, by the strings' hashes."""
    each = stretches.where("strings is not null").select("doc_id", "t", "at", F.posexplode("strings").alias("k", "string"))
    least = each.groupBy("string").agg(F.min("doc_id").alias("least"))
    gone = each.join(least, "string").where(F.col("doc_id") > F.col("least"))
    return gone.select("doc_id", "t", (F.col("at") + F.col("k")).alias("a"), (F.col("at") + F.col("k") + 1).alias("b"))


def shard_runs(parts: list[bytes], ids: np.ndarray, length: int):
    """For each part the runs of its strings' places [start, end) with the least document that has them: (starts, ends, ids) lists."""
    sizes = np.array([len(x) for x in parts])
    text = np.full(int(sizes.sum()) + len(parts) + 1, 257, dtype=np.uint16)  # parts end with a sign that no byte is
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    inside = np.ones(len(text), dtype=bool)
    inside[starts + sizes] = inside[-1] = False
    text[inside] = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint16) + 1
    text[-1] = 0
    order = suffix_array(text)
    joined = permuted_prefixes(text, order, length) >= length
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    place = np.arange(len(owner)) - starts[owner]
    whole = place + length <= sizes[owner]
    ranked = order[order < len(owner)]
    ranked = ranked[whole[ranked]]
    # a suffix with a whole string is joined to the one before it only if that has one too
    group = np.flatnonzero(~joined[ranked])
    smallest = np.minimum.reduceat(ids[owner[ranked]], group)
    by_place = np.empty(len(text), dtype=np.int64)
    by_place[ranked] = np.repeat(smallest, np.diff(np.append(group, len(ranked))))
    at = np.flatnonzero(whole)
    value, part = by_place[at], owner[at]
    cut = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (part[1:] != part[:-1]))))
    ends = np.append(cut[1:], len(at))
    return part[cut], place[at[cut]], place[at[ends - 1]] + 1, value[cut]


def repeated(parts: DataFrame, length: int) -> DataFrame:
    """(doc_id, t, a, b): places [a, b) of the strings of parts that a part of a document of a smaller id has too."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, last = 0, None

        def done(table: pa.Table):
            ids = table.column("doc_id").to_numpy()
            part, a, b, v = shard_runs(table.column("part").to_pylist(), ids, length)
            gone = v < ids[part]
            part, at = part[gone], table.column("at").to_numpy()
            if len(part):
                yield pa.record_batch({
                    "doc_id": ids[part], "t": table.column("t").to_numpy()[part], "a": (at[part] + a[gone]).astype(np.int32),
                    "b": (at[part] + b[gone]).astype(np.int32),
                })

        for batch in batches:
            keys = batch.column(3).to_numpy()
            # shards end where the key changes
            edges = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
            ends = pc.binary_length(batch.column(4)).to_numpy().cumsum()
            begun = 0
            for k, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                if size >= SHARD and (k or keys[0] != last):
                    held.append(batch.slice(begun, x - begun))
                    yield from done(pa.Table.from_batches([h for h in held if h.num_rows]))
                    held, size, begun = [], 0, x
                size += int(ends[y - 1] - (ends[x - 1] if x else 0))
            held.append(batch.slice(begun))
            last = keys[-1]
        if held:
            yield from done(pa.Table.from_batches(held))

    shards = parts.select("doc_id", "t", "at", "key", "part").repartition("key").sortWithinPartitions("key")
    return shards.mapInArrow(run, "doc_id long, t long, a int, b int")


def removable(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, t, a, b): places [a, b) of strings that a document of a smaller id has."""
    anchors = written(shared_anchors(docs.where("doc_id is not null"), length), "anchors")
    found = written(shared_stretches(docs, anchors, length), "stretches")
    dropped(anchors)
    each = repeated(found.where("key is not null"), length).unionByName(counted(found)).select("doc_id", "t", F.array("a").alias("a"), F.array("b").alias("b"))
    settled = found.where("starts is not null").select("doc_id", "t", F.col("starts").alias("a"), F.col("ends").alias("b"))
    lists = each.unionByName(settled).groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b")).alias("found"))
    lists = written(lists.select("doc_id", "t", F.flatten("found.a").alias("a"), F.flatten("found.b").alias("b")), "places")
    dropped(found)
    return lists


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, kept (the remaining bytes) and spans (start, end: maximal removed runs of bytes).

    A byte goes if a string of `length` bytes over it also starts in a document of a smaller id; strings are judged on the input.
    Null texts are empty. Texts shorter than length stay whole. Rows of one id don't remove each other's bytes; null ids
    are compared with nothing and stay whole. Kept bytes need not be whole characters. Other columns are not read.
    """
    if length < ANCHOR + 8:
        raise ValueError(f"length must be {ANCHOR + 8} at least")
    text = docs[text_col]
    rows = bounded(docs).select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    found = removable(rows, length)
    joined = rows.join(found.withColumnsRenamed({"doc_id": "i", "t": "u"}), (F.col("doc_id") == F.col("i")) & (F.col("t") == F.col("u")), "left").select("doc_id", "text", "a", "b")

    def run(batches):
        for batch in batches:
            for piece in (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                rows = []
                for doc_id, text, a, b in zip(piece.column(0).to_pylist(), piece.column(1), piece.column(2), piece.column(3)):
                    data = (text.as_py() or "").encode()
                    spans = []
                    if a.is_valid:
                        starts, ends = a.values.to_numpy(), b.values.to_numpy() + (length - 1)
                        by = np.argsort(starts, kind="stable")
                        starts, ends = starts[by], np.maximum.accumulate(ends[by])
                        new = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
                        spans = list(zip(starts[new].tolist(), ends[np.append(new[1:], len(ends)) - 1].tolist()))
                    edges = [0, *[x for s in spans for x in s], len(data)]
                    kept = b"".join([data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)])
                    rows.append((doc_id, len(data), kept, [{"start": x, "end": y} for x, y in spans]))
                if rows:
                    yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), RESULT.types)], schema=RESULT)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, kept binary, spans array<struct<start: int, end: int>>")


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
