"""Token ids in Arrow stream files of fixed-size-list batches.

Every sequence of a file has the same length, so its ids and its mask are slices of two flat buffers: a
reader maps the file and takes sequence k without copying or decoding anything before it. Beside them each
sequence lists the documents that end in it, so files alone give the documents back.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import bounded, scratch
from contrail.llm.tokens import encoder

MANIFEST = "file_no int, path string, n_sequences long, n_tokens long, n_docs long"
DOCS = "file_no int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def schema(length: int, wide: bool) -> pa.Schema:
    """ids: 16-bit where the vocabulary fits, else 32-bit. mask: true where an id counts, false for padding.
    end_doc, end_at: the documents that end in a sequence and the place after their last id."""
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("end_doc", pa.list_(pa.int64())), ("end_at", pa.list_(pa.int32()))])


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class Writer:
    """One stream file: ids come document by document and leave as batches of `per_batch` whole sequences."""

    def __init__(self, sink, length: int, wide: bool, per_batch: int = 512):
        self.length, self.per_batch, self.kind = length, per_batch, np.uint32 if wide else np.uint16
        self.schema = schema(length, wide)
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.buffer = np.empty(length * per_batch, dtype=self.kind)
        self.used = self.n_tokens = self.n_sequences = self.n_docs = 0
        self.ends: list[tuple[int, int | None]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """ids holds one id at least: the end of the document."""
        self.n_tokens += len(ids)
        self.n_docs += 1
        while len(ids):
            if self.used == len(self.buffer):
                self._flush()
            n = min(len(ids), len(self.buffer) - self.used)
            self.buffer[self.used : self.used + n] = ids[:n]
            self.used += n
            ids = ids[n:]
        self.ends.append((self.used, doc_id))

    def _flush(self) -> None:
        n = -(-self.used // self.length)
        mask = np.arange(n * self.length) < self.used
        self.buffer[self.used : n * self.length] = 0
        at = np.array([x for x, _ in self.ends], dtype=np.int64)
        of = (at - 1) // self.length
        offsets = pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32))
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(self.buffer[: n * self.length]), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
            pa.ListArray.from_arrays(offsets, pa.array([d for _, d in self.ends], pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array((at - of * self.length).astype(np.int32))),
        ]
        self.out.write_batch(pa.record_batch([c.cast(t) for c, t in zip(columns, self.schema.types)], schema=self.schema))
        self.n_sequences += n
        self.used, self.ends = 0, []

    def close(self) -> None:
        if self.used:
            self._flush()
        self.out.close()


def write(docs: DataFrame, tokenizer: str, path: str, length: int = 2048, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, put end_id after it, and write the ids in ascending order of id_col: one file for each
    range of ids. Returns the manifest (file_no, path, n_sequences, n_tokens, n_docs), which is also written below path.

    path: a folder that all executors and the driver share. A file gets its name when it is complete, so a lost
    task leaves no part of it. Null and empty texts are end_id alone; null ids come first; rows with one id are in the
    order of their texts' hashes; other columns are not read; no rows give no files.
    """

    def run(batches):
        from pyspark import TaskContext

        tool = encoder(tokenizer)
        wide = tool.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16 or end_id >= 1 << 16
        task = TaskContext.get()
        files, folder = file_system(path)
        final, part = f"{folder}/tokens-{task.partitionId():06d}.arrows", f"{folder}/.tokens-{task.taskAttemptId()}.part"
        made = None
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            if made is None and doc_ids:
                files.create_dir(folder)
                sink = files.open_output_stream(part)
                made = Writer(sink, length, wide)
            for first, ids, ends in tool.column(batch.column(1)):
                # each text's ids with the end after them
                ids = np.insert(ids.astype(made.kind), ends, end_id)
                begin = 0
                for k, stop in enumerate((ends + np.arange(1, len(ends) + 1)).tolist()):
                    made.add(doc_ids[first + k], ids[begin:stop])
                    begin = stop
        if made is not None:
            made.close()
            sink.close()
            files.move(part, final)
            name = final if "://" not in path else f"{path}/{final.rpartition('/')[2]}"
            yield pa.record_batch({
                "file_no": pa.array([task.partitionId()], pa.int32()), "path": [name], "n_sequences": [made.n_sequences], "n_tokens": [made.n_tokens],
                "n_docs": [made.n_docs],
            })

    narrow = bounded(docs).select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    # equal ids may be many: the text's hash and the place in the input let a range end among them
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    placed = narrow.select("*", order[1].alias("h"), order[2].alias("m")).repartitionByRange(F.col("doc_id").asc_nulls_first(), "h", "m")
    manifest = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "m").select("doc_id", "text").mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


class Reader:
    """A mapped file. sequence(k) gives views of its ids and mask; documents() streams the documents back."""

    def __init__(self, path: str):
        files, name = file_system(path)
        self.source = pa.memory_map(name) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(name)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.firsts = np.cumsum([0] + [b.num_rows for b in self.batches])

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        b = int(np.searchsorted(self.firsts, k, side="right")) - 1
        row = k - int(self.firsts[b])
        ids, mask = self.batches[b].column(0), self.batches[b].column(1)
        n = ids.type.list_size
        return ids.flatten()[row * n : (row + 1) * n].to_numpy(zero_copy_only=True), mask.flatten()[row * n : (row + 1) * n]

    def documents(self):
        """(doc_id, start in the file, n_tokens, crc32 of the ids as little-endian unsigned 32-bit)."""
        start = n = crc = 0
        for batch in self.batches:
            length = batch.column(0).type.list_size
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=True)[: batch.column(1).flatten().true_count]
            ends, docs = batch.column(3), batch.column(2).flatten().to_pylist()
            rows = np.repeat(np.arange(batch.num_rows), np.diff(ends.offsets.to_numpy()))
            at, here = rows * length + ends.flatten().to_numpy(), 0
            for end, doc_id in zip(at.tolist(), docs):
                crc = zlib.crc32(flat[here:end].astype("<u4").tobytes(), crc)
                n += end - here
                yield doc_id, start, n, crc
                start, here, n, crc = start + n, end, 0, 0
            crc = zlib.crc32(flat[here:].astype("<u4").tobytes(), crc)
            n += len(flat) - here


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files below path: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    One task reads one file or more; a window over the manifest, which has a row for each file, gives each file's first id.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    first = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file_no", "path", F.coalesce(F.sum("n_tokens").over(first), F.lit(0)).alias("base"))

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows = [(d, base + s, n, c) for d, s, n, c in Reader(name).documents()]
                for k in range(0, len(rows), 10_000):
                    d, s, n, c = zip(*rows[k : k + 10_000])
                    yield pa.record_batch({
                        "doc_id": pa.array(d, pa.int64()), "start": pa.array(s, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                        "ids_crc32": pa.array(c, pa.int64()),
                    })

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write docs to a new folder of the cluster's shared folder and read the documents back from the files."""
    path = scratch(docs.sparkSession, "tokens")
    write(docs, tokenizer, path, **options)
    return read_documents(docs.sparkSession, path)
