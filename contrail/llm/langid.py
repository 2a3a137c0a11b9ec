"""Language of whole texts by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams by language on the executors; only the log-probability matrix, whose size is languages
times DIMS, comes to the driver and is sent out with the scoring function. Scoring gathers, for the n-grams that a text
has, their columns of the matrix and adds them up, batch by batch in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import bounded, lean

DIMS = 1 << 15
SIZES = (1, 2, 3)
#: Odd multipliers of the rolling hash, one for each place in an n-gram, and one that mixes in its size.
FACTORS, SIZE_FACTOR = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), 0x27D4EB2F
#: Most languages that a model is fitted on.
MOST_LANGUAGES = 1_000
#: Characters that are handled at a time.
BLOCK = 1 << 20

_TABLE: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank (32) for what is no letter."""
    if not _TABLE:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for k in range(0x110000):
            if (c := chr(k)).isalpha():
                low = c.lower()
                out[k] = ord(low) if len(low) == 1 else k
        _TABLE.append(out)
    return _TABLE[0]


def grams(codes: np.ndarray, starts: int) -> list[np.ndarray]:
    """For each n-gram size the hashes below DIMS of the n-grams at the first `starts` places, DIMS for those with
    two blanks in a row or one blank alone."""
    blank = codes == 32
    double = blank[:-1] & blank[1:]
    out, total = [], np.zeros(len(codes), dtype=np.uint32)
    for n in SIZES:
        m = min(starts, len(codes) - n + 1)
        if m <= 0:
            break
        total = total[: len(codes) - n + 1] + codes[n - 1 :] * np.uint32(FACTORS[n - 1])
        mixed = (total[:m] ^ (total[:m] >> np.uint32(15))) * np.uint32(SIZE_FACTOR + 2 * n)
        h = (mixed >> np.uint32(32 - 15)).astype(np.int32)
        if n == 1:
            h[blank[:m]] = DIMS
        for k in range(n - 1):
            h[double[k : k + m]] = DIMS
        out.append(h)
    return out


def pieces(texts: list[str | None]):
    """(codes, starts, docs, firsts): runs of whole texts, or blocks of a long one, as letters. Each text stands
    between two pairs of blanks; docs and firsts say which text begins at which place."""
    table = letters()
    run, size = [], 0

    def joined():
        firsts, at = [], 0
        for _, t in run:
            firsts.append(at)
            at += len(t) + 2
        text = "  ".join(["", *[t for _, t in run], ""])
        codes = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        return codes, len(codes), [d for d, _ in run], firsts

    for d, text in enumerate(texts):
        if not text:
            continue
        if len(text) > BLOCK:
            for k in range(0, len(text), BLOCK):
                # two characters after the block, two blanks before the text; n-grams count where they begin, in one block only
                part = "  " * (k == 0) + text[k : k + BLOCK] + (text[k + BLOCK : k + BLOCK + 2] + "  ")[:2]
                codes = table[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
                yield codes, len(codes) - 2, [d], [0]
            continue
        run.append((d, text))
        size += len(text)
        if size > BLOCK:
            yield joined()
            run, size = [], 0
    if run:
        yield joined()


def _counts(batches):
    """(lang, bucket, n) of each partition's labelled texts."""
    lean()
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lang in set(langs):
            texts = [x.as_py() for x, y in zip(batch.column(0), langs) if y == lang]
            docs[lang] = docs.get(lang, 0) + len(texts)
            total = totals.setdefault(lang, np.zeros(DIMS + 1, dtype=np.int64))
            for codes, starts, _, _ in pieces(texts):
                for h in grams(codes, starts):
                    total += np.bincount(h, minlength=DIMS + 1)
    for lang, total in totals.items():
        total[DIMS] = docs[lang]  # the spare place carries the number of texts
        at = np.flatnonzero(total)
        yield pa.record_batch({"lang": pa.array([lang] * len(at)), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})


class Model:
    """languages, and a matrix with a row of log-probabilities for each and a spare column of zeros; priors are logs."""

    def __init__(self, languages: list[str], matrix: np.ndarray, priors: np.ndarray):
        self.languages, self.matrix, self.priors = languages, matrix, priors

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        n = len(self.languages)
        sums, seen = np.zeros((n, len(texts))), np.zeros(len(texts), dtype=np.int64)
        for codes, starts, docs, firsts in pieces(texts):
            for k, h in enumerate(grams(codes, starts)):
                if k == 0:
                    np.add.at(seen, docs, np.add.reduceat((h < DIMS).astype(np.int64), np.minimum(firsts, len(h) - 1)))
                at = np.minimum(firsts, len(h) - 1)
                for i in range(n):
                    np.add.at(sums[i], docs, np.add.reduceat(np.take(self.matrix[i], h), at, dtype=np.float64))
        if not n:
            return ["und"] * len(texts), [0.0] * len(texts)
        sums += self.priors[:, None]
        best = sums.argmax(axis=0)
        score = 1 / np.exp(sums - sums.max(axis=0)).sum(axis=0)
        return [self.languages[b] if s else "und" for b, s in zip(best.tolist(), seen.tolist())], np.where(seen > 0, score, 0.0).tolist()


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Fit on all labelled rows whose language and text aren't null, repeated ones each time. Languages stand in ascending order, so ties
    go to the first. No rows give a model of no language."""
    rows = bounded(labelled).select(labelled[text_col].alias("text"), labelled[lang_col].alias("lang")).where("lang is not null and text is not null")
    found = rows.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    n_langs = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if n_langs > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the matrix would not fit a worker")
    got = found.toArrow()  # DIMS + 1 rows a language at most
    langs = sorted(set(got.column(0).to_pylist()))
    at = np.searchsorted(np.array(langs, dtype=object), np.array(got.column(0).to_pylist(), dtype=object)) if langs else np.empty(0, dtype=np.int64)
    counts = np.zeros((len(langs), DIMS + 1))
    counts[at, got.column(1).to_numpy()] = got.column(2).to_numpy()
    docs, matrix = counts[:, DIMS].copy(), counts + smoothing
    logs = np.zeros((len(langs), DIMS + 1), dtype=np.float32)
    if langs:
        logs[:, :DIMS] = np.log(matrix[:, :DIMS] / matrix[:, :DIMS].sum(axis=1, keepdims=True))
    return Model(langs, logs, np.log(docs / docs.sum()) if langs else docs)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score: the posterior of the predicted language, 0 to 1.

    und with score 0 for null texts, texts without letters, and where no language was learned. Only the text decides,
    the whole of it, however long; repeated rows are judged alike; no rows, no rows; every row keeps its other columns, but for columns named lang_pred or score, which are replaced.
    """
    rest = bounded(docs).drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages * DIMS * 4 bytes: 131 MB for the most languages

    def run(batches):
        lean()
        at = None
        for batch in batches:
            at = batch.schema.get_field_index(text_col) if at is None else at
            for part in (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                langs, scores = sent.value.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    from pyspark.sql import types as T

    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rest.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """The rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
