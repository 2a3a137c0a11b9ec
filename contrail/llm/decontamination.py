"""Benchmark passages in documents, found by one Aho-Corasick automaton over words.

Test items are normalised to words; each distinct word becomes one character, each window of `window` words one
pattern of as many characters. A document becomes a string with one character a word, so one pass of the automaton
gives all occurrences, and places in that string are word numbers, which map back to the text.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import bounded, lean, written

#: Words are runs of digits, a-z and all beyond ASCII, after A-Z are lower-cased: other bytes become blanks.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Most bytes of item texts in one automaton: some 4 words a byte of patterns stay under 1 GB.
MOST_BYTES = 8 << 20
#: Hash buckets of items, of which parts are made up.
BUCKETS = 4096
#: Words that are in no item, and the first character that stands for a word; UTF-16's surrogates are left out.
OTHER, FIRST, GAP, GAP_SIZE = "\x00", 1, 0xD800, 0x800


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Matcher:
    """items: (item_id, text). Items without words have no windows; items of fewer words than a window are one."""

    def __init__(self, items: list[tuple], window: int):
        import ahocorasick

        self.letters: dict[bytes, str] = {}
        self.automaton, owners = ahocorasick.Automaton(), {}
        for k, (_, text) in enumerate(items):
            sequence = "".join([self._letter(w) for w in words(text)])
            n = min(window, len(sequence))
            for i in range(len(sequence) - n + 1 if n else 0):
                owners.setdefault(sequence[i : i + n], set()).add(k)
        self.ids = [x for x, _ in items]
        for pattern, of in owners.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(of)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def _letter(self, word: bytes) -> str:
        k = len(self.letters) + FIRST
        return self.letters.setdefault(word, chr(k if k < GAP else k + GAP_SIZE))

    def find(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Maximal runs [start, end) of hit words, and the items that occur."""
        if self.empty or not found:
            return [], set()
        get, runs, items = self.letters.get, [], set()
        sequence = "".join([get(w, OTHER) for w in found])
        for end, (n, of) in self.automaton.iter(sequence):
            items.update(of)
            a, b = end + 1 - n, end + 1
            while runs and runs[-1][1] >= a:
                a = min(a, runs.pop()[0])
            runs.append((a, b))
        return runs, items


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _parts(items: DataFrame, most_bytes: int) -> list[DataFrame]:
    """The items in parts of at most most_bytes of text, unless one of BUCKETS hash buckets alone has more. Sizes are counted before anything is
    fetched."""
    bucket = F.pmod(F.xxhash64("item_id", "text"), F.lit(BUCKETS))
    sizes = items.groupBy(bucket.alias("k")).agg(F.sum(F.octet_length("text")).alias("n")).orderBy("k").collect()
    parts, size = [[0, BUCKETS]], 0
    for k, n in sizes:
        if size and size + n > most_bytes:
            parts[-1][1] = k
            parts.append([k, BUCKETS])
            size = 0
        size += n
    return [items.where((bucket >= a) & (bucket < b)) for a, b in parts] if len(parts) > 1 else [items]


_MATCHERS: dict[str, Matcher] = {}


def _matcher(name: str, part, window: int) -> Matcher:
    """One automaton for each worker process; another part's takes its place."""
    if name not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[name] = Matcher(part.value, window)
    return _MATCHERS[name]


RESULTS = ("n_words", "n_hit", "item_ids", "spans")


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """docs with n_words, n_hit (words inside any occurrence of a window), item_ids (of items with occurring windows, as
    strings in ascending order) and spans (start, end: characters of the text covered by maximal runs of hit words).

    A benchmark of more than most_bytes is scanned for in several passes, one written after the other, each with an automaton of bounded
    size, whose hits are united; the driver holds one part at a time. Texts are scanned whole, however long; repeated rows alike. Null texts have no words. Null item ids hit but are not listed; repeated ids are listed once. Other columns
    stay; those named as the results are replaced. An empty benchmark hits nothing.
    """
    context = docs.sparkSession.sparkContext
    rest = bounded(docs).drop(*RESULTS)
    items = benchmark.select(benchmark[item_col].cast("string").alias("item_id"), benchmark[item_text_col].alias("text"))
    items = items.where("text is not null")
    parts = _parts(items.distinct(), most_bytes)
    out = rest
    for k, part in enumerate(parts):
        sent = context.broadcast([tuple(r) for r in part.collect()])
        out = _pass(out, rest.schema, sent, window, text_col, k == 0, k == len(parts) - 1)
        if k < len(parts) - 1:
            out = written(out, "scanned")
            sent.destroy()
    return out


def _pass(df: DataFrame, schema: T.StructType, part, window: int, text_col: str, first: bool, last: bool) -> DataFrame:
    """One automaton's pass. Between passes a column holds the runs of hit words so far, another the items."""
    ints, span = T.ArrayType(T.IntegerType()), T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    if last:
        new = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("item_ids", T.ArrayType(T.StringType())), ("spans", T.ArrayType(span))]
    else:
        new = [("_runs", ints), ("_items", T.ArrayType(T.StringType()))]  # read by place, so their names may clash
    arrow = {
        "n_words": pa.int64(), "n_hit": pa.int64(), "item_ids": pa.list_(pa.string()),
        "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), "_runs": pa.list_(pa.int32()), "_items": pa.list_(pa.string()),
    }
    kept = len(schema.fields)

    name = uuid.uuid4().hex

    def run(batches):
        lean("contrail.llm.decontamination")
        matcher = _matcher(name, part, window)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            rows = []
            for i, text in enumerate(batch.column(at)):
                text = text.as_py()
                found = words(text)
                runs, hit = matcher.find(found)
                ids = {matcher.ids[k] for k in hit} - {None}
                if not first:
                    flat = batch.column(kept)[i].as_py()
                    runs = _merged([*runs, *zip(flat[::2], flat[1::2])])
                    ids |= set(batch.column(kept + 1)[i].as_py())
                if not last:
                    rows.append(([x for r in runs for x in r], sorted(ids)))
                    continue
                spans = []
                if runs:
                    places = [m.span() for m in WORD.finditer(text)]
                    spans = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in runs]
                rows.append((len(found), sum(b - a for a, b in runs), sorted(ids), spans))
            columns = zip(*rows) if rows else [[] for _ in new]
            made = [pa.array(list(x), arrow[n]) for x, (n, _) in zip(columns, new)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *made], names=[*batch.schema.names[:kept], *[n for n, _ in new]])

    return df.mapInArrow(run, T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in new]]))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """A document is contaminated if a twentieth of its words or more is hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


ORACLE = """
WITH normal AS (
  SELECT 'd' AS kind, doc_id::VARCHAR AS id, text FROM documents UNION ALL SELECT 'i', item_id::VARCHAR, text FROM benchmark),
words AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM normal),
sized AS (SELECT id, w, least(len(w), 13) AS n FROM words WHERE kind = 'i' AND len(w) > 0),
windows AS (SELECT DISTINCT id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS p FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
docs AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE kind = 'd'),
places AS (SELECT d.id, d.i, s.n, list_aggregate(d.w[d.i:d.i + s.n - 1], 'string_agg', ' ') AS p
  FROM docs d, (SELECT DISTINCT n FROM windows) s WHERE d.i + s.n - 1 <= len(d.w)),
found AS (SELECT places.id, i, windows.n, windows.id AS item FROM places JOIN windows ON places.p = windows.p AND places.n = windows.n),
hit AS (SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS k FROM found) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT words.id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (id) LEFT JOIN items USING (id) WHERE kind = 'd'"""
