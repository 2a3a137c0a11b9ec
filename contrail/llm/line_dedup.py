"""Cross-site boilerplate lines, judged by the number of distinct sites a line appears on.

A HyperLogLog sketch of the sites is kept for each line's hash and merged by aggregation, so no group of
occurrences comes together. Estimates well off the threshold decide; only for lines near it the distinct
sites are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import folded, written

LG_K = 12
#: Standard errors on either side of the threshold within which lines are counted exactly. One is 1.04 / sqrt(2^LG_K).
BAND = 6
#: Lines that are sent to every executor: some 60 bytes each.
MOST_SENT = 200_000


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame) -> DataFrame:
    """(h, c, doc_id, t, site, pos) of every line that isn't blank; h and c are hashes of the line without outer
    blanks, t of the whole text."""
    each = docs.select("doc_id", "site", F.xxhash64("text").alias("t"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    return each.where(F.length(F.trim("line")) > 0).select(F.xxhash64(F.trim("line")).alias("h"), F.crc32(F.trim("line")).alias("c"), "doc_id", "t", "site", "pos")


def beside(lines: DataFrame) -> DataFrame:
    """lines as one side of a join: sent to every executor up to MOST_SENT of them, which are counted, else joined by shuffling."""
    return F.broadcast(lines) if lines.limit(MOST_SENT + 1).count() <= MOST_SENT else lines


def spread_lines(found: DataFrame, sites: int) -> DataFrame:
    """(h, c, first): lines on `sites` distinct sites or more; first is their least (doc_id, t, pos), nulls first."""
    margin = BAND * 1.04 / (1 << LG_K) ** 0.5 * sites + 1
    sketched = found.groupBy("h", "c").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("s"), F.min(F.struct("doc_id", "t", "pos")).alias("first"))
    counted = written(sketched.select("h", "c", "first", F.hll_sketch_estimate("s").alias("n")).where(F.col("n") >= sites - margin), "lines")
    near = counted.where(F.col("n") <= sites + margin).select("h", "c", "first")
    # a line's sites are brought together before its occurrences are, so a line that stands everywhere is no group of all its rows
    exact = found.where("site is not null").join(beside(near), ["h", "c"]).groupBy("h", "c", "site").agg(F.min("first").alias("first"))
    exact = exact.groupBy("h", "c").agg(F.count("*").alias("n"), F.min("first").alias("first")).where(F.col("n") >= sites)
    return written(counted.where(F.col("n") > sites + margin).select("h", "c", "first").unionByName(exact.select("h", "c", "first")), "spread")


def remove_boilerplate(docs: DataFrame, sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """docs with text_col less every line that stands on `sites` distinct sites or more, but for its first
    occurrence (least id, then text hash, then place), and with n_lines and n_removed.

    Lines are compared without outer blanks; blank lines stay. Null sites count for none. Null texts stay null with 0
    lines; the empty text has 1. Rows with one id and one text are treated alike, so a repeated first row keeps
    its line in each. Other columns stay, but n_lines and n_removed are replaced where docs has them.
    """
    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    found = occurrences(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[site_col].alias("site")))
    spread = spread_lines(found, sites)
    doomed = found.join(beside(spread), ["h", "c"]).where(~F.struct("doc_id", "t", "pos").eqNullSafe(F.col("first")))
    doomed = doomed.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("gone"))
    keyed = docs.select(folded(docs, "n_lines", "n_removed").alias("row"), docs[id_col].alias("i"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("u"))
    joined = keyed.join(doomed, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("u") == F.col("t")), "left")
    split, gone = lines(F.col("text")), F.col("gone")
    kept = F.array_join(F.filter(split, lambda x, i: ~F.array_contains(gone, i)), "\n")
    text = F.when(gone.isNull(), F.col("text")).otherwise(kept)
    return joined.select(
        *[(text if c == text_col else F.col("row")[c]).alias(c) for c in rest], F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
    )


def oracle(sites: int) -> str:
    """The query's rows in DuckDB's SQL, with exact distinct counts, where doc_id is unique."""
    return f"""
WITH l AS (SELECT doc_id, source, trim(line) AS line, pos FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents)),
spread AS (SELECT line, min((doc_id, pos)) AS first FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {sites}),
doomed AS (SELECT doc_id, list(pos) AS gone FROM l JOIN spread USING (line) WHERE (doc_id, pos) <> first GROUP BY doc_id)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE
    coalesce(array_to_string(list_transform(list_filter(range(0, len(string_split(text, chr(10)))), lambda i: NOT list_contains(gone, i)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)), '') END AS text,
  coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed
FROM documents LEFT JOIN doomed USING (doc_id)"""
