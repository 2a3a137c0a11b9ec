import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, copies, near copies, shared lines and repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    line = "Copyright notice: " + prose(rng, 12)
    base = prose(rng, 200)
    rows = [(0, None, "en", "s0", 0), (1, "", "en", "s1", 0), (2, " \n\t", None, None, 3), (3, long, "en", "s2", len(long)), (4, "x", "en", "s3", 1), (None, base, "en", "s4", 1), (None, None, None, None, None)]
    rows += [(10 + k, base, "en", f"s{k}", 1) for k in range(6)]
    rows += [(20 + k, base[: 400 + k] + " changed " + base[400 + k :], "de", f"s{k % 3}", 1) for k in range(6)]
    rows += [(30 + k, f"{prose(rng, 30)}\n{line}\n{prose(rng, 20)}", ["en", "de", "fr"][k % 3], f"s{k}", 1) for k in range(14)]
    rows += [(50, "Grüße, naïve façade. 日本語 text <|endoftext|> it's  two\n\n\nlines\u00a0end ", "de", "s1", 1)] * 2
    rows += [(51, "other text for the same id", "en", "s1", 1), (51, "one more text for it", "en", "s2", 1)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """With columns named like the operators' own."""
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    for c in ("start", "length", "shard", "size", "fp", "label", "key", "h", "t", "at", "score", "lang_pred", "n_words", "spans", "n_lines", "n_removed", "component_id", "fingerprint", "ids", "class", "_t", "_id"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    from contrail.llm.queries import vocabulary

    return vocabulary()
