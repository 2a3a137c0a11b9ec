import numpy as np
from pyspark.sql import functions as F

from contrail.llm import langid


def test_fit_counts_every_labelled_row(spark):
    """One text copied many times, and a language of few rows, beyond 50,000 rows."""
    n = 60_000
    rows = spark.range(n).select(F.when(F.col("id") % 20_000 == 7, "rare").otherwise("much").alias("lang"), F.when(F.col("id") % 20_000 == 7, F.concat(F.lit("zyx"), F.col("id"))).otherwise(F.when(F.col("id") < 20_000, "one copied text").otherwise(F.concat(F.lit("ab"), F.col("id")))).alias("text"))
    model = langid.train(rows)
    assert model.languages == ["much", "rare"] and np.allclose(np.exp(model.priors), [(n - 3) / n, 3 / n], rtol=1e-9)
    assert model.predict(["zyx", "one copied text"])[0] == ["rare", "much"]
