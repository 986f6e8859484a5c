import pytest


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text[, lang, source]) rows."""

    def make(rows, extra: str = ""):
        full = [(*r, *(None, None)[len(r) - 2 :]) if len(r) < 4 else tuple(r) for r in rows]
        df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string")
        df = df.selectExpr("*", "cast(length(text) as bigint) AS n_chars")
        return df.selectExpr("*", extra) if extra else df

    return make


#: Columns whose names the operators use themselves.
CLASHES = (
    "1 AS id, 2 AS n, 3 AS p, 4 AS q, 5 AS v, 6 AS cid, 7 AS gone_id, 8 AS again_id, 9 AS wanted, 10 AS found, 11 AS row, "
    "12 AS lang_pred, 13 AS score, 14 AS topic, 15 AS n_tokens, 16 AS probability, 17 AS sampled, 18 AS padded, 19 AS value"
)


@pytest.fixture
def clashing():
    """`df` with more columns, named as those in the operators."""
    return lambda df: df.selectExpr("*", *CLASHES.split(", "))
