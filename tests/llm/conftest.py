import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table from texts, or from (id, text[, lang, source]) tuples."""

    def make(rows, extra=False):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            i, text, lang, source = (*r, "en", "src0")[:4] if len(r) < 4 else r
            full.append((i, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOC)
        if extra:  # columns that operators use inside or return
            from pyspark.sql import functions as F
            for c in ("id", "node", "token", "size", "key", "rank", "target", "copies", "line", "doc", "score", "spans",
                      "base", "n_lines", "component", "component_id", "label", "kinds", "data", "q", "n_words", "place"):
                df = df.withColumn(c, F.lit("x"))
        return df

    return make


#: Rows that every operator must take: nulls in every column, empty and blank texts, a tie, a repeated row, a long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a"), (5, "a"), (None, "b c d"), (7, "x " * 30000), (8, "é漢 \U0001f600"),
       (9, "word " * 60, None, None), (10, "w" * 50000)]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(ODD, extra=True)
