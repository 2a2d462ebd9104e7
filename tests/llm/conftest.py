from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "This line is long enough to be compared by its key 0123456789"
WORDS = " ".join(f"word{i}" for i in range(60))


def rows_of(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


#: Nulls, empty and white texts, ties, repeated rows, a long text, and what is shared by several.
TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, WORDS), (6, WORDS), (7, WORDS + " more"),
    (8, f"{LINE}\nown eight"), (9, f"own nine\n  {LINE.upper()} "), (10, f"{LINE}\n{LINE}"), (11, LINE),
    (12, f"{LINE}\n\nlast"), (12, f"{LINE}\n\nlast"), (13, "é ñ 日本 " * 5000), (None, "no id at all, but some words here"),
    (14, "x" * 49), (15, "x" * 120), (16, "one  two\r\nthree four <|endoftext|> a.b, c"),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd rows, with columns named like those that operators make."""
    rows = [(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    clashing = "line row h1 h2 pos digest label shard start length rank bucket score key size text_hash".split()
    return docs.withColumns({c: F.lit(f"extra {c}") for c in clashing})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
