from __future__ import annotations

import pytest
from pyspark.sql import Row

LONG = " ".join(f"word{i % 977} is{i}" for i in range(30_000))

#: Awkward texts: NULL, empty, white space only, control and wide characters, long, one word.
TEXTS = [
    None, "", "   \n\t ", "one", "a b c", "\x1c odd\x85separators \xa0here", "été naïve 東京 😀😀 ﬁ",
    LONG, "same line\nsame line\nother line\nsame line", "the cat sat on the mat " * 20,
    "<|endoftext|> in <|endoftext|>text  with  runs   ", "▁marker ▁▁ text ▁", "don't we'll I'm 's",
    "x" * 5000, "mail a.b@c.org, call +1 (736) 555-2678 or 10.0.0.1", "trailing space ",
    "\r\nline\r\nline\r\n", "٣٤ ४५ 12 34", "token = 4bb9ab0dca6ee9988a51daf6bba0ef7c01aa9a9b",
]


def documents(spark, texts=None, lang="en", source=None):
    """One row per text, with extra columns whose names the operators use themselves."""
    texts = TEXTS if texts is None else texts
    rows = [(i * 3, t, None if i % 7 == 6 else lang, source or f"s{i % 3}", 0, "x", i, "k", 1.5, i)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
        "row string, size int, key string, score double, _row int")


@pytest.fixture(scope="session")
def awkward(spark):
    docs = documents(spark)
    return docs.unionByName(docs.where("doc_id in (9, 24)")).cache()  # two rows occur twice


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark).where("1 = 0")


def by_id(df) -> dict[int, list[Row]]:
    out: dict[int, list[Row]] = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out
