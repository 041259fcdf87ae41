"""Documents with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

AWKWARD = [
    (1, "the cat sat on the mat", "en", "a"),
    (1, "the cat sat on the mat", "en", "a"),  # a repeated row
    (1, "another text under the same id", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n \r\n", "en", "b"),
    (None, "a text without an id", "en", "b"),
    (None, None, None, "b"),
    (5, "word " * 30_000, "en", "b"),
    (6, "a" * 60_000, None, "c"),
    (7, "naïve — 日本語 😀 İ <|endoftext|> \x85\u2028 'll", "xx", "c"),
    (8, "the cat sat on the mat", "en", None),
    (9, "\n".join(["one line of words here", "", "one line of words here"] * 9), "en", "d"),
    (10, "lone", "en", "d"),
]
#: Names that operators use inside or in their results.
CLASHES = "id row text_crc32 size shard slot n_words kept p_good n_lines n_removed_lines hash at rest texts class component_id source_key ids n_tokens n_bytes copies taken carried _words".split()


@pytest.fixture(scope="session")
def awkward(spark: SparkSession) -> DataFrame:
    rows = [(i, t, lang, source, None, *(f"{c}!" for c in CLASHES)) for i, t, lang, source in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES))


@pytest.fixture(scope="session")
def empty(awkward: DataFrame) -> DataFrame:
    return awkward.limit(0)


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.001"
