import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "the the the", "x" * 70_000, "the cat " * 9_000, "é ñ ü", "中文 字", "\u0000", "a\u00a0b\u2028c",
    "token = secret: abcdefgh1234", "one two three four", "one two three four", "ONE two three FOUR", "12 34 %$# 56",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, odd texts, repeated rows and columns whose names clash with results."""
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else "s", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", "en", "s", 1), (3, "\n\n", None, "s", 1), (3, "\n\n", None, "s", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS)


CLASHING = (
    "score lang_pred spans ids fp component_id shard slot size group row bin offset length piece start n_words distance kept failed "
    "pool name key host path rule verdict n_tokens digest tokenizer"
)


@pytest.fixture(scope="session")
def clashing(odd):
    return odd.select("*", *[F.lit(7).alias(c) for c in CLASHING.split()])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def spark(spark):
    from ripplekit.llm.common import session

    return session(spark)
