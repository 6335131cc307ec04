"""Shared small tables for the training-data operators."""

import random

import pytest
from odd_texts import SYLLABLES, prose

@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty and blank texts, a null id, repeated rows and ids, ties, one very long text, clashing extra columns."""
    rnd = random.Random(5)
    base = prose(rnd, "en", 80)
    rows = [(10, base), (11, base.replace(" ", "\n \t", 1)), (3, base), (3, base), (12, None), (13, ""), (14, " \n"), (None, base),
            (None, None), (15, "one"), (16, "one"), (15, "two words"), (17, "ü ñ \u2028 中文 😀 <|endoftext|>"), (18, "12 %% 34"),
            (19, prose(rnd, "de", 30_000)), (20, "x" * 70_000), (21, " ".join(["again"] * 5000)), (22, base + " end")]
    rows += [(100 + i, prose(rnd, rnd.choice(list(SYLLABLES)), 60)) for i in range(20)]
    full = [(i, t, "en", "k", 1, 2, 3, "x", True) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, id string, key int, n int, block int, "
                                       "text_hash string, train boolean").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")

