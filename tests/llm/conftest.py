import random

import pytest

from activity_engine.llm.common import configure


@pytest.fixture(autouse=True)
def settings(spark):
    configure(spark)


def prose(seed: int, count: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(count))


#: Nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters.
EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (5, "one"), (None, "one two"), (None, None),
    (6, prose(1, 60)), (7, prose(1, 60)), (8, prose(2, 30_000)), (9, "naïve ÉTÉ 漢字 \u0085 ½ <|endoftext|> 🙂‍♂️"),
    (10, "a " * 900), (11, "x" * 3000), (12, "THE!! END!!\nTHE!! END!!\n\nTHE!! END!!"),
]


#: Names that operators have used for columns of their own.
CLASHES = ("_key", "_label", "_t", "_hit", "_toxicity", "_removal", "rule", "verdict", "_id", "_doc", "_head", "_found",
           "_change", "key", "spans", "leaf", "root", "path", "i", "n", "_row", "_text")


@pytest.fixture()
def edges(spark):
    """Edge rows with columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), "mine", 1, -1, *CLASHES) for i, t in EDGES]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row string, t int, k int, "
              + ", ".join(f"{c} string" for c in CLASHES))


@pytest.fixture()
def no_docs(edges):
    return edges.limit(0)
