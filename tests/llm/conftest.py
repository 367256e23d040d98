import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF0001 = "/root/testdata/sf0.001"
#: Columns that clash with names the operators use inside.
CLASHES = "id long, score double, fp long, key long, found string, `rank` int, candidate string, label int, n long"


@pytest.fixture(scope="session")
def documents(spark):
    """Small documents with every odd case: null and empty texts, a null id, repeats, a long text, clashing columns."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [(1, word), (2, word), (3, None), (4, ""), (5, "   \n\t "), (6, "short"), (7, word + " extra"),
            (8, " ".join(f"w{i % 977}" for i in range(30_000))), (8, "same id, another text"), (None, word),
            (9, "Élan vital, naïve café — 日本 😀!"), (6, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("*", "cast(1 as long) AS id", "0.5D AS score", "7L AS fp", "8L AS key", "'x' AS found", "3 AS rank",
                            "'y' AS candidate", "1 AS label", "2L AS n", "'src' AS source", "cast(null as string) AS lang", "9 AS start")


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
