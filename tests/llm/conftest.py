import pytest

from finmesh.llm.common import table
from tests.conftest import SF001

#: Texts with every odd case: null, empty, white space, ties, repeats, very long words and texts.
ODD = [(None, "null id"), (900_001, None), (900_002, ""), (900_003, " \n\t "), (900_004, "Tie one two three"), (900_005, "tie ONE two three"),
       (900_006, "a" * 5000), (900_007, "naïve ΑΣ İstanbul 日本語 😀 it's 123 \n\n  x\t\tz  "), (900_008, "word " * 30_000), (900_005, "tie ONE two three")]
DOCUMENTS = "doc_id long, text string"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents table and the odd rows."""
    return table(spark, SF001, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(ODD, DOCUMENTS)).repartition(4)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns named like the operators' own."""
    rows = [(1, "Some text here", "k", 5, "x"), (2, "some TEXT here", "k", 6, None), (3, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, keep_id long, __file string")
