import pytest

from ledgerlens.llm.common import ship

LONG = "lorem ipsum dolor " * 15_000 + "\n" + "x" * 50_000

#: (doc_id, text): nulls, empty and blank texts, a null id, repeated rows, ties, a very long text, odd characters.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog.\nSecond line here."), (2, None), (3, ""), (4, " \n\t "),
    (None, "No id on this row at all."), (5, "Repeated row."), (5, "Repeated row."), (6, LONG), (7, LONG),
    (8, "one"), (9, "É \x85 \xa0 ß 漢字 😀 <|endoftext|> \x00 |#*|"), (None, None), (None, None), (10, "one"),
]


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge(llm):
    """The edge rows with further columns named like the operators' own."""
    rows = [(i, t, "x", n, "y", 1.0, True, "z", b"b", [1]) for n, (i, t) in enumerate(EDGE)]
    return llm.createDataFrame(rows, "doc_id long, text string, text_hash string, fp int, component_id string, "
                                     "score double, kept boolean, shard string, words binary, parts array<int>")


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)
