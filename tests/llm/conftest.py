import pytest
from small_tables import SCHEMA, prose, table


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    from leafstat.llm.common import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    same = prose(1, 60)
    return [(None, None), (None, prose(2, 40)), (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, same), (5, same),
            (6, same), (7, prose(3, 60_000)), (8, "é漢字 \x00 <|endoftext|> 's A--B 😀"), (9, "x" * 300_000),
            (10, "a b c d e f g h " * 40), (11, same + " and more"), (-3, "***" * 30)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return table(spark, odd_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1), (7, 1), (11, 1), (-3, 0), (None, 1), (99, 1), (6, None)], "doc_id long, quality int")
