import pytest

SMALL = "/root/testdata/sf0.01"
WORDS = ("the cat sat on a mat while rain fell over old roofs and nobody in town came out to see what had been "
         "left at the door of number nine since monday morning").split()
LONG = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + str(i % 13) for i in range(30_000))
CLASH = ["score", "size", "base", "spans", "h", "n", "rep", "label", "part", "kind", "found", "key", "lang_pred", "predicted",
         "_row", "taken", "fingerprint", "assign", "entropy"]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and long texts, repeated rows, equal texts under several ids."""
    plain = " ".join(WORDS * 3)
    return [(1, plain, "en", "a"), (1, plain, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (None, plain, "en", None),
            (None, None, None, None), (4, LONG, "en", "b"), (5, plain, "de", None), (6, " \n\t ", "de", "c"),
            (7, "word", "en", "c"), (8, plain + " x", "de", "a"), (9, "Ünïcode ßtraße 12 a@b.co +1 (555) 123-4567", None, "b")]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The same as a table whose further columns have names that the operators use themselves."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit("mine") for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
