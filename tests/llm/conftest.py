import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key double, digest string, " \
         "shard int, __size long"


def documents(spark, rows):
    """Rows of (doc_id, text, source) with the other columns of ``documents`` and columns whose names clash."""
    full = [(i, t, None if s is None else "en", s, None if t is None else len(t), -1, -1.0, "x", 99, -7)
            for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{i % 977} other{i % 13}" for i in range(60_000))
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, LONG, "b"), (5, "one", None), (5, "one", None),
       (6, "one", "a"), (7, "One", "a"), (8, "ein schöner Tag, né? 日本 😀", "b"), (9, LONG, "b"), (None, "lost", "c"),
       (10, "one two three four five six seven", "c"), (11, "one  two three four five six seven", "c")]


@pytest.fixture(scope="session")
def odd(spark):
    from demandcast.llm.common import ship_package
    ship_package(spark)
    return documents(spark, ODD).cache()


@pytest.fixture(scope="session")
def none(spark):
    from demandcast.llm.common import ship_package
    ship_package(spark)
    return documents(spark, [])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
