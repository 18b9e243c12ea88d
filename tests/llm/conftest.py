import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with the names that operators use or return themselves.
CLASHING = {"fingerprint": "f", "component_id": "c", "size": "s", "shard": "x", "slot": "y", "score": "z", "lang_pred": "p", "taken": "t", "hits": "h", "kept_id": "k", "hit_id": "i", "removed": "r", "label": "l", "id": "d", "n": "n", "count": "q", "target": "g", "rank": "a", "pass": "b", "fp": "e", "held_out": "o"}
#: Names that stages use within.
CLASHING |= {f"__{n}": n for n in ("row", "copy", "times", "lang", "score", "path", "index", "first", "id", "number", "at", "tie", "nth", "run", "arc", "part", "start", "sum", "before")}


def prose(rng, n, words=("the", "of", "tion", "ering", "andst", "house", "river", "über", "été", "mañana")):
    return " ".join(rng.choice(words) + rng.choice(["", "a", "er", "lin", "do"]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and wordless texts, a very long one, repeated rows and ties."""
    rng = random.Random(7)
    long = prose(rng, 60_000)
    base = prose(rng, 80)
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, base.replace("the", "THE", 1), None, "b", 1),
        (3, base.replace("the", "THE", 1), None, "b", 1),
        (4, None, "en", "a", None),
        (5, "", "fr", None, 0),
        (6, " \t\n ", None, "b", 3),
        (7, "123 ... !!!", "de", None, 11),
        (8, long, "en", "c", len(long)),
        (9, "one", "fr", "c", 3),
        (None, prose(rng, 50), "fr", "c", 5),
        (None, None, None, None, None),
        (10, prose(rng, 300) + ". " + base, "fr", "a", 9),
        (11, "ünï çödé 漢字 \U0001f600 the the", "es", "a", 9),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The rows as a table with clashing extra columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows, SCHEMA)
    return df.withColumns({c: F.lit(v) for c, v in CLASHING.items()})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [tuple(r) for r in docs.collect()]
