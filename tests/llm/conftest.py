import random

import pytest

#: Names that the operators use inside.
CLASHING = ["row", "key", "n", "length", "place", "bucket", "score", "held_out", "class", "label", "part", "file"]


@pytest.fixture(scope="session")
def clashing():
    return set(CLASHING)


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(3)
    words = ["tha", "or.", "in", "Éreu", "ndre,", "42", "x's", "漢字", "éa", "the"]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "ra", "mo"]) for _ in range(n))

    same = prose(80)
    return [
        None,
        "",
        "",
        " \n",
        "a",
        "a  b\n\n\tc d <|endoftext|> e<|startoftext|>",
        "!!! $$$",
        same,
        same,
        same,
        same + " more",
        prose(300),
        prose(40) + "\n" + prose(40),
        "z" * 5000,
        prose(30_000),
    ]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_texts):
    """Null, empty and very long texts, equal rows, a null id, and columns with the operators' own names."""
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    rows += [(None, "no id"), (7, rows[7][1])]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(i, t, None, *("x" for _ in CLASHING)) for i, t in rows]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
