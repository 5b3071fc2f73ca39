import random

import pytest
from pyspark.sql import types as T

from tests.conftest import *  # noqa: F403

WORDS = "the of and to in is it that was for on are with as his they be at one have this from".split()


def prose(seed: int, words: int) -> str:
    """Lines of invented English, the same for the same seed."""
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append(rng.choice(WORDS) if rng.random() < 0.4 else "".join(rng.choice("aeiolnrst") for _ in range(6)))
        out.append("\n" if i % 11 == 10 else " ")
    return "".join(out).strip()


#: Null and empty values, blanks only, repeated rows, a tie in the id, a very long text.
EDGE = [
    (1, prose(1, 120), "en"),
    (1, prose(1, 120), "en"),
    (2, prose(1, 120), "en"),
    (3, None, None),
    (4, "", "en"),
    (5, " \n\t ", "xx"),
    (None, prose(5, 80), "en"),
    (None, None, None),
    (6, prose(6, 30), "de"),
    (6, prose(7, 30), "de"),
    (7, prose(7, 6000) + "\n" + prose(1, 120), "en"),
    (8, "é" * 5000, "fr"),
    (9, "x" * 3000 + " " + "y" * 3000, "en"),
    (10, prose(1, 60) + " ümläut " + prose(2, 60), None),
]
#: Names that operators also use.
CLASHES = ["kept", "_text", "_hash", "hash", "fingerprint", "block", "word", "__utf8", "n_lines", "piece"]


@pytest.fixture(scope="session")
def edge(spark):
    schema = "doc_id bigint, text string, lang string, " + ", ".join(f"`{c}` int" for c in CLASHES)
    return spark.createDataFrame([(*r, *range(len(CLASHES))) for r in EDGE], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], T.StructType.fromDDL("doc_id bigint, text string, lang string"))
