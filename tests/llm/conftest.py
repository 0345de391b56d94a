import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id bigint, text string, uid string, hits string, n bigint, spans string, `group` string, label string, shard int, rest string"


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with nulls, empty and long texts, repeated rows and ids, copies, near copies and shared passages."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdeäé") for _ in range(r.randrange(1, 4))) for _ in range(120)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, base, long = text(60), text(150), text(12_000)
    rows = [(i, text(r.randrange(1, 90))) for i in range(40)]
    rows += [(100 + i, f"{text(20)} {passage}\t{text(r.randrange(30))}") for i in range(8)]
    near = base.split()
    for i in range(14):  # a chain of near copies, each a little further from the first
        near[(i * 37) % len(near)] = f"New{i}"
        rows.append((200 + i, " ".join(near)))
    rows += [(300 + i, base) for i in range(3)] + [(300, base), (301, text(50))]  # repeated rows; an id with two texts
    rows += [(400, None), (401, ""), (402, " \n"), (403, "a"), (404, "A"), (405, "a b"), (None, base), (None, text(70)), (None, None)]
    rows += [(500, long), (501, long + " tail"), (502, text(500) * 2), (503, "To " * 200), (504, "x" * 50_000)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names the operators use inside."""
    return spark.createDataFrame([(*row, "u", "h", 5, "s", "g", "l", 7, "r") for row in corpus], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
