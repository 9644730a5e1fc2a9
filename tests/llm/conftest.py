import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, score double, keys string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source]) as a documents table with extra columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, 0.5, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return make


@pytest.fixture(scope="session")
def corpus():
    """Random documents with copies, near copies, shared passages, shared lines, nulls, empties and a repeated row."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(400)]

    def words(n):
        return [rng.choice(vocab) for _ in range(n)]
    passage, line = words(30), "This Line is shared by very many documents."
    rows = []
    for i in range(60):
        w = words(rng.choice([0, 1, 3, 12, 13, 40, 120]))
        if i % 3 == 0:
            w = w[:20] + passage + w[20:]
        text = ""
        for x in w:
            text += x + rng.choice([" ", " ", " ", "\n", "\t"])
        if i % 4 == 0:
            text += "\n  " + (line.upper() if i % 8 else line) + " \n"
        rows.append((i * 3 - 20, text, rng.choice(["a", "b", "ß", "", None])))
    base = words(90)
    for k in range(25):  # near copies
        w = list(base)
        for _ in range(k % 5):
            w[rng.randrange(90)] = rng.choice(vocab)
        rows.append((500 + k, " ".join(w), "hot"))
    rows += [(700 + k, " ".join(base), "hot") for k in range(10)]  # exact copies
    rows += [(900, None, "a"), (901, "", "a"), (902, "   \n\t ", None), (None, "some text of a row without id", "b")]
    rows.append(rows[3])
    return rows
