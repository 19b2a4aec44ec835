import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rnd, n, letters="abcdefghiklmnoprstu"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def messy():
    """Rows with nulls in every column, empty and odd texts, repeated rows and ids, copies, shared lines and passages."""
    rnd = random.Random(7)
    lines = [sentence(rnd, 8) for _ in range(6)]
    passages = [sentence(rnd, 70) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [sentence(rnd, rnd.randint(0, 60))]
        if i % 3 == 0:
            parts.append(rnd.choice(passages))
        if i % 2 == 0:
            parts += ["\n" + rnd.choice(lines) + "\n"]
        parts.append(sentence(rnd, rnd.randint(0, 60)))
        rows.append((i, " ".join(parts), rnd.choice(["en", "de", None]), f"s{i % 9}", None))
    rows += [(200, None, "en", "s1", 0), (201, "", "en", None, 0), (202, " \n\t ", None, "s1", 4), (None, rows[3][1], "en", "s2", None), (None, None, None, None, None),
             (203, rows[6][1], "en", "s3", 1), (204, rows[6][1], "en", "s4", 1), (9, rows[9][1], "en", "s5", 1), (9, "other text of the same id", "en", "s0", 1),
             (205, "a" * 3000, "en", "s1", 3000), (206, "ab" * 1500 + "é中😀" * 300, "en", "s1", 3900), (207, "<|endoftext|> x<|startoftext|>", "en", "s1", 1),
             (208, "\n".join(lines), "en", "s8", 1), (209, sentence(rnd, 30_000), "de", "s0", 1), (210, "$$$ *** ### " * 80, "en", "s0", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, messy):
    """The messy rows with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    extra = {c: F.lit("clash") for c in ("kept", "n_words", "score", "fp", "h", "rid", "key", "hub", "spans", "items", "hit", "gone", "z", "__id", "__sum", "__text", "n_tokens", "component_id")}
    return spark.createDataFrame(messy, COLUMNS).withColumns(extra)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
