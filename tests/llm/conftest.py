import random

import pytest

from genomeloom.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def hard_rows():
    """Null ids, texts and sources, empty and white-space texts, ties, repeated rows, equal texts, a long text."""
    rng = random.Random(3)
    syllables = [a + b for a in "bdfglmnprst" for b in "aeiou"]

    def sentence(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)) + "."

    def text(lines):
        return "\n".join(sentence(rng.randint(3, 12)) for _ in range(lines))

    rows = []
    for i in range(60):
        rows.append((i, text(rng.randint(1, 12)), rng.choice(["en", "de"]), "big" if i % 3 else f"s{i % 4}"))
    passage = text(9)
    for i in range(60, 72):
        rows.append((i, text(3) + "\n" + passage + "\n" + text(3), "en", "big"))
    base = rows[5][1]
    words = base.split(" ")
    for i in range(72, 78):  # near copies
        changed = list(words)
        changed[rng.randrange(len(changed))] = f"edit{i}"
        rows.append((i, " ".join(changed), "en", "s1"))
    rows += [(78, base, "en", "s2"), (79, base, None, None), (80, base, "en", "s2")]
    rows += [(80, base, "en", "s2")]  # a row as a whole
    rows += [(81, None, None, None), (82, "", "en", "s3"), (83, " \n\t ", "en", "s3")]
    rows += [(None, text(4), "en", "big"), (None, None, None, None), (None, base, "en", "big")]
    rows += [(84, text(900), "de", "s0"), (85, "x" * 30_000, "de", "s0"), (86, "la " * 3_000, "de", "s0")]
    rows += [(10, "another text under a known number", "en", "big")]
    rows += [(87, "One! Two? <|endoftext|> ΣΑΣ é   zeró " + "It's 12,5%", "en", "s1")]
    return rows


@pytest.fixture(scope="session")
def hard(llm, hard_rows):
    """The rows with columns that clash with what the operators produce."""
    from pyspark.sql import functions as F

    df = llm.createDataFrame(hard_rows, SCHEMA).repartition(3)
    extra = ("kept", "shard", "slot", "keep_id", "n_words", "class_id", "epoch", "length", "n_lines", "key", "row")
    return df.withColumns({c: F.lit("mine") for c in extra})


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)
