import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "id bigint, h string, size string, score string, fp string, component_id string, place string, row string, part string, tokens string")


def sentence(seed: int, words: int) -> str:
    """Made-up words that do not repeat between seeds."""
    return " ".join(f"w{seed}x{i * 7919 % 10007}" for i in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, and columns with clashing names."""
    long_text = "\n".join(sentence(900 + i % 50, 40) for i in range(1500))
    texts = [(1, sentence(1, 60)), (2, sentence(1, 60)), (2, sentence(1, 60)), (3, None), (4, ""), (5, " \n\t \n"), (None, sentence(2, 30)),
             (6, sentence(2, 30)), (7, long_text), (8, "é" * 3000), (9, "short"), (10, sentence(3, 80) + "\n" + sentence(4, 20)), (None, None)]
    rows = [(i, t, "en" if i else None, None if i is None or i % 2 else "a", None if t is None else len(t), 5, *["x"] * 9) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
