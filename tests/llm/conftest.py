import pytest

#: Rows with nulls, empty and very long texts, repeated rows, and extra columns whose names operators use themselves.
EXTRA = "id string, label int, score double, key string, component string, row_key int, base string, spans string, fp long"


@pytest.fixture(scope="session")
def awkward(spark):
    texts = ["The quick brown fox jumps over the lazy dog", "The quick brown fox jumps over the lazy dog", None, "",
             " \n\t ", "é 😀 ünïcode Text", "word " * 30_000, "x" * 100_000, "mail a.b@example.com or +1 (555) 123-4567",
             "Released under the MIT License.\nmore", "<|endoftext|> twice <|endoftext|>", None]
    ids = [1, 1, 2, 3, 4, 5, 6, 7, None, 9, 10, None]
    rows = [(i, t, None, "src", len(t) if t else None, "x", 1, 0.5, "k", "c", 7, "b", "s", 3) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
