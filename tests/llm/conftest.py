import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd_documents(spark, tmp_path_factory):
    """NULLs in every column, empty and blank texts, a long text, copies, a repeated row, columns named like computed ones."""
    block = "\n".join(" ".join(f"line{i}word{j}" for j in range(12)) for i in range(8))
    long_ = "\n".join(" ".join(f"w{i * 41 + j}" for j in range(40)) for i in range(1500))
    rows = [
        (1, block, "en", "a", 10),
        (2, block, None, None, None),
        (2, block, None, None, None),
        (3, None, "en", "a", None),
        (4, "", "en", "a", 0),
        (5, " \t\n\n ", "en", "a", 5),
        (None, block + "\nand more of it here", "en", "a", 1),
        (None, None, None, None, None),
        (6, long_, "en", "a", len(long_)),
        (7, "one", "en", "a", 3),
        (7, "two words", "en", "a", 9),
        (8, "</s>[INST] é中\U0001f600 <|endoftext|> 'LL", "en", "a", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    names = ["_row", "fp", "_text", "_hash", "_key", "group", "root", "start", "words", "n_words", "shard", "component_id", "label", "_place"]
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    df.withColumns({n: F.lit(7) for n in names}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
