import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LINE = "A line that five documents or more have in common, long enough"
PASSAGE = " ".join(f"word{k}" for k in range(60))


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, copies, near copies, a repeated row, shared lines and passages."""
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    base = " ".join(f"base{k}" for k in range(120))
    texts = [None, "", " \t\n ", "\n\n\n", "12 34 !!", "one", "one two", "one two three", "ONE two Three", long, long + " tail",
             base, base, base.replace("base7 ", "other "), base.upper(), base + " and more", "é ü ñ 日本語 😀\x00\x0b",
             "a" * 5_000, PASSAGE, "start " + PASSAGE + " end", PASSAGE + "\n" + PASSAGE, "ab " * 200, "ab " * 150]
    texts += [f"{LINE}\nown {k}\n \t{LINE.upper()}\r" for k in range(7)]
    rows = [(k, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "src0", len(t) if t and k % 3 else None) for k, t in enumerate(texts)]
    return [*rows, rows[11], rows[12], rows[23]]


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    """Tables here are small: most of a test's time would go into empty tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def crowded(awkward):
    """The same rows with columns named like those that the operators make."""
    names = ("n_lines n_dropped n_words n_removed n_shingles component_id kept lang_pred score row copy doc node a b position bitmap "
             "spans slots key h seed item place words tokens rest task slot").split()
    return awkward.withColumns({n: F.lit(k) for k, n in enumerate(names)})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark_items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")
