import pytest
from pyspark.sql import functions as F

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards boil jugs of quiet vexing "
    "zinc and my big sphinx of quartz hears every vow that the five boxing judges make"
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(n, seed=0):
    """n words of a fixed pseudorandom order."""
    words, state, out = PROSE.split(), 12345 + 7919 * seed, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(words[(state >> 8) % len(words)] + str((state >> 16) % 50))
    return " ".join(out)


def rows():
    """Nulls in every column, empty, blank and long texts, copies, near copies and repeated rows."""
    shared = sentence(120, seed=1)
    near = shared.split()
    near[60] = "changed"
    texts = [
        (1, shared),
        (2, shared),
        (3, " ".join(near)),
        (4, ""),
        (5, " \t\n "),
        (6, None),
        (None, shared),
        (None, None),
        (7, "one two three"),
        (8, "One TWO three"),
        (9, sentence(60, seed=2) + "\n" + shared + "\n" + sentence(60, seed=3)),
        (10, sentence(4000, seed=4)),
        (11, sentence(300, seed=5)),
        (11, sentence(300, seed=5)),
        (12, "a b c d " * 100),
        (13, "line one here\n" * 40 + "### $$$ %%% &&&"),
        (14, "é ñ 日本 <|endoftext|> don't  stop now\x1f ok " + sentence(80, seed=6)),
        (15, shared.upper()),
    ]
    sources = ["a", "a", "b", "a", None, "b", "a", None, "c"]
    return [
        (i, t, None if n % 5 == 0 else "en", sources[n % len(sources)], None if t is None else len(t))
        for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """The rows, with further columns whose names operators may use inside."""
    made = spark.createDataFrame(rows(), SCHEMA)
    clashing = "kept score predicted shard slot ids row doc start size node key word n gram rejected_by".split()
    return made.withColumns({name: F.lit("own") for name in clashing}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
