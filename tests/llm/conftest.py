import random

import pytest

WORDS = [a + b for a in "the re on an in is er".split() for b in "tion ed ing ble sh nd ou wh".split()]


def prose(seed, n):
    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) + str(dice.randrange(99)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    """A folder with small tables: nulls, empty, short and long texts, copies, near copies, shared passages, extra columns."""
    a, b, passage = prose(1, 120), prose(2, 400), prose(3, 60)
    near = a.split()
    near[60] = "changed"
    long = prose(4, 12_000)
    texts = [None, "", " \n\t ", "one two", a, a, " ".join(near), b + " " + passage, prose(5, 80) + "\n" + passage + "\n" + prose(6, 90),
             passage, long, "Mail joe@example.org or +49 30 1234567, card 4111 1111 1111 1111, ip 10.0.0.300 and 10.0.0.3 é",
             "%%% ### word%%% " * 40, "twice twice twice twice " * 20, "x <|endoftext|> y  \n z", "iban GB82 WEST 1234 5698 7654 32",
             passage + " tail", prose(7, 51)]
    rows = [(i, t, "en" if i % 2 else None, "s", 0, "clash") for i, t in enumerate(texts)] + [(17, prose(7, 51), "en", "s", 0, "clash")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i not in (12, 13)), 0) for i in range(4, 17)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    urls = [None, "nothing", "http://a.net", "http://a.NET/x", "https://www.example.net/en/1?x=1", "http://example.com/de/?q", "ftp://b.org/fr/a#t",
            "http://badnet/en/", "http://notexample.com/de/"] * 2
    spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(
        f"{folder}/pages.parquet")
    dice = random.Random(9)
    vectors = [[dice.gauss(0, 1 + j) for j in range(6)] for _ in range(60)]
    vectors += [None, [], [1.0] * 5 + [None], [float("nan")] * 6, [float("-inf")] + [0.0] * 5, [-0.0] * 6, *[vectors[0]] * 40, vectors[1],
                *[[dice.random(), 1.0] for _ in range(5)], [3.0]]
    spark.createDataFrame([(i, v, 0, "clash") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, n string").repartition(
        3).write.parquet(f"{folder}/embeddings.parquet")
    items = [(0, "one two"), (1, None), (2, ""), (3, "Twice x É é endoftext"), (4, passage), (4, a), (5, "unseen ~~~ term"), (6, long), (None, "iban 10"), (7, "...")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(spark, corpus, tmp_path_factory):
    """The same tables without rows."""
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "pages", "embeddings", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder
