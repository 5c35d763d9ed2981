import pytest

pytest.importorskip("headway.llm")

LONG = " ".join(f"w{i * i % 7919}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
DOCS = [
    (1, "alpha beta", "en", "a", 10), (1, "alpha beta", "en", "a", 10), (None, "alpha beta gamma", "en", "a", None), (2, None, None, None, None),
    (3, "", "en", "a", 0), (4, " \t\n\x0b\x0c\r ", "en", "b", 7), (5, LONG, "en", "b", len(LONG)), (6, LONG + " tail", "en", "b", 1), (6, LONG + " tail", "en", "b", 1),
    (7, f"one two {PASSAGE} three", "en", "a", 1), (8, f"four {PASSAGE} five\nsix", None, "c", 1), (9, PASSAGE + " " + PASSAGE, "en", None, 1),
    (10, "É x <|endoftext|> It's 42! ΑΣ KK <|startoftext|>y", "en", "c", 1), (11, "Licensed under CC BY-NC 4.0.\nAll rights\nreserved. cc by", "en", "c", 1),
    (12, "released under the\nMIT License. Released under the MIT License", "en", "c", 1), (13, "😀 😀 😀 😀 ### %%", "en", "c", 1),
    (14, "\n".join(["same line here"] * 40), "en", "c", 1),
] + [(100 + i, "a shared line of many documents\n" + " ".join(f"u{i}x{j}" for j in range(60)), "en", "host", 1) for i in range(30)] + [
    (200, "a shared line of many documents\n" * 12 + "short own text of this one", "en", "host", 1),
    (300, " ".join(f"v{j}" for j in range(200)), "en", "b", 1), (301, " ".join(f"v{j}" for j in range(203)), "en", "b", 1),
]
PAGES = [
    (1, "http://user@Sub.Example.com:80/news/a.html?x", "<html><body><nav>menu</nav><article><h1>Title</h1><p>First &amp; last<br>line</p></article></body></html>"),
    (1, "http://user@Sub.Example.com:80/news/a.html?x", None), (None, None, ""), (2, "not a url", "<p>" + "long text " * 20_000), (3, "https://example.com./", "<div class=ad>x</div>"),
]
PLAIN = [(i, [((i * 7 + j) * 37 % 101 - 50) / 40 for j in range(16)], i * i % 5) for i in range(0, 400, 3)]
VECTORS = PLAIN + PLAIN[:4] + [
    (1000 + i, PLAIN[1][1], 1) for i in range(40)] + [  # a large group of copies
    (1, None, 1), (2, [], 1), (4, [float("nan")] + [1.0] * 15, 1), (5, [float("-inf")] * 16, 2), (7, [None] + [1.0] * 15, 3), (None, [0.5] * 16, 1), (None, [0.5] * 16, 1),
    (50, [0.25] * 16, None), (100, [1e30] * 16, 1), (200, [1.0] * 8, 1), (202, [2.0] * 8, 1), (203, [1.5] * 8, 2), (250, [1.0, 2.0], 1), (350, [0.0] * 16, 4),
    (400, [30000.0] * 16, 2), (401, [20000.5] * 16, 2), (402, [15000.25] * 16, 3),
]
LABELS = [(1, 1, 0), (1, 0, 1), (7, None, 1), (None, 1, 1), (8, 1, 0), (9, 0, 1)]


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """A folder of odd tables, and one of empty ones. Extra columns have names that the operators use themselves."""
    clash = ", 1L AS row_id, 'x' AS text_md5, 2L AS mark, 'y' AS TARGET, 3L AS taken, 4 AS kept, 'z' AS row_key, 5 AS block, 'h' AS host, 6 AS size"
    out = []
    for many in (1, 0):
        folder = str(tmp_path_factory.mktemp("tables"))
        docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long").limit(len(DOCS) * many)
        docs.createOrReplaceTempView("odd")
        spark.sql(f"SELECT *{clash} FROM odd").write.parquet(f"{folder}/documents.parquet")
        pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").limit(len(PAGES) * many)
        pages.selectExpr("*", "1L AS row_id", "'t' AS text", "2 AS n_chars").write.parquet(f"{folder}/pages.parquet")
        vectors = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>, label int").limit(len(VECTORS) * many)
        vectors.selectExpr("*", "1L AS v", "true AS is_anchor", "2 AS _label", "'c' AS code", "3 AS error", "4 AS block").write.parquet(f"{folder}/embeddings.parquet")
        spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").limit(len(LABELS) * many).write.parquet(f"{folder}/labels.parquet")
        out.append(folder)
    return out
