"""Small tables that the tests of this folder share."""

SF = "/root/testdata/sf0.001"
SF_TRAIN = "/root/testdata/sf0.01"

DOCS_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               # names that the operators use inside
               "bucket int, owner long, row string, shard int, slot int, words string, found string, hashes string, "
               "band int, tile long, score string, piece int, start long, part string, id long, n string")


def make_docs(spark, texts):
    """A documents table with clashing extra columns from (doc_id, text) rows."""
    rows = [(i, t, "en", "s", len(t or ""), 1, 2, "r", 3, 4, "w", "f", "h", 5, 6, "x", 7, 8, "p", 9, "n") for i, t in texts]
    return spark.createDataFrame(rows, DOCS_SCHEMA)


BASE = " ".join(f"w{i}" for i in range(60))
EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, "One"), (6, "a b c d"), (7, "a b  c\td"), (8, BASE),
    (9, BASE), (10, BASE.replace("w3 ", "x ")), (11, "lead " + BASE), (12, "the " * 3000), (13, "the " * 2500 + "end"),
    (14, " ".join(f"v{i % 977}q{i}" for i in range(30000))), (15, "y" * 20000), (16, "日本語 テスト ▁x É é"),
    (17, "<|endoftext|> it's a\x1fb \x00"), (18, "a b c d e"), (19, "a b c d e f"), (20, " ".join(["p q"] * 40)),
    (-5, "negative id " + BASE), (21, "😀" * 7),
]
#: The same with repeated rows and rows without an id.
ROUGH_TEXTS = [*EDGE_TEXTS, (8, BASE), (4, "one"), (None, "no id here"), (None, BASE), (None, None)]
