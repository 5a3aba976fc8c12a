"""Tables with every awkward row the operators promise to handle."""

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOREM = ("The quick brown fox jumps over the lazy dog near the old river bank while seven small birds watch it from a "
         "tall tree and nobody says a single word about what happened there on that cold and quiet winter morning ")
#: names that clash with what operators use inside
CLASHES = ["count", "rank", "at", "th", "fp", "node", "root", "copy", "size", "key", "score", "words", "_row", "_id", "toxic",
           "open", "bytes", "packed", "held_out", "kept", "weight", "item_id", "label", "value", "block", "u", "text_"]


def awkward_rows():
    long = " ".join(f"{LOREM}{k}" for k in range(1500))  # about 300 KB
    return [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, "   \n\t ", "en", None, 6), (4, "ok", "en", "b", 2),
        (5, LOREM * 3, "en", "b", 9), (5, LOREM * 3, "en", "b", 9), (6, LOREM * 3, None, None, 9), (7, long, "en", "c", 9),
        (8, "x" * 5000, "de", "c", 5000), (9, "12345 !!! ??? 678", "en", "", 17), (None, LOREM + "with no id at all", "en", "a", 9),
        (2**60 + 1, "Ünïcödé ß 漢字 😀 text, naïve café", "fr", "d", 30), (12, None, None, None, None),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"clash {k}").alias(c) for k, c in enumerate(CLASHES) if c not in docs.columns])


def duck(path_of):
    con = duckdb.connect()
    for t, p in path_of.items():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
