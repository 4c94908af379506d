"""Small awkward tables."""

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, turns int, label int, node bigint, sequence_id bigint, quality string, band int"
EXTRA = ("x", 1, 2, 3, 4, "q", 5)  # columns whose names the operators use themselves
LONG = " ".join(f"word{k % 977} and{k % 13}" for k in range(20000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again until noon", "en", "a", 70),
    (2, "the quick brown fox jumps over the lazy dog again and again until noon", "en", "a", 70),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, LONG, "en", "a", len(LONG)),
    (6, "two words", "de", "b", 9),
    (7, " \n \n ", "de", "b", 5),
    (8, "Ünïcödé ﬁ 漢字 <|endoftext|> it's We'LL 1234 ½ \t x", "fr", "b", 40),
    (8, "Ünïcödé ﬁ 漢字 <|endoftext|> it's We'LL 1234 ½ \t x", "fr", "b", 40),
    (9, "a" * 3000, "fr", "c", 3000),
    (None, "no id here but words enough to make a few shingles of five", "es", "c", 50),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCUMENTS)
