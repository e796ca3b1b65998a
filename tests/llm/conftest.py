

ODD = [(None, None, None, None), (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "fr", None),
       (4, "one", "en", "b"), (5, "Déjà vu — naïve 😀 ﬁn x y\x1cz\x85w", "fr", "b"),
       (6, "12 34 !!", "de", "c"), (7, "word " * 30000, "en", "c"), (8, "same text here now ok", "en", "d"),
       (9, "same text here now ok", "en", "d"), (9, "same text here now ok", "en", "d"), (10, "x" * 3000, "es", "e"),
       (11, "don't  stop   \n\n  we'll\tgo 1234567 ÄÖÜ ſK", "de", "e")]


def odd_documents(spark, extra=False):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    if extra:  # names that the operators use themselves
        for c in ("chunk", "word", "flag", "n", "shard", "slot", "score", "lang_pred", "n_shingles", "_text", "id"):
            df = df.selectExpr("*", f"'x' as `{c}`")
    return df
