"""Small inputs for the training-data operators: every odd case in one table."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the thing of the other and the water was in the house where they were all the time with some of the others "
FR = "le chat et la souris dans une maison avec des enfants qui ne sont pas les amis du roi mais de la reine "


def odd_documents(spark, more=()):
    """NULLs in every column, empty and blank texts, a very long one, repeated rows and ids."""
    rows = [(1, EN * 3, "en", "a", 10), (2, None, "en", "a", None), (3, "", "en", None, 0), (4, "   \n\t ", None, "b", 5),
            (5, "x" * 70_000, "en", "b", 70_000), (6, FR * 3, "fr", "b", 1), (7, FR * 3, "fr", "b", 1), (7, FR * 3, "fr", "b", 1),
            (8, "Re.", "en", "a", 3), (None, EN * 4, "en", "a", 7), (9, "日本語 テキスト 1 2 3 <|endoftext|> ok", "ja", "c", 1),
            (10, EN * 400, "en", "a", 1), *more]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """Extra columns with names that an operator also uses."""
    for name in names:
        df = df.withColumn(name, df[df.columns[0]])
    return df
