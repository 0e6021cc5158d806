"""Small inputs for the tests: awkward texts and columns whose names clash."""

LONG = "one two three four five six seven eight nine ten " * 400
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line here for all.\n\n"),
    (2, "second LINE here for all.  \nAnother line that stands alone\nshort\nshort"),
    (3, None), (4, ""), (5, " \t\n \x0b "), (6, LONG), (7, LONG), (8, "ü É 漢字 <b>& ### $$$ !!\r\n\tÉ É É"),
    (9, "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line here for all.\n\n"),
    (None, "no id but a line of some length"), (11, "no id but a line of some length"),
    (12, "a b c d e " * 3), (13, "x"), (13, "x"), (14, "Second line here for all."),
]
SCHEMA = "doc_id long, text string"
CLASH = "doc_id long, text string, doc long, body string, key int, row int, score double, n_lines int, n int, comp int, items int, words int, kept int"


def docs(spark, rows=TEXTS, clash=False):
    if clash:
        return spark.createDataFrame([(i, t, 1, "b", 2, 3, 0.5, 9, 4, 5, 6, 7, 8) for i, t in rows], CLASH)
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
