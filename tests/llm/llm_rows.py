"""Rows shared by the tests of this folder."""

#: Rows every operator on texts must take: nulls, empty, blank, marks only, repeats, a very long text.
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "...,;"), (5, "a"), (5, "a"), (None, "no id here"), (7, "word " * 30_000),
    (8, "x" * 200_000), (9, "  two  spaces and\r\nbreaks\n\n"), (10, "naïve café über ß ▁mark 日本語 \x00  end"),
    (11, "<s> </s> <unk> <|endoftext|>"), (-3, "negative id"),
]


def texts(sp, rows):
    return sp.createDataFrame(rows, "doc_id long, text string")
