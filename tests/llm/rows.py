"""Rows that every operator must handle."""

#: Null id, null, empty and blank texts, ties, repeated rows, a long text.
ODD = [
    (None, "no id at all here, but ten words or more of text"), (1, None), (2, ""), (3, " \n\t "), (4, "same text"), (5, "same text"),
    (5, "same text"), (6, "one"), (7, "word " * 30_000), (8, "naïve café 日本語 😀 <|endoftext|> end"), (9, "a\x00b \x0b c"),
]
