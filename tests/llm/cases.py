"""Rows that every operator must take."""

EDGE_ROWS = [
    (1, "The same text twice."),
    (1, "The same text twice."),
    (None, "No id here."),
    (2, None),
    (3, ""),
    (4, "   "),
    (5, "word " * 30_000),
    (6, "The same text twice."),
    (7, "Zeile eins\nZeile zwei\n\n\nZeile eins"),
    (8, "tab\t\tand  two spaces   and é́ Σας <|endoftext|> end"),
]
