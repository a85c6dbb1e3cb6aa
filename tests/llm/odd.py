"""Odd documents that every operator on texts has to take."""

ODD_TEXTS = [
    None, "", " \t\n ", "one", "a b c d e", "###", "日本語 テキスト", "\x1c\x85\u2028 odd\u00a0spaces",
    "the same words again and again " * 4000, "x" * 200_000, "Word" + "\n" * 5000 + "end",
]
# Columns whose names an operator uses itself.
SCHEMA = "doc_id long, text string, lang string, n long, sig long, score string, label string"


def odd_documents(frame, first=1000):
    rows = [(first + i, t, None, None, 1, "x", "y") for i, t in enumerate(ODD_TEXTS)]
    rows += [(first + 3, "one", None, 2, 2, "z", "w")] * 2 + [(None, "no id", None, 1, 1, "", "")]
    return frame(SCHEMA, *rows)


def no_documents(frame):
    return frame(SCHEMA)
