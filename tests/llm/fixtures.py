"""Small documents with the cases every operator has a defined result for."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, host string, site string"


def tricky(seed: int = 1, n: int = 60) -> list[tuple]:
    """NULLs in every column, empty, blank and long texts, copies, near copies, repeated rows."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "and", "é", "ß,"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(n)]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text))
        if i % 5 == 0:
            rows.append((1000 + i, text.upper()))
            rows.append((2000 + i, text))
        if i % 4 == 0:
            parts = text.split()
            parts[rng.randrange(len(parts))] = "changed"
            rows.append((3000 + i, " ".join(parts)))
            rows.append((4000 + i, text + " more"))
    rows += [(5000, ""), (5001, None), (5002, "  \t\n "), (5003, "one"), (5004, "one two"), (5005, "one two")]
    rows += [(5006, "long " * 5000 + "end"), (5007, "x" * 20000), (None, "no id here"), (None, texts[0])]
    rows += [rows[3], rows[3], (-7, texts[1])]
    full = [(i, t, None if k % 7 == 0 else "en", None if k % 9 == 0 else "s", None, "h", "x") for k, (i, t) in enumerate(rows)]
    return full
