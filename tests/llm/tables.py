"""Small tables for the tests of the operators."""

import random

CLASHES = ["id", "row", "n", "tk", "hash", "bucket", "component", "key", "found", "runs", "items", "n_words", "vote", "host", "size", "q", "v", "__kept", "__id"]
WORDS = "the of and to in that was he it is his on with as at by be had not are but from or have an they which one you".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "a", "er", "ing", "ß", "é"]) for _ in range(n))


def documents(spark, rows, clash=True):
    """(doc_id, text, lang, source, n_chars) and columns whose names operators may use themselves."""
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t) if t is not None else None, *(["x"] * len(CLASHES) if clash else [])) for i, t in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in (CLASHES if clash else []))
    return spark.createDataFrame(full, names)


def hard_rows():
    """Nulls, empty and blank texts, repeated rows, ties, a very long text, a null id."""
    text = prose(1, 60)
    return [
        (4, text), (2, None), (3, ""), (5, " \n\t"), (7, text), (7, text), (6, text + " " + prose(2, 3)), (8, prose(3, 40000)), (None, text),
        (None, None), (9, "word"), (10, "two words"), (11, text.upper()), (12, prose(3, 40000) + " end"),
    ]
