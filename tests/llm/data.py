"""Small awkward tables for the training-data operators."""

import random

WORDS = "the of and ingon thea erre lyre ontion heed shan bleath tion erly anhe reer ouble stlynt".split()

#: Names that operators use inside; an input may have such columns too.
CLASHES = ("fp", "size", "block", "row", "key", "n", "place", "draw", "label", "share", "doc", "count", "quota", "t1")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def awkward_rows(seed=1, n=40):
    """(doc_id, text, lang, source) with nulls, empty and long texts, copies and repeats."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 150)), rng.choice(["en", "de"]), f"s{i % 3}") for i in range(n)]
    body = prose(rng, 120)
    rows += [
        (100, None, None, None), (101, "", "en", "s0"), (102, " \t\n\x0b\f\r ", "en", "s1"), (103, "x", "en", None),
        (104, body, "en", "s0"), (105, body, "en", "s0"), (105, body, "en", "s0"), (None, body, "en", "s0"), (None, None, None, None),
        (106, body + " one more word", "en", "s1"), (107, prose(rng, 40_000), "en", "s2"), (108, "É è 漢字 🎉 ñ " * 30, "fr", "s2"),
        (109, "%%% *** ### 12345 67890", None, "s0"), (110, "same line\n" * 50, "en", "s1"), (111, "a" * 5000, "en", "s1"),
        (112, "word " * 500, "en", "s1"), (113, "bell \x07 nul \x00 unit \x1f nbsp \xa0 nel \x85 sep   end", "en", "s0"),
    ]
    return rows


def documents(spark, rows):
    clash = tuple("x" for _ in CLASHES)
    return spark.createDataFrame([(i, t, l, s, None if t is None else len(t), *clash) for i, t, l, s in rows], SCHEMA)
