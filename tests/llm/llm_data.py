"""Small tables with every awkward case the operators define a result for."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, file string, at string, key string, "
        "size string, score string, kept string, label string, node string, copies string")
CLASH = ("f", "a", "k", "z", "s", "t", "l", "n", "c")


def prose(seed, words=120, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}{'é' if rng.random() < .1 else ''}" for _ in range(words))


def edge_rows():
    base, other = prose(1), prose(2)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    texts = [base, base, base.upper(), near, other, None, "", "   ", "one", "one two three", "ONE  two\tthree",
             "a\n\nb\n a ", prose(3, 20000), base + "\n" + other, "x" * 900, "x" * 900, "é" * 300, "<|endoftext|> it's",
             "don't   stop ▁now　 ", other + " tail", "\x00\x1f"]
    rows = [(i, t, "en", (None, "b", "a")[i % 3]) for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, other, None, None), (None, base, "en", "a"), (500, None, None, "b")]
    return rows


def edge_docs(spark, rows=None):
    rows = edge_rows() if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1] or ""), *CLASH) for r in rows], DOCS)


def empty_docs(spark):
    return edge_docs(spark, [])


def key(row):
    return tuple((v is None, str(type(v)) if v is None else v) for v in row)


def same_rows(got, expected):
    got, expected = sorted(map(tuple, got), key=key), sorted(map(tuple, expected), key=key)
    assert got == expected
