"""Small tables with the cases that every operator has to take."""

import random

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; documents may have columns of these names too.
CLASHES = ["node", "key", "row", "kept", "line", "ids", "token_ends", "decoded", "size", "taken", "toxicity", "quality", "label",
           "fingerprint", "part", "edge", "shard", "text_hash", "class_id", "segment", "pairs", "own_id", "times", "copy"]


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randint(0, 99)) for _ in range(n))


def rows():
    """Nulls, empty and blank texts, a long text, equal texts, near copies, repeated rows and shared lines."""
    base, line = prose(60, 1), "This very line is found in many documents."
    near = base.split()
    near[30] = "changed"
    return [
        (1, base, "en", "a", len(base)), (2, " ".join(near), "en", "a", None), (3, base.upper(), "en", "b", 3), (4, None, "en", "a", None),
        (5, "", "en", None, 0), (6, "  \n\t ", None, "c", 5), (7, prose(20_000, 2), "en", "b", 1), (None, prose(30, 3), "de", None, 9),
        (None, None, None, None, None), (8, f"{line}\n{prose(9, 4)}", "en", "a", 1), (9, f"  {line.lower()} \n{line}\nrest", "en", "c", 1),
        (10, f"top\n{line}\nend", "en", "b", 1), (10, f"top\n{line}\nend", "en", "b", 1), (11, "one", "en", "a", 3), (12, "é 日本 'll x's\r\n", "en", "d", 9),
    ]


def documents(spark, clashing=False):
    df = spark.createDataFrame(rows(), SCHEMA)
    if clashing:
        for name in CLASHES:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
