"""Documents with the awkward cases, beside an extra column whose name the operators use themselves."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, line string, size long"


def prose(seed: int, words: int, per_line: int = 12) -> str:
    choose = random.Random(seed)
    said = ["".join(choose.choice("bcdfgklmnprstv") + choose.choice("aeiou") for _ in range(choose.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(said[i : i + per_line]) + "." for i in range(0, words, per_line))


def documents(spark, *texts, start: int = 0):
    rows = [(start + i, t, "en", f"src{i % 3}" if i % 5 else None, None if t is None else len(t), "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


TEXTS = [
    None, "", " \n\t ", "one", "Ünïcödé ßtraße 中文 words here.", prose(1, 80), prose(1, 80), prose(2, 3000), "same line.\nsame line.\nother line.",
    prose(3, 60), "a  b   c\r\n\x85 d   ", "x" * 5000,
]


def awkward(spark):
    """All of these, a row twice, a null id, and an id with two texts."""
    df = documents(spark, *TEXTS)
    more = [(5, TEXTS[5], "en", "src2", 1, "x", 7), (None, "no id here.", "en", "src1", 1, "x", 7), (9, "another text.", None, None, None, None, None)]
    return df.union(spark.createDataFrame(more, SCHEMA)).repartition(3)
