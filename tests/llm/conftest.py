import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, component_id string"


def words(n, seed, stems=("th", "er", "on", "an", "re", "ti", "es", "or")):
    r = random.Random(seed)
    return ["".join(r.choice(stems) for _ in range(r.randint(1, 4))) for _ in range(n)]


def document_rows():
    """Copies, near copies, ties, nulls in every column, empty and long texts."""
    base = words(120, 1)
    near = [*base[:60], "changed", *base[61:]]
    far = [*base[:30], *words(90, 2)]
    passage = "\n".join(" ".join(words(12, 50 + i)) for i in range(6))
    texts = [
        " ".join(base), " ".join(near).upper(), " ".join(far), " ".join(base), "", None, "   \t\n", "one two", "One\tTWO", "one two three",
        "lead in\n" + passage + "\nlead out", "other lead\nand more\n" + passage + "\nother end", " ".join(words(9000, 3)), "same line\n" * 40, "a b c " * 60,
        "é ñ 漢字 😀 don't we'll <|endoftext|> x's  \n\n y", "# $ % & | < > *" * 30, " ".join(words(55, 4)), " ".join(words(60, 5)), " ".join(words(70, 6)),
    ]
    rows = [(i + 1, t, "en", f"src{i % 3}", len(t or ""), 1, "x", "y") for i, t in enumerate(texts)]
    rows.append((None, "no id here", None, None, None, None, None, None))
    rows.append((21, " ".join(base), None, None, None, None, None, None))
    rows.append((3, " ".join(far), "en", "src2", 1, 1, "x", "y"))  # a repeated row
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(document_rows(), DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)
