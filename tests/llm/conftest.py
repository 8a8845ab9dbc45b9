import pytest

#: A row of odd cases for every operator on documents: NULL, empty, blank, short, copies, extra columns.
LONG = " ".join(f"word{i % 97}x{i} and the of" for i in range(30_000))


@pytest.fixture(scope="session")
def documents(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from that noisy crowd of people "
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 3), (4, "One.", "en", "b", 4),
        (5, base * 3, "en", "a", 1), (6, base * 3, "en", "a", 1), (7, base * 3 + "Änderung", "de", "c", 1),
        (8, "der hund und die katze gehen nicht mit dem alten mann zu der stadt " * 5, "de", "b", 1),
        (9, LONG, "en", None, 1), (10, "12345 %% ## || 678", "de", "c", 1),
        (5, base * 3, "en", "a", 1), (None, "no id but some text here", "en", "b", 1),
        (11, "x" * 5_000, "en", "a", 1), (12, "\n".join(["same line of words"] * 40), "en", "b", 1),
    ]
    # columns that the operators use inside
    wide = [r + ("k", 1.5, "w", 7) for r in rows]
    return spark.createDataFrame(
        wide, "doc_id long, text string, lang string, source string, n_chars long, text_key string, score double, words string, size long")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [
        (1, "Jumps over the lazy dog and runs far away from that NOISY crowd"), (2, None), (3, ""),
        (4, "lazy dog"), (5, "nothing here occurs in any of the given texts at all today"),
        (6, "jumps over the lazy dog and runs far away from that noisy crowd"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")
