import pytest

#: Nulls, empty and long texts, ties and repeated rows, and columns whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, part int, size double, fp string, `range` int, id int, root string, __id int, __text string, __no int, __found string, found string, extra map<string,int>"
#: Long texts: of words, of letters without a space, and 1 MB of letters of three bytes each.
UNSPACED = "abcdefghij" * 30_000
HAN = "漢字語文" * 87_500
LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def odd(spark):
    texts = [
        (1, "The quick brown fox jumps over the lazy dog and runs away."), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, LONG),
        (7, "same text here"), (7, "same text here"), (8, "Same  text\nhere"), (None, "no id at all"), (None, None), (9, "éà ß 漢字 \U0001f600 word"),
        (13, UNSPACED), (14, HAN), (15, "one more word"), (15, "one more word"),
        (10, "word"), (-5, "negative id words to count"), (12, "one two three four five six seven eight nine ten"),
    ]
    rows = [(i, t, ["en", None, "fr"][k % 3], [None, "a", "b", "Z"][k % 4], None if t is None else len(t), "k", 1, 2.0, "x", 3, 4, "r", k, "t", 5, "f", "g", {"k": k}) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
