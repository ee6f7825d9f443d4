import random

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names operators might use for themselves.
CLASHING = (
    "row_number", "block", "words", "counts", "quality", "near", "found",
    "counted", "kept_lines", "reference", "row", "seq", "length", "n",
)


def sentence(rng, words, length):
    return " ".join(rng.choice(words) for _ in range(length))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, blanks, repeats, copies and a long text."""
    rng = random.Random(5)
    words = [
        "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7)))
        for _ in range(300)
    ]
    base = [sentence(rng, words, 70) for _ in range(12)]
    passage = sentence(rng, words, 55)
    line = sentence(rng, words, 12)
    texts = [
        *base,
        base[0],
        base[1].replace(" ", "\n", 3),
        base[2].upper(),
        base[3] + " " + words[0],
        base[4] + "\n" + passage + "\n" + line,
        passage + " " + base[5],
        sentence(rng, words, 10) + " " + passage,
        base[6] + "\n" + line + "\n" + base[7],
        "\n".join([line, "", line, line, " \t", "x", "x"]),
        None, "", " ", "\n\n", "  a  b ▁c\t d", "one", "one two three",
        "日本語 \U0001f600 é é ΣΑΣ <|endoftext|>",
        "a " * 400, "#*$%& " * 30, " ".join([passage] * 3),
        "\n".join(sentence(rng, words, 9) for _ in range(300)),
    ]
    rows = [
        (k, text, ("en", "de", None)[k % 3], f"s{k % 2}", len(text or ""))
        for k, text in enumerate(texts)
    ]
    rows += [rows[0], (None, base[8], None, None, None), (3, base[9], "en", "s", 1)]
    return rows


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def clean_rows(odd_rows):
    """The rows with a doc_id of their own."""
    seen, out = set(), []
    for row in odd_rows:
        if row[0] is not None and row[0] not in seen:
            seen.add(row[0])
            out.append(row)
    return out


@pytest.fixture(scope="session")
def clean_documents(spark, clean_rows):
    return spark.createDataFrame(clean_rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def sf_dir(tmp_path, clean_documents):
    """A folder with the table documents."""
    clean_documents.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.fixture(scope="session")
def clashing():
    """Adds columns named like those that operators use."""
    from pyspark.sql import functions as F

    return lambda docs: docs.withColumns({name: F.lit(name) for name in CLASHING})
