import random
import re

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, t string, count long, digest string"


def words(text):
    return [] if text is None else re.findall(r"[^\x20\x09-\x0D]+", text)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="session")
def edge_docs():
    """Nulls in every column, empty and long texts, ties, repeated rows; a hot source and a hot group of copies."""
    rng = random.Random(7)
    vocab = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    base = [text(rng.randint(1, 90)) for _ in range(40)]
    rows = [(i, base[i % 40] if i % 3 else "Hot COPY of one Line\nand é another", "en" if i % 2 else "fr",
             "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(120)]
    rows += [(200, None, None, None), (201, "", "en", "s1"), (202, " \t\n", None, "s1"), (None, "null id here", "en", None),
             (None, None, None, None), (203, text(6000), "de", "s2"), (204, "Ünï ÉCOLE École", "fr", "s0"),
             (205, "ünï École École", "fr", "s0"), (206, "HOT copy of one line\nand é another", "en", "hot"),
             (207, "日本語 テキスト <|endoftext|> x", "ja", "s3"), (5, base[5], "en", "s1"), (5, base[5], "en", "s1")]
    return [(*r, None if r[1] is None else len(r[1]), 1, "x", 2, "y") for r in rows]


@pytest.fixture()
def edge(spark, edge_docs):
    return spark.createDataFrame(edge_docs, SCHEMA)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
