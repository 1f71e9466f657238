import pytest

#: Texts that operators must get along with, whatever they do.
ODD_TEXTS = [
    None, "", " ", "\n", "\n\n", "a", "One two three four five six seven.", "One two three four five six seven.",
    "É ünï çode 日本語 🙂 text", "x" * 30_000, "word " * 6_000, "<|endoftext|> inside", "tab\tand\x0bvertical\x0cfeed\r\nend",
]


@pytest.fixture
def docs_of(spark):
    """A documents table with the given texts, ids from 0 on, and further columns."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, None if i % 3 == 0 else "en", f"src{i % 2}") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    return make


@pytest.fixture
def odd_docs(docs_of):
    """Odd texts, and among their rows a repeated one and one without an id."""
    texts = [*ODD_TEXTS, ODD_TEXTS[6], "no id"]
    return docs_of(texts, [*range(len(ODD_TEXTS)), 6, None])


@pytest.fixture(scope="session")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")
