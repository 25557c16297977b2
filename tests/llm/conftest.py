import pytest

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def given(spark):
    """doc_id -> (text, lang, source) of the smallest table."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {r["doc_id"]: (r["text"], r["lang"], r["source"]) for r in rows}


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts or (doc_id, text, lang, source) rows."""

    def build(*rows):
        full = [
            (i, r, "en", "src0") if r is None or isinstance(r, str) else r for i, r in enumerate(rows)
        ]
        full = [(*r, None if r[1] is None else len(r[1])) for r in full]
        return spark.createDataFrame(full, COLUMNS)

    return build


#: Texts that every operator meets: nothing, blanks, one word, no letter, wide
#: characters, one very long word, one very long text.
ODD = [
    None, "", " \n\t ", "word", "123 ... 456", "été ß 漢字 ́x 😀", "a" * 50_000,
    "the same words again and again\n" * 4_000,
]


@pytest.fixture(scope="session")
def odd(make):
    """Odd texts, twice each, NULL ids and labels among them."""
    rows = [(i, x, "en", "src0") for i, x in enumerate(ODD)]
    rows += [(i, x, "en", "src0") for i, x in enumerate(ODD)]
    rows += [(None, "a row without an id", None, None), (None, None, None, None)]
    return make(*rows)
