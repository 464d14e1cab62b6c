import re

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside; a table may have them as further columns.
CLASHES = ["part", "class", "kappa", "n", "spans", "rate", "label", "id", "v", "q", "keep", "tokens"]


@pytest.fixture
def docs(spark):
    """A table of documents from (id, text) pairs, with further columns of clashing names."""

    def make(pairs, clash=True):
        frame = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in pairs], DOCS)
        return frame.withColumns({c: F.lit("x") for c in CLASHES}) if clash else frame

    return make


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
