from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = ("k", "key", "h", "n", "bucket", "shard", "slot", "spans", "component", "line_no", "length", "offset", "rank", "node", "size", "kept", "label", "n_words", "n_lines", "n_symbols", "key2", "_key", "_turn", "_doc", "_lines", "_lost", "_left", "row", "left", "lost", "doc", "turn", "lines", "redacted", "_row")


@pytest.fixture(scope="session")
def make(spark):
    """docs from (doc_id, text) pairs, with other columns null or clashing."""

    def build(rows, clash=False):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], SCHEMA)
        return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clash else df

    return build


WORDS = "the dam wall was built in stone and earth before any river flood could reach its lower gate or spill over into old town".split()


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and blank texts, ties, repeated rows, and a very long text with a very long word."""
    long = " ".join(f"{w}{i % 97}" for i in range(4000) for w in WORDS[:9]) + " " + "x" * 5000
    text = " ".join(WORDS) + "\nsecond line of the text here\n\n" + " ".join(reversed(WORDS))
    return make([(1, text), (1, text), (2, text), (3, None), (None, text + " more"), (None, None), (4, ""), (5, " \t\n "), (6, long), (7, text.replace("stone", "mud"))], clash=True)


@pytest.fixture(scope="session")
def none(make):
    return make([])
