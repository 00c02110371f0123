"""Shared cases of the training-data tests."""

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def vocab():
    import public_tokenizers
    return public_tokenizers.path


# texts with every shape the operators must bear: null, empty, white space only,
# several kinds of white space, non-Latin scripts, tokens' own strings, long runs
ODD = [None, "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  ", "a  b", "a \n b", "a\n\nb", "a\nb\n", "\na", "tab\t x \t\ty",
       "it's  x 　y", "don't stop's'll ''s", " <|endoftext|> x", "a  <|endoftext|>\n", "x.\n\n\ny .",
       "é à  ö   z", "1,2.3 a1b2-c", "日本 語  です\n", "a'\nb'", "w?\n 'x", " \x1c a\x85 b", "  a   b",
       "▁", "a▁ b ▁▁c", " ▁", "x" * 5000, "ab " * 3000, "🎉🎉 oḱ", "\u0000 nul \u0000", "THE END. The end.\r\nthe END"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "keep", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], "keep", 1), (None, "no id here", "keep", 1),
                                                            (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, ids string, length int")
