import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import public_tokenizers  # noqa: E402
import pytest  # noqa: E402

SF = "/root/testdata/sf0.001"

#: Texts with the corners that every operator must bear.
TEXTS = [None, "", " ", "\n\n \t", "12 34 %% 5", "one", "One two THREE", "a b c d e", "A b  c\u00a0d\u3000e f\n\ng  \n h ", "x" * 5000,
         "<|endoftext|> in <|endoftext|>text<|im_end|>", "é\u2028ü ß\u0085z \U0001F600 日本語 текст", "the same line\n" * 40, "na " * 300,
         "zero\x00byte and\x1fseparators\x1c here", " ".join(f"word{i % 701}" for i in range(40_000)), "don't I'll we've HE'S 1,000.50 ...  !!"]


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def corner_docs(spark):
    """Corner texts, each twice under its id, null ids and columns named like results."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", sys.path[0])
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, i, "extra") for i, t in enumerate(TEXTS)]
    rows += rows[4:9] + [(None, "a row without an id", None, None, None, "x"), (None, None, None, None, None, "x")]
    names = ["ids", "n_tokens", "kept", "n_words", "slot", "score", "component_id", "Decoded", "near_next"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(*r[:5], *[r[5]] * len(names)) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(corner_docs):
    return corner_docs.limit(0)
