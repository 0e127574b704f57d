"""Documents with every odd case: NULLs, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import pytest

#: Names that operators use for columns of their own.
CLASHING = (
    "fingerprint n_words size bucket number quality_score row verdict_host host_verdict host_rate"
    " quality_metrics label label_id known_id known_text chosen_id chosen_print counted_id id_rows"
    " root component_id text_key added_key added spans doc_key lane turn ids sequence_id offset"
    " start length piece tree digest place block n_leaves fim cut copy copies position"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in CLASHING
)
PROSE = "the quick brown fox jumps over the lazy dog while a patient cat watches from the old wall"


@pytest.fixture(scope="session")
def odd_rows():
    long_text = " ".join(f"w{i % 5000}" for i in range(30_000))
    texts = [
        PROSE,
        PROSE,
        PROSE.replace("lazy", "idle"),
        "",
        None,
        " \n\t ",
        "one",
        "spam " * 60,
        long_text,
        "line of text here\nline of text here\n### $$$ %%% ***",
        "mail a.b@c.example.org or +1 (555) 555-2485, card 4524132264652876, host 10.0.0.255",
        "Licensed under the Apache License, Version 2.0. The MIT  license, too.",
        "naïve café 日本語 \U0001f600 words beyond the plane and more of them here",
    ]
    rows = [
        (i, text, "en", ["b", "a", None][i % 3], None if text is None else len(text))
        for i, text in enumerate(texts)
    ]
    rows += [(None, PROSE, None, None, None)] * 2  # NULL ids and a repeated row
    rows += [rows[0]] * 3 + [(6, "another text with the id six", None, "a", None)]
    return [(*row, *["x"] * len(CLASHING)) for row in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
