from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runlens.functions import notes


def test_notes_are_codes_with_facts(spark):
    df = spark.range(1).select(notes.note("row_length", row=F.col("id"), found="2").alias("n"), notes.note("no_numbers").alias("m"))
    row = df.select("n", notes.code_of(F.col("n")).alias("c"), notes.in_words(F.col("n")).alias("w"), notes.in_words(F.col("m")).alias("v")).first()
    assert (row["n"], row["c"]) == ("row_length row=0 found=2", "row_length")
    assert row["w"] == notes.MEANING["row_length"] + ": row=0 found=2"
    assert row["v"] == notes.MEANING["no_numbers"]
    with pytest.raises(KeyError):
        notes.note("unknown")
