"""Rows and brute-force helpers for the tests of this folder."""

from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame from rows and a DDL schema, over four partitions."""
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(4)


SF_SMALL = "/root/testdata/sf0.001"

#: Rows that every operator has to stand: null and empty texts, white space, ties, repeated rows, a null id.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "Same text here twice over"), (5, "Same text here twice over"),
       (6, "same TEXT here twice over"), (None, "Same text here twice over"), (7, "é ü 漢字 \U0001f600 <|endoftext|>"),
       (8, "long " * 40_000), (9, "x" * 100_000), (10, "\\ <| \\| | 1.2.3.4.5 + @ @a.b 12")]
#: Columns whose names the operators use inside.
CLASH = ", ".join(f"`{c}` string" for c in ("_file", "_row", "keep_id", "digest", "n", "fp", "kept", "host", "part",
                                            "ids", "spans", "block", "_metadata"))


def odd_docs(make, rows=None):
    """ODD (or ``rows``) with columns of clashing names beside id and text."""
    rows = ODD if rows is None else rows
    return make([(*r, *(["z"] * 13)) for r in rows], f"doc_id long, text string, {CLASH}")


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
