"""Odd rows that every corpus operator has to take, and Python's path for the workers."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")])

SENTENCES = [f"The {w} of line {i} tells about {w} and {w}s in plain and simple words." for i, w in enumerate("fox dog cat cow hen pig owl bat elk ant".split())]
PASSAGE = " ".join(f"shared{i}" + ("." if i % 9 == 8 else "") for i in range(60))
LONG = " ".join(f"w{i}" for i in range(60_000))
DOCS = "doc_id bigint, text string, row string, body int, key string, n_words string, ord int, n_removed string, votes string, doc string"


def docs_rows() -> list[tuple]:
    texts = [
        (1, "\n".join(SENTENCES)),
        (2, "\n".join(SENTENCES)),
        (3, "Something else.\n" + PASSAGE + "\nIts own end."),
        (4, "Another start here.\n" + PASSAGE + "\nWith a different end."),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "One"),
        (9, "one"),
        (10, LONG),
        (11, LONG + " x"),
        (None, "\n".join(SENTENCES)),
        (12, "repeated row of the table."),
        (12, "repeated row of the table."),
        (13, "ÄÖÜ ß 漢字   emoji 😀 <|endoftext|> done."),
    ]
    return [(i, t, "r", 1, "k", "n", 2, "x", "v", "d") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(docs_rows(), DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
