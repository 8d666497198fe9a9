"""Odd rows and definitions that the tests share."""

from __future__ import annotations

import re

import pytest

TEXT = "doc_id bigint, text string"


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split(text: str | None) -> list[str]:
    """Words, by definition."""
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


#: Nulls, empty and odd texts, repeats and ties; every operator must take them.
ODD = [
    (1, "one two three four five six seven eight nine ten " * 3),
    (2, None),
    (3, ""),
    (4, " \t\n\r\x0b\x0c "),
    (5, "Ärger über Öl und 漢字 kana　end.\n\nx,. y, .z 12,5 it's <|endoftext|>"),
    (6, "word"),
    (6, "word"),
    (7, "a b\nA B \n a b\nlicensed under CC BY-NC 4.0, cc by\ncc by"),
    (None, "no id at all but some words here and there in a row"),
    (None, None),
    (8, "x" * 300_000),
    (9, "tail\n\n\n"),
    (10, "lorem ipsum dolor sit amet " * 4000),
]


@pytest.fixture
def odd(spark):
    """The odd rows with extra columns named like the operators' own."""
    schema = TEXT + ", node int, length string, bin int, place int, normal string, kept string"
    return spark.createDataFrame([(*r, 1, None, 2, 3, "n", "k") for r in ODD], schema)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], TEXT)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
