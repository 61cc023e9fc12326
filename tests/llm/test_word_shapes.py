"""Shapes of words are those of whole words."""

from __future__ import annotations

from shelfmark.llm import quality_model


def test_long_words_that_differ_late_have_different_shapes():
    number = quality_model.Hasher().number
    assert number("a" * 80 + "7" * 9)[1] != number("a" * 80)[1] == number("a" * 90)[1]
