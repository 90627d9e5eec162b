"""Odd and very long texts take linear time in every text operator."""

import time

import pytest

from docmill.llm import boilerplate, bpe, cutting, neardup, sentences

ODD = {
    "spaces": "a" + " " * 60_000 + "b.", "brackets": "(" * 60_000, "dots": ". " * 30_000, "quotes": '"' * 60_000, "lines": "a\n" * 20_000, "numbers": "1. " * 30_000,
    "one word": "x" * 100_000, "no spaces": "語" * 60_000, "tags": "<p>" * 30_000, "links": "[a](" * 20_000, "thai": "ก " * 30_000, "dashes": "-" * 60_000,
    "wrapped item": "- item\n" + "a line of it\n" * 20_000, "numbers at line starts": "It holds\n" + "2. of them and\n" * 15_000, "closers": "a.\n" + ")\n" * 30_000,
}
#: Shapes in which each line looks back at what is open, at 5 MB.
WRAPPED = {"item": "- item\n" + "a line of it that is wrapped hard\n" * 150_000, "numbers": "It holds\n" + "2. of them and so on and so on\n" * 165_000, "ends": "1. item\n" + "a line of it.\n" * 350_000}


@pytest.mark.parametrize("name", WRAPPED)
def test_sentences_of_five_megabytes(name):
    began = time.process_time()
    assert sentences.units(WRAPPED[name], "en")
    assert time.process_time() - began < 15


@pytest.mark.parametrize("name", ODD)
def test_time(name):
    text = ODD[name]
    encoder = bpe.Encoder.of(bpe.read_spec(bpe.vocabulary_path()))
    for work in (
        lambda: sentences.units(text, "en"), lambda: cutting.cut(text, 2000, 200), lambda: encoder.batch([text]),
        lambda: boilerplate.decode_page(boilerplate.Field(), "web/h.example/x", "t", text), lambda: neardup.word_sets([text], neardup._WordHash(), 3, 40),
    ):
        began = time.process_time()
        work()
        assert time.process_time() - began < 5
