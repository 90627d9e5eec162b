import random

import pytest
from tokenizers import Tokenizer

from docmill.llm import bpe

EDGES = [None, "", " ", " \n\t ", "<|endoftext|> stays", "aaaaaaaaaaaaa", "don't I'LL 've", "a" * 30_000, "ที่นี่" * 40, "年度报告" * 50, " x　y​", "🧑‍🔧🏽", "\r\n\r\n  x", "=-" * 99, "0" * 41]


@pytest.fixture(scope="module")
def public():
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def automaton():
    return bpe.Encoder.of(bpe.read_spec(bpe.vocabulary_path())).automaton


def test_same_ids_and_round_trip(public, automaton):
    rng = random.Random(3)
    texts = EDGES + ["".join(rng.choice("aabeinst  012-='\n") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        ids = automaton.encode(text)
        assert ids == public(text)
        assert automaton.decode(ids) == (text or "")


def test_arcs_are_the_valid_pairs(public, automaton):
    """A pair of tokens is an arc exactly if encoding the joined bytes gives the pair."""
    rng = random.Random(4)
    ascii_tokens = [t for t, b in automaton.label.items() if b.isalpha() and b.isascii()]
    for _ in range(3000):
        a, b = rng.choice(ascii_tokens), rng.choice(ascii_tokens)
        joined = (automaton.label[a] + automaton.label[b]).decode()
        assert automaton.arc(a, b) == (public(joined) == [a, b])


def test_documents(spark, public):
    rows = [(n, t, "clash") for n, t in enumerate(EDGES)] + [(0, None, "again"), (None, "x", "null key")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = [(r.doc_id, r.ids) for r in bpe.encode_documents(df).collect()]
    assert sorted(map(repr, got)) == sorted(repr((k, public(t))) for k, t, _ in rows)
    counts = {r.doc_id: r.n_tokens for r in bpe.count_tokens(df.where("doc_id > 0")).collect()}
    assert counts == {k: len(public(t)) for k, t, _ in rows if k}
    assert bpe.encode_documents(df.limit(0)).collect() == []


def test_the_table_of_transitions_is_bounded(public, monkeypatch):
    monkeypatch.setattr(bpe, "TRANSITIONS", 2_000)
    monkeypatch.setattr(bpe, "WORD_TABLE_LIMIT", 5_000)
    encoder = bpe.Encoder(bpe.Automaton.load(bpe.compiled(bpe.vocabulary_path())))
    rng = random.Random(5)
    base, most, words = len(encoder.automaton.compiled), 0, 0
    for _ in range(60):
        texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 12))) for _ in range(20)) for _ in range(10)]
        offsets, ids = encoder.batch(texts)
        most, words = max(most, len(encoder.automaton.table)), max(words, len(encoder.words))
        for n, text in enumerate(texts):
            assert ids[offsets[n] : offsets[n + 1]].tolist() == public(text)
    assert most <= base + 2_000 + 20_000 and words <= 5_000 + 400  # what one batch adds comes on top
    encoder.automaton.bound()
    assert len(encoder.automaton.table) <= base + 2_000


def test_the_split_pattern_comes_from_the_file():
    level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    assert bpe.split_pattern({"pre_tokenizer": level}) == bpe.SPLIT
    split = {"type": "Split", "pattern": {"Regex": r"\S+|\s+"}, "behavior": "Isolated", "invert": False}
    assert bpe.split_pattern({"pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, level | {"use_regex": False}]}}) == split["pattern"]["Regex"]
    for bad in ({}, {"pre_tokenizer": {"type": "Metaspace"}}, {"pre_tokenizer": level | {"add_prefix_space": True}}, {"pre_tokenizer": split}, {"pre_tokenizer": level, "normalizer": {"type": "NFC"}}, {"pre_tokenizer": level | {"use_regex": False}}):
        with pytest.raises(ValueError):
            bpe.split_pattern(bad)


def test_another_splitting_gives_that_tokenizers_ids(tmp_path):
    import json

    spec = json.loads(bpe.read_spec(bpe.vocabulary_path()))
    spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": r"\p{L}{1,3}|[^\p{L}]"}, "behavior": "Isolated", "invert": False}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    t = Tokenizer.from_file(str(path))
    encoder = bpe.Encoder.compiled(bpe.compiled(str(path)))
    for text in ["Standing there, 42 wires!", "ab  cdefg\n語のtest"]:
        assert encoder.automaton.encode(text) == t.encode(text, add_special_tokens=False).ids
