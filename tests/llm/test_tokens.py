import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from framelark.llm import tokens
from framelark.llm.elias_fano import EliasFano

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**40), 2**40), max_size=400), st.integers(0, 3))
def test_elias_fano_round_trip(values, fold):
    values = sorted(v >> (fold * 12) for v in values)
    data = EliasFano.encode(values).to_bytes()
    again, rest = EliasFano.from_bytes(data + b"xyz")
    assert rest == b"xyz" and again.select(np.arange(len(values))).tolist() == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 1000, 20_000))
    assert len(EliasFano.encode(values).to_bytes()) * 8 < 20_000 * (3 + np.log2(values[-1] / 20_000))


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(PATH)
    return lambda t: tok.encode(t, add_special_tokens=False).ids


def test_encoder_equals_the_library(plain):
    rng = random.Random(3)
    bits = ["a", "it's", " ", "  ", "\n", "\n\n", " \n", "'", "'s", "ß", "œuvre", "é", "1", "22", "²", "½", ".", ",x", "…", "\t", " ", "　", "日本", "<|endoftext|>", "!?", "word", "Thereof,", "\x85", "é.", "x.\ny", "-", "😀", "\r\n", "\x00"]
    texts = ["", " ", "\n", "'s", *("".join(rng.choice(bits) + rng.choice([" ", "", " "]) for _ in range(rng.randrange(25))) for _ in range(3000))]
    encoder = tokens.Encoder(PATH)
    for at in range(0, len(texts), 100):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts[at : at + 100])]
        for t, ids in zip(texts[at : at + 100], got, strict=True):
            assert ids == plain(t), repr(t)


def test_encoder_forgets_without_error(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 3)
    encoder = tokens.Encoder(PATH)
    for _ in range(2):
        texts = ["one two three four five", "six seven, eight"]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [plain(t) for t in texts]


def test_files_hold_the_ids(spark, tmp_path, plain, monkeypatch):
    monkeypatch.setattr(tokens, "READ_BYTES", 64)
    rng = random.Random(7)
    rows = [(i * 5 - 40, " ".join(rng.choices(["alpha", "beta.", "gé", "x"], k=rng.choice([0, 1, 5, 400]))), 1) for i in range(60)]
    rows += [(None, "no id", 2), (7000, None, 3), (7001, "", 4), (7002, "same", 5), (7002, "same", 6)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(7)
    folder = f"file://{tmp_path}/out"
    manifest = tokens.write_tokens(docs, folder, PATH)
    back = tokens.read_tokens(manifest, folder)
    assert back.rdd.getNumPartitions() == manifest.count()  # a task per shard
    got = sorted(back.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(r[0] for r in rows if r[0] is not None)]
    texts = {}
    for i, t, _ in rows:
        texts[i] = t or ""
    at = 0
    for r in got:
        want = [*plain(texts[r.doc_id]), 0]
        assert (r.start, r.n_tokens, r.ids) == (at, len(want), want)
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        at += len(want)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read_tokens(tokens.write_tokens(empty, folder, PATH), folder).count() == 0


def test_frequent_words_stay(monkeypatch):
    """A full memory keeps the words learnt first: they are not encoded again."""
    monkeypatch.setattr(tokens, "CACHED", 40)
    encoder, learnt = tokens.Encoder(PATH), []
    run = encoder._run
    monkeypatch.setattr(encoder, "_run", lambda texts: learnt.extend(texts) or run(texts))
    for i in range(30):
        text = " ".join(["start often common", *(f"w{i}x{k}" for k in range(9 * (i > 0)))])
        assert encoder.encode([text]) == [np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, encoder.dtype).tobytes()]
        assert len(encoder.words) <= 40
    assert sum("often" in t for t in learnt) == 1


def test_a_word_is_encoded_once_whatever_follows(monkeypatch):
    """Signs and line ends after a word make no new word of it."""
    encoder, learnt = tokens.Encoder(PATH), []
    run = encoder._run
    monkeypatch.setattr(encoder, "_run", lambda texts: learnt.extend(texts) or run(texts))
    text = " ".join(["so", *(f"überall{end}{sign}\nweiter" for end in ("", "1", "д", "ñ") for sign in (".", ",", "!?", "$$$", "", ".\t", "\n"))])
    assert encoder.encode([text]) == [np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, encoder.dtype).tobytes()]
    assert sum(t.count("überall") for t in learnt) == 4
    assert sum(t.count("weiter") for t in learnt) == 3  # after a line feed alone, after two, after a tab and one


def test_no_cut_changes_ids(plain):
    rng = random.Random(5)
    bits = ["a", "Z", "7", "é", "×", "÷", "ÿ", "Ā", "д", "ª", "²", "λ", "日", "😀", "'", "'s", "'ll", ".", "_", "^", "…", "»", "<|endoftext|>", "x" * 70, "\x00", "\x1c", "\x1f", "\x7f", "\x85", "\xa0", "҂"]
    bits += ["ɏ", " ", "᠎", " ", "​", " ", " ", " ", "　", "﻿", " ", " ", " ", " ", "\n", "\n", "\n", "\t", "\r", "\v"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(20_000)]
    encoder = tokens.Encoder(PATH)
    for at in range(0, len(texts), 500):
        for t, ids in zip(texts[at : at + 500], encoder.encode(texts[at : at + 500]), strict=True):
            assert np.frombuffer(ids, encoder.dtype).tolist() == plain(t), repr(t)
    assert max(map(len, encoder.words)) <= tokens.LONGEST


def test_another_pattern_is_encoded_whole(tmp_path):
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    for form in (ByteLevel(add_prefix_space=True), Sequence([Split(".\n", "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])):
        other = Tokenizer.from_file(PATH)
        other.pre_tokenizer = form
        other.save(str(tmp_path / "other.json"))
        encoder = tokens.Encoder(str(tmp_path / "other.json"))
        texts = ["One two.\nThree four", "", "five, six\nseven"]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [other.encode(t, add_special_tokens=False).ids for t in texts]
