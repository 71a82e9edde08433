import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clientele.llm import bpe
from clientele.llm.lexicon import NOT_FOUND, Lexicon, compile_words

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "é", "", "stop", "stops"])}
    path = tmp_path / "l.bin"
    path.write_bytes(compile_words(words))
    lexicon = Lexicon(str(path))
    ranks = lexicon.ranks(list(words))
    assert [lexicon.ids_of(r).tolist() for r in ranks] == list(words.values())
    assert (lexicon.ranks([b"ta", b"tapss", b"x", b"\xc3"]) == NOT_FOUND).all()
    # Rests: of the start, of t, s, st, of the first byte of é, "p, ps", ", s", and nothing.
    assert lexicon.n_states == 8


def test_lexicon_of_nothing(tmp_path):
    path = tmp_path / "l.bin"
    path.write_bytes(compile_words({}))
    assert (Lexicon(str(path)).ranks([b"", b"a"]) == NOT_FOUND).all()


def test_minimality_against_right_languages(tmp_path):
    rng = random.Random(4)
    words = {bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 7))) for _ in range(40)}
    path = tmp_path / "l.bin"
    path.write_bytes(compile_words({w: [1] for w in words}))
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    languages = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert Lexicon(str(path)).n_states == len(languages)


@pytest.fixture(scope="module")
def encoder(vocabulary, tmp_path_factory):
    path = tmp_path_factory.mktemp("lexicon") / "l.bin"
    path.write_bytes(compile_words({w.encode(): vocabulary.merge(w) for w in ["the", "and", "hello", "."]}))
    return bpe.Encoder(vocabulary, Lexicon(str(path)))


ODD = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "Σίσυφος ΟΔΟΣ", "İstanbul", "é", "don't I'LL we've", "a\x1cb\x85c\xa0d",
       "１２３ ½ ⅷ", "한글 漢字 😀👩‍👩‍👧", "́x", "Å Å", "", " \n", "a" * 3000, "ab" * 40 + "!" * 200, "ß ẞ ﬁ"]


def ids(encoder, text):
    return np.frombuffer(next(iter(encoder.encode([text]))), np.int32).tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(encoder, library, text):
    assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*ODD, "the", " ", "'s", "Hello", "\t"]) | st.text(
    st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=12), max_size=6))
def test_any_text(encoder, library, parts):
    text = "".join(parts)
    assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_long_and_short_merges_agree(vocabulary):
    rng = random.Random(0)
    for _ in range(300):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 60))).encode()
        start = [vocabulary.inner[b] for b in word[:-1]] + [vocabulary.final[word[-1]]]
        assert vocabulary._merge_short(list(start)) == vocabulary._merge_long(list(start))


def test_documents(spark, library, odd_documents):
    rows = odd_documents.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(ODD, 100)), "doc_id long, text string"))
    out = sorted(bpe.round_trip_digests(rows, FILE).collect(), key=str)
    expected = []
    for r in rows.collect():
        coded = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(coded, skip_special_tokens=False)
        expected.append((r["doc_id"], len(coded), hashlib.sha256(" ".join(map(str, coded)).encode()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in out)


def test_columns_are_kept(odd_documents):
    out = bpe.encode(odd_documents, FILE, ids="tokens")
    assert out.columns == [*odd_documents.columns, "tokens"]
    assert out.count() == odd_documents.count()
