import hashlib
import random
from types import SimpleNamespace

import public_tokenizers
import pytest
import tiktoken

from marquee.llm import bpe, common


@pytest.fixture(scope="module")
def codec():
    with open(bpe.RANKS, "rb") as f:
        return bpe.Codec(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.rank, special_tokens={})


def test_hash_is_minimal_and_perfect(codec):
    assert sorted(codec.hash.key_at.tolist()) == list(range(len(codec.tokens)))
    assert codec.hash.lookup(codec.tokens).tolist() == list(range(len(codec.tokens)))


def test_small_hashes():
    for n in (1, 2, 3, 10, 257):
        keys = [f"k{i}".encode() for i in range(n)]
        assert bpe.PerfectHash(keys).lookup(keys).tolist() == list(range(n))


def test_as_the_library(codec, library):
    rng = random.Random(3)
    alphabet = "abcdeÉéñß日本語🙂 \n\t'’.,0123456789́ "
    texts = ["", " ", "x" * 5000, "<|endoftext|>", "it's we'll they'd", "a  b   c \n\n"] + [
        "".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(400)]
    ids, sizes = codec.encode(texts)
    expected = [library.encode_ordinary(t) for t in texts]
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    assert codec.decode(ids) == "".join(texts).encode()


def test_odd_documents(spark, odd_docs, no_docs, library):
    got = bpe.decode(bpe.encode(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        text = r["text"] or ""
        ids = library.encode_ordinary(text)
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert hashlib.sha256(r["decoded"]).digest() == hashlib.sha256(text.encode()).digest()
    assert bpe.decode(bpe.encode(no_docs)).count() == 0
    both = bpe.encode(odd_docs, decoded="decoded").collect()
    assert sorted(bytes(r["decoded"]) for r in both) == sorted(bytes(r["decoded"]) for r in got)


def test_a_column_of_the_outputs_name_is_replaced(spark):
    df = spark.createDataFrame([("hello", "old")], "text string, ids string")
    assert bpe.encode(df).columns == ["text", "ids"]
    assert bytes(bpe.encode(df).first()["ids"]) != b"old"


def test_a_worker_gives_its_codec_back():
    sent = SimpleNamespace(value=(b"YQ== 0\nYg== 1\n", ".", None))
    made = bpe._codec(sent, "own")
    # Encoding and decoding send the ranks twice; one codec serves both.
    assert bpe._codec(SimpleNamespace(value=None), "own") is made and list(common._made) == ["codec"]
    common.drop_made()
    assert bpe._codec(sent, "own") is not made
    common.drop_made()
