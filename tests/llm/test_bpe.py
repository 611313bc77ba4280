import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from indicata.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(1)
    alphabet = ["a", "b", "é", " ", "\n", "\x1c", "\xa0", "漢", "😀", "1", "²", "!", "'s", "aaaa", "the", "\r\n", "\x85"]
    some = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 200))) for _ in range(200)]
    long = ["a" * 20000, "ab" * 30000, "".join(r.choice("abcde") for _ in range(50000)), " " * 5000, "é漢" * 5000]
    return ["", "<|endoftext|>", *some, *long, "the the", "the the"]


def test_equals_the_library(spark, reference):
    rows = list(enumerate(texts())) + [(-1, None)]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows],
                               "doc_id long, text string, ids string, decoded string, row string")
    coded = bpe.encode(df, PATH, P.PATTERN)
    found = {r.doc_id: r for r in bpe.digest(coded).collect()}
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        sha = lambda x: hashlib.sha256(x).hexdigest()
        assert tuple(found[i])[1:] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))
    assert coded.select("row").first()[0] == "z"
    assert bpe.encode(df.where("false"), PATH, P.PATTERN).count() == 0


def test_memory_is_bounded(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    own = bpe.Vocabulary(open(PATH, "rb").readlines(), P.PATTERN)
    for t in texts()[:120]:
        assert np.frombuffer(own.encode([t])[0], "<i4").tolist() == reference.encode_ordinary(t)


def test_ranks_that_fall_while_merging():
    """A vocabulary in which a merge makes a pair of a lower rank."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"ab", b"cd", b"abcd", b"bc"]
    own = bpe.Vocabulary([base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)], P.PATTERN)
    ranks = {t: i for i, t in enumerate(tokens)}
    lib = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    for _ in range(300):
        t = "".join(r.choice("abcd") for _ in range(r.randint(1, 30)))
        assert np.frombuffer(own.encode([t])[0], "<i4").tolist() == lib.encode_ordinary(t), t
