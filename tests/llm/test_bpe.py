import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loginwatch.llm import bpe

from .cases import odd_documents, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def runs():
    rng = random.Random(5)
    alphabets = ["abc", "the", "éè中", "0123456789", "!?#*-", " ", "\n", " \n", "aaaaaaab", "​́x"]
    for letters in alphabets:
        yield "".join(rng.choice(letters) for _ in range(700))
    yield "a" * 3000
    yield "don't " + "x'll" * 300 + "  \n\n " + "=" * 999 + "<|endoftext|>" + "y" * 500
    yield "<|endoftext|><|endoftext|>"
    yield " " * 500 + "word" + "\t" * 501


@pytest.mark.parametrize("leaf", [1, 3, 16, 100])
def test_tree_equals_the_library_on_long_runs(library, leaf):
    encoder = bpe.TreeEncoder(PATH, long=20, leaf=leaf)
    texts = list(runs())
    for text, ids in zip(texts, encoder.encode_batch(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:40]


def test_ranks_equal_the_library_on_all_usual_characters(library):
    encoder = bpe.TreeEncoder(PATH)
    assert encoder.ranks
    usual = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070)]]
    texts = [f"a{c}b {c} {c}{c} 1{c}2 {c}'s\n{c}\n" for c in usual] + ["".join(usual), "<|endoftext|>", "x<|endoftext|> <|endoftext|"]
    for text, ids in zip(texts, encoder.encode_batch(texts)):
        assert encoder._encode_one(text) is not None
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder._encode_one("中") is None


def test_other_tokenizer_files_go_through_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe._by_rank(path, {}) is None


def test_joins_of_any_halves(library):
    encoder = bpe.TreeEncoder(PATH)
    rng = random.Random(1)
    for _ in range(300):
        piece = "".join(rng.choice(["th", "e", "ing", "er", "a", "an", "tion", "s"]) for _ in range(60))
        at = rng.randrange(len(piece) + 1)
        halves = [encoder.piece.encode(x).ids if x else [] for x in (piece[:at], piece[at:])]
        joined = encoder.concatenate(*halves) if all(halves) else halves[0] + halves[1]
        assert joined == encoder.piece.encode(piece).ids


@pytest.mark.parametrize("make", [odd_documents, lambda s: table(s, "documents"), lambda s: odd_documents(s).where("false")])
def test_digests_equal_the_library(spark, library, make):
    docs = make(spark)
    got = sorted((tuple(r) for r in bpe.token_digests(docs, PATH).collect()), key=repr)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(b).hexdigest() for b in (
            np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode())]
        want.append((r.doc_id, len(ids), *sha))
    assert got == sorted(want, key=repr)


def test_round_trip_and_clashing_columns(spark):
    docs = odd_documents(spark).withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit(0))
    out = bpe.encode_decode(docs, PATH)
    assert out.where(~F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "decoded"]
