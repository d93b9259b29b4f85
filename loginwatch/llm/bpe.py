"""BPE encoding and decoding; long unsplit text by tree concatenation."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tiktoken import Encoding
from tokenizers import Tokenizer

#: Characters of a run that the pre-tokenizer leaves whole, from which it is halved.
LONG = 4096
#: Characters of a leaf.
LEAF = 1024
#: Characters handed to the library at once.
BATCH = 1 << 20
#: The split of a byte-level pre-tokenizer; a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters beyond those whose classes are the same in every edition of Unicode's tables.
_UNUSUAL = re.compile("[^\0-\u024f\u2000-\u206f]")


@contextmanager
def library_threads(on: bool):
    """Whether the library splits a batch over threads; it reads the variable at each call.

    Off for batches of whole texts, where Spark's tasks fill the cores; on for the leaves
    of one long piece, which no other task can share.
    """
    name = "TOKENIZERS_PARALLELISM"
    before = os.environ.get(name)
    os.environ[name] = "true" if on else "false"
    try:
        yield
    finally:
        if before is None:
            del os.environ[name]
        else:
            os.environ[name] = before


def _bytes_of_letters() -> dict[str, int]:
    """The byte alphabet: printable Latin-1 stands for itself, other bytes from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _by_rank(path: str, added: dict[str, int]) -> Encoding | None:
    """The same encoding by ranks, which takes a third of the time; None for a file whose
    merges are not in the order of their ids or that splits in another way."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", ())]
    ids = [model["vocab"].get(m.replace(" ", "")) for m in merges]
    plain = (
        model["type"] == "BPE" and spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
        and not pre.get("add_prefix_space") and not model.get("dropout") and not model.get("ignore_merges")
        and None not in ids and ids == sorted(set(ids))
    )
    if not plain:
        return None
    letters = _bytes_of_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    return Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)


class TreeEncoder:
    """A tokenizer file, with long pieces encoded in halves."""

    def __init__(self, path: str, long: int = LONG, leaf: int = LEAF):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # The merges alone: what it gets is one piece, in the byte alphabet of the vocabulary.
        self.piece = Tokenizer(self.whole.model)
        self.long, self.leaf = long, leaf
        specials = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        added = sorted(specials, key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None
        self.ranks = _by_rank(path, specials)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, as the library gives them without adding special tokens."""
        out = [self._encode_one(t) for t in texts]
        plain = [i for i, ids in enumerate(out) if ids is None]
        for i, got in zip(plain, self.whole.encode_batch_fast([texts[i] for i in plain], add_special_tokens=False)):
            out[i] = np.array(got.ids, "<u4")
        return out

    def _encode_one(self, text: str) -> np.ndarray | None:
        if self._has_long_run(text):
            return self._encode_long(text)
        if self.ranks and not _UNUSUAL.search(text):
            return np.array(self.ranks.encode(text, allowed_special="all"), "<u4")
        return None

    def decode_batch(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)

    def _has_long_run(self, text: str) -> bool:
        if len(text) < self.long:
            return False
        words = text.split()
        return max(map(len, words), default=0) >= self.long - 1 or len(text) - sum(map(len, words)) >= self.long

    def _encode_long(self, text: str) -> np.ndarray:
        """A text with a long run: split as the library does, each piece on its own.

        A piece that the pre-tokenizer has made is one piece again on its own, so the
        short ones go through the merges as they are and the long ones as a tree.
        """
        ids: list[int] = []
        parts = self.added.split(text) if self.added else [text]
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.whole.token_to_id(part))
                continue
            short: list[str] = []
            for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(part) if part else []:
                if len(piece) < self.long:
                    short.append(piece)
                    continue
                ids += self._merged(short)
                short = []
                ids += self.encode_piece(piece)
            ids += self._merged(short)
        return np.array(ids, "<u4")

    def _merged(self, pieces: list[str]) -> list[int]:
        return [i for e in self.piece.encode_batch_fast(pieces, add_special_tokens=False) for i in e.ids]

    def encode_piece(self, piece: str) -> list[int]:
        """The tree: leaves are encoded side by side by the library's threads, then joined
        in pairs, level by level."""
        leaves = [piece[i: i + self.leaf] for i in range(0, len(piece), self.leaf)]
        with library_threads(True):
            level = [e.ids for e in self.piece.encode_batch_fast(leaves, add_special_tokens=False)]
        while len(level) > 1:
            joined = [self.concatenate(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
            level = joined + level[len(joined) * 2:]
        return level[0] if level else []

    def concatenate(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring runs from theirs.

        A window of k tokens on both sides of the join is encoded again. Its first token
        equal to the left side's and its last equal to the right side's: both sides
        agree, as a sequence of tokens is the encoding of its text exactly when each two
        neighbours are that of theirs, and every pair of the result is inside one of the
        three encodings. Else the window doubles, at the utmost to both sides whole.
        """
        k = 1
        while True:
            tail, head = left[-k:], right[:k]
            text = "".join(map(self.piece.id_to_token, tail + head))
            window = self.piece.encode(text, add_special_tokens=False).ids
            if (k >= len(left) or window[0] == tail[0]) and (k >= len(right) or window[-1] == head[-1]):
                return left[:-k] + window + right[k:]
            k *= 2


@cache
def _encoder(path: str) -> TreeEncoder:
    return TreeEncoder(path)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BATCH:
            yield texts[start: i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def encode_decode(frame: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``frame`` with ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded``.

    Whole texts; null counts as empty, which gives no ids. The strings of special tokens
    become those tokens, as in the library. Nothing is shuffled, and a batch holds
    ``BATCH`` characters or one text. Columns named ``ids`` or ``decoded`` are replaced.
    """
    result = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    @F.pandas_udf(result)
    def run(texts: pd.Series) -> pd.DataFrame:
        encoder, ids, decoded = _encoder(path), [], []
        with library_threads(False):
            for part in _slices(texts.tolist()):
                got = encoder.encode_batch(part)
                ids += [x.tobytes() for x in got]
                decoded += encoder.decode_batch(got)
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(decoded, dtype=object)})

    other = [c for c in frame.columns if c not in ("ids", "decoded")]
    return frame.select(*other, run(F.coalesce(column, F.lit(""))).alias("_bpe")).select(*other, "_bpe.*")


def token_digests(documents: DataFrame, path: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text, per document."""
    coded = encode_decode(documents.select("doc_id", "text"), path)
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
