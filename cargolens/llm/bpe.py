"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that ends its BPE encoding. It is a
vocabulary entry that is a suffix of the prefix (an automaton over the vocabulary lists those)
and that may stand after the last token of what precedes it (a pair test). Storing that token
per prefix and following it back from the end gives the ids, in time linear in the piece.

Pieces are the tokenizer's own: special tokens are cut out first, the byte-level pattern cuts
the rest. Encodings are kept per blank-separated chunk in a bounded cache, as texts repeat words.

Defined results: null text counts as empty; empty text has no ids and decodes to ""; very long
texts and pieces take linear time; repeated rows are encoded alike; an empty table gives an empty
table; columns of the input are kept unless an output column has their name, which it replaces.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.llm.common import ready

#: Entries of each cache of a worker. A full one is set aside, and dropped when the next is full.
CACHE = 300_000
#: Longer chunks are not kept.
KEEP_CHARS = 64

#: Below it all code points are classed alike by every Unicode version in use.
FIRST_UNASSIGNED = "\u0378"
#: The pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_names() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself when printable, else 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


def unassigned() -> re.Pattern:
    """Finds code points that Unicode 15.1 leaves unassigned: libraries of other versions may class them otherwise."""
    runs, start = [], None
    for cp in range(sys.maxunicode + 2):
        odd = cp <= sys.maxunicode and unicodedata.category(chr(cp)) == "Cn"
        if odd and start is None:
            start = cp
        elif not odd and start is not None:
            runs.append(f"{re.escape(chr(start))}-{re.escape(chr(cp - 1))}")
            start = None
    return re.compile(f"[{''.join(runs)}]")


class Encoder:
    """Encodes and decodes as the tokenizer file says; a byte-level BPE without normaliser or prefix space."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model, kind = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or spec["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that strip or look around are not supported")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.pattern, self.odd = regex.compile(PATTERN), unassigned()
        self.irregular = re.compile(r"\s (?:\s|\Z)")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        bytes_of = {c: b for b, c in enumerate(byte_names())}
        vocab = model["vocab"]
        # Tokens as latin-1 strings: one character per byte, which the automaton reads.
        self.token = {i: "".join(chr(bytes_of[c]) for c in s) for s, i in vocab.items()}
        self.bytes_of = {i: s.encode("latin-1") for i, s in self.token.items()} | {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = (vocab[left], vocab[right])
            self.rank[pair] = rank
            self.parts.setdefault(vocab[left + right], (*pair, rank))
        made = {i for i, s in self.token.items() if len(s) == 1} | set(self.parts)
        self.automaton = ahocorasick.Automaton()
        for i in made:
            self.automaton.add_word(self.token[i], (i, len(self.token[i])))
        self.automaton.make_automaton()
        self.edges: tuple[dict, dict] = ({}, {})
        self.fits: dict[tuple[int, int], bool] = {}
        self.recent: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.size = {i: len(s) for i, s in self.token.items()}
        self.digits = {i: str(i) for i in self.bytes_of}

    def edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The pieces at one border of a token while it is built, first to last, each with the rank that consumes it."""
        known = self.edges[right]
        if token not in known:
            steps, now, consumed = [], token, sys.maxsize
            while True:
                steps.append((now, consumed))
                if now not in self.parts:
                    break
                left_part, right_part, consumed = self.parts[now]
                now = right_part if right else left_part
            known[token] = steps[::-1]
        return known[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay side by side: no merge joins their borders while both are built.

        Borders meet in order of rank. A merge across needs a rank below the one that consumes
        the piece of ``a`` (an equal pair further left comes first) and not above that of ``b``.
        """
        left, right, i, j = self.edge(a, True), self.edge(b, False), 0, 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            across = self.rank.get((x, y))
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if x_ends == y_ends == sys.maxsize:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def piece(self, text: str) -> list[int]:
        """Ids of one piece of the pattern."""
        raw = text if text.isascii() else text.encode().decode("latin-1")
        last: list[int | None] = [None] * len(raw)
        fits = self.fits
        for end, (token, size) in self.automaton.iter(raw):
            if last[end] is not None:
                continue
            before = end - size
            if before < 0:
                last[end] = token
            elif (previous := last[before]) is not None:
                pair = (previous, token)
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) >= CACHE:
                        fits.clear()
                    fit = fits[pair] = self.compatible(previous, token)
                if fit:
                    last[end] = token
        out, at = [], len(raw) - 1
        while at >= 0:
            token = last[at]
            if token is None:
                raise ValueError("the vocabulary lacks a byte")
            out.append(token)
            at -= self.size[token]
        out.reverse()
        return out

    def run(self, text: str) -> tuple[int, ...]:
        """Ids of a text without special tokens, piece by piece."""
        known = text.isascii() or max(text) < FIRST_UNASSIGNED
        if known and (text[1:] if text[:1] == " " else text).isalpha():
            return tuple(self.piece(text))
        if known or not self.odd.search(text):
            pieces = self.pattern.findall(text)
        else:
            pieces = [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return tuple(chain.from_iterable(map(self.piece, pieces)))

    def chunk(self, text: str) -> tuple[int, ...]:
        ids = self.older.get(text) or self.run(text)
        if len(text) <= KEEP_CHARS:
            if len(self.recent) >= CACHE:
                self.older, self.recent = self.recent, {}
            self.recent[text] = ids
        return ids

    def parts_of(self, text: str) -> list[tuple[int, ...]]:
        """Ids of consecutive parts of a text.

        A blank between two words always starts a piece, so chunks may be cut there; runs of
        white space that go on after a blank, or end with one, are left to the pattern.
        """
        if not text:
            return []
        if self.specials and self.specials.search(text):
            out = []
            for k, part in enumerate(self.specials.split(text)):
                out += [(self.special[part],)] if k % 2 else self.parts_of(part)
            return out
        if self.irregular.search(text):
            return [self.run(text)]
        first, *rest = text.split(" ")
        chunk = self.chunk
        out = [chunk(first)] if first else []
        for word in rest:
            word = " " + word
            out.append(self.recent.get(word) or chunk(word))
        return out

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.parts_of(text or "")))

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens included; bytes that form no character become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with their ids as an array of ints."""
    ready(docs.sparkSession)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts):
        return texts.map(lambda t: encoder(vocabulary).encode(t))

    return docs.withColumn(ids, run(F.col(text)))


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; null ids decode to the empty text."""
    ready(rows.sparkSession)

    @F.pandas_udf(T.StringType())
    def run(lists):
        return lists.map(lambda x: encoder(vocabulary).decode([] if x is None else list(x)))

    return rows.withColumn(text, run(F.col(ids)))


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """Per document: key, the string columns ``also``, n_tokens, ids_sha256 and decoded_sha256, from ids that are decoded again."""
    import pyarrow as pa

    ready(docs.sparkSession)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", key, *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            counts, hashed, decoded = [], [], []
            for value in batch.column(0):
                ids = coder.encode(value.as_py())
                counts.append(len(ids))
                hashed.append(hashlib.sha256(",".join(map(coder.digits.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            made = [pa.array(counts, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*made, *batch.columns[1:]], names=names)

    out = f"n_tokens long, ids_sha256 string, decoded_sha256 string, `{key}` long" + "".join(f", `{c}` string" for c in also)
    read = docs.select(F.col(text).alias("_text"), F.col(key).cast("long").alias(key), *[F.col(c).cast("string").alias(c) for c in also])
    return read.mapInArrow(run, out).select(key, *also, *names[:3])


def query(spark, sf_dir: str) -> DataFrame:
    """Digests of every document under the public 50k byte-level vocabulary."""
    from public_tokenizers import path

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), path("byte_bpe_50k.json"))
