"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is one token that ends its encoding. An automaton over the
vocabulary lists the tokens that end at each position, longest first; the one whose
predecessor's token is compatible with it is the last token of that prefix. Following the last
tokens back from the end of the word gives the ids. Each different word is encoded once per
worker; texts are never shuffled.

Nulls are empty texts; repeated rows each give a row; extra columns are ignored; an empty
table gives an empty result. Texts may be of any length: work is linear in it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, in_tasks
from hazemill.llm.words import Memory

RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_BY_FILE: dict[str, PrefixBpe] = {}


def byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 stands for itself; the other bytes, in order, are U+0100 and on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixBpe:
    """Encoder for a tokenizers file with byte-level BPE and an optional end-of-word suffix."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as file:
            model = json.load(file)
        self.suffix = model["model"].get("end_of_word_suffix") or ""
        self.final = 256 if self.suffix else 0
        library = Tokenizer.from_file(tokenizer_file)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        vocabulary: dict[str, int] = model["model"]["vocab"]
        self.token = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.bytes = byte_symbols()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["model"]["merges"]):
            pair = vocabulary[left], vocabulary[right]
            self.rank[pair] = rank
            self.parts[vocabulary[left + right]] = pair
        self.automaton = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            symbols = self._symbols(token.removesuffix(self.suffix), bool(self.suffix) and token.endswith(self.suffix))
            if symbols and (i in self.parts or len(symbols) == 1):
                self.automaton.add_word(symbols, (i, len(symbols)))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.memory = Memory(self._encode_stems, lambda word: self._value(self.encode_word(word)))

    def _symbols(self, piece: str, final: bool) -> str:
        """One character per byte; the byte that ends a word is another symbol than within one."""
        if any(c not in self.bytes for c in piece):
            return ""
        points = [self.bytes[c] for c in piece]
        if final and points:
            points[-1] += self.final
        return "".join(map(chr, points))

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens at one end of ``token``, each with the rank of the merge that absorbs it."""
        if token not in self.spines[side]:
            spine, until = [], float("inf")
            node: int | None = token
            while node is not None:
                spine.append((node, until))
                pair = self.parts.get(node)
                until = self.rank[pair] if pair else until
                node = pair[side] if pair else None
            self.spines[side][token] = spine
        return self.spines[side][token]

    def compatible(self, left: int, right: int) -> bool:
        """No merge crosses the border between the two while both sides are still being built.

        Of equal ranks the leftmost merge comes first: one that absorbs the left side's end
        precedes a merge across the border, one that absorbs the right side's start follows it.
        """
        if (left, right) not in self.fits:
            self.fits[left, right] = not any(
                (rank := self.rank.get((a, b))) is not None and rank < until_a and rank <= until_b
                for a, until_a in self._spine(left, 1)
                for b, until_b in self._spine(right, 0)
            )
        return self.fits[left, right]

    def encode_symbols(self, symbols: str) -> list[int]:
        last, back, fits = [-1] * (len(symbols) + 1), [0] * (len(symbols) + 1), self.fits
        for end, (token, length) in self.automaton.iter(symbols):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fit = fits.get((before, token))
                if not (self.compatible(before, token) if fit is None else fit):
                    continue
            last[end], back[end] = token, start
        ids, at = [], len(symbols)
        while at:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def _encode_plain(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text)):
            ids += self.encode_symbols(self._symbols(piece, True))
        return ids

    def encode_word(self, word: str) -> list[int]:
        if not any(s in word for s in self.special):
            return self._encode_plain(word)
        return [i for s in self.cut.split(word) for i in ([self.special[s]] if s in self.special else self._encode_plain(s))]

    def _value(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Ids and tokens, each followed by a space."""
        return "".join([f"{i} " for i in ids]).encode(), "".join([self.token[i] + " " for i in ids]).encode()

    def _encode_stems(self, stems: list[str]) -> list[tuple[bytes, bytes]]:
        """Plain letters are one piece, normal once in lower case."""
        values = []
        for stem in stems:
            symbols = stem.lower().encode().decode("latin-1")
            values.append(self._value(self.encode_symbols(symbols[:-1] + chr(ord(symbols[-1]) + self.final))))
        return values

    def encode(self, texts: pa.Array) -> Iterator[tuple[memoryview, memoryview]]:
        """Of each text its ids and its tokens, space-joined."""
        (ids_at, ids), (tokens_at, tokens) = self.memory.texts(texts)
        ids_at, tokens_at = ids_at.tolist(), tokens_at.tolist()
        for a, b, c, d in zip(ids_at, ids_at[1:], tokens_at, tokens_at[1:], strict=False):
            yield ids[a : max(a, b - 1)], tokens[c : max(c, d - 1)]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary file has no decoder, so tokens are joined by spaces, special ones included."""
        return " ".join(self.token[i] for i in ids if i in self.token)


def prefix_bpe(tokenizer_file: str) -> PrefixBpe:
    if tokenizer_file not in _BY_FILE:
        _BY_FILE[tokenizer_file] = PrefixBpe(tokenizer_file)
    return _BY_FILE[tokenizer_file]


def encode_documents(documents: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, ids (array of int) and the text decoded from them, for every row of ``documents``."""

    def encode(batches: Batches) -> Batches:
        bpe = prefix_bpe(tokenizer_file)
        for batch in batches:
            ids, decoded = [], []
            for of_ids, of_tokens in bpe.encode(batch.column(1)):
                ids.append([int(i) for i in bytes(of_ids).split()])
                decoded.append(str(of_tokens, "utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return in_tasks(rows, encode, "doc_id bigint, ids array<int>, decoded string")


def token_digests(documents: DataFrame, tokenizer_file: str) -> DataFrame:
    """Per document the number of tokens and digests of the ids and of the decoded text."""

    def digest(batches: Batches) -> Batches:
        bpe = prefix_bpe(tokenizer_file)
        for batch in batches:
            counts, ids_hex, decoded_hex = [], [], []
            for ids, tokens in bpe.encode(batch.column(1)):
                counts.append(bytes(ids).count(b" ") + 1 if ids else 0)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                decoded_hex.append(hashlib.sha256(tokens).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(decoded_hex)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return in_tasks(rows, digest, RESULT)
