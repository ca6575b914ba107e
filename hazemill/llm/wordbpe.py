"""Token ids of whole texts by the tokenizers library, each different word encoded once per worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from hazemill.llm.words import Memory

_BY_FILE: dict[str, WordIds] = {}


class WordIds:
    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.memory = Memory(self._encode_stems, self._encode_word)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; none for null."""
        ((edges, data),) = self.memory.texts(texts)[:1]
        edges = edges.tolist()
        return [np.frombuffer(data[a:b], self.dtype) for a, b in zip(edges, edges[1:], strict=False)]

    def _ids(self, text: str) -> np.ndarray:
        # A batch of one: only batches come without offsets, which is faster.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _encode_word(self, word: str) -> tuple[bytes]:
        return (self._ids(word).tobytes(),)

    def _encode_stems(self, stems: list[str]) -> list[tuple[bytes]]:
        """Stems side by side: each is one piece, and its last token is the first that ends a word."""
        values: list[tuple[bytes]] = []
        for low in range(0, len(stems), 1000):
            ids = self._ids(" ".join(stems[low : low + 1000]))
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
            data = ids.tobytes()
            values += [(data[a:b],) for a, b in zip([0, *cuts], cuts, strict=False)]
        return values


def word_ids(tokenizer_file: str) -> WordIds:
    if tokenizer_file not in _BY_FILE:
        _BY_FILE[tokenizer_file] = WordIds(tokenizer_file)
    return _BY_FILE[tokenizer_file]
