"""Words of texts and what a worker remembers about them.

The tokenizers here drop white space and never join symbols across it, so a text's tokens are
its words' tokens. They also part letters from punctuation, so a word of plain letters with a
tail of stops is its stem followed by its tail. Different words are far fewer than words,
different stems fewer still: each batch looks up its different words once, and a worker encodes
each once. Values are bytes, put together per text by Arrow.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers; when there are more, those not met since the last turn are dropped.
REMEMBERED = 800_000
STOPS = ".,;:!?"


def words_of(texts: pa.Array, special: bool = False) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Words between ASCII white space, and for each text (null: none) where its words begin and end.

    A-Z is put in lower case, but with ``special`` only in texts where no special token could
    hide. A text without words has one empty word.
    """
    lists = split_words(texts, special)
    return lists.offsets.to_numpy(), lists.values.dictionary_encode()


def split_words(texts: pa.Array, special: bool = False) -> pa.ListArray:
    texts = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lower = pc.ascii_lower(texts)
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<"), texts, lower) if special else lower)


def stem_and_tail(word: str) -> tuple[str, str] | None:
    """Latin-1 letters and the stops after them; None for any other word."""
    stem = word.rstrip(STOPS)
    if stem.isalpha() and (stem.isascii() or max(stem) < "Ā"):
        return stem, word[len(stem) :]
    return None


class Memory:
    """Values of words in two generations, so that frequent words outlast a turn.

    A value is a tuple of bytes; ``encode_stems`` gets stems that ``stem_and_tail`` has cut.
    """

    def __init__(self, encode_stems: Callable[[list[str]], list], encode_word: Callable[[str], tuple[bytes, ...]]):
        self.encode_stems, self.encode_word = encode_stems, encode_word
        self.new: dict[str, tuple[bytes, ...]] = {}
        self.old: dict[str, tuple[bytes, ...]] = {}

    def values(self, words: list[str]) -> list[tuple[bytes, ...]]:
        found = list(map(self.new.get, words))
        if None in found:
            if len(self.new) > REMEMBERED:
                self.old, self.new = self.new, {}
            self._learn([w for w in words if w not in self.new])
            found = list(map(self.new.get, words))
        return found

    def texts(self, texts: pa.Array) -> list[tuple[np.ndarray, memoryview]]:
        """Per component of the values: for each text, the edges of its bytes, and the bytes."""
        offsets, words = words_of(texts, special=True)
        values = self.values(words.dictionary.to_pylist())
        result = []
        for component in zip(*values, strict=True) if values else [(), ()]:
            joined = pa.array(component, pa.large_binary()).take(words.indices)
            edges = np.frombuffer(joined.buffers()[1], np.int64) if len(joined) else np.zeros(1, np.int64)
            data = memoryview(joined.buffers()[2]) if joined.buffers()[2] is not None else memoryview(b"")
            result.append((edges[offsets], data))
        return result

    def _learn(self, words: list[str]) -> None:
        cut: dict[str, tuple[str, str]] = {}
        unknown: dict[str, None] = {}
        for word in words:
            if (value := self.old.get(word)) is not None:
                self.new[word] = value
            elif (parts := stem_and_tail(word)) is None:
                self.new[word] = self.encode_word(word)
            else:
                stem, tail = parts
                if tail:
                    cut[word] = parts
                if stem not in self.new:
                    if (value := self.old.get(stem)) is not None:
                        self.new[stem] = value
                    else:
                        unknown[stem] = None
        stems = list(unknown)
        self.new.update(zip(stems, self.encode_stems(stems) if stems else [], strict=True))
        for word, (stem, tail) in cut.items():
            if tail not in self.new:
                self.new[tail] = self.encode_word(tail)
            self.new[word] = tuple(a + b for a, b in zip(self.new[stem], self.new[tail], strict=True))
