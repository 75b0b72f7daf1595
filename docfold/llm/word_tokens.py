"""Token ids of many texts at once with a tokenizer that drops white space.

Such a tokenizer's parts never reach over ASCII white space, nothing is composed across it, and it leaves no trace in the ids. So
ids of a text are the ids of its words one after another. Words repeat: the library encodes each once per worker, and texts are
put together by numpy. The result equals encoding whole texts.
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
from tokenizers import Tokenizer

from docfold.llm.tokens import _byte_names

KNOWN_WORDS = 500_000
#: Letters up to U+023F, then ASCII punctuation but the apostrophe: two parts of the tokenizer's pattern at most.
_SIMPLE = re.compile(rb"((?:[A-Za-z]|[\xc3-\xc8][\x80-\xbf])+)([!-&(-/:-@\[-`{-~]*)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)


class _Numbers(dict):
    """Numbers words in the order they are met; ``fresh`` lists those met since it was emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class WordEncoder:
    """``encode(texts)`` gives all ids in one array and the number of ids of each text; special tokens are not added."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        said = json.loads(self.tokenizer.to_str())
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.added = [t["content"].encode() for t in said.get("added_tokens") or []]
        self.by_words = self._drops_white_space(said)
        self.names = _byte_names()
        self.tail = functools.lru_cache(10_000)(self._tail)
        self._reset()

    @staticmethod
    def _drops_white_space(said: dict) -> bool:
        """Whether the file is of the kind described above: parts are what a pattern matches, and the pattern matches no white space."""
        normal = said.get("normalizer") or {}
        steps = normal.get("normalizers") or ([normal] if normal else [])
        split = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        return (
            all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
            and split.get("type") == "Split" and split.get("behavior") == "Removed" and bool(split.get("invert"))
            and split.get("pattern") == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
            and said["model"]["type"] == "BPE" and not said["model"].get("dropout")
        )

    def _reset(self) -> None:
        self.numbers, self.stems = _Numbers(), {}
        self.count, self.offset = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.dtype)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        if not self.by_words or any(a in t for t in raw for a in self.added):
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            counts = np.array([len(x) for x in found], np.int64)
            return np.fromiter((i for x in found for i in x), self.dtype, int(counts.sum())), counts
        if len(self.numbers) > KNOWN_WORDS:
            self._reset()
        split = [t.split() for t in raw]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(sizes.sum()))
        self._learn()
        count = self.count[words]
        ends = np.append(0, np.cumsum(count))
        places = np.repeat(self.offset[words] - ends[:-1], count)
        places += np.arange(ends[-1])
        ids = self.pool[places]
        return ids, np.diff(ends[np.append(0, np.cumsum(sizes))])

    def _tail(self, punctuation: bytes) -> list[int]:
        return self.tokenizer.encode(punctuation.decode(), add_special_tokens=False).ids if punctuation else []

    def _learn(self) -> None:
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if not fresh:
            return
        found: list = [None] * len(fresh)
        others = []
        merge, names, tail, stems = self.tokenizer.model.tokenize, self.names, self.tail, self.stems
        for i, word in enumerate(fresh):
            # what is composed already is only lower-cased by the normalizer, and a part is merged by itself
            letters = word.rstrip(b".,;:!?")
            if letters.isalpha():
                lower, text, rest = letters.lower(), None, word[len(letters) :]
            else:
                match = _SIMPLE.fullmatch(word)
                text = match and match[1].decode()
                if not (text and text.isalpha() and "\u0130" not in text):
                    others.append(i)
                    continue
                lower, rest = text.lower().encode(), match[2]
            ids = stems.get(lower)
            if ids is None:
                ids = stems[lower] = [t.id for t in merge(lower.decode() if text is None else lower.decode("latin-1").translate(names))]
            found[i] = ids + tail(rest) if rest else ids
        for i, e in zip(others, self.tokenizer.encode_batch([fresh[i].decode("utf-8", "surrogatepass") for i in others], add_special_tokens=False)):
            found[i] = e.ids
        count = np.array([len(x) for x in found], np.int64)
        self.offset = np.append(self.offset, len(self.pool) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.pool = np.append(self.pool, np.fromiter((i for x in found for i in x), self.dtype, int(count.sum())))
