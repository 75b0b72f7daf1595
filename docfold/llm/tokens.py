"""Token ids of many texts at once with a tokenizer file of the tokenizers library.

A byte-level BPE file splits a text by its pattern and then merges inside each part, so ids of a text are the ids of its
chunks one after another, wherever the chunks are cut between parts. Chunks repeat, so each is encoded by the library
once per worker and looked up afterwards, with numpy, in a table of fixed size. The result equals encoding whole texts.
"""

from __future__ import annotations

import functools
import json

import numpy as np
from tokenizers import Tokenizer

SLOT_BITS = 22
POOL_LIMIT = 1 << 24
KEY_BYTES = 16
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_K1, _K2, _K3, _K4 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD))

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,;:!?")] = True
#: Bytes after which a white-space run has certainly ended: no ASCII white space or separator, no first byte of a wider one.
_SOLID = np.ones(256, dtype=bool)
_SOLID[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = False
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[33:127] = True


def _byte_names() -> dict[int, str]:
    """The character by which byte-level vocabularies name each byte: itself if visible, else the next from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and file."""
    return TextEncoder(path)


class TextEncoder:
    """``encode(texts)`` gives all ids in one array and the number of ids of each text; special tokens are not added."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        said = json.loads(self.tokenizer.to_str())
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.added = [t["content"].encode() for t in said.get("added_tokens") or []]
        split = said.get("pre_tokenizer") or {}
        model = said["model"]
        self.chunked = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not said.get("normalizer") and model["type"] == "BPE" and not model.get("dropout")
        )
        self.names = _byte_names()
        self._reset()

    def _reset(self) -> None:
        n = 1 << SLOT_BITS
        self.first, self.second = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.length, self.count, self.offset = np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.zeros(n, np.uint32)
        self.pool, self.used = np.zeros(1 << 20, self.dtype), 0
        self.long: dict[bytes, tuple[int, int]] = {}

    def _keep(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        at = self.used
        self.pool[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b" ".join(raw)
        if not self.chunked or any(t in joined for t in self.added):
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            counts = np.array([len(x) for x in found], dtype=np.int64)
            return np.fromiter((i for x in found for i in x), self.dtype, int(counts.sum())), counts
        if self.used > POOL_LIMIT:
            self._reset()
        return self._encode_chunks(raw, joined)

    def _encode_chunks(self, raw: list[bytes], joined: bytes) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if raw else np.zeros(0, np.int64)
        n = len(joined)
        buf = np.frombuffer(joined + b" " * (KEY_BYTES + 8), np.uint8)
        here, after = buf[:n], buf[1 : n + 1]
        before = np.concatenate([[np.uint8(32)], here[:-1]]) if n else here
        solid = _SOLID[after]
        line = (here == 10) & _VISIBLE[before] & solid
        cut = ((here == 32) & solid) | line | (_STOP[here] & _LETTER[before])
        cut[1:] |= line[:-1]
        gaps = (begin + sizes)[:-1]
        cut[gaps] = True
        cut[begin[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, n))
        keep = np.ones(len(starts), dtype=bool)
        keep[np.searchsorted(starts, gaps)] = False  # the blanks between texts
        starts, lengths = starts[keep], lengths[keep]
        offset, count = self._look_up(buf, joined, starts, lengths)
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(offset - (ends - count), count) + np.arange(total)]
        bounds = np.searchsorted(starts, np.append(begin, n + 1))
        ends = np.concatenate([[0], ends])
        return ids, np.diff(ends[bounds])

    def _look_up(self, buf, joined, starts, lengths):
        words = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
        a = words[starts] & _MASKS[np.minimum(lengths, 8)]
        b = words[starts + 8] & _MASKS[np.clip(lengths - 8, 0, 8)]
        mixed = (a * _K1) ^ ((b + _K3) * _K2) ^ (lengths.astype(np.uint64) * _K3)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _K4
        slot = (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        short = lengths <= KEY_BYTES
        hit = short & (self.first[slot] == a) & (self.second[slot] == b) & (self.length[slot] == lengths)
        offset, count = self.offset[slot].astype(np.int64), self.count[slot].astype(np.int64)
        missed = np.flatnonzero(~hit)
        if len(missed):
            keys = [joined[s : s + k] for s, k in zip(starts[missed].tolist(), lengths[missed].tolist())]
            fresh = [k for k in dict.fromkeys(keys) if k not in self.long]
            known = dict(zip(fresh, self._encode_new(fresh)))
            self.long.update((k, v) for k, v in known.items() if len(k) > KEY_BYTES)
            placed = np.array([known.get(k) or self.long[k] for k in keys], dtype=np.int64)
            offset[missed], count[missed] = placed[:, 0], placed[:, 1]
            stored = missed[short[missed]]
            at = slot[stored]
            # of several chunks with one slot the last one stays, in all arrays alike
            last = dict(zip(at.tolist(), stored.tolist()))
            at, stored = np.fromiter(last.keys(), np.int64, len(last)), np.fromiter(last.values(), np.int64, len(last))
            self.first[at], self.second[at], self.length[at] = a[stored], b[stored], lengths[stored]
            self.offset[at], self.count[at] = offset[stored], count[stored]
        return offset, count

    def _encode_new(self, chunks: list[bytes]) -> list[tuple[int, int]]:
        """Pool place and number of ids of chunks not seen before. One word of Latin letters is one part: no split needed."""
        found: list = [None] * len(chunks)
        others = []
        merge = self.tokenizer.model.tokenize
        for i, chunk in enumerate(chunks):
            word = chunk[1:] if chunk[:1] == b" " else chunk
            if word.isalpha() or (word and max(word) < 0xC9 and word.decode("utf-8", "surrogatepass").isalpha()):
                found[i] = [t.id for t in merge(chunk.decode("latin-1").translate(self.names))]
            else:
                others.append(i)
        texts = [chunks[i].decode("utf-8", "surrogatepass") for i in others]
        for i, e in zip(others, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            found[i] = e.ids
        flat = np.fromiter((i for x in found for i in x), self.dtype, sum(map(len, found)))
        at = self._keep(flat)
        placed = []
        for x in found:
            placed.append((at, len(x)))
            at += len(x)
        return placed
