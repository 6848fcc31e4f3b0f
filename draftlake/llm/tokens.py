"""Token ids of whole texts by a public tokenizer file, remembered per piece between white space."""

from __future__ import annotations

import ctypes
import os
import re

import numpy as np

MEMORY, CHUNK_CHARS = 1_200_000, 1 << 19
_WHITE = re.compile(r"[ \t\n\r]+")
_ODD = re.compile("[\x1c-\x1f]")
# Fixed value: the split pattern of the tokenizer file, for counting the words inside a piece.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_loaded = {}


class _Runs:
    """Numbered runs of ids, one after the other."""

    def __init__(self):
        self.ids, self.starts, self.n = np.zeros(1 << 20, np.uint32), np.zeros(1 << 16, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        used, end = self.starts[self.n], self.n + len(sizes)
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while end >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[used:used + len(ids)] = ids
        self.starts[self.n + 1:end + 1] = used + np.cumsum(sizes)
        self.n = end

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs one after the other, size of each run)."""
        begin, size = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(size)
        return self.ids[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)], size


class _Numbers(dict):
    """Numbers for keys in order of first sight; ``fresh`` lists those seen since it was last emptied."""

    def __init__(self, *known):
        super().__init__(zip(known, range(len(known))))
        self.fresh: list[str] = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def of(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def news(self) -> list[str]:
        fresh, self.fresh = self.fresh, []
        return fresh


class PieceEncoder:
    """Encodes texts exactly as the tokenizers library does with add_special_tokens=False.

    The tokenizer never joins characters across white space, so a piece between white space always has the same ids: it
    is encoded once and remembered, in a memory of bounded size that starts anew when full. Unknown pieces are encoded
    many at a time; their words are told apart by the word-end mark of the last token of each word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = regex.compile(SPLIT + "| ").findall
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self):
        self.number = _Numbers()
        self.pieces = _Runs()
        self.word_number = _Numbers(" ")
        self.word_ids = _Runs()
        self.word_ids.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _plain(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _learn_words(self, fresh: list[str]) -> None:
        groups = [fresh[i:i + 500] for i in range(0, len(fresh), 500)]
        encoded = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, encoded):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                self.word_ids.add(ids, np.diff(cuts, prepend=0))
            else:
                lists = [self._plain(w) for w in group]
                self.word_ids.add(np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists]))

    def _learn(self, fresh: list[str]) -> None:
        even = self.tokenizer.normalizer.normalize_str(" ".join(fresh))
        if "<|" in even or even.count(" ") != len(fresh) - 1:
            lists = [self._plain(p) for p in fresh]
            self.pieces.add(np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists]))
        else:
            words = self.words(even)
            numbers = self.word_number.of(words)
            self._learn_words(self.word_number.news())
            ids, size = self.word_ids.take(numbers)
            piece = np.cumsum(numbers == 0)
            self.pieces.add(ids, np.bincount(piece, size, len(fresh)).astype(np.int64))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, taken in runs of bounded size; a longer text is a run of its own."""
        out, at = [], 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= CHUNK_CHARS:
                size += len(texts[end])
                end += 1
            out += self._encode_run(texts[at:end])
            at = end
        return out

    def _encode_run(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; unknown pieces of all texts are learned together, a bounded number at a time."""
        pieces = [[p for p in _WHITE.split(t) if p] if _ODD.search(t) else (t.lower() if _plain(t) else t).split() for t in texts]
        sizes = np.cumsum([0] + [len(p) for p in pieces])
        flat = [p for ps in pieces for p in ps]
        parts, counts = [], np.zeros(len(flat) + 1, np.int64)
        for at in range(0, len(flat), MEMORY // 4):
            part = flat[at:at + MEMORY // 4]
            if len(self.number) > MEMORY or len(self.word_number) > MEMORY:
                self._clear()
            numbers = self.number.of(part)
            fresh = self.number.news()
            if fresh:
                self._learn(fresh)
            taken, size = self.pieces.take(numbers)
            parts.append(taken)
            counts[at + 1:at + 1 + len(part)] = size
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return np.split(ids, np.cumsum(counts)[sizes[1:-1]])


def _plain(text: str) -> bool:
    """Latin-1 without special tokens: lower-casing it first changes no id, as nothing composes and case is one to one."""
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def encoder(path: str) -> PieceEncoder:
    """The process's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


def forget_encoders() -> None:
    """Give the memory of the process's encoders back; a reused worker would else hold it through tasks that encode nothing."""
    if _loaded:
        _loaded.clear()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # not glibc
            pass
