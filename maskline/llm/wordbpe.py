"""Token ids of whole texts by a ``tokenizers`` file: a batch at a time, each distinct word encoded once."""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa

END_ID = 1
SLICE = 1 << 18  # bytes of text that are cut into words at a time
CACHED = 48  # bytes of the longest word that is kept
BLANK, LETTER, MARK, OTHER = range(4)
MARKS = b".,;:!?*&%$#@|"
_loaded: dict[str, WordEncoder] = {}


def _kinds() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[[*b" \n"]] = BLANK
    kind[[*range(65, 91), *range(97, 123)]] = LETTER
    kind[[*MARKS]] = MARK
    return kind


_KIND = _kinds()
_WEIGHTS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordTable:
    """Ids of known words, by a 64-bit hash of their bytes: open addressing in numpy arrays.

    It is emptied when it holds ``limit`` words. Two of a million words share a hash with a
    probability of 3e-8.
    """

    limit = 1_200_000

    def __init__(self, kind: np.dtype):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.bits, self.n = 17, 0
        self._keys, self._at = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.begin, self.pool = np.zeros(1, np.int64), np.empty(0, self.kind)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, or -1."""
        out, open_, slot = np.full(len(h), -1, np.int64), np.arange(len(h)), self._slot(h)
        while len(open_):
            key = self._keys[slot]
            hit = (key == h[open_]) & (key != 0)
            out[open_[hit]] = self._at[slot[hit]]
            on = ~hit & (key != 0)
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, h: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """Store new words' ids; a hash of 0 is not kept for later. Returns their numbers."""
        numbers = np.arange(self.n, self.n + len(ids))
        sizes = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), self.kind)])
        self.n += len(ids)
        if 2 * self.n > 1 << self.bits:
            held, at = self._keys[self._keys != 0], self._at[self._keys != 0]
            self.bits = (4 * self.n).bit_length()
            self._keys, self._at = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
            self._put(held, at)
        self._put(h[h != 0], numbers[h != 0])
        return numbers

    def _put(self, h: np.ndarray, at: np.ndarray) -> None:
        slot = self._slot(h)
        while len(h):
            free = np.flatnonzero(self._keys[slot] == 0)
            slots, first = np.unique(slot[free], return_index=True)
            self._keys[slots], self._at[slots] = h[free[first]], at[free[first]]
            left = np.ones(len(h), bool)
            left[free[first]] = False
            h, at, slot = h[left], at[left], (slot[left] + 1) & ((1 << self.bits) - 1)


class WordEncoder:
    """Ids of texts as the ``tokenizers`` library gives them.

    Tokenizers whose normaliser and pre-tokeniser do not look across white space encode a text
    as the chain of its blank-separated words. Where they also lower-case and cut letters from
    marks, a word of Latin letters and trailing marks is the chain of these two: they are looked
    up apart, so each kept entry serves all its mixes, and the library's model takes the letters
    straight. Texts that hold ``<|`` (a special token could span words there) are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._code = "H" if self.kind.itemsize == 2 else "I"
        self.words = WordTable(self.kind)
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._shown = {ord(c): shown.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        self._tokenize = self.library.model.tokenize
        marks, tried = MARKS.decode(), ("The", "thou,", "Straße.", "ÉTÉ***", "ñandú!!", "x")
        self._splits = all(self._letters(w.rstrip(marks).lower()) + self._encoded(w[len(w.rstrip(marks)) :]) == self._encoded(w) for w in tried)

    def _encoded(self, word: str) -> bytes:
        return array(self._code, self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        shown = word if word.isascii() else word.translate(self._shown)
        return array(self._code, [t.id for t in self._tokenize(shown)]).tobytes()

    def ids(self, text: str | None, end_id: int = END_ID) -> np.ndarray:
        """Ids of the text (null: empty) and the end id, in the smallest unsigned kind."""
        return self.batch(pa.array([text], pa.string()), end_id)[0]

    def batch(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a column's texts (null: empty), each with the end id, one after the other; and their bounds."""
        texts = texts.fill_null("").cast(pa.large_string())
        if not len(texts):
            return np.empty(0, self.kind), np.zeros(1, np.int64)
        at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        parts, counts, first = [], [], 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, "right")) - 1)
            part, n = self._slice(data[at[first] : at[last]], at[first : last + 1] - at[first], end_id)
            parts.append(part)
            counts.append(n)
            first = last
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    def _slice(self, data: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for a run of texts, which start at the offsets ``at``: ids, and how many each has."""
        special = np.unique(np.searchsorted(at, np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)), "right") - 1).tolist()
        if self._splits and not special and len(data) <= 4 * SLICE:
            ids, n = self._chain(data, at)
            return np.insert(ids, np.cumsum(n), end_id), n + 1
        each = []
        for i in range(len(at) - 1):
            own = data[at[i] : at[i + 1]]
            if self._splits and i not in special:
                ids = self._long(own)
            else:
                ids = np.frombuffer(self._encoded(own.tobytes().decode()), self.kind)
            each.append(np.append(ids, self.kind.type(end_id)))
        return np.concatenate(each), np.array([len(x) for x in each])

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Ids of one text of any length, cut before blanks."""
        out, first = [], 0
        while first < len(data):
            last = min(first + SLICE, len(data))
            ahead = np.flatnonzero(_KIND[data[last : last + SLICE]] == BLANK)
            while last < len(data) and not len(ahead):
                last = min(last + SLICE, len(data))
                ahead = np.flatnonzero(_KIND[data[last : last + SLICE]] == BLANK)
            last += int(ahead[0]) if len(ahead) else 0
            out.append(self._chain(data[first:last], np.array([0, last - first]))[0])
            first = last
        return np.concatenate([np.empty(0, self.kind), *out])

    def _chain(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of texts that hold no special token."""
        n = len(data)
        if not n:
            return np.empty(0, self.kind), np.zeros(len(at) - 1, np.int64)
        kind, low = _KIND[data], data | ((data >= 65) & (data <= 90)).view(np.uint8) << 5
        lead = np.flatnonzero(data[:-1] == 0xC3)  # of U+00C0 to U+00FF, letters but for two
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        low[lead + 1] |= (data[lead + 1] <= 0x9E).view(np.uint8) << 5
        fresh = np.zeros(n + 1, bool)  # a text starts (or all ends) here
        fresh[at] = True
        blank = kind == BLANK
        begin = ~blank
        begin[1:] &= blank[:-1] | fresh[1:n]
        starts = np.flatnonzero(begin)
        if not len(starts):
            return np.empty(0, self.kind), np.zeros(len(at) - 1, np.int64)
        after = np.zeros(n, np.uint8)  # kind of the byte before, inside a word
        after[1:] = kind[:-1]
        after[begin] = BLANK
        odd = (kind == OTHER) | (kind == MARK) & (after == BLANK) | (kind == LETTER) & (after == MARK)
        plain = np.maximum.reduceat(odd.view(np.uint8), starts) == 0  # words of letters and trailing marks
        of_word = np.cumsum(begin, dtype=np.int32) - 1
        of_word[: starts[0]] = 0
        own = plain[of_word]
        cut = begin | (own & (kind == MARK) & (after == LETTER))
        tokens = np.flatnonzero(cut)
        last = ~blank
        last[:-1] &= blank[1:] | fresh[1:n] | cut[1:]
        ends = np.flatnonzero(last) + 1
        value = np.where(own, low, data)
        place = np.maximum(np.arange(n) - np.repeat(tokens, np.diff(tokens[1:], prepend=0, append=n)), 0)
        terms = (value.astype(np.uint64) + np.uint64(1)) * _WEIGHTS[np.minimum(place, 255)]
        terms[blank] = 0
        h = np.add.reduceat(terms, tokens)
        long = ends - tokens > CACHED
        h[long] = 0
        if self.words.n > self.words.limit:
            self.words.clear()
        number = self.words.find(h)
        new = np.flatnonzero(number < 0)
        if len(new):
            names, first, back = np.unique(np.where(long[new], np.arange(len(new), dtype=np.uint64), h[new]), return_index=True, return_inverse=True)
            which = new[first]
            got = []
            for a, b, letters in zip(tokens[which].tolist(), ends[which].tolist(), (own & (kind == LETTER))[tokens[which]].tolist(), strict=True):
                word = value[a:b].tobytes().decode()
                got.append(self._letters(word) if letters else self._encoded(word))
            number[new] = self.words.add(h[which], got)[back]
        counts = self.words.begin[number + 1] - self.words.begin[number]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = self.words.pool[np.repeat(self.words.begin[number] - upto[:-1], counts) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(tokens, at)])


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker for a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]
