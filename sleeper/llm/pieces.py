"""Whole texts as pieces that byte-level BPE encodes one by one.

The pattern of byte-level BPE puts a space in front of the word after it, and no
match goes over any other white space. So a text may be cut before every space
that something other than white space follows: the pieces' ids, one after the
other, are the text's. Few pieces are distinct, so each is encoded once and kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A space ends a piece unless white space (to either library) or nothing follows.
_CUT = re.compile(r" (?=[^\s\x1c-\x1f\x85])")
_UNSAFE = re.compile(r" (?:[\s\x1c-\x1f\x85]|\Z)")
#: Signs that are a word of their own behind letters.
STOPS = frozenset(".,;:!?")
#: Letters, signs and perhaps a new line with letters and signs behind them: words of their own, one after the other.
#: No sign that contractions or special tokens hold.
_SIGNS = r'[!"#$%&()*+,\-./:;=?@\\^_`{}~]'
_PARTS = re.compile(rf"(\n?[^\W\d_]+)({_SIGNS}*)(?:\n([^\W\d_]+)({_SIGNS}*))?")
#: What a byte is: a letter (or one of several bytes of it), a sign, a new line, a space, other white space, else.
LETTER, SIGN, LINE, SPACE, WHITE, ELSE = range(6)
_KINDS = np.array([LETTER if i > 127 or chr(i).isalpha() else SIGN if re.match(_SIGNS, chr(i)) else LINE if i == 10
                   else SPACE if i == 32 else WHITE if chr(i).isspace() else ELSE for i in range(256)], np.uint8)
#: The same for each code point, where it has been looked up.
_UNKNOWN = 255
_CHARACTERS = np.full(0x110000, _UNKNOWN, np.uint8)
#: What a byte (of kind k) and the next (of kind n) tell, at k << 3 | n: a piece begins here, its piece stays whole,
#: a word ends here if the piece does not.
BEGINS, WHOLE, ENDS = 1, 2, 4


def _pairs() -> np.ndarray:
    out = np.zeros(64, np.uint8)
    for k in range(6):
        for n in range(6):
            white = n in (LINE, SPACE, WHITE)
            whole = k >= WHITE or k == SPACE and white or k == LINE and white and n != SPACE
            out[k << 3 | n] = BEGINS * (k == SPACE and not white) | WHOLE * whole | ENDS * (k not in (n, SPACE))
    return out


_PAIRS = _pairs()
#: Distinct pieces a worker keeps.
KEPT = 1_000_000
#: Bytes of text that are cut and looked up at once (a longer text is taken whole).
RUN_BYTES = 8 << 20


def cut(text: str) -> list[str]:
    """The pieces of a text; all but the first have lost the space they begin with."""
    return _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")


def parts(piece: str) -> list[str] | None:
    """The words that a piece is made of, if it is plain, each as a piece; those that no space goes before
    begin with a line feed, as first pieces do."""
    m = _PARTS.fullmatch(piece)
    if not m:
        return None
    word, signs, then, more = m.groups()
    if not word.lstrip("\n").isalpha() or then and not then.isalpha():
        return None  # numbers that are no digits
    return [word] + ["\n" + x for x in (signs, then and "\n", then, more) if x]


def _kinds(raw: np.ndarray) -> np.ndarray:
    """What each byte of UTF-8 is; a character's first byte says what it is, the others are LETTER."""
    out = _KINDS[raw]
    at = np.flatnonzero(raw >= 0xc0)  # a character of several bytes begins
    if len(at):
        first = raw[at]
        more = (first >= 0xe0).astype(np.uint8) + (first >= 0xf0)
        code = (first & (0x1f >> more)).astype(np.int32) << 6 | raw[at + 1] & 0x3f
        for k in (1, 2):
            longer = np.flatnonzero(more >= k)
            code[longer] = code[longer] << 6 | raw[at[longer] + 1 + k] & 0x3f
        kind = _CHARACTERS[code]
        if len(new := np.unique(code[kind == _UNKNOWN])):
            _CHARACTERS[new] = [LETTER if c.isalpha() else WHITE if c.isspace() else ELSE for c in map(chr, new.tolist())]
            kind = _CHARACTERS[code]
        out[at] = kind
    return out


def word_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where texts in UTF-8, none of them empty, are cut so that the ids of what is between are the texts' ids.

    ``texts`` is where texts begin. A piece (from a space that something other than white
    space follows) is cut into words where letters, signs and a new line meet, if it has
    nothing else; or it stays whole.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    kind = _kinds(raw)
    told = kind << 3
    told[:-1] |= kind[1:]
    lasts = np.append(texts[1:], len(raw)) - 1
    told[lasts] = kind[lasts] << 3 | WHITE  # nothing follows
    told = _PAIRS[told]
    starts = (told & BEGINS).astype(bool)
    starts[texts] = True
    ends = (told[:-1] & ENDS).astype(bool)
    whole = np.flatnonzero(told & WHOLE)
    if len(whole):
        pieces = np.flatnonzero(starts)
        plain = np.ones(len(pieces), bool)
        plain[np.searchsorted(pieces, whole, "right") - 1] = False
        ends &= np.repeat(plain, np.diff(np.append(pieces, len(raw))))[:-1]
    starts[1:] |= ends
    return np.flatnonzero(starts)


class Pieces:
    """Remembers what ``encode`` (pieces -> ids as bytes, one for each) gave for each piece.

    When it is full, the younger half goes: frequent pieces come early. Columns have a
    memory of their own: the number of each word, in the order of ``bounds`` and ``raw``.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kept: int = KEPT):
        self.encode, self.kept, self.ids = encode, kept, {}
        self.numbers, self.bounds, self.raw = {}, np.zeros(1, np.int64), b""

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        cuts = [cut(t) for t in texts]
        for c in cuts:  # a first piece has no space before it: it is its own kind
            c[0] = "\n" + c[0]
        found, new = self._look_up(cuts)
        if len(new) + len(self.ids) > self.kept:
            self.ids = dict(islice(self.ids.items(), self.kept // 2))
            found, new = self._look_up(cuts)
        self.learn(new)
        known = self.ids
        return [b"".join([known[p] if x is None else x for p, x in zip(c, f)]) for c, f in zip(cuts, found)]

    def column(self, texts: pa.Array, last: bytes) -> pa.Array:
        """The ids of each text of an Arrow column (null: empty) and ``last`` behind them: a run's texts are cut as
        bytes, put together by Arrow, and each distinct word of the run is looked up once."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        runs = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // RUN_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(texts)]
        return pa.concat_arrays([self._run(texts.slice(x, y - x), last) for x, y in zip(cuts, cuts[1:])])

    def _run(self, texts: pa.Array, last: bytes) -> pa.Array:
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, int)
        raw = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        starts = word_starts(raw, ends[:-1][ends[:-1] < ends[1:]])
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)])
        coded = words.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        known = len(self.bounds) - 1
        ids = pa.Array.from_buffers(pa.large_binary(), known + 1, [  # and ``last``, which ends each text
            None, pa.py_buffer(np.append(self.bounds, len(self.raw) + len(last))), pa.py_buffer(self.raw + last)])
        until = np.searchsorted(starts, ends[1:])
        whole = ids.take(pa.array(np.insert(numbers[coded.indices.to_numpy()], until, known)))
        at = np.frombuffer(whole.buffers()[1], np.int64)[np.append(0, until + np.arange(1, len(until) + 1))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(at), whole.buffers()[2]]) \
            .cast(pa.binary())

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of different words; those that aren't known are encoded."""
        def found() -> np.ndarray:
            return np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))

        numbers = found()
        if np.count_nonzero(numbers < 0) + len(self.numbers) > self.kept:
            half = self.kept // 2
            self.numbers, self.bounds = dict(islice(self.numbers.items(), half)), self.bounds[:half + 1]
            self.raw = self.raw[:self.bounds[-1]]
            numbers = found()
        at = np.flatnonzero(numbers < 0)
        if len(at):
            new = [words[i] for i in at.tolist()]
            ids, known = self.encode(new), len(self.numbers)
            numbers[at] = np.arange(known, known + len(new))
            self.numbers.update(zip(new, range(known, known + len(new))))
            self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))
            self.raw += b"".join(ids)
        return numbers

    def _look_up(self, cuts: list[list[str]]) -> tuple[list[list[bytes | None]], set[str]]:
        """What is known of each piece, and the pieces that aren't."""
        get, new = self.ids.get, set()
        found = [list(map(get, c)) for c in cuts]
        for c, f in zip(cuts, found):
            if None in f:
                new.update([p for p, x in zip(c, f) if x is None])
        return found, new

    def learn(self, new: set[str]) -> None:
        """Encode pieces that aren't known; those made of several words by these."""
        known, made = self.ids, {p: x for p in new if not p.isalpha() and (x := parts(p)) and len(x) > 1}
        one = list({p for p in new if p not in made} | {x for w in made.values() for x in w if x not in known})
        known.update(zip(one, self.encode([p[1:] if p[:1] == "\n" else " " + p for p in one])))
        for p, words in made.items():
            known[p] = b"".join([known[x] for x in words])
