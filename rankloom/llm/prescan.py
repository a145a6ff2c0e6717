"""Pre-token boundaries of many texts at once, without regular expressions.

Every code point gets a symbol. Whether a position starts a pre-token depends on
its neighbours and on what follows it: a run of white space that reaches the end
of the text, or the letters of a contraction. What follows is the state of a small
automaton that reads the text from right to left. Each symbol is a function on the
automaton's states; functions compose associatively, and all compositions form a
small finite set, so a prefix scan over function numbers finds every state at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import numpy as np

# Symbols of code points.
OTHER, NUMBER, LETTER, SPACE, WHITE, APOSTROPHE, STMD, E, L, RV, END = range(11)
# Kinds of symbols: what may stand in one pre-token together.
_KIND = np.array([0, 1, 2, 3, 4, 0, 2, 2, 2, 2, 5], np.uint8)
# What a text begins with: nothing but white space, anything else, the letters of
# contractions (e, l, one of stmd, re or ve, ll), or white space before other text.
(S_END, S_TEXT, S_E, S_L, S_STMD, S_RE, S_LL, S_WHITE) = range(8)
_WIDTH = 64  # columns of a scan block


def _symbol_table(letters: Iterable[int], numbers: Iterable[int], white: Iterable[int]) -> np.ndarray:
    """Symbol of every code point, from the properties as the tokenizer's library has them."""
    table = np.full(0x110000, OTHER, np.uint8)
    for points, symbol in ((letters, LETTER), (numbers, NUMBER), (white, WHITE)):
        table[list(points)] = symbol
    table[ord(" ")] = SPACE
    table[ord("'")] = APOSTROPHE
    for marks, symbol in (("stmd", STMD), ("e", E), ("l", L), ("rv", RV)):
        table[[ord(c) for c in marks]] = symbol
    return table


def _every_character() -> str:
    """All code points that a text can hold, in order."""
    return "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)


@cache
def library_symbols() -> np.ndarray:
    """Letters, numbers and white space by the Unicode tables of the tiktoken library.

    The tokenizers library has the same tables, which a test checks.
    """
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}

    def points(pattern: str) -> list[int]:
        kept = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return [ord(c) for c in bytes(kept.encode_ordinary(_every_character())).decode()]

    return _symbol_table(points(r"\p{L}"), points(r"\p{N}"), points(r"\s"))


def _step(symbol: int, state: int) -> int:
    """State before a symbol, given the state after it."""
    if symbol == END:
        return S_END
    if symbol in (SPACE, WHITE):
        return S_END if state == S_END else S_WHITE
    if symbol == STMD:
        return S_STMD
    if symbol == E:
        return S_E
    if symbol == L:
        return S_LL if state in (S_L, S_LL) else S_L
    if symbol == RV:
        return S_RE if state == S_E else S_TEXT
    return S_TEXT


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each symbol's function, composition table, result of function and state)."""
    basic = [tuple(_step(c, q) for q in range(8)) for c in range(11)]
    known = {tuple(range(8)): 0}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in basic:
            both = tuple(g[f[q]] for q in range(8))
            if both not in known:
                known[both] = len(known)
                todo.append(both)
    every = list(known)
    assert len(every) < 256
    compose = np.array([[known[tuple(g[x] for x in f)] for g in every] for f in every], np.uint8)
    return np.array([known[g] for g in basic], np.uint8), compose, np.array(every, np.uint8)


def _scan(numbers: np.ndarray) -> np.ndarray:
    """Inclusive scan of function numbers: blocks side by side, then the blocks' totals."""
    _, compose, _ = _functions()
    size, flat = len(compose), compose.ravel()
    n = len(numbers)
    if n <= _WIDTH:
        out = numbers.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    blocks = -(-n // _WIDTH)
    padded = np.zeros(blocks * _WIDTH, np.uint8)  # 0 is the identity
    padded[:n] = numbers
    by_column = np.ascontiguousarray(padded.reshape(blocks, _WIDTH).T)
    for j in range(1, _WIDTH):
        by_column[j] = flat[by_column[j - 1].astype(np.intp) * size + by_column[j]]
    before = np.zeros(blocks, np.uint8)
    before[1:] = _scan(by_column[-1])[:-1]
    by_column = flat[before.astype(np.intp) * size + by_column]
    return np.ascontiguousarray(by_column.T).ravel()[:n]


def following(codes: np.ndarray) -> np.ndarray:
    """For every position, the state of the text that starts there."""
    numbers, _, apply = _functions()
    return apply[:, S_END][_scan(numbers[codes[::-1]])][::-1]


def boundaries(codes: np.ndarray) -> np.ndarray:
    """Whether a pre-token, or an END symbol, starts at each position."""
    kind = _KIND[codes]
    n = len(codes)
    state = following(codes)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = _KIND[END], kind[:-1]
    white = (kind == _KIND[SPACE]) | (kind == _KIND[WHITE])
    white_before = (before == _KIND[SPACE]) | (before == _KIND[WHITE])
    next_white = np.ones(n, bool)
    next_white[:-1] = white[1:]
    # White space: its run starts here, or it is the last of a run before other text.
    start = white & (~white_before | ((state == S_WHITE) & ~next_white))
    start |= ~white & (kind != before) & (before != _KIND[SPACE])
    ends = codes == END
    start |= ends
    marks = np.flatnonzero((codes[:-1] == APOSTROPHE) & start[:-1])
    if len(marks):
        after = state[marks + 1]
        letter = kind[marks + 1] == _KIND[LETTER]
        one = marks[letter & (after == S_STMD)]
        two = marks[letter & ((after == S_RE) | (after == S_LL))]
        start[np.concatenate([one, two]) + 1] = False
        start[one + 2] = True
        start[two + 3] = True
    return start


class Slices:
    """Pre-tokens of texts, as byte ranges of their joined UTF-8 form."""

    def __init__(self, texts: list[str], table: np.ndarray):
        joined = "\n".join(texts) + "\n"  # the separators' symbols are END, whatever stands in the texts
        self.raw = joined.encode()
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        codes = table[points]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1
        codes[ends] = END
        places = np.flatnonzero(boundaries(codes))
        real = codes[places] != END
        if len(self.raw) != len(points):
            widths = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            offsets = np.zeros(len(points) + 1, np.int64)
            np.cumsum(widths, out=offsets[1:])
            at, self.text_ends = offsets[places], offsets[ends]
        else:
            at, self.text_ends = places, ends
        #: Byte ranges of the pre-tokens, and of each text the first and last pre-token.
        self.starts = at[real]
        self.stops = at[1:][real[:-1]]
        self.last = np.searchsorted(self.starts, self.text_ends)
        self.first = np.concatenate([[0], self.last[:-1]]).astype(np.int64)

    def pieces(self) -> list[bytes]:
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.starts.tolist(), self.stops.tolist())]
