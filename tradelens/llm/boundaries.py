"""Where byte-level BPE cuts a text before it merges, found without a regex.

Every code point has a class (letter, number, other, white space, space). What
lies ahead matters in two places only, a contraction after an apostrophe and the
last white space before something else, and is folded into the class. A word
boundary then follows from an automaton of eight states. Each class is a function
from state to state; composing functions is associative, so the states at all
places come from a prefix scan over blocks of columns in numpy. There are few
distinct compositions, and each is a number in a table of products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken

LETTER, NUMBER, OTHER, WHITE, SPACE = range(5)
_POINTS = 0x110000
# Symbols: what the automaton reads. A contraction's apostrophe tells how much follows it; white space
# is the last before something else (alone, or a space that joins it), or not. From FIRST on the same,
# at the start of a text.
_LETTER, _NUMBER, _OTHER, _QUOTE1, _QUOTE2, _WHITE, _LAST, _JOINS = range(8)
_FIRST = 8
# States: what is open before a place.
_CLOSED, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _IN_WHITE, _JOINED, _ONE_MORE, _TWO_MORE = range(8)
_STATES = 8
_ROWS = 256
# The letters that follow an apostrophe in a contraction.
_AFTER_QUOTE = "stmd"
_PAIRS_AFTER_QUOTE = ("re", "ve", "ll")


def class_table() -> np.ndarray:
    """The class of each code point, as the tokenizer's own Unicode tables have it."""
    points = np.array([i for i in range(_POINTS) if not 0xD800 <= i < 0xE000], "<u4")
    text = points.tobytes().decode("utf-32-le")
    single = {bytes([b]): b for b in range(256)}
    table = np.full(_POINTS, OTHER, np.uint8)
    for kind, name in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        library = tiktoken.Encoding("classes", pat_str=kind, mergeable_ranks=single, special_tokens={})
        held = bytes(library.encode_ordinary(text)).decode()
        table[np.frombuffer(held.encode("utf-32-le"), "<u4")] = name
    table[ord(" ")] = SPACE
    return table


def _step(symbol: int, state: int) -> tuple[int, bool]:
    """The next state, and whether a word begins at the symbol."""
    if symbol >= _FIRST:
        symbol, state = symbol - _FIRST, _CLOSED
    if state == _TWO_MORE:
        return _ONE_MORE, False
    if state == _ONE_MORE:
        return _CLOSED, False
    if symbol in (_LETTER, _NUMBER):
        inside = _IN_LETTERS if symbol == _LETTER else _IN_NUMBERS
        return inside, state not in (inside, _JOINED)
    if symbol == _WHITE:
        return _IN_WHITE, state != _IN_WHITE
    if symbol in (_LAST, _JOINS):
        return (_CLOSED if symbol == _LAST else _JOINED), True
    if state in (_IN_OTHERS, _JOINED):  # an apostrophe among other signs is one of them
        return _IN_OTHERS, False
    return {_OTHER: _IN_OTHERS, _QUOTE1: _ONE_MORE, _QUOTE2: _TWO_MORE}[symbol], True


def _products() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each symbol's function, product of any two numbers, and the state that a number makes of CLOSED."""
    symbols = [tuple(_step(s, q)[0] for q in range(_STATES)) for s in range(2 * _FIRST)]
    number = {tuple(range(_STATES)): 0}  # the identity pads blocks
    found = [tuple(range(_STATES))]
    for f in found:
        for g in symbols:
            after = tuple(g[q] for q in f)
            if after not in number:
                number[after] = len(found)
                found.append(after)
    table = np.array([[number[tuple(g[q] for q in f)] for g in found] for f in found], np.uint16)
    return np.array([number[s] for s in symbols], np.int32), table, np.array([f[_CLOSED] for f in found], np.uint8)


_NUMBER_OF, _PRODUCT, _FROM_CLOSED = _products()
_BEGINS = np.array([[_step(s, q)[1] for q in range(_STATES)] for s in range(2 * _FIRST)])
_FLAT = _PRODUCT.reshape(-1).astype(np.int32)
_WIDTH = len(_PRODUCT)


def _then(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _FLAT.take(first * _WIDTH + second)


def scan(functions: np.ndarray) -> np.ndarray:
    """Products of all functions up to each place: within blocks side by side, then over the blocks' totals."""
    n = len(functions)
    columns = -(-n // _ROWS)
    if columns <= 1:
        out = functions.copy()
        for i in range(1, n):
            out[i] = _PRODUCT[out[i - 1], out[i]]
        return out
    block = np.zeros(columns * _ROWS, np.int32)
    block[:n] = functions
    block = np.ascontiguousarray(block.reshape(columns, _ROWS).T)
    for row in range(1, _ROWS):
        block[row] = _then(block[row - 1], block[row])
    block[:, 1:] = _then(np.broadcast_to(scan(block[-1])[:-1], (_ROWS, columns - 1)), block[:, 1:])
    return block.T.reshape(-1)[:n]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each begins."""
    places = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[places]
    points = lead.astype(np.uint32)
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF8, 3)):
        some = np.flatnonzero((lead >= low) & (lead < high))
        value = points[some] & (0x3F >> more)
        for k in range(1, more + 1):
            value = value << 6 | (data[places[some] + k] & 0x3F)
        points[some] = value
    return points, places


def symbols(points: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What the automaton reads, from classes and the one or two code points ahead in the same text."""
    n = len(points)
    kind = table[points]
    closes = np.ones(n, bool)  # the text ends here
    closes[:-1] = first[1:]
    out = kind.copy()  # letters, numbers and others are their own symbols
    white = np.flatnonzero(kind >= WHITE)
    ahead = np.minimum(white + 1, n - 1)
    last = ~closes[white] & (kind[ahead] < WHITE)
    out[white] = np.where(last, np.where(kind[white] == SPACE, _JOINS, _LAST), _WHITE)

    quote = np.flatnonzero(points == ord("'"))
    quote = quote[~closes[quote]]
    one = points[quote + 1]
    out[quote[np.isin(one, [ord(c) for c in _AFTER_QUOTE])]] = _QUOTE1
    quote, one = quote[~closes[quote + 1]], one[~closes[quote + 1]]
    two = points[quote + 2]
    pairs = np.zeros(len(quote), bool)
    for a, b in _PAIRS_AFTER_QUOTE:
        pairs |= (one == ord(a)) & (two == ord(b))
    out[quote[pairs]] = _QUOTE2
    return out + first.astype(np.uint8) * np.uint8(_FIRST)


def word_starts(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Byte places at which words begin in texts laid end to end; ``starts``: where non-empty texts begin."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, places = code_points(data)
    first = np.zeros(len(points), bool)
    first[np.searchsorted(places, starts)] = True
    read = symbols(points, first, table)
    state = _FROM_CLOSED[scan(_NUMBER_OF[read])]
    before = np.concatenate((np.zeros(1, np.uint8), state[:-1]))  # CLOSED, then the state behind the place before
    return places[_BEGINS.take(read.astype(np.int32) * _STATES + before)]


def flat_texts(texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """The texts' bytes end to end (buffer and view) and where each text begins, with the end."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    whole = texts.buffers()[2] or pa.py_buffer(b"")
    data = whole.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return data, np.frombuffer(data, np.uint8), offsets - offsets[0]


def words(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts (null: empty) one after the other, as slices of their bytes, and how many end with each text."""
    buffer, data, offsets = flat_texts(texts)
    starts = word_starts(data, np.unique(offsets[:-1][np.diff(offsets) > 0]), table)
    cut = np.concatenate((starts, [len(data)])).astype(np.int32)
    found = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cut), buffer])
    return found, np.searchsorted(starts, offsets[1:])
