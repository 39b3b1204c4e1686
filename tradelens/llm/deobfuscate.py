"""Noisy-channel restoration of disguised words.

A written word is a character lattice: a letter stands for itself, a digit or
sign for the letters it imitates, a run of one character for one or two of it,
and signs or spaces between single letters for nothing. Viterbi decoding finds
the lattice path that the corpus's character four-gram model likes best. A word
without any such sign has one path only, itself, and is not decoded; nor is a
number, unless it repeats a digit. A character written twice may well be meant,
so such a word is also read with both.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np

# The letters that digits and signs imitate.
LEET = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "bg",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
}
_SIGNS = re.escape("".join(LEET))
EDGE = 0
OTHER = 27
SIZE = 28
_SUSPECT = re.compile(rf"[^\W\d_][{_SIGNS}]|[{_SIGNS}][^\W\d_]|([^\W_])\1\1")
_DOUBLED = re.compile(r"([^\W_])\1")
_DOTTED = re.compile(rf"[\w{_SIGNS}](?:[.\-_*~/][\w{_SIGNS}]){{2,}}$")
_TRIM = re.compile(r"^[\s.,;:?\"'()\[\]{}<>«»“”„¿¡-]+|[\s.,;:?!\"'()\[\]{}<>«»“”„-]+$")
_TOKEN = re.compile(r"[^\W_]+")
_SIGN_COST = 0.5
_SELF_COST = 6.0
#: Letters of words whose decoding is remembered.
_REMEMBERED = 64
_CHUNK = 1024


def codes(text: str) -> np.ndarray:
    """Letters a-z as 1-26, other letters as OTHER, anything else as EDGE; runs of EDGE as they are."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    return _table()[np.minimum(points, _TOP)]


_TOP = 0x24F


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    table = np.array([OTHER if chr(i).isalpha() else EDGE for i in range(_TOP + 1)], np.int32)
    table[_TOP] = EDGE
    table[97:123] = np.arange(1, 27)
    return table


def four_grams(text: str) -> np.ndarray:
    """How often each four-gram of codes occurs; grams that end in a second EDGE do not count."""
    c = np.concatenate(([EDGE] * 3, codes(text), [EDGE]))
    c = c[np.concatenate(([True] * 3, (c[3:] != EDGE) | (c[2:-1] != EDGE)))]
    # After an edge a new word begins: what lies before the edge is forgotten.
    a, b, x, y = c[:-3], c[1:-2], c[2:-1], c[3:]
    b = np.where(x == EDGE, EDGE, b)
    a = np.where(b == EDGE, EDGE, a)
    return np.bincount(((a * SIZE + b) * SIZE + x) * SIZE + y, minlength=SIZE**4)


class CharModel:
    """Log probabilities of a letter after three, backing off to fewer."""

    def __init__(self, counts: np.ndarray, backoff: float = 5.0):
        n4 = counts.reshape(SIZE, SIZE, SIZE, SIZE).astype(np.float64)
        n3, n2 = n4.sum(axis=0), n4.sum(axis=(0, 1))
        n1 = n2.sum(axis=0)
        p = (n1 + 1) / (n1.sum() + SIZE)
        for n in (n2, n3, n4):
            p = (n + backoff * p) / (n.sum(axis=-1, keepdims=True) + backoff)
        self.log = np.log(p)
        self._remembered = lru_cache(maxsize=50_000)(self._decode)

    def decode(self, word: str, twice: bool = False) -> str:
        """The likeliest reading of a written word; with ``twice`` of doubled characters as two."""
        run = self._remembered if len(word) <= _REMEMBERED else self._decode
        return run(word, twice)

    def _decode(self, word: str, twice: bool) -> str:
        paths = {(EDGE, EDGE, EDGE): (0.0, "", None)}
        for char, count in _runs(word):
            options = _options(char, min(count, 2))
            if twice and count == 2:
                options = [o for o in options if len(o[0]) == 2] or options
            best: dict[tuple, tuple] = {}
            for (a, b, c), (score, read, past) in paths.items():
                for letters, cost in options:
                    key, total = (a, b, c), score - cost
                    for letter in letters:
                        code = _code(letter)
                        total += self.log[key[0], key[1], key[2], code]
                        key = (key[1], key[2], code)
                    if key not in best or best[key][0] < total:
                        best[key] = (total, read + letters, past)
            paths = _aside(best)
        return self._likeliest(paths)

    def _likeliest(self, paths: dict[tuple, tuple]) -> str:
        ended = [(score + self.log[k[0], k[1], k[2], EDGE], read, past) for k, (score, read, past) in paths.items()]
        top = max(e[0] for e in ended)
        return max(_whole(read, past) for score, read, past in ended if score == top)

    def segment(self, letters: str) -> list[str]:
        """The words that letters written without space between them are likeliest to be."""
        paths = {(EDGE, EDGE, EDGE): (0.0, "", None)}
        for at, letter in enumerate(letters):
            code, best = _code(letter), {}
            for (a, b, c), (score, read, past) in paths.items():
                steps = [((a, b, c), score, read + letter)]
                if at:
                    steps.append(((EDGE, EDGE, EDGE), score + self.log[a, b, c, EDGE], f"{read} {letter}"))
                for (x, y, z), total, text in steps:
                    total += self.log[x, y, z, code]
                    if (y, z, code) not in best or best[y, z, code][0] < total:
                        best[y, z, code] = (total, text, past)
            paths = _aside(best)
        return self._likeliest(paths).split()


def _aside(paths: dict[tuple, tuple]) -> dict[tuple, tuple]:
    """Long readings are laid aside in chunks that later paths share, so that a path's step costs the same at any length."""
    if all(len(read) < _CHUNK for _, read, _ in paths.values()):
        return paths
    kept: dict[tuple, tuple] = {}

    def chunk(read: str, past: tuple | None) -> tuple:
        return kept.setdefault((read, id(past)), (read, past))

    return {k: (score, "", chunk(read, past)) for k, (score, read, past) in paths.items()}


def _whole(read: str, past: tuple | None) -> str:
    parts = [read]
    while past is not None:
        parts.append(past[0])
        past = past[1]
    return "".join(reversed(parts))


def _code(letter: str) -> int:
    n = ord(letter) - 96
    return n if 1 <= n <= 26 else OTHER


def _runs(word: str) -> Iterator[tuple[str, int]]:
    last, count = "", 0
    for char in word:
        if char == last:
            count += 1
        else:
            if last:
                yield last, count
            last, count = char, 1
    if last:
        yield last, count


@lru_cache(maxsize=4096)
def _options(char: str, count: int) -> list[tuple[str, float]]:
    """What one character, or two and more of it (``count`` 2), may stand for, and at what cost."""
    if char in LEET:
        out = [(x * r, _SIGN_COST * r) for x in LEET[char] for r in range(1, min(count, 2) + 1)]
        return out + [(char, _SELF_COST)] if char.isdigit() else out
    if not char.isalpha():
        return [("", 0.0)]
    if count == 1:
        return [(char, 0.0)]
    return [(char, 0.0), (char * 2, 0.0)]


def tokens(word: str, model: CharModel, may: Callable[[str], bool] | None = None) -> list[str]:
    """The words that a written word (no white space) stands for, restored where it looks disguised.

    ``may`` tells of a part of the word whether any reading of it is of interest;
    where none is, it is not decoded and only what is written counts.
    """
    word = _TRIM.sub("", word.lower())
    if _DOTTED.match(word):
        return [model.decode(word)] if may is None or may(word) else []
    if _SUSPECT.search(word):
        return [t for part in re.split(rf"[^\w{_SIGNS}]+", word) if part for t in _readings(part, model, may) if t]
    return [t for part in _TOKEN.findall(word) for t in (_readings(part, model, may) if _DOUBLED.search(part) else [part])]


def _readings(part: str, model: CharModel, may: Callable[[str], bool] | None) -> list[str]:
    decoded = may is None or may(part)
    if not _SUSPECT.search(part):
        written = _TOKEN.findall(part)
    elif decoded and any(count == 2 for _, count in _runs(part)):
        written = [model.decode(part, True)]
    else:
        written = []
    if not decoded:
        return written
    read = model.decode(part)
    return written if read in written else [*written, read]


class Readable:
    """Whether some path of a word's lattice spells one of ``words`` or begins with one of ``beginnings``.

    The lattice is walked over the words' own beginnings, letter by letter, and
    mostly left after a few.
    """

    def __init__(self, words: Iterable[str], beginnings: Iterable[str]):
        self.words, self.beginnings = frozenset(words), frozenset(beginnings)
        self.open = {w[:k] for w in self.words | self.beginnings for k in range(len(w) + 1)}

    def __call__(self, word: str) -> bool:
        reached = {""}
        for char, count in _runs(word):
            further = {r + letters for r in reached for letters, _ in _options(char, min(count, 2))}
            if not self.beginnings.isdisjoint(further):
                return True
            reached = further & self.open
            if not reached:
                return False
        return not self.words.isdisjoint(reached)


def disguised(word: str) -> bool:
    word = _TRIM.sub("", word.lower())
    return bool(_DOTTED.match(word) or _SUSPECT.search(word))


def readings(word: str, model: CharModel) -> list[str]:
    """Those of ``tokens`` that the word does not hold as they are."""
    written = _TOKEN.findall(_TRIM.sub("", word.lower()))
    return [t for t in tokens(word, model) if t not in written]


def single(word: str) -> str:
    """The only character of a word but for punctuation around it, or nothing."""
    if len(word) > 1:
        word = _TRIM.sub("", word)
    return word if len(word) == 1 else ""
