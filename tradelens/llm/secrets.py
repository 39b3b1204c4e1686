"""Secret scans: base patterns and a sliding-window entropy of candidate strings.

Candidates are runs of token characters that hold a letter and a digit. Over a
window of ``WINDOW`` characters the Shannon entropy of the class's characters is
kept up by adding the count of the character that enters and taking off the one
that leaves. Counts enter as whole millionths of ``c * log2(c)``, so the sum is
exact. What reaches the class's threshold in any window is a secret, unless the
allow-list knows it or a base match covers it. Built-in functions only.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .matching import joined, let, matches, of_kind, overlaps

KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = (
    r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
)
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Character classes, the first that holds all of a candidate's characters counts: symbols and least bits a character.
CLASSES = [
    ("hex", "0123456789abcdef", "^[0-9a-f-]+$", 3.0),
    ("HEX", "0123456789ABCDEF", "^[0-9A-F-]+$", 3.0),
    ("token", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", "", 3.7),
]
# What looks random but is no secret, cut out wherever it stands: UUIDs, dates, runs of the alphabet, sample values.
ALLOW = [
    "(?<![0-9A-Fa-f])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Fa-f])",
    "(?<![0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])",
    "(?i:abcdefgh|0123456789|qwerty)",
    "(?i:example|sample|placeholder|changeme|your[-_])",
]
#: Characters of a run that are walked over at once.
_STRETCH = 1 << 14
_UNIT = 1_000_000
_TERMS = [round(_UNIT * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]


def _at_least(text: Column, pattern: str, group: int, least: int) -> Column:
    return F.char_length(F.regexp_extract(text, pattern, group)) >= least


def _hot(text: Column, symbols: str, least: float) -> Column:
    """(first, last) character of ``text`` (from 1) in windows of ``least`` bits or more; first 0 if there are none."""
    terms = F.array(*map(F.lit, _TERMS))
    full = round(_UNIT * WINDOW * (math.log2(WINDOW) - least))

    def walk(chars: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), len(symbols) + 1).alias("counts"),
            F.lit(0).alias("sum"),
            F.lit(0).alias("first"),
            F.lit(0).alias("last"),
        )

        def step(s: Column, i: Column) -> Column:
            leaves = i > WINDOW
            gone = _place(symbols, F.element_at(chars, F.greatest(i - WINDOW, F.lit(1))))
            moved = F.struct(
                _place(symbols, F.element_at(chars, i)).alias("new"), F.when(leaves, gone).otherwise(-1).alias("old")
            )

            def update(m: Column) -> Column:
                counts = F.transform(
                    s["counts"],
                    lambda c, k: c + F.when(k == m["new"], 1).otherwise(0) - F.when(k == m["old"], 1).otherwise(0),
                )
                came, left = F.get(s["counts"], m["new"]), F.get(s["counts"], m["old"])
                change = F.get(terms, came + 1) - F.get(terms, came)
                change = F.when(m["old"] >= 0, change + F.get(terms, left - 1) - F.get(terms, left)).otherwise(change)
                total = s["sum"] + F.when(m["new"] == m["old"], 0).otherwise(change)
                hot = (i >= WINDOW) & (total <= full)
                return F.struct(
                    counts.alias("counts"),
                    total.alias("sum"),
                    F.when(hot & (s["first"] == 0), i - WINDOW + 1).otherwise(s["first"]).alias("first"),
                    F.when(hot, i).otherwise(s["last"]).alias("last"),
                )

            return let(moved, update)

        return F.aggregate(
            F.sequence(F.lit(1), F.size(chars)), zero, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
        )

    return let(F.regexp_extract_all(text, F.lit("."), F.lit(0)), walk)


def _place(symbols: str, char: Column) -> Column:
    """The character's number in the class, 0 outside it."""
    return F.call_function("locate", char, F.lit(symbols))


def _pieces(run: Column, base: Column) -> Column:
    """What is left of a run without allowed parts and base spans: start, text, in order."""
    allowed = "|".join(f"(?:{a})" for a in ALLOW)
    known = matches(run["text"], allowed, run["text"].rlike(allowed))
    known = F.transform(known, lambda m: F.struct((run["start"] + m["start"]).alias("start"), (run["start"] + m["end"]).alias("end")))
    covered = F.transform(F.filter(base, lambda b: overlaps(run, b)), lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    last = F.array(F.struct(run["end"].alias("start"), run["end"].alias("end")))
    cuts = F.array_sort(F.concat(known, covered, last))
    none = F.struct(run["start"].alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"))

    def step(state: Column, cut: Column) -> Column:
        free = F.array(F.struct(state["at"].alias("start"), cut["start"].alias("end")))
        grown = F.when(cut["start"] - state["at"] >= WINDOW, F.concat(state["out"], free)).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], cut["end"]).alias("at"), grown.alias("out"))

    free = F.aggregate(cuts, none, step, lambda s: s["out"])
    return F.transform(
        free, lambda p: F.struct(p["start"].alias("start"), F.substring(run["text"], p["start"] - run["start"] + 1, p["end"] - p["start"]).alias("text"))
    )


def _hot_stretches(text: Column, symbols: str, least: float) -> Column:
    """``_hot`` of a text of any length: stretches that overlap by a window are walked one by one."""
    begins = F.sequence(F.lit(0), F.greatest(F.lit(0), F.char_length(text) - WINDOW), F.lit(_STRETCH))

    def stretch(b: Column) -> Column:
        found = _hot(F.substring(text, b + 1, F.lit(_STRETCH + WINDOW - 1)), symbols, least)
        return let(found, lambda h: F.struct((b + h["first"]).alias("first"), (b + h["last"]).alias("last"), (h["first"] > 0).alias("hot")))

    found = F.filter(F.transform(begins, stretch), lambda h: h["hot"])
    return let(found, lambda f: F.struct(F.coalesce(F.array_min(F.transform(f, lambda h: h["first"])), F.lit(0)).alias("first"), F.coalesce(F.array_max(F.transform(f, lambda h: h["last"])), F.lit(0)).alias("last")))


def _entropy_spans(found: Column, base: Column) -> Column:
    pieces = F.flatten(F.transform(found, lambda run: _pieces(run, base)))
    pieces = F.filter(pieces, lambda m: m["text"].rlike("[A-Za-z]") & m["text"].rlike("[0-9]"))

    def span(m: Column) -> Column:
        hot = F.lit(None)
        for _, symbols, holds, least in reversed(CLASSES):
            here = _hot_stretches(m["text"], symbols, least)
            hot = F.when(m["text"].rlike(holds), here).otherwise(hot) if holds else here
        return let(
            hot,
            lambda h: F.struct(
                (m["start"] + h["first"] - 1).alias("start"), (m["start"] + h["last"]).alias("end"), (h["first"] > 0).alias("hot")
            ),
        )

    return F.filter(F.transform(pieces, span), lambda m: m["hot"])


def _all_spans(text: Column) -> Column:
    sign = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    keyed = sign & text.rlike(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]")
    long_run = text.rlike("[A-Za-z0-9+/_=-]{20}")
    base = F.concat(
        of_kind("assign", F.filter(matches(text, ASSIGN, keyed), lambda m: _at_least(m["text"], ASSIGN, 1, 6)), True),
        of_kind("access", F.filter(matches(text, ACCESS, F.contains(text, F.lit("AKIA"))), lambda m: F.char_length(m["text"]) >= 20), True),
        of_kind("hex", matches(text, HEX, long_run & text.rlike("[0-9a-f]{24}")), True),
    )
    runs = matches(text, CANDIDATE, long_run & text.rlike("[0-9]"))
    both = F.struct(base.alias("base"), runs.alias("runs"))
    return let(both, lambda z: F.concat(z["base"], of_kind("entropy", _entropy_spans(z["runs"], z["base"]), False)))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and secrets: array of (kind, start, end, base), one row per row.

    Places are code points of the text, the end exclusive; null texts are empty
    and have no spans. Repeated rows get equal spans; an empty table gives an
    empty result. A column secrets is replaced; no other column but the text is
    used.
    """
    return docs.withColumn("secrets", _all_spans(text_or_empty(text)))


def _is_kind(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def digest(spans: Column) -> list[Column]:
    """n_<kind> of the base spans, base_sha256 and spans."""
    base = F.filter(spans, lambda s: s["base"])
    return [
        *[F.size(F.filter(base, partial(_is_kind, k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base, KINDS).cast("binary"), 256).alias("base_sha256"),
        joined(spans, KINDS).alias("spans"),
    ]
