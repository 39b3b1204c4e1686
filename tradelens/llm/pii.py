"""Personal data by weak supervision.

Base rules find e-mail addresses, IP addresses, card and phone numbers. Looser
patterns propose more spans. Four labelers (strict formats, gazetteers, context
words, surroundings) vote on every span, base or proposed: 1 for, 0 against, -1
abstains. Expectation-maximisation estimates the labelers' reliabilities from
the counts of vote patterns over the whole corpus. The posteriors then train a
naive Bayes classifier of spans, which also sees what no labeler does (a span's
shape, the words and characters around it) and decides on the proposed ones. Base
spans always stay. The main path has built-in functions only; the driver sees
counts of vote patterns and feature values, whose number is bounded.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .matching import CONTEXT, joined, let, matches, overlaps

KINDS = ["email", "ip", "card", "phone"]
THRESHOLD = 0.5
ROUNDS = 50
# What a labeler is taken to be before its votes are seen, better than chance, and the part of the spans that this weighs.
_PRIOR = {(1, "1"): 0.7, (1, "0"): 0.1, (1, "-1"): 0.2, (0, "1"): 0.2, (0, "0"): 0.6, (0, "-1"): 0.2}
_PRIOR_PART = 0.1
#: Smoothing of the classifier: how many spans of all kinds a kind's own are mixed with, and values of a feature.
_POOLED = 4.0
_VALUES = 4
#: Values that words beside a span are hashed to.
_WORDS = 256
LABELERS = ["format", "gazetteer", "context", "edges"]

# The base patterns, with possessive repeats and starts at the beginning of a run only (or where the
# last match ended): the same matches, in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

# Proposals beyond the base.
SPELLED = (
    r"(?i)(?<![a-z0-9._%+-])[a-z0-9][a-z0-9._%+-]{0,63}\x20?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[a-z0-9-]{1,63}"
    r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\x20?[a-z0-9-]{1,63}){1,4}"
)
DIGITS = r"(?<![0-9])[0-9]{12,19}(?![0-9])"
PLAIN_PHONE = r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

# Gazetteers.
_TOP_LEVEL = "com org net edu gov int io co info biz de fr es uk it nl be ch at eu us ca au jp cn in br ru pl se no dk fi pt".split()
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|6011|65)"
_RESERVED = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|2[3-5][0-9])\."
_CALLING = r"^\+?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_FOR = {
    "email": r"mail|contact|write|address|courriel|correo|kontakt",
    "ip": r"\bip\b|host|server|address|login|adresse|direcci",
    "card": r"card|visa|master|credit|amex|karte|carte|tarjeta",
    "phone": r"tel|phone|call|fax|mobile|anruf|appel|llam",
}
_AGAINST = r"version|\bv\.?$|isbn|order|invoice|section|chapter|sha|hash|licen|\bid\b"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _base_ok(kind: str, text: Column) -> Column:
    digits = F.length(_digits(text))
    return {
        "email": F.lit(True),
        "ip": text.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": digits.between(12, 19) & F.call_function("luhn_check", _digits(text)),
        "phone": digits.between(9, 15),
    }[kind]


def _passes(kind: str, m: Column) -> Column:
    return _base_ok(kind, m["text"])


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, or 0 where ``no`` (by default wherever not ``yes``), or -1."""
    vote = F.when(yes, 1)
    return vote.otherwise(0) if no is None else vote.when(no, 0).otherwise(-1)


def _votes(kind: str, m: Column) -> list[Column]:
    text, before, digits = m["text"], F.lower(m["before"]), _digits(m["text"])
    ending = F.right(text, F.lit(CONTEXT))
    strict = {
        "email": _vote(text.rlike("^[A-Za-z0-9]") & ending.rlike(r"(?i)[a-z0-9][\x20)\]}.][a-z]{2,}$")),
        "ip": _vote(~text.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(F.call_function("luhn_check", digits)),
        "phone": _vote(F.length(digits).between(10, 13), F.lit(False)),
    }[kind]
    listed = {
        "email": _vote(F.lower(F.regexp_extract(ending, r"([A-Za-z]+)$", 1)).isin(_TOP_LEVEL), F.lit(False)),
        "ip": _vote(F.lit(False), text.rlike(_RESERVED)),
        "card": _vote(digits.rlike(_ISSUERS)),
        "phone": _vote(F.when(F.startswith(text, F.lit("+")), text.rlike(_CALLING)).otherwise(digits.rlike("^[2-9]"))),
    }[kind]
    context = _vote(before.rlike(_FOR[kind]), before.rlike(_AGAINST))
    edges = _vote(~before.rlike(r"[\p{L}\p{N}_=/-]$") & ~m["after"].rlike(r"^[\p{L}\p{N}_=/-]"))
    return [strict, listed, context, edges]


def _word(text: Column, pattern: str) -> Column:
    """The word that a pattern finds at an end of ``text``, as one of ``_WORDS`` numbers; none and digits apart."""
    word = F.regexp_extract(F.lower(text), pattern, 1)
    number = F.pmod(F.xxhash64(word), F.lit(_WORDS)).cast("string")
    return F.when(word == "", "-").when(word.rlike("^[0-9]"), "9").otherwise(number)


def _side(char: Column) -> Column:
    """The class of the character beside a span."""
    return F.when(char == "", "none").when(char.rlike(r"[\p{L}]"), "letter").when(char.rlike("[0-9]"), "digit").when(char.rlike(r"\s"), "space").otherwise("sign")


def _features(m: Column, size: Column) -> list[Column]:
    """Length and shape of a span (groups of digits and the signs in it), the word before it, and the characters beside it."""
    ending = F.right(m["text"], F.lit(4 * CONTEXT))
    groups = F.least(F.size(F.regexp_extract_all(ending, F.lit("[0-9]+"), F.lit(0))), F.lit(5)).cast("string")
    signs = [F.when(ending.rlike(c), F.lit(n)).otherwise("") for n, c in (("s", " "), ("d", r"\."), ("h", "-"), ("p", r"[()]"), ("+", r"\+"), ("@", "@"))]
    return [size, F.concat(groups, *signs), _word(m["before"], r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$"), _side(F.right(m["before"], F.lit(1))), _side(m["after"])]


def _spans(kind: str, found: Column, base: bool) -> Column:
    def span(m: Column) -> Column:
        votes = [v.cast("string") for v in _votes(kind, m)]
        size = F.least(F.floor((m["end"] - m["start"]) / 4), F.lit(8)).cast("string")
        seen = [*votes, *_features(m, size)]
        return F.struct(
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.lit(base).alias("base"),
            F.concat_ws("|", F.lit(kind), *votes).alias("pattern"),
            F.array(*[F.concat(F.lit(f"{kind}|{i}="), f) for i, f in enumerate(seen)]).alias("features"),
        )

    return F.transform(found, span)


def _all_spans(text: Column) -> Column:
    """Base spans, and proposed ones that overlap none of them."""
    # Each is implied by the pattern that it stands before.
    gates = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": text.rlike(r"\+[0-9]"),
    }
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    base = F.concat(
        *[
            _spans(k, F.filter(matches(text, patterns[k], gates[k]), partial(_passes, k)), True)
            for k in KINDS
        ]
    )
    spelled = F.contains(F.lower(text), F.lit("dot")) & text.rlike(r"(?i)[(\[{\x20]at[)\]}\x20].{1,66}[(\[{\x20]dot[)\]}\x20]")
    more = F.concat(
        _spans("email", matches(text, SPELLED, spelled), False),
        _spans("card", matches(text, DIGITS, text.rlike("[0-9]{12}")), False),
        _spans("phone", matches(text, PLAIN_PHONE, text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")), False),
    )
    both = F.struct(base.alias("base"), more.alias("more"))
    return let(
        both,
        lambda z: F.concat(z["base"], F.filter(z["more"], lambda m: ~F.exists(z["base"], lambda b: overlaps(m, b)))),
    )


def estimate(patterns: dict[str, int]) -> dict[str, float]:
    """Posterior of each vote pattern under labelers of unknown reliability (expectation-maximisation)."""
    rows = [(p, n, p.split("|")[0], p.split("|")[1 : 1 + len(LABELERS)]) for p, n in sorted(patterns.items())]
    post = {p: (1 + votes.count("1")) / (2 + votes.count("1") + votes.count("0")) for p, _, _, votes in rows}
    strength = 5 + _PRIOR_PART * sum(patterns.values())
    for _ in range(ROUNDS):
        prior, total = defaultdict(lambda: 1.0), defaultdict(lambda: 2.0)
        said = {(k, c, v): strength * x for k in range(len(LABELERS)) for (c, v), x in _PRIOR.items()}
        size = {(k, c): strength for k in range(len(LABELERS)) for c in (0, 1)}
        for p, n, kind, votes in rows:
            prior[kind] += n * post[p]
            total[kind] += n
            for k, v in enumerate(votes):
                for c, w in ((1, post[p]), (0, 1 - post[p])):
                    said[k, c, v] += n * w
                    size[k, c] += n * w
        for p, _, kind, votes in rows:
            odds = math.log(prior[kind]) - math.log(total[kind] - prior[kind])
            odds += sum(math.log(said[k, 1, v] / size[k, 1]) - math.log(said[k, 0, v] / size[k, 0]) for k, v in enumerate(votes))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def classifier(counts: dict[tuple[str, str], int]) -> dict[str, float]:
    """Log odds of every kind and of every feature ``kind|number=value``, under naive Bayes trained on the posteriors.

    ``counts``: spans by vote pattern and feature; under the feature "" all of a pattern.
    """
    post = estimate({p: n for (p, f), n in counts.items() if not f})
    # Weights of each class by kind, and by kind and feature; "" pools the kinds.
    weight = defaultdict(float)
    for (p, f), n in counts.items():
        for c, w in ((1, n * post[p]), (0, n * (1 - post[p]))):
            for k in (p.split("|")[0], ""):
                weight[c, k, f.partition("|")[2]] += w

    def chance(c: int, kind: str, f: str) -> float:
        pooled = (weight[c, "", f] + 1 / _VALUES) / (weight[c, "", ""] + 1)
        return (weight[c, kind, f] + _POOLED * pooled) / (weight[c, kind, ""] + _POOLED)

    odds = {}
    for p, f in counts:
        kind, value = p.split("|")[0], f.partition("|")[2]
        if f:
            odds[f] = math.log(chance(1, kind, value) / chance(0, kind, value))
        else:
            odds[kind] = math.log((weight[1, kind, ""] + 1) / (weight[0, kind, ""] + 1))
    return odds


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and pii: array of (kind, start, end, base), one row per row.

    Places are code points of the text, the end exclusive; null texts are empty
    and have no spans. Learns from all rows of ``docs``; repeated rows count and
    get equal spans. An empty table gives an empty result. A column pii is
    replaced; no other column but the text is used.
    """
    spans = _all_spans(text_or_empty(text))
    voted = docs.select(F.inline(F.transform(spans, lambda s: F.struct(s["pattern"].alias("pattern"), s["features"].alias("features")))))
    told = voted.select("pattern", F.explode(F.concat(F.array(F.lit("")), "features")).alias("feature"))
    counts = told.groupBy("pattern", "feature").agg(F.count(F.lit(1)).alias("n")).collect()
    odds = sorted(classifier({(r["pattern"], r["feature"]): r["n"] for r in counts}).items())
    known = F.map_from_arrays(
        F.array(*[F.lit(k) for k, _ in odds]).cast("array<string>"), F.array(*[F.lit(v) for _, v in odds]).cast("array<double>")
    )

    def likely(s: Column) -> Column:
        of = lambda k: F.coalesce(F.try_element_at(known, k), F.lit(0.0))
        return F.aggregate(s["features"], of(s["kind"]), lambda total, f: total + of(f)) >= math.log(THRESHOLD / (1 - THRESHOLD))

    kept = F.filter(spans, lambda s: s["base"] | likely(s))
    fields = ("kind", "start", "end", "base")
    return docs.withColumn("pii", F.transform(kept, lambda s: F.struct(*[s[f].alias(f) for f in fields])))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first."""
    order = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        cut = F.struct(
            s["end"].alias("at"), F.concat(state["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")
        )
        longer = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], cut).otherwise(longer)

    done = F.aggregate(order, first, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _is_kind(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def digest(spans: Column) -> list[Column]:
    """n_<kind> of the base spans, base_sha256 and spans."""
    base = F.filter(spans, lambda s: s["base"])
    return [
        *[F.size(F.filter(base, partial(_is_kind, k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base, KINDS).cast("binary"), 256).alias("base_sha256"),
        joined(spans, KINDS).alias("spans"),
    ]
