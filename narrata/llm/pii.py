"""Personal data by weak supervision, from SQL functions alone.

Strict patterns find base spans (e-mail, ip, card, phone); they always stay. Looser patterns and
numbers that fail a check give more candidates. Five labelers vote on every candidate, for, against or
not at all: the strict pattern (which votes against numbers that fail its check and not at all on forms that it
does not know), its structure, a gazetteer, words in front, and what touches it.
Expectation-maximisation estimates for each kind how reliable each labeler is, from the counts of vote
patterns alone, and from that how likely a candidate is personal data. These probabilities train the
span classifier (naive Bayes on shape, surroundings and check digit); candidates it is sure of
are added unless they overlap a base span.

A text is scanned once, in the task that reads it; the candidates of a document stay in its row. Only
counts of vote patterns (at most 3^5 for a kind) and of feature values are shuffled, and the
estimates that go through the driver are a few hundred numbers whatever the input.

The patterns are written so that a match never needs a second try from inside the same run of
characters, nor a group repeated by recursion, and places are summed up by blocks: texts of any length, with any number of
matches, are read in linear time. Only where a text holds both strict and loose spans is each loose one compared
with each strict one.

Defined cases: a null text counts as empty and has no spans; positions are code points from 0, the end
exclusive; repeated rows are judged alike and all count; without candidates nothing is learned and nothing
added; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import staged

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["strict", "structure", "gazetteer", "context", "touching"]
FEATURES = ["length", "digits", "separators", "before", "after", "cue", "check"]
#: A candidate is added when the classifier gives it at least this probability.
MIN_PROBABILITY = 0.9
STEPS = 8
CONTEXT = 30

_EMAIL_RUN = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
EMAIL = _EMAIL_RUN + r"@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?![A-Za-z0-9-]|\.[A-Za-z0-9-])"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x20-]*?(?![0-9]|[\x20-][0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOOSE_EMAIL = _EMAIL_RUN + r"\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?[(\[]dot[)\]]\x20?|\.)[A-Za-z]{2,12}"
LOOSE_PHONE = r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"

#: The gazetteer. Ends of e-mail hosts, first digits of card numbers, and country codes.
TOP_DOMAINS = "com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch at be se no dk fi pl pt"
CARD_STARTS = "34 35 36 37 38 4 51 52 53 54 55 22 23 24 25 26 27 60 62 64 65"
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98 351 352 353 358 420"
#: Words in front that speak for a kind, and words that speak against personal data.
CUES = {
    "email": "mail|contact|write|correo|courriel|schreib",
    "ip": "ip|addr|host|server|login|client",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": "phone|call|tel|mobile|cell|fax|ruf|appel|llam",
}
AGAINST = "version|order|invoice|isbn|serial|part|build|release|section|chapter"
NO_SPANS = "array<struct<start:int,end:int,value:string,before:string,left:string,right:string>>"
#: Spans whose places are summed up together; the sums of these blocks are summed up in turn.
SUMMED = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums_before(sizes: Column, first: Column) -> Column:
    """For each number of an array, ``first`` and the sum of those before it."""
    nothing = F.struct(first.alias("at"), F.array().cast("array<int>").alias("sums"))
    step = lambda s, size: F.struct((s["at"] + size).alias("at"), F.concat(s["sums"], F.array(s["at"])).alias("sums"))
    return F.aggregate(sizes, nothing, step, lambda s: s["sums"])


def _places(sizes: Column) -> Column:
    """The same for arrays of any length, by blocks: a fold copies what it has, so it must stay short."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / SUMMED).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(sizes, b * SUMMED + 1, F.lit(SUMMED)))
    total = lambda block: F.aggregate(block, F.lit(0), lambda s, x: s + x)
    placed = _let(blocks, lambda every: _let(
        _sums_before(F.transform(every, total), F.lit(0)),
        lambda firsts: F.flatten(F.transform(every, lambda block, b: _sums_before(block, F.get(firsts, b)))),
    ))
    return F.when(F.size(sizes) > 0, placed).otherwise(F.array().cast("array<int>"))


def found(text: Column, pattern: str) -> Column:
    """All leftmost matches that don't overlap, in code points, with what stands beside them.

    (start, end, value, before: at most ``CONTEXT`` characters since the match in front, left and right: the
    characters that touch it, empty at the ends of the text)
    """
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def spans(of: Column) -> Column:
        matches, gaps = of["matches"], of["gaps"]
        sizes = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))

        def one(match, i, places):
            gap, behind = F.get(gaps, i), F.get(gaps, i + 1)
            start = F.get(places, i) + F.length(gap)
            left = F.when(gap != "", F.right(gap, F.lit(1))).otherwise(F.coalesce(F.right(F.get(matches, i - 1), F.lit(1)), F.lit("")))
            right = F.when(behind != "", F.left(behind, F.lit(1))).otherwise(F.coalesce(F.left(F.get(matches, i + 1), F.lit(1)), F.lit("")))
            return F.struct(
                start.alias("start"), (start + F.length(match)).alias("end"), match.alias("value"),
                F.lower(F.right(gap, F.lit(CONTEXT))).alias("before"), left.alias("left"), right.alias("right"),
            )

        return _let(_places(sizes), lambda places: F.transform(matches, lambda match, i: one(match, i, places)))

    return _let(F.struct(matches.alias("matches"), gaps.alias("gaps")), spans)


def _where(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(NO_SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """The check digit of a number of at most 20 digits."""
    padded, doubled = F.lpad(digits, 20, "0"), F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    digit = lambda at: F.substring(padded, at, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(20)), F.lit(0), lambda s, at: s + F.when(at % 2 == 1, F.get(doubled, digit(at))).otherwise(digit(at))
    )
    return total % 10 == 0


def _counted(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


def _listed(value: Column, words: str) -> Column:
    return F.array_contains(F.array(*[F.lit(w) for w in words.split()]), value)


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 0 against, -1 for no vote."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _votes(kind: int, value: Column, base: bool, before: Column, left: Column, right: Column) -> list[Column]:
    digits = _digits(value)
    if kind == 0:
        structure = value.rlike(r"[A-Za-z0-9]@.*\.[A-Za-z]{2,}$")
        gazetteer = _listed(F.lower(F.regexp_extract(value, r"([A-Za-z0-9]+)$", 1)), TOP_DOMAINS)
    elif kind == 1:
        structure = ~value.rlike(r"(^|\.)0[0-9]")
        gazetteer = ~value.rlike(r"^(0|127|255)\.")
    elif kind == 2:
        structure = passes_luhn(digits)
        gazetteer = _listed(F.substring(digits, 1, 2), CARD_STARTS) | _listed(F.substring(digits, 1, 1), CARD_STARTS)
    else:
        structure = value.rlike(r"[0-9]{3}[\x20.-][0-9]{4}$")
        codes = [F.regexp_extract(value, rf"^\+([0-9]{{{n}}})", 1) for n in (1, 2, 3)]
        listed = _listed(codes[0], COUNTRY_CODES) | _listed(codes[1], COUNTRY_CODES) | _listed(codes[2], COUNTRY_CODES)
        gazetteer = F.when(value.startswith("+"), listed)  # no vote on a number without a country code
    touching = left.rlike(r"[\p{L}0-9_]") | right.rlike(r"[\p{L}0-9_]")
    # The strict pattern has read loose numbers too and refused them; other loose forms it does not know.
    strict = 1 if base else 0 if kind == 2 else -1
    return [
        F.lit(strict), _vote(structure, ~structure), _vote(gazetteer, ~gazetteer),
        _vote(before.rlike(rf"(?:{CUES[KINDS[kind]]})"), before.rlike(rf"(?:{AGAINST})")), _vote(~touching, touching),
    ]


def _side(char: Column) -> Column:
    """Class of the character beside a span."""
    return F.when(char == "", 0).when(char.rlike(r"[\s]"), 1).when(char.rlike(r"\p{L}"), 2).when(char.rlike("[0-9]"), 3).otherwise(4)


def _features(kind: int, value: Column, before: Column, left: Column, right: Column) -> list[Column]:
    return [
        F.least(F.floor(F.length(value) / 4), F.lit(12)).cast("int"), F.least(F.length(_digits(value)), F.lit(20)),
        F.least(F.length(F.regexp_replace(value, r"[^\x20().-]", "")), F.lit(8)), _side(left), _side(right),
        before.rlike(rf"(?:{CUES[KINDS[kind]]})").cast("int"),
    ]


def _described(spans: Column, kind: int, base: bool) -> Column:
    def describe(span):
        beside = (span["before"], span["left"], span["right"])
        votes = _votes(kind, span["value"], base, *beside)
        check = votes[1] if kind == 2 else F.lit(-1)  # only a check digit says what the shape does not
        return F.struct(
            F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), F.lit(base).alias("base"),
            F.array(*votes).alias("votes"), F.array(*_features(kind, span["value"], *beside), check).alias("features"),
        )

    return F.transform(spans, describe)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, base, votes, features), by kind and start."""
    text = F.col("text")
    many_digits = text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?|(?<=0))"  # the zeros alone are a part too
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text",
        _where(text.contains("@"), found(text, EMAIL)).alias("email"),
        _where(text.rlike(r"[0-9]\.[0-9]"), F.filter(found(text, IP), lambda s: s["value"].rlike(rf"^{part}\.{part}\.{part}\.{part}$"))).alias("ip"),
        _where(many_digits, F.filter(found(text, CARD), lambda s: _counted(s["value"], 13, 19))).alias("number"),
        _where(text.contains("+"), F.filter(found(text, PHONE), lambda s: _counted(s["value"], 9, 15))).alias("phone"),
        _where(text.rlike(r"[(\[]at[)\]]"), found(text, LOOSE_EMAIL)).alias("loose_email"),
        _where(text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), found(text, LOOSE_PHONE)).alias("loose_phone"),
    )
    luhn = lambda s: passes_luhn(_digits(s["value"]))
    split = split.select(
        "doc_id", "text", "email", "ip", "phone", "loose_email", "loose_phone",
        F.filter("number", luhn).alias("card"), F.filter("number", lambda s: ~luhn(s)).alias("loose_card"),
    )
    base = F.concat("email", "ip", "card", "phone")
    apart = lambda spans: F.filter(
        spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    parts = [_described(F.col(name), kind, True) for kind, name in enumerate(KINDS)]
    parts += [_described(apart(F.col(f"loose_{KINDS[kind]}")), kind, False) for kind in (0, 2, 3)]
    return split.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _posterior(estimates: dict[int, dict], kind: Column, votes: Column) -> Column:
    """Probability of personal data given the votes, as an expression with the estimates as constants."""
    out = F.lit(0.5)
    for k, e in estimates.items():
        odds = F.lit(math.log(e["share"] / (1 - e["share"])))
        for j in range(len(LABELERS)):
            yes, no = e["yes"][j], e["no"][j]
            vote = F.get(votes, F.lit(j))
            odds = odds + F.when(vote == 1, math.log(yes / no)).when(vote == 0, math.log((1 - yes) / (1 - no))).otherwise(0.0)
        out = F.when(kind == k, 1 / (1 + F.exp(-odds))).otherwise(out)
    return out


def reliabilities(spans: DataFrame, steps: int = STEPS) -> dict[int, dict]:
    """Expectation-maximisation over the counts of vote patterns; ``spans`` has kind and votes.

    For each kind: the share of personal data, and for each labeler how often it votes for, among
    personal data (yes) and the rest (no). Each estimate starts from eight cases as one would expect.
    """
    patterns = staged(spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).coalesce(1), "pii-patterns")
    estimates = {k: {"share": 0.5, "yes": [0.8] * len(LABELERS), "no": [0.2] * len(LABELERS)} for k in range(len(KINDS))}
    for _ in range(steps):
        p = F.col("p")
        vote = [F.get("votes", F.lit(j)) for j in range(len(LABELERS))]
        sums = patterns.withColumn("p", _posterior(estimates, F.col("kind"), F.col("votes"))).groupBy("kind").agg(
            F.sum(p * F.col("n")).alias("real"), F.sum("n").alias("all"),
            F.array(*[F.sum(F.when(v == 1, p * F.col("n")).otherwise(0.0)) for v in vote]).alias("real_for"),
            F.array(*[F.sum(F.when(v >= 0, p * F.col("n")).otherwise(0.0)) for v in vote]).alias("real_voted"),
            F.array(*[F.sum(F.when(v == 1, (1 - p) * F.col("n")).otherwise(0.0)) for v in vote]).alias("rest_for"),
            F.array(*[F.sum(F.when(v >= 0, (1 - p) * F.col("n")).otherwise(0.0)) for v in vote]).alias("rest_voted"),
        ).collect()  # a row for each kind
        for r in sums:
            estimates[r["kind"]] = {
                "share": (r["real"] + 1) / (r["all"] + 2),
                "yes": [(a + 6.4) / (b + 8) for a, b in zip(r["real_for"], r["real_voted"], strict=True)],
                "no": [(a + 1.6) / (b + 8) for a, b in zip(r["rest_for"], r["rest_voted"], strict=True)],
            }
    return estimates


def classifier(spans: DataFrame, estimates: dict[int, dict]) -> dict[str, float]:
    """Naive Bayes trained on the estimated probabilities: log odds by ``kind/feature/value``, and ``kind`` alone.

    The number of weights is bounded by the ranges of the features.
    """
    p = _posterior(estimates, F.col("kind"), F.col("votes"))
    rows = (
        spans.select("kind", p.alias("p"), F.posexplode(F.concat(F.array(F.lit(0)), "features")).alias("feature", "value"))
        .groupBy("kind", "feature", "value").agg(F.sum("p").alias("real"), F.sum(1 - F.col("p")).alias("rest")).collect()
    )
    weights = {}
    totals = {r["kind"]: r for r in rows if r["feature"] == 0}
    for r in rows:
        of = totals[r["kind"]]
        if r["feature"] == 0:
            weights[f"{r['kind']}"] = math.log((of["real"] + 1) / (of["rest"] + 1))
        else:
            weights[f"{r['kind']}/{r['feature']}/{r['value']}"] = math.log(
                ((r["real"] + 1) / (of["real"] + 20)) / ((r["rest"] + 1) / (of["rest"] + 20))
            )
    return weights


def _score(weights: dict[str, float], span: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    kind = span["kind"].cast("string")
    keys = [F.concat_ws("/", kind, F.lit(str(j + 1)), F.get(span["features"], F.lit(j)).cast("string")) for j in range(len(FEATURES))]
    total = F.coalesce(F.try_element_at(table, kind), F.lit(0.0))
    for key in keys:
        total = total + F.coalesce(F.try_element_at(table, key), F.lit(0.0))
    return total


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (text form of all spans) and n_added."""
    read = staged(candidates(docs), "pii-spans")
    spans = read.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features")
    weights = classifier(spans, reliabilities(spans)) or {"": 0.0}
    every = F.filter("spans", lambda s: s["base"] | (_score(weights, s) >= math.log(MIN_PROBABILITY / (1 - MIN_PROBABILITY))))
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda k: F.filter("spans", lambda s: s["base"] & (s["kind"] == k))
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return read.select(
        "doc_id", *counts, F.sha2(_text(base), 256).alias("base_sha256"), _text(every).alias("spans"),
        (F.size(every) - F.size(base)).cast("long").alias("n_added"),
    )
