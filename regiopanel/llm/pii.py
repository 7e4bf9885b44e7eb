"""Personal data found by labelers whose votes are weighed.

Patterns give candidate spans.  Labelers look at each: does a strict check hold, does a gazetteer know a
part of it, which words stand before it, does it stand alone.  Expectation-maximisation over
the counts of vote patterns estimates how far each labeler can be trusted, and a logistic classifier
is trained on the posteriors, with the kind and length as further features.  Base kinds
always stay; spans of other patterns are added where the classifier says so.

Everything that touches a text is a built-in expression.  The driver sees counts of patterns only,
whose number is bounded by the votes, kinds and length classes.

Offsets count code points, the end is exclusive.  Patterns have no nested choice: what they
repeat is possessive, so no text makes them slow or deep.

Defined results: a null text counts as empty and has no span; repeated rows get equal results; an
empty table gives an empty result.  Only the id and the text are read, so other columns can't clash;
``redact`` changes the text and, where there is one of that name, the column of its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import let, spare_name, text_or_empty
from regiopanel.llm.weak_labels import fit
from regiopanel.session import stored

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BESIDE = 40  # characters before a span in which its context is looked for
COUNTER_CUES = r"(?i)(version|release|isbn|invoice|order|article|section|chapter|artikel|numéro de page|página)"


@dataclass(frozen=True)
class Kind:
    """A pattern of candidates. ``known`` is a gazetteer as a pattern of the span, ``cues`` of what stands before."""

    name: str
    pattern: str
    base: bool
    hint: str  # a cheap necessary condition on the text
    known: str
    cues: str


# In the order in which kinds are listed; gazetteers and cue words are fixed values.
KINDS = [
    Kind("email", EMAIL, True, "@", r"(?i)\.(com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$", r"(?i)(mail|contact|kontakt|correo|courriel|write to|schreiben)"),
    Kind("ip", IP, True, ".", r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.|127\.)", r"(?i)(\bip\b|address|adresse|host|server|login|dirección)"),
    Kind("card", CARD, True, "", r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)", r"(?i)(card|visa|karte|carte|tarjeta|credit|kredit|pay|iban|konto)"),
    Kind("phone", PHONE, True, "+", r"^\+(1|33|34|43|41|44|49)\b", r"(?i)(tel|phone|call|mobil|fax|anruf|appel|llam)"),
    Kind("email", r"[A-Za-z0-9._%+-]++ ?+[(\[](?i:at)[)\]] ?+[A-Za-z0-9-]++(?: ?+[(\[](?i:dot)[)\]] ?+[A-Za-z0-9-]++)++", False, "", r"(?i)(com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$", r"(?i)(mail|contact|kontakt|correo|courriel|write to|schreiben)"),
    Kind("phone", r"(?<![0-9+.(-])[(]?+[0-9]{3}[)]?+[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", False, "", r"^[(]?[2-9]", r"(?i)(tel|phone|call|mobil|fax|anruf|appel|llam)"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, "-", r"^(?!000|666|9)[0-9]{3}-(?!00)", r"(?i)(social|ssn|security|insurance|versicherung|sécurité)"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?+[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])", False, "", r"^(DE|FR|ES|AT|CH|GB|IT|NL|BE|LU|PT|IE)", r"(?i)(iban|konto|account|compte|cuenta|bank)"),
]
NAMES = list(dict.fromkeys(k.name for k in KINDS))
FOUND = (
    "array<struct<start:int,kind:int,end:int,text:string,base:boolean,votes:array<int>,size:int>>"
)


def _hits(text: Column, kind: Kind) -> Column:
    """Array of (start, end, text) of leftmost matches: what lies between them gives their places."""
    between = F.split(text, kind.pattern, -1)
    step = lambda acc, k, gaps, hits: let(
        acc["at"] + F.length(F.get(gaps, k)),
        lambda start: F.struct(
            (start + F.length(F.get(hits, k))).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        start.alias("start"), (start + F.length(F.get(hits, k))).alias("end"), F.get(hits, k).alias("text")
                    )
                ),
            ).alias("out"),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def placed(hits: Column) -> Column:
        whole = let(
            between,
            lambda gaps: F.aggregate(
                F.sequence(F.lit(0), F.size(hits) - 1), first, lambda acc, k: step(acc, k, gaps, hits), lambda acc: acc["out"]
            ),
        )
        return F.when(F.size(hits) > 0, whole).otherwise(none)

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), placed)
    return F.when(text.contains(kind.hint), found).otherwise(none) if kind.hint else found


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def value(k: Column) -> Column:
        doubled = F.substring(F.reverse(digits), k + 1, 1).cast("int") * (1 + k % 2)
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    values = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value)
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _octet(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)


def _iban(span: Column) -> Column:
    """Remainder 1 when divided by 97, letters read as numbers, a digit at a time."""
    plain = F.replace(span, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    values = F.transform(
        F.sequence(F.lit(1), F.length(turned)),
        lambda k: F.when(F.substring(turned, k, F.lit(1)).rlike("[0-9]"), F.substring(turned, k, F.lit(1)).cast("int"))
        .otherwise(F.ascii(F.substring(turned, k, F.lit(1))) - 55),
    )
    rest = F.aggregate(values, F.lit(0), lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97)
    return rest == 1


def _valid(kind: Kind, span: Column) -> Column:
    """The base kinds' conditions; those that fail are no candidates."""
    digits = _digits(span)
    if not kind.base:
        return F.lit(True)
    if kind.name == "ip":
        return F.forall(F.split(span, r"\."), _octet)
    if kind.name == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _strict(kind: Kind, span: Column) -> Column:
    if kind.name == "iban":
        return _vote(_iban(span), ~_iban(span))
    if kind.name == "card":
        return _vote(F.length(_digits(span)).between(13, 16), F.length(_digits(span)) == 12)
    if kind.name == "email":
        return _vote(span.rlike(r"[A-Za-z]{2,}$"), span.rlike(r"[0-9]$"))
    if kind.name == "phone":
        return _vote(F.length(_digits(span)).between(10, 13), F.lit(False))
    return _vote(span.rlike(kind.known), F.lit(False))


def _votes(kind: Kind, text: Column, hit: Column) -> Column:
    span, start, end = hit["text"], hit["start"], hit["end"]
    near = F.substring(text, F.greatest(start - BESIDE, F.lit(0)) + 1, F.least(start, F.lit(BESIDE)))
    before, after = F.substring(text, start, F.lit(1)), F.substring(text, end + 1, F.lit(1))
    alone = ~F.when(start > 0, before.rlike(r"\w")).otherwise(False) & ~after.rlike(r"\w")
    same = _digits(span).rlike(r"^([0-9])\1{6,}$")
    return F.array(
        _strict(kind, span),
        _vote(span.rlike(kind.known), F.lit(False)),
        _vote(near.rlike(kind.cues), near.rlike(COUNTER_CUES)),
        _vote(alone, ~alone),
        _vote(F.lit(False), same),
    )


LABELERS = 5
SIZES = (12, 16, 24)


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by start and kind; those that meet a base span are left out."""

    def of(kind: Kind) -> Column:
        hits = F.filter(_hits(text, kind), lambda h: _valid(kind, h["text"]))
        return F.transform(
            hits,
            lambda h: F.struct(
                h["start"].alias("start"),
                F.lit(NAMES.index(kind.name)).alias("kind"),
                h["end"].alias("end"),
                h["text"].alias("text"),
                F.lit(kind.base).alias("base"),
                _votes(kind, text, h).alias("votes"),
                sum((F.when(F.length(h["text"]) > n, 1).otherwise(0) for n in SIZES), F.lit(0)).alias("size"),
            ),
        )

    base = F.concat(*[of(k) for k in KINDS if k.base])
    more = F.concat(*[of(k) for k in KINDS if not k.base])

    def joined(fixed: Column) -> Column:
        free = F.filter(
            more, lambda e: ~F.exists(fixed, lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"]))
        )
        return F.sort_array(F.concat(fixed, free))

    return let(base, joined).cast(FOUND)


@dataclass(frozen=True)
class SpanClassifier:
    bias: float
    votes: tuple[dict[int, float], ...]
    kinds: tuple[float, ...]
    sizes: tuple[float, ...]

    def score(self, span: Column) -> Column:
        odds = F.lit(self.bias)
        for j, w in enumerate(self.votes):
            vote = F.get(span["votes"], j)
            odds = odds + F.when(vote == 1, w[1]).when(vote == -1, w[-1]).otherwise(w[0])
        for i, w in enumerate(self.kinds):
            odds = odds + F.when(span["kind"] == i, w).otherwise(0.0)
        for i, w in enumerate(self.sizes):
            odds = odds + F.when(span["size"] == i, w).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


STEPS, RATE, DECAY = 400, 0.5, 1e-3
# First guess: labelers that vote for a span are mostly right, and candidates mostly are personal data.
GUESS = {True: {-1: 0.05, 0: 0.45, 1: 0.50}, False: {-1: 0.40, 0: 0.45, 1: 0.15}}


def train(counts: dict[tuple, int]) -> SpanClassifier:
    """From counts by (votes, kind, size): label model first, then logistic regression on its posteriors."""
    patterns: dict[tuple, int] = {}
    for (votes, _, _), n in counts.items():
        patterns[votes] = patterns.get(votes, 0) + n
    labels = fit(patterns, LABELERS, prior=0.5, guess=GUESS)
    rows = [(votes, kind, size, n, labels.posterior(votes)) for (votes, kind, size), n in sorted(counts.items())]
    total = sum(n for *_, n, _ in rows) or 1
    bias, kinds, sizes = 0.0, [0.0] * len(NAMES), [0.0] * (len(SIZES) + 1)
    weights = [{v: 0.0 for v in (-1, 0, 1)} for _ in range(LABELERS)]
    for _ in range(STEPS):
        grads: dict = {}
        for votes, kind, size, n, target in rows:
            odds = bias + sum(w[v] for w, v in zip(weights, votes, strict=True)) + kinds[kind] + sizes[size]
            error = n / total * (target - 1 / (1 + math.exp(-odds)))
            for key in ("bias", ("kind", kind), ("size", size), *enumerate(votes)):
                grads[key] = grads.get(key, 0.0) + error
        bias += RATE * grads.get("bias", 0.0)
        kinds = [w + RATE * (grads.get(("kind", i), 0.0) - DECAY * w) for i, w in enumerate(kinds)]
        sizes = [w + RATE * (grads.get(("size", i), 0.0) - DECAY * w) for i, w in enumerate(sizes)]
        for j, w in enumerate(weights):
            for v in w:
                w[v] += RATE * (grads.get((j, v), 0.0) - DECAY * w[v])
    return SpanClassifier(bias, tuple(weights), tuple(kinds), tuple(sizes))


def fit_spans(found: DataFrame, column: str = "found") -> SpanClassifier:
    spans = found.select(F.explode(column).alias("s"))
    rows = spans.groupBy("s.votes", "s.kind", "s.size").count().collect()  # bounded by what can occur
    return train({(tuple(r.votes), r.kind, r["size"]): r["count"] for r in rows})


def accepted(model: SpanClassifier, column: str = "found") -> Column:
    return F.filter(column, lambda s: s["base"] | (model.score(s) >= 0.5))


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (start, kind name, end, text, base, score)."""
    found = docs.select(docs[f"`{id_col}`"].alias("doc_id"), candidates(text_or_empty(f"`{text_col}`")).alias("found"))
    found = stored(found, "spans")
    model = fit_spans(found)
    names = F.array(*map(F.lit, NAMES))
    spans = F.transform(
        accepted(model),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.get(names, s["kind"]).alias("kind"),
            s["end"].alias("end"),
            s["text"].alias("text"),
            s["base"].alias("base"),
            model.score(s).alias("score"),
        ),
    )
    return found.select("doc_id", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; a span that overlaps an earlier one goes with it."""
    names = F.array(*[F.lit(f"[{n.upper()}]") for n in NAMES])
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.get(names, s["kind"]))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    end = lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))
    )
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, end)).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every accepted span replaced by its kind, all other columns as they were."""
    column = spare_name(docs, "_found")
    found = docs.withColumn(column, candidates(text_or_empty(f"`{text_col}`")))
    model = fit_spans(found.select(column), column)
    spans = accepted(model, column)
    columns = []
    for name in docs.columns:
        value = docs[f"`{name}`"]
        if name == text_col:
            value = F.when(value.isNotNull(), let(spans, lambda s: _masked(docs[f"`{text_col}`"].cast("string"), s)))
        columns.append(value.alias(name))
    out = found.select(*columns)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(f"`{text_col}`").cast(docs.schema[length_col].dataType))
    return out
