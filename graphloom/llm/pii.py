"""Personal data by regular expressions, checksums and context, in DataFrame functions only.

Expressions propose spans. Luhn's check confirms cards, mod-97 confirms account numbers (IBAN),
ranges of numbers confirm the rest. Words nearby raise a span's score. Spans of the base kinds are
always kept; those of further kinds need ``least`` as score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in order; expressions with possessive loops, which match what the plain ones
# match (a loop's characters never begin what follows it) without retries or recursion. A match may
# begin inside a run only where the last match ended.
LOCAL, HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
BASE = ("email", "ip", "card", "phone")
#: What a text must hold for a match at all.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}"}
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"), "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax"), "iban": ("iban", "account", "bank"),
}
#: Running values are made in stretches of STEP, texts are read in stretches of CHUNK characters.
STEP, CHUNK = 64, 256


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    # Every second digit from the right counts twice, less nine above nine.
    at = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return _sum(at) % 10 == 0


def _mod97(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(F.lit(1), F.lit(4)))

    def add(acc, c):
        number = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (acc * F.when(number > 9, 100).otherwise(10) + number) % 97

    fits = F.length(plain).between(15, 34)
    return fits & (F.aggregate(F.split(turned, ""), F.lit(0), add) == 1)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: _let(F.regexp_replace(p, "^0+", ""), lambda n: (F.length(n) < 3) | ((F.length(n) == 3) & (n <= "255"))))
    if kind == "card":
        return _let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "iban":
        return _mod97(value)
    return F.lit(True)


def _running(values: Column, add, levels: int = 2) -> Column:
    """Before each of some numbers, what ``add`` makes of those ahead of it, from 0 on.

    An array that grows is copied each time. So stretches of STEP numbers are folded apart, from
    what the stretches before them make, which is found the same way.
    """

    def fold(stretch, at):
        start = F.struct(at.alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(stretch, start, lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    if not levels:
        return fold(values, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STEP).cast("int")), lambda c: F.slice(values, c * STEP + 1, STEP))

    def whole(stretches):
        made = F.transform(stretches, lambda s: F.aggregate(s, F.lit(0), add))
        return _let(made, lambda m: F.flatten(F.zip_with(stretches, _running(m, add, levels - 1), fold)))

    return F.when(F.size(values) > 0, _let(cut, whole)).otherwise(F.expr("cast(array() as array<int>)"))


def _found(text: Column, kind: str) -> Column:
    """Spans of a kind: start, order, end, kind, score."""
    pattern, order = F.lit(PATTERNS[kind]), list(PATTERNS).index(kind)

    def spans(hits):
        def placed(gaps):
            # A gap's text is what stands before its hit, back to the hit before.
            steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
            parts = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("value"), F.length(g).alias("gap"), F.lower(g.substr(F.lit(-32), F.lit(32))).alias("near")))
            return F.zip_with(_let(steps, lambda s: _running(s, lambda a, x: a + x)), parts, lambda a, p: F.struct((a + p["gap"]).alias("start"), p["value"].alias("value"), p["near"].alias("near")))

        good = F.filter(_let(F.split(text, PATTERNS[kind], -1), placed), lambda p: _valid(kind, p["value"]))

        def scored(p):
            said = F.exists(F.array(*[F.lit(w) for w in CONTEXT[kind]]), lambda w: F.contains(p["near"], w))
            score = F.lit(SCORES[kind]) + F.when(said, 0.2).otherwise(0.0)
            return F.struct(p["start"].alias("start"), F.lit(order).alias("order"), (p["start"] + F.length(p["value"])).alias("end"), F.lit(kind).alias("kind"), score.alias("score"))

        return F.transform(good, scored)

    none = F.expr("cast(array() as array<struct<start: int, order: int, end: int, kind: string, score: double>>)")
    hits = _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda h: F.when(F.size(h) > 0, spans(h)).otherwise(none))
    return F.when(text.rlike(HINTS[kind]), hits).otherwise(none)


def find_pii(docs: DataFrame, least: float = 0.6, text_col: str = "text") -> DataFrame:
    """docs with pii_text (null: empty) and pii_spans, sorted by start and kind.

    A span has start and end (code points, end exclusive), kind and score. Of spans that begin at
    one place the kinds' order decides. Texts without spans have an empty array. Rows are independent
    of each other, so repeated ones get equal results; no row moves, and none goes or comes. Time
    grows with the text and its number of spans. Columns of docs with the two names are replaced.
    """
    own = [c for c in docs.columns if c not in ("pii_text", "pii_spans")]
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = made.select("row", "text", *[_found(F.col("text"), kind).alias(kind) for kind in PATTERNS])
    extra = [F.filter(k, lambda s: s["score"] >= least) for k in PATTERNS if k not in BASE]
    spans = F.array_sort(F.concat(*[F.col(k) for k in BASE], *extra))
    return made.select("row.*", F.col("text").alias("pii_text"), spans.alias("pii_spans"))


def told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or each stretch of overlapping spans, as [KIND] of the first; spans are sorted by start."""

    def between(chunks, a, b):
        """The characters from a to b, of chunks."""
        first, last = F.floor(a / CHUNK).cast("int"), F.floor(b / CHUNK).cast("int")
        chunk = lambda k: F.coalesce(F.get(chunks, k), F.lit(""))
        inner = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        apart = F.concat(chunk(first).substr(a % CHUNK + 1, F.lit(CHUNK)), inner, chunk(last).substr(F.lit(1), b % CHUNK))
        return F.when(first == last, chunk(first).substr(a % CHUNK + 1, b - a)).otherwise(apart)

    def joined(before):
        # A span that begins before an earlier one has ended belongs to that one's stretch.
        every = F.zip_with(spans, before, lambda s, e: F.struct(s["start"].alias("start"), e.alias("before"), s["kind"].alias("kind")))
        heads = F.filter(every, lambda s: s["start"] >= s["before"])

        def written(chunks):
            ahead = F.transform(heads, lambda h: F.concat(between(chunks, h["before"], h["start"]), F.lit("["), F.upper(h["kind"]), F.lit("]")))
            end = F.array_max(F.transform(spans, lambda s: s["end"]))
            return F.concat(F.array_join(ahead, ""), between(chunks, end, F.length(text)))

        return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), written)

    ends = F.transform(spans, lambda s: s["end"])
    return F.when(F.size(spans) > 0, _let(ends, lambda e: _let(_running(e, lambda a, x: F.greatest(a, x)), joined))).otherwise(text)
