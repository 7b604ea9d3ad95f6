"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is a Column expression over one row: no shuffle, no Python on the
executors. A detector names a kind, a pattern, a validator of the matched
text, a prior score and context words. A proposal of a base kind stands once
its validator holds. Any other kind also needs a score of `THRESHOLD`:

    score = prior + CHECKSUM_WEIGHT (checksum kinds) + CONTEXT_WEIGHT (a
            context word within CONTEXT_CHARS code points of the span)

An IBAN is not delimited by its pattern: capitals and digits may follow it. Every
word that can start one is tried with every word end up to 34 characters on;
the checksum decides, the country's length settles a tie, and no other is
sought before the end of a confirmed one.

Defined cases: a null or empty text has no spans; spans of different kinds
may overlap and are all reported; repeated rows give repeated results; an
empty table gives an empty result; other columns of the input pass through
`find_pii` unless they carry the name of the new column, which is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bind

THRESHOLD = 0.6
CHECKSUM_WEIGHT = 0.4
CONTEXT_WEIGHT = 0.4
CONTEXT_CHARS = 40
IBAN_LENGTHS = dict(re.findall("([A-Z]{2})([0-9]{2})", """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22
    GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22
    MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29
    VA22 VG24 XK20"""))
_BLOCK = 256  # spans per block of the two-level running sum


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check over a string of digits: from the right, every second digit doubles."""
    d = F.split(F.reverse(digits), "")
    weighed = F.transform(d, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """ISO 7064 mod 97-10 as IBANs use it: the first four characters move to the
    end, letters count as 10 to 35, and the number leaves remainder 1."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _card(m: Column) -> Column:
    return bind(_digits(m), lambda d: F.length(d).between(14, 19) & luhn(d))


def _ip(m: Column) -> Column:
    return F.forall(F.split(m, "[.]"), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))


def _phone(m: Column) -> Column:
    return F.length(_digits(m)).between(10, 15)


def _always(m: Column) -> Column:
    return F.lit(True)


def _iban(m: Column) -> Column:
    return bind(F.regexp_replace(m, " ", ""), lambda c: F.length(c).between(15, 34) & mod97(c))


def _ibans(text: Column, pattern: str) -> Column:
    """array<struct<start, m>> of the confirmed IBANs. `pattern` matches a start; its group holds
    what may follow, up to 34 characters without spaces, and one character more."""
    lengths = F.create_map(*[F.lit(v) for k, n in IBAN_LENGTHS.items() for v in (k, int(n))])

    def longest(s: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(15), F.greatest(F.length(s), F.lit(15))), lambda n: (
            F.substr(s, n, F.lit(1)).rlike("[A-Z0-9]") & ~F.substr(s, n + 1, F.lit(1)).rlike("[A-Za-z0-9]")))
        valid = F.filter(F.transform(ends, lambda n: F.substr(s, F.lit(1), n)), _iban)
        ranked = F.transform(valid, lambda m: F.struct(F.coalesce(
            F.length(F.regexp_replace(m, " ", "")) == lengths[F.substr(m, F.lit(1), F.lit(2))], F.lit(False)).alias("known"),
            F.length(m).alias("n"), m.alias("m")))
        return F.array_max(ranked)["m"]

    tails = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    tried = F.zip_with(_matches(text, pattern), tails, lambda x, t: F.struct(x["start"].alias("start"), longest(F.concat(x["m"], t)).alias("m")))

    def apart(found: Column) -> Column:
        end = lambda x: x["start"] + F.length(x["m"])
        overlaps = F.transform(found, lambda x, i: F.coalesce(x["start"] < end(F.get(found, i - 1)), F.lit(False)))
        none = F.struct(F.lit(0).alias("at"), F.slice(found, 1, 0).alias("kept"))
        step = lambda a, x: F.when(x["start"] < a["at"], a).otherwise(
            F.struct(end(x).alias("at"), F.concat(a["kept"], F.array(x)).alias("kept")))
        return F.when(F.exists(overlaps, lambda o: o), F.aggregate(found, none, step, lambda a: a["kept"])).otherwise(found)

    return bind(F.filter(tried, lambda x: x["m"].isNotNull()), apart)


def _ssn(m: Column) -> Column:
    return ~m.rlike("^(?:000|666|9)") & ~m.rlike("^...-00") & ~m.rlike("0000$")


@dataclass(frozen=True)
class Detector:
    kind: str
    pattern: str
    valid: Callable[[Column], Column]
    base: bool = False
    checksum: bool = False
    prior: float = 0.6
    context: tuple[str, ...] = field(default=())
    alone: str = ""  # a character class that must not stand before or after the span
    within: Callable[[Column, str], Column] | None = None  # finds the valid spans from the text where the pattern gives starts only


# The base kinds are fixed by the contract, in the order in which it lists
# them. Quantifiers are possessive wherever what follows cannot take back a
# character, and a local part or number is entered at its first character only
# (or where the last match ended, \G), so a long run is read once.
DETECTORS = (
    Detector("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
             _always, base=True, prior=0.9, context=("mail", "contact")),
    Detector("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, base=True, prior=0.6,
             context=("ip", "host", "server", "address")),
    Detector("card", r"[0-9](?:[\x20-]?[0-9])++", _card, base=True, checksum=True, prior=0.4,
             context=("card", "visa", "credit", "payment")),
    Detector("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, base=True, prior=0.7,
             context=("phone", "call", "tel", "mobile")),
    Detector("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}.?))", _iban,
             checksum=True, prior=0.4, context=("iban", "account", "bank"), alone="[A-Za-z0-9]", within=_ibans),
    Detector("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn, prior=0.3,
             context=("ssn", "social security"), alone="[0-9-]"),
    Detector("secret", r"[0-9a-f]{32,}+", _always, prior=0.3,
             context=("token", "secret", "password", "api_key", "apikey", "api key"), alone="[A-Za-z0-9]"),
)
KINDS = tuple(d.kind for d in DETECTORS)
_SPAN = "struct<start:int,ord:int,end:int,kind:string,score:double>"


def _running(lengths: Column) -> Column:
    """Sums of all earlier entries, per entry: sums of blocks, then within a block."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    at = lambda i: F.floor(i / _BLOCK).cast("int")

    def within(sums: Column) -> Column:
        ahead = F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))
        return bind(ahead, lambda o: F.transform(lengths, lambda _, i: F.get(o, at(i)) + total(
            F.slice(lengths, at(i) * _BLOCK + 1, i % _BLOCK))))

    blocks = F.sequence(F.lit(0), at(F.size(lengths)))
    return bind(F.transform(blocks, lambda b: total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))), within)


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, m>> of the leftmost non-overlapping matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def place(pairs: Column) -> Column:
        steps = F.transform(pairs, lambda x: x["g"] + F.length(x["m"]))
        return bind(bind(steps, _running), lambda r: F.transform(pairs, lambda x, i: F.struct(
            (F.get(r, i) + x["g"]).alias("start"), x["m"].alias("m"))))

    pairs = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    return bind(F.filter(pairs, lambda x: x["m"].isNotNull()), place)


def _detect(text: Column, d: Detector, order: int) -> Column:
    near = "|".join(d.context)

    def span(x: Column) -> Column:
        start, end = x["start"], x["start"] + F.length(x["m"])
        before = F.substr(text, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS)))
        after = F.substr(text, end + 1, F.lit(CONTEXT_CHARS))
        hit = F.lower(F.concat(before, F.lit("\n"), after)).rlike(f"(?<![a-z])(?:{near})")
        score = F.lit(d.prior + (CHECKSUM_WEIGHT if d.checksum else 0)) + F.when(hit, CONTEXT_WEIGHT).otherwise(0.0)
        return F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(d.kind).alias("kind"),
                        F.least(F.round(score, 4), F.lit(1.0)).alias("score"))

    found = d.within(text, d.pattern) if d.within else F.filter(_matches(text, d.pattern), lambda x: d.valid(x["m"]))
    kept = F.transform(found, span)
    if d.alone:
        free = lambda c: ~F.coalesce(c, F.lit("")).rlike(d.alone)
        kept = F.filter(kept, lambda s: (free(F.when(s["start"] > 0, F.substr(text, s["start"], F.lit(1)))))
                        & free(F.substr(text, s["end"] + 1, F.lit(1))))
    if not d.base:
        kept = F.filter(kept, lambda s: s["score"] >= THRESHOLD)
    return F.when(text.rlike(d.pattern), kept.cast(f"array<{_SPAN}>")).otherwise(F.array().cast(f"array<{_SPAN}>"))


def pii_spans(text: Column) -> Column:
    """All spans of a text by start, then kind in the order of KINDS."""
    return F.array_sort(F.concat(*[_detect(text, d, i) for i, d in enumerate(DETECTORS)]))


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Adds `out`: array<struct<start, ord, end, kind, score>>; offsets count code points, end exclusive."""
    return docs.withColumn(out, pii_spans(F.coalesce(F.col(text), F.lit(""))))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; where spans
    overlap, the first that starts names the joint stretch."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        fresh = F.concat(a["parts"], F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]),
                                             F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= a["at"], fresh).otherwise(a["parts"]).alias("parts"))

    done = F.aggregate(spans, start, step, lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1)))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a `documents` table."""
    base = F.filter("pii", lambda s: s["ord"] < sum(d.base for d in DETECTORS))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return find_pii(docs.select("doc_id", "text")).select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("pii")).alias("spans"))
