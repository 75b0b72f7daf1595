"""Personal data in texts: patterns propose, checksums confirm, words nearby adjust the score.

E-mail and IP addresses, card numbers (Luhn), phone numbers, and, as an added kind, IBANs (mod-97). A score starts from the kind
and rises if a context word stands within 40 characters. Scores never remove a span.

Long runs must not make a pattern run in squares or deep recursion, so dots within host names and separators within card
numbers are first exchanged for one mark, where they stand between two characters of the kind; runs then match as one class.

Null texts have no spans. Repeated rows are reported each. Places are in code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm.spans import JOINT, clean, count_kind, joined, with_found

_LOCAL = f"[A-Za-z0-9._%+{JOINT}-]"
#: A run is matched from its start, or from where the last match ended within it.
EMAIL = f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++{JOINT}[A-Za-z0-9{JOINT}-]++"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = f"(?<![0-9{JOINT}])[0-9][0-9{JOINT}]{{15,}}+"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
#: Number of characters of an IBAN by country.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
IBAN = "(?<![A-Z0-9])(?:" + "|".join(f"{country}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for country, n in IBAN_LENGTHS.items()) + ")(?![A-Z0-9])"
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")
#: Score of a kind by itself, and words that raise it.
SCORES = {
    "email": (0.6, "(?i)mail|contact|write|kontakt|correo|courriel"),
    "ip": (0.4, "(?i)\\bip\\b|address|server|host|adresse"),
    "card": (0.6, "(?i)card|visa|master|credit|karte|carte|tarjeta"),
    "phone": (0.5, "(?i)phone|tel|call|mobile|fax|anruf"),
    "iban": (0.8, "(?i)iban|bank|account|konto|compte|cuenta"),
}
CONTEXT_GAIN = 0.2


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit of a string of digits checks the others."""

    def doubled(c: Column, i: Column) -> Column:
        n = c.cast("int") * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(F.split(digits, "(?!$)"), doubled), F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN's check digits are right."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(turned, "(?!$)"), F.lit(0), step) == 1


def _with_kind(kind: str, spans: Column) -> Column:
    own, words = SCORES[kind]

    def scored(s: Column) -> Column:
        near = F.coalesce(s["before"], F.lit("")).rlike(words) | F.coalesce(s["after"], F.lit("")).rlike(words)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.when(near, own + CONTEXT_GAIN).otherwise(own).alias("score"))

    return F.transform(spans, scored)


def _number(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(16, 19) & luhn(digits)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of each row: array of ``kind, start, end, score`` by kind, then start."""
    df = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), clean(docs["text"].cast("string")).alias("text"))
    text = F.col("text")
    hosts = F.regexp_replace(text, "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])", JOINT)
    runs = F.regexp_replace(text, "(?<=[0-9])[\\x20-](?=[0-9])", JOINT)
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    df = with_found(df, "email", hosts, EMAIL, needs=F.contains(text, F.lit("@")))
    df = with_found(df, "ip", text, IP, needs=text.rlike("[0-9]\\.[0-9]"), valid=lambda m: m.rlike(f"^{part}(?:\\.{part}){{3}}$"))
    df = with_found(df, "card", runs, CARD, needs=text.rlike("[0-9][\\x20-]?[0-9]"), valid=_number)
    df = with_found(df, "phone", text, PHONE, needs=F.contains(text, F.lit("+")), valid=lambda m: F.length(_digits(m)).between(8, 15))
    df = with_found(df, "iban", text, IBAN, needs=text.rlike("[A-Z]{2}[0-9]{2}"), valid=mod97)
    return df.select("doc_id", F.concat(*(_with_kind(kind, F.col(kind)) for kind in KINDS)).alias("spans"))


def personal_digest(found_spans: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, all spans as text, the number of added ones and the highest score."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [count_kind(k).alias(f"n_{k}") for k in KINDS]
    top = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    return found_spans.select("doc_id", *counts[:4], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), counts[4], top.alias("max_score"))
