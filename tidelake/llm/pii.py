"""Personal data: patterns propose spans, checksums confirm, context adjusts the score.

Emails, IP addresses, cards (Luhn) and phone numbers are the base kinds; the
method adds IBANs (mod-97) and dashed nine-digit identity numbers that a nearby
word makes likely.  All of it runs as DataFrame functions.  Patterns are written
so that the regular-expression engine neither recurses nor backtracks over long
runs: a card's inner separators become one marker each, which makes it a plain
character run, and runs are possessive.

Defined results: null text is empty and has no spans; every kind's matches are
leftmost and don't overlap within the kind, and kinds may overlap each other;
texts of any length take time in proportion to their length and matches;
repeated rows each get their spans; an empty table gives no rows; columns besides
the id and the text aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import table
from tidelake.llm.spans import count_of, listed, replaced, spans

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Stands for one separator between two digits while cards are looked for.
MARK, SPARE = "\ue000", "\ue001"
CARD = f"[0-9][0-9{MARK}]{{11,}}+"
#: The length of each country's IBANs, by ISO 13616.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28,
    "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
_OF_LENGTH = {n: "|".join(c for c, k in IBAN_LENGTHS.items() if k == n) for n in sorted(set(IBAN_LENGTHS.values()))}
#: Either case, single spaces anywhere; a country's length bounds the match, so words after it aren't taken in.
IBAN = "(?i)(?<![A-Z0-9])(?:" + "|".join(f"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in _OF_LENGTH.items()) + ")(?![A-Z0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE = ("email", "ip", "card", "phone")
#: kind: (score of a confirmed match, score that a context word adds, context words)
CONTEXT = {
    "email": (0.9, 0.1, "mail|contact|write|address"),
    "ip": (0.6, 0.3, "ip|host|server|address|login"),
    "card": (0.7, 0.3, "card|visa|credit|pay|mastercard|amex|account"),
    "phone": (0.6, 0.3, "phone|call|tel|mobile|fax|contact"),
    "iban": (0.8, 0.2, "iban|bank|account|transfer"),
    "identity": (0.2, 0.5, "ssn|social security|identity|tax id|insurance"),
}
#: An added kind needs this score; base kinds stay whatever theirs is.
LEAST = 0.5


def ip_valid(value: Column) -> Column:
    """All four parts at most 255, leading zeros or not."""
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.left(F.ltrim(p, F.lit("0")), F.lit(3)).try_cast("int"), F.lit(0)) <= 255))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_valid(value: Column) -> Column:
    """12 to 19 digits that pass Luhn's check."""
    return F.length(digits_of(value)).between(12, 19) & F.call_function("luhn_check", F.left(digits_of(value), F.lit(19)))


def mod97_valid(value: Column) -> Column:
    """15 to 34 letters (either case) and digits whose rearranged number leaves 1 modulo 97."""
    plain = F.upper(F.translate(value, " ", ""))
    turned = F.concat(F.substring(plain, 5, 34), F.left(plain, F.lit(4)))
    step = lambda acc, c: F.when(c >= "A", acc * 100 + F.ascii(c) - 55).otherwise(acc * 10 + F.ascii(c) - 48) % 97
    return F.length(plain).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def scored(span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    out = F.lit(0.0)
    for kind, (score, more, words) in CONTEXT.items():
        out = F.when(span["kind"] == kind, F.lit(score) + F.when(near.rlike(rf"\b(?:{words})"), F.lit(more)).otherwise(F.lit(0.0))).otherwise(out)
    return F.round(out, 2)


def with_spans(docs: DataFrame, text_col: str = "text", into: str = "_pii") -> DataFrame:
    """``docs`` with two arrays: ``{into}_base`` and ``{into}_more``, the base kinds' spans and those that the method adds."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.regexp_replace(F.translate(text, MARK, SPARE), "(?<=[0-9])[ -](?=[0-9])", MARK)
    found = docs.withColumns({
        f"{into}_email": F.filter(spans(text, EMAIL, "email", 0, text.contains("@")), lambda s: s["value"].isNotNull()),
        f"{into}_ip": F.filter(spans(text, IP, "ip", 1, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")), lambda s: ip_valid(s["value"])),
        f"{into}_card": F.filter(spans(marked, CARD, "card", 2, text.rlike("[0-9](?:[ -]?[0-9]){11}")), lambda s: luhn_valid(s["value"])),
        f"{into}_phone": F.filter(spans(text, PHONE, "phone", 3, text.contains("+")), lambda s: F.length(digits_of(s["value"])).between(9, 15)),
        f"{into}_iban": F.filter(spans(text, IBAN, "iban", 4, text.rlike("[A-Za-z]{2}[0-9]{2}")), lambda s: mod97_valid(s["value"]) & (scored(s) >= LEAST)),
        f"{into}_identity": F.filter(spans(text, IDENTITY, "identity", 5, text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}")), lambda s: scored(s) >= LEAST),
    })
    base = F.array_sort(F.concat(*(F.col(f"{into}_{k}") for k in BASE)))
    more = F.concat(F.col(f"{into}_iban"), F.col(f"{into}_identity"))
    return found.withColumns({f"{into}_base": base, f"{into}_more": more}).drop(*(f"{into}_{k}" for k in CONTEXT))


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans give one replacement."""
    return replaced(text, found, lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs).withColumn("_all", F.array_sort(F.concat("_pii_base", "_pii_more")))
    base, every = F.col("_pii_base"), F.col("_all")
    return found.select(
        "doc_id", *(count_of(base, k).alias(f"n_{k}") for k in BASE), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(every).alias("spans"), F.array_join(F.transform(every, lambda s: scored(s).cast("string")), ",").alias("scores"),
    )


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced in their texts; ``n_chars`` follows, and null texts stay null."""
    found = with_spans(docs).withColumn("_all", F.array_sort(F.concat("_pii_base", "_pii_more")))
    text = F.when(F.col("text").isNotNull(), redacted(F.coalesce("text", F.lit("")), F.col("_all")))
    changed = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))
    return changed.select(docs.columns)

