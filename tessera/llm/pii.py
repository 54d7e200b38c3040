"""Personal data [DataFrame functions only].

Regular expressions propose spans, checksums (Luhn, mod 97) or ranges confirm them and
words close before a span move its score. The base kinds (email, ip, card, phone) are
kept whenever they are confirmed; the further kinds (cardgroup, iban, ssn, secret) only
from a score of ``MIN_SCORE`` on and outside of base spans.

Positions count code points, ends are exclusive. They come from the lengths of the
pieces between the matches, summed by a window over the matches of one text, so the
work grows linearly with the number of matches.

Edge cases: a null text has no span; an empty table gives an empty result; equal rows
are handled one by one; a very long text is searched whole, by patterns that never go
back over what they have read; other columns are ignored, or kept by ``mask``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import let, pick

MIN_SCORE = 0.5
NEAR = 40               # code points before a span in which context words count


def _only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)),
                       lambda i: F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (blanks allowed) has the remainder 1 modulo 97."""
    turned = let(F.regexp_replace(iban, " ", ""),
                 lambda s: F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4)))
    codes = F.transform(F.split(turned, ""), lambda c: F.ascii(c))
    rest = F.aggregate(codes, F.lit(0), lambda r, c: F.when(
        c >= 65, (r * 100 + c - 55) % 97).when(c >= 48, (r * 10 + c - 48) % 97).otherwise(r))
    return rest == 1


def _octets(ip: Column) -> Column:
    parts = F.transform(F.split(ip, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))


# --- fixed values: characters of an IBAN by country (ISO 13616 register) -------------------
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}
# -------------------------------------------------------------------------------------------


def _iban_pattern() -> str:
    """By the length of the country, so that nothing behind the number is taken with it;
    other countries have 15 to 34 characters, and no group that begins a known one."""
    known = "(?:" + "|".join(" ".join(IBAN_LENGTHS.values()).split()) + ")[0-9]{2}"
    each = []
    for n, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(n - 4, 4)
        end = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        each.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{end}")
    other = (f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?: ?(?!{known})"
             f"[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?")
    return rf"\b(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*each, other])})\b"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    may: Callable[[Column], Column]     # a cheap test that every text with a match passes
    base: bool
    prior: float
    context: str                        # words that raise the score
    against: str = r"\b(?:version|release|chapter|section)\W*$"   # words that lower it


def _digits_between(low: int, high: int, check=None) -> Callable[[Column], Column]:
    def valid(s: Column) -> Column:
        ok = F.length(_only_digits(s)).between(low, high)
        return ok if check is None else F.when(ok, check(_only_digits(s))).otherwise(False)
    return valid


# The base patterns are given; here they are written so that no text makes them go back:
# each piece is possessive, and a match may only begin where a run of its first class does
# (or where the last match ended), which finds the same leftmost matches.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda s: F.lit(True), lambda t: F.contains(t, F.lit("@")), True, 0.9,
         r"(?i)\b(?:mail|email|e-mail|contact|write)\b"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets,
         lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), True, 0.6,
         r"(?i)\b(?:ip|host|server|address|login)\b"),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++", _digits_between(16, 19, luhn),
         lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?+[0-9]){15}")), True, 0.8,
         r"(?i)\b(?:card|visa|mastercard|credit|payment)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _digits_between(8, 15),
         lambda t: F.contains(t, F.lit("+")), True, 0.6, r"(?i)\b(?:phone|tel|call|fax|mobile)\b"),
    # two numbers side by side are one run of digits for the base kind, which drops it
    Kind("cardgroup", r"(?<![0-9])(?:[0-9]{4}[\x20-]?+){3}[0-9]{4}(?![0-9])",
         _digits_between(16, 16, luhn), lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?+[0-9]){15}")),
         False, 0.7, r"(?i)\b(?:card|visa|mastercard|credit|payment)\b"),
    Kind("iban", _iban_pattern(), lambda s: (F.length(F.regexp_replace(s, " ", "")) >= 15) & mod97(s),
         lambda t: F.rlike(t, F.lit(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4} ?[A-Z0-9]{4}")), False, 0.7,
         r"(?i)\b(?:iban|account|bank|transfer)\b"),
    Kind("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
         lambda s: ~F.rlike(s, F.lit("^(?:000|666|9..)-|-00-|-0000$")),
         lambda t: F.rlike(t, F.lit("[0-9]{3}-[0-9]{2}-[0-9]{4}")), False, 0.2,
         r"(?i)\b(?:ssn|social security)\b"),
    Kind("secret", r"\b[0-9a-f]{32,64}\b", lambda s: F.lit(True),
         lambda t: F.rlike(t, F.lit("[0-9a-f]{32}")), False, 0.2,
         r"(?i)\b(?:token|secret|password|api[ _-]?key)\b"),
)
NAMES = [k.name for k in KINDS]


def _score(kind: Kind, left: Column) -> Column:
    up = F.when(F.rlike(left, F.lit(kind.context)), 0.4).otherwise(0.0)
    down = F.when(F.rlike(left, F.lit(kind.against)), 0.4).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(kind.prior) + up - down))


def _proposed(kind: Kind, text: Column) -> Column:
    """All matches of a kind: place in the list, length of the piece before, the match,
    whether it is confirmed, its score."""
    pieces = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    found = let(pieces, lambda p: F.transform(hits, lambda h, i: let(
        F.get(p, i), lambda gap: F.struct(
            F.lit(NAMES.index(kind.name)).alias("kind"), i.alias("i"),
            F.char_length(gap).alias("gap"), F.char_length(h).alias("n"),
            kind.valid(h).alias("valid"),
            _score(kind, F.right(gap, F.lit(NEAR))).alias("score")))))
    none = F.filter(F.array(F.struct(
        F.lit(0).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit(0).alias("n"),
        F.lit(True).alias("valid"), F.lit(0.0).alias("score"))), lambda x: F.lit(False))
    return F.when(kind.may(text), found).otherwise(none)


def find_pii(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: ``doc_id`` and ``found``, an array of
    ``(kind, start, end, base, score)`` in the order of the kinds, then of the starts."""
    rows = pick(docs, "doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    text = F.coalesce(F.col("text"), F.lit(""))
    matches = rows.select("__row", "doc_id", F.explode_outer(F.concat(
        *[_proposed(k, text) for k in KINDS])).alias("m")).select("__row", "doc_id", "m.*")
    matches = matches.repartition("__row")
    upto = W.partitionBy("__row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    base = F.col("kind").isin([i for i, k in enumerate(KINDS) if k.base])
    span = F.struct("kind", (F.col("end") - F.col("n")).alias("start"), "end",
                    base.alias("base"), "score")
    keep = F.col("valid") & (base | (F.col("score") >= min_score))
    return (matches.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto))
            .groupBy("__row", "doc_id")
            .agg(F.array_sort(F.collect_list(F.when(keep, span))).alias("found"))
            .select("doc_id", F.when(F.exists("found", lambda s: ~s["base"]), let(
                F.filter("found", lambda s: s["base"]), lambda own: F.filter(
                    F.col("found"), lambda s: s["base"] | ~F.exists(own, lambda b: (
                        (b["start"] <= s["start"]) & (s["end"] <= b["end"]))))))
                .otherwise(F.col("found")).alias("found")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, hash of the base spans, all spans as text."""
    found = find_pii(docs)
    spans = F.col("found")

    def count(i: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("long")

    return found.select(
        "doc_id", *[count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base],
        F.sha2(_joined(F.filter(spans, lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"))


def _masked(kind: Kind, text: Column, min_score: float) -> Column:
    pieces = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def put(gap: Column, hit: Column) -> Column:
        ok = kind.valid(hit)
        if not kind.base:
            ok = ok & (_score(kind, F.right(gap, F.lit(NEAR))) >= min_score)
        return F.concat(gap, F.when(hit.isNull(), "").when(ok, f"<{kind.name.upper()}>")
                        .otherwise(hit))

    whole = let(hits, lambda found: F.array_join(
        F.transform(pieces, lambda gap, i: let(F.get(found, i), lambda hit: put(gap, hit))), ""))
    return F.when(kind.may(text), whole).otherwise(text)


def mask(text: Column, min_score: float = MIN_SCORE) -> Column:
    """The text with every kept span replaced by ``<KIND>``; the kinds one after another."""
    for kind in KINDS:
        def step(t: Column) -> Column:
            return _masked(kind, t, min_score)          # noqa: B023  (called at once)

        text = let(text, step)
    return text


def mask_documents(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with masked texts; ``n_chars``, where there is one, counts the new text.
    A null text stays null."""
    names = docs.columns
    low = [c.lower() for c in names]
    at = names.index("text") if "text" in names else low.index("text")
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    flat = flat.withColumn(f"c{at}", mask(F.col(f"c{at}"), min_score))
    if "n_chars" in names:
        n = names.index("n_chars")
        flat = flat.withColumn(f"c{n}", F.char_length(f"c{at}").cast(dict(docs.dtypes)["n_chars"]))
    return flat.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
