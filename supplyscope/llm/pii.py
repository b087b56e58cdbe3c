"""Personal data spans in SQL expressions only (operator 2).

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod 97 for account numbers), and words before a span adjust its score.

The patterns of the first four kinds run possessively and may start only where
a run of their first class starts or where the previous match ended; that gives
the same leftmost matches as the plain pattern in time linear in the text.
An account number's pattern matches its head only and looks ahead for all that
may belong to it; the number is the part, up to a word's end, whose length is
its country's and that passes mod 97 (of a country not in the register the
longest of 15 to 34 characters that passes).  Offsets come from the lengths of
the matches and of the gaps between them (``split`` by the same pattern), in
code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.work import text_or_empty

# The patterns of each kind, in linear form.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: The first group is the longest run from the head on, with one more letter
#: or digit if the run ends within a word.
ACCOUNT = r"(?=([A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+[A-Za-z0-9]?+))[A-Z]{2}[0-9]{2}"
ACCOUNT_HEAD = 4
LEAST_ACCOUNT, MOST_ACCOUNT = 15, 34
#: Lengths of account numbers in the IBAN register, by country.
ACCOUNT_LENGTHS = {n: c.split() for n, c in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items()}

#: What a text must hold for a kind's pattern to match at all, tested first.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "\\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}"}

CONTEXT = {
    "email": "mail|contact|write|reach",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|transfer",
}
BASE_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.8, "phone": 0.5, "iban": 0.9}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.2


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn check."""
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(m: Column) -> Column:
    """Whether an account number leaves 1 modulo 97 (letters count 10-35)."""
    s = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def add(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, acc * 10 + c - 48).otherwise(acc * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def account_length(run: Column) -> Column:
    """Length of the account number at the start of a run of ``ACCOUNT``,
    spaces counted; null if there is none."""
    country = F.substring(run, 1, 2)
    known = F.lit(None).cast("int")
    for n, names in ACCOUNT_LENGTHS.items():
        known = F.when(country.isin(names), n).otherwise(known)

    def fits(i: Column) -> Column:
        part = F.substring(run, F.lit(1), i)
        n = F.length(F.regexp_replace(part, " ", ""))
        ends = (F.substring(run, i, F.lit(1)) != " ") & F.substring(run, i + 1, F.lit(1)).isin("", " ")
        sized = F.when(known.isNotNull(), n == known).otherwise(n.between(LEAST_ACCOUNT, MOST_ACCOUNT))
        return F.when(ends & sized, mod97(part)).otherwise(False)

    fit = F.filter(F.sequence(F.lit(LEAST_ACCOUNT), F.length(run)), fits)
    return F.array_max(fit)


def small_parts(m: Column) -> Column:
    """Whether each dotted part is at most 255, leading zeros aside."""
    return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")).between(1, 3)
                    & (F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int"), F.lit(999)) <= 255))


def checked(kind: str, m: Column) -> Column:
    if kind == "ip":
        return small_parts(m)
    if kind == "card":
        return F.when(F.length(digits_of(m)).between(13, 19), luhn(digits_of(m))).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(m)).between(9, 15)
    return F.lit(True)


SPAN = "struct<kind:string,start:int,end:int,score:double>"
STATE = f"struct<at:int,out:array<{SPAN}>>"


def spans(text: Column, kind: str, pattern: str) -> Column:
    """Confirmed spans of a kind as an array of structs, by start."""
    def place(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)),
                           lambda m, g: F.struct(m.alias("m"), g.alias("g")))

        def step(state: Column, pair: Column) -> Column:
            m, gap = pair["m"], pair["g"]
            start = state["at"] + F.length(gap)
            if kind == "iban":
                # a head within a number is none; nor is such a number context
                at, size = start + ACCOUNT_HEAD, account_length(m)
                free = start - F.coalesce(F.try_element_at(state["out"], F.lit(-1))["end"], F.lit(0))
                end, right = start + size, (free >= 0) & size.isNotNull()
                before = F.right(gap, F.least(F.lit(CONTEXT_CHARS), free))
            else:
                end = start + F.length(m)
                at, right, before = end, checked(kind, m), F.right(gap, F.lit(CONTEXT_CHARS))
            near = F.lower(before).rlike(CONTEXT[kind])
            score = F.lit(BASE_SCORE[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
            span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                            F.least(F.lit(1.0), F.round(score, 2)).alias("score")).cast(SPAN)
            more = F.when(right, F.concat(state["out"], F.array(span))).otherwise(state["out"])
            return F.struct(at.alias("at"), more.alias("out")).cast(STATE)

        none = F.array().cast(f"array<{SPAN}>")
        done = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")).cast(STATE), step)
        return F.when(F.size(found) > 0, done["out"]).otherwise(none)

    # one-element array: the matches are computed once and named
    may = text.contains("@") if kind == "email" else F.col("__digit") & text.rlike(NEEDS[kind])
    found = F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if kind == "iban" else 0))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(found), place)[0]


def joined(arr: Column, score: bool = False) -> Column:
    def one(s: Column) -> Column:
        cols = [s["kind"], s["start"].cast("string"), s["end"].cast("string")]
        return F.concat_ws(":", *cols, *([s["score"].cast("string")] if score else []))
    return F.array_join(F.transform(arr, one), ",")


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, n_iban,
    base_sha256 (of the first four kinds), spans (all kinds) and scored (all,
    with scores), each by kind, then start; offsets in code points.

    Null and empty texts have no spans; repeated rows and null ids pass
    through; other columns are not read.  Rows are independent: one pass over
    the texts, no shuffle.
    """
    text = text_or_empty(docs[text_col])
    kinds = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": ACCOUNT}
    found = docs.select(docs[id_col].alias(id_col), text.alias("__text"))
    found = found.withColumn("__digit", F.col("__text").rlike("[0-9]"))
    found = found.select(id_col, *(spans(F.col("__text"), k, p).alias(f"__{k}") for k, p in kinds.items()))
    base = F.concat(*(F.col(f"__{k}") for k in list(kinds)[:4]))
    every = F.concat(*(F.col(f"__{k}") for k in kinds))
    return found.select(id_col, *(F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in kinds),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"),
                        joined(every, True).alias("scored"))
