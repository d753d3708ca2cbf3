"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

Everything is a projection of the scan in built-in functions: no shuffle, no Python. A pattern's matches and the pieces
of text between them (``regexp_extract_all`` and ``split`` walk the text alike) give positions in code points by one
running sum over the matches.

Base kinds stand by their own checks alone. Further kinds need a score of ``threshold``: a prior, more if a checksum
holds, more if a context word is within 40 characters of the text before or after, other matches
included. A null text has no spans; empty texts, ties and repeated rows
need no care, since each row is judged by itself, and an empty table gives an empty one. Other columns are carried by
``with_spans`` and ``mask`` whatever their names. Time is in proportion to a text's length, however many spans it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance.llm.common import free_name, text_column

CONTEXT_CHARS = 40
#: Spans are gathered in runs of this length, so that a text with very many of them takes linear time.
RUN = 256
#: Characters of a block of text. Parts of a text are cut from its blocks, since to find a position a whole text is walked.
BLOCK = 512


def blocks_of(text: Column) -> Column:
    """A text as an array of blocks of code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), 0)


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` to before ``end``, which may lie outside the text; empty if there are none."""
    start = F.greatest(start, F.lit(0))
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor((end - 1) / BLOCK).cast("int")
    held = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.when(end > start, F.substr(held, start - first * BLOCK + 1, end - start)).otherwise(F.lit(""))


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def octets(found: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return found.rlike(rf"^{part}(?:\.{part}){{3}}$")


def luhn(found: Column) -> Column:
    return F.call_function("luhn_check", digits(found))


def long_card(found: Column) -> Column:
    return F.length(digits(found)).between(16, 19) & luhn(found)


def short_card(found: Column) -> Column:
    return F.length(digits(found)).between(13, 15) & luhn(found)


def phone_length(found: Column) -> Column:
    return F.length(digits(found)).between(8, 15)


def mod_97(found: Column) -> Column:
    """ISO 7064: first four characters moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(found, " ", "")
    letters = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")

    def add(rest: Column, letter: Column) -> Column:
        code = F.ascii(letter)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.length(plain).between(15, 34) & (F.aggregate(letters, F.lit(0), add) == 1)


#: Characters of an IBAN by country, without spaces.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """As many characters as the country has, so that following words stay out; for codes not listed as many as follow."""

    def groups(n: int) -> str:
        return f"(?: ?[A-Z0-9]{{4}}){{{n // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")

    known = [f"(?:{codes.replace(' ', '|')})[0-9]{{2}}{groups(n - 4)}" for n, codes in IBAN_LENGTHS.items()]
    listed = "|".join(codes.replace(" ", "|") for codes in IBAN_LENGTHS.values())
    other = f"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(known)}|{other})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """What ``confirm`` does not hold for is no span. Patterns are possessive where they could go back: linear time."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column] | None = None
    base: bool = False
    prior: float = 0.5
    context: str = ""


#: Base kinds in their order. A match starts where a run of its characters starts, or right after the last match.
BASE = [
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        base=True,
        context="mail|contact|write",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", octets, base=True, context="ip|host|server|address"),
    Kind("card", r"[0-9](?:[ -]?+[0-9])++", long_card, base=True, prior=0.7, context="card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", phone_length, base=True, context="phone|call|tel|mobile|fax"),
]

#: Kinds beyond the base: confirmed by a checksum, or with a low prior that needs a context word.
FURTHER = [
    Kind(
        "iban",
        iban_pattern(),
        mod_97,
        prior=0.7,
        context="iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "short_card",
        r"(?<![0-9+.-])[0-9](?:[ -]?+[0-9]){12,14}+(?![0-9]|[ -][0-9])",
        short_card,
        prior=0.3,
        context="card|visa|amex|credit|payment",
    ),
    Kind(
        "national_id",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        prior=0.3,
        context="ssn|social security|national id",
    ),
]
KINDS = BASE + FURTHER
CONTEXT_SCORE = 0.3


def walked(items: Column, item: str, step: Callable[[Column, Column], tuple[Column, Column, Column]]) -> Column:
    """Array of the items that a walk over ``items`` makes: ``step`` takes the place reached and an element and gives the new
    place, the item (of SQL type ``item``) and whether it is one."""
    empty = F.array().cast(f"array<{item}>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("run"), F.array().cast(f"array<array<{item}>>").alias("full"))

    def add(acc: Column, x: Column) -> Column:
        at, one, stands = step(acc["at"], x)
        run = F.when(stands, F.array_append(acc["run"], one)).otherwise(acc["run"])
        turn = F.size(acc["run"]) >= RUN
        return F.struct(
            at.alias("at"),
            F.when(turn & stands, F.array(one)).when(turn, empty).otherwise(run).alias("run"),
            F.when(turn, F.array_append(acc["full"], acc["run"])).otherwise(acc["full"]).alias("full"),
        )

    return F.aggregate(items, state, add, lambda acc: F.flatten(F.array_append(acc["full"], acc["run"])))


def spans_of(text: Column, blocks: Column, found: Column, kind: Kind, threshold: float) -> Column:
    """Array of (kind, start, end, score) of the matches that stand; ``found`` are the matches in order."""
    n = F.size(found)
    gaps = F.split(text, kind.pattern, -1)
    pieces = F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), n).alias("before"))
    span = "struct<kind:string,start:int,end:int,score:double>"

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        start = at + F.length(x["before"])
        end = start + F.length(x["found"])
        confirmed = F.lit(True) if kind.confirm is None else kind.confirm(x["found"])
        score = F.lit(kind.prior)
        if kind.context:
            near = F.concat_ws(" ", cut(blocks, start - CONTEXT_CHARS, start), cut(blocks, end, end + CONTEXT_CHARS))
            score = score + F.when(confirmed & F.lower(near).rlike(rf"\b(?:{kind.context})"), CONTEXT_SCORE).otherwise(0.0)
        stands = confirmed
        if not kind.base:
            stands = stands & (score >= threshold)
        one = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        return end, one, stands

    return F.when(n > 0, walked(pieces, span, step)).otherwise(F.array().cast(f"array<{span}>"))


def with_spans(docs: DataFrame, out: str, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, score), by kind as listed, then start; end is exclusive."""
    text = text_column()
    found = {k.name: free_name(docs, f"found_{k.name}") for k in KINDS}
    blocks = free_name(docs, "text_blocks")
    made = {found[k.name]: F.regexp_extract_all(text, F.lit(k.pattern), 0) for k in KINDS}
    rows = docs.withColumns({**made, blocks: blocks_of(text)})
    spans = [spans_of(text, F.col(blocks), F.col(found[k.name]), k, threshold) for k in KINDS]
    return rows.withColumn(out, F.concat(*spans)).drop(blocks, *found.values())


def is_kind(*names: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"].isin(*names)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, top_score) for every row."""
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "all_spans", threshold)
    spans = F.col("all_spans")
    base = F.filter(spans, is_kind(*(k.name for k in BASE)))
    counts = [F.size(F.filter(spans, is_kind(k.name))).cast("long").alias(f"n_{k.name}") for k in BASE]
    score = F.array_max(F.transform(spans, lambda x: x["score"])).alias("top_score")
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"), score)


def mask(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans become one.

    Null texts stay null, and a column n_chars is set to the new length of texts that change.
    """
    name = free_name(docs, "all_spans")
    rows = with_spans(docs, name, threshold)
    ordered = F.array_sort(F.transform(F.col(name), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        part = F.struct(at.alias("start"), x["start"].alias("end"), x["kind"].alias("kind"))
        return F.greatest(at, x["end"]), part, x["start"] >= at

    def put(blocks: Column) -> Column:
        kept = walked(ordered, "struct<start:int,end:int,kind:string>", step)
        pieces = F.transform(kept, lambda p: F.concat(cut(blocks, p["start"], p["end"]), F.lit("["), F.upper(p["kind"]), F.lit("]")))
        rest = F.array_max(F.transform(F.col(name), lambda x: x["end"]))
        return F.concat(F.array_join(pieces, ""), cut(blocks, rest, F.size(blocks) * BLOCK))

    # Through a one-element array, so that the blocks are made once and not for every piece.
    masked = F.transform(F.array(blocks_of(text_column())), put)[0]
    fresh = free_name(rows, "masked_text")
    rows = rows.withColumn(fresh, F.when(F.size(name) > 0, masked))
    new = {"text": F.coalesce(fresh, "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length(fresh).cast(docs.schema["n_chars"].dataType), "n_chars")
    return rows.withColumns(new).select(*docs.columns)
