"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their scores."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kind, pick, ship, strings

#: Code points before and after a span in which context words count.
BEFORE, AFTER = 40, 20
#: Least score of a span that the method adds.
LEAST = 0.6

# The base patterns. Possessive forms and the look-behind match what the plain ones do, in linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# The patterns of the kinds that the method adds.
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
NATIONAL = re.compile(r"\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}")

_digit = re.compile("[0-9]")
_not_digit = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (twice + sum(map(int, digits[::-2]))) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without blanks leaves 1 modulo 97, its first four characters moved to the end."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def small_parts(address: str) -> bool:
    """Whether every part of a dotted address is at most 255."""
    return all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in address.split(".")))


def issued(number: str) -> bool:
    """Whether a social security number lies in the ranges that are given out."""
    return number[:3] not in ("000", "666") and number[0] != "9" and number[4:6] != "00" and number[7:] != "0000"


def _card(span: str) -> bool:
    digits = _not_digit.sub("", span)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _account(span: str) -> bool:
    bare = span.replace(" ", "")
    return 15 <= len(bare) <= 34 and mod97(bare)


def _phone(span: str) -> bool:
    return 9 <= len(_not_digit.sub("", span)) <= 15


def _local_phone(span: str) -> bool:
    return 9 <= len(_not_digit.sub("", span)) <= 11


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses. Each is found from its @ sign, so a long run of letters is read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        end, domain = at + 1, DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                end = free = domain.end()
                yield start, end
        at = text.find("@", end)


def _found(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: proposed by `spans`, confirmed by `valid`, scored by `prior` and nearby words.

    Base kinds keep every confirmed span. Spans of other kinds must not touch a letter or digit of ASCII,
    must not overlap a base span, and need a score of LEAST.
    """

    name: str
    spans: Callable[[str], Iterator[tuple[int, int]]]
    valid: Callable[[str], bool]
    prior: float
    boost: float
    words: str
    base: bool = True


# Scores and context words.
KINDS = (
    Kind("email", emails, lambda s: True, 0.9, 0.1, "mail|email|contact|write"),
    Kind("ip", _found(IP), small_parts, 0.6, 0.2, "ip|address|host|server"),
    Kind("card", _found(CARD), _card, 0.7, 0.2, "card|credit|visa|payment"),
    Kind("phone", _found(PHONE), _phone, 0.7, 0.2, "phone|tel|call|fax|mobile"),
    Kind("iban", _found(IBAN), _account, 0.8, 0.1, "iban|account|bank", base=False),
    Kind("ssn", _found(SSN), issued, 0.4, 0.4, "ssn|social security", base=False),
    Kind("local_phone", _found(NATIONAL), _local_phone, 0.3, 0.4, "phone|tel|call|fax|mobile", base=False),
)


def _alone(text: str, start: int, end: int) -> bool:
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    return not any(c.isascii() and c.isalnum() for c in around)


def find_spans(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) of all spans by kind in the order of KINDS, then start."""
    found, taken = [], []
    some_digit = _digit.search(text) is not None
    for k, near in zip(KINDS, _near, strict=True):
        if not some_digit and k.name != "email":
            break
        for start, end in k.spans(text):
            if not k.valid(text[start:end]):
                continue
            if not k.base and not (_alone(text, start, end) and all(end <= a or b <= start for a, b in taken)):
                continue
            close = text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]
            score = round(k.prior + (k.boost if near.search(close.lower()) else 0.0), 6)
            if k.base:
                taken.append((start, end))
            if k.base or score >= LEAST:
                found.append((k.name, start, end, score, k.base))
    return found


_near = [re.compile(f"(?:^|[^a-z])(?:{k.words})(?:[^a-z]|$)") for k in KINDS]
SPAN = "struct<kind:string,start:bigint,end:bigint,score:double,base:boolean,text:string>"


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): one row per input row; spans hold kind, start, end (exclusive), score, base and text.

    Positions are code points of the whole text. A null or empty text has no spans. Matches of one kind
    never overlap; those of different kinds may. Null and repeated ids give rows of their own, an empty
    table none; other columns of df, whatever their names, are left out. Every row is judged by itself,
    without a shuffle, so that repeated rows and hot ids do not matter.
    """
    ship(df.sparkSession)
    rows = pick(df, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, texts, scores, base = [], [], [], []
            starts, ends, offsets = array("q"), array("q"), array("i", [0])
            for text in strings(batch.column("text")):
                for name, start, end, score, is_base in find_spans(text) if text else ():
                    kinds.append(name)
                    starts.append(start)
                    ends.append(end)
                    scores.append(score)
                    base.append(is_base)
                    texts.append(text[start:end])
                offsets.append(len(kinds))
            numbers = [pa.array(np.frombuffer(x, "q") if x else [], pa.int64()) for x in (starts, ends)]
            flat = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), *numbers, pa.array(scores, pa.float64()), pa.array(base, pa.bool_()), pa.array(texts, pa.string())],
                ["kind", "start", "end", "score", "base", "text"],
            )
            spans = pa.ListArray.from_arrays(pa.array(np.frombuffer(offsets, "i"), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), spans], ["id", "spans"])

    made = rows.mapInArrow(run, f"id {kind(rows, 'id')}, spans array<{SPAN}>")
    return made.withColumnRenamed("id", id_col)


def span_digest(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and the list of all, from find_personal_data."""

    def listed(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("bigint").alias(f"n_{name}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [number(k.name) for k in KINDS if k.base]
    return df.select(id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"))
