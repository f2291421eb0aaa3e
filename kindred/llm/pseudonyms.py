"""Format-preserving pseudonyms for personal numbers and dates, by keyed Feistel permutations."""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from datetime import date
from functools import cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kindred.session import lean

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
LOWER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
#: Fixed lengths of account numbers by country: all of the IBAN registry.
IBAN_SIZES = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 "
        "GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 "
        "NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30 "
    ).split()
}


class Feistel:
    """Permutations of the numbers below any size, one for each tweak, under a key.

    Alternating halves over the product of two near-equal factors, with HMAC-SHA-256 as the round
    function; a result outside the size is permuted again until it is inside (cycle walking), which
    ends because the number came from inside.
    """

    def __init__(self, key: bytes):
        self.key = key
        self.memory: dict[tuple[int, int, str], int] = {}

    def _round(self, k: int, value: int, size: int, tweak: str) -> int:
        mark = f"{k}|{value}|{size}|{tweak}".encode()
        return int.from_bytes(hmac.digest(self.key, mark, "sha256"), "big")

    def _once(self, x: int, a: int, b: int, size: int, tweak: str, back: bool) -> int:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2 == 0:
                left = (left + sign * self._round(k, right, size, tweak)) % a
            else:
                right = (right + sign * self._round(k, left, size, tweak)) % b
        return left * b + right

    def permute(self, x: int, size: int, tweak: str, back: bool = False) -> int:
        """Where x goes among the numbers below size; with back, where it came from."""
        if size < 2:
            return x
        if (found := self.memory.get((x, size, tweak))) is not None and not back:
            return found
        a = isqrt(size - 1) + 1
        b, start = -(-size // a), x
        while True:
            x = self._once(x, a, b, size, tweak, back)
            if x < size:
                break
        if not back:
            if len(self.memory) > 200_000:
                self.memory.clear()
            self.memory[(start, size, tweak)] = x
        return x


def luhn_valid(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def luhn_digit(body: str) -> str:
    return next(c for c in DIGITS if luhn_valid(body + c))


def _iban_rest(code: str) -> int:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


def _refill(shape: str, fresh: str, letters: str = DIGITS) -> str:
    """The characters of `fresh` in the places of `shape` that are among `letters`."""
    left = iter(fresh)
    return "".join(next(left) if c in letters else c for c in shape)


@cache
def _days(short: str) -> Sequence[int]:
    """The days from 1900 to 2099 in order, with months (m) and days (d) below 10 where those are `short`."""
    days = range(FIRST_DAY, LAST_DAY + 1)
    if not short:
        return days
    dates = map(date.fromordinal, days)
    return [d.toordinal() for d in dates if (d.month < 10 or "m" not in short) and (d.day < 10 or "d" not in short)]


class Pseudonyms:
    """Replacements of one key. Each kind keeps its separators, its length and what makes it valid."""

    def __init__(self, key: str):
        self.feistel = Feistel(key.encode())

    def _digits(self, digits: str, tweak: str) -> str:
        return str(self.feistel.permute(int(digits), 10 ** len(digits), f"{tweak}:{len(digits)}")).zfill(len(digits)) if digits else ""

    def card(self, found: str) -> str | None:
        digits = re.sub(r"[^0-9]", "", found)
        if not 13 <= len(digits) <= 19 or not luhn_valid(digits) or len(set(digits)) == 1:
            return None
        body = self._digits(digits[:-1], "card")
        return _refill(found, body + luhn_digit(body))

    def iban(self, found: str) -> str | None:
        code = re.sub(r"\s", "", found).upper()
        if IBAN_SIZES.get(code[:2]) != len(code) or _iban_rest(code) != 1:
            return None
        body = code[4:]
        digits = [c for c in body if c.isdigit()]
        fresh = _refill(body, self._digits("".join(digits), "iban" + code[:2]))
        check = 98 - _iban_rest(code[:2] + "00" + fresh)
        left = iter(code[:2] + f"{check:02d}" + fresh)
        return "".join(c if c.isspace() else next(left) for c in found)

    def phone(self, found: str) -> str | None:
        digits = re.sub(r"[^0-9]", "", found)
        if not 8 <= len(digits) <= 15:
            return None
        kept = 1 if found.lstrip().startswith("+1") else 2 if found.lstrip().startswith("+") else 0
        return _refill(found, digits[:kept] + self._digits(digits[kept:], f"phone{digits[:kept]}"))

    def social(self, found: str) -> str | None:
        area, group, serial = found.split("-")
        if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000":
            return None
        areas = [k for k in range(1, 900) if k != 666]
        place = (areas.index(int(area)) * 99 + int(group) - 1) * 9999 + int(serial) - 1
        rest, serial_new = divmod(self.feistel.permute(place, len(areas) * 99 * 9999, "social"), 9999)
        area_new, group_new = divmod(rest, 99)
        return f"{areas[area_new]:03d}-{group_new + 1:02d}-{serial_new + 1:04d}"

    def address(self, found: str) -> str | None:
        parts = found.split(".")
        if any(int(p) > 255 for p in parts):
            return None
        # The number of digits of each part stays, so the text keeps its length.
        lows = [0 if len(p) == 1 else 10 ** (len(p) - 1) for p in parts]
        highs = [min(255, 10 ** len(p) - 1) for p in parts]
        place, size = 0, 1
        for p, low, high in zip(parts, lows, highs, strict=True):
            place, size = place * (high - low + 1) + int(p) - low, size * (high - low + 1)
        new, out = self.feistel.permute(place, size, "address" + "".join(str(len(p)) for p in parts)), []
        for low, high in zip(reversed(lows), reversed(highs), strict=True):
            new, digit = divmod(new, high - low + 1)
            out.append(str(digit + low))
        return ".".join(reversed(out))

    def day(self, found: str) -> str | None:
        a, mark, b, _, c = re.fullmatch(r"([0-9]+)([-./])([0-9]+)([-./])([0-9]+)", found).groups()
        if len(a) == 4:
            order = "ymd"
        else:
            month_first = mark == "/" and int(b) > 12 or mark == "/" and int(a) <= 12
            order = "mdy" if month_first else "dmy"
        own = dict(zip(order, (a, b, c), strict=True))
        try:
            day = date(*(int(own[k]) for k in "ymd")).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # The number of digits of each part stays, so the text keeps its length.
        short = "".join(k for k in "md" if len(own[k]) == 1)
        days = _days(short)
        new = date.fromordinal(days[self.feistel.permute(bisect_left(days, day), len(days), "day" + short)])
        parts = {"y": f"{new.year:04d}", "m": f"{new.month:0{len(own['m'])}d}", "d": f"{new.day:0{len(own['d'])}d}"}
        return mark.join(parts[k] for k in order)

    def mail(self, found: str) -> str | None:
        local, at, domain = found.rpartition("@")
        return self._spelled(local, "mail") + at + domain

    def token(self, found: str) -> str | None:
        letters = HEX if found == found.lower() else HEX.upper()
        if not set(found) <= set(letters):
            return None
        new = self.feistel.permute(int(found, 16), 16 ** len(found), f"token:{len(found)}")
        out = f"{new:0{len(found)}x}"
        return out if letters == HEX else out.upper()

    def _spelled(self, text: str, tweak: str) -> str:
        """Letters stay letters of their case, digits digits; other characters stay as they are."""
        alphabets = [DIGITS if c in DIGITS else LOWER if c.lower() in LOWER else None for c in text]
        place, size = 0, 1
        for c, own in zip(text, alphabets, strict=True):
            if own:
                place, size = place * len(own) + own.index(c.lower()), size * len(own)
        shape = "".join("9" if a is DIGITS else "a" if a else c for c, a in zip(text, alphabets, strict=True))
        new, out = self.feistel.permute(place, size, f"{tweak}:{shape}"), []
        for c, own in zip(reversed(text), reversed(alphabets), strict=True):
            if own:
                new, k = divmod(new, len(own))
                out.append(own[k].upper() if c.isupper() else own[k])
            else:
                out.append(c)
        return "".join(reversed(out))


#: For queries and tests on made-up data only: whoever reads this can undo its pseudonyms.
TEST_KEY = "a test key that everyone knows"
KEY_SETTING = "spark.kindred.pseudonym.key"


def key_of(spark: SparkSession) -> str:
    """The secret key in the session's settings; the test key where none is set."""
    return spark.conf.get(KEY_SETTING, TEST_KEY)


KINDS = ("mail", "iban", "day", "address", "social", "phone", "token", "card")
STOP = r"(?![\w-]|\.[0-9])"
FORMS = [
    r"(?P<mail>(?<![\w.+%-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    r"(?P<iban>(?<!\w)[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,4})?(?!\w))",
    rf"(?P<day>(?<![\w./-])(?:[0-9]{{4}}(?P<s1>[-./])[0-9]{{1,2}}(?P=s1)[0-9]{{1,2}}(?=[Tt][0-9]{{2}})|(?:[0-9]{{4}}(?P<s2>[-./])[0-9]{{1,2}}(?P=s2)[0-9]{{1,2}}|[0-9]{{1,2}}(?P<s3>[-./])[0-9]{{1,2}}(?P=s3)[0-9]{{4}}){STOP}))",
    rf"(?P<address>(?<![\w.])[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{STOP})",
    r"(?P<social>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))",
    r"(?P<phone>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)|(?<![\w+(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?!\w)|(?<![\w+-])[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![\w-]))",
    r"(?P<token>(?<!\w)(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{32,64}(?!\w)|(?<!\w)(?=[0-9A-F]*[0-9])(?=[0-9A-F]*[A-F])[0-9A-F]{32,64}(?!\w))",
    r"(?P<card>(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]))",
]
PATTERN = re.compile("|".join(FORMS))
PATTERNS = dict(zip(KINDS, map(re.compile, FORMS), strict=True))
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
#: Cards as they are printed, not any run of numbers.
PRINTED = re.compile(r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}")
#: Where a match can begin.
START = re.compile(r"(?<!\w)[\w.+%(-]")


def _readings(text: str, start: int, using: Pseudonyms) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, kind and pseudonym of the valid values that begin at a place: by kind, longer ones first.

    A pattern takes all that may belong to a value, also a short word or number after it, so what ends
    at an earlier blank is tried too.
    """
    if not PATTERN.match(text, start):
        return
    for kind, pattern in PATTERNS.items():
        found = pattern.match(text, start)
        while found:
            if (new := getattr(using, kind)(found.group())) is not None:
                yield start, found.end(), kind, new
            cut = text.rfind(" ", start, found.end())
            found = pattern.match(text, start, cut) if cut > start else None


def _broken_account(text: str, start: int) -> int:
    """Where an account number of its country's length ends that begins at a place; 0 without one."""
    found = PATTERNS["iban"].match(text, start)
    while found:
        if IBAN_SIZES.get(found[0][:2].upper()) == len(found[0].replace(" ", "")):
            return found.end()
        cut = text.rfind(" ", start, found.end())
        found = PATTERNS["iban"].match(text, start, cut) if cut > start else None
    return 0


def _chosen(text: str, start: int, using: Pseudonyms, broken: int = 0) -> tuple[int, int, str, str] | None:
    """The value at a place, or none if there is none or a longer one overlaps.

    Numbers side by side may pass for a card or a phone number that ends inside the next value: then a
    shorter reading that leaves that value whole is taken, or else the longer of both. Before `broken`,
    inside an account number with wrong check digits, of all cards only 16 digits in fours count.
    """
    readings = (r for r in _readings(text, start, using) if start >= broken or r[2] != "card" or PRINTED.fullmatch(text, start, r[1]))
    if (own := next(readings, None)) is None or own[2] not in ("phone", "card"):
        return own
    end = own[1]
    rivals = (r for m in START.finditer(text, text.find(" ", start, end) + 1 or end, end) for r in _readings(text, m.start(), using))
    rival = max((r for r in rivals if r[1] > end and (r[2] != "card" or PRINTED.fullmatch(text, *r[:2]))), key=lambda r: r[1] - r[0], default=None)
    if rival is None:
        return own
    if shorter := next((r for r in readings if r[1] <= rival[0]), None):
        return shorter
    return own if end - start >= rival[1] - rival[0] else None


def _values(text: str, using: Pseudonyms) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, kind and pseudonym of the valid values in the whole text, from left to right.

    Every value begins in a word with a digit or @, so only those words' places are tried. After a
    place without a value the next one is tried.
    """
    at = broken = 0
    while mark := MARK.search(text, at):
        word = mark.start()
        while word > at and not text[word - 1].isspace():
            word -= 1
        after = SPACE.search(text, mark.end())
        at = after.start() if after else len(text)
        for start in START.finditer(text, word, at):
            if found := _chosen(text, start.start(), using, broken):
                yield found
                at = found[1]
                break
            broken = max(broken, _broken_account(text, start.start()))


def pseudonymise_text(text: str, using: Pseudonyms) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with every valid number and date replaced, and the places in the new text with their kinds."""
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, new in _values(text, using):
        gap = text[at:start]
        out += (gap, new)
        size += len(gap)
        spans.append((size, size + len(new), kind))
        size += len(new)
        at = end
    if not spans:
        return text, []
    return "".join([*out, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replace personal numbers and dates in a text column, adding spans (start, stop, kind in the new text) and n_replaced.

    Kinds: mail (the part before the @), IBAN (of all countries of the registry, in one piece or in
    fours) and card numbers that are valid by their check digits, dates of the calendar from 1900 to
    2099 in digits, with the year first or last in four digits, also of ISO timestamps, whose time stays, IPv4 addresses, US social security numbers, phone numbers
    and hexadecimal secrets. A value is permuted within all values of its format under `key`, so equal
    values have equal pseudonyms in all documents, different ones different, and whoever has the key
    can go back; check digits are made right again and separators stay. What isn't valid stays as it
    is, but for valid values inside it that begin a word and end at a blank or where the pattern ends.
    A card is any 13 to 19 digits with Luhn's check digit, so one in ten other numbers of that length,
    or such runs in a row of numbers, passes for one. Left out: dates with the month's name, a year of
    two digits, no separators or blanks in them, and dates that a word, a hyphen or an underscore joins; IBANs with other
    separators than single blanks. A phone number with its country's code and the same without it, and
    mail domains, which stay in clear, aren't linked or hidden. Whole texts are searched, however long;
    a null text stays null, an empty one empty, and an empty table has no rows. Where several readings
    begin at a place, the kind that stands first in KINDS and then the longest is taken. Other columns
    are kept, but for columns named like the added ones. Every row stands for itself: equal texts, also
    in repeated rows, become equal texts.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    kept = [c for c in docs.columns if c not in ("spans", "n_replaced")]
    at = kept.index(text)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("kind", T.StringType())])
    fields = T.StructType([*docs.select(kept).schema.fields, T.StructField("spans", T.ArrayType(span)), T.StructField("n_replaced", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = Pseudonyms(key)
        for batch in batches:
            texts, spans = [], []
            for value in batch.column(at).to_pylist():
                new, found = (None, []) if value is None else pseudonymise_text(value, using)
                texts.append(new)
                spans.append([{"start": a, "stop": b, "kind": k} for a, b, k in found])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind), pa.array([len(s) for s in spans], pa.int32())], names=[*kept, "spans", "n_replaced"])

    return docs.select(kept).mapInArrow(lean(run), fields)
