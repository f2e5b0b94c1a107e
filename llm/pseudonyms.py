"""Format-preserving pseudonyms for personal numbers and dates, by a keyed Feistel permutation.

What validates as a payment card, bank account, social security or telephone number, network address, date or e-mail
address is replaced by another value of the same format that validates too. The permutation depends on the key, the kind
and the domain only, so equal values get equal pseudonyms in every document, however they are punctuated, and whoever
holds the key can undo it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm.spark import table

#: Rounds of the Feistel network.
ROUNDS = 10
#: For examples and tests; a deployment passes its own secret.
EXAMPLE_KEY = b"example key, not a secret"
_FIRST_DAY, _LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

#: What may be personal, by kind; every match is validated before it is replaced. Earlier kinds go first. A network address
#: may change its length, so no other value reaches into one.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w|(?:\.[0-9]{1,3}){3})",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])",
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./-])[0-9]{2}\1[0-9]{4})(?!\w|[./-][0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\w)"
    r"|(?<![\w+])\+[0-9]{8,15}(?!\w)|(?<![\w+])\+[0-9]{1,3}(?:[ -][0-9]{1,12}){1,6}(?!\w|(?:\.[0-9]{1,3}){3})",
    "card": r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?!\w|(?:\.[0-9]{1,3}){3})"
    r"|(?<![\w-])[0-9]{4}(?:(?:\.[0-9]{4}){3}|(?:/[0-9]{4}){3}|(?: [0-9]{4}){3})(?!\w)",
}
#: Kinds whose pattern may take in what follows a value: shorter prefixes that end before a separator are looked at too.
_OPEN = {"iban", "card", "phone"}
#: Characters of an IBAN by country; of other countries any length is looked at.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28,
    EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26,
    IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, LY=25, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30,
    NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SD=18, SE=24, SI=19, SK=24, SM=27, ST=25, SV=28,
    TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)


@dataclass(frozen=True)
class Permutation:
    """Keyed permutations of [0, size): a balanced Feistel network that walks on until it is inside."""

    key: bytes

    def _round(self, tweak: bytes, i: int, half: int, bits: int) -> int:
        made = blake2b(half.to_bytes(32, "big"), digest_size=32, key=self.key, person=bytes([i]), salt=blake2b(tweak, digest_size=16).digest())
        return int.from_bytes(made.digest(), "big") & ((1 << bits) - 1)

    def _walk(self, value: int, size: int, tweak: bytes, order: range) -> int:
        if not 0 <= value < size:
            raise ValueError("The value is outside the domain.")
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        tweak = tweak + b"/%d" % size
        while True:
            a, b = value >> bits, value & ((1 << bits) - 1)
            for i in order:
                if order.step > 0:
                    a, b = b, a ^ self._round(tweak, i, b, bits)
                else:
                    a, b = b ^ self._round(tweak, i, a, bits), a
            value = (a << bits) | b
            if value < size:
                return value

    def permute(self, value: int, size: int, tweak: str) -> int:
        return self._walk(value, size, tweak.encode(), range(ROUNDS))

    def restore(self, value: int, size: int, tweak: str) -> int:
        return self._walk(value, size, tweak.encode(), range(ROUNDS - 1, -1, -1))


def luhn_digit(digits: str) -> str:
    """The check digit that completes `digits`."""
    total = sum(sum(divmod(int(d) * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{98 - int(number) % 97:02d}"


def _refill(shape: str, filling: str, keep: int = 0) -> str:
    """`shape` with its letters and digits, after the first `keep`, replaced in turn."""
    out, at, seen = [], iter(filling), 0
    for c in shape:
        if c.isascii() and c.isalnum():
            seen += 1
            out.append(c if seen <= keep else next(at))
        else:
            out.append(c)
    return "".join(out)


class Pseudonyms:
    """Pseudonyms under one key. `inverse` gives back what a pseudonym stands for."""

    def __init__(self, key: bytes, inverse: bool = False) -> None:
        if not key or len(key) > 64:
            raise ValueError("A key has 1 to 64 bytes.")
        self.inverse = inverse
        self._map = Permutation(key).restore if inverse else Permutation(key).permute
        self.replaced = lru_cache(maxsize=100_000)(self._replaced)

    def _digits(self, digits: str, tweak: str) -> str:
        return f"{self._map(int(digits), 10 ** len(digits), tweak):0{len(digits)}d}"

    def _replaced(self, kind: str, found: str) -> str | None:
        """The pseudonym, or None if `found` does not validate as the kind."""
        plain = re.sub(r"[^0-9A-Za-z]", "", found)
        return getattr(self, f"_{kind}")(found, plain)

    def _card(self, found: str, plain: str) -> str | None:
        if luhn_digit(plain[:-1]) != plain[-1] or len(set(plain)) == 1:
            return None
        new = self._digits(plain[:-1], "card")
        return _refill(found, new + luhn_digit(new))

    def _iban(self, found: str, plain: str) -> str | None:
        country, account = plain[:2], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, account) != plain[2:4]:
            return None
        new = self._classes(account, f"iban {country}")
        return _refill(found, iban_check(country, new) + new, keep=2)

    def _classes(self, text: str, tweak: str) -> str:
        """Permutes digits among digits and letters among letters of their case."""
        bases = [(48, 10) if c.isdigit() else (65, 26) if c.isupper() else (97, 26) for c in text]
        value, size = 0, 1
        for c, (low, base) in zip(text, bases, strict=True):
            value, size = value * base + ord(c) - low, size * base
        value = self._map(value, size, f"{tweak} {''.join('d' if b[0] == 48 else 'A' if b[0] == 65 else 'a' for b in bases)}")
        out = []
        for low, base in reversed(bases):
            value, digit = divmod(value, base)
            out.append(chr(low + digit))
        return "".join(reversed(out))

    def _ip(self, found: str, plain: str) -> str | None:
        parts = [int(x) for x in found.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in found.split(".")):
            return None
        new = self._map(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, new.to_bytes(4, "big")))

    def _date(self, found: str, plain: str) -> str | None:
        a, b, c = (int(x) for x in re.split(r"[./-]", found))
        for form in ((0, 1, 2),) if a > 31 else ((2, 1, 0), (2, 0, 1)):  # year first; else day first, then month first
            try:
                day = date(*((a, b, c)[i] for i in form))
            except ValueError:
                continue
            if not _FIRST_DAY <= day <= _LAST_DAY:
                return None
            new = (day - _FIRST_DAY).days
            while True:  # a month-first date stays one that reads no other way, so that it can be undone
                new = self._map(new, (_LAST_DAY - _FIRST_DAY).days + 1, "date")
                made = _FIRST_DAY + timedelta(days=new)
                if form != (2, 0, 1) or made.day > 12:
                    break
            values = dict(zip(form, (made.year, made.month, made.day), strict=True))
            return _refill(found, "".join(f"{values[i]:0{4 if i == form[0] else 2}d}" for i in range(3)))
        return None

    def _ssn(self, found: str, plain: str) -> str | None:
        area, group, serial = int(plain[:3]), int(plain[3:5]), int(plain[5:])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        place = area - 1 - (area > 666)
        new = self._map((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
        new, serial = divmod(new, 9999)
        place, group = divmod(new, 99)
        return _refill(found, f"{place + 1 + (place >= 665):03d}{group + 1:02d}{serial + 1:04d}")

    def _phone(self, found: str, plain: str) -> str | None:
        code = len(plain) - 10 if "(" in found or re.search(r"\d{3}[ .-]\d{3}[ .-]\d{4}$", found) else 0
        national = plain[code:]
        if code <= 0 and found.startswith("+"):  # country codes are not told apart: the first three digits stay
            if not 8 <= len(plain) <= 15:
                return None
            return _refill(found, plain[:3] + self._digits(plain[3:], f"phone {plain[:3]}"))
        if national[0] in "01" or national[3] in "01":
            return None
        value = int(national[0]) - 2
        value = value * 100 + int(national[1:3])
        value = (value * 8 + int(national[3]) - 2) * 10**6 + int(national[4:])
        new = self._map(value, 64 * 10**8, "phone")
        new, tail = divmod(new, 10**6)
        new, exchange = divmod(new, 8)
        lead, area = divmod(new, 100)
        return _refill(found, f"{plain[:code]}{lead + 2}{area:02d}{exchange + 2}{tail:06d}")

    def _email(self, found: str, plain: str) -> str | None:
        name, _, host = found.rpartition("@")
        letters = "".join(c for c in name if c.isalnum())
        return f"{_refill(name, self._classes(letters, 'email'))}@{host}" if letters else None


_KINDS = {k: re.compile(p) for k, p in PATTERNS.items()}
_ANY = re.compile("|".join(f"(?P<{k}>{p.replace(chr(92) + '1', '(?P=mark)').replace('([./-])', '(?P<mark>[./-])')})" for k, p in PATTERNS.items()))
_DIGIT = re.compile(r"[0-9@]")


def _prefixes(kind: str, found: str) -> list[str]:
    """What a match may stand for, in the order in which it is tried."""
    if kind not in _OPEN:
        return [found]
    ends = [i for i in range(1, len(found)) if found[i - 1].isalnum() and not found[i].isalnum()]
    out = [found[:i] for i in [*ends, len(found)]]
    if kind == "phone":  # where it ends is not known, so as much as there is
        return [x for x in reversed(out) if x == found or _KINDS["phone"].fullmatch(x)]
    size = lambda x: sum(c.isalnum() for c in x)
    if kind == "card":
        return [x for x in out if size(x) >= 13]
    known = [i for i, x in enumerate(out) if size(x) == IBAN_LENGTHS.get(found[:2])]
    return out[known[0] :] if known else [x for x in out if size(x) >= 15]


@dataclass(frozen=True)
class _Span:
    kind: str
    begin: int
    end: int
    cluster: int  # where the run of candidates begins that reach into each other


def _spans(text: str, names: Pseudonyms, at: int = 0, end: int | None = None) -> tuple[list[_Span], dict[int, int]]:
    """What validates in text[at:end], from left to right, and the clusters that hold a candidate that does not, with their ends."""
    found, failed = [], {}
    cluster = reach = -1
    while (match := _ANY.search(text, at)) and (end is None or match.start() < end):
        begin = match.start()
        if begin >= reach:
            cluster = begin
        at = begin + 1
        for kind, pattern in _KINDS.items():
            if not (match := pattern.match(text, begin)):
                continue
            reach = max(reach, match.end())
            for part in _prefixes(kind, match[0]):
                if names.replaced(kind, part) is not None:
                    found.append(_Span(kind, begin, begin + len(part), cluster))
                    at = begin + len(part)
                    break
                failed[cluster] = reach
            if at > begin + 1:
                break
        if cluster in failed:
            failed[cluster] = reach
    return found, failed


def pseudonymized(text: str, names: Pseudonyms) -> tuple[str, Counter]:
    """`text` with pseudonyms, and how many of each kind.

    Where candidates that do not validate reach into a value, its pseudonym is permuted on until the text reads as the
    same values as before, so that the key finds them again; the key's holder undoes such a cluster from its end.
    """
    if not _DIGIT.search(text):
        return text, Counter()
    spans, failed = _spans(text, names)
    clusters: dict[int, list[_Span]] = {}
    for span in spans:
        clusters.setdefault(span.cluster, []).append(span)
    for first in sorted(clusters, reverse=True):  # what is before does not move
        own = clusters[first]
        if first not in failed:
            for span in reversed(own):
                text = text[: span.begin] + names.replaced(span.kind, text[span.begin : span.end]) + text[span.end :]
            continue
        own, stop = list(own), max(failed[first], own[-1].end)
        for i in range(len(own)) if not names.inverse else range(len(own) - 1, -1, -1):
            begin, new = own[i].begin, text[own[i].begin : own[i].end]
            while True:
                new = names.replaced(own[i].kind, new)
                grown = len(new) - (own[i].end - begin)  # an address may change its length
                made = text[:begin] + new + text[own[i].end :]
                move = lambda x, j: (x.kind, x.begin + grown * (j > i), x.end + grown * (j >= i))  # noqa: B023, E731
                if [(x.kind, x.begin, x.end) for x in _spans(made, names, first, stop + grown)[0]] == [move(x, j) for j, x in enumerate(own)]:
                    break
            text, stop = made, stop + grown
            own = [_Span(*move(x, j), first) for j, x in enumerate(own)]
    return text, Counter(x.kind for x in spans)


def replace_personal(docs: DataFrame, key: bytes = EXAMPLE_KEY, inverse: bool = False) -> DataFrame:
    """(doc_id, n_replaced, kinds, text) of every row of docs(doc_id, text).

    kinds maps each kind that was replaced to its number. A null text stays null, with 0 replaced; a text without
    personal values stays as it is; rows that repeat give equal rows; other columns are left aside.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, inverse)
        for batch in batches:
            texts, totals, kinds = [], [], []
            for text in batch["text"].to_pylist():
                new, found = pseudonymized(text, names) if text is not None else (None, Counter())
                texts.append(new)
                totals.append(found.total())
                kinds.append(sorted(found.items()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(totals, pa.int64()), pa.array(kinds, pa.map_(pa.string(), pa.int64())), pa.array(texts, pa.string())],
                names=["doc_id", "n_replaced", "kinds", "text"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_replaced long, kinds map<string,long>, text string")


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_personal(table(spark, sf_dir, "documents"))
    return out.selectExpr(
        "doc_id", "n_replaced", "array_join(transform(map_entries(kinds), e -> concat(e.key, '=', e.value)), ',') as kinds", "text"
    )
