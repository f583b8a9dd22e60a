"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation.

Card numbers and IBANs (with valid check digits), social security numbers, telephone numbers,
IPv4 addresses, dates, e-mail addresses and credentials are found in the whole text and replaced.
Each kind is a finite set of values in a fixed format; a Feistel network whose rounds are keyed
hashes permutes that set, stepping on until the result lies in it again.  So a pseudonym has the
format, the length and the check digits of its original, equal values get equal pseudonyms in
every document, and who holds the key can go back.  A value never stays as it was.

What fails its check takes nothing with it: other kinds are tried at the same place, and the search
goes on inside it.  After a value the search goes on where the value ends.  A pseudonym inside such
a candidate can happen to fulfil the candidate's check (one card number in ten, one IBAN in 97);
only there ``back`` reads the wrong value.

Null text stays null, text without such values stays as it is, and so do numbers that fail their
check.  Other columns pass untouched; repeated rows are treated alike.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import string

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, slices

ROUNDS = 8

# The formats that are looked for.
_FORMATS = r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-]))
  | (?P<secret>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b
      | \b(?:gh[pousr]_|sk-|xox[abp]-)[A-Za-z0-9_-]{16,}
      | (?<=password=)[^\s"',;]{4,} | (?<=password:[ ])[^\s"',;]{4,}
      | \b(?:(?<=token[ ]=[ ]")|(?<=token=)|(?<=api_key=)|(?<=secret=))[A-Za-z0-9_/+=.-]{8,})
  | (?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
  | (?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))
  | (?P<date>(?<![\d/.-])(?:(?:19|20)\d\d(?P<s1>[-/.])\d\d(?P=s1)\d\d|\d\d(?P<s2>[-/.])\d\d(?P=s2)(?:19|20)\d\d)(?![\d/-]|\.\d))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<phone>(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)
      | (?<![\w+])\+(?!1[ .(-])\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)
      | (?<![\w+(-])\(\d{3}\)[ ]?\d{3}[ .-]\d{4}(?!\d) | (?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]))
  | (?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<s3>[ -])\d{4}(?P=s3)\d{4}(?P=s3)\d{1,7}|\d{4}(?P<s4>[ -])\d{6}(?P=s4)\d{5})(?![\w-]))
    """
_PATTERN = re.compile(_FORMATS, re.VERBOSE)
# What else may start at the place of a candidate that failed: the kinds behind its own.
_STARTS = [m.start() for m in re.finditer(r"\(\?P<(?!s\d)", _FORMATS)]
_LATER = {re.match(r"\(\?P<(\w+)", _FORMATS[a:])[1]: re.compile(_FORMATS[b:], re.VERBOSE) for a, b in zip(_STARTS, _STARTS[1:])}
# A text without a digit or an at sign has nothing to look for.
_MAYBE = re.compile(r"[0-9@]|password|token|secret|api_key")
_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
_LOWER, _UPPER = string.digits + string.ascii_lowercase, string.digits + string.ascii_uppercase


class Feistel:
    """Keyed permutations of 0..n-1 and of strings over an alphabet."""

    def __init__(self, key: bytes, rounds: int = ROUNDS) -> None:
        self.key, self.rounds = key, rounds

    def _round(self, tweak: bytes, i: int, value: int, size: int) -> int:
        data = tweak + b"|%d|%d|%d" % (i, value, size)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big") % size

    def _once(self, x: int, a: int, b: int, tweak: bytes, back: bool) -> int:
        """One pass over 0..a*b-1: the halves x div b and x mod b are shifted by hashes of each other in turn."""
        left, right = divmod(x, b)
        for i in reversed(range(self.rounds)) if back else range(self.rounds):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * self._round(tweak, i, left, b)) % b
            else:
                left = (left + sign * self._round(tweak, i, right, a)) % a
        return left * b + right

    def permute(self, x: int, n: int, tweak: bytes, back: bool = False) -> int:
        """Where the permutation of 0..n-1 (or its inverse) takes x."""
        if n < 2:
            return x
        b = int(n**0.5) + 1 if n < 1 << 50 else 1 << ((n.bit_length() + 1) // 2)
        a = -(-n // b)
        while True:  # step on until inside; a * b is below 2n for all but the smallest n
            x = self._once(x, a, b, tweak, back)
            if x < n:
                return x

    def other(self, x: int, n: int, tweak: bytes, back: bool = False) -> int:
        """As ``permute``, on one cycle more where x would stay: no value keeps itself unless n is 1.

        x -> permute(permute_inverse(x) + 1) is the permutation of one single cycle.
        """
        step = -1 if back else 1
        return self.permute((self.permute(x, n, tweak, True) + step) % n, n, tweak)


def luhn(digits: str) -> int:
    """The check sum modulo 10; 0 for a valid number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _fill(shape: str, symbols: str, old: str) -> str:
    """``shape`` with the characters of ``old``'s positions replaced by ``symbols`` in order."""
    it = iter(symbols)
    return "".join(next(it) if c in old else c for c in shape)


class Pseudonyms:
    """Finds and replaces values with one key."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.feistel, self.back = Feistel(key), back
        self.known: dict[tuple[str, str], str | None] = {}

    def _digits(self, text: str, tweak: bytes, n: int | None = None) -> str:
        """Another string of as many digits."""
        return str(self.feistel.other(int(text), n or 10 ** len(text), tweak + b"%d" % len(text), self.back)).zfill(len(text))

    def _word(self, text: str, tweak: bytes) -> str:
        """Another string whose every character is of the class (digit, lower, upper) that it was."""
        classes = [next((k for k in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in k), "") for c in text]
        x, n = 0, 1
        for c, k in zip(text, classes):
            if k:
                x, n = x * len(k) + k.index(c), n * len(k)
        x = self.feistel.other(x, n, tweak + repr([len(k) for k in classes]).encode(), self.back)
        out = []
        for c, k in zip(reversed(text), reversed(classes)):
            if k:
                x, i = divmod(x, len(k))
                c = k[i]
            out.append(c)
        return "".join(reversed(out))

    def card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
            return None
        # The first digit names the network; the last is the check digit.
        while True:
            body = digits[0] + self._digits(digits[1:-1], b"card" + digits[:1].encode())
            digits = body + str(-luhn(body + "0") % 10)
            if len(set(digits)) > 1:
                return _fill(value, digits, string.digits)

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = self._word(plain[4:], b"iban" + plain[:2].encode())
        check = 98 - _mod97(body + plain[:2] + "00")
        return _fill(value, f"{plain[:2]}{check:02d}{body}", _UPPER)

    def ssn(self, value: str) -> str | None:
        a, b, c = (int(x) for x in value.split("-"))

        def valid(a: int, b: int, c: int) -> bool:
            return 0 < a < 900 and a != 666 and b > 0 and c > 0

        if not valid(a, b, c):
            return None
        x = (a * 100 + b) * 10_000 + c
        while True:
            x = self.feistel.other(x, 10**9, b"ssn", self.back)
            a, rest = divmod(x, 1_000_000)
            b, c = divmod(rest, 10_000)
            if valid(a, b, c):
                return f"{a:03d}-{b:02d}-{c:04d}"

    def phone(self, value: str) -> str | None:
        # The country code stays, so the number stays one of its country.
        country = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d|", value).group()
        rest = value[len(country) :]
        digits = re.sub(r"\D", "", rest)
        if not 6 <= len(digits) <= 14:
            return None
        return country + _fill(rest, self._digits(digits, b"phone" + country.encode()), string.digits)

    def ip(self, value: str) -> str | None:
        x = 0
        for part in value.split("."):
            x = x * 256 + int(part)
        lengths = [len(p) for p in value.split(".")]
        # The octets keep their number of digits: 10, 90 or 156 values each.
        low, size = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 90, 3: 156}
        octets = [int(p) for p in value.split(".")]
        if any(not 0 <= o - low[n] < size[n] for o, n in zip(octets, lengths)):
            return None
        x, n = 0, 1
        for o, k in zip(octets, lengths):
            x, n = x * size[k] + o - low[k], n * size[k]
        x = self.feistel.other(x, n, b"ip" + repr(lengths).encode(), self.back)
        out = []
        for k in reversed(lengths):
            x, o = divmod(x, size[k])
            out.append(str(o + low[k]))
        return ".".join(reversed(out))

    def date(self, value: str) -> str | None:
        a, b, c = (int(x) for x in re.split(r"[-/.]", value))
        year_first = a > 99
        mark = value[4] if year_first else value[2]
        # Day and month by the only order that is valid; day first where both are.
        orders = ("ymd",) if year_first else ("dmy", "mdy")
        for order in orders:
            y, m, d = {"ymd": (a, b, c), "dmy": (c, b, a), "mdy": (c, a, b)}[order]
            try:
                day = datetime.date(y, m, d).toordinal()
            except ValueError:
                continue
            while True:
                day = _FIRST_DAY + self.feistel.other(day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, b"date" + order.encode(), self.back)
                new = datetime.date.fromordinal(day)
                if order != "mdy" or new.day > 12:  # else it would be read back as day first
                    break
            return {
                "ymd": f"{new.year}{mark}{new.month:02d}{mark}{new.day:02d}",
                "dmy": f"{new.day:02d}{mark}{new.month:02d}{mark}{new.year}",
                "mdy": f"{new.month:02d}{mark}{new.day:02d}{mark}{new.year}",
            }[order]
        return None

    def email(self, value: str) -> str | None:
        name, _, host = value.rpartition("@")
        # Name and host apart, so that addresses of one host stay together; the top level stays.
        host, _, top = host.rpartition(".")
        return f"{self._word(name, b'name')}@{self._word(host, b'host')}.{top}"

    def secret(self, value: str) -> str | None:
        prefix = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-|", value).group()
        return prefix + self._word(value[len(prefix) :], b"secret" + prefix.encode())

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of each in the new text; lengths don't change."""
        if not _MAYBE.search(text):
            return text, []
        spans, out, at = [], [], 0
        m = _PATTERN.search(text)
        while m:
            kind, value = m.lastgroup, m.group()
            if kind == "iban":
                # A short word in capitals may follow; the check digits tell where the number ends.
                while " " in value and self.iban(value) is None:
                    value = value.rpartition(" ")[0]
            new = self.known.get((kind, value), "")
            if new == "":
                new = getattr(self, kind)(value)
                if len(self.known) >= 100_000:
                    self.known = {}
                self.known[kind, value] = new
            if new is not None:
                out += [text[at : m.start()], new]
                at = m.start() + len(value)
                spans.append((kind, m.start(), at))
                m = _PATTERN.search(text, at)
            else:
                # Another kind may start at the same place, and any inside what the candidate took.
                m = (kind in _LATER and _LATER[kind].match(text, m.start())) or _PATTERN.search(text, m.start() + 1)
        return ("".join([*out, text[at:]]), spans) if spans else (text, [])


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False, text: str = "text") -> DataFrame:
    """The rows with pseudonyms in ``text``, all other columns as they are; ``back`` restores."""

    def run(batches):
        names = Pseudonyms(key, back)
        for batch in slices(batches):
            at = batch.schema.get_field_index(text)
            new = [t if t is None else names.replace(t)[0] for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return bounded(docs).mapInArrow(run, docs.schema)


def findings(docs: DataFrame, key: bytes, id_col: str = "doc_id") -> DataFrame:
    """(id, text, n_found, kinds): the text with pseudonyms and what was replaced; null text gives null and 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        names = Pseudonyms(key)
        for batch in slices(batches):
            done = [(None, []) if t is None else names.replace(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([t for t, _ in done], pa.string()),
                    pa.array([len(s) for _, s in done], pa.int64()),
                    pa.array([",".join(sorted({k for k, _, _ in s})) for _, s in done], pa.string()),
                ],
                names=[id_col, "text", "n_found", "kinds"],
            )

    return bounded(docs).select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, text string, n_found bigint, kinds string")
