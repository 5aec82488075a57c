"""Personal data by anchor expansion.

One Aho-Corasick automaton reads every text once, from end to end, and reports anchors:
at-signs, plus signs, digits, colons, schemes and the cues of identifiers. A parser of
its own expands each anchor to both sides and checks what it found: the labels of a
domain, the parts of an address, check digits, the length of a number. Every parser
uses up what it has read, so the time grows with the text and not with its square.

Text is read as bytes (UTF-8, A-Z folded): all marks, digits and letters that the rules
name are ASCII, and no byte of another character is. Offsets are code points in the end.

Kinds. The first four are the base, exactly the leftmost matches of these patterns that do not
overlap within their kind, after which matches that fail the test are dropped:

======== ======================================================== =======================
email    ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
ip       ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``                 parts at most 255
card     ``[0-9]([\\x20-]?[0-9])+``                                14 to 19 digits, Luhn
phone    ``\\+[0-9][\\x20().0-9-]+[0-9]``                           10 to 15 digits
mail     an address that base cuts short or misses: quoted name, letters beyond ASCII,
         ``name [at] host [dot] tld``
ip6      an IPv6 address of three groups or more
iban     country, check digits and account, remainder 1 by 97
account  a number of 6 to 20 digits after a cue such as ``account`` or ``passport``
secret   a key of 16 characters or more, with digits, after a cue such as ``token``
login    ``user:password`` before the host of a URL
======== ======================================================== =======================

A span of the last six kinds that lies within another one found is not listed.
"""

from __future__ import annotations

import functools
import ipaddress
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.words import buffers, give_back

BASE = ("email", "ip", "card", "phone")
ADDED = ("mail", "ip6", "iban", "account", "secret", "login")
KINDS = BASE + ADDED
EMAIL, IP, CARD, PHONE, MAIL, IP6, IBAN, ACCOUNT, SECRET, LOGIN = range(10)

#: Cues before numbers, cues before keys, spelled-out at-signs, schemes of URLs.
ACCOUNT_CUES = (
    "account", "acct", "konto", "cuenta", "compte", "ssn", "social security", "passport",
    "pasaporte", "passeport", "reisepass", "tax id", "customer id", "routing",
)
SECRET_CUES = ("token", "secret", "password", "passwd", "api key", "api_key", "apikey", "access key", "access_key")
SPELLED_AT = ("[at]", "(at)", "{at}")
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "ssh://", "sftp://", "git://", "postgres://", "mysql://")

#: The automaton gets long texts in parts: it copies what it is given.
PART = 1 << 20

_FOLD = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
_LOCAL = "abcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HIGH = "".join(map(chr, range(0x80, 0x100)))
_DOMAIN = re.compile(r"[a-z0-9-]+(?:\.[a-z0-9-]+)+").match
_WIDE_DOMAIN = re.compile(r"[a-z0-9\x80-\xff-]+(?:\.[a-z0-9\x80-\xff-]+)+").match
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){0,3}").match
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*").match
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_SPELLED = re.compile(r"(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64} ?\Z").search
_SPELLED_HOST = re.compile(r" ?[a-z0-9-]+(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?|\.)[a-z0-9-]+)+").match
_COLONS = re.compile(r"[0-9a-f:]*").match
_IBAN = re.compile(r"[0-9]{2}(?:[a-z0-9]{11,30}|(?: [a-z0-9]{4}){2,7}(?: [a-z0-9]{1,3})?)(?![a-z0-9])").match
_GAP = r"(?: ?(?:no|nr|num|number|nummer|id|key|numero|n)\b)?[ .:=#\"'-]{0,6}"
_ACCOUNT = re.compile(_GAP + r"([0-9](?:[ -]?[0-9]){5,19})(?![0-9a-z])").match
_SECRET = re.compile(_GAP + r"([a-z0-9_+/-]{16,512}={0,2})(?![a-z0-9_+/-])").match
_LOGIN = re.compile(r"([a-z0-9._~%+-]{1,128}:[^\x00-\x20/@:]{1,128})@[a-z0-9\[]").match
_NUMBERS = {ord(x): str(int(x, 36)) for x in "abcdefghijklmnopqrstuvwxyz"}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789" + _HIGH)


@functools.lru_cache(maxsize=1)
def _automaton():
    """All anchors, each with what parses it and its length; once per worker."""
    import ahocorasick

    words = {"@": "at", "+": "plus", ":": "colon"} | {str(x): "digit" for x in range(10)}
    words |= {x: "account" for x in ACCOUNT_CUES} | {x: "secret" for x in SECRET_CUES}
    words |= {x: "spelled" for x in SPELLED_AT} | {x: "scheme" for x in SCHEMES}
    automaton = ahocorasick.Automaton()
    for word, parser in words.items():
        automaton.add_word(word, (parser, len(word)))
    automaton.make_automaton()
    return automaton


def anchors(text: str) -> Iterator[tuple[str, int, int]]:
    """(parser, start, end) of every anchor of a folded text, by end."""
    found = _automaton().iter(text[:PART])
    for start in range(0, max(len(text), 1), PART):
        if start:
            found.set(text[start : start + PART])
        for last, (parser, length) in found:
            yield parser, last + 1 - length, last + 1


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _iban(text: str, at: int) -> int | None:
    """The end of an IBAN whose check digits are at ``at``; letters of a word after it are given back."""
    found = _IBAN(text, at)
    if not found:
        return None
    end = found.end()
    while end > at:
        code = text[at - 2 : end].replace(" ", "")
        if len(code) < 15:
            return None
        if len(code) <= 34 and int((code[4:] + code[:4]).translate(_NUMBERS)) % 97 == 1:
            return end
        end = text.rfind(" ", at, end)
    return None


def _address(text: str, low: int, at: int) -> tuple[int, int, int]:
    """(start, end, end of what was read) of the hexadecimal groups around a colon."""
    left = at
    while left > low and text[left - 1] in "0123456789abcdef:":
        left -= 1
    end = _COLONS(text, at).end()
    return left, end, end


def _wide_mail(text: str, low: int, at: int) -> tuple[int, int, int] | None:
    """The address around the at-sign at ``at`` if letters of any script, or a quoted name, count."""
    if at > low and text[at - 1] == '"':
        name = text.rfind('"', max(low, at - 66), at - 1)
        if not 0 <= name < at - 2:
            return None
    else:
        name = low + len(text[low:at].rstrip(_LOCAL + _HIGH))
        letters = text[name:at].encode("latin-1").decode(errors="ignore")
        for place in range(len(letters) - 1, -1, -1):
            if not (letters[place].isalnum() or letters[place] in _LOCAL):
                letters = letters[place + 1 :]
                break
        name = at - len(letters.encode())
    host = _WIDE_DOMAIN(text, at + 1)
    if name >= at or not host:
        return None
    letters = host.group().encode("latin-1").decode(errors="ignore")
    stop = next((i for i, x in enumerate(letters) if not (x.isalnum() or x in ".-")), len(letters))
    letters = letters[:stop].rstrip(".-")
    return (name, MAIL, at + 1 + len(letters.encode())) if "." in letters else None


def spans(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, kind number, end) of all personal data of a folded text, in its own offsets."""
    out: list[tuple[int, int, int]] = []
    more: list[tuple[int, int, int]] = []
    email_end = after_at = card_end = ip_end = colon_end = 0
    for parser, start, end in anchors(text):
        if parser == "digit":
            if start >= ip_end:
                found = _DOTTED(text, start)
                ip_end = found.end()
                parts = text[start:ip_end].split(".")
                if len(parts) == 4 and all(map(_small, parts)):
                    out.append((start, IP, ip_end))
            if start >= card_end:
                card_end = _DIGITS(text, start).end()
                if card_end - start >= 14:
                    digits = text[start:card_end].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append((start, CARD, card_end))
                if start >= 2 and text[start - 2 : start].isascii() and text[start - 2 : start].isalpha():
                    if start == 2 or text[start - 3] not in _WORD:
                        stop = _iban(text, start)
                        if stop:
                            more.append((start - 2, IBAN, stop))
        elif parser == "at":
            low = max(email_end, after_at)
            local = low + len(text[low:start].rstrip(_LOCAL))
            found = _DOMAIN(text, end)
            if local < start and found:
                out.append((local, EMAIL, found.end()))
                email_end = found.end()
            wide = _wide_mail(text, after_at, start)
            if wide:
                more.append(wide)
            after_at = end
        elif parser == "plus":
            found = _PHONE(text, start)
            if found and 10 <= sum(map(str.isdigit, found.group())) <= 15:
                out.append((start, PHONE, found.end()))
        elif parser == "colon":
            if start >= colon_end:
                left, stop, colon_end = _address(text, colon_end, start)
                groups = text[left:stop]
                clear = (left == 0 or text[left - 1] not in _WORD) and (stop == len(text) or text[stop] not in _WORD)
                if clear and 4 <= len(groups) <= 39 and sum(map(bool, groups.split(":"))) >= 3:
                    try:
                        ipaddress.IPv6Address(groups)
                    except ValueError:
                        continue
                    more.append((left, IP6, stop))
        elif parser == "scheme":
            found = _LOGIN(text, end)
            if found:
                more.append((end, LOGIN, found.end(1)))
        elif parser == "spelled":
            name = _SPELLED(text[max(0, start - 66) : start])
            host = _SPELLED_HOST(text, end)
            if name and host:
                more.append((start - len(name.group()), MAIL, host.end()))
        elif start == 0 or text[start - 1] not in _WORD:
            if parser == "account":
                found = _ACCOUNT(text, end)
                if found:
                    more.append((found.start(1), ACCOUNT, found.end(1)))
            else:
                found = _SECRET(text, end)
                if found and any(map(str.isdigit, found.group(1))):
                    more.append((found.start(1), SECRET, found.end(1)))
    return sorted(out + _outer(more, out))


def _outer(more: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The added spans that lie in no other span."""
    kept = []
    reach, rest = -1, sorted(base)
    at = 0
    for start, kind, end in sorted(more, key=lambda x: (x[0], -x[2], x[1])):
        while at < len(rest) and rest[at][0] <= start:
            reach = max(reach, rest[at][2])
            at += 1
        if end > reach:
            kept.append((start, kind, end))
            reach = end
    return kept


def points(raw: bytes, offsets: Sequence[int]) -> dict[int, int]:
    """Code points before each of the byte offsets."""
    if raw.isascii():
        return {x: x for x in offsets}
    data = np.frombuffer(raw, np.uint8)
    out, before, total = {}, 0, 0
    for offset in sorted(set(offsets)):
        total += int(np.count_nonzero((data[before:offset] & 0xC0) != 0x80))
        out[offset], before = total, offset
    return out


def _rows(column: pa.Array) -> Iterator[bytes]:
    raw, ends = buffers(column)
    for row in range(len(ends) - 1):
        yield raw[ends[row] : ends[row + 1]].tobytes()


def _found(raw: bytes) -> list[tuple[int, int, int]]:
    return spans(raw.translate(_FOLD).decode("latin-1")) if raw else []


SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def personal_spans(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", into: str = "spans") -> DataFrame:
    """Per row: the columns ``keep`` and the array ``into`` of (kind, start, end), by start, then kind.

    Offsets are code points, the end exclusive. A null or empty text has an empty array.
    Each row is judged by itself: repeated rows repeat their spans, ties cannot occur, a
    null in ``keep`` stays null, an empty table gives an empty one. Columns not in
    ``keep`` go nowhere near the result, whatever their names; ``into`` must be none of
    ``keep``. A text is read whole, however long.
    """
    if into in keep:
        raise ValueError(f"column {into} is both kept and made")
    fields = [docs.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField(into, T.ArrayType(SPAN))])
    # The text goes last under a name that is free.
    free = "_text"
    while free in keep:
        free += "_"
    rows = docs.select(*[F.col(f"`{x}`") for x in keep], F.col(f"`{text}`").cast("string").alias(free))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = []
            for raw in _rows(batch.column(batch.num_columns - 1)):
                here = _found(raw)
                place = points(raw, [x for s, _, e in here for x in (s, e)])
                found.append([{"kind": KINDS[k], "start": place[s], "end": place[e]} for s, k, e in here])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, into])
        give_back()

    return rows.mapInArrow(search, schema)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every piece of personal data replaced by its kind in brackets, such as ``[EMAIL]``.

    Spans that overlap are replaced as one, by the kind that begins first. All columns
    and rows stay, whatever their names; a null text stays null and an empty one empty.
    """
    at = docs.columns.index(text)

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, out = batch.column(at), []
            for raw, known in zip(_rows(column), column.is_valid().to_pylist(), strict=True):
                parts, before = [], 0
                for start, kind, end in _found(raw):
                    if start >= before:
                        parts += (raw[before:start], b"[%s]" % KINDS[kind].upper().encode())
                    before = max(before, end)
                out.append(b"".join([*parts, raw[before:]]) if known else None)
            columns = batch.columns
            columns[at] = pa.array(out, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        give_back()

    return docs.mapInArrow(replace, docs.schema)


def _joined(found: Column) -> Column:
    part = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(found, part), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, the digest of the base spans, and all spans as text.

    Edge cases are those of ``personal_spans``; without base spans the digest is that of
    the empty string.
    """
    found = personal_spans(docs)
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    counts = [_count(kind).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
