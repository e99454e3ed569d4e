"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over the whole text and finds anchors: at-signs, address schemes, and cues of
identifiers (two digits of a number that belong together, a plus before a digit, words such as ``IBAN``). From each anchor a small
deterministic parser looks to the left and right for the boundaries of the e-mail address, network address, number or
account, and validates what it has found. Parsers look at every character at most a few times, whatever the text.
"""

from __future__ import annotations

import functools
import ipaddress
import re
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, tidy

#: Kinds of the base rules, in the order of spans that start together; then the kinds that the method adds.
KINDS = ("email", "ip", "card", "phone")
MAILBOX, ADDRESS, ACCOUNT = ADDED = ("mailbox", "address", "account")
ORDER = {kind: i for i, kind in enumerate((*KINDS, *ADDED))}

DIGITS = "0123456789"
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_DIALLED = re.compile(r"[\x20().0-9-]*+")

# What the method adds to the base rules.
_WIDE_DOMAIN = re.compile(r"[^\W_](?:[\w-]*+)(?:\.[^\W_][\w-]*+)++")
_AUTHORITY = re.compile(r"[^\s/?#<>\"'\\]++")
_HOST = re.compile(r"(?:[^\W_][\w-]*\.)+[^\W_][\w-]*|[0-9a-fA-F:.]*")
_SCHEMES = ("http", "https", "ftp", "ftps", "sftp", "ssh", "imap", "smtp", "ldap", "postgres", "postgresql", "mysql", "mongodb", "redis", "amqp")
_CALLS = ("tel:", "sms:", "callto:")
#: Words before an account's number.
CUES = ("iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte", "passport", "ssn")
_FILLER = re.compile(r"(?:\x20?(?:number|num|no|nr|n°|id)\b\.?)?\x20?[:=#]?\x20?", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"[A-Z]{0,3}[0-9](?:[\x20-]?[0-9]){5,19}(?![A-Za-z0-9])")


@functools.cache
def anchors() -> ahocorasick.Automaton:
    """The automaton of all anchors; an anchor's value is its parser and its length."""
    found = ahocorasick.Automaton()
    add = lambda word, kind: found.add_word(word, (kind, len(word)))
    add("@", "email")
    add("://", ADDRESS)
    for word in _CALLS:
        add(word, "call")
    for a, b in product(DIGITS, DIGITS):
        add(f"{a}.{b}", "ip")
        for between in ("", " ", "-"):
            add(f"{a}{between}{b}", "card")
    for a in DIGITS:
        add(f"+{a}", "phone")
    for cue in CUES:
        for word in (cue, cue.upper(), cue.capitalize()):
            add(word, ACCOUNT)
    found.make_automaton()
    return found


def run_before(text: str, lo: int, hi: int, chars: str) -> int:
    """Where the run of ``chars`` that ends at ``hi`` begins, not before ``lo``."""
    return lo + len(text[lo:hi].rstrip(chars))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def iban(code: str) -> bool:
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _dotted_quads(text: str, start: int, end: int):
    """Four parts at a time of a dotted number; a quad with a part above 255 is passed over as a whole."""
    edges, at = [], start
    for part in text[start:end].split("."):
        edges.append((at, at + len(part)))
        at += len(part) + 1
    for k in range(0, len(edges) - 3, 4):
        parts = [text[a:z].lstrip("0") for a, z in edges[k:k + 4]]
        if all(len(p) < 3 or (len(p) == 3 and int(p) <= 255) for p in parts):
            yield edges[k][0], edges[k + 3][1]


def _mailbox(text: str, lo: int, at: int) -> tuple[int, int] | None:
    """A mailbox around the at-sign with letters of any alphabet, or with a quoted local part."""
    right = _WIDE_DOMAIN.match(text, at + 1)
    if not right:
        return None
    labels = right[0].split(".")
    if any(len(x) > 63 or x[-1] == "-" or "_" in x for x in labels) or len(labels[-1]) < 2 or not labels[-1].isalpha():
        return None
    begin = at
    if begin > lo and text[begin - 1] == '"':
        begin = text.rfind('"', max(lo, at - 66), at - 1)
        return (begin, right.end()) if 0 <= begin < at - 2 and "\n" not in text[begin:at] else None
    while begin > lo and at - begin <= 64 and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-"):
        begin -= 1
    local = text[begin:at]
    begin += len(local) - len(local.lstrip("."))
    local = text[begin:at]
    if not local or len(local) > 64 or local[-1] == "." or ".." in local:
        return None
    return begin, right.end()


def _network_address(text: str, at: int) -> tuple[int, int] | None:
    """A scheme's address that names a user, or a bare IPv6 host."""
    begin = at
    while begin > 0 and at - begin < 12 and text[begin - 1].isascii() and text[begin - 1].isalpha():
        begin -= 1
    right = _AUTHORITY.match(text, at + 3)
    if text[begin:at].lower() not in _SCHEMES or not right:
        return None
    user, sign, host = right[0].rpartition("@")
    if host.startswith("["):
        inner, closed, port = host[1:].partition("]")
        try:
            ipaddress.IPv6Address(inner)
        except ValueError:
            return None
        if not closed or (sign and not user):
            return None
        end = right.end() - len(port)
        return begin, end
    if not user or user.startswith(":"):
        return None
    host = host.partition(":")[0].rstrip(".,;)")
    if not host or not _HOST.fullmatch(host) or "." not in host:
        return None
    return begin, right.start() + len(user) + 1 + len(host)


def _account(text: str, cue: int, end: int) -> tuple[int, int] | None:
    """The identifier behind a cue: an IBAN by its check digits, a social security number, or 6 to 20 digits."""
    if cue > 0 and text[cue - 1].isalnum() or end < len(text) and text[end].isalnum():
        return None
    at = _FILLER.match(text, end).end()
    if at == end:
        return None
    if text[cue:end].lower() == "iban":
        m = _IBAN.match(text, at)
        code = m[0] if m else ""
        while code and not iban(code.replace(" ", "")):  # words in capitals may follow
            code = code.rpartition(" ")[0]
        return (at, at + len(code)) if code else None
    if text[cue:end].lower() == "ssn":
        m = _SSN.match(text, at)
        return m.span() if m and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000" else None
    m = _ACCOUNT.match(text, at)
    return m.span() if m else None


def personal_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all spans of a text, sorted; positions are code points."""
    out: list[tuple[int, int, int]] = []
    added: list[tuple[int, int, int]] = []
    done_mail = done_ip = done_card = after_at = 0
    for last, (what, size) in anchors().iter(text):
        start = last - size + 1
        if what == "card":
            # the first two digits of a number that goes on as far as it can; anchors inside it are passed over
            if start >= done_card:
                done_card = _NUMBER.match(text, start).end()
                if done_card - start >= 12:
                    digits = text[start:done_card].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((start, ORDER["card"], done_card))
        elif what == "ip":
            if start >= done_ip:
                begin = run_before(text, done_ip, start + 1, DIGITS)
                done_ip = _DOTTED.match(text, begin).end()
                out += [(a, ORDER["ip"], z) for a, z in _dotted_quads(text, begin, done_ip)]
        elif what == "phone":
            end = _DIALLED.match(text, start + 2).end()
            end = start + 2 + len(text[start + 2:end].rstrip(" ().-"))
            if end >= start + 4 and 9 <= sum(map(text.count, DIGITS, [start] * 10, [end] * 10)) <= 15:
                out.append((start, ORDER["phone"], end))
        elif what == "email":
            lo = max(done_mail, after_at)
            begin, right = run_before(text, lo, start, _LOCAL), _DOMAIN.match(text, start + 1)
            if begin < start and right:
                done_mail = right.end()
                out.append((begin, ORDER["email"], done_mail))
            if found := _mailbox(text, after_at, start):
                added.append((found[0], ORDER[MAILBOX], found[1]))
            after_at = start + 1
        elif what == ADDRESS:
            if found := _network_address(text, start):
                added.append((found[0], ORDER[ADDRESS], found[1]))
        elif what == "call":
            run = _DIALLED.match(text, last + 1)
            number = run[0].rstrip(" ().-")
            if number[:1].isdigit() and 7 <= sum(map(number.count, DIGITS)) <= 15:
                added.append((last + 1, ORDER[ADDRESS], last + 1 + len(number)))
        elif found := _account(text, start, last + 1):
            added.append((found[0], ORDER[ACCOUNT], found[1]))
    covered = sorted({(a, z) for a, _, z in out})
    first = np.array([a for a, _ in covered], np.int64)
    reach = np.maximum.accumulate(np.array([z for _, z in covered], np.int64)) if covered else first
    for span in set(added):  # a span inside a base span says nothing new
        k = int(np.searchsorted(first, span[0], "right")) - 1
        if k < 0 or reach[k] < span[2]:
            out.append(span)
    return sorted(out)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("value", T.StringType())])


@F.arrow_udf(T.ArrayType(SPAN))
def _spans(texts: pa.Array) -> pa.Array:
    tidy()
    names, ends = (*KINDS, *ADDED), [0]
    kind, start, end, value = [], [], [], []
    for text in texts:
        text = text.as_py() or ""
        for a, k, z in personal_spans(text):
            kind.append(names[k])
            start.append(a)
            end.append(z)
            value.append(text[a:z])
        ends.append(len(kind))
    flat = pa.StructArray.from_arrays([pa.array(kind, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                                       pa.array(value, pa.string())], names=SPAN.names)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def spans_of(text: Column | str) -> Column:
    """Column function: the personal data of a text as an array of struct(kind, start, end, value), by start, then kind.

    ``email``, ``ip``, ``card`` and ``phone`` are the matches of the base rules, leftmost and non-overlapping for each kind, those
    that fail their check dropped. The method adds ``mailbox`` (letters of any alphabet, quoted local parts), ``address``
    (a scheme's address with a user, an IPv6 host, a number to dial) and ``account`` (a checked IBAN, a social security
    number, or digits behind a cue) where no base span covers them. A null text is empty.
    """
    return _spans((F.col(text) if isinstance(text, str) else text).cast("string"))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id and ``personal``, its spans (see :func:`spans_of`).

    Rows are judged one by one: repeated and null ids give rows each; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col), spans_of(text_col).alias("personal"))


@F.arrow_udf(T.StringType())
def _masked(texts: pa.Array) -> pa.Array:
    tidy()
    names, out = (*KINDS, *ADDED), []
    for text in texts.to_pylist():
        parts, at = [], 0
        for a, k, z in personal_spans(text or ""):
            if a >= at:
                parts += [text[at:a], f"<{names[k]}>"]
            at = max(at, z)
        out.append(None if text is None else "".join(parts) + text[at:])
    return pa.array(out, pa.string())


def mask_personal(text: Column | str) -> Column:
    """Column function: the text with every span replaced by its kind in angle brackets (overlapping spans: the first's; null: null)."""
    return _masked((F.col(text) if isinstance(text, str) else text).cast("string"))
