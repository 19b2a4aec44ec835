"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Base spans (e-mail, IP address, card, international phone) follow fixed patterns and checks, leftmost and non-overlapping
for each kind; a match that fails its check is dropped without a retry.  Each kind is found in time linear in the text,
whatever it holds: a run of characters is looked at once, not once for each place where a match could start.

Further spans are proposals with a score, and are kept from ``threshold`` on:

* ``iban``: two letters, two digits and as many characters as the country has; confirmed by the remainder modulo 97.
* ``ssn``: ddd-dd-dddd with an area, group and serial that are given out.
* ``card`` and ``phone``: well-formed numbers that a base match had swallowed together with the number beside them, and
  phone numbers without a country code.

A proposal's score is its kind's weight, plus what its checksum adds, plus ``CONTEXT`` if one of the kind's words stands
within ``reach`` code points on either side, minus as much if a word that speaks against it does.  Base spans are scored
alike but stay whatever their score.  A proposal inside a base span is not repeated; of proposals that overlap, the
better one (then the longer, then the first) stays.

Map only: nothing is shuffled or gathered.  A text is handled whole by one task, so memory follows the longest text.
Null and empty texts have no spans; rows that repeat a doc_id, or are equal, are judged each on its own; a null doc_id is
passed on.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C

# --- fixed by the contract ---------------------------------------------------------------------------------------------
BASE = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# digits are taken whole: none of the patterns can match by giving one back, so a run is tried at its start only
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# -----------------------------------------------------------------------------------------------------------------------

KINDS = (*BASE, "iban", "ssn")
_ORDER = {k: i for i, k in enumerate(KINDS)}

# Characters of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21,
    "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "VA": 22, "XK": 20,
}

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9A-Za-z-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9A-Za-z-])")
CARD_RUN = re.compile(r"(?<![0-9])(?:[0-9]{13,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])")
PHONE_FORM = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])")
PHONE_LOCAL = re.compile(r"(?<![0-9A-Za-z+().-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-]|\.[0-9])")

#: Scores: the weight of a kind's pattern, what a checksum adds, what words near it add or take.
WEIGHT = {"email": 0.8, "ip": 0.4, "card": 0.1, "phone": 0.5, "iban": 0.2, "ssn": 0.3, "card_run": 0.2, "phone_local": 0.3}
CHECKSUM = 0.5
CONTEXT = 0.3
THRESHOLD = 0.5
REACH = 40

#: Words that speak for a kind, and words that speak against it.
FOR = {
    "email": {"email", "mail", "contact", "write", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "login", "adresse"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "tarjeta", "carte", "karte", "kreditkarte"},
    "phone": {"phone", "call", "tel", "telephone", "mobile", "cell", "fax", "whatsapp", "telefon", "teléfono", "téléphone", "handy", "móvil"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "cuenta", "compte"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
}
AGAINST = {
    "ip": {"version", "release", "section"},
    "card": {"order", "invoice", "tracking", "serial", "isbn", "part"},
    "phone": {"order", "invoice", "tracking", "serial", "isbn", "part"},
    "ssn": {"order", "invoice", "tracking", "serial", "isbn", "part"},
}

SPANS = "spans array<struct<kind:string,start:long,end:long,score:double,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
_WORDS = re.compile(r"[^\W\d_]+")
_NO_DIGITS = {i: None for i in map(ord, " -().+")}
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += _DOUBLED[ord(c) - 48] if i & 1 else ord(c) - 48
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the compact form's checksum holds: first four characters moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, one step for each @: its local part reaches back to a character that can't be
    in one, to the @ before it or to the match before it."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        low = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            low = m.end()
        at = text.find("@", low)
    return out


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans, and the card and phone matches that fail their check."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    failed = []
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].translate(_NO_DIGITS)
            if len(digits) >= 12:
                (found if len(digits) <= 19 and luhn(digits) else failed).append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = len(m[0].translate(_NO_DIGITS))
            (found if 9 <= digits <= 15 else failed).append(("phone", m.start(), m.end()))
    return found, failed


def proposals(text: str, failed: list[tuple[str, int, int]]):
    """(kind, start, end, weight with what the checksum adds) of everything that further patterns propose."""
    for kind, start, end in failed:
        if kind == "card":
            for m in CARD_RUN.finditer(text, start, end):
                if luhn(m[0].translate(_NO_DIGITS)):
                    yield "card", m.start(), m.end(), WEIGHT["card_run"] + CHECKSUM
        elif (m := PHONE_FORM.match(text, start, min(end, start + 24))) and 9 <= len(m[0].translate(_NO_DIGITS)) <= 15:
            yield "phone", m.start(), m.end(), WEIGHT["phone"]
    for m in IBAN.finditer(text):
        size = IBAN_LENGTH.get(m[0][:2])
        if size:
            at, taken = m.start(), 0
            while taken < size and at < m.end():
                taken += text[at] not in " -"
                at += 1
            whole = text[m.start():at].translate(_NO_DIGITS)
            if taken == size and not text[at:at + 1].isalnum() and mod97(whole):
                yield "iban", m.start(), at, WEIGHT["iban"] + CHECKSUM
    for m in SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", m.start(), m.end(), WEIGHT["ssn"]
    for m in PHONE_LOCAL.finditer(text):
        if 9 <= len(m[0].translate(_NO_DIGITS)) <= 11:
            yield "phone", m.start(), m.end(), WEIGHT["phone_local"]


def context(text: str, kind: str, start: int, end: int, reach: int) -> float:
    """What the words near a span add to its score or take from it."""
    words = {w.lower() for piece in (text[max(0, start - reach):start], text[end:end + reach]) for w in _WORDS.findall(piece)}
    return CONTEXT * (not words.isdisjoint(FOR[kind])) - CONTEXT * (not words.isdisjoint(AGAINST.get(kind, ())))


def find_spans(text: str, threshold: float = THRESHOLD, reach: int = REACH) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) of all spans of a text, by start, then kind as listed, then end."""
    found, failed = base_spans(text)
    out = []
    for kind, start, end in found:
        score = WEIGHT[kind] + CHECKSUM * (kind == "card") + context(text, kind, start, end, reach)
        out.append((kind, start, end, score, True))
    # the base spans' furthest end up to each start tells in one look-up whether one of them covers a proposal
    covers = sorted((s, e) for _, s, e in found)
    starts, far, furthest = [s for s, _ in covers], [], 0
    for _, e in covers:
        furthest = max(furthest, e)
        far.append(furthest)
    more = []
    for kind, start, end, weight in proposals(text, failed):
        i = bisect_right(starts, start)
        score = weight + context(text, kind, start, end, reach)
        if score >= threshold and not (i and far[i - 1] >= end):
            more.append((kind, start, end, score, False))
    # of those that overlap the best stays; taken spans are kept in order, so a look-up of the neighbours is enough
    taken: list[tuple[int, int]] = []
    for x in sorted(more, key=lambda x: (-x[3], x[1] - x[2], x[1], _ORDER[x[0]])):
        i = bisect_right(taken, (x[1], x[2]))
        if (i == 0 or taken[i - 1][1] <= x[1]) and (i == len(taken) or taken[i][0] >= x[2]):
            taken.insert(i, (x[1], x[2]))
            out.append(x)
    return sorted(((k, s, e, round(min(max(v, 0.0), 1.0), 6), b) for k, s, e, v, b in out), key=lambda x: (x[1], _ORDER[x[0]], x[2]))


def redacted(text: str, spans: list) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are one, named by the first."""
    out, at = [], 0
    for kind, start, end, *_ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, carry: list[str] | None = None, text: bool = False, threshold: float = THRESHOLD, reach: int = REACH) -> DataFrame:
    """Every document with its ``spans`` and, if ``text``, its ``redacted`` text; ``carry`` names input columns to pass on (doc_id)."""
    def work():
        def f(texts):
            whole = [t or "" for t in texts.to_pylist()]
            spans = [find_spans(t, threshold, reach) for t in whole]
            made = [pa.array([[dict(zip(("kind", "start", "end", "score", "base"), x, strict=True)) for x in s] for s in spans], _ARROW)]
            return made + [pa.array([redacted(t, s) for t, s in zip(whole, spans, strict=True)], pa.string())] * text
        return f

    return C.map_texts(docs, SPANS + ", redacted string" * text, work, ["doc_id"] if carry is None else carry)


def joined(spans: Column) -> Column:
    """kind:start:end of spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Base spans counted by kind, a digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))
