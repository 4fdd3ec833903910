"""Personal data and secrets: patterns propose spans, validators confirm them, context words adjust the score."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import batch_of, per_slice

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "key", "secret")
BASE = KINDS[:4]
THRESHOLD = 0.6
NEAR = 48  # characters of context on either side

# The patterns of the base kinds. Look-behinds and possessive repeats keep them linear on long runs
# without changing what they match: a run that fails at its start fails from each later start in it.
LOCAL = "A-Za-z0-9._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Kinds the method adds, with the score of the pattern, of a passed check sum, and words that speak for it.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
# Keys whose issuers publish their form, and private key blocks; any other secret is a run of random characters.
KEY = re.compile(r"(?<![A-Za-z0-9_])(?:A[KS]IA[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{20,}+|sk_(?:live|test)_[A-Za-z0-9]{24,}+"
                 r"|eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{20,}+)(?![A-Za-z0-9_])|-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
CONTEXT = {
    "email": ("mail", "contact", "write", "correo"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "key": ("key", "token", "secret", "private", "credential"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "passphrase", "key", "apikey", "credential", "credentials", "bearer", "auth"),
}
PATTERN_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.4, "key": 0.7, "secret": 0.1}
# What a passed check adds: a check sum says much, randomness alone little, since digests are random as well.
CHECKED = {"card": 0.5, "iban": 0.5, "secret": 0.3}
CONTEXT_WORD = 0.3
HEX = frozenset("0123456789abcdefABCDEF")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def entropy(run: str) -> float:
    """Bits a character."""
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values())


def random_run(run: str) -> bool:
    """Whether a run looks drawn at random: 32 and more hexadecimal digits of over 3 bits (4 at most), or characters of all of
    upper case, lower case and digits of over 3.5 bits (a word or a path of words lacks one of these)."""
    body = run.rstrip("=")
    digit, upper, lower = any("0" <= c <= "9" for c in body), any("A" <= c <= "Z" for c in body), any("a" <= c <= "z" for c in body)
    if HEX.issuperset(body):
        return len(body) >= 32 and digit and (upper or lower) and entropy(body) > 3
    return digit and upper and lower and entropy(body) > 3.5


def emails(text: str):
    """Leftmost matches, found from each @: the local part is the run of allowed characters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SET:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def proposals(text: str):
    """(kind, start, end, check passed or not, None where the kind has none)."""
    for start, end in emails(text):
        yield "email", start, end, None
    digits = re.search("[0-9]", text)
    if digits:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                yield "ip", m.start(), m.end(), None
        for m in CARD.finditer(text):
            number = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(number) <= 19:
                yield "card", m.start(), m.end(), luhn(number)
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    yield "phone", m.start(), m.end(), None
        for m in IBAN.finditer(text):
            yield "iban", m.start(), m.end(), mod97(m[0])
        if "-" in text:
            for m in SSN.finditer(text):
                yield "ssn", m.start(), m.end(), None
        for m in RUN.finditer(text):
            yield "secret", m.start(), m.end(), random_run(m[0])
    for m in KEY.finditer(text):
        yield "key", m.start(), m.end(), None


def context_words(text: str, kind: str, start: int, end: int) -> bool:
    near = set(re.findall(r"[a-z]+", (text[max(0, start - NEAR):start] + " " + text[end:end + NEAR]).lower()))
    return any(w in near for w in CONTEXT[kind])


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Accepted spans (kind, start, end, score) in order of kind and start; code points, end exclusive.

    Base kinds are accepted when their own checks pass, whatever the score; the others need THRESHOLD: an
    IBAN needs its check sum, an SSN-like number a context word nearby, a published form of key nothing more, any other
    secret must look random and have a context word nearby. A secret that is a key's text is told as the key only.
    """
    out = []
    for kind, start, end, checked in proposals(text or ""):
        if checked is False:
            continue
        score = PATTERN_SCORE[kind] + CHECKED.get(kind, 0.0) * bool(checked) + CONTEXT_WORD * context_words(text, kind, start, end)
        if kind in BASE or score >= THRESHOLD:
            out.append((kind, start, end, min(1.0, score)))
    keys = [s for s in out if s[0] == "key"]
    if keys:
        out = [s for s in out if s[0] != "secret" or not any(s[1] < k[2] and k[1] < s[2] for k in keys)]
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, score) per document; a null or empty text has none. Every row is judged by
    itself: repeated rows give repeated results, an empty table none, and very long texts take time in proportion."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(kind))])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans(t)]
                 for t in part.column("text").to_pylist()]
        return batch_of(arrow, part.column("doc_id"), pa.array(found, pa.list_(kind)))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(per_slice(run), "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"))


def redacted(text: str | None) -> str | None:
    """The text with each maximal run of overlapping spans replaced by ``<KIND>`` of its first span."""
    found = sorted((s, e, k) for k, s, e, _ in spans(text))
    if not found:
        return text
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all rows and columns stay."""
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        at = part.schema.get_field_index("text")
        text = pa.array([redacted(t) for t in part.column(at).to_pylist()], pa.string())
        return part.set_column(at, part.schema.field(at).with_type(pa.string()), text)

    return docs.mapInArrow(per_slice(run), docs.schema)
