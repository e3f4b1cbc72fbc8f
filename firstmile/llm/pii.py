"""Personal data: patterns propose spans, validators confirm them, context words adjust the score.

Each kind has a pattern, a validator and a starting score; the words around a
span raise or lower it. Base kinds that validate always stay. The further kinds
(iban, ssn, secret) count only if their score reaches the threshold.

NULL text counts as empty, and has no spans. Spans are in code points, end
exclusive. Rows are handled one by one: equal rows give equal results, other
columns pass through untouched, texts of any length are read whole. Patterns run
in time linear in the text: no start is tried inside a run that already failed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstmile.llm.columns import map_rows, slices, values

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn", "secret")
KINDS = BASE + EXTRA
ORDER = {kind: i for i, kind in enumerate(KINDS)}
THRESHOLD = 0.5
REACH = 40

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A later start in the same run of digits fails as its first one does, so only first ones are tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|(?:ghp_|sk-|AKIA|xox[bp]-)[A-Za-z0-9_-]{16,80})(?![A-Za-z0-9])")

# Words near a span that speak for a kind, or against it.
FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "key", "password", "api", "bearer"),
}
AGAINST = {
    "ip": ("version", "release"),
    "card": ("order", "isbn", "serial"),
    "phone": ("isbn",),
    "ssn": ("part", "item", "serial"),
    "secret": ("sha", "commit", "checksum", "md5"),
}
START = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "secret": 0.3}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ outwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _part_small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)]
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(_part_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() <= 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def _score(text: str, start: int, end: int, kind: str) -> float:
    near = set(re.findall(r"[a-z]+", f"{text[max(0, start - REACH) : start]} {text[end : end + REACH]}".lower()))
    score = START[kind]
    score += 0.3 * bool(near & set(FOR.get(kind, ()))) - 0.3 * bool(near & set(AGAINST.get(kind, ())))
    return round(min(1.0, max(0.0, score)), 2)


def extra_spans(text: str) -> Iterator[tuple[int, int, str]]:
    """The longest prefix of each IBAN proposal that passes mod 97, US social security numbers, secrets.

    Proposals may overlap: a code before an IBAN does not hide it.
    """
    at, done = 0, 0
    while m := IBAN.search(text, at):
        for end in range(m.end(), max(m.start() + 14, done), -1):
            code = text[m.start() : end].replace(" ", "")
            if text[end - 1] != " " and 15 <= len(code) <= 34 and not text[end : end + 1].isalnum() and mod97(code):
                yield m.start(), end, "iban"
                done = end
                break
        at = m.start() + 1
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
            yield m.start(), m.end(), "ssn"
    yield from ((m.start(), m.end(), "secret") for m in SECRET.finditer(text))


def spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind: every base span, and the further ones above the threshold that none covers."""
    found = [(a, b, k, _score(text, a, b, k)) for a, b, k in base_spans(text)]
    taken = [(a, b) for a, b, _, _ in found]
    for a, b, kind in extra_spans(text):
        score = _score(text, a, b, kind)
        if score >= THRESHOLD and not any(x <= a and b <= y for x, y in taken):
            found.append((a, b, kind, score))
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]], s[1]))


def redact_text(text: str) -> str:
    """text with every span, overlapping ones merged, replaced by <kind> of the span that starts first."""
    parts, done = [], 0
    for a, b, kind, _ in spans(text):
        if a >= done:
            parts += [text[done:a], f"<{kind}>"]
            done = b
        else:
            done = max(done, b)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data in `text` replaced by its kind; NULL stays NULL. n_chars, if there, follows the text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            at = batch.schema.get_field_index("text")
            new = pa.array([None if t is None else redact_text(t) for t in values(batch, "text")], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), new)

    out = map_rows(docs, run)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def listed(found: list[tuple[int, int, str, float]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in found)


DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>"


def digest(docs: DataFrame) -> DataFrame:
    """One row a document: counts, hash of the base spans, all spans and their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            found = [spans(t or "") for t in values(batch, "text")]
            base = [[s for s in f if s[2] in BASE] for f in found]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())}
                | {f"n_{k}": pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in BASE}
                | {"base_sha256": pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string())}
                | {"spans": pa.array([listed(f) for f in found], pa.string()), "scores": pa.array([[s[3] for s in f] for f in found], pa.list_(pa.float64()))}
            )

    return docs.select("doc_id", "text").mapInArrow(run, DIGEST)
