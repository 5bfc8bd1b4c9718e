"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Base kinds (always kept once valid): email, ip (parts at most 255), card (12 to 19
digits, Luhn) and phone (9 to 15 digits).  Further kinds are kept from a score of
``KEEP`` on: iban (as long as its country's are, mod-97), ssn (format, then context
decides).  Context words are those of English, German, French and Spanish, and are taken
whole where the window cuts them.

Rules for odd input: a null or empty text has no spans; offsets count code points;
a match of a base kind that fails its check is dropped and not tried again from a later
start; texts and runs of digits of any length are searched whole; spans of equal start
stand in the order of the kinds; repeated rows and null ids each get their own result;
an empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .workspace import bounded_batches

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2})[0-9]{2}\x20?[A-Z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.35}
# Length of an IBAN by country, as the public registry of ISO 13616 lists them.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18,
    "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23,
    "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
_iban = {n: re.compile(rf"[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(IBAN_LENGTH.values())}

#: Words that speak for a kind, in the four languages.
CONTEXT = {
    "email": "mail email contact write kontakt schreiben adresse courriel contacter correo contacto escribir".split(),
    "ip": "ip address server host adresse rechner serveur hôte dirección servidor".split(),
    "card": "card visa credit payment karte kreditkarte zahlung kartennummer carte crédit paiement bancaire tarjeta crédito pago".split(),
    "phone": "phone call tel mobile fax telefon anruf handy rufnummer téléphone appeler portable teléfono llamar móvil".split(),
    "iban": "iban account bank konto kontonummer bankverbindung compte banque cuenta banco".split(),
    "ssn": "ssn social security sozialversicherungsnummer sozialversicherung sécurité sociale seguridad seguro".split(),
}
AGAINST = {
    "ip": "version release versión".split(),
    "card": "order serial isbn bestellung seriennummer commande série pedido serie".split(),
    "ssn": "part model order teil modell bestellung pièce modèle commande pieza modelo pedido".split(),
}
WINDOW, STEP, KEEP = 40, 0.2, 0.5
WORD = re.compile(r"[^\W\d_]+")
LONGEST = max(len(w) for words in (*CONTEXT.values(), *AGAINST.values()) for w in words)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    rest = 0
    for c in moved:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest == 1


def find_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs without @ cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        if domain := DOMAIN.match(text, at + 1):
            while start > free and text[start - 1] in LOCAL:
                start -= 1
        if start < at:
            out.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(free, at + 1))
    return out


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def find(text: str) -> list[tuple[int, int, str]]:
    """All confirmed spans: start, end (exclusive), kind."""
    out = [(s, e, "email") for s, e in find_emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(map(small, m.groups())):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    free = 0
    for m in IBAN.finditer(text):
        if m.start() >= free and (n := IBAN_LENGTH.get(m[1])) and (own := _iban[n].match(text, m.start())) and mod97(own[0].replace(" ", "")):
            free = own.end()
            out.append((m.start(), free, "iban"))
    out += [(m.start(), m.end(), "ssn") for m in SSN.finditer(text)]
    return out


def around(text: str, start: int, end: int) -> set[str]:
    """Words that begin or end within ``WINDOW`` characters of a span; one that the window cuts is read on, as far as any word of context is long."""
    low, high = max(0, start - WINDOW), min(len(text), end + WINDOW)
    before = WORD.search(text[max(0, low - LONGEST) : low][::-1])
    after = WORD.match(text, high)
    if low and text[low].isalpha() and before and before.start() == 0:
        low -= before.end()
    if after and text[high - 1].isalpha():
        high = min(after.end(), high + LONGEST)
    return set(WORD.findall(f"{text[low:start]} {text[end:high]}".lower()))


def score(text: str, start: int, end: int, kind: str) -> float:
    """Prior of the kind, one step up or down for the words around it."""
    near = around(text, start, end)
    up, down = not near.isdisjoint(CONTEXT[kind]), not near.isdisjoint(AGAINST.get(kind, ()))
    return round(min(1.0, max(0.0, BASE_SCORE[kind] + STEP * (up - down))), 2)


def annotate(text: str | None) -> tuple[list[tuple[int, int, str, float]], list[tuple[int, int, str, float]]]:
    """Base spans, and all kept spans, each by start and then by kind as listed."""
    text = text or ""
    order = {k: i for i, k in enumerate(KINDS)}
    spans = [(s, e, k, score(text, s, e, k)) for s, e, k in sorted(find(text), key=lambda x: (x[0], order[x[2]]))]
    base = [x for x in spans if order[x[2]] < 4]
    return base, [x for x in spans if order[x[2]] < 4 or x[3] >= KEEP]


def joined(spans: list[tuple[int, int, str, float]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k, _ in spans)


def redact(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    """Each span becomes its kind in angle brackets; of overlapping spans the union goes, named by the first."""
    out, at = [], 0
    for s, e, k, _ in spans:
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS[:4]), ("base_sha256", pa.string()), ("spans", pa.string()), ("scores", pa.list_(pa.float64()))])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans and their scores."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)), strict=True):
                base, spans = annotate(text)
                counts = [sum(x[2] == k for x in base) for k in KINDS[:4]]
                rows.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), [x[3] for x in spans]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SCHEMA.types, strict=True)] if rows else [pa.array([], t) for t in SCHEMA.types], schema=SCHEMA)

    bounded_batches(docs.sparkSession)
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return picked.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every kept span replaced in the text (a null text stays null)."""
    at = docs.columns.index(text_col)
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = [t if t is None else redact(t, annotate(t)[1]) for t in (v.as_py() for v in batch.column(at))]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
