"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier judges spans.

Candidates are the strict matches (the base, which always stays), matches of the strict forms that
fail their check, and looser forms: addresses with "at" and "dot" spelled out, phone numbers without
a country code or run together with other numbers, card numbers and IP addresses with other
separators. On each candidate regex, gazetteer, checksum, context and shape labelers vote for,
against or not at all. Expectation-maximisation over the counts of all vote patterns of the corpus
estimates how reliable each labeler is, without labelled data; a logistic regression on the votes
and on features of the span is trained with the resulting chances. Loose candidates that it trusts
and that overlap no base span are added.

Counts cover all documents. What reaches the driver is one row per pattern of votes and features:
at most 4 kinds x 3**5 votes x 12 features, whatever the size of the corpus.

Null text counts as empty: no spans. Repeated rows each give their row, and each counts. Only doc_id
and text are used, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remanente.llm.common import over_texts, texts, written

KINDS = ("email", "ip", "card", "phone")
#: Least chance at which a loose candidate is added.
TRUST = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")

_AT = r"(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)"
#: Stands in every match of _AT, so a text without it has no spelled-out address.
_AT_WORD = re.compile(r"(?i)[\s\[({]at[\s\])}]")
_DOT = r"(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.)"
_SPELLED = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}"
    rf"(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}"
)
_FULL_PHONE = re.compile(
    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
)
_LOCAL_PHONE = re.compile(
    r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
)
_SOLID_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])")
_SPACED_CARD = re.compile(
    r"(?<![0-9])[0-9]{4}([ ./_-]|  )[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"
)
_SPACED_IP = re.compile(
    r"(?i)(?<![0-9.])[0-9]{1,3}(?:\s?[\[({]\s?(?:\.|dot)\s?[\])}]\s?[0-9]{1,3}){3}(?![0-9])"
)

#: Words that stand before personal data, words that stand before other numbers,
#: top-level domains, and first digits of card issuers.
CUES = {
    "email": ("email", "e-mail", "mail", "contact", "write", "reach", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr", "login", "from"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "whatsapp"),
}
OTHERS = ("version", "isbn", "order", "invoice", "price", "total", "page", "section", "no.", "id")
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
ISSUERS = "3456"

N_VOTES = 5


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(span: str) -> str:
    return "".join([c for c in span if "0" <= c <= "9"])


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each @ is tried once, from the start of the run of letters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict matches, by kind as listed, then start."""
    return [(k, a, b) for k, a, b, passed in checked_spans(text) if passed]


def checked_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether it passes) of the matches of the strict forms."""
    out = [(0, *span, True) for span in base_emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        out.append((1, *m.span(), all(len(p) <= 3 and int(p) <= 255 for p in parts)))
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if len(digits) >= 13:
            out.append((2, *m.span(), len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in _PHONE.finditer(text):
            out.append((3, *m.span(), 9 <= len(digits_of(m.group())) <= 15))
    return out


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the looser forms; of one kind, those with more evidence come first."""
    out = []
    if _AT_WORD.search(text):
        out += [(0, *m.span()) for m in _SPELLED.finditer(text)]
    if not _DIGIT.search(text):
        return out
    for kind, form in (
        (1, _SPACED_IP),
        (2, _SOLID_CARD),
        (2, _SPACED_CARD),
        (3, _FULL_PHONE),
        (3, _LOCAL_PHONE),
    ):
        out += [(kind, *m.span()) for m in form.finditer(text)]
    return out


def code(text: str, kind: int, start: int, end: int, strict: bool) -> int:
    """Votes (0 none, 1 for, 2 against) and features of a candidate, as one number.

    Votes: strict regex; format and checksum; gazetteer; context; shape. Features: length and share
    of letters that are digits, in three and two steps.
    """
    span, digits = text[start:end], digits_of(text[start:end])
    before = text[max(0, start - 32) : start].lower()
    votes = [1 if strict else 0]
    if kind == 0:
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        votes += [1 if 2 <= len(last) <= 24 and last.isalpha() else 2, 1 if last in DOMAINS else 0]
    elif kind == 1:
        parts = [int(p) for p in re.findall("[0-9]{1,9}", span)]
        votes += [1 if strict or max(parts) <= 255 else 2, 2 if parts[0] in (0, 255) else 1]
    elif kind == 2:
        fits = 13 <= len(digits) <= 19 and luhn(digits)
        votes += [1 if fits else 2, 1 if digits[0] in ISSUERS else 2]
    else:
        own = digits[-10:]
        area = len(digits) <= 13 and own[0] in "23456789"
        votes += [
            1 if strict or 10 <= len(digits) <= 13 and area else 2,
            1 if "(" in span or span[0] == "+" else 0,
        ]
    words = set(re.findall(r"[a-z.-]+", before))
    cue = any(c in words or c + ":" in before for c in CUES[KINDS[kind]])
    votes.append(1 if cue else 2 if words.intersection(OTHERS) else 0)
    edge = text[start - 1 : start] + text[end : end + 1]
    votes.append(2 if any(c.isalnum() or c in "_/=#" for c in edge) else 1)
    size = 0 if end - start < 12 else 1 if end - start < 20 else 2
    mostly = int(2 * len(digits) >= end - start)
    number = 0
    for v in votes:
        number = number * 3 + v
    return (number * 3 + size) * 2 + mostly


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: kind, start, end, base, code of all candidates of a text."""
    def rows(batch: list[str]) -> dict[str, list]:
        made = []
        for text in batch:
            spans: list[tuple[int, int, int, bool]] = []
            if _DIGIT.search(text) or "@" in text:
                spans = checked_spans(text)
            strict = [s for s in spans if s[3]]
            spans += [
                (k, a, b, False)
                for k, a, b in loose_spans(text)
                if not any(a < d and c < b for _, c, d, _ in strict)
            ]
            made.append(
                [
                    {"kind": k, "start": a, "end": b, "base": s, "code": code(text, k, a, b, s)}
                    for k, a, b, s in spans
                ]
            )
        return {"found": made}

    shape = "kind int, start long, end long, base boolean, code int"
    return over_texts(texts(docs), rows, f"found array<struct<{shape}>>")


def votes_of(codes: np.ndarray) -> np.ndarray:
    """One column of votes for each labeler."""
    number = codes // 6
    return np.stack([number // 3**k % 3 for k in range(N_VOTES - 1, -1, -1)], axis=1)


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Chance that each pattern marks personal data, by EM over counted vote patterns.

    Both classes give each labeler's votes for and against their own chances; not voting tells
    nothing. The start takes votes for as more likely in the one, votes against in the other.
    """
    yes = np.tile([1.0, 0.85, 0.15], (votes.shape[1], 1))
    no = np.tile([1.0, 0.2, 0.8], (votes.shape[1], 1))
    prior, column = 0.5, np.arange(votes.shape[1])
    chance = np.full(len(counts), 0.5)
    for _ in range(rounds):
        a = np.log(prior) + np.log(yes[column, votes]).sum(axis=1)
        b = np.log(1 - prior) + np.log(no[column, votes]).sum(axis=1)
        chance = 1 / (1 + np.exp(np.clip(b - a, -50, 50)))
        for table, weight in ((yes, chance * counts), (no, (1 - chance) * counts)):
            for v in (1, 2):
                table[:, v] = (weight[:, None] * (votes == v)).sum(axis=0) + 1.0
            table[:, 1:] /= table[:, 1:].sum(axis=1, keepdims=True)
        prior = float(np.clip((chance * counts).sum() / counts.sum(), 0.01, 0.99))
    return chance


def inputs(kinds: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One column for each kind, vote for and against, and feature."""
    votes = votes_of(codes)
    parts = [kinds[:, None] == np.arange(len(KINDS)), votes == 1, votes == 2]
    parts += [(codes // 2 % 3)[:, None] == np.arange(3), (codes % 2)[:, None] == 1]
    return np.concatenate(parts, axis=1).astype(float)


def train(patterns: list[tuple[int, int, int]]) -> np.ndarray:
    """Weights of the span classifier, from (kind, code, count) rows."""
    if not patterns:
        return np.zeros(0)
    kinds, codes, counts = (np.array(x) for x in zip(*sorted(patterns), strict=True))
    votes, chance = votes_of(codes), np.zeros(len(codes))
    for kind in np.unique(kinds):
        own = kinds == kind
        chance[own] = reliabilities(votes[own], counts[own].astype(float))
    x, weight = inputs(kinds, codes), np.log1p(counts)
    weight = weight / weight.sum()
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (weight * (p - chance)) + 1e-4 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        move = np.linalg.solve(curve, gradient)
        w -= move / max(1.0, np.abs(move).max())
    return w


def fit(found: DataFrame) -> np.ndarray:
    """The classifier from the counts of all patterns."""
    each = found.select(F.explode("found").alias("x")).groupBy("x.kind", "x.code").count()
    return train([(r["kind"], r["code"], r["count"]) for r in each.collect()])


def accepted(spans: list[dict], weights: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """Base spans, and trusted loose ones that do not overlap each other."""
    out = [(s["kind"], s["start"], s["end"], True) for s in spans if s["base"]]
    loose = [s for s in spans if not s["base"]]
    if loose and len(weights):
        kinds, codes = (np.array([s[c] for s in loose]) for c in ("kind", "code"))
        chance = 1 / (1 + np.exp(-inputs(kinds, codes) @ weights))
        for s, p in zip(loose, chance, strict=True):
            passed = s["code"] // 6 // 3 ** (N_VOTES - 2) % 3 != 2  # the checksum has a veto
            if p >= TRUST and passed and not any(s["start"] < e and b < s["end"] for _, b, e, _ in out):
                out.append((s["kind"], s["start"], s["end"], False))
    return sorted(out)


def shown(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, *_ in spans)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans by kind, base_sha256, spans, n_added."""
    found = written(candidates(docs), "candidates")
    shared = docs.sparkSession.sparkContext.broadcast(fit(found))

    def rows(batch: list[list[dict]]) -> dict[str, list]:
        out: dict[str, list] = {f"n_{kind}": [] for kind in KINDS}
        out |= {"base_sha256": [], "spans": [], "n_added": []}
        for spans in batch:
            every = accepted(spans or [], shared.value)
            base = [s for s in every if s[3]]
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(s[0] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(shown(base).encode()).hexdigest())
            out["spans"].append(shown(every))
            out["n_added"].append(len(every) - len(base))
        return out

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return over_texts(found, rows, f"{counts}, base_sha256 string, spans string, n_added long", "found")
