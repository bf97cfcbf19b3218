"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier learns from their votes.

Candidates are the matches of the base patterns, which always count, and of wider ones: numbers that fail a check, local phone
numbers, addresses written out with "at" and "dot", account and social-security numbers, secrets (runs of 20 or more letters and
digits with a word before them that calls them so, or a known beginning; others are mostly digests and identifiers). Each gets votes for, against or none from its usual form, a checksum (a secret's entropy), a gazetteer, the words around
it, its borders and its length; none of them knows which spans are base ones. The span's own features (`FEATURES`) are few-valued
too, so Spark counts patterns of votes and features over all texts, and from those counts alone (a bounded table)
the driver estimates each labeler's reliability by expectation-maximisation over the votes and trains a logistic span classifier
with votes and features on the expected labels. Spans it gives `SPAN_AT` or more are added. Texts are read twice and never shuffled.

All searches are linear in the text. Defined results: a null or empty text has no spans; repeated rows count each in the
estimates and get the same spans; without candidates only base spans are found; `redact` returns all columns as they came
but the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import learn

SPAN_AT = 0.5
CONTEXT_CHARS = 40

# Kinds in the order of results, the first four with base patterns.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "secret")
BASE_KINDS = KINDS[:4]

# Word lists of the gazetteer and the context labelers.
TOP_DOMAINS = "com org net edu gov info io de fr es uk eu it nl ch at be us ca au".split()
CUES = {
    "email": "mail email e-mail courriel correo contact contacto kontakt write",
    "ip": "ip address host server client login from adresse dirección",
    "card": "card visa mastercard credit payment carte karte tarjeta",
    "phone": "phone tel call mobile fax whatsapp téléphone telefon teléfono appel",
    "ssn": "ssn social security",
    "iban": "iban account bank konto compte cuenta",
    "secret": "token key apikey secret password passwd pwd credential credentials bearer authorization",
}
COUNTER_CUES = "version build isbn issn page chapter figure table section release order invoice part serial".split()
CARD_STARTS = ("34", "37", "36", "38", "4", "51", "52", "53", "54", "55", "6011", "65", "2131", "1800", "35", "50", "56", "57", "58", "6")
SECRET_STARTS = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxp-", "npm_", "eyJ")
NO_COUNTRY_CODE = "0"  # no country's calling code begins with it

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WRITTEN = re.compile(r"(?<![\w.])[A-Za-z0-9._-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]{1,63}){1,4}")
LOCAL_PHONE = re.compile(r"(?<![\w+.()-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![\w-])")
SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
SECRET = re.compile(r"(?<![\w+/=.@-])(?=[A-Za-z+/_-]{0,256}[0-9])(?=[0-9+/_-]{0,256}[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?![\w@.]\w)")
# Usual forms of a span: one way of writing it throughout.
USUAL = {
    "email": re.compile(r"\w(?:.*\w)?[@ (\[].*"),
    "ip": re.compile(r"(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}"),
    "card": re.compile(r"[0-9]+|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{1,4})+|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"\+?[0-9]*+(?:[ .-]?+\([0-9]++\))?(?:[ .-]?+[0-9]{2,}+)*"),
    "ssn": re.compile(r".*"),
    "iban": re.compile(r"[A-Z0-9]+|[A-Z0-9]{4}(?: [A-Z0-9]{4})*(?: [A-Z0-9]{1,3})?"),
    "secret": re.compile(r"(?!.*[A-Za-z]{4}[-_/][A-Za-z]{4})(?![0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-).*"),
}
TELLING = re.compile(r"[@0-9(\[]")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")

CUE_WORDS = {k: frozenset(v.split()) for k, v in CUES.items()}
COUNTER_WORDS = frozenset(COUNTER_CUES)


def luhn(digits: str) -> bool:
    doubled = sum((2 * int(d) - 9 if d > "4" else 2 * int(d)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def small_parts(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the base pattern: the longest run of local characters before each @ that a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The matches of each kind that pass its check."""
    numbers = [(m.span(), re.sub("[^0-9]", "", m.group())) for m in DIGITS.finditer(text)]
    return {
        "email": list(emails(text)),
        "ip": [m.span() for m in IP.finditer(text) if small_parts(m.group())],
        "card": [s for s, d in numbers if 16 <= len(d) <= 19 and luhn(d)],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15],
    }


def words_before(text: str, start: int) -> set[str]:
    return {w.lower() for w in WORD.findall(text[max(0, start - CONTEXT_CHARS): start])}


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int]]:
    """The base spans, and all others that the labelers judge; these overlap no base span of their kind."""
    out = [("ip", *m.span()) for m in IP.finditer(text)]
    out += [("card", *m.span()) for m in DIGITS.finditer(text) if 13 <= sum(c != " " and c != "-" for c in m.group()) <= 19]
    out += [("phone", *m.span()) for m in PHONE.finditer(text)]
    for kind, pattern in (("email", WRITTEN), ("phone", LOCAL_PHONE), ("ssn", SSN), ("iban", IBAN)):
        out += [(kind, *m.span()) for m in pattern.finditer(text)]
    out += [
        ("secret", *m.span()) for m in SECRET.finditer(text)
        if m.group().startswith(SECRET_STARTS) or words_before(text, m.start()) & CUE_WORDS["secret"]
    ]
    starts = {k: [s for s, _ in spans] for k, spans in base.items()}

    def apart(kind: str, start: int, end: int) -> bool:
        at = bisect_left(starts.get(kind, []), end) - 1
        return at < 0 or base[kind][at][1] <= start

    wider = [c for c in dict.fromkeys(out) if apart(*c)]
    return [(k, *s) for k, spans in base.items() for s in spans] + wider


def _mod97(text: str) -> bool:
    moved = text.replace(" ", "")
    moved = moved[4:] + moved[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


LABELERS = ("form", "checksum", "gazetteer", "context", "border", "length")
# How far each labeler is trusted before any text is seen.
TRUST = np.array([0.05, 0.4, 0.15, 0.25, 0.1, 0.05])
FEATURES = ("entropy", "digits", "before", "after")


def entropy(span: str) -> float:
    """Bits a character."""
    n = np.array(list(Counter(span).values())) / len(span)
    return float(-(n * np.log2(n)).sum())


def features(text: str, start: int, end: int) -> tuple[int, ...]:
    """The span's entropy in whole bits (at most 4), its share of digits in quarters, and whether quotes or assignments adjoin it."""
    span = text[start:end]
    before = text[max(0, start - 2): start].strip()[-1:]
    return (
        min(4, int(entropy(span))), 4 * sum(c.isdigit() for c in span) // len(span),
        int(before != "" and before in "\"'=:`"), int(end < len(text) and text[end] in "\"'`"),
    )


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Each labeler's vote: 1 for, -1 against, 0 none."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    checksum = gazetteer = 0
    length = 1
    if kind == "email":
        last = re.split(r"[^A-Za-z]+", span)[-1].lower()
        gazetteer = 1 if last in TOP_DOMAINS else -1
        length = 1 if len(span) <= 254 else -1
    elif kind == "ip":
        checksum = 1 if small_parts(span) else -1
        gazetteer = -1 if span.startswith(("0.", "127.", "255.")) else 0
        length = 1 if len(span) >= 8 else 0
    elif kind == "card":
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_STARTS) else -1
        length = 1 if len(digits) in (15, 16) else -1
    elif kind == "phone":
        gazetteer = (-1 if digits[:1] == NO_COUNTRY_CODE else 1) if span.startswith("+") else 0
        length = 1 if 8 <= len(digits) <= 15 else -1
    elif kind == "ssn":
        checksum = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    elif kind == "iban":
        checksum = 1 if _mod97(span) else -1
    else:
        checksum = 1 if entropy(span) >= 3 else -1
        gazetteer = 1 if span.startswith(SECRET_STARTS) else 0
        length = 1 if len(span) <= 256 else -1
    words = words_before(text, start)
    context = 1 if words & CUE_WORDS[kind] else -1 if words & COUNTER_WORDS else 0
    inside = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return (1 if USUAL[kind].fullmatch(span) else -1, checksum, gazetteer, context, -1 if inside else 1, length)


@dataclass
class Model:
    """A weight per kind and labeler vote, then feature; none without candidates."""

    weights: dict[str, np.ndarray]
    reliability: dict[str, tuple[float, float]]  # chance of a vote for, of spans that are and aren't personal

    def probability(self, kind: str, vote: tuple[int, ...]) -> float:
        w = self.weights.get(kind)
        return 0.0 if w is None else float(learn.sigmoid(np.array(w[0] + np.dot(w[1:], vote))))


def fit(patterns: Counter) -> Model:
    """Expectation-maximisation over counts of (kind, votes and features), then the classifier; labelers are shared by the kinds.

    Only votes enter the first."""
    if not patterns:
        return Model({}, {})
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    kind = np.array([KINDS.index(k) for k, _ in keys])
    inputs = np.array([v for _, v in keys], float)
    vote = inputs[:, : len(LABELERS)]
    yes, no = vote > 0, vote < 0
    post = np.clip(0.5 + vote @ TRUST, 0.05, 0.95)
    prior = np.full(len(KINDS), 0.5)
    for _ in range(100):
        weigh = np.stack((post * n, (1 - post) * n))
        # Chance of a vote for, among votes given, in either class; the counts added keep it from 0 and 1.
        chance = (weigh @ yes + 2 * np.array([[0.7], [0.3]])) / (weigh @ (yes | no) + 2)
        prior = (np.bincount(kind, post * n, len(KINDS)) + 1) / (np.bincount(kind, n, len(KINDS)) + 2)
        log = yes @ np.log(chance).T + no @ np.log(1 - chance).T
        new = learn.sigmoid(log[:, 0] - log[:, 1] + np.log(prior[kind] / (1 - prior[kind])))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    weights = {}
    for k, name in enumerate(KINDS):
        mine = kind == k
        if mine.any():
            weights[name] = _logistic(np.column_stack((np.ones(mine.sum()), inputs[mine])), post[mine], n[mine])
    return Model(weights, {x: (float(chance[0, i]), float(chance[1, i])) for i, x in enumerate(LABELERS)})


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Newton's method with expected labels and a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = learn.sigmoid(x @ w)
        g = x.T @ (n * (p - y)) + 0.1 * w
        h = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


def judged(text: str) -> Iterator[tuple[str, int, int, bool, tuple[int, ...]]]:
    if TELLING.search(text):
        base = base_spans(text)
        own = {(k, *s) for k, spans in base.items() for s in spans}
        for kind, start, end in candidates(text, base):
            is_base = (kind, start, end) in own
            yield kind, start, end, is_base, votes(text, kind, start, end) + features(text, start, end)


def spans(text: str | None, model: Model) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, is base) by kind, then start. Spans of one kind don't overlap."""
    kept: list[tuple[int, int, int, bool]] = []
    added: list[tuple[int, int, int, bool]] = []
    for kind, start, end, is_base, vote in judged(text or ""):
        if is_base or model.probability(kind, vote) >= SPAN_AT:
            (kept if is_base else added).append((KINDS.index(kind), start, end, is_base))
    done = (-1, 0)
    for kind, start, end, is_base in sorted(added):
        if kind != done[0] or start >= done[1]:
            kept.append((kind, start, end, is_base))
            done = kind, end
    return [(KINDS[k], s, e, b) for k, s, e, b in sorted(kept)]


def train(docs: DataFrame, *, text_col: str = "text") -> Model:
    """Count vote patterns over all texts (their number is bounded by the values of votes and features) and fit."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for k in range(0, len(batch), 64):
                for text in batch.column(0).slice(k, 64).to_pylist():
                    seen.update((kind, *v) for kind, _, _, _, v in judged(text or ""))
        yield pa.RecordBatch.from_pylist(
            [{"kind": k, "votes": list(v), "n": n} for (k, *v), n in seen.items()],
            schema=pa.schema([("kind", pa.string()), ("votes", pa.list_(pa.int32())), ("n", pa.int64())]),
        )

    counted = (
        docs.select(F.col(text_col).alias("text")).mapInArrow(count, "kind string, votes array<int>, n long")
        .groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()
    )
    return fit(Counter({(r.kind, tuple(r.votes)): r.n for r in counted}))


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id and spans (kind, start, end in code points, base)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in range(0, len(batch), 64):
                for text in batch.column(1).slice(k, 64).to_pylist():
                    found.append([{"kind": k_, "start": s, "end": e, "base": b} for k_, s, e, b in spans(text, model)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN_TYPE)], names=["id", "spans"])

    key = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {key}, spans {SPAN_TYPE}")
    return out.withColumnRenamed("id", id_col)


def redacted(text: str | None, model: Model) -> str | None:
    """The text with each stretch of overlapping spans replaced by the first one's kind in brackets."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in spans(text, model)):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def redact(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents, spans in their texts replaced."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                texts = pa.array([redacted(t, model) for t in part.column(at).to_pylist()], part.column(at).type)
                yield part.set_column(at, part.schema.field(at), texts)

    return docs.mapInArrow(run, docs.schema)
