"""Personal data by weak supervision.

Base patterns are exact: what they match and what passes their checks is personal data. Looser patterns propose further
spans. Labelers (shape, validity, context, gazetteer, counter-evidence) vote on every proposed span, base spans
included. The spans are then reduced to counts per pattern of votes and features, a table whose size is bounded by the
labelers and features and not by the data; on it, expectation-maximisation estimates how reliable each labeler is (base
spans count as known), and a logistic classifier over votes and features is fitted to the resulting
probabilities. The classifier decides about every proposed span; base spans always stay.

* A null text is an empty text and has no spans. Offsets are code points, the end is exclusive.
* Spans of different kinds may overlap; proposed spans that overlap a base span are left out. Repeated rows are judged
  alike. An empty table gives no rows.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.session import settle

KINDS = ("email", "ip", "card", "phone", "name", "ssn", "iban")
BASE_KINDS = KINDS[:4]
LABELERS = ("shape", "valid", "context", "gazetteer", "counter")

# The contract's patterns. The look-behinds and possessive repeats change no match; they keep long runs linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# End of the fixed values.

_LOOSE = (
    ("email", re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{2,63}){1,4}", re.I)),
    ("phone", re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("card", re.compile(r"(?<![0-9.])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?![0-9.])")),
)
_NAME = re.compile(r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\. ?|\b[Mm]y name is |\b[Ii] am )([A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20}){1,2})")
_DIGIT, _AT = re.compile("[0-9]"), re.compile(r"[\[(] ?at ?[\])]", re.I)
_CUES = {
    "email": ("mail", "contact", "reach", "write"), "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "account"), "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "name": ("mr", "mrs", "ms", "dr", "name", "prof"), "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "bank", "account", "transfer"),
}
_COUNTER = ("version", "isbn", "token", "order", "invoice", "hash", "serial", "license", "doi", "id", "total", "$", "€")
_DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info", "co")
_NAMES = frozenset(
    "james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph "
    "jessica thomas sarah charles karen anna peter paul marie laura daniel maria hans julia pierre carlos".split()
)
_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())

_CANDIDATE = [("kind", T.IntegerType()), ("start", T.IntegerType()), ("stop", T.IntegerType()), ("base", T.BooleanType()),
              ("votes", T.IntegerType()), ("look", T.IntegerType())]
CANDIDATES = T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in _CANDIDATE]))


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _at_most_255(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the contract's matches, in order."""
    found, free = [], 0
    sign = text.find("@")
    while sign >= 0:
        at = sign
        while at > free and _LOCAL.match(text, at - 1, at):
            at -= 1
        domain = _DOMAIN.match(text, sign) if at < sign else None
        if domain:
            found.append((at, 0, domain.end()))
            free = domain.end()
        sign = text.find("@", max(sign + 1, free))
    if any(c in text for c in "0123456789"):
        for match in _IP.finditer(text):
            if all(map(_at_most_255, match[0].split("."))):
                found.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text):
            if match.end() - match.start() >= 14 and 14 <= len(digits := _digits(match[0])) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
        for match in _PHONE.finditer(text):
            if 10 <= len(_digits(match[0])) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def _valid(kind: str, text: str) -> bool:
    digits = _digits(text)
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "ssn":
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    if kind == "iban":
        bare = text.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    return True


def _vote(kind: str, text: str, start: int, stop: int, base: bool) -> tuple[int, int]:
    """Votes in base 3 (0 none, 1 no, 2 yes) and looks in mixed base."""
    span, before = text[start:stop], text[max(0, start - 40) : start].lower()
    after = text[stop : stop + 1]
    cue = any(c in before for c in _CUES[kind])
    counter = any(c in before[-16:] for c in _COUNTER) or before[-1:].isalnum() or after.isalnum()
    if kind == "email":
        listed = 2 if span.lower().rstrip("])").split(".")[-1].split(" ")[-1] in _DOMAINS else 0
    elif kind == "name":
        listed = 2 if span.split(" ")[0].lower() in _NAMES else 1
    elif kind == "iban":
        listed = 2 if span[:2] in _COUNTRIES else 1
    elif kind == "phone":
        listed = 1 if len(set(_digits(span))) == 1 else 0
    else:
        listed = 0
    votes = (2 if base or kind in ("ssn", "iban") else 0, 2 if _valid(kind, span) else 1, 2 if cue else 0, listed, 1 if counter else 0)
    packed = 0
    for vote in votes:
        packed = packed * 3 + vote
    marks = sum(not c.isalnum() for c in span)
    return packed, min(3, marks) * 2 + (len(span) > 15)


def _near(base: list[tuple[int, int, int]], at: int, stop: int) -> list[tuple[int, int, int]]:
    """The base spans that begin within a span, and the few before it: one of each kind can reach it."""
    end = bisect_left(base, (stop,))
    return base[max(0, at - 3 * len(BASE_KINDS)) : end]


def candidates(text: str) -> list[dict]:
    """Base spans and proposed spans with their votes, in order."""
    base = base_spans(text)
    rows = [(start, kind, stop, True) for start, kind, stop in base]
    hints = {True: _AT.search(text), False: _DIGIT.search(text)}
    for kind, pattern in _LOOSE:
        for match in pattern.finditer(text) if hints[kind == "email"] else ():
            at = bisect_left(base, (match.start(),))
            if not any(start < match.end() and match.start() < stop for start, _, stop in _near(base, at, match.end())):
                rows.append((match.start(), KINDS.index(kind), match.end(), False))
    for match in _NAME.finditer(text):
        rows.append((match.start(1), KINDS.index("name"), match.end(1), False))
    out = []
    for start, kind, stop, known in sorted(rows):
        votes, look = _vote(KINDS[kind], text, start, stop, known)
        out.append({"kind": kind, "start": start, "stop": stop, "base": known, "votes": votes, "look": look})
    return out


@F.arrow_udf(CANDIDATES)
def propose(texts: pa.Array) -> pa.Array:
    shape = pa.list_(
        pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_()),
                   ("votes", pa.int32()), ("look", pa.int32())])
    )
    return pa.array([candidates(text) if text else [] for text in texts.to_pylist()], shape)


def _unpack(votes: np.ndarray) -> np.ndarray:
    return np.stack([votes // 3 ** (len(LABELERS) - 1 - at) % 3 for at in range(len(LABELERS))], 1)


def estimate(votes: np.ndarray, kinds: np.ndarray, known: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Probability that the spans of each pattern are personal data, by expectation-maximisation.

    The labelers vote independently given the truth; each has a reliability table (truth by vote), each kind a prior.
    Starts from the share of yes among the votes.
    """
    yes, no = (votes == 2).sum(1), (votes == 1).sum(1)
    truth = np.where(known, 1.0, (yes + 0.5) / (yes + no + 1.0))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - truth), counts * truth])  # by truth
        log = np.zeros((2, len(counts)))
        for kind in np.unique(kinds):
            of = kinds == kind
            log[:, of] = np.log(weight[:, of].sum(1) + 1)[:, None]
        for at in range(votes.shape[1]):
            table = np.stack([[weight[t, votes[:, at] == v].sum() + 1 for v in range(3)] for t in range(2)])
            log += np.log(table / table.sum(1, keepdims=True))[:, votes[:, at]]
        top = log.max(0)
        odds = np.exp(log - top)
        truth = np.where(known, 1.0, odds[1] / odds.sum(0))
    return truth


def _features(kinds: np.ndarray, votes: np.ndarray, looks: np.ndarray) -> np.ndarray:
    columns = [kinds[:, None] == np.arange(len(KINDS)), looks[:, None] == np.arange(8)]
    columns += [votes[:, [at]] == np.arange(3) for at in range(votes.shape[1])]
    return np.concatenate([np.ones((len(kinds), 1)), *columns], 1).astype(float)


def fit_classifier(x: np.ndarray, target: np.ndarray, counts: np.ndarray, rounds: int = 300, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method with a ridge."""
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (p - target)) + ridge * weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def learn(found: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier from a table of candidates; None without candidates."""
    patterns = (
        found.select(F.explode("spans").alias("s"))
        .groupBy("s.kind", "s.votes", "s.look", "s.base")
        .agg(F.count("*").alias("n"))
        .orderBy("kind", "votes", "look", "base")
        .toPandas()  # at most kinds x 3^labelers x looks x 2 rows
    )
    if patterns.empty:
        return None
    kinds, votes = patterns.kind.to_numpy(), _unpack(patterns.votes.to_numpy())
    counts = patterns.n.to_numpy().astype(float)
    truth = estimate(votes, kinds, patterns.base.to_numpy(), counts)
    return fit_classifier(_features(kinds, votes, patterns.look.to_numpy()), truth, counts)


def _accepted(span: Column, weights: np.ndarray | None, threshold: float) -> Column:
    """The classifier as an expression: one weight each for kind, look and every labeler's vote."""
    if weights is None:
        return span["base"]
    w = F.array(*(F.lit(float(v)) for v in weights))
    at = [1 + span["kind"], 1 + len(KINDS) + span["look"]]
    offset = 1 + len(KINDS) + 8
    for labeler in range(len(LABELERS)):
        power = 3 ** (len(LABELERS) - 1 - labeler)
        at.append(offset + 3 * labeler + F.floor(span["votes"] / power).cast("int") % 3)
    score = F.lit(float(weights[0]))
    for index in at:
        score = score + F.get(w, index)
    return span["base"] | (score > float(np.log(threshold / (1 - threshold))))


def find_personal_data(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``doc_id`` and ``spans``: array of (kind, start, stop, base), by start and then kind.

    A proposed span is kept when the classifier gives it more than ``threshold``.
    """
    found = settle(docs.select("doc_id", propose(F.coalesce("text", F.lit(""))).alias("spans")))
    weights = learn(found)
    kept = F.filter("spans", lambda s: _accepted(s, weights, threshold))
    names = F.array(*map(F.lit, KINDS))
    return found.select(
        "doc_id",
        F.transform(
            kept,
            lambda s: F.struct(
                F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["base"].alias("base")
            ),
        ).alias("spans"),
    )


def digest(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
