"""Personal data by weak supervision: labelers vote on candidate spans, expectation-
maximisation weighs them, and a span classifier trained on the result decides.

Base spans follow fixed patterns and always count. Besides them, looser patterns propose
candidates: spelled-out addresses, telephone numbers without a plus, card numbers of other
lengths and separators, and version-6 network addresses. Labelers by pattern and checksum,
by gazetteer, by context words and by surroundings vote for, against or not at all. Votes
and a few features make a candidate's profile; there are a bounded number of profiles, and
only their counts over all documents leave the tasks. The reliabilities of the labelers and
the share of personal data of each kind are estimated from the counts of base and loose
candidates alike, and a logistic classifier of profiles is fitted to the estimated
posteriors. Loose candidates it is sure of become spans.

Edge cases: null and empty texts have no spans; repeated rows have equal spans; every other
column is left out; without candidates nothing is trained; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import runs

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# no match begins inside digits: where one is possible, an earlier one is
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Around each ``@``: the run of local characters before it and the domain behind."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            free = found.end()
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    out = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0")[:4] or 0) <= 255 for part in found[0].split(".")):
            out.append(("ip", *found.span()))
    for found in _CARD.finditer(text):
        digits = _digits(found[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *found.span()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= len(_digits(found[0])) <= 15:
                out.append(("phone", *found.span()))
    return out


# -- candidates ------------------------------------------------------------------------

_LABEL = r"[A-Za-z0-9-]{2,63}"
_SPELLED_DOT = r"(?:[ ]?(?:\(dot\)|\[dot\]|\{dot\})[ ]?| dot )"
_SPELLED_AT = r"[ ]?(?:\(at\)|\[at\]|\{at\}|@)[ ]?"
LOOSE = {
    # a bare "at" counts only before a spelled-out dot
    "email": re.compile(
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}"
        rf"(?:{_SPELLED_AT}{_LABEL}(?:(?:\.|{_SPELLED_DOT}){_LABEL}){{1,4}}| at {_LABEL}(?:{_SPELLED_DOT}{_LABEL}){{1,4}})",
        re.I,
    ),
    "ip": re.compile(
        r"(?<![0-9A-Fa-f:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:[ ]?\.[ ]?[0-9]{1,3}){3})(?![0-9A-Fa-f:])"
    ),
    "card": re.compile(r"(?<![0-9])(?:[0-9][ .-]?){12,18}[0-9](?![0-9])"),
    "phone": re.compile(
        r"(?<![0-9+.])(?:\+|00)?(?:[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    ),
}
_SPELLED = re.compile(r"\bdot\b|[(\[{]at[)\]}]", re.I)

# What the gazetteer and the context labelers know.
TOP_DOMAINS = frozenset("com org net edu gov info io co uk de fr es it nl eu us ca au ch at be".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 81 86 91".split())
LOCAL_NETWORKS = ("0.", "127.", "255.")
FOR = {
    "email": ("mail", "contact", "write", "courriel", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "client", "login", "from"),
    "card": ("card", "visa", "credit", "pay", "carte", "tarjeta", "karte"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "whatsapp"),
}
AGAINST = ("version", "release", "isbn", "issn", "serial", "order", "invoice", "page", "id=", "sha", "v.")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "surroundings")


def _votes(kind: str, text: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote of each labeler: 1 personal, -1 not, 0 none."""
    span = text[start:end]
    digits = _digits(span)
    before = text[max(0, start - 40) : start].lower()
    checksum = gazetteer = 0
    if kind == "email":
        top = re.split(r"[^a-z0-9-]+", span.lower())[-1]
        gazetteer = 1 if top in TOP_DOMAINS else -1
        checksum = 1 if re.search(r"@|\bat\b", span, re.I) and not span.startswith((".", "-")) else -1
    elif kind == "ip":
        parts = re.findall(r"[0-9]+", span) if ":" not in span else []
        checksum = -1 if parts and max(int(p) for p in parts) > 255 else 1
        gazetteer = -1 if span.startswith(LOCAL_NETWORKS) else 0
    elif kind == "card":
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) else -1
    else:
        checksum = 1 if 8 <= len(digits) <= 15 and len(set(digits)) > 2 else -1
        code = span.lstrip("+0").split(" ")[0].split("(")[0].split("-")[0]
        gazetteer = 1 if span.startswith(("+", "00")) and code in COUNTRY_CODES else 0
    words = set(re.findall(r"[a-z=.]+", before))
    context = 1 if words.intersection(FOR[kind]) else -1 if any(word in before for word in AGAINST) else 0
    beside = text[max(0, start - 1) : start] + text[end : end + 1]
    surroundings = -1 if any(c.isalnum() or c in "_/=#" for c in beside) else 1
    return (1 if base else 0, checksum, gazetteer, context, surroundings)


@dataclass(frozen=True)
class Candidate:
    span: Span
    base: bool
    profile: str


def candidates(text: str) -> list[Candidate]:
    """Base spans, and loose ones that overlap no base span, with their profiles."""
    base = base_spans(text)
    has_digit = bool(_DIGIT.search(text))
    loose: list[Span] = []
    if "@" in text or _SPELLED.search(text):
        loose += [("email", *m.span()) for m in LOOSE["email"].finditer(text)]
    if has_digit:
        loose += [(kind, *m.span()) for kind in ("ip", "card", "phone") for m in LOOSE[kind].finditer(text)]
    # of overlapping candidates the earlier kind and start counts, base before loose
    taken = _united((start, end) for _, start, end in base)
    out = [_candidate(span, text, True) for span in base]
    for kind in dict.fromkeys(span[0] for span in loose):
        free = _free([span for span in loose if span[0] == kind], taken)
        out += [_candidate(span, text, False) for span in free]
        taken = sorted([*taken, *(span[1:] for span in free)])  # two sorted runs
    return out


def _united(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges, sorted, those that overlap put together."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _free(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """The spans of one pattern, which do not overlap each other, that overlap none of the
    taken ranges, which are sorted and do not overlap either."""
    starts = [start for start, _ in taken]
    before = ((span, bisect_left(starts, span[2])) for span in spans)  # so many start before its end
    return [span for span, at in before if not at or taken[at - 1][1] <= span[1]]


def _candidate(span: Span, text: str, base: bool) -> Candidate:
    kind, start, end = span
    votes = _votes(kind, text, start, end, base)
    piece = text[start:end]
    shape = min(3, sum(c in " ().-[]{}" for c in piece) // 2)
    return Candidate(span, base, f"{kind}|{','.join(map(str, votes))}|{shape}|{min(3, (end - start) // 8)}")


# -- learning --------------------------------------------------------------------------


def estimate(votes: np.ndarray, kinds: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior probability of personal data of every profile, by expectation-maximisation
    over labelers that err independently. Starts from the balance of the votes."""
    start = votes.sum(1) / np.maximum(np.abs(votes).sum(1), 1)
    p = np.clip(0.5 + 0.4 * start, 0.05, 0.95)
    for _ in range(rounds):
        log_odds = np.zeros(len(p))
        for kind in np.unique(kinds):
            on = kinds == kind
            share = (p[on] @ counts[on] + 2) / (counts[on].sum() + 4)
            log_odds[on] = np.log(share / (1 - share))
        for labeler in range(votes.shape[1]):
            voting = votes[:, labeler] != 0  # no vote says nothing
            all_yes, all_no = p[voting] @ counts[voting] + 4, (1 - p[voting]) @ counts[voting] + 4
            for value in (-1, 1):
                on = votes[:, labeler] == value
                # smoothed towards labelers that are right more often than wrong
                yes = (p[on] @ counts[on] + 2 + value) / all_yes
                no = ((1 - p[on]) @ counts[on] + 2 - value) / all_no
                log_odds[on] += np.log(yes / no)
        fresh = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        if np.abs(fresh - p).max() < 1e-6:
            break
        p = fresh
    return p


def fit(features: np.ndarray, target: np.ndarray, counts: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic classifier on soft targets, by Newton steps."""
    w = np.zeros(features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        hessian = (features * (counts * p * (1 - p))[:, None]).T @ features + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, features.T @ (counts * (p - target)) + penalty * w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(profiles: dict[str, int], threshold: float = 0.9) -> frozenset[str]:
    """Profiles that count as personal data, from the number of candidates of each."""
    if not profiles:
        return frozenset()
    names = sorted(profiles)
    parts = [name.split("|") for name in names]
    kinds = np.array([part[0] for part in parts])
    votes = np.array([[int(v) for v in part[1].split(",")] for part in parts])
    counts = np.array([profiles[name] for name in names], float)
    posterior = estimate(votes, kinds, counts)
    columns = [np.ones(len(names)), *(kinds == kind for kind in KINDS)]
    # whether the fixed pattern matches is left out: the classifier is for spans it misses
    columns += [votes[:, k] == value for k in range(1, votes.shape[1]) for value in (-1, 1)]
    columns += [np.array([part[k] for part in parts]) == str(v) for k in (2, 3) for v in range(4)]
    features = np.column_stack(columns).astype(float)
    weights = fit(features, posterior, np.minimum(counts, 1e6))
    sure = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30))) >= threshold
    return frozenset(name for name, yes in zip(names, sure, strict=True) if yes)


# -- over tables -----------------------------------------------------------------------


def profile_counts(docs: DataFrame) -> dict[str, int]:
    """Number of candidates of every profile, over all documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in runs(batches, "text"):
            counts: dict[str, int] = {}
            for text in texts:
                for found in candidates(text):
                    counts[found.profile] = counts.get(found.profile, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["profile", "n"],
            )

    rows = docs.select("text").mapInArrow(scan, "profile string, n long")
    # one row per profile, of which there are no more than kinds, votes and shapes make
    return {row.profile: row.n for row in rows.groupBy("profile").agg(F.sum("n").alias("n")).collect()}


def _joined(spans: list[Span]) -> str:
    spans = sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SCHEMA = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def personal_data(docs: DataFrame, sure: frozenset[str]) -> DataFrame:
    """Base spans of every document by number and digest, all spans, and the number of
    those that were added."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, "text"):
            rows = []
            for text in texts:
                found = candidates(text)
                base = [c.span for c in found if c.base]
                added = [c.span for c in found if not c.base and c.profile in sure]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((
                    *(sum(kind == name for kind, _, _ in base) for name in KINDS),
                    digest, _joined(base + added), len(added),
                ))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))],
                ["doc_id", *(part.split()[0] for part in SCHEMA.split(", "))],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, {SCHEMA}")


def redacted(text: str, spans: str) -> str:
    """The text with each span replaced by its kind."""
    parts = sorted(((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",") if s)))
    out, done = [], 0
    for start, end, kind in parts:
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
            done = end
    return "".join([*out, text[done:]])
