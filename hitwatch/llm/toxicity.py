"""Toxicity: a support vector machine over a subsequence string kernel.

The kernel of two words sums, over all common subsequences of three letters that span
at most six places, ``decay ** (span + span)``, divided by a length norm of each word.
Letters need not be neighbours, so ``i-d-i-o-t``, ``idxiot`` and ``i d i o t`` stay near
``idiot``. A few words of labelled documents are landmarks of a Nyström map; a linear
machine is trained in its space on the words of labelled documents, of which a toxic
one must have at least one toxic word (multiple-instance training). Kernel, map and
machine then fold into one weight per letter triple, and scoring a text is a few table
look-ups per letter, whatever the number of landmarks.

Words are runs without white space; neighbouring words of one or two characters count as
one word, which undoes spaced-out spelling. A text is
scored by its most toxic word, by how far its other words reach, and by its length.

Texts are taken in compatibility form (NFKC), so full-width and other variants of letters
are those letters. The most frequent letters of the landmarks have codes of their own; all
other letters of all scripts share some codes by a hash, so a text of a script with very many
letters has triples too.

Edge cases: null and empty texts, and texts without a word of three letters, get the
score of the machine's offset, a low one; repeated rows get equal scores; an empty table
gives none; without labelled rows of both kinds every score is 0.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hitwatch.llm.common import runs
from hitwatch.llm.labelled import held_out

DECAY = 0.6
REACH = 5  # places from the first letter of a triple to its last
THRESHOLD = 0.7
LANDMARKS, NEUTRAL_LANDMARKS = 64, 16
MINED_LANDMARKS = 48
NEUTRAL_WORDS = 8_000
MINED_WORDS = 2_000  # clean words nearest to toxic ones, added in each round
ROUNDS = 5
MOST_LETTERS = 62  # of the landmarks, the most frequent, have codes of their own
SHARED_LETTERS = 48  # codes of all other letters; the table of triples has the cube of all codes
RUN = 400_000

GAPS = [(j, k) for k in range(2, REACH + 1) for j in range(1, k)]


@dataclass(frozen=True)
class Letters:
    """Letters and digits of lower-cased texts as one array, cut into words."""

    codes: np.ndarray  # 0: no letter of the alphabet, 1: start of a word
    word: np.ndarray  # number of the word of each place
    sizes: np.ndarray  # places of each word; may be none


_LETTER = np.array([chr(c).isalnum() for c in range(0x110000)])
_SPACE = np.array([chr(c).isspace() for c in range(0x110000)])


def _folded(text: str) -> str:
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()


def letters(texts: Sequence[str], alphabet: np.ndarray) -> tuple[Letters, np.ndarray]:
    """Letter codes by ``alphabet``, a table by code point, and the text of each word."""
    lowered = [_folded(text) for text in texts]
    joined = "\n".join(["", *lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _SPACE[points]
    edge = np.diff(space, prepend=True)
    begins = np.flatnonzero(edge & ~space)
    ends = np.flatnonzero(edge & space)
    short = ends - begins <= 2
    text_starts = np.cumsum([1, *(len(text) + 1 for text in lowered)])
    # a word starts where the one before is long, or it is, or a text begins between them
    new = np.ones(len(begins), bool)
    if len(begins) > 1:
        texts_before = np.searchsorted(text_starts, begins, "right")
        new[1:] = ~(short[1:] & short[:-1]) | (texts_before[1:] != texts_before[:-1])
    starts = begins[new]
    # only letters, digits and a mark before each word stay, so punctuation inserted into
    # a word is gone
    mark = np.zeros(len(points), bool)
    mark[starts - 1] = True
    kept = _LETTER[points] | mark
    word = np.cumsum(mark, dtype=np.int32)[kept] - 1
    sizes = np.bincount(word, minlength=len(starts))
    of_text = np.searchsorted(text_starts, starts, "right") - 1
    return Letters(np.where(mark, 1, alphabet[points])[kept].astype(np.int32), word, sizes), of_text


def length_norms(shortest: int = 7, longest: int = 64) -> np.ndarray:
    """Kernel norm of a word of so many places, all different; very short words, which have
    a triple or two, have the norm of a longer one."""
    triples = [[DECAY ** (2 * (k + 1)) * (max(n, shortest) - k) for _, k in GAPS] for n in range(longest + 1)]
    return np.sqrt(np.array(triples).sum(1))


NORMS = length_norms()


def word_sums(text: Letters, size: int, weights: np.ndarray) -> np.ndarray:
    """For each word the sum of the weights of its letter triples, by decay and length."""
    n = len(text.codes)
    codes = np.concatenate([text.codes, np.zeros(REACH, np.int32)])
    word = np.concatenate([text.word, np.full(REACH, -1, np.int32)])
    first, second = text.codes * np.int32(size * size), codes * np.int32(size)
    total = np.zeros(n, np.float32)
    for k in range(2, REACH + 1):
        last = first + codes[k : n + k]
        inside = np.zeros(n, np.float32)
        for j in range(1, k):
            inside += weights.take(last + second[j : n + j])
        inside *= word[k : n + k] == text.word
        total += inside * np.float32(DECAY ** (k + 1))
    sums = np.bincount(text.word, total, minlength=len(text.sizes))
    return sums / NORMS[np.minimum(text.sizes, len(NORMS) - 1)]


@dataclass(frozen=True)
class Model:
    alphabet: np.ndarray
    size: int
    weights: np.ndarray
    offset: float
    curve: np.ndarray

    def evidence(self, texts: Sequence[str]) -> np.ndarray:
        """For each text the margin of its most toxic word, how much its other words reach
        over the machine's lower margin, and how many words there are."""
        found, of_text = letters(texts, self.alphabet)
        best, over, count = np.full(len(texts), self.offset), np.zeros(len(texts)), np.zeros(len(texts))
        if len(of_text):
            value = np.maximum(word_sums(found, self.size, self.weights), 0.0) + self.offset
            first = np.flatnonzero(np.diff(of_text, prepend=-1))
            best[of_text[first]] = np.maximum.reduceat(value, first)
            reach = np.clip(value + 1, 0, 2)
            over[of_text[first]] = np.add.reduceat(reach, first)
            count[of_text[first]] = np.diff(np.append(first, len(of_text)))
        over = np.maximum(over - np.clip(best + 1, 0, 2), 0)
        return np.column_stack([best, np.log1p(over), np.log1p(count), np.ones(len(texts))])

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Score of each text, from 0 to 1."""
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ self.curve, -50, 50)))


# -- training --------------------------------------------------------------------------


def _words(texts: Sequence[str]) -> list[Counter]:
    """Words of each text, as the scorer cuts them."""
    out = []
    for text in texts:
        parts, run = [], []
        for part in _folded(text).split():
            if len(part) <= 2:
                run.append(part)
                continue
            if run:
                parts.append(" ".join(run))
                run = []
            parts.append(part)
        if run:
            parts.append(" ".join(run))
        out.append(Counter(parts))
    return out


def _without_copies(bags: Sequence[Counter]) -> list[Counter]:
    """Bags that share less than half of eight minimum hashes with each earlier one: words
    that only near copies have in common would pass for toxic ones."""
    seen: dict[tuple[int, int], list[int]] = {}
    out: list[Counter] = []
    for bag in bags:
        hashes = np.array([zlib.crc32(word.encode("utf-8", "surrogatepass")) for word in bag], np.uint64)
        if not len(hashes):
            continue
        mixed = (hashes[:, None] * _FACTORS[None, :]) & np.uint64(0xFFFFFFFF)
        keys = list(enumerate(mixed.min(0).tolist()))
        shared = Counter(at for key in keys for at in seen.get(key, ()))
        if max(shared.values(), default=0) >= len(keys) // 2:
            continue
        for key in keys:
            seen.setdefault(key, []).append(len(out))
        out.append(bag)
    return out


_FACTORS = np.random.default_rng(11).integers(1 << 20, 1 << 31, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _plain(word: str) -> str:
    return "".join(c for c in word if c.isalnum())


def _spelled(word: str) -> list[str]:
    """A word with inserted characters, as people write to hide it."""
    plain = _plain(word)
    half = len(plain) // 2
    inserted = [plain[:at] + c + plain[at:] for at in range(1, len(plain)) for c in (plain[at], "x")]
    return [*inserted, plain + "s", plain[:half] + plain[half + 1 :]]


class _Kernel:
    """Triple weights of words, over the alphabet of the landmarks."""

    def __init__(self, landmarks: Sequence[str]):
        counts = Counter(c for word in landmarks for c in word)
        known = sorted(sorted(counts, key=lambda c: (-counts[c], c))[:MOST_LETTERS])
        self.size = len(known) + 2 + SHARED_LETTERS
        other = np.flatnonzero(_LETTER)
        self.alphabet = np.zeros(len(_LETTER), np.uint8)
        self.alphabet[other] = self.size - 1 - (other * 2_654_435_761 >> 16) % SHARED_LETTERS
        self.alphabet[[ord(c) for c in known]] = np.arange(2, len(known) + 2)
        self.maps = [self.triples(word) for word in landmarks]

    def triples(self, word: str) -> dict[int, float]:
        """Weight of each letter triple of one word, by its length norm."""
        codes = [1, *(int(self.alphabet[ord(c)]) for c in word)]
        norm = NORMS[min(len(codes), len(NORMS) - 1)]
        out: dict[int, float] = {}
        for i in range(len(codes)):
            for j, k in GAPS:
                if i + k < len(codes):
                    at = (codes[i] * self.size + codes[i + j]) * self.size + codes[i + k]
                    if codes[i] and codes[i + j] and codes[i + k]:
                        out[at] = out.get(at, 0.0) + DECAY ** (k + 1) / norm
        return out

    def table(self, factors: Sequence[float]) -> np.ndarray:
        """One weight per triple: the landmarks' maps summed with the given factors."""
        out = np.zeros(self.size**3, np.float32)
        for factor, triples in zip(factors, self.maps, strict=True):
            for at, value in triples.items():
                out[at] += factor * value
        return out

    def weigh(self, words: Sequence[str], factors: Sequence[float]) -> np.ndarray:
        """Sum over the landmarks of kernel times factor, for each word."""
        out = np.zeros(len(words), np.float32)
        table = self.table(factors)
        for at in range(0, len(words), 20_000):
            # each word as a text of its own: short ones are not joined
            found, of_text = letters(words[at : at + 20_000], self.alphabet)
            out[at + of_text] = word_sums(found, self.size, table)
        return out

    def to_landmarks(self, words: Sequence[str]) -> np.ndarray:
        """Kernel of each word with each landmark."""
        units = np.eye(len(self.maps))
        return np.column_stack([self.weigh(words, unit) for unit in units])


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 2e-4) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last entry is the offset."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-9
    for _ in range(25):
        gap = 1 - y * (x @ w)
        on = gap > 0
        xs, share = x[on], weight[on] / weight.sum()
        gradient = ridge * w - xs.T @ (share * y[on] * gap[on])
        step = np.linalg.solve((xs * share[:, None]).T @ xs + np.diag(ridge), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sigmoid(x: np.ndarray, positive: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve through the two classes, by Newton steps; the last entry
    is the offset."""
    target = np.where(positive, (positive.sum() + 1) / (positive.sum() + 2), 1 / ((~positive).sum() + 2))
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (p - target) + ridge * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return w


def train(toxic: Sequence[str], clean: Sequence[str]) -> Model | None:
    """A model from texts of either class; none if one of them is missing."""
    bags, others = _without_copies(_words(toxic)), _without_copies(_words(clean))
    if not bags or not others:
        return None
    seen_toxic = Counter(word for bag in bags for word in {_plain(w) for w in bag})
    seen_clean = Counter(word for bag in others for word in {_plain(w) for w in bag})

    def lean(word: str) -> float:
        a, b = seen_toxic[word] / len(bags), seen_clean[word] / len(others)
        return (a - b) / np.sqrt(a + b + 1 / len(bags))

    able = sorted((w for w in seen_toxic if 3 <= len(w) <= 24 and seen_toxic[w] >= 3), key=lambda w: (-lean(w), w))
    known = able[:LANDMARKS] or sorted(seen_toxic)[:LANDMARKS]
    rng = np.random.default_rng(7)
    neutral = sorted({w for w in seen_clean if 3 <= len(w) <= 24})
    if neutral:
        known = [*known, *rng.choice(neutral, min(NEUTRAL_LANDMARKS, len(neutral)), replace=False)]
    known = list(dict.fromkeys(str(w) for w in known if len(w) >= 3))
    if not known:
        return None
    positive = sorted({w for bag in bags for w in bag})
    every_negative = sorted({w for bag in others for w in bag})
    negative = every_negative
    if len(negative) > NEUTRAL_WORDS:
        negative = sorted(str(w) for w in rng.choice(negative, NEUTRAL_WORDS, replace=False))
    number = {w: i for i, w in enumerate(positive)}
    of_bag = [np.array([number[w] for w in bag], int) for bag in bags if bag]
    # words taken as toxic: the likeliest of each text, and those that toxic texts alone often have
    value = np.array([lean(_plain(w)) for w in positive])
    never = np.array([not seen_clean[_plain(w)] for w in positive])
    surplus = np.array([
        max(0.25, seen_toxic[p] - len(bags) * seen_clean[p] / len(others)) for p in map(_plain, positive)
    ])
    strong = np.flatnonzero(never & (value > max(value) / 3))

    for phase in range(2):
        kernel = _Kernel(known)
        gram = kernel.to_landmarks(known)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2 + 1e-3 * np.eye(len(known)))
        root = vectors / np.sqrt(np.maximum(values, 1e-3))  # K^(-1/2), rotated
        in_negative = kernel.to_landmarks(negative) @ root
        for _ in range(ROUNDS):
            witness = np.union1d([at[np.argmax(value[at])] for at in of_bag], strong).astype(int)
            spelled = [[s for s in _spelled(positive[at])] for at in witness]
            toxic_words = [*(positive[at] for at in witness), *(s for some in spelled for s in some)]
            # words count by the number of toxic texts that have them beyond what clean ones would
            share = surplus[witness] / surplus[witness].sum()
            varied = [0.5 * part / max(1, len(some)) for part, some in zip(share, spelled, strict=True) for _ in some]
            x = np.vstack([kernel.to_landmarks(toxic_words) @ root, in_negative])
            y = np.r_[np.ones(len(toxic_words)), -np.ones(len(in_negative))]
            weight = np.r_[share, varied, np.full(len(in_negative), 1.5 / len(in_negative))]
            w = _svm(x, y, weight)
            factors = root @ w[:-1]
            value = kernel.weigh(positive, factors)
            near = kernel.weigh(every_negative, factors)
            mined = [every_negative[at] for at in np.argsort(-near, kind="stable")[:MINED_WORDS]]
            fresh = sorted(set(mined).difference(negative))
            if fresh:
                negative = [*negative, *fresh]
                in_negative = np.vstack([in_negative, kernel.to_landmarks(fresh) @ root])
        if phase == 0:
            # the clean words hardest to tell apart become landmarks too
            plain_mined = dict.fromkeys(p for p in map(_plain, mined) if 2 <= len(p) <= 24)
            known = list(dict.fromkeys([*known, *plain_mined]))[: len(known) + MINED_LANDMARKS]

    plain = Model(kernel.alphabet, kernel.size, kernel.table(factors), float(w[-1]), np.zeros(4))
    evidence = np.vstack([
        plain.evidence(texts[at : at + 100]) for texts in (toxic, clean) for at in range(0, len(texts), 100)
    ])
    curve = _sigmoid(evidence, np.arange(len(evidence)) < len(toxic))
    return Model(plain.alphabet, plain.size, plain.weights, plain.offset, curve)


# -- over tables -----------------------------------------------------------------------


def _scored(model: Model | None, texts: Sequence[str]) -> np.ndarray:
    return np.zeros(len(texts)) if model is None else model.scores(texts)


def toxicity_scores(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, "text", RUN):
            value = _scored(model, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value),
                 pa.array((value >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, "text", RUN):
            yield batch.filter(pa.array(_scored(model, texts) < threshold))

    return docs.mapInArrow(keep, docs.schema)
