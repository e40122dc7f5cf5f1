"""Toxic spans by a linear-chain conditional random field with two tags.

Only documents are labelled, so tokens get their tags first: a word or a word's beginning that toxic
training documents have far more often than others is a cue, and tokens with a cue in toxic documents are
tagged. Near copies in the sample count once, or a copied document's own words would look like cues. The
field is fitted to these tags over word and beginning features and tag transitions by gradient ascent on
the likelihood. A text's score comes from its forward-backward marginals: from the surest
token and the number of tokens surer than one half, calibrated on the training documents.

The sample holds at most about ``FIT_ROWS`` labelled documents; scoring covers every whole text.

Defined results: a null or empty text has no tokens and gets the score of no toxic token; without
labels of both classes, or without any cue, that score is 0; columns named like a result are replaced.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.llm.columns import as_strings
from varve.llm.learning import labelled_sample, one_task, platt, sigmoid

#: Labelled documents that the field is fitted on, about.
FIT_ROWS = 6_000
#: A cue's least share of toxic documents against others, and its least log-likelihood ratio against chance.
CUE_RATIO = 20.0
CUE_EVIDENCE = 11.5
BEGINNINGS = (4, 5, 6)
SEGMENT = 64
STEPS = 60

_TOKEN = re.compile(r"[^\W\d_]+")
SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("sure", T.DoubleType())]
    )
)


def features(token: str) -> list[str]:
    """A token's own feature, and one for each beginning that is shorter than it."""
    return [f"={token}", *(f"{token[:n]}~" for n in BEGINNINGS if len(token) >= n)]


class Field:
    """Weights of the fitted field: one tag against the other, so a token has one score."""

    def __init__(self, weights: dict[str, float], bias: float, moves: np.ndarray):
        self.weights, self.bias = weights, bias
        self.moves = moves  # factors of going from tag to tag
        self.heads = {f.strip("=~")[: BEGINNINGS[0]] for f in weights}
        self.scores: dict[str, float] = {}

    def score(self, token: str) -> float:
        found = self.scores.get(token)
        if found is None:
            found = self.bias + sum(self.weights.get(f, 0.0) for f in features(token))
            if len(self.scores) > 200_000:
                self.scores.clear()
            self.scores[token] = found
        return found

    def marginals(self, tokens: list[str]) -> list[float]:
        """Probability of the toxic tag for each token, by the ratios of forward and backward sums."""
        (m00, m01), (m10, m11) = self.moves
        heads, size, plain = self.heads, BEGINNINGS[0], math.exp(self.bias)
        lift = [math.exp(min(self.score(t), 40.0)) if t[:size] in heads else plain for t in tokens]
        forward, ratio = [], 1.0
        for at, up in enumerate(lift):
            ratio = up if not at else up * (m01 + m11 * ratio) / (m00 + m10 * ratio)
            forward.append(ratio)
        out, back = [0.0] * len(lift), 1.0
        for at in range(len(lift) - 1, -1, -1):
            odds = forward[at] * back
            out[at] = odds / (1 + odds)
            ahead = lift[at] * back
            back = (m10 + m11 * ahead) / (m00 + m01 * ahead)
        return out

    def has_cue(self, tokens: list[str]) -> bool:
        heads, size = self.heads, BEGINNINGS[0]
        return any(t[:size] in heads for t in tokens)


def _evidence(marginals: list[float]) -> float:
    """Log-odds of the surest token, and a little for each further token surer than one half."""
    if not marginals:
        return -12.0
    top = min(max(max(marginals), 6e-6), 1 - 6e-6)
    return math.log(top / (1 - top)) + 0.5 * min(sum(p >= 0.5 for p in marginals), 10)


class TokenRows:
    """Token lists as numbers of distinct words, numbered as they first occur: four bytes a token."""

    def __init__(self, texts: Iterable[str | None]):
        known: dict[str, int] = {}
        self.rows = [np.array([known.setdefault(t, len(known)) for t in tokens_of(text)], np.int32) for text in texts]
        self.words = list(known)

    def __iter__(self):
        """The token lists, one at a time."""
        return ([self.words[i] for i in row] for row in self.rows)


def _distinct(tokens: TokenRows) -> np.ndarray:
    """False for documents of which much has been seen in the ones before."""
    count, words = len(tokens.rows), len(tokens.words)
    owner = np.repeat(np.arange(count, dtype=np.int32), [len(r) for r in tokens.rows])
    word = np.concatenate(tokens.rows or [np.zeros(0, np.int32)]).astype(np.int64)
    pair = np.unique(word[:-1] * words + word[1:], return_inverse=True)[1]
    inside = owner[:-2] == owner[2:]
    gram, owner = (pair[:-1] * words + word[2:])[inside], owner[:-2][inside]
    order = np.lexsort((owner, gram))
    gram, owner = gram[order], owner[order]
    # runs of one triple of words, by document: only the run's first document hasn't seen it before
    first = np.append(True, gram[1:] != gram[:-1])[: len(gram)]
    single = first | np.append(True, owner[1:] != owner[:-1])[: len(gram)]
    grams = np.bincount(owner[single], minlength=count)
    return (grams == 0) | (np.bincount(owner[single & ~first], minlength=count) < 0.3 * grams)


def cues(tokens: TokenRows, toxic: np.ndarray) -> set[str]:
    """Features that toxic documents have far more often than others."""
    fresh = _distinct(tokens)
    number: dict[str, int] = {}
    of_word = np.full((len(tokens.words), 1 + len(BEGINNINGS)), -1, np.int32)
    for i, word in enumerate(tokens.words):
        own = [number.setdefault(f, len(number)) for f in features(word)]
        of_word[i, : len(own)] = own
    held = np.zeros((2, len(number)), np.int64)
    for row, flag, use in zip(tokens.rows, toxic, fresh):
        if use:
            own = np.unique(of_word[np.unique(row)])
            held[int(flag), own[own >= 0]] += 1
    n0, n1 = max(((toxic == 0) & fresh).sum(), 1), max(((toxic == 1) & fresh).sum(), 1)
    share = n1 / (n0 + n1)
    found = set()
    for feature, c0, c1 in zip(number, held[0].tolist(), held[1].tolist()):
        if c1 and (c1 / n1) / ((c0 + 0.5) / n0) >= CUE_RATIO:
            p = c1 / (c0 + c1)
            evidence = c1 * math.log(p / share) + (c0 * math.log((1 - p) / (1 - share)) if c0 else 0.0)
            if evidence >= CUE_EVIDENCE:
                found.add(feature)
    return found


def _fit_field(tokens: TokenRows, toxic: np.ndarray, found: set[str]) -> Field:
    """Gradient ascent on the likelihood of the tags, over segments of all texts."""
    names = sorted(found)
    number = {f: i for i, f in enumerate(names)}
    kinds: dict[tuple[int, ...], int] = {(): 0}
    of_word = [kinds.setdefault(tuple(number[f] for f in features(w) if f in number), len(kinds)) for w in tokens.words]
    of_word = np.array(of_word, np.int32)
    starts = np.concatenate(([0], np.cumsum([-(-len(row) // SEGMENT) for row in tokens.rows])))
    kind = np.full((starts[-1], SEGMENT), -1, np.int32)
    tag = np.zeros(kind.shape, bool)
    for row, flag, start, stop in zip(tokens.rows, toxic, starts[:-1], starts[1:]):
        kind[start:stop].reshape(-1)[: len(row)] = of_word[row]
        tag[start:stop] = bool(flag) & (kind[start:stop] > 0)
    kind, tag = kind.T, tag.T  # place by segment
    real = kind >= 0
    kind = np.maximum(kind, 0)
    holder = np.repeat(np.arange(len(kinds)), [len(k) for k in kinds])
    member = np.array([i for k in kinds for i in k], np.int64)
    theta = np.zeros(len(names) + 1 + 4)
    theta[len(names)] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    pairs = np.zeros(4)
    for a in (0, 1):
        for b in (0, 1):
            pairs[2 * a + b] = ((tag[:-1] == a) & (tag[1:] == b) & real[1:]).sum()
    known = kind[real]
    goal = np.bincount(known, tag[real], len(kinds))
    total = real.sum()
    for turn in range(1, STEPS + 1):
        by_kind = np.bincount(holder, theta[member], len(kinds)) + theta[len(names)]
        moves = np.exp(theta[-4:]).reshape(2, 2)
        lift = np.where(real, np.exp(np.clip(by_kind, -30, 30))[kind], 1.0)
        sure, together = _forward_backward(lift, moves, real)
        miss = np.bincount(known, sure[real], len(kinds)) - goal
        slope = np.concatenate((np.bincount(member, miss[holder], len(names)), [miss.sum()], together - pairs)) / total
        slope += 1e-7 * theta
        slope[len(names) + 1] = 0  # staying untagged is the unit
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-9)
        theta = theta - 0.25 * step
    weights = {f: float(w) for f, w in zip(names, theta) if w > 0.05}
    return Field(weights, float(theta[len(names)]), np.exp(theta[-4:]).reshape(2, 2))


def _forward_backward(lift: np.ndarray, moves: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the tag by place and segment, and expected numbers of tag pairs."""
    (m00, m01), (m10, m11) = moves
    places = len(lift)
    forward = np.empty_like(lift)
    forward[0] = lift[0]
    for t in range(1, places):
        forward[t] = lift[t] * (m01 + m11 * forward[t - 1]) / (m00 + m10 * forward[t - 1])
    back = np.ones_like(lift)
    for t in range(places - 2, -1, -1):
        ahead = lift[t + 1] * back[t + 1]
        back[t] = np.where(real[t + 1], (m10 + m11 * ahead) / (m00 + m01 * ahead), 1.0)
    sure = forward * back
    sure /= 1 + sure
    ahead = np.multiply(lift[1:], back[1:], out=back[1:])  # whose own values were needed for the marginals only
    joint = np.stack([ahead] * 4)
    joint[0] = m00
    joint[1] *= m01
    np.multiply(m10, forward[:-1], out=joint[2])
    np.multiply(m11, forward[:-1], out=joint[3])
    joint[3] *= ahead
    joint /= joint.sum(0)
    joint *= real[1:]
    return sure, joint.sum((1, 2))


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def fit(sample: DataFrame, label: str = "toxic") -> bytes:
    """The fitted field, its calibration and the score of a text without toxic tokens."""

    def learn(rows):
        import pandas as pd

        rows = rows.sort_values("doc_id")
        toxic = rows[label].to_numpy()
        tokens = TokenRows(rows["text"])
        found = cues(tokens, toxic) if len(set(toxic)) == 2 else set()
        model = None
        if found:
            field = _fit_field(tokens, toxic, found)
            evidence = np.array([_evidence(field.marginals(t)) if field.has_cue(t) else -12.0 for t in tokens])
            slope, offset = platt(evidence, toxic.astype(float))
            model = (field.weights, field.bias, field.moves, max(slope, 1e-3), offset)
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    found = one_task(sample.select("doc_id", "text", label), learn, "model binary")
    return bytes(found[0]["model"]) if found else pickle.dumps(None)


def _spans(text: str, marginals: list[float]) -> list[dict]:
    """Offsets in code points of the tokens that are toxic rather than not."""
    places = [m.span() for m in _TOKEN.finditer(text)]
    return [{"start": a, "end": b, "sure": p} for (a, b), p in zip(places, marginals) if p >= 0.5]


def score(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``spans`` of toxic tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the cues' weights
    own = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", SPANS)]
    plain = docs.select(*[c for c in docs.columns if c not in ("score", "predicted", "spans")])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sure", pa.float64())]))

    def run(batches):
        fitted = pickle.loads(shared.value)
        field = Field(*fitted[:3]) if fitted else None
        slope, offset = fitted[3:] if fitted else (0.0, -40.0)
        none = float(sigmoid(slope * -12.0 + offset)) if fitted else 0.0
        for batch in batches:
            scores, spans = [], []
            for text in as_strings(batch.column("text")):
                text = text.as_py()
                low = text.lower()
                tokens = _TOKEN.findall(low)
                if field is None or not field.has_cue(tokens):
                    scores.append(none)
                    spans.append([])
                    continue
                if len(low) != len(text):  # lower-casing moved the offsets
                    tokens = [t.lower() for t in _TOKEN.findall(text)]
                marginals = field.marginals(tokens)
                scores.append(float(sigmoid(slope * _evidence(marginals) + offset)))
                spans.append(_spans(text, marginals))
            columns = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "score", "predicted", "spans"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *own]))


def held_out() -> F.Column:
    """Rows that no label is learnt from: every fifth by the CRC of the id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def tag_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Fit on the labelled documents that aren't held out, and score all documents."""
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "toxic", fit_rows, ~held_out(), balanced=False)
    return score(docs, fit(sample))
