"""Features of toxicity and the counterfactual swap (task side)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: Neutral names of groups, in English, German, French and
#: Spanish. A swap replaces one by the next of its line.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("old", "young", "elderly", "teenage"), ("disabled", "blind", "deaf"), ("immigrants", "refugees", "citizens", "foreigners"),
    ("frauen", "männer"), ("mädchen", "jungen"), ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten"), ("schwule", "lesben", "heterosexuelle"), ("flüchtlinge", "einwanderer", "bürger", "ausländer"),
    ("femmes", "hommes"), ("filles", "garçons"), ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques"), ("homosexuels", "lesbiennes", "hétérosexuels"), ("réfugiés", "immigrés", "citoyens", "étrangers"),
    ("mujeres", "hombres"), ("niñas", "niños"), ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos"), ("homosexuales", "lesbianas", "heterosexuales"), ("refugiados", "inmigrantes", "ciudadanos", "extranjeros"),
)


def swaps(lines) -> dict[str, str]:
    """Each term and what replaces it; a term of several lines counts in the first."""
    out: dict[str, str] = {}
    for line in lines:
        for i, term in enumerate(line):
            out.setdefault(term, line[(i + 1) % len(line)])
    return out


SWAP = swaps(IDENTITY_TERMS)
_WORD = re.compile(r"[^\W\d_]+")
_CACHED = 200_000


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word, and its beginnings and endings of 4 to 6 letters."""
    out = [word]
    for k in (4, 5, 6):
        if len(word) > k:
            out += [word[:k] + "-", "-" + word[-k:]]
    return out


def counterfactuals(text: str | None, swap: dict[str, str]) -> list[set[str]]:
    """The words of the text with one of its identity terms swapped wherever it
    stands, for each such term: a text that names a whole line has its own, too."""
    words = words_of(text)
    return [(words - {w}) | {swap[w]} for w in sorted(words & swap.keys()) if swap[w] != w]


def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) -> (feature, rows with label 1, rows with label 0)."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for f in {f for w in words_of(text) for f in features_of(w)}:
                counts.setdefault(f, [0, 0])[1 - label] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
                                         ["feature", "ones", "zeros"])


class Lookup:
    """Numbers of the chosen features that a text has."""

    def __init__(self, features: list[str]):
        self.number, self.of_word = {f: i for i, f in enumerate(features)}, {}

    def __call__(self, words: set[str]) -> set[int]:
        found: set[int] = set()
        known, number = self.of_word, self.number
        if len(known) > _CACHED:
            known.clear()
        for w in words:
            hit = known.get(w)
            if hit is None:
                hit = known[w] = tuple(number[f] for f in features_of(w) if f in number)
            if hit:
                found.update(hit)
        return found


def vectors(features, swap: dict[str, str]):
    """(text, label) -> (label, its features, those of each counterfactual that differ)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(features.value)
        for batch in batches:
            own, others = [], []
            for text in batch.column(0).to_pylist():
                own.append(sorted(look(words_of(text))))
                found = (sorted(look(words)) for words in counterfactuals(text, swap))
                others.append([f for f in found if f != own[-1]])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.list_(pa.int32())), pa.array(others, pa.list_(pa.list_(pa.int32())))], ["label", "own", "others"])
    return run


def scorer(model):
    """texts -> scores, for a pandas UDF."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, weights, bias = model.value
        look = Lookup(features)
        for texts in batches:
            logits = np.array([bias + sum(weights[i] for i in look(words_of(t))) for t in texts], np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -40, 40))))
    return run


def fit(own: list[np.ndarray], others: list[list[np.ndarray]], labels: np.ndarray, n_features: int, penalty: float, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam. Its loss is the mean log loss, plus
    ``penalty`` times the mean squared change of the logit when an identity term
    is swapped (over all counterfactuals), plus ``ridge`` times the weights' squares."""
    flat = lambda rows: (np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)] or [np.empty(0)]).astype(np.int64),
                         np.concatenate([*rows, np.empty(0)]).astype(np.int64))
    row, col = flat(own)
    changed = [(i, o) for i, each in enumerate(others) for o in each]
    a_row, a_col = flat([own[i] for i, _ in changed])
    b_row, b_col = flat([o for _, o in changed])
    d_row, d_col, sign = np.concatenate([a_row, b_row]), np.concatenate([a_col, b_col]), np.concatenate([np.ones(len(a_row)), -np.ones(len(b_row))])
    n, w = len(labels), np.zeros(n_features + 1)
    w[-1] = np.log((labels.sum() + 0.5) / (n - labels.sum() + 1.5))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], n) + w[-1], -40, 40)))
        g = np.append(np.bincount(col, (p - labels)[row], n_features) / max(1, n) + 2 * ridge * w[:-1], (p - labels).sum() / max(1, n))
        if changed:
            delta = np.bincount(d_row, w[d_col] * sign, len(changed))
            g[:-1] += penalty * 2 * np.bincount(d_col, delta[d_row] * sign, n_features) / len(changed)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])
