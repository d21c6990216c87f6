"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear SVM.

A text is cut into sentences and those into units: the letters of each run of
non-blanks, so inserted signs fall away, and of runs of spaced letters.  A window
is a unit or two units that follow each other in a sentence, so that insults of
two ordinary words count as well.  The kernel of two windows counts their common
subsequences of three letters, with gaps of up to three letters weighing less and
marks at the ends of units and between them; it tolerates inserted and left-out
letters.  It is scaled by what windows of that length can reach.

Letters are code points, folded and without accents, so that words of any script
differ.  Runs of scripts without blanks are cut into overlapping pieces.

The SVM is trained on sentences.  Every sentence of a clean document is clean; of
a toxic document the sentences that score highest are toxic, and a sentence
stands for its highest window.  The first choice goes by how runs of four letters
are spread over both kinds; after each fit the toxic sentences are chosen anew among
all toxic documents, those above the margin, and the clean ones that score
highest join the training rows.  Landmarks are windows of both kinds, spread by the kernel.  A
document's score is its highest sentence's, mapped to a probability by a logistic
fit on cross-fitted scores.

As the kernel is an inner product over letter triples, the landmark map and the
SVM fold into one weight per triple.  A window's sum is that of its units and of
the letters next to the blank, so each distinct unit is summed once per block.

Defined results: texts without letters, empty and null ones get the score of the
lowest margin that the table can give; without toxic or without clean labelled
rows every score is 0; documents of null id are scored; a document labelled
twice counts as toxic if one label says so; labels of unknown documents are
ignored; extra columns stay, unless named like a computed one.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .batches import add_columns, as_bytes, id_and_text, in_own_columns

SPAN, DECAY = 6, 0.6
# Letter codes: the blank, a-z, marks of a unit's ends, and 35 classes of code points.
BITS = 6
BLANK, START, END, OTHER = 0, 27, 28, 29
CLASSES = (1 << BITS) - OTHER
TRIPLES = 1 << (3 * BITS)
RUN_PLACES = 1 << 20
LONGEST, PIECE = 40, 6
LANDMARKS = 128
TURNS = 4
# The fit reads a bounded sample of labelled rows, in order of a hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1_500, 2_500
THRESHOLD = 0.7
KEPT_UNITS = 200_000

# A mark with a blank after it ends a sentence, a full stop of unspaced scripts always does.
STOP = re.compile(r"[.!?…]+(?=\s)|[\n。！？]")
ASCII_LETTERS = {c: None for c in range(128) if not (97 <= c <= 122 or chr(c).isspace())}
# Signs, digits and accents; marks of U+0900 to U+109F are letters of their scripts.
SIGNS = re.compile("[^\\w\\sऀ-႟]+|[\\d_]+")
SPACED = re.compile(r"(?:(?<=\s)|\A)[^\W\d_](?:[^\S\n][^\W\d_]){2,}(?=\s|\Z)")
UNSPACED = "฀"


def sentences_of(text: bytes | None) -> list[list[str]]:
    """Units of each sentence of a UTF-8 text."""
    body = STOP.sub("\n", (text or b"").decode("utf-8", "replace"))
    if body.isascii():
        plain = body.lower().translate(ASCII_LETTERS)
    else:
        plain = SIGNS.sub("", unicodedata.normalize("NFKD", body.casefold()))
    out = [units for line in plain.split("\n") if (units := line.split())]
    out += [["".join(run.split())] for run in SPACED.findall(plain)]
    if any(len(u) > PIECE for units in out for u in units if len(u) > LONGEST or u[0] >= UNSPACED):
        out = [[piece for u in units for piece in _pieces(u)] for units in out]
    return out


def _pieces(unit: str) -> list[str]:
    size = PIECE if unit[0] >= UNSPACED else LONGEST
    if len(unit) <= size:
        return [unit]
    return [unit[i : i + size] for i in range(0, len(unit) - size // 2, size // 2)]


def _codes(units: list[str]) -> np.ndarray:
    """Letter codes of units of one length, a row each."""
    points = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").astype(np.int64).reshape(len(units), -1)
    return np.where((points >= 97) & (points <= 122), points - 96, OTHER + points % CLASSES)


def _number(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((a << BITS) + b << BITS) + c


def _inner_triples(codes: np.ndarray):
    """(triple numbers, weight) for each way to place three letters, the end marks included."""
    ends = np.ones((len(codes), 1), np.int64)
    codes = np.hstack([START * ends, codes, END * ends])
    size = codes.shape[1]
    for last in range(2, min(SPAN, size)):
        for middle in range(1, last):
            yield _number(codes[:, : size - last], codes[:, middle : size - last + middle], codes[:, last:]), DECAY ** (last - 2)


# Places of three out of three letters, the blank, and three letters, from both sides.
ACROSS = [(t, DECAY ** max(0, t[2] - t[0] - 2)) for t in combinations(range(7), 3) if t[0] < 3 < t[2] or 3 in t]


def _across_triples(keys: np.ndarray):
    """The same for the letters around the blank of two units, as ``tail`` and ``head`` numbers."""
    spots = [keys >> (BITS * i) & (1 << BITS) - 1 for i in (5, 4, 3)] + [np.zeros_like(keys)] + [keys >> (BITS * i) & (1 << BITS) - 1 for i in (2, 1, 0)]
    for (a, b, c), weight in ACROSS:
        yield _number(spots[a], spots[b], spots[c])[:, None], weight


def _norm(length: int) -> float:
    """Square norm of a unit of this length whose triples all differ."""
    size = length + 2
    return sum((last - 1) * (size - last) * DECAY ** (2 * (last - 2)) for last in range(2, min(SPAN, size)))


ACROSS_NORM = sum(w * w for _, w in ACROSS)


def _by_length(units: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        groups.setdefault(len(u), []).append(i)
    return groups


def unit_sums(units: list[str], table: np.ndarray, chunk: int = 20_000) -> np.ndarray:
    """Sums of the table's weights over each unit's triples."""
    out = np.zeros(len(units))
    for places in _by_length(units).values():
        for at in range(0, len(places), chunk):
            part = places[at : at + chunk]
            for numbers, weight in _inner_triples(_codes([units[i] for i in part])):
                out[part] += weight * table[numbers].sum(axis=1)
    return out


def across_sums(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The same for the letters around blanks."""
    out = np.zeros(len(keys))
    for numbers, weight in _across_triples(keys):
        out += weight * table[numbers[:, 0]]
    return out


class Units(dict):
    """Numbers of units, given on demand, and what windows need of each unit."""

    def __init__(self):
        super().__init__()
        self.names: list[str] = []
        self.norm, self.tail, self.head = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self.names)
        self.names.append(unit)
        return number

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Unit numbers of all texts in order, -1 after each sentence and each text, and where texts start."""
        ids, starts = array("i"), []
        number = self.__getitem__
        for text in texts:
            starts.append(len(ids))
            for sentence in sentences_of(text):
                ids.extend(map(number, sentence))
                ids.append(-1)
            ids.append(-1)
        known = len(self.norm)
        new = self.names[known:]
        norm, tail, head = np.empty(len(new)), np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        for length, places in _by_length(new).items():
            codes = _codes([new[i] for i in places])
            short = np.full((len(places), max(0, 3 - length)), START)
            norm[places] = _norm(length)
            tail[places] = _number(*np.hstack([short, codes])[:, -3:].T)
            head[places] = _number(*np.hstack([codes, short + END - START])[:, :3].T)
        self.norm, self.tail, self.head = (np.concatenate(x) for x in ((self.norm, norm), (self.tail, tail), (self.head, head)))
        return np.array(ids, np.int32), np.array(starts, np.int64)

    def pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose unit and the next one are in one sentence, and the numbers of the letters between."""
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0)).astype(np.int32)
        return at, self.tail[ids[at]] << 3 * BITS | self.head[ids[at + 1]]


@dataclass(frozen=True)
class Model:
    table: np.ndarray  # weight per triple
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5, rounds: int = 30, chunk: int = 4096) -> np.ndarray:
    """Linear SVM with squared hinge loss, by Newton steps over the active rows, summed in chunks."""
    size = z.shape[1] + 1
    parts = [slice(i, i + chunk) for i in range(0, len(z), chunk)]
    w, active = np.zeros(size), np.ones(len(z), bool)
    for _ in range(rounds):
        gram, right = ridge * weight.sum() * np.eye(size), np.zeros(size)
        for part in parts:
            rows = np.flatnonzero(active[part])
            za = np.hstack([z[part][rows].astype(np.float64), np.ones((len(rows), 1))])
            weighted = za * weight[part][rows, None]
            gram += weighted.T @ za
            right += weighted.T @ y[part][rows]
        w = np.linalg.solve(gram, right)
        now = np.concatenate([y[part] * (z[part] @ w[:-1] + w[-1]) < 1 for part in parts])
        if (now == active).all():
            break
        active = now
    return w


class Sample:
    """Labelled texts as windows: each place has the window of its unit, and that of it and the next one."""

    def __init__(self, texts: list[bytes | None]):
        self.units = Units()
        self.ids, self.starts = self.units.read(texts)
        self.ends = np.r_[self.starts[1:], len(self.ids)]
        self.at, keys = self.units.pairs(self.ids)
        self.keys, key_of = np.unique(keys, return_inverse=True)
        self.key_of = key_of.astype(np.int32)
        # Sentences: from after a -1 to the next one.
        self.stops = np.flatnonzero(self.ids < 0)

    def windows(self, places: np.ndarray, double: np.ndarray) -> np.ndarray:
        """(unit, next unit or -1) of the windows that begin at the places."""
        second = np.where(double, self.ids[np.minimum(places + 1, len(self.ids) - 1)], -1)
        return np.stack([self.ids[places], second], axis=1).astype(np.int64)

    def pair_scores(self, units: np.ndarray, between: np.ndarray, norms: np.ndarray, least: float, chunk: int = 1 << 17) -> np.ndarray:
        """For each pair the sums of both units and of the letters between them, over the root of its norm; in chunks."""
        out = np.empty(len(self.at), np.float32)
        for i in range(0, len(out), chunk):
            at = self.at[i : i + chunk]
            left, right = self.ids[at], self.ids[at + 1]
            out[i : i + chunk] = (units[left] + units[right] + between[self.key_of[i : i + chunk]]) / np.sqrt(norms[left] + norms[right] + least)
        return out

    def best(self, single: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The higher score at each place of its two windows, and whether that is the pair's."""
        value = np.r_[single, -np.inf].astype(np.float32)[self.ids]  # -1 reads the last one
        double = np.zeros(len(value), bool)
        double[self.at] = pair > value[self.at]
        value[self.at] = np.maximum(value[self.at], pair)
        return value, double

    def scored(self, table: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
        """``best`` under a table of triple weights."""
        u = self.units
        raw, between = unit_sums(u.names, table), across_sums(self.keys, table)
        return self.best(raw / np.sqrt(u.norm) + bias, self.pair_scores(raw, between, u.norm, ACROSS_NORM) + np.float32(bias))

    def sentences(self, texts: np.ndarray, value: np.ndarray, most: int, least: float = -np.inf) -> np.ndarray:
        """Of each text, the places of the best windows of its highest ``most`` sentences above ``least``."""
        out = []
        for t in texts.tolist():
            stops = self.stops[np.searchsorted(self.stops, self.starts[t]) : np.searchsorted(self.stops, self.ends[t])]
            begins = np.r_[self.starts[t], stops[:-1] + 1]
            own = stops > begins
            if not own.any():
                continue
            begins, stops = begins[own], stops[own]
            high = np.maximum.reduceat(value[: stops[-1]], begins)
            chosen = np.argsort(-high, kind="stable")[:most]
            out += [b + int(np.argmax(value[b:e])) for b, e, h in zip(begins[chosen], stops[chosen], high[chosen]) if h > least]
        return np.array(out, np.int64)

    def features(self, windows: np.ndarray, column: np.ndarray, columns: int) -> np.ndarray:
        """Triple weights of windows as rows, of the triples that have a column."""
        out = np.zeros((len(windows), columns), np.float32)
        norm = np.zeros(len(windows))

        def add(rows: np.ndarray, numbers: np.ndarray, weight: float) -> None:
            found = column[numbers]
            row, at = np.nonzero(found >= 0)
            np.add.at(out, (rows[row], found[row, at]), np.float32(weight))

        for side in (0, 1):
            rows = np.flatnonzero(windows[:, side] >= 0)
            names = [self.units.names[i] for i in windows[rows, side]]
            norm[rows] += self.units.norm[windows[rows, side]]
            for places in _by_length(names).values():
                for numbers, weight in _inner_triples(_codes([names[i] for i in places])):
                    add(rows[places], numbers, weight)
        rows = np.flatnonzero(windows[:, 1] >= 0)
        norm[rows] += ACROSS_NORM
        keys = self.units.tail[windows[rows, 0]] << 3 * BITS | self.units.head[windows[rows, 1]]
        for numbers, weight in _across_triples(keys):
            add(rows, numbers, weight)
        out /= np.sqrt(norm)[:, None].astype(np.float32)
        return out

    def triples(self, windows: np.ndarray) -> np.ndarray:
        """All triples of some windows, in order."""
        names = [self.units.names[i] for i in np.unique(windows[windows >= 0])]
        found = [n.ravel() for places in _by_length(names).values() for n, _ in _inner_triples(_codes([names[i] for i in places]))]
        both = windows[windows[:, 1] >= 0]
        found += [n.ravel() for n, _ in _across_triples(self.units.tail[both[:, 0]] << 3 * BITS | self.units.head[both[:, 1]])]
        return np.unique(np.concatenate(found))

    def spread(self, windows: np.ndarray, wanted: int) -> np.ndarray:
        """Windows far from each other under the kernel, the first one first."""
        if len(windows) <= wanted:
            return windows
        own = self.triples(windows)
        column = np.full(TRIPLES, -1, np.int32)
        column[own] = np.arange(len(own))
        rows = self.features(windows, column, len(own))
        chosen, nearest = [0], rows @ rows[0]
        while len(chosen) < wanted:
            chosen.append(int(np.argmin(nearest)))
            nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
        return windows[sorted(set(chosen))]

    def first_scores(self, toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How much more often toxic texts have a window's runs of four letters than clean ones do."""
        u = self.units
        inner = _runs_inside(u.names)
        between = _runs_across(self.keys)
        seen = np.zeros((2, RUN_PLACES))
        unit = np.zeros((2, len(u.names)))
        kinds, kind_of = np.unique(self.ids[self.at].astype(np.int64) * len(u.names) + self.ids[self.at + 1], return_inverse=True)
        kind_of, pair = kind_of.astype(np.int32), np.zeros((2, len(kinds)), np.float32)
        for label, texts in ((0, clean), (1, toxic)):
            for t in texts.tolist():
                ids = np.unique(self.ids[self.starts[t] : self.ends[t]])
                ids = ids[ids >= 0]
                a, b = np.searchsorted(self.at, (self.starts[t], self.ends[t]))
                held = [inner[i] for i in ids.tolist()] + [between[np.unique(self.key_of[a:b])].ravel()]
                seen[label, np.unique(np.concatenate(held))] += 1
                unit[label, ids] += 1
                pair[label, np.unique(kind_of[a:b])] += 1
        n0, n1 = max(1, len(clean)), max(1, len(toxic))
        odds = lambda c: np.log((c[1] + 0.5) / n1) - np.log((c[0] + 0.5) / n0)
        expected = seen[0] / n0 * n1
        surprise = (seen[1] - expected) / np.sqrt(expected + 1)
        value = np.where((surprise > 3) & (odds(seen) > 3), surprise, 0.0)
        total = np.array([value[r].sum() for r in inner])
        count = np.array([max(1, len(r)) for r in inner])
        both = self.pair_scores(total, value[between].sum(axis=1), count, between.shape[1])
        # A clean word may have a run of an insult.
        return np.where(odds(unit) > 1, total / np.sqrt(count), 0.0), np.where(odds(pair)[kind_of] > 1, both, 0.0)


def _place_of(a, b, c, d) -> np.ndarray:
    mixed = (_number(a, b, c) << BITS) + d
    return (mixed * 0x9E3779B1 >> 7) & RUN_PLACES - 1


def _runs_inside(units: list[str]) -> list[np.ndarray]:
    """Places of each unit's runs of four letters, the marks at its ends included."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(units)
    for length, places in _by_length(units).items():
        if length < 2:
            continue
        codes = np.pad(_codes([units[i] for i in places]), ((0, 0), (1, 1)), constant_values=((0, 0), (START, END)))
        numbers = _place_of(*(codes[:, j : j + length - 1] for j in range(4)))
        for i, row in zip(places, numbers, strict=True):
            out[i] = row
    return out


def _runs_across(keys: np.ndarray) -> np.ndarray:
    """Places of the four runs of four that hold the blank between two units."""
    spots = [keys >> (BITS * i) & (1 << BITS) - 1 for i in (5, 4, 3)] + [np.zeros_like(keys)] + [keys >> (BITS * i) & (1 << BITS) - 1 for i in (2, 1, 0)]
    return np.stack([_place_of(*spots[i : i + 4]) for i in range(4)], axis=1)


def _ranked(windows: np.ndarray) -> np.ndarray:
    """Distinct windows, the most frequent first."""
    kinds, count = np.unique(windows, axis=0, return_counts=True)
    return kinds[np.argsort(-count, kind="stable")]


def _fit_margins(sample: Sample, toxic: np.ndarray, clean: np.ndarray) -> Model:
    """Latent SVM: which sentence of a toxic text is toxic, and which window tells it, is chosen by the last fit."""
    value, double = sample.best(*sample.first_scores(toxic, clean))
    good = sample.sentences(toxic, value, 4, 0.0)  # texts without a telling run wait for the first fit
    if not len(good):
        return Model(np.zeros(TRIPLES), -1.0, 1.0, 0.0)
    known = np.empty((0, 2), np.int64)
    for turn in range(TURNS):
        positive = sample.windows(good, double[good])
        bad = sample.sentences(clean, value, 3)
        negative = sample.windows(bad, double[bad])
        if turn == 0:
            # Before the first fit most clean windows score alike: take some of each text, of both kinds.
            some = [p for t in clean.tolist() for p in range(sample.starts[t], sample.ends[t], max(1, (sample.ends[t] - sample.starts[t]) // 8))]
            some = np.array([p for p in some if sample.ids[p] >= 0], np.int64)
            follows = np.isin(some, sample.at) & (np.arange(len(some)) % 2 == 0)
            negative = np.vstack([negative, sample.windows(some, follows)])
            marks = np.vstack([sample.spread(_ranked(positive)[:500], LANDMARKS * 2 // 3), sample.spread(_ranked(negative)[:500], LANDMARKS // 3)])
            marks = np.unique(marks, axis=0)
            own = sample.triples(marks)
            column = np.full(TRIPLES, -1, np.int32)
            column[own] = np.arange(len(own))
            phi = sample.features(marks, column, len(own)).astype(np.float64)
            values, vectors = np.linalg.eigh(phi @ phi.T)
            keep = values > 1e-6 * values.max()
            whiten = vectors[:, keep] / np.sqrt(values[keep])  # the Nyström map
        known = np.unique(np.vstack([known, negative]), axis=0)  # clean windows gather over the turns
        same = {tuple(w) for w in positive.tolist()}
        negative = known[[tuple(w) not in same for w in known.tolist()]] if turn == 0 else known
        rows = np.vstack([positive, negative])
        mapped = np.empty((len(rows), whiten.shape[1]), np.float32)
        for i in range(0, len(rows), 500):
            mapped[i : i + 500] = sample.features(rows[i : i + 500], column, len(own)) @ phi.T @ whiten
        y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        shares = np.r_[np.full(len(positive), 0.5 / len(positive)), np.full(len(negative), 0.5 / max(1, len(negative)))]
        w = _svm(mapped, y, shares)
        table = np.zeros(TRIPLES)
        table[own] = phi.T @ (whiten @ w[:-1])
        model = Model(table, float(w[-1]), 1.0, 0.0)
        value, double = sample.scored(table, model.bias)
        good = sample.sentences(toxic, value, 4, 0.0)
        if not len(good):
            break
    return model


def _highest(sample: Sample, texts: np.ndarray, model: Model) -> np.ndarray:
    value, _ = sample.scored(model.table, model.bias)
    high = np.maximum.reduceat(value, sample.starts)[texts]
    return np.where(np.isfinite(high), high, _floor(model))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with targets kept off 0 and 1."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        slack = p * (1 - p) + 1e-9
        g = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(slack * x * x).sum() + 1e-3, (slack * x).sum()], [(slack * x).sum(), slack.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def fit(texts: list[bytes | None], labels: list[int]) -> Model | None:
    """A model of labelled texts, or None if a class is missing."""
    y = np.array(labels)
    if len(set(labels)) < 2:
        return None
    sample = Sample(texts)
    if not len(sample.units.names):
        return Model(np.zeros(TRIPLES, np.float32), -1.0, 1.0, 0.0)
    fold = np.zeros(len(y), int)  # alternate folds within each class
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % 2
    held = np.zeros(len(y))
    for side in (0, 1):
        train, other = fold != side, np.flatnonzero(fold == side)
        if len(set(y[train])) < 2:
            held = None
            break
        held[other] = _highest(sample, other, _fit_margins(sample, np.flatnonzero(train & (y == 1)), np.flatnonzero(train & (y == 0))))
    model = _fit_margins(sample, np.flatnonzero(y == 1), np.flatnonzero(y == 0))
    if held is None:
        held = _highest(sample, np.arange(len(y)), model)
    slope, shift = _logistic(held, y)
    return Model(model.table.astype(np.float32), model.bias, slope, shift)


def _floor(model: Model) -> float:
    """Margin of a text without units: none of the telling triples."""
    return min(model.bias, -1.0)


def held_out(key: str = "doc_id"):
    """The third of documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Fit on a bounded sample of labelled documents outside the held-out third."""
    known = (
        labels.select(F.col(key).cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
        .dropna()
        .filter(~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
        .withColumn("_order", F.xxhash64("_id"))
    )
    picked = known.filter("_y = 1").orderBy("_order").limit(SAMPLE_TOXIC)
    picked = picked.unionByName(known.filter("_y = 0").orderBy("_order").limit(SAMPLE_CLEAN))
    bodies = id_and_text(docs, key, text).join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    rows = bodies.groupBy("_id").agg(F.first("_order").alias("o"), F.first("_y").alias("y"), F.min("text").alias("t"))
    rows = rows.toArrow().sort_by([("o", "ascending"), ("_id", "ascending")])
    return fit(as_bytes(rows["t"]), rows["y"].to_pylist())


class _Scorer:
    """Sums of units seen so far in this worker, bounded."""

    def __init__(self):
        self.model = None

    def scores(self, model: Model, texts: list[bytes | None]) -> np.ndarray:
        if self.model is not model or len(self.units.names) > KEPT_UNITS:
            self.model, self.units, self.raw = model, Units(), np.empty(0)
        units = self.units
        ids, starts = units.read(texts)
        if not len(starts):
            return np.empty(0)
        self.raw = np.r_[self.raw, unit_sums(units.names[len(self.raw) :], model.table)]
        floor = np.full(1, -np.inf)
        single = np.r_[self.raw / np.sqrt(units.norm), floor]
        value = single[ids]
        at, keys = units.pairs(ids)
        if len(at):
            kinds, kind_of = np.unique(keys, return_inverse=True)
            left, right = ids[at], ids[at + 1]
            pair = self.raw[left] + self.raw[right] + across_sums(kinds, model.table)[kind_of]
            value[at] = np.maximum(value[at], pair / np.sqrt(units.norm[left] + units.norm[right] + ACROSS_NORM))
        high = np.maximum.reduceat(value, starts) + model.bias
        return model.probability(np.where(np.isfinite(high), high, _floor(model)))


_SCORER = _Scorer()


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1."""
    field = T.StructField("score", T.DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(block):
        if shared.value is None:
            return [[0.0] * block.num_rows]
        return [_SCORER.scores(shared.value, as_bytes(block.column(text))).tolist()]

    return add_columns(docs.withColumn(text, F.col(text).cast("string")), text, [field], make)


def drop_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` without those that score at least ``threshold``; a column named ``score`` keeps its values."""
    return in_own_columns(docs, ["score"], lambda own: score(own, model, text).filter(F.col("score") < threshold))
