"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters as its own vector, if the training sample knows it, beside the mean of the
vectors of its character trigrams, which every word has. The network reads windows of words,
each window overlapping the next by half, pools the states of both directions by attention,
and gives one logit per window. A document's score is the calibrated sigmoid of its highest
window, so that a short insult in a long text counts in full. Training is plain numpy on the
driver over a bounded sample; scoring runs batch by batch in the tasks, over whole texts.
"""

from __future__ import annotations

import pickle
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    crc_remainder, hash_below, ragged_ranges, words_of, written,
)

#: A word in UTF-8, as ``words_of`` finds them.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
WINDOW, STRIDE = 64, 32
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
#: Character trigrams are hashed into this many vectors.
CHAR_ROWS = 1 << 14
#: The training sample: at most so many documents of label 0 and of label 1, and so many
#: characters times that, which bounds what the driver holds. Scoring reads whole texts.
SAMPLE, SAMPLE_CHARS = (2400, 800), 6000
#: A sampled text beyond its share of the characters is read in so many pieces, spread over the
#: whole text.
PIECES = 40
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: A small sample is gone through more often, until there were so many steps.
UPDATES = 200
#: A word has a vector of its own if so many sampled documents have it; in training the vector
#: is left out at this rate, so that the trigrams learn too.
SPREAD, DROPOUT = 6, 0.3
DECAY = 1e-5
#: Windows that one step of scoring holds, and bytes of words whose inputs a task keeps.
STEP, CACHE = 2048, 64 << 20
#: Windows are scored in a multiple of so many, so that a score does not depend on its neighbours.
MULTIPLE = 16
#: Texts that a task takes from Arrow at a time.
TEXTS = 256
#: Words whose gate inputs are computed together.
BLOCK = 1 << 13
#: A longer word is read as several words of so many bytes.
LONG_WORD = 1024
THRESHOLD = 0.7
GATES = 3 * HIDDEN
#: Rows of the training sample before their texts are read.
CHOSEN = pa.schema({"place": pa.int64(), "l_key": pa.string(), "y": pa.int32(), "cap": pa.int64()})


# --- inputs ---------------------------------------------------------------------------------


def trigrams(word: bytes) -> list[int]:
    """Rows of the character trigrams of a word with its ends marked."""
    letters = f"^{word.decode('utf-8', 'replace')}$"
    return [
        zlib.crc32(letters[i : i + 3].encode()) % CHAR_ROWS for i in range(max(1, len(letters) - 2))
    ]


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text; words beyond LONG_WORD bytes come in parts."""
    words = words_of(text)
    if text is None or len(text) <= LONG_WORD // 4 or max(map(len, words), default=0) <= LONG_WORD:
        return words
    return [w[i : i + LONG_WORD] for w in words for i in range(0, len(w), LONG_WORD)]


def windows_of(n_words: int) -> list[tuple[int, int]]:
    """Starts and lengths of all overlapping windows; an empty text has one empty window."""
    if n_words <= WINDOW:
        return [(0, n_words)]
    last = -(-(n_words - WINDOW) // STRIDE) * STRIDE
    return [(s, min(WINDOW, n_words - s)) for s in range(0, last + 1, STRIDE)]


@dataclass
class Model:
    """Parameters by name, the known words, and the calibration of a document's logit."""

    weights: dict[str, np.ndarray]
    words: dict[bytes, int]
    slope: float = 1.0
    shift: float = 0.0


@dataclass
class Words:
    """Row numbers of distinct words, and what each is made of until its gates are known."""

    model: Model
    rows: dict[bytes, int] = field(default_factory=dict)
    known: list[int] = field(default_factory=list)
    chars: list[array] = field(default_factory=list)
    gates: dict[str, np.ndarray] = field(default_factory=dict)
    done: int = 0
    held: int = 0  # bytes of the words

    def limit(self) -> None:
        """Forget all words once they hold more than CACHE bytes.

        A word of n bytes counts as 400 + 12 n: its numbers, its gates and its trigrams.
        """
        if self.held > CACHE:
            self.rows, self.known, self.chars, self.gates = {}, [], [], {}
            self.done = self.held = 0

    def projected(self) -> dict[str, np.ndarray]:
        """Gate inputs of all words so far; each word's are computed once, and only they are kept."""
        n = self.done + len(self.known)
        if not self.gates or n > len(self.gates["f"]):
            for d in "fb":
                grown = np.zeros((max(1024, 2 * n), GATES), np.float32)
                if d in self.gates:
                    grown[: self.done] = self.gates[d][: self.done]
                self.gates[d] = grown
        if self.known:
            fresh = gates_of(self.model.weights, self.known, self.chars)
            for d in "fb":
                self.gates[d][self.done : n] = fresh[d]
            self.done, self.known, self.chars = n, [], []
        return self.gates

    def number(self, words: list[bytes]) -> np.ndarray:
        find = self.rows.get
        out = [find(word, -1) for word in words]
        if -1 in out:
            for i, word in enumerate(words):
                if out[i] < 0:
                    fresh = self.done + len(self.known)
                    out[i] = self.rows.setdefault(word, fresh)
                    if out[i] == fresh:
                        self.known.append(self.model.words.get(word, 0))
                        self.chars.append(array("i", trigrams(word)))
                        self.held += 400 + 12 * len(word)
        return np.array(out, np.int64)


def word_inputs(weights: dict, known: Sequence[int], chars: Sequence[Sequence[int]]) -> np.ndarray:
    """Word vector and mean trigram vector of each word."""
    if not known:
        return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
    sizes = np.fromiter(map(len, chars), np.int64, len(chars))
    flat = np.fromiter((c for word in chars for c in word), np.int64, int(sizes.sum()))
    sums = np.add.reduceat(weights["char"][flat], np.cumsum(sizes) - sizes, axis=0)
    return np.concatenate([weights["word"][known], sums / sizes[:, None]], axis=1, dtype=np.float32)


def project(weights: dict, inputs: np.ndarray) -> dict[str, np.ndarray]:
    """Gate inputs of words for both directions."""
    return {d: inputs @ weights[f"w{d}"] + weights[f"b{d}"] for d in "fb"}


def gates_of(weights: dict, known: Sequence[int], chars: Sequence[Sequence[int]]) -> dict[str, np.ndarray]:
    """Gate inputs of words, BLOCK words at a time."""
    out = {d: np.empty((len(known), GATES), np.float32) for d in "fb"}
    for at in range(0, len(known), BLOCK):
        some = slice(at, at + BLOCK)
        for d, rows in project(weights, word_inputs(weights, known[some], chars[some])).items():
            out[d][some] = rows
    return out


# --- network --------------------------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def run_direction(
    weights: dict, d: str, inputs: np.ndarray, steps: np.ndarray, live: np.ndarray, keep: list | None
) -> np.ndarray:
    """States (time, window, hidden). ``inputs`` has the projected gates of each word; steps
    beyond a window's end leave its state alone."""
    u, c = weights[f"u{d}"], weights[f"c{d}"]
    length, batch = steps.shape
    states = np.zeros((length, batch, HIDDEN), np.float32)
    h = np.zeros((batch, HIDDEN), np.float32)
    order = range(length) if d == "f" else range(length - 1, -1, -1)
    for t in order:
        p, q = inputs[steps[t]], h @ u
        gates = sigmoid(p[:, : 2 * HIDDEN] + q[:, : 2 * HIDDEN])
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        inner = q[:, 2 * HIDDEN :] + c
        n = np.tanh(p[:, 2 * HIDDEN :] + r * inner)
        new = n + z * (h - n)
        if keep is not None:
            keep.append((t, h, r, z, n, inner))
        h = np.where(live[t][:, None], new, h)
        states[t] = h
    return states


def forward(
    weights: dict, gates: dict[str, np.ndarray], steps: np.ndarray, live: np.ndarray,
    trace: dict | None = None,
) -> np.ndarray:
    """Logit of each window. ``gates``: a row per distinct word and direction; ``steps``: (time,
    window) rows."""
    kept = {d: None if trace is None else [] for d in "fb"}
    states = np.concatenate(
        [run_direction(weights, d, gates[d], steps, live, kept[d]) for d in "fb"], axis=2
    )
    focus = np.tanh(states @ weights["aw"] + weights["ab"])
    marks = np.where(live, focus @ weights["av"], -1e9)
    marks = np.exp(marks - marks.max(0))
    shares = marks * live
    shares /= np.maximum(shares.sum(0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", shares, states)
    if trace is not None:
        trace |= {"kept": kept, "states": states, "focus": focus, "shares": shares, "pooled": pooled}
    return pooled @ weights["ow"] + weights["ob"][0]


def backward(
    weights: dict, inputs: np.ndarray, steps: np.ndarray, live: np.ndarray, trace: dict, error: np.ndarray
) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters and of the word inputs, for the derivative of the logits."""
    out = {"ow": trace["pooled"].T @ error, "ob": np.array([error.sum()], np.float32)}
    pooled = error[:, None] * weights["ow"][None, :]
    states, focus, shares = trace["states"], trace["focus"], trace["shares"]
    share_error = np.einsum("bh,tbh->tb", pooled, states)
    mark = shares * (share_error - (shares * share_error).sum(0))
    out["av"] = np.einsum("tb,tba->a", mark, focus)
    inner = mark[:, :, None] * weights["av"] * (1 - focus**2)
    out["aw"] = np.einsum("tbh,tba->ha", states, inner)
    out["ab"] = inner.sum((0, 1))
    state_error = shares[:, :, None] * pooled[None] + inner @ weights["aw"].T
    word_error = np.zeros_like(inputs)
    for k, d in enumerate("fb"):
        u = weights[f"u{d}"]
        du, dc = np.zeros_like(u), np.zeros_like(weights[f"c{d}"])
        gate_error = np.zeros((len(inputs), GATES), np.float32)
        dh = np.zeros(state_error.shape[1:2] + (HIDDEN,), np.float32)
        for t, h, r, z, n, q in reversed(trace["kept"][d]):
            dh = dh + state_error[t][:, k * HIDDEN : (k + 1) * HIDDEN]
            on = live[t][:, None]
            new = dh * on
            dn = new * (1 - z) * (1 - n**2)
            dz = new * (h - n) * z * (1 - z)
            dr = dn * q * r * (1 - r)
            recurrent = np.concatenate([dr, dz, dn * r], axis=1)
            du += h.T @ recurrent
            dc += (dn * r).sum(0)
            np.add.at(gate_error, steps[t], np.concatenate([dr, dz, dn], axis=1))
            dh = dh * (1 - on) + new * z + recurrent @ u.T
        out |= {f"u{d}": du, f"c{d}": dc, f"w{d}": inputs.T @ gate_error, f"b{d}": gate_error.sum(0)}
        word_error += gate_error @ weights[f"w{d}"].T
    return out, word_error


def start_weights(n_words: int, seed: int = 7) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)

    def draw(*shape: int, scale: float = 0.3) -> np.ndarray:
        return random.normal(0, scale, shape).astype(np.float32)

    weights = {"word": draw(n_words, WORD_DIM, scale=0.1), "char": draw(CHAR_ROWS, CHAR_DIM, scale=0.3)}
    weights["word"][0] = 0
    for d in "fb":
        weights |= {
            f"w{d}": draw(WORD_DIM + CHAR_DIM, GATES), f"u{d}": draw(HIDDEN, GATES),
            f"b{d}": np.zeros(GATES, np.float32), f"c{d}": np.zeros(HIDDEN, np.float32),
        }
    return weights | {
        "aw": draw(2 * HIDDEN, HIDDEN), "ab": np.zeros(HIDDEN, np.float32), "av": draw(HIDDEN),
        "ow": draw(2 * HIDDEN), "ob": np.array([-1.0], np.float32),
    }


# --- training -------------------------------------------------------------------------------


def _grid(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of numbered texts: (time, window) rows, which are live, and the text of each."""
    spans = [(i, s, n) for i, text in enumerate(texts) for s, n in windows_of(len(text))]
    height = max([n for *_, n in spans], default=1) or 1
    steps = np.zeros((len(spans), height), np.int32)
    live = np.zeros((len(spans), height), bool)
    for row, (i, s, n) in enumerate(spans):
        steps[row, :n] = texts[i][s : s + n]
        live[row, :n] = True
    return steps.T, live.T, np.array([i for i, *_ in spans], np.int64)


def logits_of(model: Model, words: Words, texts: list[np.ndarray]) -> np.ndarray:
    """Highest window logit of each text."""
    gates = words.projected()
    best = np.full(len(texts), -np.inf)
    # Windows are made for a few texts at a time; a very long text comes in slices of its own.
    for group, some in _slices(texts):
        steps, live, owner = _grid(some)
        for at in range(0, steps.shape[1], STEP):
            to = at + STEP
            n = len(owner[at:to])
            # With empty windows up to a multiple: the last few would be rounded otherwise.
            full = [np.pad(x[:, at:to], ((0, 0), (0, -n % MULTIPLE))) for x in (steps, live)]
            got = forward(model.weights, gates, *full)[:n]
            np.maximum.at(best, group[owner[at:to]], got)
    return best


def _slices(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Texts in groups of about STEP windows. A longer text is cut so that the pieces have
    exactly its windows: each piece starts at a window and overlaps the next piece."""
    group: list[int] = []
    some: list[np.ndarray] = []
    held, most = 0, STEP * STRIDE
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        text = texts[i]
        pieces = [text]
        if len(text) > most + WINDOW:
            pieces = [text[s : s + most + WINDOW - STRIDE] for s in range(0, len(text) - WINDOW + STRIDE, most)]
        for piece in pieces:
            group.append(i)
            some.append(piece)
            held += max(1, len(piece) // STRIDE)
            if held >= STEP:
                yield np.array(group), some
                group, some, held = [], [], 0
    if some:
        yield np.array(group), some


def train(samples: list[tuple[str | None, int]], seed: int = 7) -> Model:
    """Fit the network to (text, label) pairs.

    Each epoch looks for the highest window of every text and learns from those windows: the
    label of a text says that its worst window is toxic or that none is. A fifth of the sample
    is kept for the calibration. With one label only, every score is that label's share.
    """
    labels = np.array([label for _, label in samples], np.float32)
    # Texts are split again for their numbers: the driver never holds the words of all texts.
    spread: Counter[bytes] = Counter()
    toxic: Counter[bytes] = Counter()
    for text, label in samples:
        some = set(tokens_of(text))
        spread.update(some)
        if label:
            toxic.update(some)
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in spread.items() if n >= SPREAD), 1)}
    model = Model(start_weights(len(vocabulary) + 1, seed), vocabulary)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        model.slope, model.shift = 0.0, float(np.log(share / (1 - share)))
        return model
    words = Words(model)
    texts = [words.number(tokens_of(text)).astype(np.int32) for text, _ in samples]
    words.rows.clear()  # all words have their numbers
    # The first word input starts as the log odds of the word among the labels.
    odds = np.zeros(len(vocabulary) + 1, np.float32)
    base = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    for w, i in vocabulary.items():
        ratio = np.log((toxic[w] + 0.5) / (spread[w] - toxic[w] + 0.5)) - base
        odds[i] = ratio * spread[w] / (spread[w] + 20)
    del spread, toxic
    model.weights["word"][:, 0] = odds * 0.3
    fit = np.arange(len(texts)) % 5 != 4
    steps, live, owner = _grid([t for t, own in zip(texts, fit, strict=True) if own])
    y = labels[fit]
    sizes = np.fromiter(map(len, words.chars), np.int64, len(words.chars))
    flat = np.fromiter((c for w in words.chars for c in w), np.int32, int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    random, count = np.random.default_rng(seed), 0
    epochs = max(EPOCHS, UPDATES // max(1, -(-int(fit.sum()) // BATCH)))
    for epoch in range(epochs):
        gates = gates_of(model.weights, words.known, words.chars)
        got = np.concatenate(
            [forward(model.weights, gates, steps[:, a : a + STEP], live[:, a : a + STEP])
             for a in range(0, steps.shape[1], STEP)]
        )
        order = np.lexsort((-got, owner))
        top = order[np.r_[True, np.diff(owner[order]) > 0]]
        for pick in np.array_split(random.permutation(top), -(-len(top) // BATCH)):
            used, at = np.unique(steps[:, pick], return_inverse=True)
            left_out = random.random(len(used)) < DROPOUT
            known = np.where(left_out, 0, np.array(words.known)[used])
            own = word_inputs(model.weights, known.tolist(), [words.chars[i] for i in used])
            trace: dict = {}
            part, on = at.reshape(steps[:, pick].shape), live[:, pick]
            logit = forward(model.weights, project(model.weights, own), part, on, trace)
            error = ((sigmoid(logit) - y[owner[pick]]) / len(pick)).astype(np.float32)
            grads, word_error = backward(model.weights, own, part, on, trace, error)
            grads["word"] = DECAY * model.weights["word"]
            np.add.at(grads["word"], known, word_error[:, :WORD_DIM])
            grads["word"][0] = 0
            grads["char"] = DECAY * model.weights["char"]
            at = ragged_ranges(begins[used], sizes[used])
            share = np.repeat(word_error[:, WORD_DIM:] / sizes[used, None], sizes[used], axis=0)
            np.add.at(grads["char"], flat[at], share)
            count += 1
            _adam(model.weights, grads, moments, count, RATE * (1 - epoch / epochs))
    del gates
    held = [t for t, own in zip(texts, fit, strict=True) if not own]
    model.slope, model.shift = _calibrate(logits_of(model, words, held), labels[~fit])
    return model


def _adam(weights: dict, grads: dict, moments: dict, count: int, rate: float) -> None:
    for name, grad in grads.items():
        grad = np.clip(grad, -1, 1)
        m, v = moments[name]
        m += 0.1 * (grad - m)
        v += 0.001 * (grad**2 - v)
        step = (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)
        weights[name] -= (rate * step).astype(np.float32)


def _calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-out logits (Platt scaling)."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    low, high = 1 / (np.sum(labels == 0) + 2), (np.sum(labels == 1) + 1) / (np.sum(labels == 1) + 2)
    goal = np.where(labels == 1, high, low)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * logits + b)
        w = np.maximum(p * (1 - p), 1e-6)
        x = np.stack([logits, np.ones_like(logits)])
        # A normal prior around (1, 0) keeps the curve finite where the labels are separable.
        hessian = (x * w) @ x.T + 0.1 * np.eye(2)
        da, db = np.linalg.solve(hessian, x @ (p - goal) + 0.1 * np.array([a - 1, b]))
        da, db = np.clip([da, db], -0.5, 0.5)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


# --- Spark ----------------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Train on at most SAMPLE documents of the labels whose id is not held out.

    The sample is the first labelled texts by a hash of id and text, whatever their length, so
    that it is the same for the same table; equal rows count once. It holds at most SAMPLE *
    SAMPLE_CHARS characters of a label: if the drawn texts have more, all of them are cut to the
    same share, and a text beyond it is read in PIECES pieces spread over the whole of it.
    Labels other than 0 and 1, null ids, null texts and labels without a document are ignored;
    without any labelled row all scores are one half.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & (crc_remainder(F.col("doc_id"), 3) != 1))
        .select(F.col("doc_id").cast("string").alias("l_key"), F.col("toxic").cast("int").alias("y"))
        .where("l_key is not null")
        .distinct()
    )
    texts = (
        docs.select(F.col(key).cast("string").alias("l_key"), F.col(text).cast("string").alias("body"))
        .where("l_key is not null and body is not null")
        .withColumn("place", F.xxhash64("l_key", "body"))
    )
    # Only numbers are joined; copies of a row become one before they meet their labels.
    sizes = texts.groupBy("l_key", "place").agg(F.min(F.length("body")).alias("chars"))
    found = written(sizes.join(known, "l_key"), "labelled")
    totals = dict(found.groupBy("y").count().collect())
    chosen = []
    for y, most in enumerate(SAMPLE):
        if not totals.get(y):
            continue
        # About twice the wanted number by their hash, so that there are enough.
        some = found.where(F.col("y") == y).where(hash_below(F.col("place"), 2 * most, totals[y]))
        drawn = sorted(map(tuple, some.select("place", "l_key", "chars").collect()))[:most]
        cap = even_share([chars for *_, chars in drawn], most * SAMPLE_CHARS)
        chosen += [(place, l_key, y, cap) for place, l_key, _ in drawn]
    # As an Arrow table it reaches the executors without Python workers of theirs.
    columns = zip(*chosen, strict=True) if chosen else [[]] * len(CHOSEN)
    picked = docs.sparkSession.createDataFrame(pa.table([*map(pa.array, columns, CHOSEN.types)], CHOSEN))
    size, piece = F.length("body"), F.floor(F.col("cap") / PIECES)
    pieces = [
        F.substring(
            "body", (F.lit(1) + F.floor((size - piece) * i / (PIECES - 1))).cast("int"), piece.cast("int")
        )
        for i in range(PIECES)
    ]
    rows = (
        texts.join(F.broadcast(picked), ["place", "l_key"])
        .select(
            "place", "l_key", "y",
            F.when(size <= F.col("cap"), F.col("body")).otherwise(F.concat_ws("\n", *pieces)).alias("body"),
        )
        .dropDuplicates(["place", "l_key", "y"])
        .collect()
    )
    return train([(r["body"], r["y"]) for r in sorted(rows, key=lambda r: (r["place"], r["l_key"], r["y"]))])


def even_share(sizes: list[int], total: int) -> int:
    """The largest c for which the sizes, each cut to c, sum to at most ``total``."""
    left = total
    for i, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - i) > left:
            return left // (len(sizes) - i)
        left -= size
    return max(sizes, default=0)


def pieces_of(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in pieces that have exactly its windows: each piece starts at a window.

    A text of up to STEP * STRIDE characters is one piece. A longer one is cut into its words
    from left to right, so that a task never holds all of them.
    """
    most = STEP * STRIDE
    if text is None or len(text) <= most:
        yield tokens_of(text)
        return
    body, held = text.encode("utf-8", "surrogatepass").lower(), []
    for found in WORD.finditer(body):
        first, last = found.span()
        held += [body[i : min(i + LONG_WORD, last)] for i in range(first, last, LONG_WORD)]
        while len(held) >= most + WINDOW:
            yield held[: most + WINDOW - STRIDE]
            held = held[most:]
    yield held


def score_texts(model: Model, words: Words, texts: list[str | None]) -> np.ndarray:
    """Scores of whole texts; ``words`` is emptied whenever it holds too much."""
    best = np.full(len(texts), -np.inf)
    owners: list[int] = []
    group: list[list[bytes]] = []

    def flush() -> None:
        if owners:
            words.limit()
            np.maximum.at(best, owners, logits_of(model, words, [words.number(t) for t in group]))
            owners.clear()
            group.clear()

    held = 0
    for i, text in enumerate(texts):
        for piece in pieces_of(text):
            owners.append(i)
            group.append(piece)
            held += len(piece)
            if held >= STEP * STRIDE:
                flush()
                held = 0
    flush()
    return sigmoid(np.clip(model.slope * best + model.shift, -40, 40))


def scored(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of its whole text in ``name``.

    Null and empty texts have one empty window and get its score. A column called ``name`` is
    replaced. Only texts go to Python and only scores come back; other columns stay in Spark,
    whatever their type.
    """
    own = [c for c in docs.columns if c.lower() != name.lower()]
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # about 0.5 MB

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own_model = pickle.loads(sent.value)
        words = Words(own_model)
        for batch in batches:
            scores = [
                score_texts(own_model, words, batch.slice(at, TEXTS).to_pylist())
                for at in range(0, len(batch), TEXTS)
            ]
            yield pa.array(np.concatenate(scores) if scores else [], pa.float64())

    # Not deterministic to Spark, so that a filter on the score does not compute it again.
    score = F.arrow_udf(run, "double").asNondeterministic()
    return docs.select(*own, score(F.col(text).cast("string")).alias(name))
