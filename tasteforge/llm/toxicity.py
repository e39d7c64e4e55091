"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 10).

Inputs. Each word has two channels. The word channel is the shrunken log odds of the word among toxic against other
training documents; the character channel does the same for the character n-grams of the word with its ends marked, as
their maximum and mean, so that a word never seen is judged by its parts. A long word, as text without spaces is, counts as overlapping
pieces. Both tables are supervised embeddings.

Network. A window of ``window`` words runs through a gated recurrent unit in either direction; attention weights pool the
states; a logistic unit gives the window's probability. Forward and backward passes are numpy. Windows overlap, every
window of every text is scored, and a document's score is that of its worst window.

Training uses a bounded sample of labelled documents. So that a document's own words do not vouch for it, its inputs come
from tables made without its fold. A document has a label, its windows have none: in each round the network is trained on
the window that it, so far, finds worst in each document, toxic or not.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.words import slices

WORD = re.compile(r"\w+")
#: A document is toxic from this score on.
TOXIC_FROM = 0.3


@dataclass(frozen=True)
class Network:
    """``toxic`` and ``other`` bound the labelled sample (documents of each kind, picked by a hash of the id).

    Words and n-grams with ``least`` training documents have an entry, ``entries`` of each at most: those with the
    strongest odds. ``strength`` is the number of imagined documents of the usual mixture behind each estimate.
    """

    window: int = 64
    stride: int = 48
    hidden: int = 8
    toxic: int = 1000
    other: int = 3000
    folds: int = 4
    rounds: int = 3
    epochs: int = 4
    batch: int = 128
    rate: float = 0.02
    strength: float = 4.0
    least: int = 2
    entries: int = 60_000
    shortest: int = 3
    longest: int = 5
    piece: int = 50
    cached_words: int = 100_000
    seed: int = 11


#: Inner end of a piece of a long word; no word has it.
CUT = "+"


def words_in(text: str | None, cfg: Network) -> list[str]:
    """Folded words. One of more than ``cfg.piece`` characters is given in pieces that share longest - 1 characters.

    A piece says with ``CUT`` where the word goes on, so together the pieces have the word's n-grams and no others.
    """
    found = WORD.findall(text.lower()) if text else []
    if any(len(w) > cfg.piece for w in found):
        found = [p for w in found for p in (_pieces(w, cfg) if len(w) > cfg.piece else [w])]
    return found


def _pieces(word: str, cfg: Network) -> list[str]:
    starts = range(0, len(word) - cfg.longest + 1, cfg.piece - cfg.longest + 1)
    return [CUT * (s > 0) + word[s : s + cfg.piece] + CUT * (s != starts[-1]) for s in starts]


def ngrams(word: str, cfg: Network) -> set[str]:
    """n-grams of a word, or of a piece of one, with the word's ends marked."""
    marked = f"^{word}$".removeprefix("^" + CUT).removesuffix(CUT + "$")
    return {marked[i : i + n] for n in range(cfg.shortest, cfg.longest + 1) for i in range(len(marked) - n + 1)}


@dataclass
class Tables:
    words: dict[str, float] = field(default_factory=dict)
    grams: dict[str, float] = field(default_factory=dict)


def _odds(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float, cfg: Network) -> np.ndarray:
    """Shrunken log odds of each entry from its numbers of toxic and other documents; 0 where there is too little to say."""
    usual = (n_toxic + 0.5) / (n_toxic + n_other + 1)
    base = np.log(usual / (1 - usual))
    value = np.log((toxic + cfg.strength * usual) / (other + cfg.strength * (1 - usual))) - base
    return np.where((toxic + other >= cfg.least) & (np.abs(value) > 0.3), value, 0.0)


def _strongest(names: dict[str, int], odds: np.ndarray, cfg: Network) -> dict[str, float]:
    held = [(k, float(odds[i])) for k, i in names.items() if odds[i]]
    held.sort(key=lambda kv: (-abs(kv[1]), kv[0]))
    return dict(held[: cfg.entries])


@dataclass
class Lexicon:
    """The sample's words and n-grams as numbers: per document its words in order, per word its n-grams."""

    words: dict[str, int]
    grams: dict[str, int]
    docs: list[np.ndarray]
    parts: np.ndarray  # n-grams of word w: parts[begins[w]:begins[w + 1]]
    begins: np.ndarray

    def counts(self, fold: np.ndarray, y: np.ndarray, folds: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with each word, and each n-gram, by fold and label."""
        words = np.zeros((folds, 2, len(self.words)), np.int32)
        grams = np.zeros((folds, 2, len(self.grams)), np.int32)
        for doc, k, label in zip(self.docs, fold, y.astype(int), strict=True):
            own = np.unique(doc)
            words[k, label, own] += 1
            if len(own):
                spans = [self.parts[self.begins[w] : self.begins[w + 1]] for w in own.tolist()]
                grams[k, label, np.unique(np.concatenate(spans))] += 1
        return words, grams

    def features(self, word_odds: np.ndarray, gram_odds: np.ndarray) -> np.ndarray:
        """A row of inputs per word, as ``word_features`` gives them."""
        out = np.zeros((len(self.words), FEATURES), np.float32)
        if len(out):
            values = gram_odds[self.parts]
            out[:, 0], out[:, 1], out[:, 4] = word_odds, word_odds != 0, 1
            out[:, 2] = np.maximum.reduceat(values, self.begins[:-1])
            out[:, 3] = np.add.reduceat(values, self.begins[:-1]) / np.diff(self.begins)
        return out


def lexicon(texts: list[str | None], cfg: Network) -> Lexicon:
    words: dict[str, int] = {}
    docs = [np.array([words.setdefault(w, len(words)) for w in words_in(t, cfg)], np.int64) for t in texts]
    grams: dict[str, int] = {}
    parts, sizes = [], [0]
    for word in words:
        own = np.array([grams.setdefault(g, len(grams)) for g in sorted(ngrams(word, cfg))], np.int32)
        parts.append(own)
        sizes.append(len(own))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return Lexicon(words, grams, docs, flat, np.cumsum(sizes))


FEATURES = 5


def word_features(word: str, tables: Tables, cfg: Network) -> list[float]:
    """Word odds, whether the word has an entry, largest and mean n-gram odds, and a constant."""
    own = tables.words.get(word)
    get = tables.grams.get
    parts = [get(g, 0.0) for g in ngrams(word, cfg)]
    return [own or 0.0, 0.0 if own is None else 1.0, max(parts, default=0.0), sum(parts) / max(1, len(parts)), 1.0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(cfg: Network) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(cfg.seed)
    h = cfg.hidden
    weights = {}
    for side in ("f", "b"):
        weights["W" + side] = rng.normal(0, 0.4, (FEATURES, 3 * h))  # update, reset, candidate
        weights["U" + side] = rng.normal(0, 0.3, (h, 3 * h))
    weights["att"] = rng.normal(0, 0.3, 2 * h)
    weights["out"] = rng.normal(0, 0.3, 2 * h)
    weights["bias"] = np.array([-1.0])
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _run(gates: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (steps x windows x hidden) of one direction; gates are the inputs' parts, in the direction's order."""
    steps, n, width = gates.shape
    h = width // 3
    states = np.empty((steps, n, h), dtype=np.float32)
    state = np.zeros((n, h), dtype=np.float32)
    gate_u, cand_u = np.ascontiguousarray(u[:, : 2 * h]), np.ascontiguousarray(u[:, 2 * h :])
    for t in range(steps):
        zr = state @ gate_u
        zr += gates[t, :, : 2 * h]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :h], zr[:, h:]
        before = state @ cand_u
        cand = r * before
        cand += gates[t, :, 2 * h :]
        np.tanh(cand, out=cand)
        new = state - cand
        new *= z
        new += cand
        if mask is not None:
            new *= mask[t][:, None]
        if keep is not None:
            keep.append((state, z.copy(), r.copy(), before, cand))
        states[t] = state = new
    return states


def forward(x: np.ndarray, lengths: np.ndarray, weights: dict, keep: dict | None = None) -> np.ndarray:
    """Probabilities of windows from word features (steps x windows x FEATURES); places behind a length are empty."""
    steps = x.shape[0]
    flat = x.reshape(-1, FEATURES)
    gates = {s: (flat @ weights["W" + s]).reshape(steps, x.shape[1], -1) for s in "fb"}
    return forward_gates(gates["f"], gates["b"], lengths, weights, keep, x)


def forward_gates(gf: np.ndarray, gb: np.ndarray, lengths: np.ndarray, weights: dict, keep: dict | None = None, x=None) -> np.ndarray:
    steps = gf.shape[0]
    short = bool((lengths < steps).any())
    mask = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32) if short else None
    tape = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
    hf = _run(gf, weights["Uf"], mask, tape["f"])
    hb = _run(gb[::-1], weights["Ub"], mask[::-1] if short else None, tape["b"])[::-1]
    half = hf.shape[2]
    energy = hf @ weights["att"][:half] + hb @ weights["att"][half:]
    if short:
        energy = np.where(mask > 0, energy, np.float32(-1e9))
    share = np.exp(energy - energy.max(axis=0))
    share /= share.sum(axis=0)
    value = hf @ weights["out"][:half] + hb @ weights["out"][half:]
    logit = (share * value).sum(axis=0) + weights["bias"][0]
    if keep is not None:
        keep |= {"hf": hf, "hb": hb, "share": share, "value": value, "mask": mask, "tape": tape, "x": x, "logit": logit}
    return _sigmoid(logit)


def gradients(keep: dict, d_logit: np.ndarray, weights: dict) -> dict[str, np.ndarray]:
    """Back-propagation through attention and both directions."""
    hf, hb, share, value, x = keep["hf"], keep["hb"], keep["share"], keep["value"], keep["x"]
    half = hf.shape[2]
    mean = (share * value).sum(axis=0)
    d_value = share * d_logit
    d_energy = share * (value - mean) * d_logit
    grads = {"bias": np.array([d_logit.sum()], dtype=np.float32)}
    both = np.concatenate([hf, hb], axis=2)
    grads["out"] = np.einsum("tn,tnh->h", d_value, both)
    grads["att"] = np.einsum("tn,tnh->h", d_energy, both)
    d_both = d_value[:, :, None] * weights["out"] + d_energy[:, :, None] * weights["att"]
    for side, d_states in (("f", d_both[:, :, :half]), ("b", d_both[::-1, :, half:])):
        inputs = x if side == "f" else x[::-1]
        mask = keep["mask"] if side == "f" or keep["mask"] is None else keep["mask"][::-1]
        u = weights["U" + side]
        d_w, d_u = np.zeros_like(weights["W" + side]), np.zeros_like(u)
        carry = np.zeros_like(d_states[0])
        for t in range(len(d_states) - 1, -1, -1):
            state, z, r, before, cand = keep["tape"][side][t]
            d_new = d_states[t] + carry
            if mask is not None:
                d_new = d_new * mask[t][:, None]
            d_z = d_new * (state - cand) * z * (1 - z)
            d_cand = d_new * (1 - z) * (1 - cand * cand)
            d_r = d_cand * before * r * (1 - r)
            d_gate = np.concatenate([d_z, d_r, d_cand], axis=1)
            d_hidden = np.concatenate([d_z, d_r, d_cand * r], axis=1)
            d_w += inputs[t].T @ d_gate
            d_u += state.T @ d_hidden
            carry = d_new * z + d_hidden @ u.T
        grads["W" + side], grads["U" + side] = d_w, d_u
    return grads


def window_starts(n: int, cfg: Network) -> list[int]:
    """Starts of windows that cover n words; the last one ends with the text."""
    if n <= cfg.window:
        return [0] if n else []
    return [*range(0, n - cfg.window, cfg.stride), n - cfg.window]


@dataclass
class Model:
    tables: Tables
    weights: dict[str, np.ndarray]
    usual: float  # score of a text without words


_scorers: dict[str, Scorer] = {}


def scorer_of(key: str, model: Model, cfg: Network) -> Scorer:
    """The worker's scorer of the model called ``key``: what it has learned about words serves the worker's next tasks."""
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model, cfg)
    return _scorers[key]


class Scorer:
    """Scores texts; keeps the gate inputs of words it has met, up to ``cfg.cached_words``."""

    def __init__(self, model: Model, cfg: Network):
        self.model, self.cfg = model, cfg
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.features: list[list[float]] = []
        self.gates = np.zeros((0, 6 * self.cfg.hidden), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        index = self.index
        for word in words:
            if word not in index:
                index[word] = len(index)
                self.features.append(word_features(word, self.model.tables, self.cfg))
        return np.fromiter(map(index.__getitem__, words), np.int32, len(words))

    def _update_gates(self) -> None:
        if self.features:
            x = np.array(self.features, dtype=np.float32)
            weights = np.concatenate([self.model.weights["Wf"], self.model.weights["Wb"]], axis=1)
            self.gates = np.concatenate([self.gates, x @ weights])
            self.features = []

    def score(self, texts: list[str | None], chunk: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Score of each text, and the start of its worst window."""
        cfg, h3 = self.cfg, 3 * self.cfg.hidden
        if len(self.index) > cfg.cached_words:
            self._clear()
        ids, owner, starts, sizes, begins, total = [], [], [], [], [], 0
        for i, text in enumerate(texts):
            found = self._ids(words_in(text, cfg))
            own = window_starts(len(found), cfg)
            owner += [i] * len(own)
            starts += own
            begins += [total + s for s in own]
            sizes += [min(cfg.window, len(found))] * len(own)
            ids.append(found)
            total += len(found)
        self._update_gates()
        scores, worst = np.full(len(texts), self.model.usual), np.zeros(len(texts), np.int64)
        if not owner:
            return scores, worst
        flat = np.concatenate([*ids, np.zeros(cfg.window, np.int32)])
        sizes, begins = np.array(sizes), np.array(begins)
        order = np.argsort(sizes, kind="stable")  # windows of short texts together
        chances = np.empty(len(owner))
        for at in range(0, len(order), chunk):
            part = order[at : at + chunk]
            steps = int(sizes[part].max())
            gates = self.gates[flat[begins[part][None, :] + np.arange(steps)[:, None]]]
            chances[part] = forward_gates(gates[:, :, :h3], gates[:, :, h3:], sizes[part], self.model.weights)
        scores[np.array(owner)] = 0
        np.maximum.at(scores, owner, chances)
        for i, start, chance in zip(owner, starts, chances.tolist(), strict=True):
            if chance == scores[i]:
                worst[i] = start
        return scores, worst


def train(texts: list[str | None], labels: list[int], cfg: Network) -> Model:
    """Fit tables and network. With one kind of label only, every text gets that kind's share."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i] or "", labels[i]))
    texts, y = [texts[i] for i in order], np.array([labels[i] for i in order], dtype=np.float32)
    usual = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.0
    weights = initial(cfg)
    if not len(y) or y.min() == y.max():
        weights = {k: np.zeros_like(v) for k, v in weights.items()}
        weights["bias"] = np.array([np.log(max(usual, 1e-6) / (1 - usual))], np.float32)
        return Model(Tables(), weights, min(usual, 0.29) if not len(y) or not y.max() else usual)
    rng = np.random.default_rng(cfg.seed)
    known = lexicon(texts, cfg)
    fold = np.empty(len(y), np.int64)
    for label in (0, 1):
        here = rng.permutation(np.flatnonzero(y == label))
        fold[here] = np.arange(len(here)) % cfg.folds
    words, grams = known.counts(fold, y, cfg.folds)
    inputs: list[np.ndarray] = [np.zeros((0, FEATURES), np.float32)] * len(y)
    for k in range(cfg.folds):
        n_toxic, n_other = (float(((y == label) & (fold != k)).sum()) for label in (1, 0))
        odds = [_odds(c[:, 1].sum(axis=0) - c[k, 1], c[:, 0].sum(axis=0) - c[k, 0], n_toxic, n_other, cfg) for c in (words, grams)]
        rows = known.features(*odds)
        for i in np.flatnonzero(fold == k):
            inputs[i] = rows[known.docs[i]]
    able = [i for i in range(len(y)) if len(inputs[i])]
    # At first the window with the strongest inputs, later the one the network finds worst.
    chosen = {i: max(window_starts(len(inputs[i]), cfg), key=lambda s, i=i: inputs[i][s : s + cfg.window, [0, 2]].max(axis=0).sum()) for i in able}
    state: dict[str, list] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.items()}
    step = 0
    for turn in range(cfg.rounds):
        if turn:
            chosen = _worst_windows(inputs, able, weights, cfg)
        for _ in range(cfg.epochs):
            shuffled = rng.permutation(able)
            for at in range(0, len(shuffled), cfg.batch):
                part = shuffled[at : at + cfg.batch]
                x, lengths = _stack([inputs[i][chosen[i] : chosen[i] + cfg.window] for i in part])
                keep: dict = {}
                p = forward(x, lengths, weights, keep)
                grads = gradients(keep, ((p - y[part]) / len(part)).astype(np.float32), weights)
                step += 1
                for key, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m, v = state[key]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    weights[key] = weights[key] - cfg.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    odds = [_odds(c[:, 1].sum(axis=0), c[:, 0].sum(axis=0), float(y.sum()), float((1 - y).sum()), cfg) for c in (words, grams)]
    tables = Tables(_strongest(known.words, odds[0], cfg), _strongest(known.grams, odds[1], cfg))
    return Model(tables, {k: v.astype(np.float32) for k, v in weights.items()}, min(usual, 0.29))


def _stack(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in windows])
    x = np.zeros((lengths.max(), len(windows), FEATURES), np.float32)
    for i, w in enumerate(windows):
        x[: len(w), i] = w
    return x, lengths


def _worst_windows(inputs: list[np.ndarray], able: list[int], weights: dict, cfg: Network) -> dict[int, int]:
    pairs = [(i, s) for i in able for s in window_starts(len(inputs[i]), cfg)]
    best: dict[int, tuple[float, int]] = {}
    for at in range(0, len(pairs), 2048):
        part = pairs[at : at + 2048]
        chances = forward(*_stack([inputs[i][s : s + cfg.window] for i, s in part]), weights)
        for (i, s), chance in zip(part, chances.tolist(), strict=True):
            if i not in best or chance > best[i][0]:
                best[i] = chance, s
    return {i: s for i, (_, s) in best.items()}


def labelled_sample(
    docs: DataFrame, labels: DataFrame, cfg: Network, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> DataFrame:
    """(text, label) of at most ``cfg.toxic`` + ``cfg.other`` labelled documents, by hash of the id.

    A null label or id takes no part; an id labelled twice is labelled toxic if one of its rows is. Of the texts that share
    an id the one with the smallest hash is taken.
    """
    marks = labels.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{toxic}`").cast("int").alias("label"))
    marks = marks.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    picked = []
    for label, most in ((1, cfg.toxic), (0, cfg.other)):
        picked.append(marks.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(most))
    sample = F.broadcast(picked[0].union(picked[1]))  # as many rows as the two bounds at most
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = texts.join(sample, "id").groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return found.select("text", (F.col("label") > 0).cast("int").alias("label"))


def training_sample(docs: DataFrame, labels: DataFrame, cfg: Network, **columns: str) -> tuple[list[str | None], list[int]]:
    """Texts and labels of ``labelled_sample``."""
    found = labelled_sample(docs, labels, cfg, **columns).collect()
    return [r.text for r in found], [r.label for r in found]


def train_in_task(sample: DataFrame, cfg: Network) -> Model:
    """``train`` on a bounded (text, label) table in one task of an executor, so that only the model reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), ARROW_SAMPLE)
        model = train(rows.column("text").to_pylist(), rows.column("label").to_pylist(), cfg)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found.model) if found else train([], [], cfg)


ARROW_SAMPLE = pa.schema([("text", pa.string()), ("label", pa.int32())])


def score_documents(docs: DataFrame, model: Model, cfg: Network = Network(), text: str = "text", score: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score``, 0 to 1; the text column only with ``keep_text``.

    A text without words (null, empty, signs only) gets the sample's share of toxic documents, below 0.3. Repeated rows
    are scored alike. A column already called like ``score`` is replaced.
    """
    rest = [c for c in docs.columns if c != score and (keep_text or c != text)]
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    schema = docs.select(*[f"`{c}`" for c in rest], F.lit(0.0).alias(score)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(key, shared.value, cfg)
        for batch in batches:
            for part in slices(batch, "__text", 2 << 20):
                scores, _ = scorer.score(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores)], names=[*rest, score])

    body = F.col(f"`{text}`").cast("string").alias("__text")
    return docs.select(*[f"`{c}`" for c in rest], body).mapInArrow(run, schema)
