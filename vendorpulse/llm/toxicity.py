"""Toxicity by class-conditional Kneser-Ney models.

Two normalised models, of ordinary and of toxic texts, give the probability of
each word after the word before it; a text's evidence is the difference of
their log-likelihoods, divided by its number of words.

* Shared: one interpolated Kneser-Ney model of both classes' counts, a word
  given the word before it, which backs off to the words alone, and those, by
  their discounts, to all words never seen.
* Class: at each order a class multiplies the shared probability by (count +
  prior) / (expected + prior), where the shared model and its own words expect
  so many of its counts, and divides by the sum over all words.  So both classes
  back off through the same counts, and where one has nothing of its own it has
  the shared probability.
* Letters: models of the same kind, of each byte of a word after the ``ORDER - 1``
  before, tell the classes apart from order ``SHARED`` + 1 on.  They tilt a
  word's expectation before its own counts do, and spread the probability of
  all words never seen.

So what is rare, or equally frequent in both classes, tells next to nothing.
Counts are of texts (in how many different ones a word or pair stands), as
Kneser-Ney counts contexts: a word that one text repeats counts once.

A toxic text is ordinary but for some words, so the toxic model is the mixture
``(1 - rate) ordinary + rate toxic``, which is normalised as its parts are; the
rate is the one of ``RATES`` (1: the toxic model alone) whose logistic curve
fits labelled rows best that counted for neither model.  The curve turns
evidence into a score, and keeps its order.

Counts come from at most about ``per_class`` labelled rows of each class, by
hash of the id; fold 0 of 5 is never used, fold 4 only fits the curve and the
rate.  If fold 4 lacks a class the curve is a fixed one.  Letters, words and contexts of
the sampled rows pass the driver; pairs don't.  All lie as sorted arrays in the
shared folder, which workers memory-map; pairs by shard of their first words.  All documents are scored, whole.

Nulls and empty texts have no words and the score of no evidence.  A null
``doc_id`` is scored, and never learnt from.  Rows with several labels count as
toxic if one of them is.  With no labelled row of either class every score is
0.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, free_name, map_arrow, shared_path, stored
from .ngram import Discounts, get, put
from .words import ALNUM_WORDS, U64, Words, mix, slices, split_words

SHARDS = 16  # of the pairs, by the highest bits of their first words' hashes
#: priors, in counts, of letters, words and pairs: by loss and recall by language on each of folds 1 to 4, learnt from the
#: three others
LETTERS, WORDS, PAIRS = 3.0, 1.0, 30.0
ORDER, SHARED = 6, 2
RATES = (0.002, 0.005, 0.01, 0.02, 0.05, 0.2, 1.0)
CLASSES = ("ordinary", "toxic")


def expression_counts(column: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (first 0) and pairs of neighbours (first, second), and in how many ordinary and toxic texts each is."""
    w = split_words(column, ALNUM_WORDS, lower=True)
    h, doc = w.hashes(), w.doc()
    at = np.flatnonzero(doc[1:] == doc[:-1])
    first, second = np.append(np.zeros(len(h), U64), h[at]), np.append(h, h[at + 1])
    doc = np.append(doc, doc[at])
    keys, where, back = np.unique(pair_keys(first, second), return_index=True, return_inverse=True)
    texts = np.unique(back * (len(column) + 1) + doc)  # a text counts a word or pair once
    key, toxic = texts // (len(column) + 1), labels[texts % (len(column) + 1)].astype(bool)
    sums = np.stack([np.bincount(key[~toxic], minlength=len(keys)), np.bincount(key[toxic], minlength=len(keys))], 1)
    return first[where], second[where], sums


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One key of each pair; that of a word alone (first 0) is the word's hash."""
    return np.where(first == 0, second, mix(first * U64(0x9E3779B97F4A7C15) + second))


def _mask(k: int) -> np.uint64:
    return U64((1 << 8 * k) - 1)


def letter_keys(w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the words at ``at``, and the blank after each: the last ORDER bytes, and the word's rank."""
    size = (w.ends - w.starts)[at] + 1
    word = np.repeat(np.arange(len(at)), size)
    pos = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    letters = w.data[w.starts[at][word] + pos]
    letters[np.cumsum(size) - 1] = 0x20
    keys = np.zeros(len(letters), U64)
    for i in range(ORDER):
        byte = np.full(len(letters), 0x20, U64)
        byte[i:] = np.where(pos[i:] >= i, letters[: len(letters) - i], 0x20)
        keys |= byte << U64(8 * i)
    return keys, word


def letter_counts(column: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ORDER letters, and their counts in the different words of ordinary and toxic texts, each once a text."""
    w = split_words(column, ALNUM_WORDS, lower=True)
    h, doc = w.hashes(), w.doc()
    words, first, which = np.unique(h, return_index=True, return_inverse=True)
    texts = np.unique(which * (len(column) + 1) + doc)
    word, toxic = texts // (len(column) + 1), labels[texts % (len(column) + 1)].astype(bool)
    weight = np.stack([np.bincount(word[~toxic], minlength=len(words)), np.bincount(word[toxic], minlength=len(words))], 1)
    keys, of = letter_keys(w, first)
    return _summed([(keys, weight[of])])


def _summed(parts):
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.concatenate([c for _, c in parts])
    return keys, np.stack([np.bincount(where, n[:, c], len(keys)) for c in (0, 1)], 1).astype(np.int64)


def _shard(keys: np.ndarray) -> np.ndarray:
    return (keys >> U64(60)).astype(np.int32)


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among the sorted ``known`` ones, and whether it is one."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def discounts_of(counts: np.ndarray) -> Discounts:
    return Discounts.fit(np.array([(counts == i).sum() for i in (1, 2, 3, 4)]))


@dataclass
class Letters:
    """Probabilities of a byte after the bytes before it: columns shared, ordinary, toxic."""

    orders: list          # of each order: contexts in order, their factors of unseen bytes, keys in order, probabilities

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray) -> Letters:
        """From the counts (ordinary, toxic) of the highest order."""
        orders = {ORDER: (keys, counts)}
        for k in range(ORDER - 1, 0, -1):  # how many different bytes come before
            up, n = orders[k + 1]
            low, where = np.unique(up & _mask(k), return_inverse=True)
            orders[k] = low, np.stack([np.bincount(where, n[:, c] > 0, len(low)) for c in (0, 1)], 1).astype(np.int64)
        out = []
        for k in range(1, ORDER + 1):
            own, n = orders[k]
            context, at = np.unique(own >> U64(8), return_inverse=True)
            total, both = np.stack([np.bincount(at, n[:, c], len(context)) for c in (0, 1)], 1), n.sum(axis=1)
            off, every = discounts_of(both)(both), np.maximum(total.sum(axis=1), 1)
            rest = np.bincount(at, off, len(context)) / every
            lower = np.full((len(own), 3), 1 / 256) if k == 1 else out[-1][3][np.searchsorted(out[-1][2], own & _mask(k - 1))]
            shared = (both - off) / every[at] + rest[at] * lower[:, 0]
            p = shared[:, None] * lower / lower[:, :1]
            if k > SHARED:
                p[:, 1:] *= (n + LETTERS) / (total[at] * p[:, 1:] + LETTERS)
            scale = np.stack([np.bincount(at, p[:, c], len(context)) + rest * np.maximum(1 - np.bincount(at, lower[:, c], len(context)), 0)
                              for c in range(3)], 1)
            out.append((context, rest[:, None] / scale, own, p / scale[at]))
        return cls(out)

    def of_keys(self, keys: np.ndarray) -> np.ndarray:
        """Of each key's last byte."""
        p = np.full((len(keys), 3), 1 / 256)
        for k, (context, back, own, own_p) in enumerate(self.orders, 1):
            at, known = _find(context, (keys & _mask(k)) >> U64(8))
            p[known] *= back[at[known]]
            at, known = _find(own, keys & _mask(k))
            p[known] = own_p[at[known]]
        return p

    def of_words(self, w: Words, at: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of the words at ``at``."""
        keys, word = letter_keys(w, at)
        once, back = np.unique(keys, return_inverse=True)
        p = np.log(self.of_keys(once))[back]
        return np.stack([np.bincount(word, p[:, c], len(at)) for c in range(3)], 1)


@dataclass
class Model:
    """Both classes' models: column 0 ordinary, column 1 toxic."""

    rate: float = 1.0
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))    # sorted hashes
    shared: np.ndarray = field(default_factory=lambda: np.zeros(0))        # their shared probabilities
    p: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))        # their probabilities
    unseen: np.ndarray = field(default_factory=lambda: np.ones(2))         # that of all other words together
    letters: Letters | None = None
    folder: str = ""                                                       # where its arrays lie
    shards: tuple = ()                                                     # shards that hold pairs
    slope: float = 1.0
    offset: float = 0.0

    def save(self, folder: str) -> None:
        """Write the arrays; from now on the model is sent as the folder's name."""
        for name in ("words", "shared", "p"):
            put(folder, name, getattr(self, name))
        for k, order in enumerate(self.letters.orders):
            for i, x in enumerate(order):
                put(folder, f"letters-{k}-{i}", x)
        self.folder = folder

    def __getstate__(self) -> dict:
        arrays = ("words", "shared", "p", "letters") if self.folder else ()
        return {k: v for k, v in self.__dict__.items() if k not in arrays}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        if self.folder:
            self.words, self.shared, self.p = (get(self.folder, name) for name in ("words", "shared", "p"))
            self.letters = Letters([tuple(get(self.folder, f"letters-{k}-{i}") for i in range(4)) for k in range(ORDER)])

    def fit_words(self, words: np.ndarray, counts: np.ndarray, spelt: np.ndarray) -> None:
        """From the words' counts (ordinary, toxic) and their logarithms by letters (shared, ordinary, toxic)."""
        order = np.argsort(words)
        self.words, n, spelt = words[order], counts[order], spelt[order]
        both = n.sum(axis=1)
        off, total = discounts_of(both)(both), both.sum()
        self.shared, rest = (both - off) / total, off.sum() / total
        first = self.shared[:, None] * np.exp(np.clip(spelt[:, 1:] - spelt[:, :1], -20, 20))
        first /= first.sum(axis=0) / self.shared.sum()
        tilted = first * (n + WORDS) / (n.sum(axis=0) * first + WORDS)
        scale = tilted.sum(axis=0) + rest
        self.p = tilted / scale
        # all other words: what the letters leave to them
        self.unseen = rest / scale / np.maximum(1 - np.exp(spelt[:, 1:]).sum(axis=0), 1e-3)

    def weighed(self, second: np.ndarray, n: np.ndarray, total: np.ndarray, off: np.ndarray,
                discounts: Discounts) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs with counts ``n``: their tilted probabilities, not yet divided by a context's sum, and their second words'.

        ``total`` and ``off``: the counts (ordinary, toxic) and all discounts of the pairs' contexts.
        """
        at, _ = _find(self.words, second)
        both, every = n.sum(axis=1), total.sum(axis=1)
        p = (both - discounts(both)) / every + off / every * self.shared[at]
        expected = p[:, None] * self.p[at] / self.shared[at][:, None]
        return expected * (n + PAIRS) / (total * expected + PAIRS), self.p[at]

    def alone(self, w: Words, at: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Both classes' probabilities of the words at ``at``, whose hashes are ``h``; of words never seen relative to
        the shared letters'."""
        place, known = _find(self.words, h)
        p = self.p[place]
        new = np.flatnonzero(~known)
        if len(new):
            spelt = self.letters.of_words(w, at[new])
            p[new] = self.unseen * np.exp(np.clip(spelt[:, 1:] - spelt[:, :1], -20, 20))
        return p

    def after(self, first: np.ndarray, second: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Both classes' probabilities of words after others, from those of the words alone."""
        out, keys, shard = p.copy(), pair_keys(first, second), _shard(first)
        for i in self.shards:
            mine = np.flatnonzero(shard == i)
            at, known = _find(get(self.folder, f"{i}-first"), first[mine])
            mine, at = mine[known], at[known]
            out[mine] *= get(self.folder, f"{i}-back")[at]
            at, known = _find(get(self.folder, f"{i}-keys"), keys[mine])
            out[mine[known]] = get(self.folder, f"{i}-pairs")[at[known]]
        return out

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the words that stand before others, and the factors of words that they weren't seen before."""
        if not self.shards:
            return np.zeros(0, U64), np.zeros((0, 2))
        return tuple(np.concatenate([get(self.folder, f"{i}-{name}") for i in self.shards]) for name in ("first", "back"))

    def word_ratios(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The text of each word, and toxic / ordinary probability after the word before it."""
        w = split_words(column, ALNUM_WORDS, lower=True)
        h, doc = w.hashes(), w.doc()
        if not len(h) or not len(self.words):
            return doc, np.ones(len(h))
        words, where, which = np.unique(h, return_index=True, return_inverse=True)
        p = self.alone(w, where, words)[which]
        at = np.flatnonzero(doc[1:] == doc[:-1]) + 1
        keys, where, back = np.unique(pair_keys(h[at - 1], h[at]), return_index=True, return_inverse=True)
        at_once = at[where]
        p[at] = self.after(h[at_once - 1], h[at_once], p[at_once])[back]
        return doc, p[:, 1] / p[:, 0]

    def evidence(self, column: pa.Array, rates: tuple[float, ...] = ()) -> tuple[np.ndarray, ...]:
        """Per text: number of words, evidence (at each of ``rates``, or the model's)."""
        doc, ratio = self.word_ratios(column)
        total = np.bincount(doc, minlength=len(column))
        return total, *(np.bincount(doc, np.log(1 - rate + rate * ratio), len(column)) / np.maximum(total, 1)
                        for rate in rates or (self.rate,))

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(self.slope * _scale(evidence) + self.offset, -500, 500)))

    def loss(self, evidence: np.ndarray, labels: np.ndarray) -> float:
        p = np.clip(self.scores(evidence), 1e-9, 1 - 1e-9)
        return -float(np.log(np.where(labels == 1, p, 1 - p)).sum())

    def calibrate_rate(self, evidence: list[np.ndarray], labels: np.ndarray, rates: tuple[float, ...]) -> None:
        """The curve, and the rate of ``rates`` with which it fits best."""
        found = []
        for rate, e in zip(rates, evidence):
            self.calibrate(e, labels)
            found.append((self.loss(e, labels), rate, self.slope, self.offset))
        _, self.rate, self.slope, self.offset = min(found)

    def calibrate(self, evidence: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve over the scaled evidence, with targets drawn in by one row of each class."""
        x, pos, neg = _scale(evidence), labels.sum(), (1 - labels).sum()
        if not pos or not neg:
            self.slope, self.offset = 2.0, -2.0 * float(_scale(np.array([0.2]))[0])
            return
        y = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
        centre, spread = x.mean(), x.std() or 1.0
        z, a, b = (x - centre) / spread, 1.0, 0.0
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            r = p * (1 - p)
            g = np.array([((p - y) * z).sum() + 1e-3 * a, (p - y).sum()])
            hess = np.array([[(r * z * z).sum() + 1e-3, (r * z).sum()], [(r * z).sum(), r.sum() + 1e-9]])
            step = np.clip(np.linalg.solve(hess, g), -5, 5)
            a, b = a - step[0], b - step[1]
        a = max(a, 1e-3)
        self.slope, self.offset = float(a / spread), float(b - a * centre / spread)


def _scale(evidence: np.ndarray) -> np.ndarray:
    return np.arcsinh(100 * evidence)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        per_class: int = 10_000, rate: float | None = None) -> Model:
    own = (labels.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("toxic"))
           .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .where(fold("doc_id", 5) != 0))
    sizes = {r.toxic: r.n for r in own.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(rate or RATES[0])
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    picked = own.where("toxic in (0, 1)").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    rows = stored(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
                  .join(F.broadcast(picked), "doc_id")  # about 2 * per_class ids
                  .select("text", "toxic", (fold("doc_id", 5) == 4).alias("apart")), "toxicity-labelled")
    model = count(rows.where("not apart").select("text", "toxic"), rate or RATES[0])
    rates = RATES if rate is None else (rate,)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apart(batches):
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*map(pa.array, sent.value.evidence(b.column("text"), rates)[1:]),
                                              b.column("toxic")], [*(f"e{i}" for i in range(len(rates))), "toxic"])
    seen = map_arrow(rows.where("apart").select("text", "toxic"), apart,
                     ", ".join([*(f"e{i} double" for i in range(len(rates))), "toxic int"])).toPandas()
    model.calibrate_rate([seen[f"e{i}"].to_numpy(float) for i in range(len(rates))], seen["toxic"].to_numpy(float), rates)
    return model


def count(learnt: DataFrame, rate: float) -> Model:
    """Both classes' models from rows (text, toxic); the curve is not fitted."""
    def run(batches):
        held = []
        for b in slices(batches, "text"):
            held.append(expression_counts(b.column("text"), b.column("toxic").to_numpy()))
            if sum(len(x[0]) for x in held) > 2_000_000:
                held = [_summed_expressions(held)]
        if held:
            first, second, n = _summed_expressions(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_shard(first)), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                 pa.array(n[:, 0]), pa.array(n[:, 1])], ["shard", "first", "second", *CLASSES])

    said = stored(map_arrow(learnt, run, "shard int, first long, second long, ordinary long, toxic long")
                  .groupBy("shard", "first", "second").agg(*(F.sum(c).alias(c) for c in CLASSES)), "toxicity-expressions")
    def run_letters(batches):
        held = []
        for b in slices(batches, "text"):
            held.append(letter_counts(b.column("text"), b.column("toxic").to_numpy()))
            if sum(len(k) for k, _ in held) > 2_000_000:
                held = [_summed(held)]
        if held:
            keys, n = _summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], ["key", *CLASSES])

    model = Model(rate)
    grams = (map_arrow(learnt, run_letters, "key long, ordinary long, toxic long").groupBy("key")
             .agg(*(F.sum(c).alias(c) for c in CLASSES)).toArrow())
    if not len(grams):
        return model
    order = np.argsort(_hashes(grams, "key"))
    model.letters = letters = Letters.fit(_hashes(grams, "key")[order], _columns(grams, *CLASSES)[order])

    own = shared_path(learnt.sparkSession, "toxicity")
    model.save(own)
    sent = model  # as the folder's name

    def spell(batches):
        known = np.zeros(0, U64)
        for b in slices(batches, "text"):
            w = split_words(b.column("text"), ALNUM_WORDS, lower=True)
            h, at = np.unique(w.hashes(), return_index=True)
            new = ~_find(known, h)[1]
            h, at = h[new], at[new]
            if len(known) < 2_000_000:
                known = np.union1d(known, h)
            spelt = sent.letters.of_words(w, at)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *map(pa.array, spelt.T)], ["second", "a", "b", "c"])

    spelt = map_arrow(learnt, spell, "second long, a double, b double, c double").groupBy("second").agg(
        *(F.min(c).alias(c) for c in "abc"))
    alone = said.where("first = 0").select("second", *CLASSES).join(spelt, "second").toArrow()
    model.fit_words(_hashes(alone, "second"), _columns(alone, *CLASSES), np.stack([alone.column(c).to_numpy() for c in "abc"], 1))
    model.save(shared_path(learnt.sparkSession, "toxicity"))
    _fit_pairs(model, said.where("first <> 0"))
    return model


def _fit_pairs(model: Model, pairs: DataFrame) -> None:
    """The contexts' backoff and the pairs' probabilities, in files by shard: a shard holds all pairs of its contexts."""
    both = F.col("ordinary") + F.col("toxic")
    discounts = Discounts.fit(np.array(pairs.agg(*(F.count_if(both == i) for i in (1, 2, 3, 4))).first()))

    def write(batches):
        parts = [(b.column("first").to_numpy().view(U64), b.column("second").to_numpy().view(U64),
                  np.stack([b.column(c).to_numpy() for c in CLASSES], 1)) for b in batches]
        if not parts:
            return
        first, second, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        names, at = np.unique(first, return_inverse=True)
        sums = lambda x: np.stack([np.bincount(at, c, len(names)) for c in x.T], 1)
        total, off = sums(n), np.bincount(at, discounts(n.sum(axis=1)), len(names))
        own, alone = model.weighed(second, n, total[at], off[at], discounts)
        rest = (off / total.sum(axis=1))[:, None]
        scale = sums(own) + rest * np.maximum(1 - sums(alone), 0)
        keys, p = pair_keys(first, second), own / scale[at]
        done = np.unique(_shard(names))
        for i in done.tolist():
            mine = np.flatnonzero(_shard(first) == i)
            mine = mine[np.argsort(keys[mine])]
            put(model.folder, f"{i}-keys", keys[mine])
            put(model.folder, f"{i}-pairs", p[mine])
            own_names = _shard(names) == i
            put(model.folder, f"{i}-first", names[own_names])
            put(model.folder, f"{i}-back", (rest / scale)[own_names])
        yield pa.RecordBatch.from_arrays([pa.array(done)], ["shard"])

    done = map_arrow(pairs.repartition(SHARDS, "shard"), write, "shard int").collect()
    model.shards = tuple(sorted(r.shard for r in done))


def _summed_expressions(parts):
    first, second, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
    keys, at, where = np.unique(pair_keys(first, second), return_index=True, return_inverse=True)
    return first[at], second[at], np.stack([np.bincount(where, n[:, c], len(keys)) for c in (0, 1)], 1).astype(np.int64)


def _hashes(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().view(U64)


def _columns(table: pa.Table, *columns: str) -> np.ndarray:
    return np.stack([table.column(c).to_numpy().astype(np.int64) for c in columns], 1)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, last, one struct column ``toxicity`` (score, evidence, words)."""
    out = free_name(docs, "toxicity")
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(out, T.StructType.fromDDL("score double, evidence double, words long"))])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, text):
            words, evidence = sent.value.evidence(b.column(text))
            struct = pa.StructArray.from_arrays([pa.array(sent.value.scores(evidence)), pa.array(evidence),
                                                 pa.array(words.astype(np.int64))], ["score", "evidence", "words"])
            yield pa.RecordBatch.from_arrays([*b.columns, struct], [*b.schema.names, out])
    return docs.mapInArrow(run, schema)


def ordinary(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that aren't toxic, with their columns."""
    judged = score(docs, model, text)
    return judged.where(judged[judged.columns[-1]]["score"] < 0.5).select(*(judged[f"`{c}`"] for c in docs.columns))
