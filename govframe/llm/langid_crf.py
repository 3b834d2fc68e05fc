"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled; its neighbours speak through learned transitions, so text that
switches language is labelled piece by piece.  A word's features are its affixes, its character
n-grams and, for frequent words, the word itself (the lexicon).  Weights and transitions are learned together by
maximum conditional likelihood; labels come from forward-backward marginals.  A document's language
is the one with the largest share of the marginals, and that share is its score.

Training takes a bounded sample, ``Sample``: some rows of each language, each giving short runs
spread over its whole text; runs of different documents are chained, so switches are seen.  It is
fitted on the driver, and the model (bounded by ``Sample.features``) is broadcast.  Prediction reads only
the text: whole texts, in one map without a shuffle.  Long texts are cut into segments that are joined exactly through their
transfer matrices, so the chain is as long as the text.

Words are runs of letters, lower-cased.  Null text, or text without a letter: ``und`` with score 0.  With nothing to learn
from, every row is ``und``.  An empty table gives no rows.  A very long text is labelled in one task, which holds it, its words and
some hundred bytes of numbers a word.  Repeated rows are labelled alike.  Ties go to the first language in order of its name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from govframe.llm.common import map_texts

UNKNOWN = "und"
SEGMENT = 64
BLOCK_WORDS = 400_000
KNOWN_WORDS = 250_000

_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Sample:
    """Bounds of training: languages (those with the most labelled rows are learned, ties by name), rows of each, runs of each row,
    words of each run and chain; least count and number of features.  Few languages reach the driver, however dirty ``lang`` is."""

    langs: int = 200
    rows: int = 250
    runs: int = 12
    run_words: int = 14
    chain_words: int = 56
    least: int = 3
    features: int = 200_000
    rounds: int = 60


def words_of(text: str | None) -> list[str]:
    """Runs of letters; a run of other alphanumerics without any letter is none."""
    if not text:
        return []
    words = _WORDS.findall(text.lower())
    return words if text.isascii() else [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def features_of(word: str) -> list[str]:
    """Affixes, character n-grams and the word itself."""
    edged = f"^{word}$"
    out = [f"={word}", edged[:2], edged[:3], edged[:4], edged[-2:], edged[-3:], edged[-4:]]
    out += [edged[i : i + 3] for i in range(1, len(edged) - 3)]
    out += [edged[i : i + 2] for i in range(1, len(edged) - 2)]
    if not word.isascii():
        out += [c for c in word if not c.isascii()]
    return out


@dataclass
class Model:
    """Languages, feature rows, weights (features x languages), transitions and start weights."""

    langs: list[str]
    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    rows: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of each word and language; known words are looked up."""
        if self.table is None or len(self.rows) > KNOWN_WORDS:
            self.rows, self.table = {}, np.zeros((1024, len(self.langs)), np.float32)
        rows = self.rows
        new = [w for w in dict.fromkeys(words) if w not in rows]
        if new:
            found = [[i for f in features_of(w) if (i := self.index.get(f)) is not None] or [-1] for w in new]
            cuts = np.cumsum([0, *map(len, found[:-1])])
            flat = np.fromiter((i for x in found for i in x), np.int64)
            sums = np.add.reduceat(np.where(flat[:, None] >= 0, self.weights[flat], 0), cuts, axis=0)
            at = len(rows)
            while at + len(new) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[at : at + len(new)] = sums
            rows.update(zip(new, range(at, at + len(new)), strict=True))
        return self.table[np.fromiter(map(rows.__getitem__, words), np.int64, len(words))]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-30)


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Forward-backward marginals of all words of several texts laid end to end.

    Texts are cut into segments.  All segments first give their transfer matrices, side by side; the
    messages at the segments' edges follow along each text; then all segments run forward and backward
    from them, side by side.  The result is that of one chain per text.
    """
    langs = scores.shape[1]
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    p, first = np.exp(moves - moves.max()), _scaled(np.exp(start - start.max()))
    counts = -(-lengths // segment)  # segments of each text
    text_of = np.repeat(np.arange(len(lengths)), counts)
    begins = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    seg_first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    place = np.arange(len(text_of)) - seg_first[text_of]
    at = begins[text_of] + place * segment
    size = np.minimum(segment, lengths[text_of] - place * segment)
    order = np.argsort(-size, kind="stable")  # full segments first: the segments still running are a prefix
    at, size, place, text_of = at[order], size[order], place[order], text_of[order]
    running = [int(np.searchsorted(-size, -t, side="left")) for t in range(segment)]  # segments longer than t
    spots = np.empty(len(order), np.int64)
    spots[order] = np.arange(len(order))

    head = place == 0  # a text's first segment begins with the start weights, the others with a move
    transfer = np.where(head[:, None, None], np.eye(langs), p) * e[at][:, None, :]
    for t in range(1, segment):
        n = running[t]
        if n:
            step = (transfer[:n] @ p) * e[at[:n] + t][:, None, :]
            transfer[:n] = step / np.maximum(step.sum(axis=(1, 2), keepdims=True), 1e-300)

    # messages into each segment from the left (before its first move) and from the right
    entering, leaving = np.broadcast_to(first, (len(at), langs)).copy(), np.ones((len(at), langs))
    most = int(counts.max(initial=0))
    by_count = np.argsort(-counts, kind="stable")
    with_segment = [int(np.searchsorted(-counts[by_count], -k, side="left")) for k in range(most)]
    for k in range(1, most):
        texts = by_count[: with_segment[k]]
        before, here = spots[seg_first[texts] + k - 1], spots[seg_first[texts] + k]
        entering[here] = _scaled((entering[before][:, None, :] @ transfer[before])[:, 0, :])
    for k in range(most - 2, -1, -1):
        texts = by_count[: with_segment[k + 1]]
        here, after = spots[seg_first[texts] + k], spots[seg_first[texts] + k + 1]
        leaving[here] = _scaled((transfer[after] @ leaving[after][:, :, None])[:, :, 0])

    forward = np.empty((len(scores), langs))
    state = np.where(head[:, None], first, _scaled(entering @ p))  # prediction of the segment's first word
    for t in range(segment):
        n = running[t]
        if n:
            state[:n] = _scaled(state[:n] * e[at[:n] + t])
            forward[at[:n] + t] = state[:n]
            state[:n] = _scaled(state[:n] @ p)
    back = leaving.copy()
    out = np.empty((len(scores), langs))
    for t in range(segment - 1, -1, -1):
        n = running[t]
        if n:
            out[at[:n] + t] = _scaled(forward[at[:n] + t] * back[:n])
            back[:n] = _scaled((e[at[:n] + t] * back[:n]) @ p.T)
    return out


class Trainer:
    """Fits the field to chains of labelled words by gradient steps over the whole sample."""

    def __init__(self, chains: list[list[tuple[str, int]]], langs: list[str], sample: Sample):
        self.langs, self.sample = langs, sample
        self.length = max(map(len, chains))
        types = {w: i for i, w in enumerate(dict.fromkeys(w for c in chains for w, _ in c))}
        uses = Counter(w for c in chains for w, _ in c)
        counted: Counter = Counter()
        for w in types:
            for f in set(features_of(w)):
                counted[f] += uses[w] if f[0] == "=" else 1
        kept = sorted((f for f, n in counted.items() if n >= sample.least), key=lambda f: (-counted[f], f))[: sample.features]
        self.index = {f: i for i, f in enumerate(kept)}
        pairs = np.array([(t, self.index[f]) for w, t in types.items() for f in features_of(w) if f in self.index], np.int64).reshape(-1, 2)
        self.type_of, self.feature_of = pairs[:, 0], pairs[:, 1]
        self.n_types = len(types)
        self.words = np.zeros((len(chains), self.length), np.int64)
        self.gold = np.zeros((len(chains), self.length), np.int64)
        self.mask = np.zeros((len(chains), self.length), bool)
        for i, c in enumerate(chains):
            for t, (w, y) in enumerate(c):
                self.words[i, t], self.gold[i, t], self.mask[i, t] = types[w], y, True

    def gradient(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Observed minus expected counts."""
        langs, n = len(self.langs), len(self.words)
        table = np.stack([np.bincount(self.type_of, weights[self.feature_of, y], self.n_types) for y in range(langs)], axis=1)
        e = table[self.words]
        e = np.exp(e - e.max(axis=2, keepdims=True))
        p = np.exp(moves - moves.max())
        forward = np.empty((self.length, n, langs))
        state = np.broadcast_to(np.exp(start - start.max()), (n, langs))
        for t in range(self.length):
            on = self.mask[:, t, None]
            forward[t] = np.where(on, _scaled((forward[t - 1] @ p if t else state) * e[:, t]), forward[t - 1] if t else state)
        back, expected, switched = np.ones((n, langs)), np.zeros((self.n_types, langs)), np.zeros((langs, langs))
        d_start = np.zeros(langs)
        for t in range(self.length - 1, -1, -1):
            on = self.mask[:, t]
            marginal = _scaled(forward[t] * back)[on]
            for y in range(langs):
                expected[:, y] += np.bincount(self.words[on, t], marginal[:, y], self.n_types)
            if t:
                ahead = e[:, t] * back
                joint = forward[t - 1][:, :, None] * p * ahead[:, None, :]
                switched += (joint[on] / joint[on].sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                back = np.where(on[:, None], _scaled(ahead @ p.T), back)
            else:
                d_start -= marginal.sum(axis=0)
        d_start += np.bincount(self.gold[:, 0], minlength=langs)
        observed = np.stack([np.bincount(self.words[self.mask & (self.gold == y)], minlength=self.n_types) for y in range(langs)], axis=1)
        both = self.mask[:, 1:]
        moved = np.bincount(self.gold[:, :-1][both] * langs + self.gold[:, 1:][both], minlength=langs * langs).reshape(langs, langs)
        rest = observed - expected
        d_weights = np.stack([np.bincount(self.feature_of, rest[self.type_of, y], len(weights)) for y in range(langs)], axis=1)
        return d_weights, moved - switched, d_start

    def fit(self) -> Model:
        shapes = ((max(1, len(self.index)), len(self.langs)), (len(self.langs),) * 2, (len(self.langs),))
        at = [np.zeros(s) for s in shapes]
        m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        for k in range(1, self.sample.rounds + 1):
            for i, g in enumerate(self.gradient(*at)):
                g = g / self.mask.sum() - 1e-6 * at[i]
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
                at[i] = at[i] + 0.1 * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-9)
        return Model(self.langs, self.index, at[0].astype(np.float32), at[1], at[2])


def held_out() -> Column:
    """Rows that are never learned from: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(spark: SparkSession, docs: DataFrame, sample: Sample = Sample()) -> Model | None:
    """The field fitted to a bounded sample of the rows that are not held out; None without labelled words."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.filter(F.col("doc_id").isNotNull() & ~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    most = labelled.filter(F.col("lang") != UNKNOWN).groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample.langs)
    counts = {r["lang"]: r["n"] for r in most.collect()}
    if not counts:
        return None
    space = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(space))
    likely = F.lit(False)  # about four times the rows that are wanted, so that few texts travel
    for lang, n in counts.items():
        likely = likely | ((F.col("lang") == lang) & (draw < min(space, int(space * 4 * sample.rows / n) + 1)))
    few = labelled.filter(likely).withColumn("draw", draw)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))

    def runs(rows: Iterator[tuple]) -> Iterator[tuple]:
        for draw_, lang, text in rows:
            words = words_of(text)
            n = min(sample.runs, -(-len(words) // sample.run_words))
            for i in range(n):  # evenly over the whole text
                at = (len(words) - sample.run_words) * i // max(1, n - 1) if n > 1 else 0
                yield draw_, lang, words[max(0, at) : max(0, at) + sample.run_words]

    fields = [("draw", "long", pa.int64()), ("lang", "string", pa.string()), ("words", "array<string>", pa.list_(pa.string()))]
    chosen = few.withColumn("place", first).filter(F.col("place") <= sample.rows).select("draw", "lang", "text")
    rows = [(r["draw"], r["lang"], r["words"]) for r in map_texts(chosen, runs, fields, "draw", "lang", "text").toLocalIterator() if r["words"]]
    if not rows:
        return None
    langs = sorted(counts)
    code = {lang: i for i, lang in enumerate(langs)}
    rows.sort()
    rng = np.random.default_rng(7)
    chains, chain = [], []
    order = rng.permutation(len(rows))
    at = 0
    while at < len(order):
        same = rng.integers(1, 5)  # a few runs of one language, then another
        lang = rows[order[at]][1]
        while at < len(order) and same:
            _, of, words = rows[order[at]]
            chain += [(w, code[of]) for w in words]
            at, same = at + 1, same - 1 if of == lang else 0
            if len(chain) >= sample.chain_words:
                chains.append(chain[: sample.chain_words])
                chain = chain[sample.chain_words :]
    chains += [chain] if chain else []
    return Trainer(chains, langs, sample).fit()


def label(spark: SparkSession, docs: DataFrame, model: Model | None, runs: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, n_words, n_switches; with ``runs`` also the labelled runs of words."""
    shared = spark.sparkContext.broadcast(model)

    def predict(texts: list[str | None]) -> Iterator[tuple]:
        field_ = shared.value
        words = [words_of(t) for t in texts] if field_ else [[] for _ in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        some = lengths[lengths > 0]
        share = marginals(field_.emissions([w for x in words for w in x]), some, field_.moves, field_.start) if len(some) else None
        at = 0
        for n in lengths.tolist():
            if not n:
                yield (UNKNOWN, 0.0, 0, 0, [])
                continue
            own = share[at : at + n]
            at += n
            mean = own.mean(axis=0)
            best = own.argmax(axis=1)
            turns = np.flatnonzero(best[1:] != best[:-1]) + 1
            starts = [0, *turns.tolist()]
            spans = [{"lang": field_.langs[best[s]], "first": s, "words": e - s} for s, e in zip(starts, [*starts[1:], n], strict=True)] if runs else []
            yield field_.langs[int(mean.argmax())], float(min(1.0, mean.max())), n, len(turns), spans

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[2] or "") // 6 + 1
            if size >= BLOCK_WORDS:
                yield from answer(held)
                held, size = [], 0
        yield from answer(held)

    def answer(held: list[tuple]) -> Iterator[tuple]:
        for (doc, out, _), got in zip(held, predict([t for _, _, t in held]), strict=True):
            yield (doc, out, *got[: None if runs else 4])

    span = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())])
    fields = [("doc_id", "long", pa.int64()), ("held_out", "boolean", pa.bool_()), ("lang_pred", "string", pa.string()), ("score", "double", pa.float64()), ("n_words", "long", pa.int64()), ("n_switches", "long", pa.int64())]
    fields += [("runs", "array<struct<lang:string,first:int,words:int>>", pa.list_(span))] if runs else []
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_texts(kept, run, fields, "doc_id", "held_out", "text")


def identify(spark: SparkSession, docs: DataFrame, sample: Sample = Sample()) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out, then label every row."""
    return label(spark, docs, learn(spark, docs, sample))
