"""Language identification by a linear-chain conditional random field over words.

Each word of a text (a run of letters, of a longer run each 60) is labelled by forward-backward from affix, n-gram and lexicon features of the word and
learned transitions between successive words, so a text that switches language gets several labels. A
document's language is the label with the highest sum of word posteriors, its score their mean.

The model is fitted on the driver on a bounded sample of labelled rows (``train_rows``, dealt evenly over
labels by a hash of ids). Training sequences join passages of different documents, which is where the
transitions learn how rarely a language changes. Whole texts are labelled: chains are cut into blocks only
to be computed side by side, with exact messages passed between blocks.

Defined cases: a null text, and one without letters (Unicode's L), is ``und`` with score 0; without any labelled row
everything is ``und``; repeated rows and null ids come back as they are; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import about, held, relieve, slices, tidy

UNKNOWN = "und"
#: Labelled rows that the model is fitted on, at most; it reads their whole texts.
TRAIN_ROWS = 900
#: Letters of a word at most; longer runs of letters are several words.
WORD_LETTERS = 60
BITS = 18
LEXICON = 300
BLOCK = 64
CACHE_WORDS = 300_000


_WORD = re.compile(r"[^\W\d_]+")


@functools.cache
def _numerals() -> frozenset[str]:
    """Besides letters, decimal digits and the underscore \\w takes other numerals, such as fractions and Roman ones."""
    return frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha())


def words_of(text: str) -> list[str]:
    text = text.lower()
    if not text.isascii() and (found := _numerals().intersection(text)):
        text = text.translate(dict.fromkeys(map(ord, found), " "))
    words = _WORD.findall(text)
    if max(map(len, words), default=0) > WORD_LETTERS:
        words = [w[i : i + WORD_LETTERS] for w in words for i in range(0, len(w), WORD_LETTERS)]
    return words


def features(word: str, lexicon: dict[str, list[int]]) -> list[int]:
    """Hashed features of a lower-case word."""
    w = f"<{word}>"
    names = [f"w{word}", *(f"p{w[:n]}" for n in (2, 3, 4, 5)), *(f"s{w[-n:]}" for n in (2, 3, 4, 5))]
    for n in (1, 2, 3):
        names.extend(f"n{w[i : i + n]}" for i in range(len(w) - n + 1))
    names.extend(f"l{k}" for k in lexicon.get(word, ()))
    mask = (1 << BITS) - 1
    return [zlib.crc32(x.encode()) & mask for x in names]


@dataclass
class Model:
    labels: list[str]
    lexicon: dict[str, list[int]]
    weights: np.ndarray  # (2**BITS, labels)
    transitions: np.ndarray  # (labels, labels), from the row's to the column's

    def emissions(self, words: list[str]) -> np.ndarray:
        ids = [features(w, self.lexicon) for w in words]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.int64, int(n.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None].astype(np.float32) if len(words) else np.zeros((0, len(self.labels)), np.float32)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 7, epochs: int = 3, rate: float = 0.3, length: int = 48, batch: int = 128) -> Model:
    """Maximises the conditional likelihood by AdaGrad over dealt sequences."""
    labels = sorted(set(langs))
    docs = [(words_of(t), labels.index(x)) for t, x in zip(texts, langs, strict=True)]
    docs = [d for d in docs if d[0]]
    seen: list[Counter] = [Counter() for _ in labels]
    for words, k in docs:
        seen[k].update(words)
    lexicon: dict[str, list[int]] = {}
    for k, c in enumerate(seen):
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon.setdefault(w, []).append(k)
    rng, size = np.random.default_rng(seed), len(labels)
    # passages of 6 to 48 words; joined, they switch language now and then
    passages = []
    for words, k in docs:
        at = 0
        while at < len(words):
            n = int(rng.integers(6, 49))
            passages.append((words[at : at + n], k))
            at += n
    rng.shuffle(passages)
    words, truth = [], []
    for part, k in passages:
        words += part
        truth += [k] * len(part)
    index: dict[str, int] = {}
    at = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    ids = [features(w, lexicon) for w in index]
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat, first = np.fromiter((x for i in ids for x in i), np.int64, int(n.sum())), np.cumsum(n) - n
    scale = 1 / np.sqrt(n)
    model = Model(labels, lexicon, np.zeros((1 << BITS, size), np.float32), np.zeros((size, size), np.float32))
    rows = -(-len(at) // length)
    at, truth = np.resize(at, (rows, length)), np.resize(np.array(truth), (rows, length))
    sums_w, sums_t = np.full_like(model.weights, 1e-6), np.full_like(model.transitions, 1e-6)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(rows), max(1, rows // batch)):
            used, local = np.unique(at[part], return_inverse=True)
            local = local.reshape(len(part), length)
            lens = n[used]
            span = np.repeat(first[used] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
            feats, starts = flat[span], np.cumsum(lens) - lens
            e = np.add.reduceat(model.weights[feats], starts, axis=0) * scale[used][:, None]
            e = np.exp(e - e.max(1, keepdims=True))[local]
            a = np.exp(model.transitions)
            alpha, beta = np.empty((length, len(part), size)), np.empty((length, len(part), size))
            x = np.full((len(part), size), 1 / size)
            for t in range(length):
                x = alpha[t] = _scaled((x @ a) * e[:, t])
            x = beta[-1] = np.full((len(part), size), 1 / size)
            for t in range(length - 2, -1, -1):
                x = beta[t] = _scaled((x * e[:, t + 1]) @ a.T)
            post = _scaled(alpha * beta).transpose(1, 0, 2)
            gold = np.eye(size)[truth[part]]
            pair = np.zeros((size, size))
            for t in range(1, length):
                joint = alpha[t - 1][:, :, None] * a * (beta[t] * e[:, t])[:, None, :]
                pair += (gold[:, t - 1][:, :, None] * gold[:, t][:, None, :]).sum(0) - (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            change = (gold - post).reshape(-1, size)
            word_change = np.stack([np.bincount(local.ravel(), change[:, k], len(used)) for k in range(size)], 1) * scale[used][:, None]
            spread = np.repeat(word_change, lens, axis=0)
            touched, where = np.unique(feats, return_inverse=True)
            g = np.stack([np.bincount(where, spread[:, k], len(touched)) for k in range(size)], 1) / len(part)
            sums_w[touched] += g * g
            model.weights[touched] += rate * g / np.sqrt(sums_w[touched])
            g = pair / len(part)
            sums_t += g * g
            model.transitions += rate * g / np.sqrt(sums_t)
    return model


def posterior_sums(e: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Sums of label posteriors for each chain. e: positive emissions of all words, chain after chain; counts: words of each chain, 1 at least."""
    size, a = e.shape[1], np.exp(transitions.astype(np.float32))
    blocks = -(-counts // BLOCK)
    chain = np.repeat(np.arange(len(counts)), blocks)
    in_chain = np.arange(len(chain)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(np.cumsum(counts) - counts, blocks) + in_chain * BLOCK
    lens = np.minimum(BLOCK, np.repeat(np.cumsum(counts), blocks) - starts)
    longest = int(lens.max())
    x = np.ones((longest, len(chain), size), np.float32)  # emissions by place in block; 1 where a block has ended
    for t in range(longest):
        live = lens > t
        x[t, live] = e[starts[live] + t]
    step = [np.flatnonzero(lens > t) for t in range(longest)]
    # what a block does to any message that enters it
    if blocks.max() > 1:
        m = np.broadcast_to(np.eye(size, dtype=np.float32), (len(chain), size, size)).copy()
        for t in range(longest):
            i = step[t]
            y = (m[i].reshape(-1, size) @ a).reshape(-1, size, size) * x[t, i][:, None, :]
            m[i] = y / y.sum((1, 2), keepdims=True)
    forward, backward = np.full((len(chain), size), 1 / size, np.float32), np.full((len(chain), size), 1 / size, np.float32)
    first = np.cumsum(blocks) - blocks
    for k in range(1, int(blocks.max())):
        at = first[blocks > k] + k
        forward[at] = _scaled(np.einsum("ni,nij->nj", forward[at - 1], m[at - 1]))
        back = first[blocks > k] + blocks[blocks > k] - 1 - k
        backward[back] = _scaled(np.einsum("nij,nj->ni", m[back + 1], backward[back + 1]))
    alpha = np.empty_like(x)
    f = forward
    for t in range(longest):
        i = step[t]
        f = f.copy()
        f[i] = _scaled((f[i] @ a) * x[t, i])
        alpha[t] = f
    total = np.zeros((len(chain), size), np.float64)
    b = backward
    for t in range(longest - 1, -1, -1):
        i = step[t]
        total[i] += _scaled(alpha[t, i] * b[i])
        b = b.copy()
        b[i] = _scaled((b[i] * x[t, i]) @ a.T)
    return np.add.reduceat(total, first, axis=0)


class Labeller:
    """Labels texts, remembering the emissions of words."""

    def __init__(self, model: Model):
        self.model = model
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.labels)), np.float32)

    def _emissions(self, words: list[str]) -> np.ndarray:
        """A row for each word. When the memory is full it keeps what it has."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        rows = self.rows
        if (gone := np.flatnonzero(at < 0)).size:
            fresh: dict[str, int] = {}
            at[gone] = [fresh.setdefault(words[i], len(fresh)) for i in gone.tolist()]
            at[gone] += len(rows)
            e = self.model.emissions([*fresh])
            rows = np.concatenate([rows, np.exp(np.maximum(e - e.max(1, keepdims=True), -30)).astype(np.float32)])
            if len(rows) <= CACHE_WORDS:
                self.index.update({w: len(self.rows) + k for w, k in fresh.items()})
                self.rows = rows
        return rows[at]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        parts = [words_of(t) for t in texts]
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        some = [i for i, p in enumerate(parts) if p]
        if not some or not self.model.labels:
            return langs, scores
        words = [w for i in some for w in parts[i]]
        counts = np.array([len(parts[i]) for i in some])
        mean = posterior_sums(self._emissions(words), counts, self.model.transitions) / counts[:, None]
        for i, k, s in zip(some, mean.argmax(1), mean.max(1), strict=True):
            langs[i], scores[i] = self.model.labels[k], min(1.0, float(s))
        return langs, scores


def labeller_of(model: Model) -> Labeller:
    """One labeller a worker process and model, which serves its tasks one after the other. It holds the model, so the id stays the model's."""
    return held(("labeller", id(model)), lambda: Labeller(model))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2. A null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fits on at most ``train_rows`` labelled rows that aren't held out. Rows of rare labels come first, so that labels share the sample about evenly."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # a few labels: their counts set each one's rate, and a little more than the sample leaves its tasks
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return Model([], {}, np.zeros((1, 0), np.float32), np.zeros((0, 0), np.float32))
    of = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], float(r["count"] * len(counts)))])[F.col("lang")]
    near = rows.select("doc_id", "lang", "text").where(about(F.col("doc_id"), train_rows * 5 // 4, of))
    picked = near.orderBy(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) * of, "doc_id", "text").limit(train_rows).select("text", "lang").collect()
    texts, langs = [r["text"] for r in picked], [r["lang"] for r in picked]
    model = fit(texts, langs)
    del picked, texts, langs
    relieve()
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score in place of columns of these names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = labeller_of(sent.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [labeller.predict(texts[a:b]) for a, b in slices(map(len, texts))]
            langs = pa.array([x for got, _ in found for x in got], pa.string())
            scores = pa.array([x for _, got in found for x in got], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, langs, scores], [*batch.schema.names, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(tidy(label), schema)
