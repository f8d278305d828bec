"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.words import Words, chunks, mixed, spread, words

#: Bounds of the training sample: documents a language, documents in all, word runs of a
#: document and words of a run. Prediction has no such bound.
PER_LANGUAGE, SAMPLE, RUNS, RUN_WORDS = 600, 4000, 6, 32
#: Parts that a language's ids are ranked in before they are ranked together.
SALTS = 64
#: Hashed features, and steps of the fit.
BUCKETS, STEPS = 1 << 17, 30
#: A word of the sample enters the lexicon from this many occurrences on.
LEXICON_COUNT = 3
#: Words of a chain that are multiplied up together; steps between rescalings.
BLOCK, RESCALE = 128, 6
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    transitions: np.ndarray  # from x to
    lexicon: np.ndarray  # sorted hashes of known words
    lexicon_features: np.ndarray  # the bucket of a known word's language

    def emissions(self, found: Words, pick: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """A score per language for the words at ``pick``."""
        index, bounds = _features(found, pick, hashes, self.lexicon, self.lexicon_features)
        return np.add.reduceat(self.weights[index], bounds, axis=0)


def _features(
    found: Words, pick: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray, known: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of words, flat, and where each word's begin.

    The word itself, its lexicon entry, prefixes and suffixes to 4 letters, and all letter
    2- and 3-grams.
    """
    codes = found.codes.astype(np.uint64)
    start, size = found.start[pick], found.size[pick]
    parts, owner = [], np.arange(len(pick))
    owners = []

    def add(values: np.ndarray, kind: int, whose: np.ndarray) -> None:
        parts.append(mixed(values + np.uint64(kind << 40)) & np.uint64(BUCKETS - 1))
        owners.append(whose)

    add(hashes, 1, owner)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        hit = lexicon[at] == hashes
        parts.append(known[at[hit]].astype(np.uint64))
        owners.append(owner[hit])
    prefix, suffix = np.zeros(len(pick), np.uint64), np.zeros(len(pick), np.uint64)
    for n in range(1, 5):
        has = size >= n
        prefix[has] = prefix[has] * np.uint64(1_000_003) + codes[start[has] + n - 1]
        suffix[has] = suffix[has] * np.uint64(1_000_003) + codes[start[has] + size[has] - n]
        add(prefix[has], 10 + n, owner[has])
        add(suffix[has], 20 + n, owner[has])
    for n in (2, 3):
        grams = np.maximum(size - n + 1, 0)
        at = spread(start, grams)
        value = codes[at]
        for i in range(1, n):
            value = value * np.uint64(1_000_003) + codes[at + i]
        add(value, 30 + n, np.repeat(owner, grams))
    whose = np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    bounds = np.searchsorted(whose[order], owner)
    return np.concatenate(parts)[order].astype(np.int64), bounds


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest value; only ratios matter."""
    return x / np.maximum(x.max(axis=tuple(range(1, x.ndim)), keepdims=True), 1e-300)


def forward_backward(emissions: np.ndarray, doc: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Exact marginals of every word's label; words of a ``doc`` are a chain, in order.

    Chains are cut into blocks. Each block's transfer matrix is the product over its words;
    a scan over a chain's blocks gives what enters and leaves each, and a second pass within
    blocks gives the marginals. All steps run over many blocks at once.
    """
    n, k = emissions.shape
    if not n:
        return emissions
    step = np.exp(transitions - transitions.max())
    local = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64)
    local = np.maximum(local, 1e-24)
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    length = np.diff(np.concatenate((first, [n])))
    blocks = -(-length // BLOCK)
    chain = np.repeat(np.arange(len(first)), blocks)
    place = spread(np.zeros(len(blocks), np.int64), blocks)
    begin = first[chain] + place * BLOCK
    size = np.minimum(BLOCK, length[chain] - place * BLOCK)
    by_size = np.argsort(-size, kind="stable")
    active = [int(np.searchsorted(-size[by_size], -t, side="left")) for t in range(int(size.max()))]
    begin_s, size_s = begin[by_size], size[by_size]

    # From the label before a block to its last word's label.
    transfer = np.repeat(np.eye(k)[None], len(begin), axis=0)
    for t, m in enumerate(active):
        transfer[:m] = (transfer[:m].reshape(-1, k) @ step).reshape(-1, k, k) * local[begin_s[:m] + t][:, None, :]
        if t % RESCALE == 0:
            transfer[:m] = _scaled(transfer[:m])
    transfer = _scaled(transfer)
    back_to = np.empty(len(by_size), np.int64)
    back_to[by_size] = np.arange(len(by_size))

    # Scan over the blocks of each chain, longest chains first.
    by_blocks = np.argsort(-blocks, kind="stable")
    head = np.concatenate(([0], np.cumsum(blocks)[:-1]))[by_blocks]
    count = blocks[by_blocks]
    enter = np.ones((len(begin), k))  # weight of the label before the block
    leave = np.ones((len(begin), k))  # weight of all that follows, per last label
    # No word is before a chain: every first label is as likely, whatever the transitions.
    opening = np.linalg.solve(step.T, np.ones(k)) if np.linalg.cond(step) < 1e8 else np.ones(k)
    state = np.repeat(opening[None], len(head), axis=0)
    for b in range(int(count.max())):
        m = int(np.searchsorted(-count, -b, side="left"))
        at = head[:m] + b
        enter[at] = state[:m]
        state[:m] = _scaled(np.einsum("bi,bij->bj", state[:m], transfer[back_to[at]]))
    state = np.ones((len(head), k))
    for b in range(int(count.max()) - 1, -1, -1):
        m = int(np.searchsorted(-count, -b, side="left"))
        at = head[:m] + b
        leave[at] = state[:m]
        state[:m] = _scaled(np.einsum("bij,bj->bi", transfer[back_to[at]], state[:m]))

    forward = np.empty((n, k))
    state = enter[by_size]
    for t, m in enumerate(active):
        at = begin_s[:m] + t
        state[:m] = (state[:m] @ step) * local[at]
        if t % RESCALE == 0:
            state[:m] = _scaled(state[:m])
        forward[at] = state[:m]
    back = leave[by_size]
    result = np.empty((n, k))
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = begin_s[:m] + t
        result[at] = forward[at] * back[:m]
        back[:m] = (back[:m] * local[at]) @ step.T
        if t % RESCALE == 0:
            back[:m] = _scaled(back[:m])
    total = result.sum(axis=1, keepdims=True)
    return result / np.maximum(total, 1e-300)


def fit(sample: list[tuple[str, str]]) -> Model:
    """A model from (language, run of words) pairs.

    Runs of different languages follow each other in the training chains, as they do in
    code-switched text; so the transitions learn what a switch costs.
    """
    languages = sorted({language for language, _ in sample})
    k = len(languages)
    none = np.zeros(0, np.int64)
    if not k or not len(words([run for _, run in sample]).start):
        return Model(languages, np.zeros((BUCKETS, k)), np.zeros((k, k)), none.astype(np.uint64), none)
    order = np.random.default_rng(7).permutation(len(sample))
    found = words([sample[i][1] for i in order])
    label = np.array([languages.index(sample[i][0]) for i in order], np.int64)[found.doc]
    chain = found.doc // 4
    distinct, pick, word = np.unique(found.hashes(), return_index=True, return_inverse=True)
    counts = np.zeros((len(distinct), k))
    np.add.at(counts, (word, label), 1)
    listed = counts.sum(axis=1) >= LEXICON_COUNT
    lexicon_features = (mixed(np.arange(k, dtype=np.uint64) + np.uint64(3 << 40)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    model = Model(
        languages,
        np.zeros((BUCKETS, k)),
        np.zeros((k, k)),
        distinct[listed],
        lexicon_features[counts[listed].argmax(axis=1)],
    )
    index, bounds = _features(found, pick, distinct, model.lexicon, model.lexicon_features)
    owner = np.repeat(np.arange(len(pick)), np.diff(np.append(bounds, len(index))))
    inner = chain[1:] == chain[:-1]
    moves = np.zeros((k, k))
    np.add.at(moves, (label[:-1][inner], label[1:][inner]), 1)
    # Transitions of a chain that is fully labelled: their conditional likelihood is highest
    # close to the smoothed rates, which the gradient steps then refine.
    model.transitions[:] = np.log((moves + 1) / (moves + 1).sum(axis=1, keepdims=True))
    truth = np.zeros((len(distinct), k))
    np.add.at(truth, (word, label), 1)
    speed = np.zeros_like(model.weights)
    rate = 0.5
    for _ in range(STEPS):
        scores = np.add.reduceat(model.weights[index], bounds, axis=0)
        marginals = forward_backward(scores[word], chain, model.transitions)
        slope = truth.copy()
        np.add.at(slope, word, -marginals)
        gradient = np.zeros_like(model.weights)
        for j in range(k):
            gradient[:, j] = np.bincount(index, slope[owner, j], BUCKETS)
        gradient -= 0.5 * model.weights
        speed += gradient**2
        model.weights += rate * gradient / np.sqrt(speed + 1e-8) * 0.2
        pair = marginals[:-1][inner].T @ marginals[1:][inner]
        model.transitions += 0.1 * (moves - pair) / max(1, inner.sum())
    model.weights = model.weights.astype(np.float32)
    return model


def label_chunk(model: Model, texts: list[str | None]) -> tuple[Words, np.ndarray]:
    """Words of the texts, and the marginal of every label for each."""
    found = words(texts)
    if not len(found.start):
        return found, np.zeros((0, len(model.languages)))
    distinct, pick, word = np.unique(found.hashes(), return_index=True, return_inverse=True)
    scores = model.emissions(found, pick, distinct)
    return found, forward_backward(scores[word], found.doc, model.transitions)


def _summary(model: Model, texts: list[str | None]) -> pd.DataFrame:
    n, k = len(texts), len(model.languages)
    if not k:
        return pd.DataFrame({"lang_pred": [UNKNOWN] * n, "score": np.zeros(n)})
    total, size = np.zeros((n, k)), np.zeros(n)
    for a, b in chunks(texts):
        found, marginals = label_chunk(model, texts[a:b])
        for j in range(k):
            total[a:b, j] = np.bincount(found.doc, marginals[:, j], b - a)
        size[a:b] = np.bincount(found.doc, minlength=b - a)
    best = total.argmax(axis=1) if k else np.zeros(n, int)
    some = size > 0
    language = np.array([*model.languages, UNKNOWN], object)[np.where(some, best, k)]
    share = np.where(some, total[np.arange(n), best] / np.maximum(size, 1), 0.0)
    return pd.DataFrame({"lang_pred": language, "score": np.clip(share, 0, 1)})


def _runs(model: Model, texts: list[str | None]) -> Iterator[list[dict]]:
    for a, b in chunks(texts):
        found, marginals = label_chunk(model, texts[a:b])
        best = marginals.argmax(axis=1) if len(marginals) else np.zeros(0, int)
        rows: list[list[dict]] = [[] for _ in range(b - a)]
        new = np.flatnonzero(
            np.concatenate(([True], (found.doc[1:] != found.doc[:-1]) | (best[1:] != best[:-1])))
        ) if len(best) else []
        for i, j in zip(new, [*new[1:], len(best)]):
            d = int(found.doc[i])
            base = found.offset[d]
            rows[d].append({
                "start": int(found.start[i] - base),
                "end": int(found.start[j - 1] + found.size[j - 1] - base),
                "lang": model.languages[best[i]],
            })
        yield from rows


def train(labelled: DataFrame, id_column: str, text_column: str, lang_column: str) -> Model:
    """Fit on a bounded sample: at most PER_LANGUAGE documents a language and SAMPLE in all,
    the first by hash of the id; of each, RUNS runs of RUN_WORDS words spread over the text."""
    rank = F.xxhash64(F.col(id_column).cast("string"))
    ids = (
        labelled.select(id_column, lang_column)
        .filter(F.col(lang_column).isNotNull() & F.col(id_column).isNotNull())
        .withColumns({"rank": rank, "salt": F.pmod(rank, F.lit(SALTS))})
    )
    # First within salts, so that no task sees more of a frequent language than their share.
    for keys in ([lang_column, "salt"], [lang_column]):
        order = Window.partitionBy(*keys).orderBy("rank", id_column)
        ids = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PER_LANGUAGE)
    ids = ids.orderBy("place", "rank").limit(SAMPLE).select(id_column).distinct()
    texts = labelled.select(id_column, text_column, lang_column).join(
        F.broadcast(ids), id_column, "left_semi"
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, lang in batch.itertuples(index=False):
                parts = (text or "").split()
                steps = max(1, len(parts) // RUNS // RUN_WORDS) * RUN_WORDS
                for i in range(0, min(len(parts), steps * RUNS), steps):
                    out.append((str(key), i, lang, " ".join(w[:100] for w in parts[i : i + RUN_WORDS])))
            yield pd.DataFrame(out, columns=["key", "at", "lang", "run"])

    runs = (
        texts.filter(F.col(lang_column).isNotNull())
        .mapInPandas(cut, "key string, at int, lang string, run string")
        .orderBy(F.xxhash64("key", "at"), "key", "at", "run")
        .limit(SAMPLE * RUNS)
    )
    return fit([(row["lang"], row["run"]) for row in runs.collect()])


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> Column:
    """Column of struct(lang_pred, score) for whole texts: the language with the largest sum
    of word marginals, and its share; ``und`` and 0 for a text that is null or has no letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def languages(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory.only()
        for batch in batches:
            yield _summary(shared.value, batch.tolist())
        memory.give_back()

    # Not to be taken apart by the optimiser: a filter on a field would run it once more.
    return languages.asNondeterministic()(F.col(f"`{text_column}`"))


def label_words(docs: DataFrame, model: Model, text_column: str = "text") -> Column:
    """Column of array<struct(start, end, lang)>: the runs of one language in a text that
    switches, in code points. Empty for a text without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<start:int,end:int,lang:string>>")
    def runs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(_runs(shared.value, batch.tolist())), dtype=object)

    return runs(F.col(f"`{text_column}`"))


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that no training sees: those with crc32 of the id, as text, 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_column="doc_id", text_column="text", lang_column="lang") -> DataFrame:
    """``docs`` with held_out, lang_pred and score; columns of these names are replaced.

    Trained on the rows of ``docs`` that are not held out and have a language. Without any
    such row every document is ``und`` with score 0.
    """
    model = train(docs.filter(~held_out(id_column)), id_column, text_column, lang_column)
    guess = docs.withColumn("__guess", predict(docs, model, text_column))
    return guess.withColumns(
        {
            "held_out": held_out(id_column),
            "lang_pred": F.col("__guess.lang_pred"),
            "score": F.col("__guess.score"),
        }
    ).drop("__guess")
