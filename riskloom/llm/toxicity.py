"""Toxic spans and document scores from a linear-chain conditional random field.

Labels mark documents, so tokens are labelled at a distance: on a bounded sample of
labelled documents, words and word beginnings that are many times likelier in toxic
than in clean documents form a lexicon; in toxic documents the tokens it matches
are labelled toxic, all other tokens clean.  A two-label chain is fitted to blocks
of those tokens (hashed features: word, beginnings, ends, neighbours; transitions)
by gradient ascent with forward-backward expectations.

Scoring is one pass: forward-backward marginals of every token of the whole text,
in blocks of ``BLOCK`` tokens; marginals above ``SPAN`` are spans with character
offsets; a logistic model fitted on the sample turns the expected number of toxic
tokens, their share and the chances of at least one and two into the document score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from riskloom.llm.common import batch_words, fold, labelled_ids, steps, sums
from riskloom.sources.scratch import working_table

# Labelled documents of each class that the model is fitted on.
SAMPLE = 4_000
# Blocks of each kind (with and without a toxic token) that the chain is fitted on.
BLOCKS = 4_000
# Features that label tokens, the most frequent in toxic documents first.
LEXICON = 2_000
# Tokens of a row that is worked on at once; messages go on over the ends of rows.
BLOCK = 64
BITS = 18
_MASK = (1 << BITS) - 1
ROUNDS = 60
RATE = 0.3
PENALTY = 1e-4
SPAN = 0.5
# Marginals below this add nothing to a document's expected number.
LEAST = 0.2
# How much likelier in toxic documents a lexicon entry is, and its least log-likelihood statistic.
RATIO = 12
EVIDENCE = 22
# Words that a worker keeps.
KEPT = 300_000

# Tokens lie between ASCII white space; what is compared are the words in them.
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_WORD = re.compile(r"\w+")
_SIGNS = ".,;:!?\"'()[]{}*#|-"
# Seeds of the kinds of features: word, beginnings and ends of so many bytes, and the neighbours.
_BEGIN, _END = {4: 4, 5: 5, 6: 6, 7: 7}, {3: 13, 4: 14}
_BEFORE, _AFTER = 21, 22
PER_WORD = 1 + len(_BEGIN) + len(_END)


def bare(token: str) -> list[bytes]:
    """The lower-cased words of a token, most often one."""
    word = token.strip(_SIGNS).lower()
    words = [word] if word.isalnum() else _WORD.findall(word)
    return [w.encode("utf-8", "surrogatepass") for w in words]


def word_features(words: list[bytes]) -> list[int]:
    """32-bit hashes of identity, beginnings and ends of each word."""
    out = []
    for w in words:
        out.append(zlib.crc32(w, 1))
        n = len(w)
        out += [zlib.crc32(w[:k], seed) for k, seed in _BEGIN.items() if n >= k]
        out += [zlib.crc32(w[-k:], seed) for k, seed in _END.items() if n >= k]
    return out


def slots(token: str) -> list[int]:
    """``PER_WORD`` hashed own features, those of a further word folded in, then the token as the one before and the one after."""
    words = bare(token)
    own = [h & _MASK for h in word_features(words)][:PER_WORD]
    whole = b" ".join(words)
    own += [_MASK + 1] * (PER_WORD - len(own))
    return own + [zlib.crc32(whole, _BEFORE) & _MASK, zlib.crc32(whole, _AFTER) & _MASK]


def _entering(step: np.ndarray, first: np.ndarray, backwards: bool) -> np.ndarray:
    """The odds that enter each block of a text, from what each block does to the odds that enter it.

    ``step`` (blocks x 2 x 2): odds x leave as (a x + b) / (c x + d); ``first``: the
    first block of each text.  Texts advance together, one block at a time.
    """
    n = len(step)
    out = np.full(n, np.nan)
    ends = np.append(first[1:], n)
    size = ends - first
    order = np.argsort(-size, kind="stable")
    now = np.full(len(first), 0.0 if not backwards else 1.0)
    for k in range(int(size.max(initial=0))):
        order = order[size[order] > k]
        at = ends[order] - 1 - k if backwards else first[order] + k
        out[at] = now[order]
        (a, b), (c, d) = step[at].transpose(1, 2, 0)
        now[order] = (a * now[order] + b) / (c * now[order] + d)
    return out


def marginals(emission: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each token of each row, and the expected moves (2 x 2) over all rows.

    ``emission`` is the toxic label's score against the clean one's, rows padded on
    the right; ``moves`` are transition scores.  Forward and backward messages are
    kept as the odds toxic : clean.  With ``first``, rows are the blocks of longer
    chains that begin there: what a block does to a message is composed first,
    messages are carried from block to block, and so reach over the whole chain.
    """
    rows, width = emission.shape
    factor = np.exp(np.clip(emission, -30, 30))
    t = np.exp(moves)
    first = np.arange(rows) if first is None else first
    begins = np.zeros(rows, bool)
    begins[first] = True
    used = np.arange(width)[:, None] < lengths
    entry, exit_ = np.zeros(rows), np.ones(rows)
    if not begins.all():
        # odds in front of a block as 2 x 2 maps; a token at the start of a chain has no move before it
        ahead = np.broadcast_to(np.eye(2), (rows, 2, 2)).copy()
        behind = ahead.copy()
        one = np.zeros((rows, 2, 2))
        for k in range(width):
            f = factor[:, k]
            one[:, 0, 0], one[:, 0, 1], one[:, 1, 0], one[:, 1, 1] = f * t[1, 1], f * t[0, 1], t[1, 0], t[0, 0]
            if k == 0:
                one[begins] = 0.0
                one[begins, 0, 1], one[begins, 1, 1] = f[begins], 1.0
            ahead = np.where(used[k][:, None, None], one @ ahead, ahead)
            ahead /= ahead.max(axis=(1, 2), keepdims=True)
        for k in range(width - 1, -1, -1):
            f = factor[:, k]
            one[:, 0, 0], one[:, 0, 1], one[:, 1, 0], one[:, 1, 1] = t[1, 1] * f, t[1, 0], t[0, 1] * f, t[0, 0]
            behind = np.where(used[k][:, None, None], one @ behind, behind)
            behind /= behind.max(axis=(1, 2), keepdims=True)
        entry, exit_ = _entering(ahead, first, False), _entering(behind, first, True)
    forward = np.empty((width, rows))
    backward = np.ones((width, rows))
    with_move = factor[:, 0] * (t[0, 1] + entry * t[1, 1]) / (t[0, 0] + entry * t[1, 0])
    odds = np.where(begins, factor[:, 0], with_move)
    forward[0] = odds
    for k in range(1, width):
        odds = factor[:, k] * (t[0, 1] + odds * t[1, 1]) / (t[0, 0] + odds * t[1, 0])
        forward[k] = odds
    back = exit_
    backward[width - 1] = back
    for k in range(width - 2, -1, -1):
        x = factor[:, k + 1] * back
        back = np.where(k + 1 < lengths, (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x), back)
        backward[k] = back
    odds = (forward * backward).T
    p = odds / (1 + odds)
    expected = np.zeros((2, 2))

    def add(a: np.ndarray, x: np.ndarray) -> None:
        pair = [np.full_like(a, t[0, 0]), t[0, 1] * x, a * t[1, 0], a * t[1, 1] * x]
        whole = sum(pair)
        expected[:] += np.array([(q / whole).sum() for q in pair]).reshape(2, 2)

    if width > 1:
        inside = np.arange(1, width)[None, :] < lengths[:, None]
        add(forward[:-1].T[inside], (factor[:, 1:].T * backward[1:]).T[inside])
    joined = np.flatnonzero(~begins)  # moves between blocks
    if len(joined):
        add(entry[joined], factor[joined, 0] * backward[0, joined])
    return p, expected


def in_blocks(values: np.ndarray, bounds: np.ndarray, width: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``width`` values that do not cross bounds, their lengths, each value's cell, and the first row of each text with values."""
    sizes = np.diff(bounds)
    blocks = -(-sizes // width)
    first = np.cumsum(blocks) - blocks
    within = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
    cells = np.repeat(first, sizes) * width + within
    rows = int(blocks.sum())
    out = np.zeros(rows * width)
    out[cells] = values
    return out.reshape(rows, width), np.bincount(cells // width, minlength=rows), cells, first[blocks > 0]


def _emission(own: np.ndarray, before: np.ndarray, after: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own score of each token, plus what the word before and the word after add."""
    score = own[words].copy()
    if len(words) > 1:
        inside = np.ones(len(words), bool)
        inside[bounds[:-1][bounds[:-1] < len(words)]] = False  # first tokens have none before
        score[1:] += np.where(inside[1:], before[words[:-1]], 0)
        score[:-1] += np.where(inside[1:], after[words[1:]], 0)
    return score


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray  # weights of what ``Scorer.documents`` gives


class Scorer:
    """A model in a worker, with the scores of tokens met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.weights = np.concatenate([model.weights, [0.0]])
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, 3))

    def known(self, tokens: np.ndarray) -> np.ndarray:
        """Scores of each token: own, as the one before, as the one after."""
        if len(self.places) > KEPT:
            self.places, self.scores = {}, np.zeros((0, 3))
        fresh = [t for t in tokens if t not in self.places]
        if fresh:
            values = self.weights[np.array([slots(t) for t in fresh])]
            rows = np.column_stack([values[:, :PER_WORD].sum(axis=1) + self.model.bias, values[:, -2:]])
            self.places.update(zip(fresh, range(len(self.scores), len(self.scores) + len(fresh))))
            self.scores = np.concatenate([self.scores, rows])
        return self.scores[np.fromiter(map(self.places.__getitem__, tokens), np.int64, len(tokens))]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of all tokens, and the bounds of each text."""
        codes, words, bounds = batch_words(texts)
        if not len(codes):
            return np.zeros(0), bounds
        own, before, after = self.known(words.to_numpy(zero_copy_only=False)).T
        rows, lengths, cells, first = in_blocks(_emission(own, before, after, codes, bounds), bounds)
        p, _ = marginals(rows, lengths, self.model.moves, first)
        return p.ravel()[cells], bounds

    def documents(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Intercept, logs of the expected number of toxic tokens and of their share, and the chances of one and of two at least."""
        q = np.where(p > LEAST, np.minimum(p, 1 - 1e-9), 0.0)
        none = np.exp(sums(np.log1p(-q), bounds))
        one = none * sums(q / (1 - q), bounds)
        number = sums(q, bounds)
        share = np.log((number + 0.05) / (np.diff(bounds) + 20.0))
        return np.stack([np.ones(len(none)), np.log1p(number), share, 1 - none, np.clip(1 - none - one, 0, 1)], axis=1)


def spans(text: str, p: np.ndarray) -> list[dict]:
    """Character ranges of runs of tokens above ``SPAN``, from first to last word, with their largest marginal."""
    out: list[dict] = []
    last = -2
    for k, match in enumerate(_TOKEN.finditer(text)):
        if p[k] <= SPAN:
            continue
        words = list(_WORD.finditer(match[0])) or [re.match(".*", match[0], re.S)]
        start, end = match.start() + words[0].start(), match.start() + words[-1].end()
        if k == last + 1:
            out[-1] |= {"end": end, "p": max(out[-1]["p"], float(p[k]))}
        else:
            out.append({"start": start, "end": end, "p": float(p[k])})
        last = k
    return out


def fit_chain(blocks: list[tuple[list[str], list[int]]], rounds: int = ROUNDS) -> Model:
    """Gradient ascent on the conditional likelihood of labelled token blocks."""
    places: dict[str, int] = {}
    words = np.array([places.setdefault(w, len(places)) for tokens, _ in blocks for w in tokens], np.int64)
    labels = np.array([y for _, ys in blocks for y in ys], float)
    bounds = np.concatenate([[0], np.cumsum([len(tokens) for tokens, _ in blocks])]).astype(np.int64)
    made = np.array([slots(w) for w in places])
    own, before, after = made[:, :PER_WORD], made[:, -2], made[:, -1]
    weights = np.zeros((1 << BITS) + 1)  # the last is the padding's and stays 0
    bias, moves = -4.0, np.zeros((2, 2))
    seen = np.zeros((2, 2))
    inside = np.ones(len(words), bool)
    inside[bounds[:-1]] = False
    pairs = 2 * labels[:-1][inside[1:]] + labels[1:][inside[1:]]
    seen += np.bincount(pairs.astype(int), minlength=4).reshape(2, 2)
    past = [np.full_like(weights, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(rounds):
        score = _emission(weights[own].sum(axis=1) + bias, weights[before], weights[after], words, bounds)
        rows, lengths, cells, first = in_blocks(score, bounds)
        p, expected = marginals(rows, lengths, moves, first)
        miss = labels - p.ravel()[cells]
        by_word = np.bincount(words, miss, len(places))
        grad = np.bincount(own.ravel(), np.repeat(by_word, PER_WORD), len(weights))
        grad += np.bincount(before[words[:-1]], np.where(inside[1:], miss[1:], 0), len(weights))
        grad += np.bincount(after[words[1:]], np.where(inside[1:], miss[:-1], 0), len(weights))
        grad[-1] = 0
        grads = [grad / len(blocks) - PENALTY * weights, miss.sum() / len(blocks), (seen - expected) / len(blocks)]
        past = [a + g * g for a, g in zip(past, grads)]
        step = [RATE * g / np.sqrt(a) for g, a in zip(grads, past)]
        weights, bias, moves = weights + step[0], bias + step[1], moves + step[2]
    return Model(weights[:-1], float(bias), moves - moves[0, 0], np.zeros(5))


def fit_documents(features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, lightly penalised."""
    beta = np.zeros(features.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        curve = weights * p * (1 - p)
        hessian = (features * curve[:, None]).T @ features + 0.05 * np.eye(len(beta))
        beta = beta + np.linalg.solve(hessian, features.T @ (weights * (labels - p)) - 0.05 * beta)
    return beta


def _distinct_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that hold a feature."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            counts[label].update({f for token in set(_TOKEN.findall(text)) for f in word_features(bare(token))})
    features = list(counts[0].keys() | counts[1].keys())
    yield pd.DataFrame({"feature": features, "toxic": [counts[1][f] for f in features], "clean": [counts[0][f] for f in features]})


def _blocks(lexicon: set[int]):
    """Blocks of tokens with labels; of a toxic document only those that hold a labelled token."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"]):
                words = _TOKEN.findall(text)
                hit = [int(label and not lexicon.isdisjoint(word_features(bare(w)))) for w in words]
                for k in range(0, len(words), BLOCK):
                    toxic = any(hit[k : k + BLOCK])
                    if toxic or not label:
                        joined = " ".join(words[k : k + BLOCK])
                        rows.append((int(toxic), zlib.crc32(joined.encode("utf-8", "surrogatepass")), joined, "".join(map(str, hit[k : k + BLOCK]))))
            yield pd.DataFrame(rows, columns=["toxic", "order", "words", "hit"])

    return cut


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fit on a bounded sample of labelled documents outside fold 0; None if a class is missing.

    Copies count once: of equal texts one is kept.
    """
    known = labelled_ids(labels, "toxic", sample, held_out=0)
    known = F.broadcast(known.withColumnRenamed("doc_id", "known_id"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    rows = rows.join(known, F.col("id") == F.col("known_id")).select("text", "label", F.xxhash64("text").alias("digest"))
    with working_table(rows.dropDuplicates(["digest"]).select("text", "label"), "toxic-sample") as chosen:
        size = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if not size.get(0) or not size.get(1):
            return None
        counted = chosen.mapInPandas(_distinct_features, "feature bigint, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        ratio = (F.col("toxic") / size[1]) / ((F.col("clean") + 0.5) / size[0])
        both = F.col("toxic") + F.col("clean")
        share = size[1] / (size[0] + size[1])
        g2 = 2 * sum(F.col(c) * F.log(F.greatest(F.col(c), F.lit(0.5)) / (both * q)) for c, q in (("toxic", share), ("clean", 1 - share)))
        marked = counted.filter((ratio >= RATIO) & (g2 >= EVIDENCE))
        lexicon = {r["feature"] for r in marked.orderBy(F.desc("toxic"), "clean", "feature").limit(LEXICON).collect()}
        cut = chosen.mapInPandas(_blocks(lexicon), "toxic int, order bigint, words string, hit string")
        blocks, names = [], {}
        for kind in (0, 1):
            for r in cut.filter(F.col("toxic") == kind).orderBy("order", "words").limit(BLOCKS).collect():
                # one string object per distinct word
                blocks.append(([names.setdefault(w, w) for w in r["words"].split(" ")], [int(c) for c in r["hit"]]))
        if not any(any(y) for _, y in blocks):
            return None
        model = fit_chain(blocks)
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = Scorer(shared.value)
            for batch in batches:
                texts = pa.array(batch["text"], pa.string())
                out = np.concatenate([scorer.documents(*scorer.texts(texts[at:to])) for at, to in steps(texts)])
                yield pd.DataFrame({"label": batch["label"], "number": out[:, 1], "share": out[:, 2], "one": out[:, 3], "two": out[:, 4]})

        seen = chosen.mapInPandas(features, "label int, number double, share double, one double, two double").toPandas()
    y = seen["label"].to_numpy(float)
    x = np.stack([np.ones(len(y)), seen["number"], seen["share"], seen["one"], seen["two"]], axis=1)
    model.document = fit_documents(x, y, np.ones(len(y)))
    return model


def toxicity(text: Column | str, model: Model | None, spark) -> Column:
    """struct(score, spans) of each whole text; without a model every score is 0."""
    shared = spark.sparkContext.broadcast(model)

    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])

    @arrow_udf("score double, spans array<struct<start: int, end: int, p: double>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in batches:
            rows: list[dict] = []
            for at, to in steps(batch):
                texts = batch[at:to]
                if scorer is None:
                    rows += [{"score": 0.0, "spans": []}] * len(texts)
                    continue
                p, bounds = scorer.texts(texts)
                x = scorer.documents(p, bounds)
                scores = 1 / (1 + np.exp(-np.clip(x @ scorer.model.document, -30, 30)))
                marked = sums((p > SPAN).astype(np.int64), bounds)
                for k, score in enumerate(scores):
                    hit = spans(texts[k].as_py(), p[bounds[k] : bounds[k + 1]]) if marked[k] else []
                    rows.append({"score": float(score), "spans": hit})
            yield pa.array(rows, kind)

    return judge(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and spans of every row.

    NULL and empty texts score as texts without tokens; NULL ids belong to the
    held-out fold; repeated rows get equal results; an empty table, or labels of one
    class alone, give no model and score 0.  Only the id and text columns are read.
    """
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    judged = rows.select("doc_id", (fold("doc_id") == 0).alias("held_out"), toxicity("text", model, docs.sparkSession).alias("r"))
    return judged.select("doc_id", "held_out", F.col("r.score").alias("score"), (F.col("r.score") >= 0.5).cast("int").alias("predicted"), F.col("r.spans").alias("spans"))
