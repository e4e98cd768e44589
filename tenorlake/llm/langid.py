"""Language of texts by a linear-chain conditional random field over words.

Every word of a text gets a language, so texts that switch languages are labelled word
by word. A word's score for a language is the sum of learned weights of its features:
character n-grams of two to four with a mark for either end (those that hold an end are
the affixes), and the word itself where it is in the lexicon of words seen often in training. Learned
transitions tie neighbouring words; forward-backward gives each word's probabilities
in its run of 64 words. A text's language is the one with the largest mean
probability, and that mean is its score.

Training takes at most ``SAMPLE`` labelled documents, the same number of each language as far as they go,
chosen by a hash of the id among documents outside the held-out third; copies count once.
Their words are cut into stretches of 2 to 40 and shuffled over languages, so transitions are
learned from switching text. The model is a few megabytes and goes to the executors.

Scores are sums over arrays of characters: no step is taken word by word, and texts are read
in parts of ``PART`` characters, cut at white space where there is any, so memory doesn't grow with their length.

Defined results: a null text or one without letters is ``und`` with score 0; so is every
text if there is nothing to learn from. A null id isn't held out and not learned from;
repeated rows are labelled each; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.llm.common import slices
from tenorlake.sources import lineage

SAMPLE = 640
ROUNDS = 30
BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
OFTEN = 3
RUN = 64
PART = 400_000
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1

_P = np.uint64(0x9E3779B97F4A7C15)
CODE_POINTS = 0x110000
#: Whether a code point is a letter.
_letters: list[np.ndarray] = []


def fold(row_id: Column) -> Column:
    return F.crc32(row_id.cast("string").cast("binary")) % FOLDS


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(CODE_POINTS)), bool, CODE_POINTS))
    return _letters[0]


def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words in order: begin (place before the word), word hash, and for every place the n-grams' buckets.

    Bucket ``BUCKETS`` stands for no feature.
    """
    codes = np.frombuffer(f" {text.lower()}   ".encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, np.uint32(32)).astype(np.uint64)
    n = len(codes) - 3
    begin = np.flatnonzero(is_letter[1:] & ~is_letter[:-1])
    buckets = np.full((len(GRAMS), n), BUCKETS, np.int32)
    h, inner = codes[:n].copy(), np.ones(n, bool)
    for k in range(1, max(GRAMS)):
        h = h * _P + codes[k : n + k]
        if k + 1 in GRAMS:
            some = is_letter[:n] | is_letter[k : n + k] if k == 1 else inner
            mixed = ((h ^ (h >> np.uint64(31))) * _P) >> np.uint64(64 - 17)
            buckets[GRAMS.index(k + 1)] = np.where(some, mixed.astype(np.int32), BUCKETS)
        inner &= is_letter[k : n + k]
    if not len(begin):
        return begin, np.empty(0, np.uint64), buckets, is_letter[:n]
    # The word's hash: a polynomial in its letters.
    place = np.zeros(n, np.int64)
    place[begin] = begin
    place = np.arange(n) - np.maximum.accumulate(place)
    powers = np.power(_P, np.arange(int(place.max()) + 1, dtype=np.uint64))
    hashes = np.add.reduceat(np.where(is_letter[:n], codes[:n] * powers[place], np.uint64(0)), begin)
    return begin, hashes, buckets, is_letter[:n]


class Model:
    def __init__(self, languages: list[str], lexicon: np.ndarray):
        self.languages, self.lexicon = languages, lexicon  # word hashes, sorted
        size = len(languages)
        self.grams = np.zeros((BUCKETS + 1, size), np.float32)
        self.words = np.zeros((len(lexicon) + 1, size), np.float32)
        self.step = np.zeros((size, size), np.float32)
        self.first = np.zeros(size, np.float32)

    def looked_up(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the lexicon; the last one for words not in it."""
        if not len(self.lexicon):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def scores(self, begin: np.ndarray, buckets: np.ndarray, places: np.ndarray) -> np.ndarray:
        total = self.grams[buckets[0]]
        for row in buckets[1:]:
            total += self.grams[row]
        return np.add.reduceat(total, begin) + self.words[places]

    def marginals(self, scores: np.ndarray, run: np.ndarray, at: np.ndarray, runs: int, pairs: np.ndarray | None = None) -> np.ndarray:
        """Probabilities of each word's languages; ``run`` and ``at`` place the words.

        To ``pairs`` it adds the expected number of steps between languages.
        """
        size, width = len(self.languages), int(at.max()) + 1
        e = np.ones((width, runs, size), np.float32)
        e[at, run] = np.exp(scores - scores.max(axis=1, keepdims=True))
        real = np.zeros((width, runs, 1), bool)
        real[at, run] = True
        step = np.exp(self.step - self.step.max())
        ahead = np.empty_like(e)
        ahead[0] = e[0] * np.exp(self.first - self.first.max())
        ahead[0] /= ahead[0].sum(axis=1, keepdims=True)
        for t in range(1, width):
            ahead[t] = (ahead[t - 1] @ step) * e[t]
            ahead[t] /= np.maximum(ahead[t].sum(axis=1, keepdims=True), 1e-30)
        back = np.ones((runs, size), np.float32)
        for t in range(width - 1, 0, -1):
            follow = e[t] * back
            if pairs is not None:
                both = ahead[t - 1][:, :, None] * step * follow[:, None, :]
                both /= np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-30)
                pairs += (both * real[t][:, :, None]).sum(axis=0)
            new = follow @ step.T
            new /= np.maximum(new.sum(axis=1, keepdims=True), 1e-30)
            ahead[t] *= back
            back = np.where(real[t], new, back).astype(np.float32)
        ahead[0] *= back
        out = ahead[at, run]
        return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-30)


def train(sample: pd.DataFrame, rounds: int = ROUNDS) -> Model | None:
    """Fit weights to texts with a lang by gradient steps scaled per weight."""
    rng = np.random.default_rng(7)
    languages = sorted(sample["lang"].unique())
    stretches: list[tuple[int, str]] = []
    for text, lang in zip(sample["text"], sample["lang"], strict=True):
        parts, i = text.split(), 0
        while i < len(parts):
            n = int(rng.integers(2, 41))
            stretches.append((languages.index(lang), " ".join(parts[i : i + n])))
            i += n
    if not stretches:
        return None
    # Half of the stretches keep their order, half are shuffled over all languages.
    order = np.arange(len(stretches))
    mixed = np.flatnonzero(rng.random(len(order)) < 0.5)
    order[mixed] = rng.permutation(mixed)
    stretches = [stretches[i] for i in order]
    begin, hashes, buckets, _ = features(" ".join(t for _, t in stretches))
    if not len(begin):
        return None
    # A stretch's words have its language; a mark at each stretch's first place tells them apart.
    ends = np.cumsum([len(t.lower()) + 1 for _, t in stretches])
    truth = np.array([k for k, _ in stretches])[np.searchsorted(ends, begin, side="right").clip(0, len(stretches) - 1)]
    known, counts = np.unique(hashes, return_counts=True)
    model = Model(languages, known[counts >= OFTEN])
    places = model.looked_up(hashes)
    n, size = len(begin), len(languages)
    run, at = np.arange(n) // RUN, np.arange(n) % RUN
    goal = np.zeros((n, size), np.float32)
    goal[np.arange(n), truth] = 1
    same_run = run[1:] == run[:-1]
    seen = np.zeros((size, size))
    np.add.at(seen, (truth[:-1][same_run], truth[1:][same_run]), 1)
    lengths = np.diff(np.append(begin, buckets.shape[1]))
    # n-grams of a place belong to the word whose stretch of places it lies in.
    word_of = np.concatenate([np.zeros(begin[0], np.int32), np.repeat(np.arange(n, dtype=np.int32), lengths)])
    used = [(row[row != BUCKETS], word_of[row != BUCKETS]) for row in buckets]
    squares = [np.full(w.shape, 1e-6, np.float32) for w in (model.grams, model.words, model.step, model.first)]
    for _ in range(rounds):
        pairs = np.zeros((size, size))
        error = goal - model.marginals(model.scores(begin, buckets, places), run, at, int(run[-1]) + 1, pairs)
        grams = np.stack([sum(np.bincount(flat, error[owner, k], BUCKETS + 1) for flat, owner in used) for k in range(size)], axis=1)
        words = np.stack([np.bincount(places, error[:, k], len(model.lexicon) + 1) for k in range(size)], axis=1)
        words[-1] = 0
        grads = [grams / n - 1e-7 * model.grams, words / n - 1e-7 * model.words, (seen - pairs) / n, error[at == 0].mean(axis=0) * 0.1]
        for weight, square, grad in zip((model.grams, model.words, model.step, model.first), squares, grads, strict=True):
            square += grad.astype(np.float32) ** 2
            weight += 0.3 * grad / np.sqrt(square)
    return model


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + PART
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def predict(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sums of its words' probabilities, and its number of words."""
    total = np.zeros((len(texts), len(model.languages)))
    queue: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        begin, hashes, buckets, _ = features(" ".join(t for _, t in queue))
        if len(begin):
            # Lower-casing may change the length of a text, so places are counted after it.
            ends = np.cumsum([len(t.lower()) + 1 for _, t in queue])
            piece = np.searchsorted(ends, begin, side="right").clip(0, len(queue) - 1)
            start = np.searchsorted(piece, piece)  # the first word of its text
            within = np.arange(len(begin)) - start
            key = piece * (1 + int(within.max()) // RUN) + within // RUN
            _, run = np.unique(key, return_inverse=True)
            p = model.marginals(model.scores(begin, buckets, model.looked_up(hashes)), run, within % RUN, int(run.max()) + 1)
            owner = np.array([i for i, _ in queue])[piece]
            for k in range(p.shape[1]):
                total[:, k] += np.bincount(owner, p[:, k], len(texts))

    for i, text in enumerate(texts):
        for part in _pieces(text or ""):
            queue.append((i, part))
            size += len(part)
            if size >= PART:
                flush()
                queue, size = [], 0
    if queue:
        flush()
    return total, total.sum(axis=1)


def _predicted(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
            if model is not None and n:
                total, words = predict(model, batch.column(1).to_pylist())
                some = words > 0
                names[some] = np.array(model.languages, object)[total[some].argmax(axis=1)]
                scores[some] = total[some].max(axis=1) / words[some]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores.clip(0, 1), pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def sample_of(docs: DataFrame, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> pd.DataFrame:
    """At most ``size`` labelled texts outside the held-out third, as even over languages as they are there."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    # Written, so that its small size is known and the texts aren't shuffled to meet it.
    counts = lineage.settled(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    languages = counts.count()
    each = max(1, size // max(1, languages))
    # Two and a half times as many rows by hash as are wanted, and of these the first.
    key = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("crf")), F.lit(1_000_000))
    some = rows.join(counts, "lang").withColumn("key", key).where(F.col("key") * F.col("n") < 2_500_000.0 * each)
    some = some.where(F.col("text").isNotNull()).dropDuplicates(["text", "lang"])
    first = Window.partitionBy("lang").orderBy("key", "doc_id")
    return some.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each).orderBy("lang", "key", "doc_id").limit(size).select("text", "lang").toPandas()


def _labelled(model: Model | None, text_at: int, lang_at: int, least: float):
    predict_rows = _predicted(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            asked = pa.RecordBatch.from_arrays([batch.column(text_at), batch.column(text_at).cast(pa.string())], ["doc_id", "text"])
            _, names, scores = next(predict_rows(iter([asked]))).columns
            kept = pc.and_(pc.not_equal(names, UNKNOWN), pc.greater_equal(scores, least))
            columns = [names if i == lang_at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([c.filter(kept) for c in columns], batch.schema.names)

    return run


def labelled(docs: DataFrame, model: Model | None, least: float = 0.5, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text has a language of at least that score, with the language as their lang."""
    return docs.mapInArrow(_labelled(model, docs.columns.index(text_col), docs.columns.index(lang_col), least), docs.schema)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(_predicted(model), f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def fitted(docs: DataFrame, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    sample = sample_of(docs, size, id_col, text_col, lang_col)
    return train(sample) if len(sample) else None
