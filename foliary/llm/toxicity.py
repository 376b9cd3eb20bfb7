"""Toxicity by gradient-boosted trees over dense text features, calibrated by isotonic regression.

A bounded sample of labelled rows is fitted, cross-fitted over folds: words and
word stems that go with the label (the learned lexicon) are found in the other
folds of a row, trees grow on features so found, and what trees of the other
folds say of a row calibrates. Features of a document are densities of a fixed and of the
learned lexicon, closeness to second-person words, capitals, punctuation and
signs of obfuscation; language, source and id are no inputs. Every document is
scored whole, in place, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.llm.bpe import WordCache
from foliary.llm.common import bound_batches, discard, few, hold, map_texts, materialise, text_slices, texts_of
from foliary.llm.trees import BoostedTrees, isotonic

#: The bound on labelled rows that are fitted.
MOST_ROWS = 12_000
#: Labelled rows that a task takes.
TASK_ROWS = 600
#: Folds of the fit.
FOLDS = 5
#: Share of a score that is the trees' own probability.
ORDER_SHARE = 0.01
#: Words whose codes a worker keeps, twice over.
MOST_WORDS = 30_000
#: Toxic documents that must hold a stem.
LEAST_HOLDERS = 4
#: The bound on learned stems.
MOST_STEMS = 400
THRESHOLD = 0.3

#: Insults, and words of the second person.
LEXICON = frozenset(
    "idiot idiots moron morons stupid dumb dumbass loser losers scum clown clowns trash garbage pathetic worthless disgusting "
    "ugly fool foolish imbecile cretin dimwit jerk bastard bitch crap damn shit fuck fucking asshole whore slut creep freak "
    "vermin filth filthy pig rat coward hate hateful despicable vile nasty useless sick liar hypocrite brainless ignorant "
    "lunatic maniac psycho retard scumbag sleazy spineless twit wretch kill die "
    "idiote imbécile débile connard salope merde crétin abruti ordure dummkopf arschloch scheiße blöd trottel "
    "dreck abschaum estúpido imbécil basura mierda puta cabrón asqueroso inútil".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton vous votre du dich dir dein deine ihr usted ustedes tú tus vos".split())
#: Signs that stand in for letters.
DISGUISE = str.maketrans("013457@$!|", "oieastasii")

_STRIP = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[a-z][\d@$!|*._-]+[a-z]")
# Bits of a word's code; above them the number of its learned stem, 0 for none.
_SEED, _YOU, _CAPITAL, _SHOUT, _HIDDEN, _MIXED, _SHIFT = 1, 2, 4, 8, 16, 32, 6
NAMES = (
    "log_words", "seed_share", "seed_kinds", "stem_weight", "stem_share", "stem_hits", "stem_kinds", "stem_top", "you_share",
    "you_near", "capital_share", "shout_share", "exclaim", "other_punct", "mixed_share", "hidden_hits", "digit_share",
)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def clean(word: str) -> str:
    return _STRIP.sub("", word.lower())


def stems_of(word: str) -> list[str]:
    """The word itself and its beginnings of 3 to 8 letters."""
    return [word[:n] for n in range(3, min(9, len(word)))] + [word]


@dataclass
class Model:
    """Everything a worker needs to score; some hundred kilobytes at most."""

    stems: dict[str, tuple[int, float]] = field(default_factory=dict)
    trees: BoostedTrees = field(default_factory=BoostedTrees)
    knots: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_codes"}

    def release(self) -> None:
        """Forget the words met so far."""
        self.__dict__.pop("_codes", None)

    def code(self, word: str) -> int:
        plain = clean(word)
        out = 0
        if plain in LEXICON:
            out |= _SEED
        elif plain in SECOND_PERSON:
            out |= _YOU
        if word[:1].isupper():
            out |= _CAPITAL
            if len(plain) > 2 and word.upper() == word:
                out |= _SHOUT
        if not plain.isalpha() and _INNER.search(plain):
            out |= _MIXED
            if clean(plain.translate(DISGUISE)) in LEXICON or re.sub(r"[\W_]+", "", plain) in LEXICON:
                out |= _HIDDEN
        for n in [len(plain), *range(min(8, len(plain) - 1), 2, -1)] if self.stems else ():
            hit = self.stems.get(plain[:n])
            if hit:
                return out | hit[0] << _SHIFT
        return out

    def features(self, text: str) -> np.ndarray:
        codes = self.__dict__.get("_codes")
        if codes is None:
            codes = self.__dict__["_codes"] = WordCache(self.code, MOST_WORDS)
            self.weights = np.zeros(len(self.stems) + 1)
            for number, weight in self.stems.values():
                self.weights[number] = weight
        words = text.split()
        n = len(words)
        out = np.zeros(len(NAMES))
        if not n:
            return out
        c = np.fromiter(map(codes.__getitem__, words), np.int64, n)
        per = 100.0 / n
        seed, you = (c & (_SEED | _HIDDEN)) > 0, (c & _YOU) > 0
        stem = c >> _SHIFT
        hit = np.flatnonzero(stem)
        bad = np.union1d(np.flatnonzero(seed), hit)
        out[0] = np.log1p(n)
        out[1] = seed.sum() * per
        out[2] = len({clean(words[i]) for i in np.flatnonzero(seed).tolist()})
        if len(hit):
            weight = self.weights[stem[hit]]
            out[3:8] = weight.sum() * per, len(hit) * per, len(hit), len(np.unique(stem[hit])), weight.max()
        out[8] = you.sum() * per
        if len(bad) and you.any():
            at = np.flatnonzero(you)
            right = np.searchsorted(at, bad)
            gap = np.minimum(np.abs(bad - at[np.minimum(right, len(at) - 1)]), np.abs(bad - at[np.maximum(right - 1, 0)]))
            out[9] = (1.0 / (1.0 + gap)).sum() * per
        out[10] = ((c & _CAPITAL) > 0).sum() * per
        out[11] = ((c & _SHOUT) > 0).sum() * per
        size = len(text)
        out[12] = (text.count("!") + text.count("?")) * 100.0 / size
        out[13] = sum(map(text.count, "#$%&*@")) * 100.0 / size
        out[14] = ((c & _MIXED) > 0).sum() * per
        out[15] = ((c & _HIDDEN) > 0).sum()
        out[16] = sum(map(text.count, "0123456789")) * 100.0 / size
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        raw = self.trees.raw(np.stack([self.features(t) for t in texts]))
        level = np.interp(raw, *self.knots)
        if self.trees.feature is not None:  # within a calibrated step the trees' order stays
            level = (1 - ORDER_SHARE) * level + ORDER_SHARE / (1 + np.exp(-raw))
        return np.clip(level, 0.0, 1.0)


@dataclass
class StemCounts:
    """In how many labelled documents of each fold a stem is, by label; and how many there are."""

    names: list[str]
    held: np.ndarray  # label x fold x stem
    documents: np.ndarray  # label x fold

    def learned(self, folds: list[int]) -> dict[str, tuple[int, float]]:
        """Stems that more toxic documents of the folds hold than their share explains.

        A stem is kept if its documents are at least 6 standard deviations more
        toxic than all; its weight is the smoothed log odds ratio.
        """
        clean_n, toxic_n = self.documents[:, folds].sum(axis=1).tolist()
        if not min(clean_n, toxic_n):
            return {}
        p = toxic_n / (clean_n + toxic_n)
        b, a = self.held[:, folds].sum(axis=1).astype(float)
        z = (a - (a + b) * p) / np.sqrt(np.maximum(a + b, 1) * p * (1 - p))
        weight = np.log((a + 0.5) / (toxic_n + 1)) - np.log((b + 0.5) / (clean_n + 1))
        kept = sorted((-z[i], self.names[i], float(weight[i])) for i in np.flatnonzero((a >= LEAST_HOLDERS) & (z >= 6)))
        return {stem: (n, w) for n, (_, stem, w) in enumerate(kept[:MOST_STEMS], 1)}


def near_key(words: list[str]) -> int:
    """The least hash of a text's word triples: near copies have the same one mostly."""
    return min((zlib.crc32(" ".join(words[i : i + 3]).encode("utf-8", "replace")) for i in range(max(1, len(words) - 2))), default=0)


def _words(text: str) -> list[str]:
    return [w for w in map(clean, text.split()) if len(w) > 2]


def _count_stems(sample: DataFrame, most_rows: int) -> StemCounts:
    """Counts over the sample (raw, label), in which texts of one near key and label count once. Texts stay on the executors."""

    def run(batches):
        hold("toxicity stems")
        for batch in batches:
            for piece in text_slices(batch, "raw"):
                words = [_words(t) for t in texts_of(piece, "raw")]
                keys = [near_key(w) for w in words]
                found = [sorted({s for x in set(w) for s in stems_of(x)}) for w in words]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), piece.column("label"), piece.column("h"), pa.array(found, pa.list_(pa.string()))], ["near", "label", "h", "stems"])

    told = sample.mapInArrow(run, "near bigint, label int, h bigint, stems array<string>")
    once = materialise(few(told.groupBy("near", "label").agg(F.min_by("stems", "h").alias("stems")), most_rows, TASK_ROWS).withColumn("fold", F.col("near") % FOLDS))
    kinds = [(y, k) for y in (0, 1) for k in range(FOLDS)]
    here = lambda y, k: F.count_if((F.col("label") == y) & (F.col("fold") == k))
    documents = np.array(once.agg(*[here(y, k) for y, k in kinds]).first(), np.int64).reshape(2, FOLDS)
    by_stem = once.select("label", "fold", F.explode("stems").alias("stem")).groupBy("stem").agg(*[here(y, k).alias(f"n{y}_{k}") for y, k in kinds])
    table = by_stem.where(sum(F.col(f"n1_{k}") for k in range(FOLDS)) >= LEAST_HOLDERS).toArrow()
    held = np.array([table[f"n{y}_{k}"].to_numpy() for y, k in kinds], np.int64).reshape(2, FOLDS, -1)
    names = table["stem"].to_pylist()
    discard(once)
    return StemCounts(names, held, documents)


def _features(sample: DataFrame, models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and folds of the sample; each text is seen through the stems of the folds that it is not in."""
    shipped = sample.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        hold("toxicity fit", lambda: [m.release() for m in shipped.value])
        for batch in batches:
            for piece in text_slices(batch, "raw"):
                texts = texts_of(piece, "raw")
                folds = [near_key(_words(t)) % FOLDS for t in texts]
                x = [shipped.value[k].features(t) for k, t in zip(folds, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("h"), piece.column("label"), pa.array(folds, pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["h", "label", "fold", "x"])

    found = sample.mapInArrow(run, "h bigint, label int, fold int, x array<double>").toArrow()
    order = np.lexsort((found["label"].to_numpy(), found["h"].to_numpy()))
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES))
    return x[order], found["label"].to_numpy()[order].astype(float), found["fold"].to_numpy()[order]


def cross_fitted(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple[BoostedTrees, tuple[np.ndarray, np.ndarray]]:
    """Trees of all rows, and the isotonic calibration of what trees of the other folds say of each row."""
    raw = np.zeros(len(y))
    for k in np.unique(fold):
        rest = fold != k
        if rest.any():
            raw[~rest] = BoostedTrees().fit(x[rest], y[rest]).raw(x[~rest])
    return BoostedTrees().fit(x, y), isotonic(raw, y)


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most ``most_rows`` labelled rows that are not held out, chosen by a hash of the id.

    Rows with a null label, null id or no document are left out. An id with
    two labels is fitted with both; of documents with equal ids one text (the
    least) is. Labels of one kind only give the constant score of that kind,
    none give 0. The rule is one at all sizes: stems, trees and calibration are
    cross-fitted over FOLDS folds, in which near copies share a fold. The
    driver gets counts and features, never texts.
    """
    told = (F.col(label_col) > 0).cast("int").alias("label")
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("labelled"), told).distinct()
    chosen = chosen.orderBy(F.xxhash64("labelled"), "labelled", "label").limit(most_rows)
    texts = docs.select(F.col(id_col).alias("labelled"), F.coalesce(F.col(text_col), F.lit("")).alias("raw")).join(F.broadcast(chosen), "labelled")
    bound_batches(docs.sparkSession)
    once = few(texts.groupBy("labelled", "label").agg(F.min("raw").alias("raw")), most_rows, TASK_ROWS)
    sample = materialise(once.select("raw", "label", F.xxhash64("raw", "labelled").alias("h")))
    model = Model()
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(n) < 2:
        model.knots = (np.zeros(1), np.array([float(*n)] if n else [0.0]))
        return model
    counts = _count_stems(sample, most_rows)
    model.stems = counts.learned(list(range(FOLDS)))
    model.trees, model.knots = cross_fitted(*_features(sample, [Model(counts.learned([f for f in range(FOLDS) if f != k])) for k in range(FOLDS)]))
    discard(sample)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row; null texts are empty and get the score of a text without words."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_STEMS, trees and knots

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold(f"toxicity {id(shipped.value)}", shipped.value.release)
        s = shipped.value.score(texts_of(batch, text_col))
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [id_col, "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], text_col, f"`{id_col}` {kind}, score double, predicted int", work).select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")


def toxic_filter(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score under the threshold. Row by row: no join, so ids may repeat or be null."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        hold(f"toxicity {id(shipped.value)}", shipped.value.release)
        for batch in batches:
            for piece in text_slices(batch, text_col):
                clean = shipped.value.score(texts_of(piece, text_col)) < threshold
                yield piece.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
