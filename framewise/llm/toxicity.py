"""Toxicity by compression distance: two zstandard dictionaries, windows compressed with each.

A text is taken as a sequence of words (runs of letters and digits, in lower case), each written as
sixteen bytes of its hash, and cut into windows of words. A window is compressed once with a
dictionary of ordinary text and once with a dictionary that has toxic text as well; the difference
of the two lengths is what the toxic dictionary saves. Hashes keep a word from matching a part of
another one, so that the difference comes from whole words only. A logistic curve over a text's
window differences gives the score.

zstandard trains both dictionaries. Its trainer looks for what is frequent, and in toxic text that is ordinary
words for the most part; trained on toxic text as it is, a dictionary separates hardly anything here (area under
the curve 0.6). So the toxic one is trained on what is left of the toxic texts when only the words are kept that
they hold clearly more often than ordinary texts do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.columns import whole_text, without
from framewise.llm.words import NOT_ALNUM, mix, word_hashes

#: Words of a window.
WINDOW = 32
#: Bytes of a word. A match costs zstandard about six of them, so eight would hardly show.
WIDTH = 16
#: Labelled texts of each class that are learnt from, chosen by a hash of their key.
SAMPLE = 10_000
#: Words that the toxic dictionary is trained on at most, the most telling ones first, and its bytes.
TELLING = 4_096
TOXIC = 65_536
#: Least logarithm of how much more often toxic texts hold a word, at the lower end of its error. The
#: one is taken that separates best where dictionaries come from other texts.
CLEARLY = (1.5, 2.5, 3.5, 4.5)
#: Texts that must hold it.
HOLDERS = 3
#: Parts of the sample; the curve is fitted to each part by a dictionary from the others.
FOLDS = 4
#: Bytes of the ordinary dictionary.
ORDINARY = 16_384
#: The score from which a text counts as toxic.
THRESHOLD = 0.3

_FEATURES = 5


def codes(text: str) -> np.ndarray:
    return word_hashes(text.lower().encode(), NOT_ALNUM)


def written(words: np.ndarray) -> bytes:
    """Words as they are compressed: a hash and its hash for each."""
    return np.column_stack((words, mix(words))).astype("<u8").tobytes()


#: Stands ahead of every window and in both dictionaries: zstandard stores blocks that it can't shorten by some
#: bytes as they are, and then a single word in a window of rare ones wouldn't show.
_AHEAD = written(mix(np.arange(1, 9, dtype=np.uint64)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    # A search tree over the whole dictionary: simpler matchers overlook a part of the words.
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_BTLAZY2, min_match=6, hash_log=17, chain_log=18, search_log=8, window_log=18,
        write_checksum=0, write_content_size=0, write_dict_id=0,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


@dataclass(frozen=True)
class Distance:
    """The two dictionaries, as plain bytes so that tasks can be sent them."""

    ordinary: bytes
    toxic: bytes

    @cached_property
    def _both(self) -> tuple:
        return _compressor(self.ordinary + _AHEAD), _compressor(self.toxic + self.ordinary + _AHEAD)

    def let_go(self) -> None:
        """Give the compressors' tables back, some megabytes each; they are made anew when they are needed."""
        self.__dict__.pop("_both", None)

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic}

    def features(self, text: str) -> np.ndarray:
        """What the toxic dictionary saves over the text's windows: most in one, in all, by word, and how often."""
        found = codes(text)
        data, step = written(found), WIDTH * WINDOW
        plain, toxic = self._both
        windows = [_AHEAD + data[i : i + step] for i in range(0, len(data), step)]
        saved = np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in windows] or [0])
        gain = np.maximum(saved - 4, 0)
        total = gain.sum() / 8
        return np.array(
            [
                min(gain.max(), 40) / 8,
                np.log1p(total),
                10 * min(1.0, total / max(len(found), 1)),
                np.log1p(np.count_nonzero(gain)),
                np.log1p(len(found)) if total else 0.0,
            ]
        )


@dataclass(frozen=True)
class Model:
    """``weights`` are of the features and a constant; None if there was nothing to learn."""

    distance: Distance
    weights: tuple[float, ...] | None

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        value = float(np.dot(self.weights[:-1], self.distance.features(text)) + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights by Newton's method, the constant last; the ridge keeps separable data finite."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty @ w
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-9)) @ x + penalty, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibrate(w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """``w`` with its constant moved so that ``THRESHOLD`` is where precision and recall are best together, and
    how good they are (F1) there."""
    z, none = x @ w[:-1] + w[-1], w[-1]
    order = np.argsort(-z, kind="stable")
    z = z[order]
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    # A cut can only be made between different values, and above a text in which nothing is saved.
    allowed = np.append(z[:-1] != z[1:], True) & (z > none + 1e-9)
    reached = 0.0
    if allowed.any():
        best = int(np.argmax(np.where(allowed, f1, -1)))
        cut = (z[best] + max(none, z[best + 1] if best + 1 < len(z) else none)) / 2
        reached = float(f1[best])
    else:
        cut = none + 1.0
    moved = w.copy()
    moved[-1] += np.log(THRESHOLD / (1 - THRESHOLD)) - cut
    return moved, reached


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary by zstandard's trainer; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=3 * WIDTH, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _telling(counts: pd.DataFrame, toxic: int, clean: int, clearly: float) -> np.ndarray:
    """The most telling words, the clearest first."""
    a, b = counts["toxic"] + 0.5, counts["clean"] + 0.5
    odds = np.log(a / (toxic + 1)) - np.log(b / (clean + 1)) - 1.64 * np.sqrt(1 / a + 1 / b)
    good = counts.assign(odds=odds)[(counts["toxic"] >= HOLDERS) & (odds > clearly)]
    good = good.sort_values(["odds", "code"], ascending=[False, True]).head(TELLING)
    return good["code"].to_numpy(np.int64).view(np.uint64)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """A model from labelled rows of which ``learn`` (over the labels' columns) is true.

    At most ``sample`` rows of each class are used. They are chosen by a hash of the key, and since
    their number is bounded, their keys are sent to where the texts are. Word counts are made by
    Spark; counts of words that at least ``HOLDERS`` toxic texts hold, the telling words of each sampled toxic text, a
    window of each ordinary one and a few numbers per sampled text come to the driver.

    Texts are split into ``FOLDS`` parts by a hash. The curve is fitted to differences that come from
    a dictionary of the other parts, so that it knows how telling unseen text is. Labels that are null,
    or whose key is null or has no document, are left out; a key labelled twice counts once, as toxic if
    any label says so. Without a toxic or without an ordinary text every score is 0.
    """
    spark = docs.sparkSession
    known = labels.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    chosen = [known.where(F.col("_toxic") == v).orderBy(F.xxhash64("_key"), "_key").limit(sample) for v in (0, 1)]
    # Through Arrow: for a list of rows, Spark starts further Python workers on the executors.
    chosen = spark.createDataFrame(pa.concat_tables([c.toArrow() for c in chosen]), known.schema)
    texts = docs.select(F.col(key).alias("_key"), whole_text(text).alias("_text")).join(F.broadcast(chosen), "_key")
    texts = texts.select("_key", "_toxic", F.pmod(F.xxhash64("_key", F.lit(2)), F.lit(FOLDS)).cast("int").alias("_fold"), "_text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, fold, content in zip(*(batch.column(c) for c in ("_toxic", "_fold", "_text"))):
                found = np.unique(codes(content.as_py())).view(np.int64)
                n = len(found) + 1
                # Code null counts the texts themselves.
                same = [pa.array([x.as_py()] * n, pa.int32()) for x in (toxic, fold)]
                yield pa.RecordBatch.from_arrays([pa.array([*found.tolist(), None], pa.int64()), *same], ["code", "toxic", "fold"])

    counted = (
        texts.mapInArrow(words, "code long, toxic int, fold int")
        .groupBy("code")
        .agg(*[F.count_if((F.col("toxic") == t) & (F.col("fold") == f)).alias(f"n{t}_{f}") for t in (0, 1) for f in range(FOLDS)])
    )
    toxic, clean = ([f"n{t}_{f}" for f in range(FOLDS)] for t in (1, 0))
    kept = counted.where(F.col("code").isNull() | (sum(F.col(c) for c in toxic) >= HOLDERS))
    # As text: with a null among them, pandas would round 64-bit numbers.
    kept = kept.withColumn("code", F.col("code").cast("string")).toPandas()
    total = kept[kept["code"].isna()][[*toxic, *clean]].sum()
    kept = kept[kept["code"].notna()].astype("int64")
    if not total[toxic].sum() or not total[clean].sum():
        return Model(Distance(b"", b""), None)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for content in batch.column("_text"):
                found = codes(content.as_py())
                if len(found):
                    at = int(found[0] % np.uint64(max(1, len(found) - WINDOW)))
                    out.append(written(found[at : at + WINDOW]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["window"])

    ordinary = sorted(bytes(r[0]) for r in texts.where("_toxic = 0").mapInArrow(windows, "window binary").collect())
    base = trained(ordinary, ORDINARY)

    def telling(folds: list[int], clearly: float) -> np.ndarray:
        a, b = ([c[f] for f in folds] for c in (toxic, clean))
        counts = pd.DataFrame({"code": kept["code"], "toxic": kept[a].sum(axis=1), "clean": kept[b].sum(axis=1)})
        return _telling(counts, total[a].sum(), total[b].sum(), clearly)

    subsets = [[o for o in range(FOLDS) if o != f] for f in range(FOLDS)]
    # Whatever any of the dictionaries may be trained on.
    loosest = np.unique(np.concatenate([telling(folds, min(CLEARLY)) for folds in [*subsets, list(range(FOLDS))]]))

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [codes(content.as_py()) for content in batch.column("_text")]
            found = [w[np.isin(w, loosest)].tobytes() for w in found]
            yield pa.RecordBatch.from_arrays([batch.column("_fold"), pa.array(found, pa.binary())], ["fold", "words"])

    remains = sorted((r.fold, bytes(r.words)) for r in texts.where("_toxic = 1").mapInArrow(left, "fold int, words binary").collect())

    def distance(folds: list[int], clearly: float) -> Distance:
        wanted = telling(folds, clearly)
        samples = [np.frombuffer(words, np.uint64) for fold, words in remains if fold in folds]
        samples = [written(words[np.isin(words, wanted)]) for words in samples]
        return Distance(base, trained([s for s in samples if s], TOXIC))

    others = [[distance(folds, c) for c in CLEARLY] for folds in subsets]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, found = batch.column("_fold").to_pylist(), [[] for _ in range(batch.num_rows)]
            # One pair of dictionaries at a time is held ready.
            for fold in set(folds):
                for d in others[fold]:
                    for i, t in enumerate(batch.column("_text")):
                        if folds[i] == fold:
                            found[i] += d.features(t.as_py()).tolist()
                    d.let_go()
            yield pa.RecordBatch.from_arrays([batch.column("_toxic"), pa.array(found, pa.list_(pa.float64()))], ["toxic", "features"])

    measured = texts.mapInArrow(measure, "toxic int, features array<double>").toPandas()
    measured["features"] = measured["features"].map(tuple)
    measured = measured.sort_values(["toxic", "features"])
    x, y = np.array(measured["features"].tolist()).reshape(-1, len(CLEARLY), _FEATURES), measured["toxic"].to_numpy(float)
    tried = [(*calibrate(fit_logistic(x[:, i], y), x[:, i], y), c) for i, c in enumerate(CLEARLY)]
    weights, _, clearly = max(tried, key=lambda t: t[1])
    return Model(distance(list(range(FOLDS)), clearly), tuple(float(v) for v in weights))


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on, else 0).

    Only the text is looked at, as a whole and window by window. Null and empty texts, and texts
    without words, have the score of a text in which nothing is saved. Equal texts score alike,
    whatever else their rows hold. Input columns of the two names are replaced, other columns
    pass through, an empty table gives an empty table.
    """

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    scored = without(docs, "score", "predicted").withColumn("score", scores(whole_text(text)))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
