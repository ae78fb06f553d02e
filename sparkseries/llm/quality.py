"""Quality scores: random Fourier features of document statistics, ridge regression by summed normal equations, isotonic calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, id_and_text, kept, text_slices, utf8

STATISTICS = (
    "log_chars", "log_words", "word_mean", "word_deviation", "short_words", "long_words", "distinct_words", "upper_words",
    "numeric_words", "upper", "digits", "spaces", "newlines", "stops", "commas", "exclaim", "question", "pipes", "hashes", "symbols",
    "other_punctuation", "non_ascii", "byte_entropy", "line_mean", "distinct_lines", "top_line", "tail_symbol_words", "sentence_mean",
)
FEATURES = 256
#: Steps of the score between which calibration does not tell rows apart.
BINS = 1000


def _class(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, np.int64)
    mask[list(chars)] = 1
    return mask


#: Rows of byte classes, so that one product with the byte histogram counts them all.
CLASSES = np.array([
    _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class(b"0123456789"), _class(b" \t"), _class(b"\n\r"), _class(b"."), _class(b","), _class(b"!"),
    _class(b"?"), _class(b"|"), _class(b"#"), _class(b"$%&*@^~+=<>_\\/`"), _class(b"\"'();:-[]{}"), _class(bytes(range(128, 256))),
])
SYMBOL_ENDS = tuple("#$%&*@^~+=<>|\\/`!")


def statistics(text: bytes) -> list[float]:
    """The statistics of a whole text; all 0 for an empty one."""
    size = len(text)
    if not size:
        return [0.0] * len(STATISTICS)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    classes = (CLASSES @ histogram / size).tolist()
    shares = histogram[histogram > 0] / size
    string = text.decode("utf-8", "replace")
    words = string.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = string.split("\n")
    often: dict[str, int] = {}
    for line in lines:
        often[line] = often.get(line, 0) + 1
    ends = histogram[ord(".")] + histogram[ord("!")] + histogram[ord("?")]
    return [
        math.log1p(len(string)), math.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        float((lengths <= 3).mean()), float((lengths >= 12).mean()), len(set(words)) / n, sum(map(str.isupper, words)) / n,
        sum(map(str.isnumeric, words)) / n, *classes, float(-(shares * np.log2(shares)).sum()),
        math.log1p(len(string) / len(lines)), len(often) / len(lines), max(often.values()) / len(lines),
        sum(w.endswith(SYMBOL_ENDS) for w in words) / n, math.log1p(len(words) / (1 + ends)),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats) for every row, from the whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [statistics(text) for text in utf8(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id LONG, stats ARRAY<DOUBLE>")


@dataclass
class Kernel:
    """Random Fourier features of standardised statistics: their inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, deviation: np.ndarray, width: float = 6.0, features: int = FEATURES, seed: int = 7) -> Kernel:
        random = np.random.default_rng(seed)
        return cls(mean, deviation, random.normal(0, 1 / width, (len(mean), features)), random.uniform(0, 2 * np.pi, features))

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.deviation, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(scaled @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(stats), 1))])


def stats_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def normal_equations(rows: DataFrame, kernel: Kernel) -> dict[int, np.ndarray]:
    """For each value of `fold` the sum of z zᵀ with z = (features, label) over `rows(fold, stats, label)`.

    Each partition sums its own rows; the sums meet in about the square root of as many groups before the driver adds those up.
    """
    width = FEATURES + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            labels = batch.column("label").to_numpy()
            stats = stats_matrix(batch.column("stats"))
            for at in range(0, len(folds), 4096):
                z = np.hstack([kernel(stats[at : at + 4096]), labels[at : at + 4096, None]])
                for fold in np.unique(folds[at : at + 4096]).tolist():
                    mine = z[folds[at : at + 4096] == fold]
                    sums[fold] = sums.get(fold, 0) + mine.T @ mine
        values = [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(values, ["fold", "sums"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(s) for s in table.column("sums").to_pylist()], axis=0)
        return pa.table({"fold": table.column("fold").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("fold", "stats", "label").mapInArrow(partial, "fold INT, sums BINARY")
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    merged = parts.withColumn("part", F.spark_partition_id() % groups).groupBy("fold", "part").applyInArrow(
        lambda table: merge(table.select(["fold", "sums"])), "fold INT, sums BINARY"
    )
    found: dict[int, np.ndarray] = {}
    for row in merged.toLocalIterator():
        found[row["fold"]] = found.get(row["fold"], 0) + np.frombuffer(row["sums"]).reshape(width, width)
    return found


def ridge(sums: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights that solve the normal equations, the constant unpenalised."""
    a, b, n = sums[:-1, :-1], sums[:-1, -1], sums[-2, -2]
    return np.linalg.solve(a + penalty * n * np.diag([1.0] * (len(a) - 1) + [1e-9]) + 1e-12 * np.eye(len(a)), b)


def isotonic(counts: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """The non-decreasing rates that fit the bins best (pool adjacent violators); empty bins take a value between their neighbours."""
    pools: list[list[float]] = []
    for at in np.flatnonzero(counts):
        pools.append([positives[at], counts[at], at, at])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p, c, _first, last = pools.pop()
            pools[-1][0] += p
            pools[-1][1] += c
            pools[-1][3] = last
    places = [x for pool in pools for x in (pool[2], pool[3])]
    rates = [pool[0] / pool[1] for pool in pools for _side in range(2)]
    return np.interp(np.arange(len(counts)), places, rates)


def bins_of(scores: np.ndarray) -> np.ndarray:
    """Raw scores from -0.5 to 1.5 as bin numbers."""
    return np.clip(np.floor((scores + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)


@dataclass
class QualityModel:
    kernel: Kernel | None
    weights: np.ndarray
    rates: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(stats), self.rates[0])
        raw = self.kernel(stats) @ self.weights
        return np.clip(np.interp((raw + 0.5) / 2 * BINS - 0.5, np.arange(BINS), self.rates), 0, 1)


def learn(labelled: DataFrame) -> QualityModel:
    """A model from `labelled(stats, label, fold)`, fold 0 or 1.

    Ridge scores of each fold come from the weights of the other one; their rates of label 1 per bin are calibrated. The weights
    that are used in the end come from both folds. Without labels of both kinds the score is their mean, or 0.5 without any.
    """
    moments = labelled.select(F.posexplode("stats").alias("at", "value"), "label").groupBy("at").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"), F.avg("label").alias("rate")
    )
    found = {r["at"]: r for r in moments.collect()}  # one row per statistic
    rate = found[0]["rate"] if found else 0.5
    if rate in (0.0, 1.0) or not found:
        return QualityModel(None, np.zeros(0), np.full(BINS, rate))
    mean, deviation = (np.array([found[i][name] for i in range(len(STATISTICS))]) for name in ("mean", "deviation"))
    kernel = Kernel.draw(mean, np.where(deviation > 0, deviation, 1.0))
    sums = normal_equations(labelled, kernel)
    weights = ridge(sum(sums.values()))
    others = {fold: ridge(sums[1 - fold]) if 1 - fold in sums else weights for fold in sums}

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, folds = kernel(stats_matrix(batch.column("stats"))), batch.column("fold").to_numpy()
            raw = np.sum(z * np.array([others[f] for f in folds.tolist()]).reshape(len(z), -1), axis=1) if len(z) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(bins_of(raw)), batch.column("label")], ["bin", "label"])

    tallies = (
        labelled.select("stats", "fold", "label").mapInArrow(binned, "bin INT, label DOUBLE").groupBy("bin").agg(F.count("label"), F.sum("label"))
    )
    counts, positives = np.zeros(BINS), np.zeros(BINS)
    for at, number, sure in tallies.collect():  # at most BINS rows
        counts[at], positives[at] = number, sure
    return QualityModel(kernel, weights, isotonic(counts, positives))


def held_out_rows(doc_id: Column) -> Column:
    """The documents whose labels are never learned from; a null id has no label."""
    return F.coalesce(crc_remainder(doc_id, 3) == 1, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    Scores come from statistics of the whole text only. Labels are learned from rows that are not held out; a null
    label or id is left out, and several labels of one document all count. Empty and null texts are scored like others. Rows repeat
    as they do in the input; an empty table gives an empty result.
    """
    stats = kept(document_statistics(docs, id_col, text_col))
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out_rows(F.col("doc_id")))
    labelled = kept(
        stats.join(known, "doc_id").select("stats", "label", (crc_remainder(F.col("doc_id"), 3) / 2).cast("int").alias("fold"))
    )
    model = learn(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(stats_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id LONG, score DOUBLE")
    return scored.select("doc_id", held_out_rows(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
