"""Language identification in two steps: the family first, then one-versus-one linear support vector machines inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_remainder, id_and_text, kept, text_slices

# Families of closely related languages by ISO 639-1 code; a language in none of them is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "austronesian": ("id", "ms", "jv", "tl"),
    "sinitic": ("zh", "yue"),
}
UNKNOWN = "und"
#: Hashed n-grams of one to three letters.
FEATURES = 1 << 12
#: The most documents per language from which the machines are learned.
PER_LANGUAGE = 1000
#: From this score on a language found stands against the one that a row says.
SURE = 0.9
#: Code points of a text that are counted at once.
STRETCH = 1 << 20


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


class Letters:
    """Lower-case letters by code point; 0 for all else."""

    def __init__(self) -> None:
        chars = [chr(c) for c in range(1 << 16)]
        self.low = np.array([self._lower(c) for c in chars], np.uint32)

    @staticmethod
    def _lower(char: str) -> int:
        low = char.lower()
        return (ord(low) if len(low) == 1 else ord(char)) if char.isalpha() else 0

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        low = self.low[np.minimum(codes, 0xFFFF)]
        for code in np.unique(codes[codes > 0xFFFF]):
            low[codes == code] = self._lower(chr(code))
        return low


def ngram_counts(text: str, letters: Letters) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it has no letter. Runs of other characters count as one border."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts, some = np.zeros(FEATURES, np.int64), False
    tail = np.zeros(1, np.uint32)
    for at in range(0, len(codes), STRETCH):
        low = letters(codes[at : at + STRETCH])
        some = some or bool(low.any())
        low = np.concatenate([tail, low, np.zeros(int(at + STRETCH >= len(codes)), np.uint32)])
        low = low[np.concatenate([[True], (low[1:] != 0) | (low[:-1] != 0)])]
        fresh = len(tail)
        tail = low[-2:]
        one = low * np.uint32(0x9E3779B1)
        two = one[1:] ^ (low[:-1] * np.uint32(0x85EBCA77) + np.uint32(1))
        three = two[1:] ^ (low[:-2] * np.uint32(0xC2B2AE3D) + np.uint32(2))
        grams = np.concatenate([one[fresh:], two[fresh - 1 :], three[max(0, fresh - 2) :]])
        grams = (grams * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 12)
        counts += np.bincount(grams, minlength=FEATURES)
    return counts if some else None


def vectors(texts: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of square-rooted counts, and which texts have letters."""
    found = [ngram_counts(text, letters) for text in texts]
    some = np.array([c is not None for c in found], bool)
    rows = np.array([np.sqrt(c / c.sum()) for c in found if c is not None], np.float32).reshape(-1, FEATURES)
    return rows, some


def linear_svm(rows: np.ndarray, signs: np.ndarray, strength: float = 10.0, rounds: int = 100) -> np.ndarray:
    """Weights (and a bias at the end) of the squared-hinge machine, by accelerated gradient steps; classes weigh the same."""
    x = np.hstack([rows, np.ones((len(rows), 1), rows.dtype)]).astype(np.float32)
    signs = signs.astype(np.float32)
    share = np.where(signs > 0, 0.5 / max(1, (signs > 0).sum()), 0.5 / max(1, (signs < 0).sum())) * strength
    share = share.astype(np.float32)
    probe = np.ones(x.shape[1], np.float32)
    for _step in range(15):
        probe = x.T @ (share * (x @ probe))
        size = np.linalg.norm(probe)
        probe /= size
    step = np.float32(1 / (1e-2 + 2 * size * 1.1))
    w = ahead = np.zeros(x.shape[1], np.float32)
    for number in range(rounds):
        short = np.maximum(0, 1 - signs * (x @ ahead))
        moved = ahead - step * (np.float32(1e-2) * ahead - 2 * (x.T @ (share * signs * short)))
        ahead = moved + np.float32(number / (number + 3)) * (moved - w)
        w = moved
    return w


@dataclass
class OneVersusOne:
    """Machines between all pairs of some classes; the most votes win, then the larger sum of margins, then the smaller name."""

    classes: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, FEATURES + 1)))

    @classmethod
    def of(cls, classes: list[str], machines: dict[tuple[str, str], np.ndarray]) -> OneVersusOne:
        classes = sorted(classes)
        weights = [machines[pair] for pair in combinations(classes, 2)]
        return cls(classes, np.array(weights, np.float32).reshape(-1, FEATURES + 1))

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class number of each row, and how sure its weakest machine is, from 0 to 1."""
        if len(self.classes) == 1:
            return np.zeros(len(rows), int), np.ones(len(rows))
        margins = rows @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sums, least = (np.zeros((len(rows), len(self.classes))) for _ in range(3))
        least += np.inf
        for number, (a, b) in enumerate(combinations(range(len(self.classes)), 2)):
            m = margins[:, number]
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            for side, value in ((a, m), (b, -m)):
                sums[:, side] += value
                least[:, side] = np.minimum(least[:, side], value)
        best = np.lexsort((np.broadcast_to(-np.arange(len(self.classes)), votes.shape), sums, votes), axis=1)[:, -1]
        return best, 1 / (1 + np.exp(-4 * least[np.arange(len(rows)), best]))


@dataclass
class LanguageModel:
    families: OneVersusOne
    members: dict[str, OneVersusOne]

    @classmethod
    def of(cls, langs: list[str], machines: dict[str, dict[tuple[str, str], np.ndarray]]) -> LanguageModel:
        """From the machines between families (under the name "") and between the members of each family."""
        members: dict[str, list[str]] = {}
        for lang in langs:
            members.setdefault(family_of(lang), []).append(lang)
        within = {f: OneVersusOne.of(own, machines.get(f, {})) for f, own in members.items()}
        return cls(OneVersusOne.of(list(members), machines.get("", {})), within)

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, score = self.families.predict(rows)
        langs = np.empty(len(rows), object)
        for number, name in enumerate(self.families.classes):
            mine = np.flatnonzero(family == number)
            if len(mine):
                member, sure = self.members[name].predict(rows[mine])
                langs[mine] = [self.members[name].classes[m] for m in member]
                score[mine] *= sure
        return langs.tolist(), score


def identified(texts: list[str | None], model: LanguageModel | None, letters: Letters) -> tuple[list[str], np.ndarray]:
    """The language and score of each text; texts are turned into vectors some hundred at a time."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for start in range(0, len(texts), 512):
        rows, some = vectors([t or "" for t in texts[start : start + 512]], letters)
        if model is not None and len(rows):
            found, sure = model.predict(rows)
            places = start + np.flatnonzero(some)
            scores[places] = sure
            for at, lang in zip(places.tolist(), found, strict=True):
                langs[at] = lang
    return langs, scores


def draw_sample(
    docs: DataFrame, learn_from: Column, id_col: str, text_col: str, lang_col: str, per_language: int
) -> DataFrame:
    """(doc_id, lang, family, with_family, row): the vectors from which machines are learned, at most `per_language` of each language.

    `with_family` marks those that speak for the family as well, at most as many of each family. Which documents are drawn depends on a hash of
    their ids alone.
    """
    rows = docs.where(learn_from & docs[lang_col].isNotNull() & docs[id_col].isNotNull() & docs[text_col].isNotNull())
    families = {lang: name for name, members in FAMILIES.items() for lang in members}
    known = F.create_map(*[F.lit(x) for pair in families.items() for x in pair])
    ids = rows.select(rows[id_col].cast("long").alias("doc_id"), rows[lang_col].alias("lang")).distinct()
    # Ids are thinned out by their hash before they are ranked, so that a frequent language sends few of them to one task.
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).cast("double") / (1 << 30)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (
        ids.join(sizes, "lang")
        .where(draw * F.col("size") < 1.25 * per_language + 50)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("place") <= per_language)
        .withColumn("family", F.coalesce(F.try_element_at(known, F.col("lang")), "lang"))
        .withColumn("in_family", F.row_number().over(Window.partitionBy("family").orderBy(*order, "lang")))
        .select("doc_id", "lang", "family", (F.col("in_family") <= per_language).alias("with_family"))
    )
    texts = rows.select(rows[id_col].cast("long").alias("doc_id"), rows[lang_col].alias("lang"), rows[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for part in text_slices(batches):
            found, some = vectors(part.column("text").to_pylist(), letters)
            kept_rows = part.filter(pa.array(some, pa.bool_()))
            columns = [kept_rows.column(c) for c in ("doc_id", "lang", "family", "with_family")]
            rows_out = pa.array([r.astype("<f2").tobytes() for r in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, rows_out], ["doc_id", "lang", "family", "with_family", "row"])

    # The chosen ids are at most `per_language` for each language, so sending them to every task is bounded.
    joined = texts.join(F.broadcast(chosen), ["doc_id", "lang"])
    return joined.mapInArrow(run, "doc_id LONG, lang STRING, family STRING, with_family BOOLEAN, row BINARY")


def learn(
    docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> LanguageModel | None:
    """A model from at most `per_language` documents of each language, drawn by a hash of their id.

    `learn_from` says which rows may be learned from. Rows without a language, without an id or without a letter are left out;
    None if no row is left. Each machine is trained in a task of its own from the vectors of its two classes, at most `per_language`
    each; only its weights, 16 KB, come back.
    """
    sample = kept(draw_sample(docs, learn_from, id_col, text_col, lang_col, per_language))
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())  # as many as there are languages
    if not langs:
        return None
    families = sorted({family_of(lang) for lang in langs})
    others = {lang: [o for o in langs if o != lang and family_of(o) == family_of(lang)] for lang in langs}

    def pairs(own: str, rest: str, level: str) -> Column:
        """The machines a row goes to: its class with each other class."""
        every = F.transform(rest, lambda o: F.struct(
            F.expr(level).alias("level"), F.least(F.col(own), o).alias("a"), F.greatest(F.col(own), o).alias("b"), (F.col(own) < o).alias("first")
        ))
        return every

    siblings = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.array(*[F.lit(o) for o in others[lang]]).cast("array<string>"))])
    dealt = sample.withColumns({
        "siblings": F.try_element_at(siblings, F.col("lang")),
        "rivals": F.filter(F.array(*[F.lit(f) for f in families]), lambda f: F.col("with_family") & (f != F.col("family"))),
    })
    dealt = dealt.select("doc_id", "row", F.inline(F.concat(pairs("lang", "siblings", "family"), pairs("family", "rivals", "''"))))

    def train(rows: pa.Table) -> pa.Table:
        level, a, b = (rows.column(c)[0].as_py() for c in ("level", "a", "b"))
        rows = rows.sort_by([("doc_id", "ascending"), ("first", "ascending"), ("row", "ascending")]) if rows.num_rows > 1 else rows
        found = np.frombuffer(b"".join(rows.column("row").to_pylist()), "<f2").reshape(rows.num_rows, FEATURES).astype(np.float32)
        weights = linear_svm(found, np.where(rows.column("first").to_numpy(), 1.0, -1.0))
        return pa.table({"level": [level], "a": [a], "b": [b], "weights": [weights.astype("<f4").tobytes()]})

    trained = dealt.groupBy("level", "a", "b").applyInArrow(train, "level STRING, a STRING, b STRING, weights BINARY")
    machines: dict[str, dict[tuple[str, str], np.ndarray]] = {}
    for r in trained.collect():
        machines.setdefault(r["level"], {})[r["a"], r["b"]] = np.frombuffer(r["weights"], "<f4")
    return LanguageModel.of(langs, machines)


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from its text alone.

    A null text or one without a letter is `und` with score 0, and so is every text if nothing was learned. Rows repeat as they
    do in the input, null ids stay null, an empty table gives an empty result. Texts are read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for part in text_slices(batches):
            langs, scores = identified(part.column("text").to_pylist(), model, letters)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id LONG, lang_pred STRING, score DOUBLE")


def keep_identified(
    docs: DataFrame, model: LanguageModel | None, text_col: str = "text", lang_col: str = "lang", sure: float = SURE
) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text has a language; null texts and texts without a letter go.

    The language column tells what the text is in: where it is null it gets the language found, and so it does where it says otherwise and the
    score is `sure` or more. A text with a letter stays, its row as it is, if nothing was learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            if model is None:
                yield batch.filter(pa.array([ngram_counts(t or "", letters) is not None for t in texts], pa.bool_()))
                continue
            langs, scores = identified(texts, model, letters)
            at = batch.schema.get_field_index(lang_col)
            said = batch.column(at).to_pylist()
            told = [f if f != UNKNOWN and (s is None or (s != f and p >= sure)) else s for f, s, p in zip(langs, said, scores.tolist(), strict=True)]
            known = [lang != UNKNOWN or ngram_counts(t or "", letters) is not None for lang, t in zip(langs, texts, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(told, batch.schema.field(at).type)).filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out_rows(doc_id: Column) -> Column:
    """The documents that are never learned from; a null id is not held out and not learned from."""
    return F.coalesce(crc_remainder(doc_id, 4) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row: a model from the rows that are not held out, applied to all."""
    model = learn(docs, ~held_out_rows(docs["doc_id"]))
    return predict(docs, model).withColumn("held_out", held_out_rows(F.col("doc_id")))
