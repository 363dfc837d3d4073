"""Language identification with hyperdimensional profiles.

Every letter of any script has a random vector of +1 and -1 of its own. A run of n letters becomes one vector: the letter
vectors, rolled by their place in the run, multiplied together. A text is the sum of the vectors of
its runs, a language the sum of its training texts, and a text takes the language of largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.session import private, table

DIM, GRAM, SEED = 1024, 3, 20240601
#: Code points; 0 stands for the word break, whose vector is one of its own.
POINTS = 0x110000
#: Texts of about so many symbols are bundled in one matrix product.
BATCH_SYMBOLS = 100_000
#: Expected number of training texts of each language.
TRAIN_ROWS = 1000
UNKNOWN = "und"


class Encoder:
    """Bundles texts into vectors; one per Python worker. A letter's vector is drawn from its code point when it is first met."""

    def __init__(self) -> None:
        self.letter = np.fromiter(map(str.isalpha, map(chr, range(POINTS))), dtype=bool, count=POINTS)
        #: Place of each letter among the vectors, -1 before it is met; the vectors, rolled for each place in a run.
        self.place = np.full(POINTS, -1, dtype=np.int32)
        self.n, self.rolled = 0, [np.zeros((64, DIM), dtype=np.int8) for _ in range(GRAM)]

    def meet(self, points: np.ndarray) -> None:
        for p in points[self.place[points] < 0]:
            if self.n == len(self.rolled[0]):
                self.rolled = [np.concatenate([r, np.zeros_like(r)]) for r in self.rolled]
            vector = np.random.default_rng([SEED, int(p)]).choice(np.array([-1, 1], dtype=np.int8), size=DIM)
            for k in range(GRAM):
                self.rolled[k][self.n] = np.roll(vector, GRAM - 1 - k)
            self.place[p] = self.n
            self.n += 1

    def symbols(self, text: str) -> np.ndarray:
        """Code points of a whole text's letters, each run of others as one break, with a break at both ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        s = np.zeros(len(points) + 2, dtype=np.uint32)
        np.multiply(points, self.letter[points], out=s[1:-1])
        return s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]

    def grams(self, symbols: np.ndarray) -> np.ndarray:
        """Runs of symbols that have been met as numbers, by their places."""
        s = self.place[symbols].astype(np.int32 if self.n**GRAM < 1 << 31 else np.int64)
        code = np.zeros(max(0, len(s) - GRAM + 1), dtype=s.dtype)
        for k in range(GRAM):
            code = code * self.n + s[k : len(s) - GRAM + 1 + k]
        return code

    def bundle(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One row of DIM numbers for each text, and whether it has a letter."""
        out, lettered = np.zeros((len(texts), DIM), dtype=np.float32), np.zeros(len(texts), dtype=bool)
        at = 0
        while at < len(texts):
            begin, many, size = at, [], 0
            while at < len(texts) and (not many or size < BATCH_SYMBOLS):
                many.append(self.symbols(texts[at]))
                size += len(many[-1])
                lettered[at] = bool(many[-1].any())
                at += 1
            met = np.zeros(POINTS, dtype=bool)
            met[np.concatenate(many)] = True
            self.meet(np.flatnonzero(met))
            codes = [self.grams(s) for s in many]
            seen, column = np.unique(np.concatenate(codes), return_inverse=True)
            owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
            counts = np.bincount(owner * len(seen) + column, minlength=len(codes) * len(seen)).reshape(len(codes), len(seen))
            rest, vectors = seen.copy(), np.ones((len(seen), DIM), dtype=np.int8)
            for k in reversed(range(GRAM)):
                vectors *= self.rolled[k][rest % self.n]
                rest //= self.n
            out[begin:at] = counts.astype(np.float32) @ vectors.astype(np.float32)
        return out, lettered


_encoder: list[Encoder] = []


def encoder() -> Encoder:
    if not _encoder:
        _encoder.append(Encoder())
    return _encoder[0]


@dataclass(frozen=True)
class Profiles:
    """Language prototypes: unit rows, one for each learned language."""

    langs: tuple[str, ...]
    vectors: np.ndarray


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS, key: str = "doc_id") -> Profiles:
    """Prototypes from about ``train_rows`` texts of each language, taken by a hash of ``key``.

    Rows with a null text or language teach nothing, nor do rows with a null key; repeated rows teach each; other columns
    aren't read. An empty table gives profiles of no language. The bound is on the training sample alone.
    What reaches the driver is one row of numbers for each language and task.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return Profiles((), np.zeros((0, DIM), dtype=np.float32))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_rows / n))])
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col(key)), F.lit(1_000_000)) / 1_000_000.0
    # a language of few rows is learned from all of them
    sample = rows.where(draw < F.element_at(share, F.col(lang))).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for name, part in pdf.groupby("lang"):
                v, _ = encoder().bundle(part["text"].tolist())
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                v = (v / np.maximum(norm, 1e-9)).sum(axis=0)
                sums[name] = sums.get(name, 0) + v
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.astype(np.float64).tobytes() for v in sums.values()]})

    total: dict[str, np.ndarray] = {}
    for r in sample.mapInPandas(add, "lang string, v binary").collect():
        total[r.lang] = total.get(r.lang, 0) + np.frombuffer(bytes(r.v))
    langs = tuple(sorted(total))
    vectors = np.array([total[k] for k in langs]).reshape(len(langs), DIM)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(langs, (vectors / np.maximum(norm, 1e-9)).astype(np.float32))


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine with that prototype, 0 to 1) and margin over the next language.

    lang_pred is ``und`` and score 0 where the text is null, empty or without letters, or where nothing
    was learned. Ties go to the first language by name. Texts are read whole, however long. Columns of these names are
    replaced, all others kept; repeated rows and repeated ids are each judged on their own. An empty table gives an empty table.
    """
    made = ("lang_pred", "score", "margin")
    keep = [c for c in docs.columns if c not in made]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf[text].where(pdf[text].notna(), "")]
            v, lettered = encoder().bundle(texts)
            norm = np.linalg.norm(v, axis=1)
            if len(profiles.langs):
                cosine = (v @ profiles.vectors.T) / np.maximum(norm, 1e-9)[:, None]
                best = cosine.argmax(axis=1)
                top = cosine[np.arange(len(texts)), best]
                second = np.sort(cosine, axis=1)[:, -2] if len(profiles.langs) > 1 else np.zeros(len(texts))
            else:
                lettered, best, top, second = np.zeros(len(texts), bool), None, np.zeros(len(texts)), np.zeros(len(texts))
            yield pd.DataFrame({
                "lang_pred": [profiles.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)] if best is not None else [UNKNOWN] * len(texts),
                "score": np.where(lettered, np.clip(top, 0, 1), 0).astype(float),
                "margin": np.where(lettered, top - second, 0).astype(float),
            })

    @F.pandas_udf("lang_pred string, score double, margin double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from judge(s.to_frame(text) for s in batches)

    (own,) = private(docs, "_judged")
    # a filter on the result would otherwise be given a run of the function of its own
    judged = judged.asNondeterministic()
    return docs.select(*keep, judged(F.col(text)).alias(own)).select(*keep, *(F.col(f"{own}.{c}").alias(c) for c in made))


def held_out(key: str = "doc_id"):
    """Rows whose crc32 of the id's text leaves 2 when divided by 4 teach nothing."""
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = fit_profiles(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return predict(docs.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out")), profiles).select(
        "doc_id", "held_out", "lang_pred", "score", "margin"
    )


QUERIES = {"op1_language_id": op1_language_id}
SQL: dict[str, str] = {}
