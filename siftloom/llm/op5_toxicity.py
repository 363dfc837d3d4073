"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

All terms of the examples are in an inverted index: rare terms as posting lists, common ones (most of the
postings) as columns of weights in blocks of examples. For every common term a block knows its largest
weight, so the cosine over rare terms and a sum over the query's common ones bound an example's cosine;
common terms are only summed up where the bound reaches the nearest examples. The nearest examples vote
with their cosines, and the votes are calibrated on the examples themselves, each judged without itself
and its copies.

Texts are searched some at a time, so that a block's common terms are summed up for all texts that need the
block by one product of matrices. Those sums are in single precision and only choose candidates; the cosines
of candidates are summed up anew, text by text, so they do not depend on the texts beside it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.session import private, table

#: Expected number of example texts of each class; examples in a block; neighbours that vote.
EXAMPLES, BLOCK, NEIGHBOURS = 2500, 64, 15
#: Terms of more than one in so many examples are common; blocks that are searched first.
COMMON, FIRST_BLOCKS = 10, 8
#: Texts whose terms are looked up at a time, and that are searched at a time.
READ, AT_ONCE = 2048, 64
#: Lengths of word starts that are terms beside whole words.
STARTS = (4, 5, 6)
THRESHOLD, SEED = 0.3, 7
_WORD = re.compile(r"\w+")


def word_terms(word: str) -> tuple[str, ...]:
    """The word and its starts, which are marked by an ending star."""
    return (word, *(word[:n] + "*" for n in STARTS if len(word) > n))


def text_terms(text: str) -> Counter:
    """Number of occurrences of each term in a whole text."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for t in word_terms(word):
            out[t] += n
    return out


class Vocabulary:
    """Places of terms in the index, looked up for many words at once."""

    def __init__(self, place: dict[str, int]) -> None:
        self.terms, self.place = pa.array(place, pa.large_string()), np.fromiter([*place.values(), -1], dtype=np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """A row for each word: the places of the word and of its starts, -1 for those that the index has not."""
        sizes, star, none = pc.utf8_length(words), pa.scalar("*", words.type), pa.scalar("", words.type)
        starts = [pc.if_else(pc.greater(sizes, n), pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, n), star, none), none) for n in STARTS]
        # one call, since each builds a table of all the index's terms; no term is empty
        found = pc.index_in(pa.concat_arrays([words, *starts]), value_set=self.terms)
        return self.place[pc.fill_null(found, -1).to_numpy()].reshape(1 + len(STARTS), len(words)).T

    def counts_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text's terms in the index the end among all, the places (ascending in a text) and the occurrences. Whole texts are read."""
        words = [pa.array(_WORD.findall(text.lower()) if text else [], pa.large_string()) for text in texts]
        text_of = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        coded = pa.concat_arrays([pa.array([], pa.large_string()), *words]).dictionary_encode()
        places = self.places(coded.dictionary)[coded.indices.to_numpy()]
        size = len(self.place)
        keys = (places + size * text_of[:, None])[places >= 0]
        met, times = np.unique(keys, return_counts=True)
        return np.searchsorted(met, np.arange(1, len(texts) + 1) * size), met % size, times

    def counts(self, text: str) -> dict[int, int]:
        """Occurrences of the index's terms in a whole text."""
        _, places, times = self.counts_all([text])
        return dict(zip(places.tolist(), times.tolist(), strict=True))


def unit_vectors(ends: np.ndarray, places: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF weights of some texts' terms, those of each text before its end."""
    w = (1 + np.log(times)) * idf[places]
    sizes = np.diff(ends, prepend=0)
    norms = np.sqrt(np.bincount(np.repeat(np.arange(len(ends)), sizes), w * w, minlength=len(ends)))
    return w / np.repeat(np.where(norms > 0, norms, 1), sizes)


def unit_vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and unit TF-IDF weights of a text's terms, in order of place."""
    places = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
    times = np.fromiter(counts.values(), dtype=float, count=len(counts))
    order = np.argsort(places)
    places = places[order]
    return places, unit_vectors(np.array([len(places)]), places, times[order], idf)


@dataclass
class Index:
    """Block-max inverted index of unit TF-IDF rows."""

    terms: list[str]
    idf: np.ndarray
    labels: np.ndarray
    names: np.ndarray
    #: Weights of the examples: a dense row of terms for each, or places and weights of each. Left empty once indexed.
    rows: np.ndarray | list
    #: Largest weight of each common term in each block.
    most: np.ndarray
    #: Edges and values of the calibration of votes, and the score of texts without a neighbour.
    knots: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    lonely: float = 0.0
    prior: float = 0.0
    #: What an example of each class stands for: rows of the class over examples of it.
    stands_for: np.ndarray = field(default_factory=lambda: np.ones(2))

    def __post_init__(self) -> None:
        n, rows = len(self.labels), self.rows
        if isinstance(rows, np.ndarray):
            rows = [(np.flatnonzero(r), r[r != 0]) for r in rows[:n]]
        self.rows = []
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(p) for p, _ in rows])
        place = np.concatenate([np.zeros(0, np.int64), *(p for p, _ in rows)])
        weight = np.concatenate([np.zeros(0, np.float32), *(w for _, w in rows)]).astype(np.float32)
        held = np.bincount(place, minlength=len(self.terms))
        #: Number of each common term, -1 for rare ones; weights of common terms by block, term and example.
        self.column = np.where(held * COMMON > n, 0, -1)
        self.column[self.column == 0] = np.arange((self.column == 0).sum())
        often = self.column[place] >= 0
        blocks = -(-n // BLOCK)
        self.common = np.zeros((blocks, int(self.column.max(initial=-1)) + 1, BLOCK), dtype=np.float32)
        self.common[owner[often] // BLOCK, self.column[place[often]], owner[often] % BLOCK] = weight[often]
        self.most = self.common.max(axis=2)
        #: Posting lists of rare terms: where each begins, examples and weights.
        owner, place, weight = owner[~often], place[~often], weight[~often]
        order = np.argsort(place, kind="stable")
        self.examples, self.weights = owner[order].astype(np.int64), weight[order].astype(np.float64)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(self.terms)))])

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Places and unit weights of a text. A query's words that no example has are left out of its norm:
        that scales all its cosines alike, and neither the nearest examples nor their vote change."""
        return unit_vector(counts, self.idf)

    def rare_sums(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The cosines' share of these rare terms, for each example."""
        start = self.begin[places]
        held = self.begin[places + 1] - start
        at = np.repeat(start - np.cumsum(held) + held, held) + np.arange(held.sum())
        return np.bincount(self.examples[at], self.weights[at] * np.repeat(weights, held), minlength=len(self.most) * BLOCK)

    def nearest_all(self, ends: np.ndarray, places: np.ndarray, weights: np.ndarray, k: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of some texts the k[i] examples of largest cosine over 0, and the cosines; ties by place in the index. Exact.

        A text is given by its terms' places and unit weights, which lie before its end among all.
        """
        n, m = len(self.labels), len(ends)
        if not n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * m
        blocks, n_columns = self.most.shape
        # no sum of n_columns products in single precision is off by more, weights and rows being of length 1
        slack = (n_columns + 8) * 2.0**-22
        column, spans = self.column[places], list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
        often = column >= 0
        common = np.zeros((m, n_columns), dtype=np.float32)
        common[np.repeat(np.arange(m), np.diff(ends, prepend=0))[often], column[often]] = weights[often]
        rare = np.stack([self.rare_sums(places[a:b][~often[a:b]], weights[a:b][~often[a:b]]) for a, b in spans]).reshape(m, blocks, BLOCK)
        bound = rare.max(axis=2) + common @ self.most.T + slack
        cosines = np.full((m, blocks, BLOCK), -1.0)

        def search(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(axis=0)):
                texts = np.flatnonzero(wanted[:, block])
                # a product for all texts takes less than a copy of most of their rows
                sums = common @ self.common[block] if 2 * len(texts) > m else common[texts] @ self.common[block]
                cosines[texts, block] = rare[texts, block] + (sums[texts] if len(sums) > len(texts) else sums)

        def least(row: np.ndarray, k: int) -> float:
            """What the k-th cosine isn't below."""
            return float(np.partition(row, len(row) - k)[len(row) - k]) - slack if len(row) >= k else -1.0

        # the blocks of highest bounds give the cosine that others must reach
        first = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS]
        wanted = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(wanted, first, True, axis=1)
        search(wanted)
        reach = np.array([least(cosines[i, first[i]].ravel(), k[i]) for i in range(m)])
        search((bound >= reach[:, None]) & ~wanted)
        out = []
        for i, (a, b) in enumerate(spans):
            row = cosines[i].ravel()
            near = np.flatnonzero((row > 0) & (row >= least(row, k[i]) - slack))
            held = often[a:b]
            rows = self.common[(near // BLOCK)[:, None], column[a:b][held], (near % BLOCK)[:, None]]
            exact = rare[i].ravel()[near] + (rows * weights[a:b][held]).sum(axis=1)
            best = np.lexsort((near, -np.round(exact, 12)))[: k[i]]
            out.append((near[best], exact[best]))
        return out

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """nearest_all() for one text."""
        return self.nearest_all(np.array([len(places)]), places, weights, [k])[0]

    def neighbours(self, texts: list[str], known: Vocabulary, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """nearest() for each of some whole texts."""
        ends, places, times = known.counts_all(texts)
        weights = unit_vectors(ends, places, times, self.idf)
        for i in range(0, len(texts), AT_ONCE):
            part = ends[i : i + AT_ONCE]
            low = int(ends[i - 1]) if i else 0
            yield from self.nearest_all(part - low, places[low : part[-1]], weights[low : part[-1]], [k] * len(part))

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        """Share of label 1 in the votes, each of a weight that falls with the distance and that evens out the sample's classes."""
        w = cosines**2 * self.stands_for[self.labels[found]]
        return float((w * self.labels[found]).sum() / w.sum())


def sample_examples(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[DataFrame, dict[int, int]]:
    """About ``examples`` labelled texts of each class by a hash of the id, and the number of rows of each class.

    This bound is on the training sample alone.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000)) / 1_000_000.0
    share = F.when(F.col("toxic") == 1, examples / max(1, sizes.get(1, 0))).otherwise(examples / max(1, sizes.get(0, 0)))
    # the drawn ids are bounded by the parameter, so they are sent to the texts
    drawn = F.broadcast(known.where(draw < share))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(drawn, "doc_id"), sizes


def example_terms(texts: list[str]) -> tuple[list[str], list[dict[int, int]]]:
    """All terms of the examples, and the occurrences of each (by place) in every text."""
    place: dict[str, int] = {}
    counts = [{place.setdefault(t, len(place)): n for t, n in text_terms(text).items()} for text in texts]
    return list(place), counts


def document_frequency(docs: DataFrame, terms: list[str], text: str = "text") -> tuple[int, np.ndarray]:
    """Number of rows, and of rows with each term, over all of ``docs``: from each task a row for each term it met."""
    place = {t: i for i, t in enumerate(terms)}

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total, n = Vocabulary(place), np.zeros(len(terms), dtype=np.int64), 0
        for pdf in batches:
            n += len(pdf)
            texts = pdf["text"].tolist()
            for begin in range(0, len(texts), READ):
                total += np.bincount(known.counts_all(texts[begin : begin + READ])[1], minlength=len(terms))
        met = np.flatnonzero(total)
        yield pd.DataFrame({"place": np.append(met, -1), "n": np.append(total[met], n)})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(add, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # one row for each term of the examples
    place, n = (got.column(c).to_numpy() for c in ("place", "n"))
    out = np.zeros(len(terms))
    out[place[place >= 0]] = n[place >= 0]
    return int(n[place < 0].sum()), out


def fit_index(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Index:
    """Index of the sampled examples, with document frequencies over all of ``docs``.

    Without labels of both classes the index is empty and every score is the share of label 1 known, or 0.
    """
    sample, sizes = sample_examples(docs, labels, examples)
    rows = sample.select("doc_id", "toxic", "text").collect()  # bounded by ``examples`` of each class
    rows.sort(key=lambda r: (r.doc_id % 101, r.doc_id, r.text))
    y = np.array([r.toxic for r in rows], dtype=np.int64)
    known = sum(sizes.values())
    prior = sizes.get(1, 0) / known if known else 0.0
    terms, counts = example_terms([r.text for r in rows]) if len(set(y.tolist())) == 2 else ([], [])
    n, df = document_frequency(docs, terms) if terms else (0, np.zeros(0))
    idf, names = np.log((1 + n) / (1 + df)) + 1 if terms else df, np.array([r.doc_id for r in rows], dtype=np.int64)
    if not terms:
        return Index(terms, idf, y[:0], names[:0], [], np.zeros((0, 0)), prior=prior, lonely=prior)
    vectors = [unit_vector(c, idf) for c in counts]
    # examples with the same heaviest term stand together, so that blocks have tighter bounds
    order = sorted(range(len(rows)), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]) if len(vectors[i][0]) else len(terms), i))
    vectors = [vectors[i] for i in order]
    index = Index(terms, idf, y[order], names[order], vectors, np.zeros((0, 0)), prior=prior, lonely=prior)
    n_class = np.bincount(index.labels, minlength=2)
    index.stands_for = np.array([sizes.get(c, 0) / max(1, n_class[c]) for c in (0, 1)])
    digests = [hashlib.md5(rows[i].text.encode("utf-8", "surrogatepass")).digest() for i in order]
    _calibrate(index, vectors, digests)
    return index


def _calibrate(index: Index, vectors: list, digests: list[bytes]) -> None:
    """Each example is judged without those of an equal text (digest), itself too. Scores of votes: the weighted share of label 1 among examples of similar votes, made monotone."""
    weight, copies = index.stands_for, Counter(digests)
    votes, alone = [], [0.0, 0.0]
    nearest: list = []
    for begin in range(0, len(vectors), AT_ONCE):
        part = vectors[begin : begin + AT_ONCE]
        ends, (places, w) = np.cumsum([len(p) for p, _ in part]), (np.concatenate(x) for x in zip(*part, strict=True))
        nearest += index.nearest_all(ends, places, w, [NEIGHBOURS + copies[d] for d in digests[begin : begin + AT_ONCE]])
    for i, (found, cosines) in enumerate(nearest):
        keep = [j for j, f in enumerate(found) if digests[f] != digests[i]][:NEIGHBOURS]
        label = index.labels[i]
        if keep:
            votes.append((index.vote(found[keep], cosines[keep]), label, weight[label]))
        else:
            alone[label] += weight[label]
    index.lonely = alone[1] / sum(alone) if sum(alone) else index.prior
    votes.sort()
    groups: list[list[float]] = []  # vote, label 1, all: pooled until the shares rise
    for v, label, w in votes:
        groups.append([v * w, label * w, w])
        while len(groups) > 1 and groups[-2][1] / groups[-2][2] >= groups[-1][1] / groups[-1][2]:
            last = groups.pop()
            groups[-1] = [a + b for a, b in zip(groups[-1], last, strict=True)]
    if groups:
        index.knots = (np.array([g[0] / g[2] for g in groups]), np.array([(g[1] + index.prior) / (g[2] + 1) for g in groups]))


def score_texts(docs: DataFrame, index: Index, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (1 from ``threshold`` on) and evidence (ids of the nearest examples).

    Null and empty texts, and texts without a term of the index, have no neighbours and get the share of
    label 1 among such examples. Texts are read whole; repeated rows have equal scores. Columns of those names are
    replaced, others kept. Ties go by place in the index. An empty table gives an empty one.
    """
    made = ("score", "predicted", "evidence")
    keep = [c for c in docs.columns if c not in made]
    sent = docs.sparkSession.sparkContext.broadcast(index)
    kept: dict = {}

    @F.pandas_udf("score double, evidence array<long>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ix = sent.value
        if "v" not in kept:
            kept["v"] = Vocabulary({t: i for i, t in enumerate(ix.terms)})
        known = kept["v"]
        for texts in batches:
            seen: dict = {}
            different = list(dict.fromkeys(t or "" for t in texts.where(texts.notna(), "")))
            for begin in range(0, len(different), READ):
                part = different[begin : begin + READ]
                for t, (found, cosines) in zip(part, ix.neighbours(part, known, NEIGHBOURS), strict=True):
                    score = float(np.interp(ix.vote(found, cosines), *ix.knots)) if len(found) else ix.lonely
                    seen[t] = (min(1.0, max(0.0, score)), ix.names[found].tolist())
            judged = [seen[t or ""] for t in texts.where(texts.notna(), "")]
            yield pd.DataFrame({"score": [s for s, _ in judged], "evidence": [e for _, e in judged]})

    (own,) = private(docs, "_judged")
    scored = docs.select(*keep, judge(F.col(text)).alias(own))
    score = F.col(f"{own}.score")
    return scored.select(*keep, score.alias("score"), (score >= threshold).cast("int").alias("predicted"), F.col(f"{own}.evidence").alias("evidence"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = fit_index(docs, labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return score_texts(docs.select("doc_id", "text", held.alias("held_out")), index).select(
        "doc_id", "held_out", "score", "predicted", F.array_join(F.col("evidence").cast("array<string>"), ",").alias("evidence")
    )


QUERIES = {"op5_toxicity": op5_toxicity}
SQL: dict[str, str] = {}
