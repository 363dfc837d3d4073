"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A table has cells of a count, the exclusive or of digests and that of their checks. Two versions' tables
subtract cell by cell; cells with one digest left give it up, which frees others, until the paragraphs that
differ are known. If that fails, the tables are made again, twice as large.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize, table

#: Hash places of a digest, and cells of the published fingerprint and of the first attempt.
PLACES, CELLS = 3, 30
#: Pairs of texts that are compared at once.
SOME = 128
#: Paragraphs longer than this are cut after about one word in so many.
LONG, WORDS = 160, 16
#: A paragraph ends at a line's end or after a sentence.
_END = re.compile(r"\n|(?<=[.!?])\s")
_WORD = re.compile(r"\S+")

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """Well-mixed 64 bits of each number."""
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def paragraphs(text: str) -> Iterator[str]:
    """Paragraphs that aren't blank, without white space at their ends.

    Running text without an end is cut after words of its own choosing, about one in ``WORDS``: what is put in or taken out
    moves no cut but those beside it.
    """
    for part in _END.split(text):
        if len(part) <= LONG:
            if part and not part.isspace():
                yield part.strip()
            continue
        at = 0
        for word in _WORD.finditer(part):
            if zlib.crc32(word[0].encode("utf-8", "surrogatepass")) % WORDS == 0:
                yield part[at : word.end()].strip()
                at = word.end()
        if part[at:].strip():
            yield part[at:].strip()


def digests(text: str) -> np.ndarray:
    """A digest of each paragraph; a paragraph that repeats has a new one each time."""
    seen: dict[int, int] = {}
    out = []
    for part in paragraphs(text):
        d = xxhash.xxh3_64_intdigest(part)
        n = seen[d] = seen.get(d, -1) + 1
        out.append((d + n * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return np.array(out, dtype=np.uint64)


class Tables:
    """Tables of ``cells`` cells for many sketches at once."""

    def __init__(self, n: int, cells: int) -> None:
        self.cells = cells
        self.count = np.zeros(n * cells, dtype=np.int64)
        self.key, self.check = np.zeros(n * cells, dtype=np.uint64), np.zeros(n * cells, dtype=np.uint64)

    def add(self, keys: np.ndarray, sign: np.ndarray, owner: np.ndarray) -> None:
        """Adds (sign 1) or takes away (-1) digests in their owners' tables."""
        part, check = self.cells // PLACES, _mix(keys, 99)
        for j in range(PLACES):
            at = owner * self.cells + j * part + (_mix(keys, j + 1) % np.uint64(part)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests, signs and owners that come out of the tables; those of a failed table are of no use."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            one = np.flatnonzero(np.abs(self.count) == 1)
            one = one[self.check[one] == _mix(self.key[one], 99)]
            if not len(one):
                break
            keys, sign, owner = self.key[one], self.count[one], one // self.cells
            _, first = np.unique(_mix(keys, 7) ^ _mix(owner.astype(np.uint64), 8), return_index=True)
            keys, sign, owner = keys[first], sign[first], owner[first]
            self.add(keys, -sign, owner)
            found.append((keys, sign, owner))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def failed(self) -> np.ndarray:
        """Owners whose tables still hold something."""
        return np.unique(np.flatnonzero((self.count != 0) | (self.key != 0)) // self.cells)


def fingerprints(many: list[np.ndarray]) -> list[str]:
    """Each list's table of CELLS cells as text: number of paragraphs, then the cells in base64."""
    t = Tables(len(many), CELLS)
    keys = np.concatenate([*many, np.zeros(0, np.uint64)])
    t.add(keys, np.ones(len(keys), dtype=np.int64), np.repeat(np.arange(len(many)), [len(x) for x in many]))
    out = []
    for i, own in enumerate(many):
        part = slice(i * CELLS, (i + 1) * CELLS)
        cells = t.count[part].astype("<i4").tobytes() + t.key[part].astype("<u8").tobytes() + t.check[part].astype("<u4").tobytes()
        out.append(f"{len(own)}:{base64.b64encode(cells).decode()}")
    return out


def differences(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each pair of digest lists, the digests only in the left and only in the right, by peeling; larger tables for those that fail."""
    only: tuple[list[np.ndarray], list[np.ndarray]] = ([np.zeros(0, np.uint64)] * len(left), [np.zeros(0, np.uint64)] * len(left))
    todo, cells = np.arange(len(left)), CELLS
    while len(todo):
        lists = [x for i in todo for x in (left[i], right[i])]
        sizes = np.array([len(x) for x in lists])
        keys = np.concatenate([*lists, np.zeros(0, np.uint64)])
        t = Tables(len(todo), cells)
        t.add(keys, np.repeat(np.tile([1, -1], len(todo)), sizes), np.repeat(np.arange(len(todo)).repeat(2), sizes))
        keys, sign, owner = t.peel()
        bad = np.zeros(len(todo), dtype=bool)
        bad[t.failed()] = True
        order = np.argsort(owner, kind="stable")
        keys, sign, owner = keys[order], sign[order], owner[order]
        cut = np.searchsorted(owner, np.arange(len(todo) + 1))
        for k, i in enumerate(todo):
            if not bad[k] and cut[k] < cut[k + 1]:
                own, s = keys[cut[k] : cut[k + 1]], sign[cut[k] : cut[k + 1]]
                only[0][i], only[1][i] = own[s > 0], own[s < 0]
        todo, cells = todo[bad], cells * 2
    return only


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Paragraphs in common over paragraphs in either, of each pair; 1 if neither has any."""
    a, b = differences(left, right)
    shared = np.array([len(x) - len(d) for x, d in zip(left, a, strict=True)], dtype=float)
    either = shared + [len(x) + len(y) for x, y in zip(a, b, strict=True)]
    return np.where(either > 0, shared / np.maximum(either, 1), 1.0)


def edited_text(text: str, following: str) -> str:
    """The text, its last third replaced by as much of the start of the following one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _results(texts: list[str], following: list[str]) -> pd.DataFrame:
    parts = []
    for at in range(0, len(texts), SOME):
        own, nxt = texts[at : at + SOME], following[at : at + SOME]
        edited = [edited_text(a, b) for a, b in zip(own, nxt, strict=True)]
        d_own, d_edited, d_next = [digests(x) for x in own], [digests(x) for x in edited], [digests(x) for x in nxt]
        parts.append(pd.DataFrame({
            "n_chars": [len(x) for x in own], "edited_sha256": [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in edited],
            "fingerprint": fingerprints(d_own), "edited_fingerprint": fingerprints(d_edited),
            "near_edited": likeness(d_own, d_edited), "near_next": likeness(d_own, d_next),
        }))
    return pd.concat(parts, ignore_index=True)


def fingerprint_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``docs``.

    A row's next one is the one of the next smaller key, for the smallest the largest; equal keys follow each
    other by text; a null key comes last; a null text is empty; a single row is its own next. Other columns are left out.

    Rows are shuffled once, by ranges of keys. A task holds one row back; the first and last row of each task,
    which need the neighbouring task's, are paired in a second, small step.
    """
    kind = docs.schema[key].dataType.simpleString()
    ordered = (
        docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(F.desc("key")).sortWithinPartitions(F.desc("key"), "text")
    )
    shape = f"part int, edge string, key {kind}, text string, {_RESULT}"
    nothing = {c.split()[0]: None for c in _RESULT.split(", ")}

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), None

        def edge(name: str, row: tuple) -> pd.DataFrame:
            return pd.DataFrame([{"part": part, "edge": name, "key": row[0], "text": row[1], **nothing}])

        for pdf in batches:
            rows = list(zip(pdf["key"], pdf["text"], strict=True))
            if not rows:
                continue
            if held is None:
                yield edge("first", rows[0])
            else:
                rows = [held, *rows]
            held = rows[-1]
            if len(rows) > 1:
                out = _results([t for _, t in rows[:-1]], [t for _, t in rows[1:]])
                yield out.assign(part=part, edge=None, key=[k for k, _ in rows[:-1]], text=None)
        if held is not None:
            yield edge("last", held)

    stored = materialize(ordered.mapInPandas(walk, shape), "fingerprints")
    # at most two rows for each task; the window over them is as short as the list of tasks
    firsts = stored.where("edge = 'first'").select("part", F.col("text").alias("following"))
    circle = firsts.select(
        F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy())).alias("part"), "following"
    )
    lasts = stored.where("edge = 'last'").select("part", "key", "text").join(circle, "part")

    @F.pandas_udf(_RESULT)
    def close(texts: pd.Series, following: pd.Series) -> pd.DataFrame:
        return _results(list(texts), list(following))

    names = list(nothing)
    closed = lasts.select("key", close("text", "following").alias("r")).select("key", *(f"r.{c}" for c in names))
    return stored.where("edge is null").select("key", *names).unionByName(closed).withColumnRenamed("key", key)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


QUERIES = {"op7_fingerprints": op7_fingerprints}
SQL: dict[str, str] = {}
