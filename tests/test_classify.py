"""The classification job against a plain restatement, in all cases of references and metadata, and its restart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.operators.classify import Thresholds, Versions, classify

AT = Thresholds(same=0.35, reach=0.2, min_samples=3, merge=0.5, share=0.6, count=6)


def data(seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 8))
    who = r.integers(0, 6, 60)
    vec = centres[who] + 0.55 * r.normal(size=(60, 8))
    known = {i: {"abc"[who[i]]} if who[i] < 3 and r.random() < 0.8 else set() for i in range(60)}
    for i in range(0, 60, 9):
        known[i] = known[i] | {"c"}
    refs = [(100 + k, centres[k] + 0.2 * r.normal(size=8), n) for k, n in ((0, "a"), (1, "b|red"), (4, "e"), (4, "e"))]
    return vec, known, refs


def restated(vec, known, refs, keep):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    n, u = len(vec), unit(vec)
    diff = 1 - u @ u.T
    same = diff < AT.same
    meta = sorted({c for s in (known or {}).values() for c in s})
    names = list(meta)
    rl = None
    if refs:
        for c in sorted({c for _, _, c in refs}):
            if c not in names:
                names.append(c)
        rl = np.array([names.index(c) for _, _, c in refs])
        rd = 1 - u @ unit(np.array([x for _, x, _ in refs])).T
    shows = None
    if known is not None:
        shows = np.array([[c in known[i] or (j >= len(meta) and any(m.split("|")[0] == c.split("|")[0] and m in known[i] for m in meta)) for j, c in enumerate(names)] for i in range(n)], bool).reshape(n, len(names))
    # clusters by density, numbered by their smallest core row
    near = diff < AT.reach
    np.fill_diagonal(near, True)
    core = near.sum(1) >= AT.min_samples
    lab = np.full(n, -1)
    for i in range(n):
        if core[i] and lab[i] < 0:
            todo = [i]
            while todo:
                x = todo.pop()
                if lab[x] < 0:
                    lab[x] = i
                    todo += [y for y in range(n) if near[x, y] and core[y]]
    border = lab.copy()
    for i in range(n):
        if not core[i]:
            hit = [lab[j] for j in range(n) if near[i, j] and core[j]]
            border[i] = min(hit) if hit else -1
    lab, np_ = border, len(names)
    lab[lab >= 0] += np_

    def noise(lab, with_refs):
        out = lab.copy()
        for i in np.where(lab == -1)[0]:
            to, best_c = -1, {x: diff[i][lab == x].mean() for x in set(lab[lab >= 0])}
            c = min(best_c, key=lambda x: (best_c[x], x)) if best_c else None
            if with_refs:
                best_r = {x: rd[i][rl == x].min() for x in set(rl)}
                k = min(best_r, key=lambda x: (best_r[x], x))
                if best_r[k] < (best_c[c] if best_c else np.inf) and (rd[i][rl == k] <= AT.same * 0.5).any() and (shows is None or shows[i, k]):
                    to = k
            if to < 0 and c is not None and not (shows is not None and c < np_ and not shows[i, c]):
                hits = (diff[i][lab == c] <= AT.same)
                if hits.mean() >= AT.share or hits.sum() >= AT.count:
                    to = c
            if to < 0 and shows is not None and shows[i].sum() == 1:
                to = int(np.argmax(shows[i]))
            out[i] = to
        return out

    lab = noise(lab, refs is not None)
    if refs:
        new = lab.copy()
        for x in set(lab[lab >= 0]):
            avg = rd[lab == x].mean(0)
            by = {k: avg[rl == k].min() for k in set(rl)}
            k = min(by, key=lambda y: (by[y], y))
            if (avg[rl == k] <= AT.same).mean() >= AT.reference:
                for i in np.where(lab == x)[0]:
                    if shows is None or shows[i, k]:
                        new[i] = k
        lab = new
    if shows is not None:
        new = lab.copy()
        for x in set(lab[lab >= np_]):
            at = np.where(lab == x)[0]
            sums = shows[at][:, : len(meta)].sum(0)
            top = np.where(sums == sums.max())[0]
            if sums.max() / len(at) >= AT.metadata and len(top) == 1:
                for i in at:
                    if shows[i, top[0]]:
                        new[i] = top[0]
        lab = new
    if keep or (refs is None and shows is None):
        alive = set(lab[lab >= 0].tolist())
        while True:
            merged = False
            for x in sorted(alive):
                if x not in alive or x < (1 if np_ else 0):
                    continue
                for y in sorted(alive):
                    if y in alive and y > x and y >= np_ and same[lab == x][:, lab == y].mean() >= AT.merge:
                        for i in np.where(lab == y)[0]:
                            if shows is None or x >= np_ or shows[i, x]:
                                lab[i] = x
                        alive.remove(y)
                        merged = True
            if not merged:
                break
    else:
        lab[lab >= np_] = -1
    lab = noise(lab, False)
    np.fill_diagonal(same, True)
    kept = [lab[i] if lab[i] >= 0 and (same[i][lab == lab[i]].mean() >= AT.share or same[i][lab == lab[i]].sum() >= AT.count) else -1 for i in range(n)]
    return [int(x) for x in kept], names


def frames(spark, seed, meta, with_refs):
    vec, known, refs = data(seed)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vec)], "item long, vec array<double>")
    k = spark.createDataFrame([(i, c) for i, s in known.items() for c in s], "item long, character string") if meta else None
    r = spark.createDataFrame([(i, x.tolist(), c) for i, x, c in refs], "ref long, vec array<double>, character string") if with_refs else None
    return (vec, known if meta else None, refs if with_refs else None), (v, k, r)


@pytest.mark.parametrize(("meta", "with_refs", "keep", "seed"), [(False, False, False, 1), (True, False, True, 2), (False, True, True, 3), (True, True, False, 4)])
def test_classification_job(spark, meta, with_refs, keep, seed):
    plain, (v, k, r) = frames(spark, seed, meta, with_refs)
    items, characters, additions = classify(v, AT, k, r, keep_unnamed=keep, add=2)
    want, names = restated(*plain, keep)
    got = {x["item"]: x for x in items.collect()}
    assert [got[i].label for i in range(60)] == want and len(set(want)) > 1
    assert {x.label: x.character for x in characters.collect()} == dict(enumerate(names))
    assert all(x.character == (names[x.label] if 0 <= x.label < len(names) else None) for x in got.values())
    added = additions.groupBy("label").agg(F.count("*").alias("n"), F.max("label").alias("m")).collect()
    assert all(x.n <= 2 and x.m < len(names) for x in added) and (meta or with_refs or not added)


def test_restart(spark, tmp_path):
    _, (v, k, _) = frames(spark, 2, True, False)
    folder = f"file://{tmp_path}/job"
    first = sorted(map(tuple, classify(v, AT, k, folder=folder)[0].collect()))
    again = Versions(spark, folder)
    again.step("merged", lambda: pytest.fail("a complete stage ran again"))
    assert sorted(map(tuple, classify(v.limit(0), AT, k, folder=folder)[0].collect())) == first and not again.ran
