"""Operators that the check of round 3 found too slow: what was made faster gives the same results."""

import numpy as np

from siftloom.llm import op5_toxicity


def test_texts_searched_together_get_what_they_get_alone():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{'wort' if i % 3 else 'Größe'}{int(i)}" for i in rng.zipf(1.3, rng.integers(0, 60)) % 500) for _ in range(400)]
    terms, counts = op5_toxicity.example_terms(texts[:300])
    idf = 1 + rng.random(len(terms))
    rows = [op5_toxicity.unit_vector(c, idf) for c in counts]
    index = op5_toxicity.Index(terms, idf, np.arange(300) % 2, np.arange(300), rows, np.zeros((0, 0)))
    assert (index.column >= 0).sum() > 5 and (index.column < 0).sum() > 5
    known = op5_toxicity.Vocabulary({t: i for i, t in enumerate(terms)})
    dense = np.zeros((300, len(terms)))
    for i, (places, w) in enumerate(rows):
        dense[i, places] = w.astype(np.float32)
    together = list(index.neighbours(texts, known, 15))
    for text, (found, cosines) in zip(texts, together, strict=True):
        counted = {index.terms.index(t): n for t, n in op5_toxicity.text_terms(text).items() if t in known.terms.to_pylist()}
        assert known.counts(text) == counted
        places, w = op5_toxicity.unit_vector(counted, idf)
        cos = dense[:, places] @ w
        assert found.tolist() == [i for i in np.lexsort((np.arange(300), -np.round(cos, 12)))[:15] if cos[i] > 0]
        alone = index.nearest(places, w, 15)
        # bit by bit, whatever the texts beside it
        assert alone[0].tolist() == found.tolist() and np.allclose(alone[1], cosines, rtol=0, atol=1e-14)
    shuffled = rng.permutation(400)
    for i, (found, cosines) in zip(shuffled, index.neighbours([texts[i] for i in shuffled], known, 15), strict=True):
        assert found.tolist() == together[i][0].tolist() and cosines.tobytes() == together[i][1].tobytes()


def test_words_without_punctuation_are_remembered_once():
    import public_tokenizers

    from siftloom.llm.words import FastTokenizer

    for name, width in (("byte_bpe_50k.json", "<u2"), ("word_bpe_49k.json", "<u4")):
        fast = FastTokenizer(public_tokenizers.path(name), width)
        texts = ["lone words\nhere lone", "Mark, mark. Märk", "Mark mark", "lone, words."]
        assert fast.encode(texts) == [fast.whole(t) for t in texts]
        assert not any("ere" in p for p in fast.parts) and any("one" in p for p in fast.parts)
