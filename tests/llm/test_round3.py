"""Words encoded by the model itself, and searches over compact lists."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from garimpo.llm.packing import word_encoder
from garimpo.llm.toxicity import Index


class Refusing:
    """A tokenizer whose batches must not be asked."""

    def __init__(self, made):
        self.model, self.to_str = made.model, made.to_str


def test_the_model_encodes_words_as_the_tokenizer_does():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = ["the", " the", " zzqxv", "\n", " \t\n", "äzu", " ÿé", "!!", "'s", " 1234567", "ɏ¡", "\xad", "x" * 300]
    assert word_encoder(Refusing(made))(words) == [made.encode(w, add_special_tokens=False).ids for w in words]
    assert word_encoder(Refusing(made))([]) == []


def test_index_keeps_short_places_and_finds_the_best():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(500):
        terms = np.unique(np.r_[0, 1, rng.integers(2, 300, 12)])
        weight = rng.random(len(terms))
        rows.append((terms, weight / np.sqrt((weight**2).sum())))
    index = Index(rows, 300)
    assert index.owner.itemsize == 2
    full = np.zeros((500, 300))
    for i, (t, w) in enumerate(rows):
        full[i, t] = w
    for i in range(0, 500, 25):
        scores = np.round(full @ full[i], 12)
        scores[i] = 0
        first = np.lexsort((np.arange(500), -scores))[:15]
        found = index.nearest(*rows[i], 15, skip=i)
        assert [r for _, r in found] == first.tolist()
        assert np.allclose([s for s, _ in found], scores[first], atol=1e-11)
    assert index.nearest(np.array([299]), np.array([0.0]), 15) == []
